"""Click-log text to records, with the unreadable lines set apart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from millrace.functions import times
from millrace.schemas import CLICK_LOG


def parse_log(text: DataFrame, schema: StructType = CLICK_LOG, value: str = "value") -> DataFrame:
    """Parse each line once into ``record`` and ``is_dirty``, next to the untouched text.

    Dirty: not a JSON object, cut short, of the wrong field types, or without the device id or time that every
    later step needs. Pass a wider ``schema`` to keep further fields.
    """
    corrupt = "_corrupt"
    read = StructType([*schema.fields]).add(corrupt, StringType())
    record = F.from_json(value, read, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    # as the output of a generator the record is computed once; as a plain column the optimizer would repeat the
    # parse in every filter and projection that uses it
    parsed = text.select("*", F.explode(F.array(record)).alias("record"))
    dirty = (
        F.col("record").isNull()
        | F.col(f"record.{corrupt}").isNotNull()
        | F.col("record.common.mid").isNull()
        | F.col("record.ts").isNull()
    )
    return parsed.withColumn("is_dirty", F.coalesce(dirty, F.lit(True)))


def dirty_lines(parsed: DataFrame, value: str = "value") -> DataFrame:
    """The dirty lines, verbatim."""
    return parsed.where("is_dirty").drop("record", "is_dirty")


def clean_records(parsed: DataFrame, value: str = "value") -> DataFrame:
    """The readable lines as columns."""
    kept = [c for c in parsed.columns if c not in (value, "record", "is_dirty")]
    fields = [f.name for f in parsed.schema["record"].dataType.fields if f.name != "_corrupt"]
    return parsed.where("NOT is_dirty").select(*kept, *[F.col(f"record.{f}").alias(f) for f in fields])


def split_json_text(text: DataFrame, value: str = "value") -> DataFrame:
    """Mark lines of any JSON shape: ``is_dirty`` where the text is not a JSON object."""
    parsed = F.try_parse_json(value)
    return text.withColumn("is_dirty", ~F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False)))


def page_columns(records: DataFrame) -> DataFrame:
    """Page records as the flat page log the reports work on: one row per page, ``ts`` a timestamp."""
    kept = [c for c in records.columns if c == "log_id"]
    return records.select(
        *kept,
        "common.mid",
        "common.uid",
        "common.is_new",
        "common.vc",
        "common.ch",
        "common.ar",
        "page.page_id",
        "page.last_page_id",
        "page.item",
        "page.item_type",
        "page.during_time",
        times.from_millis("ts").alias("ts"),
    )
