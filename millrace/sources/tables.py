"""Side inputs: the code dictionary, the dimension configuration feed, delimited text lines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.schemas import CONFIG_CHANGE, CONFIG_ROW, DICTIONARY


def jdbc_options(url: str, table: str, user: str = "", password: str = "", driver: str = "") -> dict[str, str]:
    options = {"url": url, "dbtable": table, "user": user, "password": password, "driver": driver}
    return {key: value for key, value in options.items() if value}


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000, max_bytes: int = 32 * 1024**2) -> DataFrame:
    """Mark ``df`` for broadcast if it has at most ``max_rows`` rows and ``max_bytes`` as text; otherwise leave the join to Spark.

    For sources whose size the planner cannot know, such as database tables; files carry their size. The check reads
    at most ``max_rows`` + 1 rows and holds for the rows of that moment: call it anew for every micro-batch.
    """
    size = F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))
    rows, held = df.limit(max_rows + 1).agg(F.count(F.lit(1)), size).first()
    return F.broadcast(df) if rows <= max_rows and held <= max_bytes else df


def with_fresh(
    load: Callable[[], DataFrame], rule: Callable[[DataFrame, DataFrame], DataFrame], write: Callable[[DataFrame, int], None]
) -> Callable[[DataFrame, int], None]:
    """A micro-batch writer that applies ``rule(batch, side)`` with the side loaded and measured anew for every batch.

    A folder is listed again and a table queried again, so entries that came since the last batch are seen.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        write(rule(batch, broadcast_if_small(load())), batch_id)

    return run


def load_dictionary(spark: SparkSession, path: str | None = None, jdbc: dict[str, str] | None = None) -> DataFrame:
    """``dic_code, dic_name`` from a Parquet folder or a database table.

    A database table is queried again for every micro-batch of a stream, so changed names are seen without a cache to
    expire; a folder is listed once, when this is called. ``with_fresh`` calls it for every batch. No broadcast hint here: it would hold for good.
    """
    names = DICTIONARY.fieldNames()
    if path is not None:
        return spark.read.schema(DICTIONARY).parquet(path)
    return spark.read.format("jdbc").options(**(jdbc or {})).load().select(*names)


def config_changes(text: DataFrame, value: str = "value") -> DataFrame:
    """Configuration change records (``before, after, op, ts_ms``) from JSON text."""
    kept = [c for c in text.columns if c != value]
    return text.select(*kept, F.from_json(value, CONFIG_CHANGE).alias("_c")).select(*kept, "_c.*")


def config_snapshot(table: DataFrame) -> DataFrame:
    """A configuration table as change records with op ``r``, to be followed by later changes."""
    row = F.struct(*CONFIG_ROW.fieldNames()).cast(CONFIG_ROW)
    return table.select(
        F.lit(None).cast(CONFIG_ROW).alias("before"),
        row.alias("after"),
        F.lit("r").alias("op"),
        F.lit(0).cast("bigint").alias("ts_ms"),
    )


def read_lines(spark: SparkSession, path: str, schema: StructType, streaming: bool = False) -> DataFrame:
    """Comma-separated lines as typed rows."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(schema).csv(path)


def split_lines(text: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """Comma-separated text already in a frame as typed rows."""
    parts = F.split(F.col(value), ",")
    return text.select(
        *[F.get(parts, F.lit(i)).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)]
    )
