"""Training corpus from raw documents, in five stages.

Each stage is one operator of ``millrace.llm`` over all that the stage before kept; what a stage returns is written as Parquet and read
again as the next one's input. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm import decontaminate, jaccard, mixing, token_files, toxicity
from millrace.llm.queries import MIXTURE
from millrace.llm.tables import counted, read_table, stored
from millrace.session import shared_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the score at which a text is predicted toxic."""
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked documents the one with the smallest id; documents without words or id are in none and stay."""
    placed = stored(jaccard.jaccard_components(docs), "pipeline-components")
    away = placed.where("component_id <> doc_id").select("doc_id").distinct()
    kept = docs.join(counted(away), "doc_id", "left_anti").select(docs.columns)
    # rows that share an id are one document; usually there are none
    repeated = placed.where("component_id = doc_id").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if repeated.isEmpty():
        return kept
    repeated = counted(repeated)
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    one = kept.join(repeated, "doc_id", "left_semi").withColumn("__first", first).where("__first = 1").drop("__first")
    return kept.join(repeated, "doc_id", "left_anti").select(docs.columns).unionByName(one)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose words are not, to a twentieth or more, benchmark windows."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights, in shuffled order."""
    return mixing.mix_rows(docs, MIXTURE)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus in token files; returns what is read back from them per document."""
    path = shared_dir(spark, "pipeline-tokens")
    token_files.write_token_files(docs, path)
    return token_files.read_documents(spark, path)


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("source_mixing", mix_sources),
    ("token_files", write_tokens),
]

#: The first stage is a trained model, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
