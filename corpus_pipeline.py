"""The corpus pipeline: documents through five of the operators in turn."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pulsehouse.llm import decontaminate, jaccard_join, language_id, mixing, sharding
from pulsehouse.llm.common import table
from pulsehouse.session import new_run_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents whose language is rejected go."""
    return language_id.keep_identified(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: one document of each group of near copies stays."""
    return jaccard_join.keep_one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents with a window of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: sources brought to their target weights, documents
    repeated or left out for it; rows are written in training order."""
    return mixing.mixed_documents(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: each row with its shard and its slot there; slots keep the
    training order in which the rows were written."""
    return sharding.shard(docs, in_order=True)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identified),
    ("jaccard_join", one_of_each_group),
    ("decontamination", decontaminated),
    ("source_mixing", mixed),
    ("sharding", sharded),
]

# The language models and the label propagation have no SQL form; the stages
# are tested against brute-force versions in tests/llm/.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet in
    the shared folder and reread as the next stage's input."""
    docs = table(spark, sf_dir, "documents")
    base = new_run_dir(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{base}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
