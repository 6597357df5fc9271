"""The registered queries of the training-data operators.

Each takes (spark, sf_dir), applies its operator with production parameters
to its whole table and returns one row per document or page.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsehouse.llm.common import table


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pulsehouse.llm.jaccard_join import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pulsehouse.llm.secret_scan import scan

    return scan(table(spark, sf_dir, "documents"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pulsehouse.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pulsehouse.llm.quality_rules import judge

    return judge(table(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pulsehouse.llm.sharding import shard

    return shard(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op5_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pulsehouse.llm.resampling import resample

    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pulsehouse.llm.html_extract import extract

    return extract(table(spark, sf_dir, "pages"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pulsehouse.llm.decontaminate import contamination

    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pulsehouse.llm.line_dedup import dedup_lines

    return dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_deleted", "deleted_words", "runs",
        F.length("text").cast("long").alias("kept_chars"), F.sha2("text", 256).alias("kept_sha256"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pulsehouse.llm.language_id import identify

    return identify(table(spark, sf_dir, "documents")).select(
        "doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pulsehouse.llm.periodic_runs import periodic_runs

    return periodic_runs(table(spark, sf_dir, "documents"), plant=True)


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pulsehouse.llm.warc import archive
    from pulsehouse.session import new_run_dir

    read = archive(table(spark, sf_dir, "pages"), new_run_dir(spark, "warc"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pulsehouse.llm.conversation_trie import prefix_trie

    return prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_source_mixing": op2_source_mixing,
    "op3_quality_rules": op3_quality_rules,
    "op4_sharding": op4_sharding,
    "op5_importance_resampling": op5_importance_resampling,
    "op6_html_text": op6_html_text,
    "op7_decontamination": op7_decontamination,
    "op8_line_dedup": op8_line_dedup,
    "op9_language_id": op9_language_id,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_warc": op12_warc,
    "op13_conversation_trie": op13_conversation_trie,
}
