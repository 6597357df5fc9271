"""Static dimensions (SRC-3, SRC-4): '|'-delimited text, no header,
schema given up front (never inferred)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ITEM_DIM_SCHEMA = T.StructType(
    [
        T.StructField("dim_item_id", T.LongType(), False),
        T.StructField("category", T.StringType(), True),
        T.StructField("dim_content_len", T.IntegerType(), True),
    ]
)

USER_DIM_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType(), False),
        T.StructField("interest_tags", T.StringType(), True),
        T.StructField("level", T.IntegerType(), True),
    ]
)


def _read_pipe_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (
        spark.read.option("delimiter", "|")
        .option("header", "false")
        .option("mode", "PERMISSIVE")
        .schema(schema)
        .csv(path)
    )


def load_item_dim(spark: SparkSession, path: str) -> DataFrame:
    """SRC-3: dim_item_id | category | dim_content_len."""
    return _read_pipe_csv(spark, path, ITEM_DIM_SCHEMA)


def load_user_dim(spark: SparkSession, path: str) -> DataFrame:
    """SRC-4: user_id | comma list of interest tags (may be empty) | level.

    ``interest_tags`` becomes an array; an empty field gives an empty array.
    """
    raw = _read_pipe_csv(spark, path, USER_DIM_SCHEMA)
    tags = F.when(
        F.coalesce(F.trim("interest_tags"), F.lit("")) == "",
        F.array().cast("array<string>"),
    ).otherwise(F.transform(F.split("interest_tags", ","), lambda t: F.trim(t)))
    return raw.withColumn("interest_tags", tags)


def user_interest_rows(user_dim: DataFrame) -> DataFrame:
    """One row per (user_id, tag), for joins on interest."""
    return user_dim.select("user_id", "level", F.explode("interest_tags").alias("tag"))
