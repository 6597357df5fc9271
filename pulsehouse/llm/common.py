"""Small helpers shared by the operators: tables, checkpoints, prefix sums."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsehouse.session import shared_dir, ship_package

# Word separators of every contract: space and \x09-\x0D.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once in the folder of ``spark.checkpoint.dir``
    (survives lost executors; cuts the lineage of loops)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def map_arrow(df: DataFrame, run, schema: str) -> DataFrame:
    """``mapInArrow`` with the package made importable in the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


# Rows of a few longs up to which a side is broadcast (some 50 MB as a hashed
# relation); beyond, the same join is a shuffle join.
BROADCAST_ROWS = 500_000


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (materialised) with a broadcast hint if it is small enough."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def keep_sized(df: DataFrame, rows_per_part: int = 50_000) -> tuple[DataFrame, int]:
    """``keep`` and the number of rows, in partitions sized to them: tables
    that shrink from round to round would else keep the partitions, and every
    later shuffle the files, of the largest."""
    df = keep(df)
    n = df.count()
    return df.coalesce(max(1, -(-n // rows_per_part))), n


# Rows of a file that share a block of ``file_order``.
_FILE_BLOCK_BITS = 14


def file_order(df: DataFrame) -> DataFrame | None:
    """``df``, read from Parquet files that Spark wrote, with the columns
    ``__place`` (sorts rows as they were written: by part number, then row) and
    ``__stretch`` (of up to 16,384 rows that follow each other). None for a
    table that is not read from files, which has no such order."""
    try:
        meta = df.metadataColumn("_metadata")
        rows = df.select("*", meta.getField("file_name").alias("__f"),
                         meta.getField("row_index").alias("__i"))
    except AnalysisException:
        return None
    part = F.coalesce(F.regexp_extract("__f", r"^part-(\d+)-", 1).try_cast("long"), F.lit(0))
    piece = F.coalesce(F.regexp_extract("__f", r"-c(\d+)\.", 1).try_cast("long"), F.lit(0))
    return (rows.withColumn("__place", F.struct(part, piece, F.col("__f"), F.col("__i")))
            .withColumn("__stretch", F.struct(part, piece, F.col("__f"), F.shiftright(
                "__i", _FILE_BLOCK_BITS))).drop("__f", "__i"))


def utf8_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def blocks_for(n_rows: int, rows_per_block: int = 20_000) -> int:
    """Blocks that keep about ``rows_per_block`` rows each at any size."""
    return max(1, -(-n_rows // rows_per_block))


def running_totals(df: DataFrame, group: list[str], block: str, order: list,
                   value: str | Column, out: str) -> DataFrame:
    """Sum of ``value`` over the rows of the same ``group`` that come earlier
    in (``block``, ``order``), as column ``out``; exclusive of the row.

    Two levels, so that a group with a third of all rows is not one task:
    blocks are summed (map-side combined), the few block sums of a group are
    accumulated, and rows are accumulated inside their block only.
    """
    v = F.col(value) if isinstance(value, str) else value
    df = df.withColumn("__v", v.cast("long"))
    sums = df.groupBy(*group, block).agg(F.sum("__v").alias("__s"))
    before = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    w = before.orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    offs = sums.select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)],
                       F.col(block).alias("__b"),
                       F.coalesce(F.sum("__s").over(w), F.lit(0)).alias("__o"))
    cond = F.col(block) == F.col("__b")
    for i, g in enumerate(group):
        cond = cond & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    inner = (Window.partitionBy(*group, block).orderBy(*order)
             .rowsBetween(Window.unboundedPreceding, -1))
    rows = df.withColumn("__r", F.coalesce(F.sum("__v").over(inner), F.lit(0)))
    return (rows.join(offs, cond)
            .withColumn(out, F.col("__o") + F.col("__r"))
            .drop("__v", "__r", "__o", "__b", *[f"__g{i}" for i in range(len(group))]))
