"""Dimension enrichment (JOIN-1, JOIN-2, PRJ-3, PRJ-4).

Every event is kept: a left join on item_id, misses and null items get
category ``Unknown`` and content_len 0. The event's own content_len is
always replaced by the dimension's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsehouse import config

# Partitions the item-less events spread over in a shuffle join.
NULL_KEY_SALTS = 1024


def dedupe_dimension(dim: DataFrame, key: str = "dim_item_id") -> DataFrame:
    """One row per key, so that the left join can never fan an event out.
    With duplicates, the smallest (category, content_len) wins."""
    others = [c for c in dim.columns if c != key]
    first = F.min(F.struct(*others)).alias("_d")
    return dim.groupBy(key).agg(first).select(key, *[F.col(f"_d.{c}").alias(c) for c in others])


def bounded_broadcast(
    small: DataFrame,
    max_rows: int,
    max_bytes: int = config.DEFAULT_SCALE.broadcast_max_bytes,
) -> tuple[DataFrame, bool]:
    """Broadcast ``small`` only when it has at most ``max_rows`` rows and
    about ``max_bytes`` bytes (8 bytes per non-string value plus the UTF-8
    length of strings).

    The check is one aggregate over the dimension (partial sums per task, no
    row leaves its task). Beyond the bound the join stays a shuffle join (AQE may still switch it at run
    time from measured sizes, and splits skewed partitions).
    """
    strings = [f.name for f in small.schema.fields if f.dataType.typeName() == "string"]
    fixed = 8 * (len(small.schema.fields) - len(strings))
    size = F.lit(fixed)
    for c in strings:
        size = size + F.coalesce(F.octet_length(c), F.lit(0))
    probe = small.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("b")
    ).first()
    if probe.n <= max_rows and probe.b <= max_bytes:
        return F.broadcast(small), True
    return small, False


def enrich(
    events: DataFrame,
    dim_item: DataFrame,
    broadcast_max_rows: int | None = config.DEFAULT_SCALE.broadcast_max_rows,
    dedupe: bool = True,
) -> DataFrame:
    """JOIN-1 stream-static / batch left join with null fill.

    ``events`` may be a streaming frame; ``dim_item`` must be static with
    columns dim_item_id, category, dim_content_len.
    """
    dim = dedupe_dimension(dim_item) if dedupe else dim_item
    is_bc = False
    if broadcast_max_rows is not None:
        dim, is_bc = bounded_broadcast(dim, broadcast_max_rows)
    # A matched dimension row renames its category to avoid a clash with
    # an event column of the same name.
    dim = dim.select(
        "dim_item_id",
        F.col("category").alias("dim_category"),
        "dim_content_len",
    )
    if is_bc:
        joined = events.join(dim, events["item_id"] == dim["dim_item_id"], "left")
    else:
        # Shuffle join: events without an item would all hash to one
        # partition. They get a salted key instead and can never match.
        # Deterministic (a retried task must shuffle rows the same way).
        salted_by = [c for c in ("event_id", "user_id", "ts") if c in events.columns]
        salt = -1 - F.pmod(F.xxhash64(*(salted_by or events.columns)), F.lit(NULL_KEY_SALTS))
        salt = salt.cast(events.schema["item_id"].dataType)
        jk = F.coalesce(events["item_id"], salt).alias("_join_key")
        keyed = events.select("*", jk)
        joined = keyed.join(
            dim,
            (keyed["_join_key"] == dim["dim_item_id"]) & keyed["item_id"].isNotNull(),
            "left",
        )
        events = keyed
    cols = []
    for c in [c for c in events.columns if c != "_join_key"]:
        if c == "content_len":
            cols.append(
                F.coalesce(F.col("dim_content_len"), F.lit(config.UNKNOWN_CONTENT_LEN))
                .cast("int").alias("content_len")
            )
        elif c != "category":
            cols.append(events[c])
    if "content_len" not in events.columns:
        cols.append(
            F.coalesce(F.col("dim_content_len"), F.lit(config.UNKNOWN_CONTENT_LEN))
            .cast("int").alias("content_len")
        )
    cols.append(
        F.coalesce(F.col("dim_category"), F.lit(config.UNKNOWN_CATEGORY)).alias("category")
    )
    return joined.select(*cols)
