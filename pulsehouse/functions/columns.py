"""Column expressions: time keys, safe ratios and behaviour tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsehouse import config


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_key(ts: str | Column = "ts") -> Column:
    """Calendar day ``yyyyMMdd`` in the session time zone."""
    return F.date_format(_c(ts), "yyyyMMdd")


def epoch_ms(ts: str | Column = "ts") -> Column:
    return F.unix_millis(_c(ts))


def window_bounds(win: str | Column = "window") -> list[Column]:
    """``window`` struct -> window_start / window_end in epoch seconds
    (the key format of the serving store)."""
    w = _c(win)
    return [
        F.unix_seconds(w.getField("start")).alias("window_start"),
        F.unix_seconds(w.getField("end")).alias("window_end"),
    ]


def stable_round(c: str | Column, digits: int = 6) -> Column:
    """Round a double so that engines agree: first to 9 decimals (absorbs
    summation-order noise and binary representation), then half-up."""
    return F.round(_c(c).cast("decimal(38,9)"), digits).cast("double")


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den, NULL when den is 0 or NULL."""
    return F.try_divide(_c(num).cast("double"), _c(den))


def is_type(event_type: str) -> Column:
    return F.col("event_type") == F.lit(event_type)


def count_if(cond: Column) -> Column:
    """Rows where ``cond`` is true (NULL counts as false)."""
    return F.count_if(F.coalesce(cond, F.lit(False)))


def is_d1_instant_exit(
    lo: float = config.D1_MIN_SEC, hi: float = config.D1_MAX_SEC
) -> Column:
    """D1: leave_item with lo <= duration <= hi."""
    return is_type("leave_item") & F.col("duration_sec").between(lo, hi)


def is_e1_fast_swipe(
    max_sec: float = config.E1_MAX_SEC, min_len: int = config.E1_MIN_CONTENT_LEN
) -> Column:
    """E1: leave_item with duration < max_sec and content_len > min_len
    (needs the enriched content_len)."""
    return (
        is_type("leave_item")
        & (F.col("duration_sec") < max_sec)
        & (F.col("content_len") > min_len)
    )


def is_c_long_stay(
    lo: float = config.C_MIN_SEC, hi: float = config.C_MAX_SEC
) -> Column:
    """C: leave_item with lo <= duration <= hi."""
    return is_type("leave_item") & F.col("duration_sec").between(lo, hi)


def behaviour_tags() -> list[Column]:
    """PRJ-6: the D1 / E1 / C tags of each event as columns ("tag, do not
    drop"); never NULL. Needs the enriched content_len."""
    tags = {"is_d1": is_d1_instant_exit(), "is_e1": is_e1_fast_swipe(), "is_c": is_c_long_stay()}
    return [F.coalesce(t, F.lit(False)).alias(n) for n, t in tags.items()]
