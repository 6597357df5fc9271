"""Streaming detectors with keyed state (CEP-1, CEP-2, STR-1, STR-5).

``applyInPandasWithState`` with an event-time timeout. The rule's key
(user+item for A1, user for A2) is hashed into key groups, a few per
shuffle partition; a group's state holds only the look-back of its keys (60 s of
comments for A1, 5 s of likes for A2), values older than the watermark
minus the look-back are dropped, and an idle group is evicted 30 minutes
of event time after its latest event. Within a micro-batch a key's rows are
processed in (time, event_id) order; across micro-batches, in arrival
order - so late rows are judged against what was held, and flags already
emitted stand (append mode). ``operators.cheat`` is the batch truth.

The state machines implement the full A1 rule (gap clause, 60 s window
clause, duplicate-text clause), which matter once rows arrive out of
order.
"""

from __future__ import annotations

import bisect
from collections import Counter, deque
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pulsehouse import config
from pulsehouse.session import ship_package

_TIMEOUT_MS = 30 * 60 * 1000

# State of one key group, as parallel arrays: the held comments of every
# (user, item) in the group (A1), the held likes of every user (A2).
A1_STATE = "users array<bigint>, items array<bigint>, t_ms array<bigint>, texts array<string>"
A2_STATE = "users array<bigint>, t_ms array<bigint>, items array<bigint>"

# Key groups per shuffle partition: the state is keyed by a hash of the rule's
# key into groups, so a micro-batch makes a bounded number of pandas round
# trips however many users are active, and more partitions mean more groups.
GROUPS_PER_PARTITION = 8


def key_groups_for(spark) -> int:
    return GROUPS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))


def _evict_after(state: GroupState, latest_t: int) -> None:
    """Evict the key 30 minutes of event time after its latest event (and
    never before the watermark). The look-back is 60 s (A1) or 5 s (A2),
    so an evicted key could not have influenced a later row."""
    state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs(), int(latest_t)) + _TIMEOUT_MS)


class _Held:
    """Held (time, value) pairs in time order with a count per value.

    Rows of a key mostly arrive in time order: appending and dropping the
    oldest are O(1). A late row is inserted at its place, so pruning by
    time stays exact for any arrival order.
    """

    __slots__ = ("items", "counts")

    def __init__(self, pairs=()):
        self.items: deque = deque(sorted(pairs, key=lambda p: p[0]))
        self.counts: Counter = Counter(v for _, v in self.items)

    def prune(self, threshold: int) -> None:
        items, counts = self.items, self.counts
        while items and items[0][0] < threshold:
            _, v = items.popleft()
            counts[v] -= 1
            if not counts[v]:
                del counts[v]

    def add(self, t: int, v) -> None:
        items = self.items
        if not items or items[-1][0] <= t:
            items.append((t, v))
        else:
            lst = list(items)
            bisect.insort_right(lst, (t, v), key=lambda p: p[0])
            self.items = deque(lst)
        self.counts[v] += 1

    def __len__(self) -> int:
        return len(self.items)


def _out_schema(event_id_type: str, flag: str) -> str:
    return (
        f"event_id {event_id_type}, user_id bigint, item_id bigint, event_type string, "
        f"ts timestamp, {flag} boolean"
    )


def a1_is_cheat(
    held,
    min_comments: int = config.A1_MIN_COMMENTS,
    max_gap_ms: int = config.A1_MAX_GAP_MS,
    window_ms: int = config.A1_WINDOW_MS,
    dup_text: int = config.A1_DUP_TEXT,
) -> bool:
    """The A1 test on the held (time, text) comments (a ``_Held`` or any
    list of pairs)."""
    if not isinstance(held, _Held):
        held = _Held(held)
    n = len(held)
    if n < min_comments:
        return False
    items = held.items
    for k in range(n - min_comments + 1, n):
        if items[k][0] - items[k - 1][0] > max_gap_ms:
            return False
    latest = items[-1][0]
    outside = 0
    while items[outside][0] < latest - window_ms:
        outside += 1
    if n - outside >= min_comments:
        return True
    return max(held.counts.values()) >= dup_text


def _ordered(pdfs: Iterator[pd.DataFrame]) -> pd.DataFrame:
    """The key's rows of this micro-batch in (t_ms, event_id) order. The
    trigger size (maxOffsetsPerTrigger / maxFilesPerTrigger) bounds it."""
    pdf = pd.concat(list(pdfs), ignore_index=True)
    return pdf.sort_values(["t_ms", "event_id"], kind="stable")


def _shift(a: np.ndarray, k: int, fill) -> np.ndarray:
    """``a`` moved k places later (position j holds a[j - k])."""
    out = np.empty_like(a)
    out[:k] = fill
    out[k:] = a[:-k] if k else a
    return out


class A1Held(NamedTuple):
    """Held comments of a key group, per (user, item) in time order."""

    users: np.ndarray
    items: np.ndarray
    t: np.ndarray
    texts: np.ndarray

    @staticmethod
    def of(users=(), items=(), t=(), texts=()) -> A1Held:
        text = np.empty(len(texts), object)
        text[:] = list(texts)
        return A1Held(np.array(users, np.int64), np.array(items, np.int64),
                      np.array(t, np.int64), text)


class A2Held(NamedTuple):
    """Held likes of a key group, per user in time order."""

    users: np.ndarray
    t: np.ndarray
    items: np.ndarray

    @staticmethod
    def of(users=(), t=(), items=()) -> A2Held:
        return A2Held(*(np.array(x, np.int64) for x in (users, t, items)))


def _group_ids(*keys: np.ndarray) -> np.ndarray:
    """Dense number of each row's key."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


def _late_rows(gid: np.ndarray, m: int, held_t: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Rows (m held, then new) whose key gets a row older than what it holds;
    only these keys need the state machine row by row."""
    n_groups = int(gid.max()) + 1 if len(gid) else 0
    last = np.full(n_groups, np.iinfo(np.int64).min)
    first = np.full(n_groups, np.iinfo(np.int64).max)
    np.maximum.at(last, gid[:m], held_t)
    np.minimum.at(first, gid[m:], t)
    return (first < last)[gid]


def a1_batch(pdf: pd.DataFrame, held: A1Held, min_comments: int, max_gap_ms: int,
             window_ms: int, dup_text: int) -> tuple[np.ndarray, A1Held]:
    """A1 for one key group's rows of a micro-batch in (time, event_id) order:
    (flag per row, what is held after it).

    Where a key's rows come at or after its held comments the state machine
    equals the batch rule on held rows + new rows - a comment is flagged when
    it and the N-1 rows before it in its key are comments with gaps <= G,
    spanning <= W - and all such keys are done at once. Keys with an older
    row go through the state machine, alone.
    """
    m, n = len(held.t), len(pdf)
    U = np.concatenate([held.users, pdf["user_id"].to_numpy(np.int64)])
    I = np.concatenate([held.items, pdf["item_id"].to_numpy(np.int64)])
    T = np.concatenate([held.t, pdf["t_ms"].to_numpy(np.int64)])
    C = np.concatenate([np.ones(m, bool), (pdf["event_type"] == "comment").to_numpy()])
    X = np.concatenate([held.texts, pdf["comment_text"].to_numpy(object)])
    gid = _group_ids(U, I)
    late = _late_rows(gid, m, held.t, T[m:])
    flags = np.zeros(n, bool)
    at = np.flatnonzero(~late)
    at = at[np.argsort(gid[at], kind="stable")]  # per key: held, then new, in order
    g, t, c = gid[at], T[at], C[at]
    N = min_comments
    flag = c.copy()
    for k in range(1, N):
        flag &= (_shift(g, k, -1) == g) & _shift(c, k, False)
    gaps = t - _shift(t, 1, 0)
    for k in range(0, N - 1):
        flag &= _shift(gaps, k, 0) <= max_gap_ms
    flag &= (t - _shift(t, N - 1, 0)) <= window_ms
    is_new = at >= m
    flags[at[is_new] - m] = flag[is_new]
    # Held on: a key's comments after its last other event, no older than W
    # before its last row.
    i = np.arange(len(at))
    end = np.flatnonzero(np.append(g[1:] != g[:-1], True)) if len(at) else i
    mine = np.searchsorted(end, i)
    other = np.maximum.accumulate(np.where(c, -1, i)) if len(at) else i
    stay = c & (i > other[end][mine]) & (t >= t[end][mine] - window_ms)
    rows = [(U[at[stay]], I[at[stay]], T[at[stay]], X[at[stay]])]
    if late.any():
        old: dict[tuple, list] = {}
        for j in np.flatnonzero(late[:m]):
            old.setdefault((int(U[j]), int(I[j])), []).append((int(T[j]), X[j]))
        new = np.flatnonzero(late[m:])
        f, after = _a1_loop(pdf.iloc[new], {k: _Held(v) for k, v in old.items()},
                            dict(min_comments=min_comments, max_gap_ms=max_gap_ms,
                                 window_ms=window_ms, dup_text=dup_text))
        flags[new] = f
        flat = [(u, it, ht, hx) for (u, it), h in after.items() for ht, hx in h.items]
        rows.append(A1Held.of(*zip(*flat, strict=True)) if flat else A1Held.of())
    texts = np.concatenate([r[3] for r in rows])
    texts[np.array([not isinstance(x, str) for x in texts], bool)] = ""
    return flags, A1Held(*(np.concatenate([r[k] for r in rows]) for k in range(3)), texts)


def a2_batch(pdf: pd.DataFrame, held: A2Held, window_ms: int, min_items: int
             ) -> tuple[np.ndarray, A2Held]:
    """A2 for one key group's likes of a micro-batch in (time, event_id)
    order: (flag per row, what is held after it). Users whose likes come at
    or after their held ones are done at once with the boundary running sum
    of ``operators.cheat.flag_a2``; the others alone, row by row."""
    W, m, n = window_ms, len(held.t), len(pdf)
    U = np.concatenate([held.users, pdf["user_id"].to_numpy(np.int64)])
    T = np.concatenate([held.t, pdf["t_ms"].to_numpy(np.int64)])
    IT = np.concatenate([held.items, pdf["item_id"].to_numpy(np.int64)])
    gid = _group_ids(U)
    late = _late_rows(gid, m, held.t, T[m:])
    keep = np.zeros(n, bool)
    at = np.flatnonzero(~late)
    at = at[np.argsort(gid[at], kind="stable")]
    g, t, item, pos = gid[at], T[at], IT[at], np.arange(len(at))
    # Previous like of the same (user, item), in processing order.
    by_item = np.lexsort((pos, item, g))
    same = (_shift(g[by_item], 1, -1) == g[by_item]) & (_shift(item[by_item], 1, -1) == item[by_item])
    same[:1] = False
    prev = np.empty_like(t)
    prev[by_item] = np.where(same, _shift(t[by_item], 1, -1), np.iinfo(np.int64).min // 2)
    delayed = prev + W + 1 > t
    start = np.where(delayed, prev + W + 1, t)
    contrib = start <= t + W
    q = at >= m
    # Points: (user, time, band, position, kind, delta).
    nq, nc = int(q.sum()), int(contrib.sum())
    pu = np.concatenate([g[q], g[contrib], g[contrib]])
    pt = np.concatenate([t[q], start[contrib], t[contrib] + W])
    band = np.concatenate([np.ones(nq, np.int64), np.where(delayed[contrib], 0, 1),
                           np.full(nc, 2, np.int64)])
    pp = np.concatenate([pos[q], pos[contrib], pos[contrib]])
    kind = np.concatenate([np.ones(nq, np.int64), np.zeros(2 * nc, np.int64)])
    delta = np.concatenate([np.zeros(nq, np.int64), np.ones(nc, np.int64), -np.ones(nc, np.int64)])
    row = np.concatenate([at[q] - m, np.full(2 * nc, -1, np.int64)])
    o = np.lexsort((kind, pp, band, pt, pu))
    pu, kind, row, run = pu[o], kind[o], row[o], np.cumsum(delta[o])
    first = np.append(True, pu[1:] != pu[:-1])[:len(pu)]
    base = np.maximum.accumulate(np.where(first, np.arange(len(pu)), 0)) if len(pu) else pu
    count = run - np.where(base > 0, run[base - 1], 0)
    keep[row[kind == 1]] = count[kind == 1] >= min_items
    end = np.flatnonzero(np.append(g[1:] != g[:-1], True)) if len(at) else pos
    stay = t >= t[end][np.searchsorted(end, pos)] - W
    rows = [(U[at[stay]], T[at[stay]], IT[at[stay]])]
    if late.any():
        old: dict[int, list] = {}
        for j in np.flatnonzero(late[:m]):
            old.setdefault(int(U[j]), []).append((int(T[j]), int(IT[j])))
        new = np.flatnonzero(late[m:])
        f, after = _a2_loop(pdf.iloc[new], {u: _Held(v) for u, v in old.items()}, W, min_items)
        keep[new] = f
        flat = [(u, ht, hi) for u, h in after.items() for ht, hi in h.items]
        rows.append(A2Held.of(*zip(*flat, strict=True)) if flat else A2Held.of())
    return keep, A2Held(*(np.concatenate([r[k] for r in rows]) for k in range(3)))


def _fresh(held, watermark_ms: int, look_back_ms: int):
    """Every later row of the group has a time >= the watermark (older rows
    are dropped as late), so held values older than watermark - look-back
    can no longer matter."""
    mask = held.t >= watermark_ms - look_back_ms
    return type(held)(*(x[mask] for x in held))


def _a1_fn(params: dict):
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held = A1Held.of(*state.get) if state.exists else A1Held.of()
        pdf = _ordered(pdfs)
        flags, held = a1_batch(pdf, held, **params)
        held = _fresh(held, state.getCurrentWatermarkMs(), params["window_ms"])
        state.update(tuple(x.tolist() for x in held))
        _evict_after(state, max(int(pdf["t_ms"].max()), *held.t.tolist(), 0))
        out = pdf[["event_id", "user_id", "item_id", "event_type", "ts"]].copy()
        out["is_cheat_a1"] = flags
        yield out

    return fn


def _a1_loop(pdf: pd.DataFrame, held: dict, params: dict):
    """The literal A1 state machine, row by row (out-of-order batches)."""
    window_ms = params["window_ms"]
    flags = []
    for u, item, et, t, text in zip(pdf["user_id"], pdf["item_id"], pdf["event_type"],
                                    pdf["t_ms"], pdf["comment_text"]):
        k, t = (int(u), int(item)), int(t)
        if et == "comment":
            h = held.get(k)
            if h is None:
                h = held[k] = _Held()
            h.prune(t - window_ms)
            h.add(t, text if isinstance(text, str) else "")
            flags.append(a1_is_cheat(h, **params))
        else:
            held.pop(k, None)
            flags.append(False)
    return np.array(flags, dtype=bool), held


def _a2_fn(window_ms: int, min_items: int):
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held = A2Held.of(*state.get) if state.exists else A2Held.of()
        pdf = _ordered(pdfs)
        pdf = pdf[pdf["event_type"] == "like"]
        keep, held = a2_batch(pdf, held, window_ms, min_items)
        held = _fresh(held, state.getCurrentWatermarkMs(), window_ms)
        state.update(tuple(x.tolist() for x in held))
        latest = [*held.t.tolist(), *([int(pdf["t_ms"].max())] if len(pdf) else [])]
        _evict_after(state, max([state.getCurrentWatermarkMs(), *latest]))
        out = pdf.loc[keep, ["event_id", "user_id", "item_id", "event_type", "ts"]].copy()
        out["is_cheat_a2"] = True
        yield out

    return fn


def _a2_loop(pdf: pd.DataFrame, held: dict, window_ms: int, min_items: int):
    """The literal A2 state machine, row by row (out-of-order batches)."""
    keep = []
    for u, t, item in zip(pdf["user_id"], pdf["t_ms"], pdf["item_id"]):
        u, t = int(u), int(t)
        h = held.get(u)
        if h is None:
            h = held[u] = _Held()
        h.prune(t - window_ms)
        h.add(t, int(item))
        keep.append(len(h.counts) >= min_items)
    return np.array(keep, dtype=bool), held


def _prepared(events: DataFrame, watermark: str) -> DataFrame:
    # Watermark first, then PRJ-1; rows without time are skipped.
    return (
        events.withWatermark("ts", watermark)
        .where(F.col("item_id").isNotNull() & F.col("user_id").isNotNull() & F.col("ts").isNotNull())
    )


def stream_a1(
    events: DataFrame,
    min_comments: int = config.A1_MIN_COMMENTS,
    max_gap_ms: int = config.A1_MAX_GAP_MS,
    window_ms: int = config.A1_WINDOW_MS,
    dup_text: int = config.A1_DUP_TEXT,
    watermark: str = config.DETECTOR_WATERMARK,
    key_groups: int | None = None,
) -> DataFrame:
    """CEP-1 on a stream of events (event_id, user_id, item_id,
    event_type, ts, comment_text). Emits every keyed event with its flag.

    The rule is per (user, item); the state key is a hash of (user, item)
    into ``key_groups`` groups (by default a few per shuffle partition), each
    holding the comments of its pairs. A hot user's items spread over the
    groups. A started query keeps its number of groups: a restart with
    another one would look for the state in other groups.
    """
    params = dict(min_comments=min_comments, max_gap_ms=max_gap_ms,
                  window_ms=window_ms, dup_text=dup_text)
    ship_package(events.sparkSession)
    key_groups = key_groups or key_groups_for(events.sparkSession)
    e = _prepared(events, watermark).select(
        "event_id", "user_id", "item_id", "event_type", "ts", "comment_text",
        F.unix_millis("ts").alias("t_ms"),
        F.pmod(F.xxhash64("user_id", "item_id"), F.lit(key_groups)).alias("key_group"),
    )
    eid = e.schema["event_id"].dataType.simpleString()
    return e.groupBy("key_group").applyInPandasWithState(
        _a1_fn(params),
        outputStructType=_out_schema(eid, "is_cheat_a1"),
        stateStructType=A1_STATE,
        outputMode="append",
        timeoutConf=GroupStateTimeout.EventTimeTimeout,
    )


def stream_a2(
    events: DataFrame,
    window_ms: int = config.A2_WINDOW_MS,
    min_items: int = config.A2_MIN_ITEMS,
    watermark: str = config.DETECTOR_WATERMARK,
    key_groups: int | None = None,
) -> DataFrame:
    """CEP-2 on a stream: emits only the flagged likes. State key: a hash
    of user_id into ``key_groups`` groups."""
    ship_package(events.sparkSession)
    key_groups = key_groups or key_groups_for(events.sparkSession)
    e = _prepared(events, watermark).where(F.col("event_type") == "like").select(
        "event_id", "user_id", "item_id", "event_type", "ts",
        F.unix_millis("ts").alias("t_ms"),
        F.pmod(F.xxhash64("user_id"), F.lit(key_groups)).alias("key_group"),
    )
    eid = e.schema["event_id"].dataType.simpleString()
    return e.groupBy("key_group").applyInPandasWithState(
        _a2_fn(window_ms, min_items),
        outputStructType=_out_schema(eid, "is_cheat_a2"),
        stateStructType=A2_STATE,
        outputMode="append",
        timeoutConf=GroupStateTimeout.EventTimeTimeout,
    )
