"""Operator 4: sharding by balanced label propagation.

Documents of equal text are linked through their group (a star, never all
pairs). Every document starts in the shard its hash names. In each round a
group's documents vote with their shards, and the group's members move to the
shard that holds most of them, as far as that shard's quota of linked
documents and what leaves it in the same round allow. Rounds go on until no
group is split, or two of them leave as many split as before; what is split
then joins without a quota. Members of a group in one shard are
interchangeable, so a round joins and moves (group, start shard) rows, not
documents. A group above half a shard's capacity takes part as several. At the
end the shards are filled to exact counts: unlinked documents come last in each
shard and move first, linked ones by group.

The law kept is ``rows``: counts at most one apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsehouse.llm.common import blocks_for, file_order, keep, running_totals, utf8_bytes

SHARDS = 40
_UNIT = float(1 << 53)


def _unit(*cols):
    """Uniform in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 53)) / F.lit(_UNIT)


def _by_shard(rows: DataFrame, col: str, n: int) -> list[int]:
    """Documents per shard (one row per shard reaches the driver)."""
    got = {r[0]: r[1] for r in rows.groupBy(col).agg(F.sum("c")).collect()}
    return [int(got.get(s, 0)) for s in range(n)]


def _longs(values) -> str:
    return "array(" + ", ".join(f"{int(v)}L" for v in values) + ")"


def _shares(flow: dict[tuple[int, int], int], room: list[int]) -> list[float]:
    """Share of the documents that want into each shard, as large as the
    shards' room and what leaves them by the same shares allow."""
    want = [0] * len(room)
    for (_, to), c in flow.items():
        want[to] += c
    share = [1.0] * len(room)
    for _ in range(200):  # falls to the greatest shares that fit
        free = [float(x) for x in room]
        for (cur, to), c in flow.items():
            free[cur] += c * share[to]
        new = [min(1.0, max(0.0, f) / w) if w else 1.0 for f, w in zip(free, want, strict=True)]
        done = max(a - b for a, b in zip(share, new, strict=True)) < 1e-4
        share = new
        if done:
            break
    return share


def propagate(state: DataFrame, n_shards: int, cap: int) -> DataFrame:
    """``state`` (g, sub, start, cur, c): c documents of part ``sub`` of group
    g that started in ``start`` are in shard ``cur``. Returns it with the
    last ``cur``, each part in one shard; a shard may then hold more than
    ``cap``."""
    fewest, stale, r = None, 0, 0
    while True:
        room = [cap - x for x in _by_shard(state, "cur", n_shards)]
        votes = state.groupBy("g", "sub", "cur").agg(F.sum("c").alias("v"))
        # every other round shards that have room come first
        first = F.expr(f"{_longs(room)}[cur]") > 0 if r % 2 else F.lit(True)
        total = votes.groupBy("g", "sub").agg(F.max(F.struct(
            first.alias("first"), "v", _unit("g", "sub", "cur").alias("u"), "cur")).alias("best"))
        wish = state.join(total.select("g", "sub", F.col("best.cur").alias("to")), ["g", "sub"])
        moving = keep(wish.withColumn("moves", F.col("cur") != F.col("to")))
        flow = {(x.cur, x.to): x.n for x in moving.filter("moves").groupBy("cur", "to")
                .agg(F.sum("c").alias("n")).collect()}
        if not flow:
            return state
        split = moving.filter("moves").select("g", "sub").distinct().count()
        stale = 0 if fewest is None or split < fewest else stale + 1
        fewest = split if fewest is None else min(fewest, split)
        if stale == 2:  # the rest joins as well; the exact counts are left to the filling
            return keep(moving.select("g", "sub", "start", F.col("to").alias("cur"), "c"))
        share = "array(" + ", ".join(f"{x!r}D" for x in _shares(flow, room)) + ")"
        # whole groups are let in, in an order that changes with the round
        admitted = F.col("moves") & (_unit("g", "sub", F.lit(r)) < F.expr(f"{share}[to]"))
        state = keep(moving.withColumn("cur", F.when(admitted, F.col("to")).otherwise(F.col("cur")))
                     .select("g", "sub", "start", "cur", "c"))
        r += 1


def ordered_slots(rows: DataFrame) -> DataFrame:
    """``rows`` (shard, __place, __stretch, ...) with the slots of each shard
    dealt anew, in the order of ``__place``."""
    return running_totals(rows.drop("slot"), ["shard"], "__stretch", ["__place"], F.lit(1), "slot")


def shard(docs: DataFrame, n_shards: int = SHARDS, in_order: bool = False) -> DataFrame:
    """All columns of ``docs`` (doc_id, text, ...) plus size (bytes + 16),
    text_crc32, law, shard, slot (gapless from 0 in each shard), grown_shard
    (null under this law). Columns of ``docs`` that have one of these names
    are replaced.

    Shard sizes differ by at most one row. A null text has no bytes, crc 0,
    and is equal to other null texts. Repeated rows are linked like other
    copies. With fewer rows than shards the last shards stay empty; no rows
    give no rows.

    With ``in_order`` the slots of a shard follow the order in which the rows
    were written to the Parquet files ``docs`` is read from (such as training
    order); a table that is not read from files has no order to keep, and
    its slots follow hashes as without it.
    """
    placed_docs = file_order(docs) if in_order else None
    docs = docs if placed_docs is None else placed_docs
    names = [c for c in docs.columns
             if c not in ("size", "text_crc32", "law", "shard", "slot", "grown_shard")]
    base = docs.select(
        *names, (utf8_bytes(F.col("text")) + 16).alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"),
        F.xxhash64("text", F.octet_length("text")).alias("__g"),
        F.xxhash64("doc_id", "text").alias("__h"))
    light = keep(base.select("__g", "__h"))
    n = light.count()
    cap = -(-n // n_shards)
    part = max(1, cap // 2)
    groups = (light.groupBy("__g").agg(F.count("*").alias("__n")).filter("__n > 1")
              .withColumn("__parts", F.ceil(F.col("__n") / part)))
    start = F.pmod(F.xxhash64("__h", F.lit(4)), F.lit(n_shards)).cast("int")
    sub = F.pmod(F.xxhash64("__h", F.lit(5)), F.col("__parts")).cast("int")
    state = (light.join(groups, "__g")
             .groupBy(F.col("__g").alias("g"), sub.alias("sub"), start.alias("start"))
             .agg(F.count("*").alias("c")).withColumn("cur", F.col("start")))
    state = propagate(keep(state), n_shards, cap)
    # one row per group: its parts and where each (part, start) went; at most
    # 2 * n_shards parts of n_shards starts
    moved = state.groupBy("g").agg(F.map_from_entries(F.collect_list(F.struct(
        (F.col("sub") * n_shards + F.col("start")).alias("k"), "cur"))).alias("__to"))
    moved = keep(groups.join(moved, groups["__g"] == moved["g"])
                 .select(F.col("__g").alias("g"), "__n", "__parts", "__to"))

    def placed(rows: DataFrame) -> DataFrame:
        rows = rows.join(moved, rows["__g"] == moved["g"], "left").drop("g")
        rows = rows.withColumn("__shard", F.coalesce(
            F.element_at("__to", (sub * n_shards + start).cast("int")), start))
        # linked documents in [0, 1), spread so that no block holds a large
        # group alone; the others in [1, 2)
        near = F.least(F.lit(0.999999), _unit("__g") * (1 - F.col("__n") / F.lit(max(n, 1)))
                       + _unit("__h") * F.col("__n") / F.lit(max(n, 1)))
        return rows.withColumn("__u", F.when(F.col("__n").isNull(), 1 + _unit("__h")).otherwise(near))

    counts = _by_shard(placed(light).withColumn("c", F.lit(1)), "__shard", n_shards)
    quota = [n // n_shards + (s < n % n_shards) for s in range(n_shards)]
    over = [max(0, c - q) for c, q in zip(counts, quota, strict=True)]
    under = [max(0, q - c) for c, q in zip(counts, quota, strict=True)]
    over_at = [sum(over[:s]) for s in range(n_shards)]
    under_at = [sum(under[:s]) for s in range(n_shards)]
    blocks = blocks_for(cap)
    rows = placed(base).withColumn("__block", F.floor(F.col("__u") * blocks / 2).cast("int"))
    rows = running_totals(rows, ["__shard"], "__block", ["__u", "__h"], F.lit(1), "__rank")
    surplus = F.expr(f"__rank - {_longs(quota)}[__shard]")
    rows = rows.withColumn("__i", F.when(surplus >= 0, surplus + F.expr(
        f"{_longs(over_at)}[__shard]")))
    # the shard whose span of free places holds the surplus document
    spans = ", ".join(f"struct({s} AS s, {a}L AS a, {a + u}L AS b, {c}L AS c)"
                      for s, (a, u, c) in enumerate(zip(under_at, under, counts, strict=True)) if u)
    if spans:
        rows = rows.withColumn("__new", F.when(F.col("__i").isNotNull(), F.expr(
            f"element_at(filter(array({spans}), x -> x.a <= __i AND __i < x.b), 1)")))
        rows = rows.withColumn("shard", F.coalesce("__new.s", "__shard")).withColumn(
            "slot", F.coalesce(F.expr("__new.c + __i - __new.a"), F.col("__rank")))
    else:
        rows = rows.withColumn("shard", F.col("__shard")).withColumn("slot", F.col("__rank"))
    if placed_docs is not None:
        rows = ordered_slots(rows)
        names = [c for c in names if c not in ("__place", "__stretch")]
    return rows.select(*names, "size", "text_crc32", F.lit("rows").alias("law"),
                       F.col("shard").cast("int").alias("shard"),
                       F.col("slot").cast("long").alias("slot"),
                       F.lit(None).cast("int").alias("grown_shard"))
