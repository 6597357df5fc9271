"""Operator 13: prefix trie of conversations in double arrays.

A node is a distinct sequence of first turns (role, text); its members are the
conversations that start with it. Steps:

1. turns are numbered per conversation in blocks of turn numbers, so one long
   conversation is not one task; from here on a turn is two hashes and a
   length, no text travels;
2. conversations are rebuilt row by row; a prefix is identified by its depth
   and by the xor of position-tagged turn hashes (2 x 64 bits), which needs no
   order to be summed up;
3. sequences are cut into segments of at most SEGMENT turns, and segments are
   dealt to shards by their prefix; a prefix with more turns than a shard
   should hold is dealt to several. Each shard packs its segments into one
   double-array trie (BASE, CHECK) over dense ids of its turns, walks the
   segments through it, and gives one row per node it met;
4. nodes that several shards met (the upper ones, and those of split
   prefixes) are merged by a global aggregation;
5. subtree sums: the smallest member of a node is never larger than that of a
   node below, so the nodes of one smallest member are a stretch of its path.
   Sums go along these paths (blocks of depths), and between the paths by
   pointer doubling: rounds grow with the logarithm of the nesting, not with
   the depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsehouse.llm.common import bounded, keep, map_arrow, running_totals
from pulsehouse.session import ship_package

SEGMENT = 64
SHARD_TURNS = 20_000
BLOCK = 4096
# Hash of the empty list of ids.
NO_IDS = hashlib.sha256(b"").hexdigest()
_NODE = ["depth", "p1", "p2"]


class DoubleArray:
    """A forest in two arrays: the child of node s by symbol c is the slot
    BASE[s] + c if CHECK there is s. Roots are the first slots."""

    FREE = -1

    def __init__(self, roots: int):
        self.base = np.zeros(max(roots, 16), np.int64)
        self.check = np.full(max(roots, 16), self.FREE, np.int64)
        self.check[:roots] = -2
        self.low = roots  # no free slot below

    def _grow(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.append(self.base, np.zeros(more, np.int64))
            self.check = np.append(self.check, np.full(more, self.FREE))

    def _first_fit(self, offsets: np.ndarray) -> int:
        """The first slot from which all offsets (the first is 0) are free."""
        at = self.low
        while True:
            self._grow(at + 1024 + int(offsets[-1]) + 1)
            cand = np.arange(at, at + 1024)
            for o in offsets.tolist():
                cand = cand[self.check[cand + o] == self.FREE]
                if not len(cand):
                    break
            if len(cand):
                return int(cand[0])
            at += 1024

    def add(self, parent: np.ndarray, symbol: np.ndarray) -> None:
        """Packs the children (distinct pairs, sorted) of nodes without any:
        families by first fit, single children into the slots left free."""
        first = np.flatnonzero(np.append(True, parent[1:] != parent[:-1])[:len(parent)])
        count = np.diff(np.append(first, len(parent)))
        for a, n in zip(first[count > 1].tolist(), count[count > 1].tolist(), strict=True):
            c = symbol[a:a + n]
            base = self._first_fit(c - c[0]) - c[0]
            self.base[parent[a]] = base
            self.check[base + c] = parent[a]
        one = first[count == 1]
        if len(one):
            free = np.flatnonzero(self.check[self.low:] == self.FREE)
            if len(free) < len(one):
                self._grow(len(self.check) + len(one) - len(free))
                free = np.flatnonzero(self.check[self.low:] == self.FREE)
            slot = free[:len(one)] + self.low
            self.base[parent[one]] = slot - symbol[one]
            self.check[slot] = parent[one]
        taken = np.flatnonzero(self.check[self.low:] == self.FREE)
        self.low += int(taken[0]) if len(taken) else len(self.check) - self.low

    def step(self, node: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The children, -1 where there is none."""
        at = self.base[node] + symbol
        inside = (at >= 0) & (at < len(self.check))
        at = np.where(inside, at, 0)
        return np.where(inside & (self.check[at] == node), at, -1)


def _dense(*cols: np.ndarray) -> np.ndarray:
    """Ids 0, 1, ... of the distinct rows, in their order."""
    order = np.lexsort(cols[::-1])
    new = np.zeros(len(order), bool)
    for c in cols:
        new[1:] |= c[order][1:] != c[order][:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def walk_forest(root: np.ndarray, unit: np.ndarray, place: np.ndarray, turn: np.ndarray
                ) -> tuple[DoubleArray, np.ndarray]:
    """(double array, node of each turn) of sequences ``unit`` below their
    roots (dense ids); ``turn``: dense ids of the turns, by unit and place."""
    trie = DoubleArray(int(root.max(initial=-1)) + 1)
    node, state = np.empty(len(turn), np.int64), root.copy()
    by_place = np.argsort(place, kind="stable")
    ends = np.searchsorted(place[by_place], np.arange(int(place.max(initial=-1)) + 2))
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        at = by_place[a:b]
        u, c = unit[at], turn[at]
        order = np.lexsort((c, state[u]))
        p, s = state[u][order], c[order]
        new = np.append(True, (p[1:] != p[:-1]) | (s[1:] != s[:-1]))[:len(p)]
        trie.add(p[new], s[new])
        state[u] = node[at] = trie.step(state[u], c)
    return trie, node


_SHARD_OUT = ("depth long, p1 long, p2 long, q1 long, q2 long, chars long, n long, conv long")
_SHARD_NAMES = [f.split()[0] for f in _SHARD_OUT.split(", ")]


def _shard_nodes(table: pa.Table) -> pa.Table:
    """One row per node that the segments of a shard meet: depth, hash of the
    prefix and of its parent, code points of its last text, how many
    conversations pass, and the smallest of them."""
    table = table.combine_chunks()
    lists = table.column("turns").combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0)
    size = np.diff(lists.offsets.to_numpy())
    turns = lists.flatten()
    get = lambda k: turns.field(k).to_numpy(zero_copy_only=False)
    conv, s1, s2, first = (table.column(c).to_numpy() for c in ("conv_id", "s1", "s2", "first"))
    unit = np.repeat(np.arange(len(size)), size)
    start = np.cumsum(size) - size
    place = np.arange(len(unit)) - start[unit]
    root = _dense(first, s1, s2)
    turn = _dense(get("k1"), get("k2"))
    # number turns in the order in which the tries meet them: brothers lie close
    before = np.append(-1, turn[:-1])
    before[start] = -1
    order = np.lexsort((turn, before, root[unit], place))
    met, at = np.unique(turn[order], return_index=True)
    number = np.empty(len(met), np.int64)
    number[np.argsort(at)] = np.arange(len(met))
    _, node = walk_forest(root, unit, place, number[turn])

    def prefix(g: np.ndarray, s: np.ndarray) -> np.ndarray:
        total = np.bitwise_xor.accumulate(g)
        return total ^ (np.append(0, total)[start] ^ s)[unit]

    g1, g2 = get("g1"), get("g2")
    p1, p2 = prefix(g1, s1), prefix(g2, s2)
    order = np.argsort(node, kind="stable")
    edge = np.flatnonzero(np.append(True, np.diff(node[order]) != 0))
    one = order[edge]
    out = [get("pos")[one] + 1, p1[one], p2[one], (p1 ^ g1)[one], (p2 ^ g2)[one], get("chars")[one],
           np.diff(np.append(edge, len(order))), np.minimum.reduceat(conv[unit][order], edge)]
    return pa.table([pa.array(x, pa.int64()) for x in out], names=_SHARD_NAMES)


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, i (place by turn, null first), k1, k2, chars per turn."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.xxhash64(F.lit(1), role, text).alias("k1"), F.xxhash64(F.lit(2), text, role).alias("k2"),
        F.length(text).cast("long").alias("chars"))
    rows = rows.withColumn("__block", F.coalesce(
        F.floor(F.col("turn") / BLOCK).cast("long"), F.lit(-(1 << 62))))
    return running_totals(rows, ["conv_id"], "__block", [F.col("turn").asc_nulls_first(), "k1", "k2"],
                          F.lit(1), "i").select("conv_id", "i", "k1", "k2", "chars")


def rebuilt(conversations: DataFrame, shared: bool = True) -> tuple[DataFrame, DataFrame]:
    """(turns: conv_id, pos, k1, k2, chars, g1, g2; convs: conv_id, size).

    With ``shared`` every conversation c is rebuilt: the first h turns of
    conversation c - c % 100, then its own after the first h, where h =
    crc32(c as decimal) % 6; otherwise conversations stay as they are.
    """
    turns = keep(ordered_turns(conversations))
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(6))
    convs = convs.withColumn("h", h if shared else F.lit(0).cast("long"))
    # the heads: at most five turns of every hundredth conversation
    heads = (turns.filter("conv_id % 100 = 0 AND i < 5").groupBy(F.col("conv_id").alias("base"))
             .agg(F.sort_array(F.collect_list(F.struct("i", "k1", "k2", "chars"))).alias("head")))
    convs = (convs.withColumn("base", F.expr("conv_id - conv_id % 100")).join(heads, "base", "left")
             .withColumn("head", F.expr("CASE WHEN head IS NULL OR h = 0 THEN array() "
                                        "ELSE slice(head, 1, CAST(h AS INT)) END")))
    convs = keep(convs.withColumn("m", F.size("head").cast("long")).withColumn(
        "size", F.col("m") + F.greatest(F.lit(0), F.col("own") - F.col("h"))))
    taken = convs.filter("m > 0").select("conv_id", F.explode("head").alias("x")).select(
        "conv_id", F.col("x.i").alias("pos"), "x.k1", "x.k2", "x.chars")
    own = (turns.join(convs.select("conv_id", "h", "m"), "conv_id").filter("i >= h")
           .select("conv_id", F.expr("m + i - h").alias("pos"), "k1", "k2", "chars"))
    rows = taken.unionByName(own)
    rows = rows.withColumn("g1", F.xxhash64("pos", "k1", "k2")).withColumn(
        "g2", F.xxhash64("k2", "k1", "pos"))
    return keep(rows), convs.select("conv_id", "size")


def local_nodes(turns: DataFrame, shard_turns: int = SHARD_TURNS, segment: int = SEGMENT) -> DataFrame:
    """The nodes each shard meets (several rows for a node met by several)."""
    ship_package(turns.sparkSession)
    segs = (turns.groupBy("conv_id", F.floor(F.col("pos") / segment).alias("seg"))
            .agg(F.sort_array(F.collect_list(F.struct("pos", "k1", "k2", "chars", "g1", "g2")))
                 .alias("turns"),
                 F.bit_xor("g1").alias("x1"), F.bit_xor("g2").alias("x2")))
    before = Window.partitionBy("conv_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    segs = segs.select("conv_id", (F.col("seg") * segment).alias("first"), "turns",
                       F.coalesce(F.bit_xor("x1").over(before), F.lit(0)).alias("s1"),
                       F.coalesce(F.bit_xor("x2").over(before), F.lit(0)).alias("s2"))
    # a shard is named by the prefix: where the segment hangs and its first turn
    segs = keep(segs.withColumn("prefix", F.xxhash64("first", "s1", "s2", F.expr("turns[0].k1"))))
    load = keep(segs.groupBy("prefix").agg(F.sum(F.size("turns")).alias("load")))
    shards = max(1, -(-int(load.agg(F.sum("load")).first()[0] or 0) // shard_turns))
    # at most one such prefix for each shard's worth of turns
    heavy = load.filter(F.col("load") > shard_turns).select(
        "prefix", F.ceil(F.col("load") / shard_turns).alias("parts"))
    segs = segs.join(bounded(heavy), "prefix", "left").withColumn("shard", F.pmod(F.xxhash64(
        "prefix", F.pmod(F.xxhash64("conv_id"), F.coalesce("parts", F.lit(1)))), F.lit(shards)))
    return (segs.select("shard", "conv_id", "first", "s1", "s2", "turns").groupBy("shard")
            .applyInArrow(_shard_nodes, _SHARD_OUT))


def _with_parent_owner(tops: DataFrame, nodes: DataFrame, least: int) -> DataFrame:
    """``tops`` (conv, pd, q1, q2) with ``up``, the conv of the node (pd, q1,
    q2). Children of the root need no lookup; nodes with a thousandth of the
    tops below them are at most a thousand and are broadcast."""
    key = ["pd", "q1", "q2"]
    owner = nodes.select(F.col("depth").alias("pd"), F.col("p1").alias("q1"),
                         F.col("p2").alias("q2"), F.col("conv").alias("up"))
    flat = tops.filter("pd = 0").withColumn("up", F.lit(least).cast("long"))
    deep = tops.filter("pd > 0")
    hot = deep.groupBy(*key).count().filter(F.col("count") > max(100, deep.count() // 1000))
    hot = F.broadcast(keep(owner.join(F.broadcast(hot.select(*key)), key)))
    deep = deep.join(hot.withColumnRenamed("up", "hot"), key, "left")
    found = deep.filter("hot IS NOT NULL").withColumnRenamed("hot", "up")
    rest = deep.filter("hot IS NULL").drop("hot").join(owner, key)
    return flat.unionByName(found.select(flat.columns)).unionByName(rest.select(flat.columns))


def _path_totals(paths: DataFrame) -> DataFrame:
    """``paths`` (conv, up, leaves, saved): the sums over a path and all paths
    below it, by pointer doubling: after round k a path holds those less
    than 2^k paths below."""
    cur = keep(paths.select("conv", "up", "leaves", "saved"))
    while not cur.filter("up IS NOT NULL").isEmpty():
        gain = (cur.filter("up IS NOT NULL").groupBy(F.col("up").alias("conv"))
                .agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s")))
        above = cur.filter("up IS NOT NULL").select(F.col("conv").alias("up"), F.col("up").alias("upper"))
        cur = keep(cur.join(gain, "conv", "left").join(bounded(above), "up", "left").select(
            "conv", F.col("upper").alias("up"),
            (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved")))
    return cur.select("conv", F.col("leaves").alias("t_leaves"), F.col("saved").alias("t_saved"))


def _from_depth(nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """Sums of leaves and saved over the nodes of the same conv of this depth
    and deeper, in blocks of depths."""
    nodes = nodes.withColumn("__b", F.floor(F.col("depth") / block))
    sums = nodes.groupBy("conv", "__b").agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
    deeper = Window.partitionBy("conv").orderBy("__b").rowsBetween(1, Window.unboundedFollowing)
    sums = sums.select("conv", "__b", F.coalesce(F.sum("l").over(deeper), F.lit(0)).alias("l"),
                       F.coalesce(F.sum("s").over(deeper), F.lit(0)).alias("s"))
    inner = Window.partitionBy("conv", "__b").orderBy(F.desc("depth")).rowsBetween(
        Window.unboundedPreceding, 0)
    return (nodes.withColumn("leaves", F.sum("leaves").over(inner))
            .withColumn("saved", F.sum("saved").over(inner)).join(sums, ["conv", "__b"])
            .withColumn("leaves", F.col("leaves") + F.col("l"))
            .withColumn("saved", F.col("saved") + F.col("s")).drop("l", "s", "__b"))


def _hash_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash per node of its (sorted) pieces of text: nothing but the
    running hash is held."""
    key, h, out = None, None, []
    names = [*_NODE, "ends_sha256"]
    schema = pa.schema([*[(c, pa.int64()) for c in _NODE], ("ends_sha256", pa.string())])
    for b in batches:
        cols = [b.column(i).to_pylist() for i in range(4)]
        for *k, text in zip(*cols, strict=True):
            if k != key:
                if key is not None:
                    out.append([*key, h.hexdigest()])
                key, h = k, hashlib.sha256()
            else:
                h.update(b",")
            h.update(text.encode())
        yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema)
        out = []
    if key is not None:
        yield pa.RecordBatch.from_pylist(
            [dict(zip(names, [*key, h.hexdigest()], strict=True))], schema)


def _ends(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Hash of the ids of the conversations that end at each node. Ids are
    joined in pieces of 65,536 numbers at most; only the hash over a node's
    pieces, which is sequential by nature, is one stream."""
    ends = turns.groupBy("conv_id").agg(F.count("*").alias("depth"), F.bit_xor("g1").alias("p1"),
                                        F.bit_xor("g2").alias("p2"))
    zero = F.lit(0).cast("long")
    ends = ends.unionByName(convs.filter("size = 0").select(
        "conv_id", *[zero.alias(c) for c in _NODE]))
    pieces = (ends.groupBy(*_NODE, F.shiftright("conv_id", 16).alias("piece"))
              .agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
              .withColumn("ids", F.concat_ws(",", F.col("ids").cast("array<string>"))))
    pieces = pieces.repartition(*_NODE).sortWithinPartitions(*_NODE, "piece")
    return map_arrow(pieces.select(*_NODE, "ids"), _hash_lists,
                     "depth long, p1 long, p2 long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, shared: bool = True, shard_turns: int = SHARD_TURNS,
                segment: int = SEGMENT, block: int = BLOCK) -> DataFrame:
    """Per node of the trie of ``conversations`` (conv_id, turn, role, text):
    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    A null role or text is empty. Turns go by number, null first; equal
    numbers of a conversation by hash, so repeated rows are repeated turns.
    Rows without a conv_id belong to no conversation. With ``shared``
    conversations are rebuilt (see ``rebuilt``), which may leave one without
    turns: it is a member of the root. Other columns are ignored; no
    conversations give no rows, not even a root.
    """
    turns, convs = rebuilt(conversations, shared)
    total = convs.agg(F.min("conv_id"), F.count("*")).first()
    least = 0 if total[0] is None else int(total[0])
    nodes = local_nodes(turns, shard_turns, segment).groupBy(*_NODE).agg(
        F.min("q1").alias("q1"), F.min("q2").alias("q2"), F.min("chars").alias("chars"),
        F.sum("n").alias("n"), F.min("conv").alias("conv"))
    null = F.lit(None).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv"), F.count("*").alias("n")).filter("n > 0").select(
        *[F.lit(0).cast("long").alias(c) for c in _NODE], null.alias("q1"), null.alias("q2"),
        F.lit(0).cast("long").alias("chars"), "n", "conv")
    nodes = keep(nodes.unionByName(root))

    # the nodes of one smallest member are the stretch top..bottom of its path
    paths = nodes.groupBy("conv").agg(F.min(F.struct("depth", "q1", "q2")).alias("t"),
                                      F.max("depth").alias("bottom"))
    paths = keep(paths.select("conv", (F.col("t.depth") - 1).alias("pd"), "t.q1", "t.q2", "bottom"))
    tops = keep(_with_parent_owner(paths.filter("pd >= 0").drop("bottom"), nodes, least))
    hanging = tops.groupBy(F.col("pd").alias("depth"), F.col("q1").alias("p1"),
                           F.col("q2").alias("p2")).agg(F.count("*").alias("more"))
    nodes = nodes.join(hanging, _NODE, "left").join(
        paths.select("conv", F.col("pd").alias("above"), "bottom"), "conv")
    nodes = nodes.withColumn("n_children", F.coalesce("more", F.lit(0))
                             + F.when(F.col("depth") < F.col("bottom"), 1).otherwise(0))
    nodes = keep(nodes.select(
        *_NODE, "conv", "n", "n_children", (F.col("depth") == F.col("above") + 1).alias("is_top"),
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"),
        ((F.col("n") - 1) * F.col("chars")).alias("saved")))

    alone = nodes.groupBy("conv").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    totals = _path_totals(alone.join(tops.select("conv", "up"), "conv", "left"))
    below = (tops.join(totals, "conv").groupBy(F.col("pd").alias("depth"), F.col("q1").alias("p1"),
                                               F.col("q2").alias("p2"))
             .agg(F.sum("t_leaves").alias("tl"), F.sum("t_saved").alias("ts")))
    nodes = (nodes.join(below, _NODE, "left")
             .withColumn("leaves", F.col("leaves") + F.coalesce("tl", F.lit(0)))
             .withColumn("saved", F.col("saved") + F.coalesce("ts", F.lit(0))).drop("tl", "ts"))
    nodes = _from_depth(nodes, block)
    nodes = nodes.join(tops.select("conv", "up"), "conv", "left")
    nodes = nodes.join(_ends(turns, convs), _NODE, "left")
    parent = F.when(F.col("is_top"), F.col("up")).otherwise(F.col("conv"))
    return nodes.select(F.col("conv").alias("conv_id"), "depth", parent.alias("parent_conv_id"),
                        F.col("n").alias("n_convs"), F.col("n_children").cast("long").alias("n_children"),
                        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                        F.coalesce("ends_sha256", F.lit(NO_IDS)).alias("ends_sha256"))
