"""Operator 10: exact Jaccard join of documents on five-word shingles by a
size-aware heavy-light scheme.

All tokens (shingle hashes) have one global order: tokens counted as frequent
come last, by count, the others by hash. A set of n tokens that reaches the
threshold with another shares at least ceil(0.75 n) tokens with it, hence at
least one of its first n - ceil(0.75 n) + 1 tokens, and at least two of its
first n - ceil(0.75 n) + 2.

* Small (light) sets enumerate all two-token subsets of the longer prefix;
  two small sets are compared only where such a subset agrees.
* Large (heavy) sets scan the inverted lists of their prefix tokens. Small
  sets near the boundary are listed there too, to be met by large ones.
* The boundary is the size at which the estimated cost (subsets written
  against list entries read) is least.

Groups of copies do not make all pairs: identical sets share one node, and a
first round links each node with the centres of the lists of its sketch
(verified exactly), so that the second round, which is exhaustive, only
compares nodes of different components. There the entries of a list are
grouped by component first: lists (or subsets) met by one component alone
leave before any join, the entries of a component with more than a few in a
list meet the other components of the list group by group, never each other,
and only the rest is joined entry by entry. Copies whose first centre was too
different (say an excerpt) are left in many components; as long as lists hold
far more pairs than entries, each list is first compared with one node of its
own, drawn anew each time, which is linear, and what that links is merged.
Every candidate is verified on the whole texts; those whose signatures (how
many tokens of a set fall into each of some n / 2 buckets) show that they share
too little are dropped before, so that few texts are sent anywhere.

Tokens and nodes are 64-bit hashes; two different sets collide with
probability n^2 / 2^65 (3e-4 for 1e8 distinct sets).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsehouse.llm.common import bounded, keep, map_arrow
from pulsehouse.llm.graph import components
from pulsehouse.llm.textkit import chunks, mix, row_sums, shingle_sets

# Only orders tokens (a cost hint, at most 8 MB to each task): never drops any.
MAX_FREQUENT = 1 << 19
FREQUENT_FROM = 8
SKETCH = 8
SKETCH_MATCH = 3
# Pairs of components per list entry above which lists are compared with a
# centre first, and how often at most (the exhaustive round follows anyway).
PAIRS_PER_ENTRY = 64
STAR_ROUNDS = 4
# Entries of a component in one list above which they are joined as a group.
GROUP_FROM = 8


def _need(n):
    """Least overlap of a set of n tokens with any set it links with."""
    return (3 * n + 3) // 4


def _heads(row: np.ndarray, size: np.ndarray, extra: int = 2) -> np.ndarray:
    """Mask of the first n - need(n) + extra entries of each (sorted) row."""
    first = np.cumsum(size) - size
    rank = np.arange(len(row)) - first[row]
    return rank < (size - _need(size) + extra)[row]


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens that several texts of a batch hold, with how many. Of T batches
    a token of D texts meets itself in about D^2 / 2T, so everything far above
    sqrt(T) texts is found, and rare tokens are not shuffled at all."""
    for b in batches:
        tok = np.concatenate([np.zeros(0, np.uint64), *(
            shingle_sets(data, off)[1] for _, _, data, off in chunks(b.column(0)))])
        tok.sort()  # in place: a batch may hold some million tokens
        first = np.flatnonzero(np.append(True, tok[1:] != tok[:-1])[:len(tok)])
        c = np.diff(np.append(first, len(tok)))
        t, c = tok[first[c > 1]], c[c > 1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(t.view(np.int64)), pa.array(c.astype(np.int64))], ["token", "c"])


def _lists(row: np.ndarray, tok: np.ndarray, mask: np.ndarray, n_rows: int) -> pa.Array:
    count = np.bincount(row[mask], minlength=n_rows)
    offs = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(tok[mask].view(np.int64)))


def _prefix_rows(frequent):
    """doc_id, key, node, n, the prefix tokens in the global order, a sketch
    (least hashes of the set) and how frequent its tokens are on average."""

    def rank(tok: np.ndarray) -> np.ndarray:
        toks, counts = frequent.value
        if not len(toks):
            return np.zeros(len(tok), np.int64)
        at = np.minimum(np.searchsorted(toks, tok), len(toks) - 1)
        return np.where(toks[at] == tok, counts[at], 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, off in chunks(b.column(2)):
                row, tok, size = shingle_sets(data, off)
                node = mix(row_sums(row, mix(tok ^ np.uint64(0x5851F42D4C957F2D)), hi - lo)
                           + size.astype(np.uint64))
                common = rank(tok)
                central = row_sums(row, common, hi - lo) // np.maximum(size, 1)
                order = np.lexsort((tok, common, row))
                first = np.cumsum(size) - size
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo),
                     pa.array(node.view(np.int64), mask=size == 0),
                     pa.array(size.astype(np.int64)), pa.array(central),
                     _lists(row, tok[order], _heads(row, size), hi - lo),
                     _lists(row, tok, np.arange(len(row)) - first[row] < SKETCH, hi - lo)],
                    ["doc_id", "key", "node", "n", "central", "toks", "sketch"])

    return run


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b) of the pairs whose whole texts reach the threshold."""
    for b in batches:
        for lo, hi, data, off in chunks(b.column(2)):
            ra, ta, na = shingle_sets(data, off)
            rb, tb, nb = [], [], np.zeros(hi - lo, np.int64)
            for l2, h2, d2, o2 in chunks(b.column(3).slice(lo, hi - lo)):
                r, t, n = shingle_sets(d2, o2)
                rb.append(r + l2)
                tb.append(t)
                nb[l2:h2] = n
            row = np.concatenate([ra, *rb])
            tok = np.concatenate([ta, *tb])
            order = np.lexsort((tok, row))
            row, tok = row[order], tok[order]
            same = (row[1:] == row[:-1]) & (tok[1:] == tok[:-1])
            inter = np.bincount(row[1:][same], minlength=hi - lo)
            ok = (100 * inter >= 75 * (na + nb - inter)) & (inter > 0)
            yield pa.RecordBatch.from_arrays(
                [b.column(i).slice(lo, hi - lo).filter(pa.array(ok)) for i in (0, 1)], ["u", "v"])


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node and how many tokens of its set fall into each bucket, a byte each;
    null where a byte is too small. There are 2^k buckets, by the first k bits,
    so that bytes of neighbours added up give the signature for k - 1."""
    for b in batches:
        for lo, hi, data, off in chunks(b.column(1)):
            row, tok, size = shingle_sets(data, off)
            k = np.ceil(np.log2(np.maximum(size, 4) / 2)).astype(np.uint64)
            offs = np.concatenate([[0], np.cumsum(1 << k.astype(np.int64))])
            at = offs[row] + (mix(tok) >> (np.uint64(64) - k[row])).astype(np.int64)
            count = np.bincount(at, minlength=offs[-1])
            fits = np.maximum.reduceat(count, offs[:-1]) < 256 if hi > lo else np.zeros(0, bool)
            data = pa.py_buffer(np.minimum(count, 255).astype(np.uint8))
            sig = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), hi - lo, [None, pa.py_buffer(offs.astype(np.int64)), data])
            sig = pc.if_else(pa.array(fits), sig, pa.scalar(None, pa.large_binary()))
            yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), sig.cast(pa.binary())],
                                             ["node", "sig"])


def _can_link(a: bytes | None, b: bytes | None) -> bool:
    """Whether sets with these signatures may reach the threshold: they share
    at most the lesser count of each bucket."""
    if a is None or b is None:
        return True
    x, y = (np.frombuffer(s, np.uint8).astype(np.int64) for s in (a, b))
    m = min(len(x), len(y))
    x, y = x.reshape(m, -1).sum(axis=1), y.reshape(m, -1).sum(axis=1)
    return 175 * np.minimum(x, y).sum() >= 75 * (x.sum() + y.sum())


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b) of the pairs whose signatures allow the threshold."""
    for batch in batches:
        sa, sb = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        ok = pa.array([_can_link(x, y) for x, y in zip(sa, sb, strict=True)], pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(i).filter(ok) for i in (0, 1)], ["a", "b"])


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).unionByName(
        pairs.select(F.col("b").alias("node"))).distinct()


def _beside(pairs: DataFrame, rows: DataFrame, what: str) -> DataFrame:
    """``pairs`` with column ``what`` of both nodes (``rows``: node, what),
    joined on b first, so that what is compared with one a travels together."""
    xa = rows.select(F.col("node").alias("a"), F.col(what).alias("xa"))
    xb = rows.select(F.col("node").alias("b"), F.col(what).alias("xb"))
    return pairs.select("a", "b").join(xb, "b").join(xa, "a").select("a", "b", "xa", "xb")


def _verify(pairs: DataFrame, sets: DataFrame, docs: DataFrame, repeated: bool) -> DataFrame:
    """Edges (u, v) among candidate ``pairs`` (a, b), decided on whole texts:
    one document of each candidate node is fetched; the pairs that signatures
    do not rule out get both texts joined. ``repeated``: some rows are equal in
    id and text."""
    reps = keep(sets.join(_ends(pairs), "node", "left_semi").groupBy("node")
                .agg(F.min("key").alias("key")))

    def texts(reps: DataFrame) -> DataFrame:
        got = docs.join(bounded(reps), "key").select("key", "node", "text")
        return got.dropDuplicates(["key"]) if repeated else got

    signed = keep(map_arrow(texts(reps).select("node", "text"), _signatures, "node long, sig binary"))
    pairs = keep(map_arrow(_beside(pairs, signed, "sig"), _possible, "a long, b long"))
    left = keep(reps.join(_ends(pairs), "node", "left_semi"))
    return map_arrow(_beside(pairs, texts(left), "text"), _linked, "u long, v long")


def _boundary(sets: DataFrame) -> tuple[int, int]:
    """(size up to which enumerating two-token subsets costs less than being
    listed, largest size): sizes (in buckets, at most some 60 rows) against
    list entries."""
    h = (sets.filter("n > 0")
         .select("n", F.size("toks").alias("p"), F.floor(F.log2("n") * 4).alias("bucket"))
         .groupBy("bucket").agg(F.max("n").alias("n"), F.count("*").alias("docs"),
                                F.avg("p").alias("p")).orderBy("bucket").collect())
    best, at, light = None, 0, 0.0
    heavy = sum(r.docs * r.p for r in h)
    scan = 4.0  # a list entry is compared with a few others; a subset rarely is
    for r in h:
        light += r.docs * r.p * (r.p - 1) / 2
        heavy -= r.docs * r.p
        cost = light + scan * heavy
        if best is None or cost < best:
            best, at = cost, r.n
    return (int(at), int(h[-1].n)) if best is not None else (0, 0)


def _entries(info: DataFrame, light_to: int, largest: int) -> DataFrame:
    """key, heavy, i and all but toks of ``info``: the two-token subsets of sets up to the
    boundary, and the prefix tokens (the i-th) of those that a set over the
    boundary can reach."""
    rest = [c for c in info.columns if c != "toks"]
    one = (info.filter((F.col("n") <= light_to) & (F.col("n") > 1))
           .select(*rest, "toks", F.posexplode("toks").alias("j", "t1")))
    out = one.select(*rest, "t1", F.explode(F.expr("slice(toks, j + 2, size(toks))")).alias(
        "t2")).select(F.xxhash64("t1", "t2").alias("key"), F.lit(False).alias("heavy"), *rest,
                      F.lit(0).alias("i"))
    if largest <= light_to:
        return out
    p = (F.col("n") - F.ceil(F.col("n") * 0.75) + 1).cast("int")
    return out.unionByName(
        info.filter(F.col("n") * 4 > 3 * light_to)
        .select(*rest, F.lit(True).alias("heavy"),
                F.posexplode(F.slice("toks", F.lit(1), p)).alias("i", "key")))


def _with_comp(rows: DataFrame, comps: DataFrame) -> DataFrame:
    """``rows`` (node, ...) with ``comp``; a node that is linked with none so
    far is a component of its own."""
    return rows.join(comps.select("node", "root"), "node", "left").withColumn(
        "comp", F.coalesce("root", "node")).drop("root")


def _shared(entries: DataFrame) -> DataFrame:
    """The ``entries`` whose key several components have. They are sent once:
    most keys are met once, so that counting them first would send about as
    much again."""
    of_key = Window.partitionBy("key")
    return keep(entries.withColumns({"lo": F.min("comp").over(of_key), "hi": F.max("comp").over(of_key)})
                .filter("lo < hi").drop("lo", "hi"))


_SIZES = "4 * least(x.n, y.n) >= 3 * greatest(x.n, y.n)"


def _too_many(entries: DataFrame) -> bool:
    """Whether the lists hold more pairs of components than PAIRS_PER_ENTRY
    times their entries."""
    per_key = entries.groupBy("key", "comp").agg(F.count("*").alias("c")).groupBy("key").agg(
        F.count("*").cast("double").alias("k"), F.sum("c").alias("c"))
    got = per_key.agg(F.sum(F.expr("k * (k - 1) / 2")).alias("pairs"), F.sum("c").alias("c")).first()
    return bool(got.c) and got.pairs > PAIRS_PER_ENTRY * got.c


def _star_pairs(entries: DataFrame, r: int) -> DataFrame:
    """(a, b): each entry with one node of its list, the same for all lists
    that hold it."""
    hubs = entries.groupBy("key").agg(
        F.max(F.struct(F.xxhash64("node", F.lit(r)).alias("u"), "node", "n", "comp")).alias("x"))
    met = entries.select("key", F.struct("node", "n", "comp").alias("y")).join(hubs, "key")
    return met.filter(f"x.comp <> y.comp AND {_SIZES}").select(
        F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def _met(pairs: DataFrame, light_to: int) -> DataFrame:
    """(a, b) of met entries (heavy, x, y: node, n, i) that can reach the
    threshold."""
    light = pairs.filter("NOT heavy").select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    heavy = pairs.filter("heavy").select(
        F.col("x.node").alias("a"), F.col("y.node").alias("b"), F.col("x.n").alias("na"),
        F.col("y.n").alias("nb"), F.col("x.i").alias("ia"), F.col("y.i").alias("ib")).groupBy(
        "a", "b", "na", "nb").agg(F.count("*").alias("c"), F.max("ia").alias("ia"),
                                  F.max("ib").alias("ib"))
    # What follows the last of these tokens bounds the overlap.
    heavy = heavy.filter("c + least(na - ia, nb - ib) - 1 >= int((3 * (na + nb) + 6) / 7)"
                         ).select("a", "b")
    return light.unionByName(heavy).distinct()


def _across(entries: DataFrame, light_to: int, group_from: int = GROUP_FROM) -> DataFrame:
    """(a, b) of entries with equal key and different components that can reach
    the threshold; a is of the smaller component.

    The entries of a component that has more than ``group_from`` in a list meet
    the entries of small ones directly, and those of other such components
    through pairs of components; so they never meet each other."""
    groups = entries.groupBy("key", "heavy", "comp").agg(F.count("*").alias("c"))
    large = keep(groups.filter(F.col("c") > group_from).drop("c"))
    need = "int((3 * (x.n + y.n) + 6) / 7)"
    # With more than n - need tokens before it on either side, a token is not
    # the first that a pair reaching the threshold has in common.
    fits = (f"x.key = y.key AND x.heavy = y.heavy AND {_SIZES} "
            f"AND (NOT x.heavy OR (greatest(x.n, y.n) > {light_to} "
            f"AND x.i <= x.n - {need} AND y.i <= y.n - {need}))")

    def meet(one: DataFrame, two: DataFrame, more: str) -> DataFrame:
        x, y = one.alias("x"), two.alias("y")
        first = F.col("x.comp") < F.col("y.comp")
        a, b = (F.struct(f"{t}.node", f"{t}.n", f"{t}.i") for t in "xy")
        return x.join(y, F.expr(f"{fits} AND {more}")).select(
            "x.heavy", F.when(first, a).otherwise(b).alias("x"), F.when(first, b).otherwise(a).alias("y"))

    if large.isEmpty():
        return _met(meet(entries, entries, "x.comp < y.comp"), light_to)
    name = ["key", "heavy", "comp"]
    mark = bounded(large)
    few = entries.join(mark, name, "left_anti")
    many = keep(entries.join(mark, name, "left_semi"))
    g, h = large.alias("g"), large.alias("h")
    both = g.join(h, F.expr("g.key = h.key AND g.heavy = h.heavy AND g.comp < h.comp")).select(
        "g.key", "g.heavy", "g.comp", F.col("h.comp").alias("other"))
    met = meet(few, few, "x.comp < y.comp").unionByName(meet(many, few, "true"))
    if not both.isEmpty():
        met = met.unionByName(meet(many.join(both, name), many, "x.other = y.comp"))
    return _met(met, light_to)


def near_links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sets, comps): sets has doc_id, key (hash of id and text), node and n
    (null node for a text without words) per row of ``docs``; comps has
    (node, root) of every node linked with another."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text")
    counts = (map_arrow(docs.select("text"), _repeats, "token long, c long")
              .groupBy("token").agg(F.sum("c").alias("c"))
              .filter(F.col("c") >= FREQUENT_FROM)
              .orderBy(F.desc("c"), "token").limit(MAX_FREQUENT).toArrow())
    tok = counts.column("token").to_numpy().view(np.uint64)
    order = np.argsort(tok)
    frequent = spark.sparkContext.broadcast(
        (tok[order], counts.column("c").to_numpy()[order]))
    sets = keep(map_arrow(docs, _prefix_rows(frequent),
                          "doc_id long, key long, node long, n long, central long, "
                          "toks array<long>, sketch array<long>"))
    full = sets.filter("n > 0")

    # Round 1: stars over sketches, linear in the rows. The centre of a star
    # is the node whose tokens are the most frequent on average: of a group
    # of edited copies, the one closest to what they have in common.
    copies = full.groupBy("node").agg(F.min("key").alias("one"), F.count("*").alias("c"))
    copies = bounded(keep(copies.filter("c > 1").select("node", "one")))
    full = full.join(copies, "node", "left").filter("one IS NULL OR one = key").drop("one")
    repeated = full.groupBy("node").count().filter("count > 1").limit(1).count() > 0
    if repeated:
        full = full.dropDuplicates(["node"])
    sk = full.select("node", "n", "central", F.explode("sketch").alias("token"))
    hubs = (sk.groupBy("token").agg(F.max(F.struct("central", "node")).alias("hub"),
                                    F.min("node").alias("least"), F.max("node").alias("most"))
            .filter("least < most").select("token", F.col("hub.node").alias("a")))
    star = (sk.join(hubs, "token").filter("node <> a").groupBy("a", F.col("node").alias("b"))
            .agg(F.count("*").alias("c"), F.max("n").alias("n")))
    star = star.filter(F.col("c") >= F.least(F.lit(SKETCH_MATCH), F.ceil(F.col("n") / 4)))
    first = keep(_verify(keep(star), sets, docs, repeated))
    found = keep(components(first))

    # Round 2: every remaining pair, but only across components.
    light_to, largest = _boundary(full)
    info = full.select("node", F.col("n").cast("int").alias("n"), "toks")
    edges, comps = first, found
    entries = _shared(_entries(_with_comp(info, bounded(comps)), light_to, largest))
    for r in range(STAR_ROUNDS):
        if not _too_many(entries):
            break
        new = keep(_verify(keep(_star_pairs(entries, r)), sets, docs, repeated))
        if new.isEmpty():
            break
        edges = keep(edges.unionByName(new))
        comps = keep(components(edges))
        entries = _shared(_with_comp(entries.drop("comp"), bounded(comps)))
    more = keep(_across(entries, light_to))
    if not more.isEmpty():
        edges = edges.unionByName(_verify(more, sets, docs, repeated))
        comps = components(edges)
    return sets.select("doc_id", "key", "node", "n"), comps


def jaccard_components(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles,
    component_id (smallest doc_id reachable by links of Jaccard >= 0.75).

    Texts that are null or without words have n_shingles 0 and are their own
    component; texts of under five words are one shingle. Rows with equal
    sets share a component whatever their ids, also for repeated ids. A null
    doc_id takes part; a component of null ids only has a null id. Other
    columns are ignored; no rows give no rows.
    """
    sets, comps = near_links(docs.select("doc_id", "text"))
    rows = sets.join(comps, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = (rows.filter("root IS NOT NULL").groupBy("root")
           .agg(F.min("doc_id").alias("least")))
    return rows.join(ids, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """Pipeline form: one document of each component stays (the smallest
    doc_id, then the smallest hash of its text), with all columns; of rows
    equal in id and text one stays. Texts without words are kept."""
    sets, comps = near_links(docs.select("doc_id", "text"))
    rows = sets.join(comps, "node", "left").withColumn("root", F.coalesce("root", "node"))
    chosen = (rows.filter("root IS NOT NULL").groupBy("root")
              .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("c"))
              .select(F.col("c.key").alias("__key")))
    chosen = chosen.unionByName(rows.filter("root IS NULL")
                                .select(F.col("key").alias("__key")).distinct())
    one = docs.withColumn("__key", F.xxhash64("doc_id", "text")).join(chosen, "__key", "left_semi")
    return one.dropDuplicates(["__key"]).select(docs.columns)
