"""Operator 7: benchmark decontamination by a prefix-filtered set join, with
DataFrame and SQL functions only.

A window (``size`` consecutive words of an item) is a set of word shingles
with positions. A document contains the window exactly when it holds all of
its shingles in place, so by the prefix principle one token of the window is
enough to find it: its rarest shingle, counted over all documents. Steps:

1. hash the shingles of every document, keep those of the benchmark (a join
   with the benchmark's tokens), with their positions;
2. order each window's shingles by how often step 1 met them and join the
   rarest with the kept positions;
3. the position of the shingle inside the window fixes where the window
   would start; bounds on position and length drop what cannot fit;
4. verify the window's words against the document's words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsehouse.llm.common import keep

WINDOW = 10
SHINGLE = 5
# Tokens (two longs each) up to which the benchmark side is broadcast (about
# 64 MB as a hashed relation); a larger benchmark is a shuffle join.
BROADCAST_TOKENS = 1_000_000
# Bytes of candidates up to which they are broadcast to the texts; beyond, texts
# are shuffled to meet them.
BROADCAST_BYTES = 64 << 20
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(low, F.lit(WORD), F.lit(0))


def once(value: Column) -> Column:
    """``value`` behind a one-row generator: the optimiser would otherwise
    inline it into the lambdas below and compute it for every element."""
    return F.explode(F.array(value))


def _shingles(width: int) -> str:
    """SQL: hashes of the ``width``-word shingles of the array ``words``."""
    at = ", ".join(f"words[i + {j}]" for j in range(width))
    return (f"CASE WHEN size(words) >= {width} THEN transform(sequence(0, size(words) - {width}), "
            f"i -> xxhash64({width}, {at})) ELSE array() END")


def windows(bench: DataFrame, size: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """item_id (null for items without an id), win (words joined by a space),
    len, and per shingle of the window: width, offset, token."""
    w = (bench.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("w"))
         .filter("size(w) > 0").distinct()
         .select("item_id", "w", F.explode(F.expr(
             f"sequence(0, greatest(0, size(w) - {size}))")).alias("at"))
         .select("item_id", F.expr(f"slice(w, at + 1, {size})").alias("words"))
         .distinct())  # also keeps the slice out of the lambdas below
    w = w.select("item_id", F.concat_ws(" ", "words").alias("win"), F.size("words").alias("len"),
                 F.least(F.size("words"), F.lit(shingle)).alias("width"), "words")
    hashes = F.expr("CASE width " + " ".join(
        f"WHEN {k} THEN {_shingles(k)}" for k in range(1, shingle + 1)) + " END")
    return w.select("item_id", "win", "len", "width", F.posexplode(hashes).alias("offset", "token"))


def _candidates(docs: DataFrame, wins: DataFrame) -> DataFrame:
    """key -> cands: the (start, len, win) that the prefix tokens allow."""
    distinct = wins.select("win", "len", "width", "offset", "token").distinct()
    tokens = distinct.select("token").distinct()
    n_tokens = tokens.count()
    widths = [r.width for r in distinct.select("width").distinct().orderBy("width").collect()]
    if not widths:
        widths = [SHINGLE]
    if n_tokens <= BROADCAST_TOKENS:
        tokens = F.broadcast(tokens)
    text = docs.select("key", once(words(F.col("text"))).alias("words"))
    parts = [text.select("key", F.size("words").alias("n"), F.expr(_shingles(k)).alias("hs"))
             for k in widths]
    found = None
    for p in parts:
        m = (p.select("key", "n", F.posexplode("hs").alias("pos", "token"))
             .join(tokens, "token", "left_semi"))
        found = m if found is None else found.unionByName(m)
    found = keep(found)
    counts = found.groupBy("token").agg(F.count("*").alias("c"))
    ranked = distinct.join(counts, "token")
    # a window with a shingle that no document has cannot occur
    rarest = (ranked.groupBy("win", "len")
              .agg(F.min(F.struct("c", "token", "offset")).alias("r"),
                   F.count("*").alias("met"), F.first("width").alias("width"))
              .filter("met = len - width + 1")
              .select("win", "len", "r.token", "r.offset"))
    return (found.join(rarest, "token")
            .withColumn("start", F.expr("pos - offset"))
            .filter("start >= 0 AND start + len <= n")
            .groupBy("key").agg(F.collect_set(F.struct("start", "len", "win")).alias("cands")))


def _verified(docs: DataFrame, bench: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """(docs with key, words and hits: the occurrences (start, len, win), and
    the windows of the benchmark)."""
    wins = keep(windows(bench, size))
    docs = docs.withColumn("key", F.xxhash64("doc_id", "text"))
    cands = keep(_candidates(docs.select("key", "text"), wins))
    size = cands.agg(F.sum(F.expr(
        "48L + aggregate(cands, 0L, (s, c) -> s + 24L + octet_length(c.win))"))).first()[0] or 0
    rows = docs.join(F.broadcast(cands) if size <= BROADCAST_BYTES else cands, "key", "left")
    rows = rows.withColumn("words", once(F.when(F.col("cands").isNotNull(), words(F.col("text")))))
    return rows.withColumn("hits", F.expr(
        "filter(cands, c -> concat_ws(' ', slice(words, c.start + 1, c.len)) = c.win)")), wins


def contamination(docs: DataFrame, bench: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, n_hit (words
    inside any occurrence of a window), n_items, items_sha256, contaminated.

    ``bench`` has item_id and text. An item of fewer than ``size`` words, but
    not none, is one window. Null or empty texts have no words. Windows of
    items without an id count as hits, but there is no id to list, so they are
    in neither n_items nor items_sha256; the same item given twice counts once.
    Repeated documents get equal rows; empty tables give no rows or no hits.
    Other columns are ignored.
    """
    rows, wins = _verified(docs.select("doc_id", "text"), bench, size)
    rows = keep(rows.select(
        "doc_id", "key",
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(ANY_CASE)).cast("long").alias("n_words"),
        F.expr("coalesce(size(array_distinct(flatten(transform(hits, "
               "h -> sequence(h.start, h.start + h.len - 1))))), 0)").cast("long").alias("n_hit"),
        F.expr("array_distinct(transform(hits, h -> h.win))").alias("found")))
    items = (rows.filter("size(found) > 0").select("key", F.explode("found").alias("win")).distinct()
             .join(wins.filter("item_id IS NOT NULL").select("win", "item_id").distinct(), "win")
             .groupBy("key").agg(F.array_sort(F.collect_set("item_id")).alias("items")))
    return (rows.join(items, "key", "left")
            .select("doc_id", "n_words", "n_hit",
                    F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                    F.sha2(F.coalesce(F.concat_ws(",", "items"), F.lit("")), 256)
                    .alias("items_sha256"),
                    (F.col("n_hit") > 0).alias("contaminated")))


def drop_contaminated(docs: DataFrame, bench: DataFrame, size: int = WINDOW) -> DataFrame:
    """Pipeline form: the rows of ``docs`` without any hit, all columns."""
    rows, _ = _verified(docs, bench, size)
    return rows.filter("cands IS NULL OR size(hits) = 0").select(docs.columns)
