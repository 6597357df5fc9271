"""Operator 13 against brute force and its SQL: shards, splits, long and
copied conversations, and the double array itself."""

from __future__ import annotations

import random

import brute
import duckdb
import numpy as np
import pytest

from pulsehouse.llm import conversation_trie as T
from pulsehouse.llm.oracle import ORACLE_SQL
from pulsehouse.llm.queries import op13_conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_query_matches_sql(spark):
    con = duckdb.connect()
    path = "/root/testdata/sf0.01"
    con.execute(f"create view conversations as select * from read_parquet('{path}/conversations.parquet')")
    got = op13_conversation_trie(spark, path)
    rel = con.execute(ORACLE_SQL["op13_conversation_trie"])
    assert got.columns == [c[0] for c in rel.description]
    assert rows_of(got) == sorted(rel.fetchall(), key=repr)


def conversations(seed):
    r = random.Random(seed)
    out = []
    for c in [*range(0, 260), 700, 701, 705, -3, -100, -101]:
        n = r.choice((1, 2, 3, 4, 5, 8, 13, 40))
        for t in range(n):
            out.append((c, t, r.choice(("user", "bot")), r.choice(("a", "bb", "ccc", "é" * 4))))
    copy = [(r.choice(("user", "bot")), "same") for _ in range(30)]
    for c in range(800, 900):  # a third of the rows: one conversation and near copies of it
        for t, (role, text) in enumerate(copy):
            out.append((c, t, role, text if (c, t) != (c, c - 800) else "other"))
    for c in range(1000, 1004):  # longer than a block of turns
        out += [(c, t, "user", "x" * (t % 3)) for t in range(300 + 10 * c % 70)]
    out += [(2000, None, "user", None), (2000, 3, None, ""), (2000, -7, "user", "minus"),
            (None, 0, "user", "no conversation"), (2100, None, None, None)]
    r.shuffle(out)
    return out


@pytest.mark.parametrize("shared", [True, False])
def test_all_nodes(spark, shared):
    rows = conversations(int(shared))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).selectExpr(
        "*", "1 AS n", "2 AS depth", "3 AS conv", "4 AS i")
    got = T.prefix_trie(df, shared, shard_turns=200, segment=16, block=32)
    assert rows_of(got) == brute.trie(rows, shared)


def test_shards_are_bounded(spark):
    rows = [(c, t, "user", f"{t}") for c in range(600) for t in range(8)]
    turns, _ = T.rebuilt(spark.createDataFrame(rows, SCHEMA))
    local = T.local_nodes(turns, shard_turns=400)
    met = local.filter("depth = 1").count()
    assert met >= 4  # one prefix, several shards, merged later
    (root, *_) = [r for r in T.prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect() if r.depth == 0]
    assert (root.n_convs, root.n_children, root.parent_conv_id) == (600, 1, None)


def test_no_conversations(spark):
    df = spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)
    assert T.prefix_trie(df).count() == 0
    assert T.prefix_trie(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_double_array(seed):
    r = np.random.default_rng(seed)
    n = 400
    size = r.integers(1, 9, n)
    unit = np.repeat(np.arange(n), size)
    place = np.arange(len(unit)) - (np.cumsum(size) - size)[unit]
    turn = np.minimum(r.geometric(0.05, len(unit)), 90)
    _, turn = np.unique(turn, return_inverse=True)
    root = np.sort(r.integers(0, 3, n))
    root = np.unique(root, return_inverse=True)[1]
    trie, node = T.walk_forest(root, unit, place, turn)
    want, ids = {}, {}
    for k, (u, p) in enumerate(zip(unit, place, strict=True)):
        key = (root[u], tuple(turn[k - p:k + 1]))
        want.setdefault(key, set()).add(int(node[k]))
        ids.setdefault(int(node[k]), set()).add(key)
    assert all(len(v) == 1 for v in want.values()) and all(len(v) == 1 for v in ids.values())
    used = (trie.check != trie.FREE).sum()
    assert used == len(want) + root.max() + 1
    assert used > 0.5 * (np.flatnonzero(trie.check != trie.FREE).max() + 1)
    assert len(trie.check) <= 4 * used + 4096
    assert (trie.step(np.arange(int(root.max()) + 1), np.full(int(root.max()) + 1, 10**6)) == -1).all()
