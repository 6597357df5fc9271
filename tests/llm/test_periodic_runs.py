"""Operator 11 against brute force: all runs of small random, periodic and
Fibonacci texts, and the query on given documents."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest

from pulsehouse.llm import periodic_runs as R
from pulsehouse.llm.queries import op11_periodic_runs

SF = "/root/testdata/sf0.001"


def found(texts):
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    ids = np.array([hash(x) & 0xFFFFFFFF for t in texts for x in t], np.uint64)
    out = [[] for _ in texts]
    for r, s, n, q in zip(*(x.tolist() for x in R.find_runs(row, ids)), strict=True):
        out[r].append((s, n, q))
    return out


def odd_texts(seed):
    r = random.Random(seed)
    a, b = "a", "ab"
    while len(b) < 150:
        a, b = b, b + a
    thue = "".join("ab"[bin(i).count("1") % 2] for i in range(160))
    texts = ["", "a", "a" * 23, "a" * 24, "a" * 200, b, thue, "ab" * 12, "ab" * 11 + "a",
             "aaaaaab" * 20, ("a" * 30 + "b") * 5, "x" + "abc" * 40 + "y" + "abc" * 40]
    for _ in range(250):
        part = ""
        while len(part) < r.randint(1, 260):
            unit = "".join(r.choice("ab"[: r.randint(1, 2)] + "c" * r.randint(0, 1))
                           for _ in range(r.randint(1, 45)))
            if r.random() < 0.4:  # units that are periodic themselves
                unit = unit[: r.randint(1, 6)] * r.randint(2, 8) + r.choice("abz")
            part += unit * r.choice((1, 1, 2, 3, 4, 7)) + unit[: r.randint(0, len(unit))]
        texts.append(part)
    return [list(t) for t in texts]


@pytest.mark.parametrize("seed", range(4))
def test_all_runs(seed):
    texts = odd_texts(seed)
    assert found(texts) == [brute.periodic_runs(t) for t in texts]


def test_one_long_text():
    r = random.Random(7)
    unit = [str(r.random()) for _ in range(9_000)]
    text = unit * 4 + ["end"] * 50_000 + unit[:10]
    (got,) = found([text])
    assert got == [(0, 36_000, 9_000), (36_000, 50_000, 1)]


def test_no_shorter_runs_can_be_asked_for():
    with pytest.raises(ValueError):
        R.find_runs(np.zeros(0, np.int64), np.zeros(0, np.uint64), min_length=10)


def test_query_on_given_documents(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = [r for r in rows if len(r.text or "") < 3_000]
    assert len(rows) > 100
    want = {r.doc_id: brute.runs_row(r.doc_id, r.text, True) for r in rows}
    got = {r.doc_id: tuple(r) for r in op11_periodic_runs(spark, SF).collect()}
    assert {i: got[i] for i in want} == want
    assert sum(x[1] > 0 for x in want.values()) >= 10


def test_odd_rows(spark):
    text = " ".join(["one", "two", "x"] * 20)
    rows = [(None, text), (None, None), (5, None), (6, ""), (7, " \n\t "), (8, text), (8, text),
            (9, text.replace(" ", "\n\x0b")), (10, "é b " * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS start", "2 AS length", "3 AS n_runs", "4 AS row")
    for plant in (False, True):
        got = sorted((tuple(r) for r in R.periodic_runs(docs, plant).collect()), key=repr)
        assert got == sorted((brute.runs_row(i, t, plant) for i, t in rows), key=repr)
    assert R.periodic_runs(docs.limit(0)).count() == 0
