"""The corpus pipeline stage by stage against plain versions on a small
table, each stage on all that its predecessor kept."""

from __future__ import annotations

import collections
import zlib

import brute
import corpus_pipeline as P
import pytest
from pyspark.sql import functions as F

from pulsehouse.llm import language_id, mixing
from pulsehouse.llm.common import file_order
from pulsehouse.session import new_run_dir

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def kept(spark):
    """Input and output rows of each stage, through Parquet as the driver does."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    base, out = new_run_dir(spark, "test_pipeline"), {}
    for i, (name, stage) in enumerate(P.STAGES):
        path = f"{base}/{i}"
        stage(spark, docs, SF).write.parquet(path)
        result = spark.read.parquet(path)
        out[name] = (docs, result)
        docs = result
    return out


def test_stages(kept):
    assert [n for n, _ in P.STAGES] == ["language_id", "jaccard_join", "decontamination",
                                        "source_mixing", "sharding"]
    for name, (_, after) in kept.items():
        assert after.columns[:5] == COLUMNS
        assert (after.columns == COLUMNS) == (name != "sharding")


def test_language_stage(kept):
    before, after = kept["language_id"]
    want = language_id.identify(before).filter("NOT rejected").select("doc_id")
    assert sorted(after.select("doc_id").collect()) == sorted(want.collect())
    assert after.count() >= 0.98 * before.count()


def test_jaccard_stage(kept):
    before, after = kept["jaccard_join"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    comps = brute.components(rows)
    assert sorted(r.doc_id for r in after.collect()) == sorted({c for _, c in comps})


def test_decontamination_stage(spark, kept):
    before, after = kept["decontamination"]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = sorted(r.doc_id for r in before.collect() if not brute.contamination(r.text, bench)[4])
    assert sorted(r.doc_id for r in after.collect()) == want


def test_mixing_stage(kept):
    before, after = kept["source_mixing"]
    rows = {r.doc_id: r for r in before.collect()}
    words = {i: len(brute.WORD.findall(r.text or "")) for i, r in rows.items()}
    size, longest, got = (collections.Counter() for _ in range(3))
    for i, r in rows.items():
        size[r.source] += words[i]
        longest[r.source] = max(longest[r.source], words[i])
    times = collections.Counter()
    for r in after.collect():
        assert tuple(r) == tuple(rows[r.doc_id])
        times[r.doc_id] += 1
        got[r.source] += words[r.doc_id]
    assert max(times.values()) <= 3
    for s, t in brute.targets(dict(size)).items():
        assert abs(got[s] - t) <= longest[s] / 2 + 1


def test_sharding_stage(kept):
    before, after = kept["sharding"]
    rows = after.collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
        assert r.text_crc32 == zlib.crc32(r.text.encode())
    counts = [len(by.get(s, [])) for s in range(40)]
    assert max(counts) - min(counts) <= 1 and len(rows) == before.count()
    assert all(sorted(x) == list(range(len(x))) for x in by.values())
    assert before.exceptAll(after.select(*COLUMNS)).count() == 0


def test_files_of_the_mix_stand_in_training_order(kept):
    before, after = kept["source_mixing"]
    want = [r.doc_id for r in mixing.positioned_documents(before)
            .orderBy("__position", "__key").select("doc_id").collect()]
    assert after.rdd.getNumPartitions() >= 1
    assert [r.doc_id for r in file_order(after).orderBy("__place").select("doc_id").collect()] == want


def test_slots_keep_the_training_order(kept):
    before, after = kept["sharding"]
    place, line = collections.defaultdict(collections.deque), collections.defaultdict(list)
    for i, r in enumerate(file_order(before).orderBy("__place").select("doc_id").collect()):
        place[r.doc_id].append(i)
    for r in after.orderBy("shard", "slot").select("doc_id", "shard").collect():
        line[r.shard].append(r.doc_id)
    assert len(line) == 40
    for docs in line.values():
        at = -1
        for i in docs:  # some row of this document comes later in training
            at = next(x for x in place[i] if x > at)
    assert file_order(before.sparkSession.range(3)) is None


def test_run(spark, kept):
    assert P.run(spark, SF).count() == kept["sharding"][1].count()


def test_stages_take_odd_documents(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0),
            (2, "one two three four five six", "en", "a", 5), (None, "x" * 9000, "xx", "b", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                       "n_chars long").withColumn("shard", F.lit("mine"))
    for start in (docs, docs.limit(0)):
        cur = start
        for name, stage in P.STAGES:
            out = stage(spark, cur, SF)
            if name != "sharding":
                assert out.columns == docs.columns
                assert {tuple(r) for r in out.collect()} <= {tuple(r) for r in docs.collect()}
            else:
                assert out.count() == cur.count()
