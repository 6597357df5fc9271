"""Every named query of the library equals its SQL in DuckDB on the small
tables. The optional training-data operators have their own tests."""

import math

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from pulsehouse.plans.catalog import QUERIES
from pulsehouse.streaming.catalog import STREAM_QUERIES
from tests.conftest import SF_SMALL

CORE = {**QUERIES, **STREAM_QUERIES}


def _canon(pdf):
    cols = sorted(pdf.columns)

    def norm(v):
        if v is None:
            return None
        if hasattr(v, "item"):
            v = v.item()
        if isinstance(v, float) and math.isnan(v):
            return None
        return v

    rows = [tuple(norm(r[c]) for c in cols) for r in pdf.to_dict("records")]
    return cols, sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_every_query_has_oracle():
    assert set(CORE) <= set(oracle_sql()) <= set(queries())


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["window_start", "window_end", "category", "pv"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(CORE))
def test_query_matches_duckdb(spark, duck, name):
    got = CORE[name](spark, SF_SMALL).toPandas()
    want = duck.execute(oracle_sql()[name]).df()
    gc, gr = _canon(got)
    wc, wr = _canon(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr
