"""Properties of the event-time bucket + halo split."""

from hypothesis import given, settings
from hypothesis import strategies as st

from pulsehouse.operators.split import BUCKET, HALO, time_split


@settings(max_examples=25, deadline=None)
@given(
    times=st.lists(st.integers(min_value=-10**12, max_value=10**12), min_size=1, max_size=40),
    bucket=st.integers(min_value=1, max_value=10**7),
    halo_frac=st.floats(min_value=0.0, max_value=1.0),
)
def test_time_split_copies(spark, times, bucket, halo_frac):
    halo = int(bucket * halo_frac)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "id bigint, t bigint")
    rows = time_split(df, "t", bucket, halo).select("id", "t", BUCKET, HALO).collect()
    own = {}
    copies = {}
    for r in rows:
        if r[HALO]:
            copies.setdefault(r.id, []).append(r[BUCKET])
        else:
            assert r.id not in own
            own[r.id] = r[BUCKET]
    assert set(own) == set(range(len(times)))
    for i, t in enumerate(times):
        b = t // bucket
        assert own[i] == b
        expect = [b + 1] if t >= (b + 1) * bucket - halo else []
        assert copies.get(i, []) == expect
