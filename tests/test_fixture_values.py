"""Expected values of the adapted tables at sf0.001 (FIXTURES.md §3)."""

from pyspark.sql import functions as F

from pulsehouse.functions import is_c_long_stay, is_d1_instant_exit, is_e1_fast_swipe
from pulsehouse.operators import cheat
from pulsehouse.operators.enrich import enrich
from pulsehouse.sources import adapters as A
from tests.conftest import SF_SMALL


def test_community_events_shape(spark):
    com = A.community_events(spark, SF_SMALL)
    r = com.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("session_id").alias("s"),
        F.count_distinct("user_id").alias("u"),
    ).first()
    assert (r.n, r.s, r.u) == (1000, 397, 15)
    counts = {x.event_type: x["count"] for x in com.groupBy("event_type").count().collect()}
    assert counts == {
        "app_open": 82, "enter_item": 188, "leave_item": 201, "like": 65, "fav": 72,
        "share": 73, "comment": 159, "follow": 35, "unfollow": 29, "dm": 22,
        "enter_profile": 31, "click_tag": 25, "dislike": 18,
    }


def test_enrichment_keeps_every_event(spark):
    com = A.community_events(spark, SF_SMALL)
    enr = enrich(com, A.item_dimension(spark, SF_SMALL))
    assert enr.count() == com.count() == 1000
    assert enr.where(F.col("category") == "Unknown").count() == 199
    tags = enr.agg(
        F.count_if(is_d1_instant_exit()).alias("d1"),
        F.count_if(is_e1_fast_swipe()).alias("e1"),
        F.count_if(is_c_long_stay()).alias("c"),
    ).first()
    assert (tags.d1, tags.e1, tags.c) == (44, 35, 2)


def test_mid_scale_tags(spark):
    from tests.conftest import SF_MID

    enr = enrich(A.community_events(spark, SF_MID), A.item_dimension(spark, SF_MID))
    tags = enr.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("category") == "Unknown").alias("unknown"),
        F.count_if(is_d1_instant_exit()).alias("d1"),
        F.count_if(is_e1_fast_swipe()).alias("e1"),
        F.count_if(is_c_long_stay()).alias("c"),
    ).first()
    assert tuple(tags) == (10000, 2017, 411, 323, 19)


def test_app_open_users(spark):
    com = A.community_events(spark, SF_SMALL)
    assert com.where("event_type = 'app_open'").select("user_id").distinct().count() == 15


def test_detector_totals(spark):
    den = A.dense_events(spark, SF_SMALL)
    assert den.count() == 4599
    a1 = cheat.detect_a1(A.dense_for_a1(den))
    r = a1.agg(
        F.count_if(F.col("event_type") == "comment").alias("comments"),
        F.count_if("is_cheat_a1").alias("flagged"),
        F.sum(F.when(F.col("is_cheat_a1"), F.col("event_id"))).alias("ids"),
    ).first()
    assert (r.comments, r.flagged, r.ids) == (1611, 15, 98373)
    a2 = cheat.detect_a2(A.dense_for_a2(den))
    likes = den.where("event_type = 'like'").count()
    r2 = a2.agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids")).first()
    assert (likes, r2.n, r2.ids) == (2646, 1273, 7916222)
