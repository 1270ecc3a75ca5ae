"""Semi-joins that drop rows before the shuffle, and tables stored by key."""

import random

import pytest
from pyspark.sql import functions as F

from tablecraft.operators import reduce as reducing
from tablecraft.operators import report
from tablecraft.plans import shop as shop_plan
from tablecraft.sources import stage, stage_bucketed
from tablecraft.sources.standin import shop_events
from tests.conftest import rows
from tests.test_plans import plan


@pytest.fixture(scope="module")
def visits(spark):
    """A third of the rows belong to one user; some users are unknown."""
    rng = random.Random(6)
    users = [7] * 10_000 + [rng.randint(0, 5000) for _ in range(20_000)] + [None] * 500
    return spark.createDataFrame([(u, i, "k") for i, u in enumerate(users)], "user_id long, n int, `__block` string").drop("__block").repartition(8)


@pytest.mark.parametrize("most_blocks", [reducing.MOST_BLOCKS, 1])
@pytest.mark.parametrize("with_hot", [True, False])
def test_semi_join_is_exact(spark, visits, most_blocks, with_hot):
    keys = spark.createDataFrame([(k,) for k in [*range(0, 5000, 3), None, 9999, 3, 3] if with_hot or k != 7] + ([(7,)] if with_hot else []), "user_id long")
    expected = visits.join(keys, "user_id", "left_semi")
    assert rows(reducing.semi_join(visits, keys, "user_id", most_blocks=most_blocks)) == rows(expected)


def test_semi_join_of_nothing(spark, visits):
    none = spark.createDataFrame([], "user_id long")
    assert reducing.semi_join(visits, none, "user_id").count() == 0
    assert reducing.semi_join(visits.limit(0), visits.select("user_id"), "user_id").count() == 0
    texts = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "user_id string, n int")
    assert rows(reducing.semi_join(texts, texts.where("n = 2"), "user_id")) == [("b", 2)]


def test_the_filter_rejects_most_strangers(spark):
    keys = spark.range(20_000).selectExpr("id as k")
    blocks = 20_000 * reducing.BITS_PER_KEY // (64 * reducing.WORDS) + 1
    bloom = reducing.bloom_filter(keys, "k", blocks)
    assert bloom.count() <= blocks and bloom.select(F.max(F.size("words"))).first()[0] == reducing.WORDS
    assert reducing.filtered(keys, "k", bloom, blocks).count() == 20_000
    strangers = spark.range(10**9, 10**9 + 50_000).selectExpr("id as k")
    assert reducing.filtered(strangers, "k", bloom, blocks).count() < 2_500


def test_rows_are_filtered_before_the_shuffle(spark, visits):
    stored = stage(visits, "visits")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(reducing.semi_join(stored, stored.where("n < 300"), "user_id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffled = text[text.index("SortMergeJoin") :]
    assert shuffled.index("Exchange hashpartitioning(user_id") < shuffled.index("__words") < shuffled.index("visits")
    assert [r.user_id for r in reducing.hot_keys(stored, "user_id", 0.01).collect()] == [7]


def test_reports_of_a_table_stored_by_user_need_no_exchange(spark, sf_dir):
    events = stage_bucketed(shop_plan.clean_events(shop_events(spark, sf_dir)), "by-user", "user_id", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for made in (
            report.events_of(events, report.buyers(events)),
            report.sums_by(events, "user_id", ["product_id", "price"], decimals=6),
            report.activity_per_user(events),
            shop_plan.cart_purchase_users(events),
        ):
            assert "Exchange" not in plan(made)
            assert made.count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
