"""Sketches against exact figures, whole and merged."""

import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tablecraft.operators import report, sketches
from tests.test_plans import plan


@pytest.fixture(scope="module")
def numbers(spark):
    """Three columns: many ties, a long tail, and nothing but nulls and NaN."""
    rng = random.Random(3)
    rows = [(i % 12, float(rng.randint(0, 9)), math.exp(rng.gauss(0, 4)), None if i % 2 else float("nan")) for i in range(60_000)]
    rows += [(12, None, None, None), (None, 1.0, -5.0, None)]
    return spark.createDataFrame(rows, "part int, ties double, tail double, `no.thing` double").repartition(16).cache()


@pytest.mark.parametrize("k", [64, sketches.QUANTILE_K])
def test_ranks_of_sketched_quantiles(numbers, k):
    probabilities = [0.001, 0.1, 0.25, 0.5, 0.75, 0.9, 0.999]
    for states in (
        sketches.quantile_states(numbers, ["ties", "tail"], k=k),
        sketches.merge_quantiles(sketches.quantile_states(numbers, ["ties", "tail"], ["part"], k=k)),
    ):
        found = sketches.described(states, probabilities).collect()
        names = [c for c in found[0].asDict() if c.startswith("q")]
        spans = sketches.rank_spans(numbers, {r["column"]: [r[q] for q in names] for r in found}).collect()
        assert len(spans) == 14
        for s in spans:
            room = 2 * sketches.rank_error(k) * s.n + 1
            assert s.below - room <= probabilities[s.place] * s.n <= s.upto + room


def test_moments_merge(numbers):
    states = sketches.merge_quantiles(sketches.quantile_states(numbers, ["ties", "tail", "no.thing"], ["part"]))
    found = {r["column"]: r for r in sketches.described(states).collect()}
    for c in ("ties", "tail"):
        values = [r[0] for r in numbers.where(F.col(c).isNotNull()).select(c).collect()]
        r = found[c]
        assert (r["count"], r["min"], r["max"]) == (len(values), min(values), max(values))
        assert r["mean"] == pytest.approx(statistics.fmean(values)) and r["std"] == pytest.approx(statistics.stdev(values))
    nothing = found["no.thing"]
    assert nothing["count"] == 0 and [nothing[c] for c in ("mean", "std", "min", "q50", "max")] == [None] * 5
    grouped = sketches.merge_quantiles(sketches.quantile_states(numbers, ["ties"], ["part"]), ["part"])
    by_part = {r.part: r["count"] for r in sketches.described(grouped, by=["part"]).collect()}
    assert by_part == {**{i: 5000 for i in range(12)}, 12: 0, None: 1}
    assert sketches.describe_sketch(numbers.limit(0), ["ties"]).first()["count"] == 0


def test_one_scan_and_one_row_a_task(numbers, spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    text = plan(sketches.describe_sketch(events, ["event_id", "user_id", "value"]))
    assert text.count("FileScan") == 1 and text.count("Exchange SinglePartition") == 1 and "Exchange hash" not in text
    dealt = next(line for line in plan(sketches.visitor_states(events, "ts")).splitlines() if "Exchange" in line)
    assert "hashpartitioning(_groupingexpression" in dealt and "user_id" not in dealt


def test_visitors_of_ranges(spark):
    rng = random.Random(9)
    start = dt.datetime(2024, 2, 1)
    rows = [(start + dt.timedelta(days=rng.randint(0, 40), seconds=5), rng.randint(1, 30_000)) for _ in range(80_000)]
    rows += [(start, None), (None, 5)]
    visits = spark.createDataFrame(rows, "event_time timestamp_ntz, user_id long")
    half = F.col("user_id") % 2 == 0
    loads = sketches.visitor_states(visits.where(half)).unionByName(sketches.visitor_states(visits.where(~half)))
    days = [start.date() + dt.timedelta(days=i) for i in range(60)]
    ranges = [(days[0], days[0]), (days[3], days[9]), (days[0], days[59]), (days[50], days[55])]
    asked = spark.createDataFrame(ranges, "first_day date, last_day date")
    for states in (sketches.visitor_states(visits), loads):
        found = {(r.first_day, r.last_day): r.visitors for r in sketches.visitors_by_range(states, asked).collect()}
        assert set(found) == set(ranges)
        for first, last in ranges:
            exact = len({u for t, u in rows if t and u and first <= t.date() <= last})
            assert abs(found[first, last] - exact) <= 4 * sketches.visitor_error() * exact


@pytest.mark.parametrize("tracked", [64, 1024, sketches.TRACKED])
def test_heavy_hitters_are_exact(spark, tracked, monkeypatch):
    """A long tail; the small sketch cannot prove its list and has to grow."""
    rng = random.Random(4)
    rows = [(f"v{int(rng.paretovariate(0.8))}", i) for i in range(40_000)] + [(None, 0)] * 20_000
    values = spark.createDataFrame(rows, "v string, n int").repartition(8)
    for limit in (1, 20, 50):
        assert sketches.heavy_hitters(values, "v", limit, tracked=tracked).collect() == report.top_values(values, "v", limit).collect()


def test_heavy_hitters_without_a_clear_list(spark, monkeypatch):
    """All values are equally frequent, so no sketch below their number proves anything."""
    monkeypatch.setattr(sketches, "MOST_TRACKED", 256)
    values = spark.range(60_000).selectExpr("id % 20000 as v")
    assert sketches.heavy_hitters(values, "v", 5, tracked=64).collect() == report.top_values(values, "v", 5).collect()
    few = spark.createDataFrame([(1,), (1,), (2,), (None,)], "v int")
    assert [tuple(r) for r in sketches.heavy_hitters(few, "v", 5).collect()] == [(1, 2), (2, 1)]
    assert sketches.heavy_hitters(few.limit(0), "v", 5).collect() == []


def test_candidates_alone_are_shuffled(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    text = plan(sketches.heavy_hitters(events, "user_id", 10))
    assert "BroadcastHashJoin" in text and text.index("Exchange hashpartitioning") < text.index("BroadcastHashJoin")
