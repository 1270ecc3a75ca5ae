"""Small literal tables for the traps of each operator."""

import math
import time

import numpy as np
import pytest

from tablecraft.operators import clean, dedup, nulls, profile, report
from tests.conftest import rows


def test_nan_is_null_only_when_asked(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b")], "x double, s string")
    assert rows(nulls.null_counts(df)) == [("s", 1), ("x", 1)]
    assert rows(nulls.null_counts(df, nan_is_missing=True)) == [("s", 1), ("x", 2)]


def test_sparse_is_the_positive_part_of_dense(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, "x")], "a int, b int, c string")
    dense = rows(nulls.null_counts(df))
    assert rows(nulls.null_counts(df, sparse=True)) == [r for r in dense if r[1] > 0]


def test_half_empty_is_not_sparse(spark):
    df = spark.createDataFrame([(1, None, None), (None, None, None), (2, None, 1), (None, 5, None)], "a int, b int, c int")
    assert rows(nulls.sparse_columns(df, 0.5)) == [("b", 3, 4), ("c", 3, 4)]
    assert nulls.drop_sparse(df, 0.5).columns == ["a"]


def test_column_named_with_a_dot(spark):
    df = spark.createDataFrame([(1, None)], "`a.b` int, c int")
    assert rows(nulls.null_counts(df)) == [("a.b", 0), ("c", 1)]


def test_fill_zero_when(spark):
    df = spark.createDataFrame(
        [("Fully Paid", None), ("Current", None), (None, None), ("Charged Off", 5.0)], "s string, v double"
    )
    filled = nulls.fill_zero_when(df, ["v"], "s", ["Fully Paid", "Charged Off"])
    assert filled.schema["v"].dataType.simpleString() == "double"
    assert rows(filled) == [("Charged Off", 5.0), ("Current", None), ("Fully Paid", 0.0), (None, None)]


def test_mean_is_cut_toward_zero(spark):
    df = spark.createDataFrame([(-1.0,), (-2.0,), (None,)], "v double")
    assert rows(nulls.mean_impute(df, "v")) == [(-1.0,), (-1.0,), (-2.0,)]
    assert (-1.5,) in rows(nulls.mean_impute(df, "v", truncate=False))


def test_mean_of_nothing_stays_null(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    assert rows(nulls.mean_impute(df, "v")) == [(None,), (None,)]


def test_fill_zero_leaves_no_null(spark):
    df = spark.createDataFrame([(None, None, None), (1, "x", float("nan"))], "a long, s string, d double")
    filled = nulls.fill_zero(df)
    assert rows(filled) == [(0, "0", 0.0), (1, "x", 0.0)]
    assert all(n == 0 for _, n in rows(nulls.null_counts(filled, nan_is_missing=True)))


def test_casts_give_null_not_errors(spark):
    df = spark.createDataFrame([("12.5%",), (" 7% ",), ("x",), (None,)], "rate string")
    assert rows(clean.cast_numbers(df, ["rate", "absent"])) == [(None,)] * 4
    assert rows(clean.cast_numbers(df, ["rate", "absent"], strip_percent=True)) == [(12.5,), (7.0,), (None,), (None,)]


def test_labels_and_years(spark):
    df = spark.createDataFrame(
        [("Default", "< 1 year"), ("Late (16-30 days)", "10+ years"), ("Current", "n/a"), (None, None), ("Charged Off", "7 years")],
        "loan_status string, emp_length string",
    )
    out = clean.add_employment_years(clean.add_default_label(df)).select("loan_status", "isDefault", "emp_lengthIndex")
    assert rows(out) == [
        ("Charged Off", 1, 7), ("Current", 0, 0), ("Default", 1, 0), ("Late (16-30 days)", 1, 10), (None, 0, 0),
    ]


def test_rename_moves_to_the_end(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert clean.rename_to_end(df, "a", "z").columns == ["b", "c", "z"]
    with pytest.raises(ValueError):
        clean.drop_columns(df, ["a", "nope"], strict=True)
    assert clean.drop_columns(df, ["a", "nope"]).columns == ["b", "c"]


def test_not_equal_drops_null(spark):
    df = spark.createDataFrame([(1,), (100,), (None,)], "y int")
    assert rows(clean.not_equal(df, "y", 100)) == [(1,)]
    assert rows(clean.not_equal(df, "y", "100")) == [(1,)]
    assert rows(clean.above(df, "y", 99)) == [(100,)]


def test_days(spark):
    df = spark.createDataFrame([("2019-10-01 00:00:00 UTC",)], "event_time string")
    assert rows(clean.add_day_text(df).select("event_day")) == [("2019-10-01",)]
    assert str(clean.add_event_date(df).first()["event_date"]) == "2019-10-01"
    bad = spark.createDataFrame([("yesterday",)], "event_time string")
    with pytest.raises(Exception):
        clean.add_event_date(bad).collect()


def test_narrow_bounds_are_open(spark):
    df = spark.createDataFrame(
        [(126, 127, 32767, 2**31 - 1, 1e39, 1.5, None), (-127, 0, 0, 0, 0.0, 2.5, None)],
        "a long, b long, c long, d long, e double, f double, g long",
    )
    plan = {r["column"]: r["to_type"] for r in clean.narrow_plan(df).collect()}
    assert plan == {
        "a": "tinyint", "b": "smallint", "c": "int", "d": "bigint", "e": "double", "f": "float", "g": "bigint",
    }
    assert rows(clean.narrow_types(df).select("a", "f")) == [(-127, 2.5), (126, 1.5)]


def test_duplicates_with_null_and_a_large_group(spark):
    data = [(i, "hot", None) for i in range(300)] + [(300, "cold", 1), (301, "cold", 1), (302, "cold", 2)]
    df = spark.createDataFrame(data, "k long, a string, b int").repartition(5)
    mask = dedup.duplicate_mask(df, ["a", "b"], "k")
    assert mask.count() == 303
    assert rows(mask.where("not is_duplicate").select("k")) == [(0,), (300,), (302,)]
    assert rows(dedup.keep_first(df, ["a"], ["k"]).select("k")) == [(0,), (300,)]
    assert dedup.drop_duplicates(df.drop("k")).count() == 3
    assert dedup.drop_duplicates(df, ["a"]).count() == 2


def test_a_repeated_key_is_an_error(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k long, a string")
    with pytest.raises(Exception, match="not unique"):
        dedup.duplicate_mask(df, ["a"], "k").collect()


def test_distinct_values_keep_null(spark):
    df = spark.createDataFrame([(1, 7), (1, None), (2, 7)], "a int, b long")
    assert rows(dedup.distinct_values(df, ["a", "b"])) == [("a", 1), ("a", 2), ("b", 7), ("b", None)]


def test_shape_and_preview(spark):
    df = spark.createDataFrame([(i, -i) for i in range(50)], "a int, b int")
    assert rows(profile.shape(df)) == [(50, 2)]
    assert [r.b for r in profile.preview(df, ["b"], 3).collect()] == [-49, -48, -47]


def test_constant_and_partly_null_correlation(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, None, 5.0), (4.0, 7.9, 5.0), (None, 1.0, 5.0)], "x double, y double, c double"
    )
    got = {(r.a, r.b): r.r for r in profile.correlation_matrix(df).collect()}
    assert len(got) == 9
    xs, ys = [1.0, 2.0, 4.0], [2.0, 4.1, 7.9]
    mx, my = sum(xs) / 3, sum(ys) / 3
    r = sum((a - mx) * (b - my) for a, b in zip(xs, ys)) / math.sqrt(
        sum((a - mx) ** 2 for a in xs) * sum((b - my) ** 2 for b in ys)
    )
    assert got["x", "y"] == pytest.approx(r) == got["y", "x"]
    assert got["x", "x"] == pytest.approx(1.0)
    assert got["x", "c"] is None and got["c", "c"] is None
    several = {(r.a, r.b): r.r for r in profile.correlation_matrix(df.repartition(5)).collect()}
    assert several.keys() == got.keys()
    assert all(several[k] == pytest.approx(got[k]) for k in got if got[k] is not None)


def test_correlation_of_a_wide_table_takes_two_scans(spark):
    rng = np.random.default_rng(3)
    values = rng.normal(size=(200, 159)) + 1e6
    df = spark.createDataFrame([[float(v) for v in row] for row in values], ", ".join(f"c{i} double" for i in range(159)))
    start = time.time()
    got = {(r.a, r.b): r.r for r in profile.correlation_matrix(df).collect()}
    assert time.time() - start < 40 and len(got) == 159 * 159
    want = np.corrcoef(values.T)
    assert got["c3", "c158"] == pytest.approx(want[3, 158]) and got["c7", "c7"] == pytest.approx(1.0)


def test_correlation_of_nothing(spark):
    got = profile.correlation_matrix(spark.createDataFrame([], "x double, y double")).collect()
    assert len(got) == 4 and all(r.r is None for r in got)


def test_box_outliers(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 100]] + [(None,)], "v double")
    assert rows(profile.box_stats(df, "v")) == [(2.25, 3.5, 4.75, 1.0, 5.0, 1)]
    empty = spark.createDataFrame([(None,)], "v double")
    assert rows(profile.box_stats(empty, "v")) == [(None, None, None, None, None, 0)]


def test_describe_skips_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, None), (None, None)], "a int, b double")
    got = {r["column"]: r for r in profile.describe(df).collect()}
    assert (got["a"]["count"], got["a"]["q25"], got["a"]["q50"], got["a"]["q75"]) == (3, 1.5, 2.0, 2.5)
    assert got["a"]["std"] == 1.0
    assert got["b"]["count"] == 0 and got["b"]["mean"] is None and got["b"]["q50"] is None


def test_null_is_a_key_only_when_asked(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), (None,), (None,), ("b",)], "v string")
    assert [tuple(r) for r in report.value_counts(df, "v").collect()] == [(None, 3), ("b", 2), ("a", 1)]
    assert [tuple(r) for r in report.value_counts(df, "v", keep_null=False).collect()] == [("b", 2), ("a", 1)]
    assert [tuple(r) for r in report.top_values(df, "v", 1).collect()] == [("b", 2)]


def test_shares_sum_to_100(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("b",)], "v string")
    assert sum(r.share_pct for r in report.shares(df, "v").collect()) == pytest.approx(100.0)


def test_conversion_without_carts(spark):
    df = spark.createDataFrame([("view",), ("view",), ("purchase",), (None,)], "event_type string")
    assert rows(report.conversion_rates(df)) == [(2, 0, 1, 50.0, 0.0, None)]


def test_rates_do_not_depend_on_rank(spark):
    df = spark.createDataFrame([("purchase",)] * 4 + [("view",)] * 2 + [("cart",)], "event_type string")
    assert rows(report.conversion_rates(df)) == [(2, 1, 4, 200.0, 50.0, 400.0)]


def test_sums_overflow_to_null_and_decimals_are_exact(spark):
    df = spark.createDataFrame([(1, 2**62, 0.1), (1, 2**62, 0.2), (None, 1, 1.0)], "u int, n long, p double")
    assert rows(report.sums_by(df, "u", ["n"])) == [(1, None)]
    assert rows(report.sums_by(df, "u", ["p"], decimals=2)) == [(1, 0.3)]
    large = spark.createDataFrame([(1, 0.125, 3), (1, 1e16, 4), (2, 1e37, 5)], "u int, p double, n int")
    assert rows(report.sums_by(large, "u", ["p", "n"], decimals=3)) == [(1, 1e16 + 0.125, 7), (2, None, 5)]


@pytest.fixture
def clicks(spark):
    # user 1 is very active, user 2 buys once, user 3 only looks; one session is shared by 1 and 3.
    data = [(1, "s1", "view")] * 200 + [(1, "s2", "cart"), (1, "s9", "view"), (2, "s3", "purchase"), (2, "s3", None)]
    data += [(3, "s9", "view"), (3, "s4", "view"), (2, None, "view")]
    return spark.createDataFrame(data, "user_id long, user_session string, event_type string")


def test_activity_of_buyers(clicks):
    buyers = report.buyers(clicks)
    assert rows(buyers) == [(1,), (2,)]
    doubled = buyers.unionAll(buyers)
    assert report.events_of(clicks, doubled).count() == 205
    assert rows(report.activity_per_user(clicks)) == [(1, 202), (2, 2)]
    assert rows(report.activity_per_session(clicks)) == [("s1", 200), ("s2", 1), ("s3", 1), ("s9", 1)]


def test_visitors(spark):
    df = spark.createDataFrame(
        [("2019-10-02 x", 1), ("2019-10-01 a", 1), ("2019-10-01 b", 1), ("2019-10-01 b", 2), ("2019-10-01 c", None)],
        "event_time string, user_id long",
    )
    assert [tuple(r) for r in report.visitors_by_day(df).collect()] == [("2019-10-01", 2), ("2019-10-02", 1)]
    assert [tuple(r) for r in report.visitors_by_day(df, approximate=True).collect()] == [("2019-10-01", 2), ("2019-10-02", 1)]


@pytest.mark.parametrize("block, cells", [(64, 4_000_000), (3, 100), (1, 6)])
def test_correlation_in_tiles_is_the_matrix(spark, block, cells):
    """Nulls in every column, a constant column, one without values, and numbers far from zero."""
    import random

    rng = random.Random(2)
    data = []
    for i in range(900):
        x = rng.gauss(0, 1)
        row = [x, 1e9 + x + rng.gauss(0, 0.1), -3 * x, 5.0, None, rng.random(), float(i)]
        data.append([None if rng.random() < 0.1 else v for v in row] + [i % 4])
    names = ["x", "far", "down", "same", "none", "a.b", "n"]
    df = spark.createDataFrame(data, ", ".join(f"`{c}` double" for c in names) + ", k int").repartition(7)
    whole = {(r.a, r.b): r.r for r in profile.correlation_matrix(df, [*names, "k"]).collect()}
    tiled = profile.correlation_tiles(df, [*names, "k"], block=block, cells=cells).collect()
    assert len(tiled) == 64 and {(r.a, r.b) for r in tiled} == set(whole)
    for r in tiled:
        assert (r.r is None) == (whole[r.a, r.b] is None)
        assert r.r is None or r.r == pytest.approx(whole[r.a, r.b], abs=1e-9)
    assert profile.correlation_tiles(df.limit(0), ["x", "n"]).where("r is not null").count() == 0
