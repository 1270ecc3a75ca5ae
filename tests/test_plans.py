"""Physical plans that must not get worse."""

from tablecraft.operators import clean, dedup, evaluate, nulls, profile, report
from tablecraft.plans import shop as shop_plan
from tablecraft.sources import stage
from tablecraft.sources.standin import loans, shop_events, table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    text = plan(clean.any_equal(events, "event_type", ["view", "click"]).select("event_id"))
    assert "PushedFilters: [Or(EqualTo(event_type,view),EqualTo(event_type,click))]" in text
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in text


def test_reports_read_only_their_columns(spark, sf_dir):
    events = shop_plan.clean_events(stage(shop_events(spark, sf_dir), "events"))
    assert "ReadSchema: struct<event_type:string>" in plan(report.conversion_rates(events))
    assert "ReadSchema: struct<event_time:timestamp_ntz,user_id:bigint>" in plan(report.visitors_by_day(events))


def test_one_exchange_per_grouped_count(spark, sf_dir):
    events = shop_plan.clean_events(shop_events(spark, sf_dir))
    assert plan(report.activity_per_user(events)).count("Exchange hashpartitioning") == 1
    assert plan(nulls.null_counts(events)).count("Exchange") == 1
    assert plan(profile.column_info(events)).count("FileScan") == 1


def test_unused_joins_are_left_out(spark, sf_dir):
    assert "Join" not in plan(loans(spark, sf_dir, "id", "loan_amnt"))
    assert plan(loans(spark, sf_dir, "grade")).count("Join") == 1


def test_top_k_is_not_a_sort(spark, sf_dir):
    events = shop_plan.clean_events(shop_events(spark, sf_dir))
    assert "TakeOrderedAndProject" in plan(report.top_values(events, "brand", 50))
    assert "TakeOrderedAndProject" in plan(profile.preview(events, ["event_id"]))


def test_first_rows_are_cut_before_the_shuffle(spark, sf_dir):
    events = shop_plan.clean_events(shop_events(spark, sf_dir))
    text = plan(dedup.keep_first(events, ["event_type"], ["event_id"]))
    assert text.count("WindowGroupLimit") == 2 and text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_duplicate_mask_joins_on_the_unique_key(spark, sf_dir):
    events = shop_plan.clean_events(shop_events(spark, sf_dir))
    text = plan(dedup.duplicate_mask(events, ["event_type", "user_id"], "event_id"))
    assert "partial_min(event_id" in text
    assert all("windowspecdefinition(event_id" in line for line in text.splitlines() if " Window [" in line)


def test_activity_per_session_scans_once(spark, sf_dir, monkeypatch):
    events = shop_plan.clean_events(shop_events(spark, sf_dir))
    scans = []
    monkeypatch.setattr(report, "stage", lambda part, name: scans.append(plan(part).count("FileScan")) or stage(part, name))
    df = report.activity_per_session(events)
    df.collect()
    assert scans == [1]
    assert "events.parquet" not in plan(df) and plan(df).count("session-counts") == plan(df).count("FileScan")


def test_confusion_is_one_aggregate(spark):
    df = spark.createDataFrame([(0.0, 1.0)], "label double, prediction double")
    assert plan(evaluate.classification_metrics(evaluate.confusion_counts(df))).count("Exchange") == 1
