"""The registered queries: key -> function of (session, table folder).

Each one runs an operator or a study over the whole of the loan or shop stand-in table. Floating
results whose last digits depend on the order of summation are rounded here, not in the operators.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecraft.constants import (
    BUYING_EVENTS,
    IMPORTANCE_FLOOR,
    LABEL_COLUMN,
    LOAN_CURRENT_COLUMNS,
    LOAN_FLOAT_COLUMNS,
    LOAN_ID_COLUMNS,
    LOAN_INDEXED_COLUMNS,
    LOAN_MINOR_COLUMNS,
    LOAN_ONE_HOT_COLUMNS,
    ONE_HOT_LEVELS,
    SETTLED_STATUSES,
    SPARSE_FRACTION,
    TOP_BRANDS,
    TOP_PURCHASE_BRANDS,
    WEIGHT_COLUMN,
)
from tablecraft.operators import clean, dedup, evaluate, features, linear, models, nulls, profile, report, sketches, trees
from tablecraft.operators import reduce as reducing
from tablecraft.plans import loans as loan_plan
from tablecraft.plans import shop as shop_plan
from tablecraft.sources import (
    from_footers,
    read_csv,
    read_csv_with_rejects,
    read_parquet,
    stage,
    stage_bucketed,
    working_path,
    write_csv,
    write_parquet,
)
from tablecraft.sources.standin import loans, shop_events

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Report, its key column, its figures.
SHOP_REPORTS = [
    ("event_types", "event_type", "count"),
    ("event_type_shares", "event_type", "share_pct"),
    ("brands", "brand", "count"),
    ("brand_shares", "brand", "share_pct"),
    ("brand_users", "brand", "user_count"),
    ("top_brands", "brand", "count"),
    ("top_purchase_brands", "brand", "count"),
    ("visitors", "day", "visitors"),
    ("activity_per_user", "user_id", "activity_count"),
    ("activity_per_session", "user_session", "activity_count"),
    ("user_sums", "user_id", "product_id", "category_id", "price"),
    ("product_prices", "product_id", "mean_price"),
]
DESCRIBED = ["product_id", "category_id", "price", "user_id"]
NUMERIC_LOANS = ["loan_amnt", "installment", "annual_inc", "dti"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shop_plan.clean_events(shop_events(spark, sf_dir))


def _raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events before nulls are filled, the category text left out."""
    return clean.drop_columns(shop_events(spark, sf_dir), ["category_code"])


def _text_times(events: DataFrame) -> DataFrame:
    """The same events with the time as text, as in a CSV file."""
    return events.withColumn("event_time", F.concat(F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")))


def _staged_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A join of five tables, that cleaning reads three times."""
    return stage(loan_plan.without_unused(loans(spark, sf_dir), keep=["id"]), "loans")


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loan_plan.clean_loans(_staged_loans(spark, sf_dir), keep=["id"])


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key and 0/1 label of the settled loans."""
    settled = loan_plan.settled_loans(loans(spark, sf_dir, "id", "loan_status"))
    return clean.add_default_label(settled, name=LABEL_COLUMN).drop("loan_status")


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loans whose label is 100 where the loan has not ended, as in a badly merged file."""
    rows = clean.add_default_label(loans(spark, sf_dir, "id", "loan_status", "loan_amnt"), name="label")
    marked = F.when(F.col("loan_status") == "Current", 100).otherwise(F.col("label"))
    return rows.select(F.col("id").alias("_c0"), "id", "loan_amnt", "label", marked.alias(LABEL_COLUMN))


def _predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label, score and prediction of a fixed rule in place of a fitted model."""
    settled = loan_plan.settled_loans(loans(spark, sf_dir, "loan_status", "loan_amnt"))
    score = F.col("loan_amnt") / (F.col("loan_amnt") + 50000.0)
    return clean.add_default_label(settled).select(
        F.col("isDefault").cast("double").alias("label"),
        score.alias("score"),
        F.when(score >= 0.5, 0.0).otherwise(1.0).alias("prediction"),
    )


def _vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    raw = _staged_loans(spark, sf_dir)
    return loan_plan.loan_vectors(loan_plan.clean_loans(raw, keep=["id"]), key="id", spent=raw)


# --- sources and sinks -------------------------------------------------------------------------

@query
def csv_scan(spark, sf_dir):
    """Loans written as CSV with "unknown" for a missing balance; such rows are malformed."""
    rows = loans(spark, sf_dir, "id", "loan_status", "term", "loan_amnt", "tot_cur_bal")
    path = working_path(spark, "loans-csv")
    write_csv(rows.withColumn("tot_cur_bal", F.coalesce(F.col("tot_cur_bal").cast("string"), F.lit("unknown"))), path)
    return read_csv(
        spark, path, "id string, loan_status string, term string, loan_amnt double, tot_cur_bal double"
    )


CSV_TYPES = "id string, loan_status string, term string, loan_amnt double, tot_cur_bal double"


def _damaged_csv(spark: SparkSession, sf_dir: str) -> str:
    """Lines without a header: an amount that is no number, a missing field, a field too many, and "unknown"
    for a missing balance."""
    rows = loans(spark, sf_dir, "id", "loan_status", "term", "loan_amnt", "tot_cur_bal")
    line = F.right("id", F.lit(1))
    amount, balance = (F.col(c).cast("decimal(18,2)").cast("string") for c in ("loan_amnt", "tot_cur_bal"))
    fields = ["id", "loan_status", "term", F.when(line == "5", F.concat(amount, F.lit(" USD"))).otherwise(amount)]
    fields.append(F.when(line == "6", None).otherwise(F.coalesce(balance, F.lit("unknown"))))
    text = F.concat(F.concat_ws(",", *fields), F.when(line == "7", F.lit(",more")).otherwise(F.lit("")))
    path = working_path(spark, "damaged-csv")
    rows.select(text.alias("value")).write.text(path)
    return path


@query
def csv_rejects(spark, sf_dir):
    _, rejects = read_csv_with_rejects(spark, _damaged_csv(spark, sf_dir), CSV_TYPES, header=False)
    return rejects.select("record", "column", "value", "reason")


@query
def csv_kept(spark, sf_dir):
    return read_csv_with_rejects(spark, _damaged_csv(spark, sf_dir), CSV_TYPES, header=False)[0]


@query
def csv_totals(spark, sf_dir):
    """Lines, rows kept and records rejected."""
    path = _damaged_csv(spark, sf_dir)
    kept, rejects = read_csv_with_rejects(spark, path, CSV_TYPES, header=False)
    counts = [
        spark.read.text(path).agg(F.count(F.lit(1)).alias("lines")).scalar(),
        kept.agg(F.count(F.lit(1)).alias("kept")).scalar(),
        rejects.agg(F.count_distinct("record_no").alias("rejected")).scalar(),
    ]
    return spark.range(1).select(*[c.alias(n) for c, n in zip(counts, ("lines", "kept", "rejected"))])


@query
def csv_scan_inferred(spark, sf_dir):
    """Types found by a pass over the files, as a file without a schema is read."""
    path = working_path(spark, "loans-inferred")
    write_csv(loans(spark, sf_dir, "id", "loan_status", "term", "loan_amnt", "dti", "tot_cur_bal", "policy_code"), path)
    return read_csv(spark, path)


@query
def clean_scan(spark, sf_dir):
    """An earlier cleaned table with a stray index column, an old label, and bad labels."""
    path = working_path(spark, "clean-scan")
    write_parquet(_marked(spark, sf_dir), path)
    return clean.drop_columns(clean.not_equal(read_parquet(spark, path), LABEL_COLUMN, 100), ["_c0", "label"])


@query
def events_scan(spark, sf_dir):
    rows = _text_times(shop_events(spark, sf_dir))
    path = working_path(spark, "events-csv")
    write_csv(rows, path)
    return read_csv(spark, path, rows.schema, malformed="fail")


@query
def clean_roundtrip(spark, sf_dir):
    path = working_path(spark, "clean-loans")
    write_parquet(_cleaned(spark, sf_dir), path)
    return read_parquet(spark, path)


# --- profiles ----------------------------------------------------------------------------------

@query
def shape(spark, sf_dir):
    return profile.shape(loans(spark, sf_dir))


@query
def preview(spark, sf_dir):
    return profile.preview(shop_events(spark, sf_dir), ["event_id"])


@query
def column_info(spark, sf_dir):
    return profile.column_info(shop_events(spark, sf_dir))


@query
def describe(spark, sf_dir):
    rows = stage(_raw_events(spark, sf_dir).select(*DESCRIBED), "described")  # narrow, and read several times
    return _rounded(profile.describe(rows, DESCRIBED), "mean", "std")


@query
def box_stats(spark, sf_dir):
    return profile.box_stats(stage(_events(spark, sf_dir).select("price"), "prices"), "price")


@query
def correlation_matrix(spark, sf_dir):
    rows = stage(_events(spark, sf_dir).select(*DESCRIBED), "correlated")
    return _rounded(profile.correlation_matrix(rows, DESCRIBED), "r")


@query
def correlation_tiles(spark, sf_dir):
    """The same by tiles of column pairs, small ones here, so that several scans make the matrix."""
    rows = stage(_events(spark, sf_dir).select(*DESCRIBED), "correlated")
    return _rounded(profile.correlation_tiles(rows, DESCRIBED, block=2, cells=48), "r")


def _stored_loans(spark: SparkSession, sf_dir: str) -> str:
    path = working_path(spark, "stored-loans")
    write_parquet(loans(spark, sf_dir), path)
    return path


@query
def shape_from_footers(spark, sf_dir):
    return from_footers(spark, _stored_loans(spark, sf_dir), profile.shape)


@query
def column_counts_from_footers(spark, sf_dir):
    found = from_footers(spark, _stored_loans(spark, sf_dir), profile.column_info)
    return found.select("column", "non_null_count")


@query
def narrow_plan_from_footers(spark, sf_dir):
    path = working_path(spark, "stored-events")
    write_parquet(shop_events(spark, sf_dir).select(*DESCRIBED), path)
    return from_footers(spark, path, clean.narrow_plan)


# --- stored summaries ---------------------------------------------------------------------------

@query
def describe_sketch(spark, sf_dir):
    """The sketched description, and whether the exact ranks of its quartiles are where they should be."""
    rows = stage(_raw_events(spark, sf_dir), "events")
    found = stage(sketches.describe_sketch(rows, DESCRIBED), "sketched")
    quartiles = {r["column"]: [r.q25, r.q50, r.q75] for r in found.collect()}
    spans = sketches.rank_spans(rows, quartiles)
    wanted = F.element_at(F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("place") + 1) * F.col("n")
    room = 2 * sketches.rank_error() * F.col("n") + 1
    proven = (F.col("below") <= wanted + room) & (F.col("upto") >= wanted - room)
    ranks = spans.groupBy("column").agg(F.bool_and(proven).alias("ranks_proven"))
    return _rounded(found.join(ranks, "column").drop("q25", "q50", "q75"), "mean", "std")


@query
def describe_by_month(spark, sf_dir):
    """Daily states, written, and merged into months without the events."""
    rows = _raw_events(spark, sf_dir).withColumn("day", F.to_date("event_time"))
    daily = stage(sketches.quantile_states(rows, DESCRIBED, ["day"]), "daily-quantiles")
    monthly = sketches.merge_quantiles(daily.withColumn("month", F.date_format("day", "yyyy-MM")), ["month"])
    return _rounded(sketches.described(monthly, by=["month"]).drop("q25", "q50", "q75"), "mean", "std")


def _weeks(spark: SparkSession, days: DataFrame) -> DataFrame:
    """The seven days up to every day that has events."""
    return days.select(F.date_sub("day", 6).alias("first_day"), F.col("day").alias("last_day")).distinct()


@query
def visitors_by_range(spark, sf_dir):
    """Visitors of the seven days up to every day, from daily sketches, held against exact counts."""
    events = stage(_events(spark, sf_dir).select("event_time", "user_id"), "visits")
    states = stage(sketches.visitor_states(events), "daily-visitors")
    weeks = _weeks(spark, states)
    seen = events.select(F.to_date("event_time").alias("day"), "user_id").distinct()
    asked = weeks.select("first_day", "last_day", F.explode(F.sequence("first_day", "last_day")).alias("day"))
    exact = asked.join(seen, "day").groupBy("first_day", "last_day").agg(F.count_distinct("user_id").alias("exact"))
    both = sketches.visitors_by_range(states, weeks).join(exact, ["first_day", "last_day"])
    near = F.abs(F.col("visitors") - F.col("exact")) <= 4 * sketches.visitor_error() * F.col("exact")
    return both.select("first_day", "last_day", F.col("exact").alias("visitors"), near.alias("within_error"))


@query
def heavy_brands(spark, sf_dir):
    return sketches.heavy_hitters(_events(spark, sf_dir), "brand", TOP_BRANDS)


@query
def heavy_purchase_brands(spark, sf_dir):
    return sketches.heavy_hitters(stage(shop_plan.purchases(_events(spark, sf_dir)), "purchases"), "brand", TOP_PURCHASE_BRANDS)


@query
def heavy_users(spark, sf_dir):
    return sketches.heavy_hitters(_events(spark, sf_dir), "user_id", TOP_BRANDS)


# --- nulls -------------------------------------------------------------------------------------

@query
def null_counts_sparse(spark, sf_dir):
    return nulls.null_counts(loans(spark, sf_dir), sparse=True)


@query
def null_counts_dense(spark, sf_dir):
    return nulls.null_counts(shop_events(spark, sf_dir), nan_is_missing=True)


@query
def sparse_columns(spark, sf_dir):
    return nulls.sparse_columns(loans(spark, sf_dir), SPARSE_FRACTION)


@query
def drop_sparse(spark, sf_dir):
    return nulls.drop_sparse(loans(spark, sf_dir), SPARSE_FRACTION)


@query
def null_mask(spark, sf_dir):
    return nulls.null_mask(shop_events(spark, sf_dir), "event_id")


@query
def fill_zero_when(spark, sf_dir):
    rows = loans(spark, sf_dir, "id", "loan_status", "tot_cur_bal", "tot_coll_amt")
    return nulls.fill_zero_when(rows, ["tot_cur_bal", "tot_coll_amt"], "loan_status", SETTLED_STATUSES)


@query
def mean_impute(spark, sf_dir):
    return nulls.mean_impute(loans(spark, sf_dir, "id", "total_rev_hi_lim"), "total_rev_hi_lim")


@query
def drop_any_null(spark, sf_dir):
    return nulls.drop_any_null(loans(spark, sf_dir, "id", "loan_status", "tot_cur_bal", "total_rev_hi_lim"))


@query
def fill_zero(spark, sf_dir):
    return nulls.fill_zero(shop_events(spark, sf_dir))


@query
def cart_users_complete(spark, sf_dir):
    """First buying event per user, users whose event has a null left out."""
    rows = clean.drop_columns(shop_events(spark, sf_dir), ["category_code"])
    return nulls.drop_any_null(shop_plan.cart_purchase_users(rows))


# --- projections and derived columns -----------------------------------------------------------

@query
def drop_columns(spark, sf_dir):
    return clean.drop_columns(loans(spark, sf_dir), LOAN_ID_COLUMNS[1:] + LOAN_MINOR_COLUMNS + LOAN_CURRENT_COLUMNS)


@query
def cast_float(spark, sf_dir):
    columns = [*NUMERIC_LOANS, "int_rate", "mths_since_rcnt_il"]
    return clean.cast_numbers(loans(spark, sf_dir, "id", *columns), LOAN_FLOAT_COLUMNS, strip_percent=True)


@query
def cast_float_strict(spark, sf_dir):
    """Without the percent sign taken off, a rate such as "5%" is no number and becomes null."""
    return clean.cast_numbers(loans(spark, sf_dir, "id", "int_rate", "dti"), LOAN_FLOAT_COLUMNS)


@query
def label_rename(spark, sf_dir):
    rows = clean.add_default_label(loans(spark, sf_dir, "id", "loan_status"))
    return clean.rename_to_end(rows, "isDefault", LABEL_COLUMN)


@query
def default_label(spark, sf_dir):
    return clean.add_default_label(loans(spark, sf_dir, "id", "loan_status"))


@query
def emp_length_ordinal(spark, sf_dir):
    return clean.add_employment_years(loans(spark, sf_dir, "id", "emp_length"))


@query
def event_day_text(spark, sf_dir):
    return clean.add_day_text(shop_events(spark, sf_dir).select("event_id", "event_time"))


@query
def event_date(spark, sf_dir):
    return clean.add_event_date(shop_events(spark, sf_dir).select("event_id", "event_time"))


@query
def event_day_of_text(spark, sf_dir):
    return clean.add_day_text(_text_times(shop_events(spark, sf_dir).select("event_id", "event_time")))


@query
def event_date_of_text(spark, sf_dir):
    return clean.add_event_date(_text_times(shop_events(spark, sf_dir).select("event_id", "event_time")))


@query
def narrow_plan(spark, sf_dir):
    return clean.narrow_plan(shop_events(spark, sf_dir).select("product_id", "category_id", "price", "user_id"))


@query
def narrow_types(spark, sf_dir):
    return clean.narrow_types(_events(spark, sf_dir).drop("event_id"))


# --- filters -----------------------------------------------------------------------------------

@query
def loan_status_filter(spark, sf_dir):
    return loan_plan.settled_loans(loans(spark, sf_dir, "id", "loan_status"))


@query
def not_equal_filter(spark, sf_dir):
    return clean.not_equal(_marked(spark, sf_dir), LABEL_COLUMN, 100).select("id", LABEL_COLUMN)


@query
def bad_label_audit(spark, sf_dir):
    return clean.above(_marked(spark, sf_dir), LABEL_COLUMN, 99).select("id", LABEL_COLUMN)


@query
def isin_filter(spark, sf_dir):
    return clean.member_of(_events(spark, sf_dir), "event_type", BUYING_EVENTS)


# --- joins -------------------------------------------------------------------------------------

@query
def active_user_events(spark, sf_dir):
    events = _events(spark, sf_dir)
    return report.events_of(events, report.buyers(events))


@query
def active_user_events_reduced(spark, sf_dir):
    """The same by a Bloom filter of the buyers and a broadcast of the busiest of them."""
    events = stage(_events(spark, sf_dir), "events")
    return reducing.semi_join(events, report.buyers(events), "user_id")


# --- events stored by user ---------------------------------------------------------------------

def _by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_bucketed(_events(spark, sf_dir), "events-by-user", "user_id", 8)


@query
def bucketed_active_user_events(spark, sf_dir):
    events = _by_user(spark, sf_dir)
    return report.events_of(events, report.buyers(events))


@query
def bucketed_user_sums(spark, sf_dir):
    return report.sums_by(_by_user(spark, sf_dir), "user_id", ["product_id", "category_id", "price"], decimals=6)


@query
def bucketed_activity_per_user(spark, sf_dir):
    return report.activity_per_user(_by_user(spark, sf_dir))


@query
def bucketed_cart_purchase_users(spark, sf_dir):
    return shop_plan.cart_purchase_users(_by_user(spark, sf_dir))


# --- reports -----------------------------------------------------------------------------------

@query
def value_counts(spark, sf_dir):
    return report.value_counts(_cleaned(spark, sf_dir), "loan_status")


@query
def value_counts_grade(spark, sf_dir):
    return report.value_counts(loan_plan.settled_loans(_cleaned(spark, sf_dir)), "grade")


@query
def value_counts_sub_grade(spark, sf_dir):
    return report.value_counts(loan_plan.settled_loans(_cleaned(spark, sf_dir)), "sub_grade")


@query
def value_counts_null_key(spark, sf_dir):
    return report.value_counts(loans(spark, sf_dir, "mths_since_rcnt_il"), "mths_since_rcnt_il")


@query
def class_counts(spark, sf_dir):
    return report.class_counts(_labelled(spark, sf_dir), LABEL_COLUMN)


@query
def class_weights(spark, sf_dir):
    return _rounded(features.add_class_weights(_labelled(spark, sf_dir)), WEIGHT_COLUMN, digits=12)


@query
def weight_counts(spark, sf_dir):
    weighted = features.add_class_weights(_labelled(spark, sf_dir))
    return report.class_counts(_rounded(weighted, WEIGHT_COLUMN, digits=12), WEIGHT_COLUMN)


@query
def event_type_counts(spark, sf_dir):
    return report.value_counts(_events(spark, sf_dir), "event_type", keep_null=False)


@query
def brand_counts(spark, sf_dir):
    return report.value_counts(_events(spark, sf_dir), "brand", keep_null=False)


@query
def visitors_by_date(spark, sf_dir):
    return report.visitors_by_day(_events(spark, sf_dir))


@query
def visitors_by_date_of_text(spark, sf_dir):
    return report.visitors_by_day(_text_times(_events(spark, sf_dir)))


@query
def brand_column_counts(spark, sf_dir):
    return report.column_counts(_events(spark, sf_dir).drop("event_id"), "brand")


@query
def brand_user_counts(spark, sf_dir):
    return report.user_counts(_events(spark, sf_dir))


@query
def user_sums(spark, sf_dir):
    return report.sums_by(_events(spark, sf_dir), "user_id", ["product_id", "category_id", "price"], decimals=6)


@query
def mean_price_by_product(spark, sf_dir):
    return _rounded(report.mean_by(_events(spark, sf_dir), "product_id", "price", "mean_price"), "mean_price")


@query
def conversion_rates(spark, sf_dir):
    return report.conversion_rates(_events(spark, sf_dir))


@query
def activity_per_user(spark, sf_dir):
    return report.activity_per_user(_events(spark, sf_dir))


@query
def activity_per_session(spark, sf_dir):
    return report.activity_per_session(_events(spark, sf_dir))


@query
def event_type_share(spark, sf_dir):
    return report.shares(_events(spark, sf_dir), "event_type")


@query
def brand_share(spark, sf_dir):
    return report.shares(_events(spark, sf_dir), "brand")


@query
def top_brands(spark, sf_dir):
    return report.top_values(_events(spark, sf_dir), "brand", TOP_BRANDS)


@query
def top_purchase_brands(spark, sf_dir):
    return report.top_values(shop_plan.purchases(_events(spark, sf_dir)), "brand", TOP_PURCHASE_BRANDS)


@query
def shop_reports(spark, sf_dir):
    """The reports of the shop study in long form."""
    made = shop_plan.shop_reports(stage(shop_events(spark, sf_dir), "shop-events"))
    made["product_prices"] = _rounded(made["product_prices"], "mean_price")
    parts = []
    for name, key, *values in SHOP_REPORTS:
        for value in values:
            parts.append(made[name].select(F.lit(name).alias("report"), F.lit(value).alias("figure"), F.col(key).cast("string").alias("key"), F.col(value).cast("double").alias("value")))
    rates = made["conversion"]
    for value in rates.columns:
        parts.append(rates.select(F.lit("conversion").alias("report"), F.lit(value).alias("figure"), F.lit("all").alias("key"), F.col(value).cast("double").alias("value")))
    return reduce(DataFrame.unionByName, parts)


# --- duplicates --------------------------------------------------------------------------------

@query
def duplicate_mask(spark, sf_dir):
    rows = _raw_events(spark, sf_dir)
    return dedup.duplicate_mask(rows, [c for c in rows.columns if c != "event_id"], "event_id")


@query
def drop_duplicates(spark, sf_dir):
    return dedup.drop_duplicates(_raw_events(spark, sf_dir).drop("event_id"))


@query
def first_per_event_type(spark, sf_dir):
    return dedup.keep_first(_raw_events(spark, sf_dir), ["event_type"], ["event_id"])


@query
def first_per_price(spark, sf_dir):
    return dedup.keep_first(_events(spark, sf_dir), ["price"], ["event_id"])


@query
def cart_purchase_users(spark, sf_dir):
    return shop_plan.cart_purchase_users(_events(spark, sf_dir))


@query
def purchase_brand_counts(spark, sf_dir):
    return report.value_counts(shop_plan.purchases(_events(spark, sf_dir)), "brand", keep_null=False)


@query
def unique_values(spark, sf_dir):
    return dedup.distinct_values(_events(spark, sf_dir), ["product_id", "category_id", "user_id"])


# --- features ----------------------------------------------------------------------------------

@query
def string_index(spark, sf_dir):
    indexed = features.index_strings(loans(spark, sf_dir, "id", *LOAN_INDEXED_COLUMNS), LOAN_INDEXED_COLUMNS)
    return indexed.drop(*LOAN_INDEXED_COLUMNS)


@query
def string_index_wide(spark, sf_dir):
    """An index of as many levels as there are rows, or nearly."""
    return features.index_strings(loans(spark, sf_dir, "id"), ["id"])


@query
def one_hot(spark, sf_dir):
    rows = loans(spark, sf_dir, "id", *LOAN_ONE_HOT_COLUMNS)
    levels = features.category_levels(rows, LOAN_ONE_HOT_COLUMNS, most=ONE_HOT_LEVELS)
    flagged = features.one_hot(rows, LOAN_ONE_HOT_COLUMNS, levels)
    return flagged.drop(*LOAN_ONE_HOT_COLUMNS)


@query
def assemble(spark, sf_dir):
    """The vector taken apart again, so that every position can be compared."""
    rows = features.assemble(loans(spark, sf_dir, "id", *NUMERIC_LOANS), NUMERIC_LOANS)
    parts = vector_to_array("features")
    return rows.select("id", *[parts[i].alias(f"features_{i}") for i in range(len(NUMERIC_LOANS))])


@query
def label_index(spark, sf_dir):
    return features.index_label(_labelled(spark, sf_dir))


@query
def split_random(spark, sf_dir):
    """Rows per class over both parts, and those that are in both. Which row falls where depends on the
    partitioning."""
    rows = _labelled(spark, sf_dir).withColumn("row", F.monotonically_increasing_id())
    train, test = features.split_random(rows)
    both = train.unionByName(test).groupBy(LABEL_COLUMN).agg(
        F.count(F.lit(1)).alias("count"), (F.count(F.lit(1)) - F.count_distinct("row")).alias("overlap")
    )
    return both


@query
def split_hash(spark, sf_dir):
    return _labelled(spark, sf_dir).select("id", features.in_train("id").alias("in_train"))


@query
def feature_importance(spark, sf_dir):
    vectors, _ = _vectors(spark, sf_dir)
    train, _ = features.split_by_key(vectors, "id")
    forest = models.importance_forest().fit(loan_plan.fit_rows(train, "id"))
    scores = features.feature_importance(train, forest.featureImportances)
    total = scores.agg(F.sum("score").alias("total")).scalar()
    nodes = trees.importances(trees.node_table(forest)).withColumnRenamed("score", "from_nodes")
    met = scores.join(nodes, F.col("idx") == nodes["feature"], "left").select(scores["*"], F.coalesce("from_nodes", F.lit(0.0)).alias("from_nodes"))
    agrees = F.abs(F.col("score") - F.col("from_nodes")) < 1e-9
    return met.select("idx", "feature", (F.abs(total - 1) < 1e-9).alias("sums_to_one"), agrees.alias("nodes_agree"))


@query
def feature_select(spark, sf_dir):
    vectors, _ = _vectors(spark, sf_dir)
    train, _ = features.split_by_key(vectors, "id")
    importance, sliced = loan_plan.select_loan_features(vectors, train, key="id")
    chosen = [r["idx"] for r in importance.where(F.col("score") >= IMPORTANCE_FLOOR).orderBy(F.desc("score"), "idx").collect()]
    original = F.array(*[F.col("all")[i] for i in chosen])
    both = sliced.select("id", "label", vector_to_array("features").alias("all"), vector_to_array("features2").alias("part"))
    return both.select("id", "label", (F.col("part") == original).alias("same_entries"))


# --- models ------------------------------------------------------------------------------------

def _scored(spark, sf_dir, estimator) -> DataFrame:
    vectors, _ = _vectors(spark, sf_dir)
    train, test = features.split_by_key(vectors, "id")
    return models.scorecard(estimator.fit(train).transform(test))


def _checked(spark, sf_dir, estimator, *, spread: bool = False) -> DataFrame:
    """What is fixed about an iterative fit: the test rows and their positives, and whether our figures
    agree with Spark's own evaluators. ``spread`` bounds the partitions of the fit."""
    vectors, _ = _vectors(spark, sf_dir)
    train, test = features.split_by_key(vectors, "id")
    train = loan_plan.fit_rows(train, "id") if spread else train
    predicted = stage(estimator.fit(train).transform(test).drop("features"), "predictions")
    multi = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    area = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="probability", numBins=0)
    theirs = {
        "accuracy": multi.evaluate(predicted, {multi.metricName: "accuracy"}),
        "weighted_f1": multi.evaluate(predicted, {multi.metricName: "f1"}),
        "auc": area.evaluate(predicted),
    }
    card = models.scorecard(predicted)
    agree = [(F.abs(F.col(k) - v) < 1e-9).alias(f"{k}_agrees") for k, v in theirs.items()]
    return card.select("total", (F.col("tp") + F.col("fn")).alias("positives"), *agree)


@query
def model_lr(spark, sf_dir):
    return _checked(spark, sf_dir, models.logistic_regression())


@query
def model_nb(spark, sf_dir):
    """Naive Bayes has a closed form, so its whole scorecard can be computed in SQL as well."""
    card = _scored(spark, sf_dir, models.naive_bayes())
    counts = {"total", "correct", "wrong", "tp", "tn", "fn", "fp", "auc"}
    return _rounded(_rounded(card, *[c for c in card.columns if c not in counts], digits=9), "auc")


@query
def nb_parameters(spark, sf_dir):
    vectors, names = _vectors(spark, sf_dir)
    train, _ = features.split_by_key(vectors, "id")
    return _rounded(models.bayes_parameters(models.naive_bayes().fit(train), names, spark), "log_probability")


@query
def model_rf(spark, sf_dir):
    return _checked(spark, sf_dir, models.random_forest(), spread=True)


@query
def model_gbt(spark, sf_dir):
    return _checked(spark, sf_dir, models.boosted_trees(), spread=True)


# Trees of stated splits over named features: (tree, node, feature, threshold, left, right).
STATED_TREES = [
    (0, 0, "loan_amnt", 40000.0, 1, 2),
    (0, 1, "dti", 4.0, 3, 4),
    (0, 2, "grade_A", 0.5, 5, 6),
    (0, 3, None, None, None, None),
    (0, 4, None, None, None, None),
    (0, 5, None, None, None, None),
    (0, 6, None, None, None, None),
    (1, 0, "grade_B", 0.5, 1, 2),
    (1, 1, "termIndex", 0.5, 3, 4),
    (1, 2, None, None, None, None),
    (1, 3, None, None, None, None),
    (1, 4, "installment", 25.0, 5, 6),
    (1, 5, None, None, None, None),
    (1, 6, None, None, None, None),
]


def _refitted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """Test rows and stated trees with the statistics of the training rows."""
    vectors, names = _vectors(spark, sf_dir)
    train, test = features.split_by_key(vectors, "id")
    splits = [(t, n, None if f is None else names.index(f), x, a, b) for t, n, f, x, a, b in STATED_TREES]
    return test, stage(trees.refit(train, trees.stated_nodes(spark, splits)), "refitted-nodes"), names


@query
def forest_nodes(spark, sf_dir):
    """Class counts and gains of the stated trees on the training rows."""
    _, nodes, _ = _refitted(spark, sf_dir)
    counts = [F.col("stats")[c].cast("long").alias(f"n{c}") for c in range(2)]
    return _rounded(nodes.select("tree", "node", *counts, "gain", "prediction"), "gain", digits=9)


@query
def forest_importances(spark, sf_dir):
    _, nodes, names = _refitted(spark, sf_dir)
    named = spark.createDataFrame(list(enumerate(names)), "feature int, name string")
    return _rounded(trees.importances(nodes).join(named, "feature").select(F.col("name").alias("feature"), "score"), "score", digits=9)


@query
def forest_scorecard(spark, sf_dir):
    """The scorecard of the refitted trees on the test rows, from scores computed out of the node table."""
    test, nodes, _ = _refitted(spark, sf_dir)
    scored = trees.forest_scores(test, nodes)
    scored = scored.withColumns({"prediction": F.when(F.col("score") >= 0.5, 0.0).otherwise(1.0), "score": F.round("score", 12)})
    card = models.card_of(scored.select("label", "prediction", "score"))
    counts = {"total", "correct", "wrong", "tp", "tn", "fn", "fp"}
    return _rounded(card, *[c for c in card.columns if c not in counts], digits=9)


@query
def logistic_gradient(spark, sf_dir):
    """Loss and gradient at stated coefficients: ((7 idx) % 11 - 5) / 10 over the largest value of the feature."""
    vectors, names = _vectors(spark, sf_dir)
    train, _ = features.split_by_key(vectors, "id")
    tops = train.select(F.posexplode(vector_to_array("features")).alias("idx", "x")).groupBy("idx").agg(F.max("x").alias("top"))
    scale = {r["idx"]: r["top"] for r in tops.collect()}
    stated = [((7 * i) % 11 - 5) / 10 / max(1.0, scale.get(i, 1.0)) for i in range(len(names))]
    table = linear.coefficient_table(spark, stated, 0.25, names)
    found = linear.loss_and_gradient(train, table, weight=WEIGHT_COLUMN)
    return _rounded(found.select("idx", "feature", "gradient", "loss"), "gradient", "loss", digits=6)


@query
def loan_study(spark, sf_dir):
    """The whole study in long form: the scorecard of each model on the test rows. Of the iterative fits, what
    does not depend on the fit; of naive Bayes all."""
    raw = _staged_loans(spark, sf_dir)
    cards = loan_plan.loan_study(raw, spent=raw)
    parts = []
    for name, card in cards.items():
        fixed = {"total": F.col("total"), "positives": F.col("tp") + F.col("fn"), "negatives": F.col("tn") + F.col("fp")}
        if name == "naive_bayes":
            fixed |= {c: F.col(c) for c in card.columns if c != "auc"} | {"auc": F.round("auc", 6)}
        row = card.select(*[v.cast("double").alias(k) for k, v in fixed.items()])
        parts.append(row.unpivot([], list(fixed), "figure", "value").select(F.lit(name).alias("model"), "figure", "value"))
    return _rounded(reduce(DataFrame.unionByName, parts), "value", digits=9)


# --- evaluation --------------------------------------------------------------------------------

@query
def metric_accuracy(spark, sf_dir):
    return evaluate.multiclass_metrics(_predicted(spark, sf_dir)).select("accuracy")


@query
def metric_weighted_f1(spark, sf_dir):
    return _rounded(evaluate.multiclass_metrics(_predicted(spark, sf_dir)).select("weighted_f1"), "weighted_f1", digits=9)


@query
def confusion_counts(spark, sf_dir):
    return evaluate.confusion_counts(_predicted(spark, sf_dir))


@query
def confusion_counts_compat(spark, sf_dir):
    return evaluate.confusion_counts(_predicted(spark, sf_dir), compat=True)


@query
def classification_metrics(spark, sf_dir):
    metrics = evaluate.classification_metrics(evaluate.confusion_counts(_predicted(spark, sf_dir)))
    return _rounded(metrics, *metrics.columns, digits=9)


@query
def classification_metrics_compat(spark, sf_dir):
    metrics = evaluate.classification_metrics(evaluate.confusion_counts(_predicted(spark, sf_dir), compat=True))
    return _rounded(metrics, *metrics.columns, digits=9)


@query
def roc_points(spark, sf_dir):
    return evaluate.roc_points(evaluate.score_groups(_predicted(spark, sf_dir), score="score"))


@query
def roc_points_thinned(spark, sf_dir):
    return evaluate.roc_points_thinned(evaluate.score_groups(_predicted(spark, sf_dir), score="score"))


@query
def roc_auc(spark, sf_dir):
    return _rounded(evaluate.roc_auc(evaluate.score_groups(_predicted(spark, sf_dir), score="score")), "auc", digits=9)
