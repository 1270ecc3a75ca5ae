"""Loan and shop tables derived from the given test tables (rules in FIXTURES.md).

Dimension tables are joined from the left and only when one of the requested columns needs them, so
a report on one status column does not pay for four joins. The keys of the dimension tables are
unique, so leaving a join out never changes the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHOP_COLUMNS = [
    "event_id", "event_time", "event_type", "product_id", "category_id", "category_code",
    "brand", "price", "user_id", "user_session",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shop_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table with the nine shop columns plus ``event_id``, the order key. One event in
    twenty comes twice, the copy with an ``event_id`` of its own."""
    k = F.col("k")
    copies = F.when(k % 20 == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    # A column of its own, so that the pattern runs once per row and not once per use.
    events = table(spark, sf_dir, "events").withColumn("k", F.regexp_extract("props", r"([0-9]+)", 1).cast("bigint"))
    events = events.withColumn("copy", F.explode(copies))
    return events.select(
        (F.col("event_id") + F.col("copy") * F.lit(10**12)).alias("event_id"),
        F.col("ts").alias("event_time"),
        F.when(F.col("event_type") == "click", "cart").otherwise(F.col("event_type")).alias("event_type"),
        k.alias("product_id"),
        (k % 10).alias("category_id"),
        F.when(k % 3 != 0, F.concat(F.lit("c"), (k % 10).cast("string"))).alias("category_code"),
        F.when(k % 25 != 0, F.concat(F.lit("Brand#"), (k + 100 * (F.col("user_id") % 3)).cast("string"))).alias("brand"),
        F.col("value").alias("price"),
        "user_id",
        F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias("user_session"),
    )


def _loan_rules() -> dict[str, tuple[str, Column]]:
    """Column name -> (table it is made from, expression)."""
    key = F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    years = F.col("p_size") % 12
    line = F.col("l_linenumber")
    return {
        "id": ("lineitem", key),
        "issue_d": ("lineitem", F.date_format("l_shipdate", "yyyy-MM")),
        "url": ("lineitem", F.concat(F.lit("loan/"), key)),
        "emp_title": ("part", F.col("p_name")),
        "policy_code": ("lineitem", F.lit(1)),
        "loan_status": (
            "orders",
            F.when(F.col("o_orderstatus") == "F", "Fully Paid")
            .when(F.col("o_orderstatus") == "P", "Charged Off")
            .when(F.col("o_orderstatus") == "O", "Current"),
        ),
        "loan_amnt": ("lineitem", F.col("l_extendedprice")),
        "int_rate": (
            "lineitem",
            F.concat(F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.lit("%")),
        ),
        "installment": ("lineitem", F.col("l_quantity")),
        "annual_inc": ("customer", F.greatest(F.col("c_acctbal"), F.lit(0.0))),
        "dti": ("lineitem", F.col("l_tax") * 100),
        "term": (
            "lineitem",
            F.when(F.col("l_linestatus") == "F", " 36 months").when(F.col("l_linestatus") == "O", " 60 months"),
        ),
        "initial_list_status": ("lineitem", F.when(line % 2 == 0, "f").otherwise("w")),
        "application_type": ("lineitem", F.when(F.col("l_suppkey") % 5 == 0, "Joint App").otherwise("Individual")),
        "pymnt_plan": ("lineitem", F.when(F.col("l_suppkey") % 7 == 0, "y").otherwise("n")),
        "grade": ("orders", F.translate(F.substring("o_orderpriority", 1, 1), "12345", "ABCDE")),
        "sub_grade": ("part", F.col("p_brand")),
        "home_ownership": ("customer", F.col("c_mktsegment")),
        "verification_status": ("lineitem", F.col("l_returnflag")),
        "purpose": ("part", F.col("p_type")),
        "addr_state": ("nation", F.col("n_name")),
        "emp_length": (
            "part",
            F.when(years == 0, "< 1 year").when(years == 1, "1 year").when(years == 10, "10+ years")
            .when(years == 11, "n/a").otherwise(F.concat(years.cast("string"), F.lit(" years"))),
        ),
        "tot_cur_bal": ("orders", F.when(line % 4 != 0, F.col("o_totalprice"))),
        "tot_coll_amt": ("lineitem", F.when(line % 4 != 1, F.col("l_quantity") * 10)),
        "total_rev_hi_lim": ("part", F.when(F.col("l_partkey") % 5 != 0, F.col("p_retailprice"))),
        "mths_since_rcnt_il": ("lineitem", F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))),
        "total_pymnt": ("lineitem", F.col("l_extendedprice") * F.col("l_discount")),
        "fico_range_low": ("lineitem", F.col("l_quantity") + 600),
        "hardship_flag": ("lineitem", F.lit("N")),
    }


LOAN_COLUMNS = [
    "id", "issue_d", "url", "emp_title", "policy_code", "loan_status", "loan_amnt", "int_rate",
    "installment", "annual_inc", "dti", "term", "initial_list_status", "application_type",
    "pymnt_plan", "grade", "sub_grade", "home_ownership", "verification_status", "purpose",
    "addr_state", "emp_length", "tot_cur_bal", "tot_coll_amt", "total_rev_hi_lim",
    "mths_since_rcnt_il", "total_pymnt", "fico_range_low", "hardship_flag",
]


def loans(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The wide loan table, one row per line item; all columns when none is named."""
    rules = _loan_rules()
    names = list(columns) or LOAN_COLUMNS
    needed = {rules[name][0] for name in names}

    wide = table(spark, sf_dir, "lineitem")
    if needed & {"orders", "customer", "nation"}:
        orders = table(spark, sf_dir, "orders")
        if needed & {"customer", "nation"}:
            customers = table(spark, sf_dir, "customer")
            if "nation" in needed:
                nations = table(spark, sf_dir, "nation")
                customers = customers.join(nations, customers.c_nationkey == nations.n_nationkey, "left")
            orders = orders.join(customers, orders.o_custkey == customers.c_custkey, "left")
        wide = wide.join(orders, wide.l_orderkey == orders.o_orderkey, "left")
    if "part" in needed:
        parts = table(spark, sf_dir, "part")
        wide = wide.join(parts, wide.l_partkey == parts.p_partkey, "left")
    return wide.select(*[rules[name][1].alias(name) for name in names])
