"""DuckDB SQL for the registered queries, written apart from the Spark code.

Every statement starts from the given tables. The two stand-in tables (rules in FIXTURES.md) are the
common table expressions ``loans`` and ``shop``; ``events0`` is ``shop`` with its nulls filled.
"""

from __future__ import annotations

LOANS = """
loans as (
  select
    concat_ws('-', cast(l_orderkey as varchar), cast(l_partkey as varchar),
              cast(l_suppkey as varchar), cast(l_linenumber as varchar)) as id,
    strftime(l_shipdate, '%Y-%m') as issue_d,
    concat('loan/', concat_ws('-', cast(l_orderkey as varchar), cast(l_partkey as varchar),
              cast(l_suppkey as varchar), cast(l_linenumber as varchar))) as url,
    p_name as emp_title,
    1 as policy_code,
    case o_orderstatus when 'F' then 'Fully Paid' when 'P' then 'Charged Off' when 'O' then 'Current' end as loan_status,
    l_extendedprice as loan_amnt,
    concat(cast(cast(round(l_discount * 100) as int) as varchar), '%') as int_rate,
    l_quantity as installment,
    greatest(c_acctbal, 0.0) as annual_inc,
    l_tax * 100 as dti,
    case l_linestatus when 'F' then ' 36 months' when 'O' then ' 60 months' end as term,
    case when l_linenumber % 2 = 0 then 'f' else 'w' end as initial_list_status,
    case when l_suppkey % 5 = 0 then 'Joint App' else 'Individual' end as application_type,
    case when l_suppkey % 7 = 0 then 'y' else 'n' end as pymnt_plan,
    translate(substr(o_orderpriority, 1, 1), '12345', 'ABCDE') as grade,
    p_brand as sub_grade,
    c_mktsegment as home_ownership,
    l_returnflag as verification_status,
    p_type as purpose,
    n_name as addr_state,
    case p_size % 12 when 0 then '< 1 year' when 1 then '1 year' when 10 then '10+ years' when 11 then 'n/a'
      else concat(cast(p_size % 12 as varchar), ' years') end as emp_length,
    case when l_linenumber % 4 <> 0 then o_totalprice end as tot_cur_bal,
    case when l_linenumber % 4 <> 1 then l_quantity * 10 end as tot_coll_amt,
    case when l_partkey % 5 <> 0 then p_retailprice end as total_rev_hi_lim,
    case when l_returnflag = 'R' then l_quantity end as mths_since_rcnt_il,
    l_extendedprice * l_discount as total_pymnt,
    l_quantity + 600 as fico_range_low,
    'N' as hardship_flag
  from lineitem
  left join orders on l_orderkey = o_orderkey
  left join customer on o_custkey = c_custkey
  left join nation on c_nationkey = n_nationkey
  left join part on l_partkey = p_partkey
)"""

SHOP = """
single as (select *, cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as k from events),
keyed as (select * from single union all select * replace (event_id + 1000000000000 as event_id) from single where k % 20 = 3),
shop as (
  select
    event_id, ts as event_time,
    case event_type when 'click' then 'cart' else event_type end as event_type,
    k as product_id, k % 10 as category_id,
    case when k % 3 <> 0 then concat('c', cast(k % 10 as varchar)) end as category_code,
    case when k % 25 <> 0 then concat('Brand#', cast(k + 100 * (user_id % 3) as varchar)) end as brand,
    value as price, user_id,
    concat(cast(user_id as varchar), '-', strftime(ts, '%Y-%m-%d')) as user_session
  from keyed
),
events0 as (
  select
    event_id, event_time, coalesce(event_type, '0') as event_type, coalesce(product_id, 0) as product_id,
    coalesce(category_id, 0) as category_id, coalesce(brand, '0') as brand, coalesce(price, 0) as price,
    coalesce(user_id, 0) as user_id, coalesce(user_session, '0') as user_session
  from shop
)"""

IS_DEFAULT = (
    "case when loan_status in ('Default', 'Charged Off', 'Late (31-120 days)', 'Late (16-30 days)', "
    "'Does not meet the credit policy. Status:Charged Off') then 1 else 0 end"
)

YEARS = (
    "case emp_length when '1 year' then 1 when '2 years' then 2 when '3 years' then 3 when '4 years' then 4 "
    "when '5 years' then 5 when '6 years' then 6 when '7 years' then 7 when '8 years' then 8 when '9 years' then 9 "
    "when '10+ years' then 10 else 0 end"
)

CLEANED = f"""
cleaned as (
  select id, loan_status, cast(loan_amnt as float) as loan_amnt,
    try_cast(replace(int_rate, '%', '') as float) as int_rate, cast(installment as float) as installment,
    cast(annual_inc as float) as annual_inc, cast(dti as float) as dti, term, initial_list_status,
    application_type, pymnt_plan, grade, sub_grade, home_ownership, verification_status, purpose, addr_state,
    emp_length, fico_range_low, hardship_flag, {IS_DEFAULT} as "isDefault"
  from loans
  where (tot_cur_bal is not null or loan_status in ('Fully Paid', 'Charged Off'))
    and (tot_coll_amt is not null or loan_status in ('Fully Paid', 'Charged Off'))
)"""

LABELLED = f"""
labelled as (
  select id, {IS_DEFAULT} as "ClassLable" from loans where loan_status = 'Fully Paid' or loan_status = 'Charged Off'
)"""

WEIGHTED = """
weighted as (
  select *, round(case when "ClassLable" = 0 then share else 1 - share end, 12) as "weightColumn"
  from labelled, (select avg(case when "ClassLable" = 1 then 1 else 0 end) as share from labelled)
)"""

MARKED = f"""
marked as (
  select id, loan_amnt, {IS_DEFAULT} as label,
    case when loan_status = 'Current' then 100 else {IS_DEFAULT} end as "ClassLable"
  from loans
)"""

PREDICTED = f"""
predicted as (
  select cast({IS_DEFAULT} as double) as label, loan_amnt / (loan_amnt + 50000.0) as score,
    case when loan_amnt / (loan_amnt + 50000.0) >= 0.5 then 0.0::double else 1.0::double end as prediction
  from loans where loan_status in ('Fully Paid', 'Charged Off')
)"""

LOAN_NAMES = (
    "id issue_d url emp_title policy_code loan_status loan_amnt int_rate installment annual_inc dti term "
    "initial_list_status application_type pymnt_plan grade sub_grade home_ownership verification_status purpose "
    "addr_state emp_length tot_cur_bal tot_coll_amt total_rev_hi_lim mths_since_rcnt_il total_pymnt "
    "fico_range_low hardship_flag"
).split()
SHOP_NAMES = (
    "event_id event_time event_type product_id category_id category_code brand price user_id user_session"
).split()

# Levels of the one-hot columns in the test tables: column -> (level, name of the indicator).
LEVELS = {
    "grade": [(g, g) for g in "ABCDE"],
    "sub_grade": [(f"Brand#{i}", f"Brand_{i}") for i in range(1, 26)],
    "home_ownership": [(s, s) for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")],
    "verification_status": [(f, f) for f in ("A", "N", "R")],
    "purpose": [(t, t) for t in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")],
    "addr_state": [(f"NATION_{i}", f"NATION_{i}") for i in range(25)],
}
SPLIT = "cast(concat('0x', substr(md5(concat('1395:', id)), 1, 8)) as bigint) < 0.7 * 4294967296"
INDEXED = ["term", "initial_list_status", "application_type", "pymnt_plan"]


def _with(*parts: str) -> str:
    return "with " + ",".join(parts) + "\n"


def _null_counts(source: str, names: list[str]) -> str:
    counts = ", ".join(f"count(*) filter (where {n} is null) as {n}" for n in names)
    return (
        f'select "column", null_count from (select {counts} from {source}) '
        f'unpivot (null_count for "column" in ({", ".join(names)}))'
    )


def _flags(plain_names: bool = True) -> list[tuple[str, str]]:
    return [
        (f"coalesce(cast({c} = '{level}' as int), 0)", f'"{c}_{name if plain_names else level}"')
        for c, levels in LEVELS.items()
        for level, name in sorted(levels)
    ]


def _index(column: str, source: str) -> str:
    """Levels of a column numbered by falling frequency."""
    return (
        f"{column}_levels as (select {column}, cast(row_number() over (order by count(*) desc, {column}) - 1 as double) "
        f"as idx from {source} where {column} is not null group by {column})"
    )


def _first(keys: str, where: str = "true", source: str = "events0") -> str:
    return (
        f"select * exclude (rn) from (select *, row_number() over (partition by {keys} order by event_id) as rn "
        f"from {source} where {where}) where rn = 1"
    )


def _count(column: str, source: str, name: str = "count", where: str = "true") -> str:
    return f'select {column}, count(*) as "{name}" from {source} where {where} group by {column}'


def _describe(columns: list[str]) -> str:
    return "\nunion all\n".join(
        f"""select '{c}' as "column", count({c}) as "count", round(avg({c}), 6) as mean,
        round(stddev_samp({c}), 6) as std, cast(min({c}) as double) as "min",
        quantile_cont(cast({c} as double), 0.25) as q25, quantile_cont(cast({c} as double), 0.5) as q50,
        quantile_cont(cast({c} as double), 0.75) as q75, cast(max({c}) as double) as "max" from shop"""
        for c in columns
    )


def _correlation(columns: list[str]) -> str:
    return "\nunion all\n".join(
        f"select '{a}' as a, '{b}' as b, round(corr(cast({a} as double), cast({b} as double)), 6) as r from events0"
        for a in columns
        for b in columns
    )


_CONFUSION = """
select count(*) as total,
  count(*) filter (where label = prediction) as correct,
  count(*) filter (where label <> prediction) as wrong,
  count(*) filter (where label = 0 and prediction = 0) as tp,
  count(*) filter (where label = 1 and prediction = 1) as tn,
  count(*) filter (where label = {fn_label} and label <> prediction) as fn,
  count(*) filter (where label = {fp_label} and label <> prediction) as fp
from predicted"""
_CONFUSION_RIGHT = _CONFUSION.format(fn_label=0, fp_label=1)
_CONFUSION_COMPAT = _CONFUSION.format(fn_label=1, fp_label=0)

_RATIOS = """
select round(wrong / total::double, 9) as ratio_wrong, round(correct / total::double, 9) as ratio_correct,
  round((tp + tn) / total::double, 9) as accuracy,
  round(100 * tp / (tp + fp)::double, 9) as precision, round(100 * tp / (tp + fn)::double, 9) as recall,
  round(100 * 2 * tp / (2 * tp + fp + fn)::double, 9) as f1,
  round(100 * tp / (tp + fn)::double, 9) as sensitivity, round(100 * tn / (tn + fp)::double, 9) as specificity
from ({counts})"""

_WEIGHTED_F1 = """
select round(sum(actual * case when hits = 0 then 0 else 2.0 * (hits / predicted) * (hits / actual)
    / (hits / predicted + hits / actual) end) / sum(actual), 9) as weighted_f1
from (
  select c.label, cast(count(*) filter (where p.label = c.label) as double) as actual,
    cast(count(*) filter (where p.prediction = c.label) as double) as predicted,
    cast(count(*) filter (where p.label = c.label and p.prediction = c.label) as double) as hits
  from predicted p, (select distinct label from predicted) c group by c.label
)"""

_RANKED = """
groups as (
  select score, cast(sum(case when label = 0 then 1 else 0 end) as double) as pos,
    cast(sum(case when label <> 0 then 1 else 0 end) as double) as neg
  from predicted group by score
),
ranked as (
  select *, sum(pos) over w as pos_through, sum(neg) over w as neg_through,
    sum(pos) over () as pos_all, sum(neg) over () as neg_all
  from groups window w as (order by score desc rows between unbounded preceding and current row)
)"""

_SUMMARY = """
select "column", from_type, case
    when from_type = 'double' and low > -3.4028234663852886e38 and high < 3.4028234663852886e38 then 'float'
    when from_type = 'double' then 'double'
    when low > -128 and high < 127 then 'tinyint'
    when low > -32768 and high < 32767 then 'smallint'
    when low > -2147483648 and high < 2147483647 then 'int'
    else from_type end as to_type
from ("""


def _narrow_plan() -> str:
    kinds = {"product_id": "bigint", "category_id": "bigint", "price": "double", "user_id": "bigint"}
    return _with(SHOP) + _SUMMARY + " union all ".join(
        f"select '{c}' as \"column\", '{k}' as from_type, cast(min({c}) as double) as low, "
        f"cast(max({c}) as double) as high from shop" for c, k in kinds.items()
    ) + ")"


def _column_info() -> str:
    kinds = ["bigint", "timestamp_ntz", "string", "bigint", "bigint", "string", "string", "double", "bigint", "string"]
    rows = [
        f"select cast({i} as bigint) as position, '{n}' as \"column\", '{k}' as type, "
        f"{'false' if n == 'user_session' else 'true'} as nullable, count({n}) as non_null_count from shop"
        for i, (n, k) in enumerate(zip(SHOP_NAMES, kinds))
    ]
    return _with(SHOP) + "\nunion all\n".join(rows)


def _encoded() -> str:
    """Settled loans as the numbers that go into the feature vector, with label and weight."""
    numbers = ["loan_amnt", "int_rate", "installment", "annual_inc", "dti"]
    joins = " ".join(f"left join {c}_levels using ({c})" for c in INDEXED)
    parts = [f"cast({n} as double) as {n}" for n in numbers]
    parts += [f'{c}_levels.idx as "{c}Index"' for c in INDEXED]
    parts += [f"cast({flag} as double) as {name}" for flag, name in _flags(False)]
    parts += [f'cast({YEARS} as double) as "emp_lengthIndex"']
    return ",".join(
        [
            "settled as (select * from cleaned where loan_status in ('Fully Paid', 'Charged Off'))",
            *[_index(c, "settled") for c in INDEXED],
            'share as (select avg("isDefault") as r from settled)',
            'label_levels as (select "isDefault", cast(row_number() over (order by count(*) desc, "isDefault") - 1 '
            'as double) as label from settled group by "isDefault")',
            f"""encoded as (select id, label, case when "isDefault" = 0 then r else 1 - r end as weight,
            {", ".join(parts)} from settled join label_levels using ("isDefault") cross join share {joins})""",
            f"train as (select * from encoded where {SPLIT})",
            f"test as (select * from encoded where not ({SPLIT}))",
        ]
    )


def _feature_names() -> list[str]:
    return (
        ["loan_amnt", "int_rate", "installment", "annual_inc", "dti"]
        + [f'"{c}Index"' for c in INDEXED]
        + [name for _, name in _flags(False)]
        + ['"emp_lengthIndex"']
    )


def _bayes() -> str:
    """The parameters of naive Bayes: smoothed logs of the class shares and of the weighted sums."""
    names = _feature_names()
    sums = ", ".join(f"sum(weight * {n}) as {n}" for n in names)
    return _with(LOANS, CLEANED, _encoded()) + f"""
, sums as (select label, sum(weight) as mass, {sums} from train group by label),
long as (select label, feature, total from sums unpivot (total for feature in ({", ".join(names)}))),
theta as (
  select label as class, feature,
    ln(total + 50) - ln(sum(total) over (partition by label) + 50 * {len(names)}) as log_probability
  from long
),
prior as (select label as class, ln(mass + 50) - ln(sum(mass) over () + 50 * count(*) over ()) as log_probability from sums)
"""


def _bayes_parameters() -> str:
    return _bayes() + """
select class as "class", feature, round(log_probability, 6) as log_probability from theta
union all
select class, '(share)', round(log_probability, 6) from prior"""


def _bayes_card() -> str:
    """Score the test rows with those parameters and make every figure of the scorecard."""
    long = ", ".join(_feature_names())
    ratios = _RATIOS.format(counts=_CONFUSION_RIGHT)
    return _bayes() + f"""
, numbered as (select row_number() over (order by id) as line, * exclude (id) from test),
entries as (select line, label, feature, x from numbered unpivot (x for feature in ({long}))),
scores as (
  select label, sum(case when class = 0 then x * log_probability end) as s0,
    sum(case when class = 1 then x * log_probability end) as s1
  from entries join theta using (feature) group by line, label
),
posterior as (
  select label, s0 + (select log_probability from prior where class = 0) as s0,
    s1 + (select log_probability from prior where class = 1) as s1 from scores
),
predicted as (
  select label, exp(s0 - greatest(s0, s1)) / (exp(s0 - greatest(s0, s1)) + exp(s1 - greatest(s0, s1))) as score,
    case when s0 >= s1 then 0.0::double else 1.0::double end as prediction
  from posterior
),{_RANKED}
select * from ({_CONFUSION_RIGHT}), ({ratios}), ({_WEIGHTED_F1}),
  (select round(sum(neg * (pos_through - pos / 2)) / (max(pos_all) * max(neg_all)), 6) as auc from ranked)"""


def _model_facts() -> str:
    """Test rows and positives; the figures of a fit are held against Spark's evaluators."""
    return _with(LOANS, CLEANED, _encoded()) + """
select count(*) as total, count(*) filter (where label = 0) as positives,
  true as accuracy_agrees, true as weighted_f1_agrees, true as auc_agrees from test"""


DESCRIBED = ["product_id", "category_id", "price", "user_id"]

ORACLE_SQL: dict[str, str] = {
    # sources and sinks
    "csv_scan": _with(LOANS) + "select id, loan_status, term, loan_amnt, tot_cur_bal from loans where tot_cur_bal is not null",
    "clean_scan": _with(LOANS, MARKED) + 'select id, loan_amnt, "ClassLable" from marked where "ClassLable" <> 100',
    "events_scan": _with(SHOP) + "select * replace (strftime(event_time, '%Y-%m-%d %H:%M:%S UTC') as event_time) from shop",
    "clean_roundtrip": _with(LOANS, CLEANED) + "select * from cleaned",
    "csv_scan_inferred": _with(LOANS) + "select id, loan_status, term, loan_amnt, dti, tot_cur_bal, p as policy_code from "
    "(select *, cast(policy_code as integer) as p from loans)",
    # profiles
    "shape": _with(LOANS) + f"select count(*) as row_count, cast({len(LOAN_NAMES)} as bigint) as column_count from loans",
    "preview": _with(SHOP) + "select * from shop order by event_id limit 20",
    "column_info": _column_info(),
    "describe": _with(SHOP) + _describe(DESCRIBED),
    "box_stats": _with(SHOP) + """, q as (
  select quantile_cont(price, 0.25) as q25, quantile_cont(price, 0.5) as q50, quantile_cont(price, 0.75) as q75 from events0
)
select q25, q50, q75,
  min(price) filter (where price between q25 - 1.5 * (q75 - q25) and q75 + 1.5 * (q75 - q25)) as whisker_low,
  max(price) filter (where price between q25 - 1.5 * (q75 - q25) and q75 + 1.5 * (q75 - q25)) as whisker_high,
  count(*) filter (where price not between q25 - 1.5 * (q75 - q25) and q75 + 1.5 * (q75 - q25)) as outliers
from events0, q group by q25, q50, q75""",
    "correlation_matrix": _with(SHOP) + _correlation(DESCRIBED),
    # nulls
    "null_counts_sparse": _with(LOANS) + f"select * from ({_null_counts('loans', LOAN_NAMES)}) where null_count > 0",
    "null_counts_dense": _with(SHOP) + _null_counts("shop", SHOP_NAMES),
    "sparse_columns": _with(LOANS) + f"""
select "column", null_count, row_count from ({_null_counts('loans', LOAN_NAMES)}), (select count(*) as row_count from loans)
where null_count > 0.5 * row_count""",
    "drop_sparse": _with(LOANS) + "select * exclude (mths_since_rcnt_il) from loans",
    "null_mask": _with(SHOP) + "select event_id, " + ", ".join(f"{n} is null as {n}" for n in SHOP_NAMES[1:]) + " from shop",
    "fill_zero_when": _with(LOANS) + """
select id, loan_status,
  case when tot_cur_bal is null and loan_status in ('Fully Paid', 'Charged Off') then 0 else tot_cur_bal end as tot_cur_bal,
  case when tot_coll_amt is null and loan_status in ('Fully Paid', 'Charged Off') then 0 else tot_coll_amt end as tot_coll_amt
from loans""",
    "mean_impute": _with(LOANS) + """
select id, coalesce(total_rev_hi_lim, (select trunc(avg(total_rev_hi_lim)) from loans)) as total_rev_hi_lim from loans""",
    "drop_any_null": _with(LOANS) + """
select id, loan_status, tot_cur_bal, total_rev_hi_lim from loans
where tot_cur_bal is not null and total_rev_hi_lim is not null and loan_status is not null""",
    "fill_zero": _with(SHOP) + "select event_id, event_time, event_type, product_id, category_id, "
    "coalesce(category_code, '0') as category_code, coalesce(brand, '0') as brand, price, user_id, user_session from shop",
    "cart_users_complete": _with(SHOP) + "select * exclude (category_code) from ("
    + _first("user_id", "event_type in ('cart', 'purchase')", "shop") + ") where brand is not null",
    # projections and derived columns
    "drop_columns": _with(LOANS) + "select * exclude (issue_d, url, emp_title, policy_code, total_pymnt, tot_coll_amt, "
    "tot_cur_bal, total_rev_hi_lim) from loans",
    "cast_float": _with(LOANS) + """
select id, cast(loan_amnt as float) as loan_amnt, cast(installment as float) as installment,
  cast(annual_inc as float) as annual_inc, cast(dti as float) as dti,
  try_cast(replace(int_rate, '%', '') as float) as int_rate, cast(mths_since_rcnt_il as float) as mths_since_rcnt_il
from loans""",
    "cast_float_strict": _with(LOANS) + "select id, try_cast(int_rate as float) as int_rate, cast(dti as float) as dti from loans",
    "label_rename": _with(LOANS) + f'select id, loan_status, {IS_DEFAULT} as "ClassLable" from loans',
    "default_label": _with(LOANS) + f'select id, loan_status, {IS_DEFAULT} as "isDefault" from loans',
    "emp_length_ordinal": _with(LOANS) + f'select id, emp_length, {YEARS} as "emp_lengthIndex" from loans',
    "event_day_text": _with(SHOP) + "select event_id, event_time, strftime(event_time, '%Y-%m-%d') as event_day from shop",
    "event_date": _with(SHOP) + "select event_id, event_time, cast(event_time as date) as event_date from shop",
    "event_day_of_text": _with(SHOP) + "select event_id, strftime(event_time, '%Y-%m-%d %H:%M:%S UTC') as event_time, "
    "strftime(event_time, '%Y-%m-%d') as event_day from shop",
    "event_date_of_text": _with(SHOP) + "select event_id, strftime(event_time, '%Y-%m-%d %H:%M:%S UTC') as event_time, "
    "cast(event_time as date) as event_date from shop",
    "narrow_plan": _narrow_plan(),
    "narrow_types": _with(SHOP) + "select * exclude (event_id) replace (cast(product_id as tinyint) as product_id, "
    "cast(category_id as tinyint) as category_id, cast(price as float) as price, cast(user_id as smallint) as user_id) from events0",
    # filters
    "loan_status_filter": _with(LOANS) + "select id, loan_status from loans where loan_status in ('Fully Paid', 'Charged Off')",
    "not_equal_filter": _with(LOANS, MARKED) + 'select id, "ClassLable" from marked where "ClassLable" <> 100',
    "bad_label_audit": _with(LOANS, MARKED) + 'select id, "ClassLable" from marked where "ClassLable" > 99',
    "isin_filter": _with(SHOP) + "select * from events0 where event_type in ('cart', 'purchase')",
    # joins
    "active_user_events": _with(SHOP) + "select * from events0 where user_id in "
    "(select user_id from events0 where event_type in ('cart', 'purchase'))",
    # reports
    "value_counts": _with(LOANS, CLEANED) + _count("loan_status", "cleaned"),
    "value_counts_grade": _with(LOANS, CLEANED) + _count("grade", "cleaned", where="loan_status in ('Fully Paid', 'Charged Off')"),
    "value_counts_sub_grade": _with(LOANS, CLEANED) + _count("sub_grade", "cleaned", where="loan_status in ('Fully Paid', 'Charged Off')"),
    "value_counts_null_key": _with(LOANS) + _count("mths_since_rcnt_il", "loans"),
    "class_counts": _with(LOANS, LABELLED) + _count('"ClassLable"', "labelled"),
    "class_weights": _with(LOANS, LABELLED, WEIGHTED) + 'select id, "ClassLable", "weightColumn" from weighted',
    "weight_counts": _with(LOANS, LABELLED, WEIGHTED) + _count('"weightColumn"', "weighted"),
    "event_type_counts": _with(SHOP) + _count("event_type", "events0"),
    "brand_counts": _with(SHOP) + _count("brand", "events0"),
    "visitors_by_date": _with(SHOP) + "select strftime(event_time, '%Y-%m-%d') as day, count(distinct user_id) as visitors "
    "from events0 group by 1",
    "visitors_by_date_of_text": _with(SHOP) + "select strftime(event_time, '%Y-%m-%d') as day, "
    "count(distinct user_id) as visitors from events0 group by 1",
    "brand_column_counts": _with(SHOP) + "select brand, "
    + ", ".join(f"count({n}) as {n}" for n in SHOP_NAMES[1:] if n not in ("brand", "category_code"))
    + " from events0 group by brand",
    "brand_user_counts": _with(SHOP) + "select brand, count(user_id) as user_count from events0 group by brand",
    "user_sums": _with(SHOP) + "select user_id, cast(sum(product_id) as bigint) as product_id, cast(sum(category_id) as bigint) as category_id, "
    "cast(sum(cast(price as decimal(18,6))) as double) as price from events0 group by user_id",
    "mean_price_by_product": _with(SHOP) + "select product_id, round(avg(price), 6) as mean_price from events0 group by product_id",
    "conversion_rates": _with(SHOP) + """, counts as (
  select count(*) filter (where event_type = 'view') as views, count(*) filter (where event_type = 'cart') as carts,
    count(*) filter (where event_type = 'purchase') as purchases from events0
)
select *, purchases::double / nullif(views, 0) * 100 as view_to_purchase_pct,
  carts::double / nullif(views, 0) * 100 as view_to_cart_pct,
  purchases::double / nullif(carts, 0) * 100 as cart_to_purchase_pct from counts""",
    "activity_per_user": _with(SHOP) + """
select user_id, count(event_type) as activity_count from events0
where user_id in (select user_id from events0 where event_type in ('cart', 'purchase')) group by user_id""",
    "activity_per_session": _with(SHOP) + """
select user_session, count(event_type) as activity_count from events0
where user_id in (select user_id from events0 where event_type in ('cart', 'purchase')) group by user_session""",
    "event_type_share": _with(SHOP) + """
select event_type, count(*) as "count", count(*)::double / (select count(*) from events0) * 100 as share_pct
from events0 group by event_type""",
    "brand_share": _with(SHOP) + """
select brand, count(*) as "count", count(*)::double / (select count(*) from events0) * 100 as share_pct
from events0 group by brand""",
    "top_brands": _with(SHOP) + _count("brand", "events0") + ' order by "count" desc, brand limit 50',
    "top_purchase_brands": _with(SHOP)
    + _count("brand", "(select distinct * exclude (event_id) from events0 where event_type = 'purchase')")
    + ' order by "count" desc, brand limit 70',
    # duplicates
    "duplicate_mask": _with(SHOP) + """
select *, row_number() over (partition by event_time, event_type, product_id, category_id, brand, price, user_id, user_session
    order by event_id) > 1 as is_duplicate from (select * exclude (category_code) from shop)""",
    "drop_duplicates": _with(SHOP) + "select distinct * exclude (event_id, category_code) from shop",
    "first_per_event_type": _with(SHOP) + _first("event_type", source="(select * exclude (category_code) from shop)"),
    "first_per_price": _with(SHOP) + _first("price"),
    "cart_purchase_users": _with(SHOP) + _first("user_id", "event_type in ('cart', 'purchase')"),
    "purchase_brand_counts": _with(SHOP)
    + _count("brand", "(select distinct * exclude (event_id) from events0 where event_type = 'purchase')"),
    "unique_values": _with(SHOP) + """
select distinct 'product_id' as "column", product_id as "value" from events0
union all select distinct 'category_id', category_id from events0
union all select distinct 'user_id', user_id from events0""",
    # features
    "string_index": _with(LOANS, *[_index(c, "loans") for c in INDEXED])
    + "select id, " + ", ".join(f'{c}_levels.idx as "{c}Index"' for c in INDEXED)
    + " from loans " + " ".join(f"left join {c}_levels using ({c})" for c in INDEXED),
    "string_index_wide": _with(LOANS, _index("id", "loans")) + 'select id, id_levels.idx as "idIndex" from loans left join id_levels using (id)',
    "one_hot": _with(LOANS) + "select id, " + ", ".join(f"{flag} as {name}" for flag, name in _flags()) + " from loans",
    "assemble": _with(LOANS) + "select id, loan_amnt as features_0, installment as features_1, annual_inc as features_2, "
    "dti as features_3 from loans",
    "label_index": _with(LOANS, LABELLED) + """
select id, "ClassLable", idx as label from labelled join (
  select "ClassLable", cast(row_number() over (order by count(*) desc, "ClassLable") - 1 as double) as idx
  from labelled group by "ClassLable") using ("ClassLable")""",
    "split_hash": _with(LOANS, LABELLED) + f"select id, {SPLIT} as in_train from labelled",
    "split_random": _with(LOANS, LABELLED) + 'select "ClassLable", count(*) as "count", 0::bigint as overlap from labelled group by 1',
    "feature_importance": "select * from (values "
    + ", ".join(f"({i}, '{n.strip(chr(34))}', true, true)" for i, n in enumerate(_feature_names()))
    + ") as v(idx, feature, sums_to_one, nodes_agree)",
    "feature_select": _with(LOANS, CLEANED, _encoded()) + "select id, label, true as same_entries from encoded",
    # models
    "model_lr": _model_facts(),
    "model_rf": _model_facts(),
    "model_gbt": _model_facts(),
    "nb_parameters": _bayes_parameters(),
    "model_nb": _bayes_card(),
    # evaluation
    "metric_accuracy": _with(LOANS, PREDICTED)
    + "select count(*) filter (where label = prediction)::double / count(*) as accuracy from predicted",
    "metric_weighted_f1": _with(LOANS, PREDICTED) + _WEIGHTED_F1,
    "confusion_counts": _with(LOANS, PREDICTED) + _CONFUSION_RIGHT,
    "confusion_counts_compat": _with(LOANS, PREDICTED) + _CONFUSION_COMPAT,
    "classification_metrics": _with(LOANS, PREDICTED) + _RATIOS.format(counts=_CONFUSION_RIGHT),
    "classification_metrics_compat": _with(LOANS, PREDICTED) + _RATIOS.format(counts=_CONFUSION_COMPAT),
    "roc_points": _with(LOANS, PREDICTED, _RANKED) + """
select 0.0::double as fpr, 0.0::double as tpr, null::double as threshold
union all
select neg_through / neg_all, pos_through / pos_all, score from ranked""",
    "roc_auc": _with(LOANS, PREDICTED, _RANKED)
    + "select round(sum(neg * (pos_through - pos / 2)) / (max(pos_all) * max(neg_all)), 9) as auc from ranked",
}

ORACLE_SQL["correlation_tiles"] = ORACLE_SQL["correlation_matrix"]
ORACLE_SQL["shape_from_footers"] = ORACLE_SQL["shape"]
ORACLE_SQL["narrow_plan_from_footers"] = ORACLE_SQL["narrow_plan"]
ORACLE_SQL["column_counts_from_footers"] = _with(LOANS) + "\nunion all\n".join(
    f"select '{n}' as \"column\", count({n}) as non_null_count from loans" for n in LOAN_NAMES
)
ORACLE_SQL["roc_points_thinned"] = _with(LOANS, PREDICTED, _RANKED) + """
select 0.0::double as fpr, 0.0::double as tpr, null::double as threshold
union all
select neg_through / neg_all, pos_through / pos_all, score from (
  select *, lead(pos) over w as next_pos, lead(neg) over w as next_neg, row_number() over w as place
  from ranked window w as (order by score desc))
where place = 1 or next_pos is null or next_pos <> pos or next_neg <> neg"""
ORACLE_SQL["active_user_events_reduced"] = ORACLE_SQL["active_user_events"]
for _key in ("active_user_events", "user_sums", "activity_per_user", "cart_purchase_users"):
    ORACLE_SQL[f"bucketed_{_key}"] = ORACLE_SQL[_key]
_LINES = """, lines as (
  select id, loan_status, term, right(id, 1) as line, cast(cast(loan_amnt as decimal(18,2)) as varchar) as amount,
    coalesce(cast(cast(tot_cur_bal as decimal(18,2)) as varchar), 'unknown') as balance from loans),
records as (
  select *, concat_ws(',', id, loan_status, term, amount || case when line = '5' then ' USD' else '' end,
    case when line <> '6' then balance end) || case when line = '7' then ',more' else '' end as record from lines)
"""
ORACLE_SQL["csv_rejects"] = _with(LOANS) + _LINES + """
select record, null::varchar as "column", null::varchar as "value", 'number of fields' as reason from records where line in ('6', '7')
union all select record, 'loan_amnt', amount || ' USD', 'not double' from records where line = '5'
union all select record, 'tot_cur_bal', balance, 'not double' from records where line not in ('6', '7') and balance = 'unknown'"""
ORACLE_SQL["csv_kept"] = _with(LOANS) + _LINES + """
select id, loan_status, term, cast(amount as double) as loan_amnt, cast(balance as double) as tot_cur_bal
from records where line not in ('5', '6', '7') and balance <> 'unknown'"""
ORACLE_SQL["csv_totals"] = _with(LOANS) + _LINES + """
select count(*) as lines, count(*) filter (where line not in ('5', '6', '7') and balance <> 'unknown') as kept,
  count(*) filter (where line in ('5', '6', '7') or balance = 'unknown') as rejected from records"""

ORACLE_SQL["describe_sketch"] = _with(SHOP) + "\nunion all\n".join(
    f"""select '{c}' as "column", count({c}) as "count", round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as std,
    cast(min({c}) as double) as "min", cast(max({c}) as double) as "max", true as ranks_proven from shop"""
    for c in DESCRIBED
)
ORACLE_SQL["describe_by_month"] = _with(SHOP) + "\nunion all\n".join(
    f"""select strftime(event_time, '%Y-%m') as month, '{c}' as "column", count({c}) as "count", round(avg({c}), 6) as mean,
    round(stddev_samp({c}), 6) as std, cast(min({c}) as double) as "min", cast(max({c}) as double) as "max" from shop group by 1"""
    for c in DESCRIBED
)
ORACLE_SQL["visitors_by_range"] = _with(SHOP) + """, seen as (select distinct cast(event_time as date) as day, user_id from events0),
weeks as (select distinct cast(day - interval 6 day as date) as first_day, day as last_day from seen)
select first_day, last_day, count(distinct user_id) as visitors, true as within_error
from weeks join seen on day between first_day and last_day group by 1, 2"""
ORACLE_SQL["heavy_brands"] = ORACLE_SQL["top_brands"]
ORACLE_SQL["heavy_purchase_brands"] = ORACLE_SQL["top_purchase_brands"]
ORACLE_SQL["heavy_users"] = _with(SHOP) + _count("user_id", "events0") + ' order by "count" desc, user_id limit 50'

# The stated trees as one expression a tree: the leaf that a row reaches.
_LEAVES = """case when loan_amnt <= 40000 then case when dti <= 4 then 3 else 4 end else case when "grade_A" <= 0.5 then 5 else 6 end end as leaf0,
  case when "grade_B" <= 0.5 then case when "termIndex" <= 0.5 then 3 else case when installment <= 25 then 5 else 6 end end else 2 end as leaf1"""
_FOREST = _with(LOANS, CLEANED, _encoded()) + f""",
ways(tree, leaf, node) as (values (0,3,0),(0,3,1),(0,3,3),(0,4,0),(0,4,1),(0,4,4),(0,5,0),(0,5,2),(0,5,5),(0,6,0),(0,6,2),(0,6,6),
  (1,2,0),(1,2,2),(1,3,0),(1,3,1),(1,3,3),(1,5,0),(1,5,1),(1,5,4),(1,5,5),(1,6,0),(1,6,1),(1,6,4),(1,6,6)),
kids(tree, node, a, b) as (values (0,0,1,2),(0,1,3,4),(0,2,5,6),(1,0,1,2),(1,1,3,4),(1,4,5,6)),
splits(tree, node, feature) as (values (0,0,'loan_amnt'),(0,1,'dti'),(0,2,'grade_A'),(1,0,'grade_B'),(1,1,'termIndex'),(1,4,'installment')),
reached as (select label, {_LEAVES} from train),
landed as (select 0 as tree, leaf0 as leaf, label from reached union all select 1, leaf1, label from reached),
stats as (
  select w.tree, w.node, count(*) filter (where label = 0) as n0, count(*) filter (where label = 1) as n1
  from (select distinct tree, node from ways) w left join (select tree, node, label from landed join ways using (tree, leaf)) a
    on w.tree = a.tree and w.node = a.node group by 1, 2),
sized as (
  select *, n0 + n1 as n, case when n0 + n1 > 0 then 1 - (n0::double * n0 + n1::double * n1) / ((n0 + n1)::double * (n0 + n1)) else 0 end as impurity
  from stats),
nodes as (
  select s.tree, s.node, s.n0, s.n1, s.n,
    case when k.node is not null then coalesce(s.impurity - (a.n * a.impurity + b.n * b.impurity) / nullif(s.n, 0), 0) end as gain,
    case when s.n > 0 then case when s.n0 >= s.n1 then 0.0::double else 1.0::double end end as prediction
  from sized s left join kids k using (tree, node) left join sized a on a.tree = s.tree and a.node = k.a
    left join sized b on b.tree = s.tree and b.node = k.b)
"""
ORACLE_SQL["forest_nodes"] = _FOREST + "select tree, node, n0, n1, round(gain, 9) as gain, prediction from nodes"
ORACLE_SQL["forest_importances"] = _FOREST + """,
parts as (select tree, feature, gain * n as part from nodes join splits using (tree, node)),
shares as (select feature, sum(part / whole) as share from parts join (select tree, sum(part) as whole from parts group by 1) using (tree) group by 1)
select feature, round(share / (select sum(share) from shares), 9) as score from shares"""
ORACLE_SQL["forest_scorecard"] = _FOREST + f""",
tested as (select label, {_LEAVES} from test),
predicted as (
  select label, score, case when raw >= 0.5 then 0.0::double else 1.0::double end as prediction from (
    select label, (a.n0 / a.n::double + b.n0 / b.n::double) / 2 as raw, round((a.n0 / a.n::double + b.n0 / b.n::double) / 2, 12) as score
    from tested t join nodes a on a.tree = 0 and a.node = t.leaf0 join nodes b on b.tree = 1 and b.node = t.leaf1)),{_RANKED}
select * from ({_CONFUSION_RIGHT}), ({_RATIOS.format(counts=_CONFUSION_RIGHT)}), ({_WEIGHTED_F1}),
  (select round(sum(neg * (pos_through - pos / 2)) / (max(pos_all) * max(neg_all)), 9) as auc from ranked)"""


def _gradient() -> str:
    names = _feature_names()
    tops = ", ".join(f"greatest(1.0, max({n})) as t{i}" for i, n in enumerate(names))
    margin = " + ".join(f"({(7 * i) % 11 - 5}) / 10.0 / t{i} * {n}" for i, n in enumerate(names))
    slopes = " union all ".join(
        f"select {i} as idx, '{n.strip(chr(34))}' as feature, sum(e * {n}) / sum(weight) as gradient, sum(l) / sum(weight) as loss from told"
        for i, n in enumerate(names)
    )
    return _with(LOANS, CLEANED, _encoded()) + f""", tops as (select {tops} from train),
margins as (select train.*, 0.25 + {margin} as m from train cross join tops),
told as (select *, weight * (1 / (1 + exp(-m)) - label) as e,
  weight * (greatest(m, 0) + ln(1 + exp(-abs(m))) - label * m) as l from margins)
select idx, feature, round(gradient, 6) as gradient, round(loss, 6) as loss from ({slopes}
  union all select {len(names)}, '(intercept)', sum(e) / sum(weight), sum(l) / sum(weight) from told)"""


ORACLE_SQL["logistic_gradient"] = _gradient()
_CARD = "total correct wrong tp tn fn fp ratio_wrong ratio_correct accuracy precision recall f1 sensitivity specificity weighted_f1 auc".split()
ORACLE_SQL["loan_study"] = f"""
select model, figure, value from (select m.model, c.* from (
  select total::double as total, (tp + fn)::double as positives, (tn + fp)::double as negatives from ({_bayes_card()})) c,
  (values ('logistic_regression'), ('random_forest'), ('boosted_trees'), ('naive_bayes')) as m(model))
  unpivot (value for figure in (total, positives, negatives))
union all
select 'naive_bayes', figure, round(value, 9) from (select {", ".join(f'{c}::double as {c}' for c in _CARD)} from ({_bayes_card()}))
  unpivot (value for figure in ({", ".join(c for c in _CARD if c != "total")}))"""

_REPORT_SQL = {
    "event_types": ("event_type_counts", "event_type", "count"),
    "event_type_shares": ("event_type_share", "event_type", "share_pct"),
    "brands": ("brand_counts", "brand", "count"),
    "brand_shares": ("brand_share", "brand", "share_pct"),
    "brand_users": ("brand_user_counts", "brand", "user_count"),
    "top_brands": ("top_brands", "brand", "count"),
    "top_purchase_brands": ("top_purchase_brands", "brand", "count"),
    "visitors": ("visitors_by_date", "day", "visitors"),
    "activity_per_user": ("activity_per_user", "user_id", "activity_count"),
    "activity_per_session": ("activity_per_session", "user_session", "activity_count"),
    "user_sums": ("user_sums", "user_id", "product_id"),
    "user_category_sums": ("user_sums", "user_id", "category_id"),
    "user_price_sums": ("user_sums", "user_id", "price"),
    "product_prices": ("mean_price_by_product", "product_id", "mean_price"),
}
_RATES = ["views", "carts", "purchases", "view_to_purchase_pct", "view_to_cart_pct", "cart_to_purchase_pct"]
ORACLE_SQL["shop_reports"] = "\nunion all\n".join(
    [
        f"select '{'user_sums' if source == 'user_sums' else report}' as report, '{value}' as figure, cast({key} as varchar) as key, cast(\"{value}\" as double) as \"value\" "
        f"from ({ORACLE_SQL[source]})"
        for report, (source, key, value) in _REPORT_SQL.items()
    ]
    + [f"select 'conversion', '{value}', 'all', cast({value} as double) from ({ORACLE_SQL['conversion_rates']})" for value in _RATES]
)
