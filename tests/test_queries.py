"""Every registered query against its SQL counterpart, and the shape of its plan."""

import pytest

import __spark_entry__ as contract
from tests.compare import connect, differences

# The training-data queries are tested in a folder of their own.
QUERIES = {k: f for k, f in contract.queries().items() if k not in contract.MORE_QUERIES}
SQL = {k: s for k, s in contract.oracle_sql().items() if k in QUERIES}
# The SQL of this key names the types chosen at sf0.01.
TYPES_DEPEND_ON_SCALE = {"narrow_types"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = connect(sf_dir)
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("key", sorted(SQL))
def test_matches_sql(spark, duck, sf_dir, key):
    df = QUERIES[key](spark, sf_dir)
    found = differences(df, duck, SQL[key])
    if key in TYPES_DEPEND_ON_SCALE:
        found = [f for f in found if not f.startswith("type of")]
    assert found == []
    check_plan(df, bounded_windows=key in {"roc_points", "roc_points_thinned", "roc_auc"})


def test_limits_cut_rows(spark, sf_dir):
    assert QUERIES["top_brands"](spark, sf_dir).count() == 50 < QUERIES["brand_counts"](spark, sf_dir).count()
    assert QUERIES["top_purchase_brands"](spark, sf_dir).count() == 70 < QUERIES["purchase_brand_counts"](spark, sf_dir).count()
    assert QUERIES["duplicate_mask"](spark, sf_dir).where("is_duplicate").count() > 0


def check_plan(df, bounded_windows):
    """The executed plan stays in the JVM and has no cross join. Only the windows over one row per
    score range may lack a partition key."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("PythonRDD", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "NestedLoop"):
        assert bad not in plan
    if not bounded_windows:
        assert all("], [], [" not in line for line in plan.splitlines() if " Window [" in line)


def test_entry(spark):
    assert contract.entry(spark).count() == 1
