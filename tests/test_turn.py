import time

from tablecraft.operators import nulls, profile
from tablecraft.plans import loans as loan_plan
from tablecraft.sources.standin import loans


def test_filtered_profiles_plan_quickly(spark, sf_dir):
    cleaned = loan_plan.clean_loans(loans(spark, sf_dir), keep=["id"])
    start = time.time()
    for df in (nulls.null_counts(cleaned, sparse=True), profile.column_info(cleaned).where("non_null_count > 0")):
        df._jdf.queryExecution().optimizedPlan()
    assert time.time() - start < 10
