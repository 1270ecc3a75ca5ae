"""What must not grow with the table, or not be done twice."""

import pathlib
import time

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tablecraft import queries
from tablecraft.operators import features, models, trees
from tablecraft.plans import loans as loan_plan
from tablecraft.sources import release, stage


@pytest.fixture(scope="module")
def vectors(spark):
    rows = spark.range(4000).select(
        F.col("id").cast("string").alias("id"), (F.col("id") % 2).cast("double").alias("label"),
        (F.col("id") % 2).cast("double").alias("ClassLable"), (F.col("id") % 7).alias("a"), (F.col("id") % 3).alias("b"),
    )
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows.coalesce(1))


def per_partition(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]


def test_spread_bounds_rows_not_bytes(spark, vectors):
    cores = spark.sparkContext.defaultParallelism
    told = features.spread(vectors, "id", entries=400)  # 200 rows of two entries
    assert told.rdd.getNumPartitions() >= 20 and told.rdd.getNumPartitions() % cores == 0
    assert max(per_partition(told)) < 2 * 200
    assert sorted(r.id for r in told.select("id").collect()) == sorted(r.id for r in vectors.select("id").collect())
    assert features.spread(vectors, entries=400).count() == 4000
    assert features.spread(vectors.where("false"), "id").count() == 0


def fitted_partitions(monkeypatch, name):
    """Partitions of the rows that the estimator of ``name`` in models is given."""
    seen, make = [], getattr(models, name)

    class Told:
        def fit(self, df):
            seen.append(df.rdd.getNumPartitions())
            return make(maxDepth=2).fit(df)

    monkeypatch.setattr(models, name, Told)
    monkeypatch.setattr(features, "SPREAD_ENTRIES", 400)
    return seen


def test_importance_forest_is_fitted_on_bounded_partitions(spark, vectors, monkeypatch):
    seen = fitted_partitions(monkeypatch, "importance_forest")
    loan_plan.select_loan_features(vectors, vectors, key="id")
    assert seen[0] >= 20


@pytest.mark.parametrize("query,name", [("model_rf", "random_forest"), ("model_gbt", "boosted_trees"), ("feature_importance", "importance_forest")])
def test_tree_queries_are_fitted_on_bounded_partitions(spark, vectors, monkeypatch, query, name):
    seen = fitted_partitions(monkeypatch, name)
    monkeypatch.setattr(queries, "_vectors", lambda spark, sf_dir: (vectors, ["a", "b"]))
    assert queries.QUERIES[query](spark, "").count() >= 1
    assert seen[0] >= 14  # of 2,800 training rows


def test_a_vector_is_unfolded_once(spark, vectors):
    nodes = trees.stated_nodes(spark, [(0, 0, 0, 2.0, 1, 2), (0, 1, 1, 1.0, 3, 4), (0, 2, None, None, None, None), (0, 3, None, None, None, None), (0, 4, None, None, None, None)])
    nodes = trees.refit(vectors, nodes)
    scored = trees.forest_scores(vectors.withColumn("kept", F.col("features")), nodes)
    assert scored.columns == [*vectors.columns, "kept", "score"]
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("UDF(features") == 1 and scored.agg(F.avg("score")).first()[0] == pytest.approx(0.5, abs=0.01)


def test_loans_are_staged_narrow_and_where_they_lie(spark, sf_dir, monkeypatch):
    staged = {}

    def told(df, name, **options):
        staged[name] = (df.columns, options, df._jdf.queryExecution().executedPlan().toString())
        return real(df, name, **options)

    real = queries.stage
    monkeypatch.setattr(queries, "stage", told)
    monkeypatch.setattr(loan_plan, "stage", told)
    vectors, names = queries._vectors(spark, sf_dir)
    assert "id" in staged["loans"][0] and not {"url", "issue_d", "emp_title", "policy_code"} & set(staged["loans"][0])
    assert "hashpartitioning" not in staged["settled-loans"][2] and not staged["settled-loans"][1]
    assert vectors.count() and "loan_amnt" in names


@pytest.mark.parametrize("key", [None, "id"])
def test_spread_rows_are_written_once(vectors, key):
    """A fit asks for the plan of its rows again and again: it must not hold a shuffle."""
    told = features.spread(vectors.drop("label"), key, entries=400)
    assert "Exchange" not in told._jdf.queryExecution().executedPlan().toString()
    assert told.rdd.getNumPartitions() >= 20 and max(per_partition(told)) < 2 * 200
    assert told.schema["features"].metadata == vectors.schema["features"].metadata


def test_fit_rows_leave_the_key_out(vectors):
    assert "id" not in loan_plan.fit_rows(vectors, "id").columns and loan_plan.fit_rows(vectors).count() == 4000


def folder_of(df):
    return pathlib.Path(df.inputFiles()[0].removeprefix("file:").replace("///", "/")).parent


@pytest.mark.parametrize("query", ["loan_study", "feature_importance", "model_gbt", "feature_select"])
def test_spent_tables_are_deleted_before_the_fits(spark, sf_dir, monkeypatch, query):
    staged, left = {}, []

    def told(df, name, **options):
        made = real(df, name, **options)
        staged[name] = folder_of(made)
        return made

    def spread(df, *key):
        left.extend(name for name, folder in staged.items() if folder.exists())
        raise InterruptedError

    real = queries.stage
    monkeypatch.setattr(queries, "stage", told)
    monkeypatch.setattr(loan_plan, "stage", told)
    monkeypatch.setattr(features, "spread", spread)
    with pytest.raises(InterruptedError):
        queries.QUERIES[query](spark, sf_dir)
    assert set(staged) == {"loans", "settled-loans", "vectors"} and left == ["vectors"]


def test_release_deletes_staged_tables_only(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "given"))
    given, made = spark.read.parquet(str(tmp_path / "given")), stage(spark.range(5), "numbers")
    folder = folder_of(made)
    assert folder.exists()
    release(made.join(given, "id"))
    assert not folder.exists() and given.count() == 5


def shuffled(spark):
    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f.name for folder in local for f in pathlib.Path(folder).rglob("shuffle_*")}


def test_a_staged_table_leaves_no_shuffle_behind(spark):
    before = shuffled(spark)
    made = stage(spark.range(10_000).repartition(3, "id"), "numbers")
    until = time.time() + 20
    while shuffled(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled(spark) - before and made.count() == 10_000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
