"""Forests and coefficients as tables, against MLlib and against DuckDB on the same tables."""

import duckdb
import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tablecraft.operators import features, linear, trees
from tests.test_plans import plan


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(1)
    n = 1500
    x = np.stack([rng.normal(size=n), rng.integers(0, 4, n), rng.exponential(size=n), rng.integers(0, 2, n)], axis=1)
    y = (x[:, 0] + (x[:, 1] == 2) * 2 - x[:, 2] + rng.normal(size=n) > 0).astype(float)
    rows = [(i, *map(float, r), float(t), float(1 + i % 3)) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id int, a double, kind string, c double, flag double, label double, w double")
    df = features.index_strings(df, ["kind"], {"kind": [("2.0", 4), ("0.0", 3), ("1.0", 2), ("3.0", 1)]})
    return VectorAssembler(inputCols=["a", "kindIndex", "c", "flag"], outputCol="features").transform(df).select("id", "label", "w", "features").cache()


def walked(nodes, df, tmp_path):
    """The leaf of every row and tree by a recursive query in DuckDB."""
    nodes.write.parquet(str(tmp_path / "nodes"))
    df.select("id", vector_to_array("features").alias("x")).write.parquet(str(tmp_path / "rows"))
    con = duckdb.connect()
    con.execute(f"create table nodes as select * from '{tmp_path}/nodes/*.parquet'")
    con.execute(f"create table given as select * from '{tmp_path}/rows/*.parquet'")
    con.execute("""create table reached as with recursive w as (
      select id, x, tree, 0 as at from given, (select distinct tree from nodes)
      union all
      select id, x, w.tree, case when (n.categories is null and x[n.feature + 1] <= n.threshold)
        or list_contains(n.categories, x[n.feature + 1]) then n."left" else n."right" end
      from w join nodes n on w.tree = n.tree and w.at = n.node where n.feature is not null)
    select id, w.tree, n.stats, n.prediction, n.weight from w join nodes n on w.tree = n.tree and w.at = n.node where n.feature is null""")
    return con


def test_forest_as_a_table(spark, vectors, tmp_path):
    model = RandomForestClassifier(numTrees=5, maxDepth=6, seed=3).fit(vectors)
    nodes = trees.node_table(model)
    assert nodes.where("categories is not null").count() > 0 and nodes.where("feature is null").count() > 5
    ours = {r.id: r.score for r in trees.forest_scores(vectors, nodes).collect()}
    mllib = {r.id: r.p for r in model.transform(vectors).select("id", vector_to_array("probability")[0].alias("p")).collect()}
    con = walked(nodes, vectors, tmp_path)
    duck = dict(con.execute("select id, avg(stats[1] / list_sum(stats)) from reached group by id").fetchall())
    assert len(ours) == 1500
    for k, v in ours.items():
        assert v == pytest.approx(mllib[k], abs=1e-12) == duck[k]
    scores = {r.feature: r.score for r in trees.importances(nodes).collect()}
    in_duck = dict(con.execute("""with p as (select tree, feature, sum(gain * list_sum(stats)) as part from nodes where feature is not null group by all),
      s as (select feature, sum(part / whole) as share from p join (select tree, sum(part) as whole from p group by tree) using (tree) group by feature)
      select feature, share / (select sum(share) from s) from s""").fetchall())
    for i, score in enumerate(model.featureImportances.toArray()):
        assert scores.get(i, 0.0) == pytest.approx(score, abs=1e-12) and in_duck.get(i, 0.0) == pytest.approx(score, abs=1e-12)


def test_boosted_trees_as_a_table(vectors, tmp_path):
    model = GBTClassifier(maxIter=4, maxDepth=3, stepSize=0.3, seed=2).fit(vectors)
    nodes = trees.node_table(model)
    ours = {r.id: r.score for r in trees.boosted_scores(vectors, nodes).collect()}
    duck = dict(walked(nodes, vectors, tmp_path).execute("select id, 1 / (1 + exp(2 * sum(weight * prediction))) from reached group by id").fetchall())
    for r in model.transform(vectors).select("id", vector_to_array("probability")[0].alias("p")).collect():
        assert ours[r.id] == pytest.approx(r.p, abs=1e-12) and duck[r.id] == pytest.approx(r.p, abs=1e-12)
    scores = {r.feature: r.score for r in trees.importances(nodes, boosted=True).collect()}
    for i, score in enumerate(model.featureImportances.toArray()):
        assert scores.get(i, 0.0) == pytest.approx(score, abs=1e-9)


def test_scoring_does_not_move_rows(spark, vectors):
    nodes = trees.stated_nodes(spark, [(0, 0, 0, 0.5, 1, 2), (0, 1, None, None, None, None), (0, 2, None, None, None, None)])
    refitted = trees.refit(vectors, nodes)
    assert "Exchange" not in plan(trees.forest_scores(vectors, refitted, depth=1))


def test_refitting_on_the_training_rows_gives_the_fit_again(vectors):
    """Without bagging, the counts of a fitted tree are those of its rows."""
    model = RandomForestClassifier(numTrees=2, maxDepth=4, seed=3, bootstrap=False, subsamplingRate=1.0).fit(vectors)
    nodes = trees.node_table(model)
    key = lambda r: (r.tree, r.node)
    for a, b in zip(sorted(nodes.collect(), key=key), sorted(trees.refit(vectors, nodes).collect(), key=key), strict=True):
        assert (a.tree, a.node, a.feature, a.left, a.right, a.stats) == (b.tree, b.node, b.feature, b.left, b.right, b.stats)
        assert (a.gain is None) == (b.gain is None) and (a.gain is None or a.gain == pytest.approx(b.gain, abs=1e-9))
    empty = trees.refit(vectors.limit(0), nodes).collect()
    assert {tuple(r.stats) for r in empty} == {(0.0, 0.0)} and len(empty) == nodes.count()


def test_a_single_leaf(spark, vectors):
    nodes = trees.refit(vectors, trees.stated_nodes(spark, [(4, 0, None, None, None, None)]))
    share = vectors.agg(F.avg(1 - F.col("label"))).first()[0]
    assert {round(r.score, 12) for r in trees.forest_scores(vectors, nodes).collect()} == {round(share, 12)}
    assert trees.importances(nodes).count() == 0


def _loss(x, y, w, c):
    m = x @ c[:-1] + c[-1]
    return np.sum(w * (np.logaddexp(0, m) - y * m)) / w.sum()


def test_gradient_is_the_slope_of_the_loss(spark, vectors):
    rows = vectors.collect()
    x = np.array([r.features.toArray() for r in rows])
    y, w = (np.array([r[c] for r in rows]) for c in ("label", "w"))
    for c in (np.zeros(5), np.array([0.3, -0.2, 0.7, 2.0, -0.4]), np.array([900.0, 0, 0, 0, 0])):
        table = linear.coefficient_table(spark, c[:-1], c[-1], ["a", "kind", "c", "flag"])
        found = sorted(linear.loss_and_gradient(vectors, table, weight="w").collect())
        assert [r.feature for r in found] == ["a", "kind", "c", "flag", linear.INTERCEPT]
        assert found[0].loss == pytest.approx(_loss(x, y, w, c), rel=1e-12)
        for j, r in enumerate(found):
            step = np.zeros(5)
            step[j] = 1e-6
            slope = (_loss(x, y, w, c + step) - _loss(x, y, w, c - step)) / 2e-6
            assert r.gradient == pytest.approx(slope, abs=1e-6)


def test_a_fitted_model_as_a_table(spark, vectors):
    model = LogisticRegression(weightCol="w", maxIter=100, tol=1e-12).fit(vectors)
    table = linear.coefficient_table(spark, model.coefficients, model.intercept, ["a", "kind", "c", "flag"])
    found = linear.loss_and_gradient(vectors, table, weight="w").collect()
    assert all(abs(r.gradient) < 1e-6 for r in found)
    assert found[0].loss == pytest.approx(model.summary.objectiveHistory[-1], abs=1e-9)
    ours = linear.probabilities(vectors, table).select("id", "score")
    both = model.transform(vectors).select("id", vector_to_array("probability")[1].alias("p")).join(ours, "id")
    assert both.where(F.abs(F.col("p") - F.col("score")) > 1e-12).count() == 0
    assert linear.loss_and_gradient(vectors.where("id < 0"), table).count() == 0
