"""Tree ensembles as tables of nodes: importances, scores and refitted statistics by DataFrame code.

A node table holds one row per node: ``tree``, ``node`` (numbered from 0 in each tree, 0 the root), ``feature``
(null at a leaf), ``threshold`` or the ``categories`` that go left, ``left``, ``right``, ``gain``, ``stats`` (the rows
of each class, or count, sum and sum of squares of a regression), ``prediction`` and the ``weight`` of the tree. Its size
depends on the depth and number of trees alone, so it may be looked up as one value; the rows that are
scored never move.
"""

from __future__ import annotations

import json

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecraft.sources.workspace import stage, working_path

NODE = (
    "tree int, node int, feature int, threshold double, categories array<double>, left int, right int, gain double, "
    "stats array<double>, prediction double, weight double"
)


def node_table(model) -> DataFrame:
    """The nodes of a fitted forest or of boosted trees, from what the model saves of itself."""
    spark = SparkSession.getActiveSession()
    path = working_path(spark, "forest")
    model.save(path)
    weights = spark.createDataFrame([(i, float(w)) for i, w in enumerate(model.treeWeights)], "treeID int, weight double")
    node, split = F.col("nodeData"), F.col("nodeData.split")
    is_leaf, is_number = node["leftChild"] < 0, split["numCategories"] < 0
    return (
        spark.read.parquet(f"{path}/data")
        .join(F.broadcast(weights), "treeID")
        .select(
            F.col("treeID").alias("tree"),
            node["id"].alias("node"),
            F.when(~is_leaf, split["featureIndex"]).alias("feature"),
            F.when(~is_leaf & is_number, split["leftCategoriesOrThreshold"][0]).alias("threshold"),
            F.when(~is_leaf & ~is_number, split["leftCategoriesOrThreshold"]).alias("categories"),
            F.when(~is_leaf, node["leftChild"]).alias("left"),
            F.when(~is_leaf, node["rightChild"]).alias("right"),
            F.when(~is_leaf, node["gain"]).alias("gain"),
            node["impurityStats"].alias("stats"),
            node["prediction"].alias("prediction"),
            "weight",
        )
    )


def stated_nodes(spark: SparkSession, splits: list[tuple[int, int, int | None, float | None, int | None, int | None]]) -> DataFrame:
    """A node table from stated ``(tree, node, feature, threshold, left, right)``, without statistics."""
    return spark.createDataFrame([(t, n, f, x, None, a, b, None, None, None, 1.0) for t, n, f, x, a, b in splits], NODE)


def importances(nodes: DataFrame, *, boosted: bool = False) -> DataFrame:
    """``(feature, score)`` of the features that some node splits by: gain times rows of the node, with all
    scores together 1. In a forest every tree has the same say; boosted trees, whose ``stats`` begin with the
    number of rows, are added up as they are."""
    count = F.col("stats")[0] if boosted else F.aggregate("stats", F.lit(0.0), lambda a, x: a + x)
    by_tree = nodes.where("feature is not null").groupBy("tree", "feature").agg(F.sum(F.col("gain") * count).alias("part"))
    whole = by_tree.groupBy("tree").agg(F.sum("part").alias("whole"))
    part = F.col("part") if boosted else F.try_divide("part", "whole")
    shares = by_tree.join(whole, "tree").groupBy("feature").agg(F.sum(part).alias("share"))
    total = shares.agg(F.sum("share").alias("total")).scalar()
    return shares.select("feature", F.try_divide(F.col("share"), total).alias("score"))


def _forest(nodes: DataFrame) -> Column:
    """All trees as one constant: an array of arrays of nodes, each node at the place of its number. The
    nodes are fetched, as a fitted model is; tasks share the constant and copy it into no row."""
    trees: dict[int, list] = {}
    for r in sorted(nodes.collect(), key=lambda r: (r["tree"], r["node"])):
        if r["node"] != len(trees.setdefault(r["tree"], [])):
            raise ValueError(f"the nodes of tree {r['tree']} are not numbered from 0")
        trees[r["tree"]].append(r.asDict())
    fields = nodes.select("node", "feature", "threshold", "categories", "left", "right", "stats", "prediction", "weight").schema
    kind = f"array<array<{fields.simpleString()}>>"
    return F.from_json(F.lit(json.dumps(list(trees.values()))), kind)


def _with_entries(df: DataFrame, features: str) -> DataFrame:
    """``df`` with the entries of the vector as the array ``__x``. A column of its own, so that a row's vector is
    unfolded once and not at every step in every tree."""
    return df.withColumn("__x", F.col(features) if isinstance(df.schema[features].dataType, T.ArrayType) else vector_to_array(features))


def _next(node: Column, x: Column) -> Column:
    """The child that a row goes to."""
    value = F.element_at(x, node["feature"] + 1)
    goes_left = F.when(node["categories"].isNull(), value <= node["threshold"]).otherwise(F.array_contains(node["categories"], value))
    return F.when(goes_left, node["left"]).otherwise(node["right"])


def _depth(nodes: DataFrame) -> int:
    """An upper bound of the depth: the most inner nodes of a tree."""
    return min(30, nodes.where("feature is not null").groupBy("tree").count().agg(F.max("count")).first()[0] or 0)


def leaves(forest: Column, x: Column, depth: int) -> Column:
    """The leaf that a row reaches in each tree."""

    def walk(tree: Column) -> Column:
        steps = F.sequence(F.lit(1), F.lit(max(1, depth)))
        return tree[F.aggregate(steps, F.lit(0), lambda at, _: F.when(tree[at]["left"].isNull(), at).otherwise(_next(tree[at], x)))]

    return F.transform(forest, walk)


def forest_scores(df: DataFrame, nodes: DataFrame, *, features: str = "features", name: str = "score", depth: int | None = None) -> DataFrame:
    """Adds the probability of class 0 of a forest: the mean share of the class in the leaves. One pass
    without a shuffle."""
    forest = _forest(nodes)
    reached = leaves(forest, F.col("__x"), _depth(nodes) if depth is None else depth)
    shares = F.transform(reached, lambda leaf: leaf["stats"][0] / F.aggregate(leaf["stats"], F.lit(0.0), lambda a, v: a + v))
    score = F.aggregate(shares, F.lit(0.0), lambda a, v: a + v, lambda a: a / F.size(forest))
    return _with_entries(df, features).withColumn(name, score).drop("__x")


def boosted_scores(df: DataFrame, nodes: DataFrame, *, features: str = "features", name: str = "score", depth: int | None = None) -> DataFrame:
    """Adds the probability of class 0 of boosted trees with logistic loss: the weighted sum ``m`` of the
    leaves' predictions stands for the odds ``exp(2 m)`` of class 1."""
    reached = leaves(_forest(nodes), F.col("__x"), _depth(nodes) if depth is None else depth)
    margin = F.aggregate(reached, F.lit(0.0), lambda a, leaf: a + leaf["weight"] * leaf["prediction"])
    return _with_entries(df, features).withColumn(name, 1 / (1 + F.exp(2 * margin))).drop("__x")


def refit(df: DataFrame, nodes: DataFrame, *, features: str = "features", label: str = "label", classes: int = 2) -> DataFrame:
    """The same trees with the class counts, gini gains and predictions of other rows.

    Each row counts at every node on its way. The ways are counted by (tree, node, class) before the shuffle, so
    a task sends a few rows per node.
    """
    x = F.col("__x")
    depth = _depth(nodes)

    def way(tree: Column) -> Column:
        steps = F.sequence(F.lit(1), F.lit(max(1, depth)))
        return F.aggregate(
            steps,
            F.array(F.lit(0)),
            lambda seen, _: F.when(tree[F.element_at(seen, -1)]["left"].isNull(), seen).otherwise(
                F.array_append(seen, _next(tree[F.element_at(seen, -1)], x))
            ),
        )

    ways = _with_entries(df, features).select(F.col(label).cast("int").alias("class"), F.posexplode(F.transform(_forest(nodes), way)).alias("tree", "way"))
    counted = ways.select("class", "tree", F.explode("way").alias("node")).groupBy("tree", "node").agg(
        F.array(*[F.count_if(F.col("class") == c).cast("double") for c in range(classes)]).alias("stats")
    )
    order = nodes.select("tree").distinct().selectExpr("tree", "int(row_number() over (partition by 1 order by tree) - 1) as place")
    numbered = nodes.drop("stats", "gain", "prediction").join(order, "tree")
    counted = counted.select(F.col("tree").alias("place"), "node", "stats")
    full = stage(
        numbered.join(counted, ["place", "node"], "left").withColumn(
            "stats", F.coalesce("stats", F.array(*[F.lit(0.0)] * classes))
        ),
        "refitted",
    )
    total = F.aggregate("stats", F.lit(0.0), lambda a, v: a + v)
    squares = F.aggregate("stats", F.lit(0.0), lambda a, v: a + v * v)
    sized = full.withColumns({"n": total, "impurity": F.when(total > 0, 1 - squares / (total * total)).otherwise(0.0)})
    child = sized.select("tree", F.col("node").alias("child"), F.col("n").alias("cn"), F.col("impurity").alias("ci"))
    kids = [child.select(F.col("tree").alias("tree"), F.col("child").alias(s), F.col("cn").alias(f"n_{s}"), F.col("ci").alias(f"i_{s}")) for s in ("left", "right")]
    met = sized.join(kids[0], ["tree", "left"], "left").join(kids[1], ["tree", "right"], "left")
    after = F.try_divide(F.col("n_left") * F.col("i_left") + F.col("n_right") * F.col("i_right"), F.col("n"))
    prediction = F.when(F.col("n") > 0, (F.array_position("stats", F.array_max("stats")) - 1).cast("double"))
    return met.select(
        "tree", "node", "feature", "threshold", "categories", "left", "right",
        F.when(F.col("feature").isNotNull(), F.coalesce(F.col("impurity") - after, F.lit(0.0))).alias("gain"),
        "stats", prediction.alias("prediction"), "weight",
    )
