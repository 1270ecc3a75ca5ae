"""A logistic model as a table of coefficients, with loss and gradient from one aggregate."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

INTERCEPT = "(intercept)"


def coefficient_table(spark: SparkSession, coefficients, intercept: float, names: list[str]) -> DataFrame:
    """``(idx, feature, coefficient)``; the intercept comes last."""
    rows = [(i, name, float(c)) for i, (name, c) in enumerate(zip(names, coefficients, strict=True))]
    return spark.createDataFrame([*rows, (len(names), INTERCEPT, float(intercept))], "idx int, feature string, coefficient double")


def _margin(coefficients: DataFrame, features: str) -> Column:
    """Intercept plus the products of entries and coefficients. The coefficients are fetched, as a fitted model
    is, and become a constant of the plan."""
    ordered = F.lit([r["coefficient"] for r in coefficients.orderBy("idx").collect()])
    entries = F.array_append(vector_to_array(features), F.lit(1.0))
    return F.aggregate(F.zip_with(entries, ordered, lambda x, c: x * c), F.lit(0.0), lambda a, v: a + v)


def probabilities(df: DataFrame, coefficients: DataFrame, *, features: str = "features", name: str = "score") -> DataFrame:
    """Adds the probability of label 1."""
    return df.withColumn(name, 1 / (1 + F.exp(-_margin(coefficients, features))))


def loss_and_gradient(
    df: DataFrame, coefficients: DataFrame, *, features: str = "features", label: str = "label", weight: str | None = None
) -> DataFrame:
    """``(idx, feature, coefficient, gradient, loss)``: the mean weighted logistic loss at the coefficients, and its
    derivative by each of them. One scan and one aggregate; a task sends one row per coefficient."""
    w = F.col(weight) if weight else F.lit(1.0)
    told = df.select(F.col(features).alias("x"), F.col(label).cast("double").alias("y"), w.cast("double").alias("w"), _margin(coefficients, features).alias("m"))
    error = F.col("w") * (1 / (1 + F.exp(-F.col("m"))) - F.col("y"))
    loss = F.col("w") * (F.greatest(F.col("m"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("m"))) - F.col("y") * F.col("m"))
    entries = F.posexplode(F.array_append(vector_to_array("x"), F.lit(1.0))).alias("idx", "x")
    steps = told.select("w", error.alias("error"), loss.alias("loss"), entries).groupBy("idx").agg(
        F.try_divide(F.sum(F.col("error") * F.col("x")), F.sum("w")).alias("gradient"),
        F.try_divide(F.sum("loss"), F.sum("w")).alias("loss"),  # every row comes once for each entry
    )
    return coefficients.join(steps, "idx").select("idx", "feature", "coefficient", "gradient", "loss")
