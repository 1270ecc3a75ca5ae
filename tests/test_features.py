import random
from collections import Counter

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tablecraft.constants import LABEL_COLUMN, LOAN_ONE_HOT_COLUMNS, WEIGHT_COLUMN
from tablecraft.operators import features, models
from tablecraft.plans import loans as loan_plan
from tablecraft.sources.standin import loans
from tests.conftest import rows


@pytest.fixture(scope="module")
def colours(spark):
    data = [(1, "red", "x"), (2, "blue", "x"), (3, "red", None), (4, None, "y"), (5, "green", "x")]
    return spark.createDataFrame(data, "id int, colour string, mark string")


def test_levels(colours):
    assert features.category_levels(colours, ["colour", "mark"], most=3) == {
        "colour": [("red", 2), ("blue", 1), ("green", 1)], "mark": [("x", 3), ("y", 1)],
    }
    with pytest.raises(ValueError):
        features.category_levels(colours, ["colour"], most=2)


def test_index_of_columns_with_different_numbers_of_levels(colours):
    df = features.index_strings(colours, ["colour", "mark"]).select("id", "colourIndex", "markIndex")
    assert rows(df) == [(1, 0.0, 0.0), (2, 1.0, 0.0), (3, 0.0, 2.0), (4, 3.0, 1.0), (5, 2.0, 0.0)]


def test_index_of_very_many_levels(spark):
    rng = random.Random(4)
    values = [f"v{rng.randint(0, 4000)}" for _ in range(9000)] + ["hot"] * 3000 + [None] * 5
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(7)
    counts = Counter(v for v in values if v is not None)
    want = {v: float(i) for i, (v, _) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0])))}
    got = {r.v: r.vIndex for r in features.index_strings(df, ["v"]).collect()}
    assert got == want | {None: float(len(want))}


def test_unknown_labels(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "c string")
    assert rows(features.index_label(df, "c", unknown="skip").select("label")) == [(0.0,), (0.0,)]
    assert rows(features.index_label(df, "c", unknown="keep").select("label")) == [(0.0,), (0.0,), (1.0,)]
    with pytest.raises(Exception, match="holds a null"):
        features.index_label(df, "c").collect()


def test_the_share_is_kept_to_the_last_digit(spark):
    df = spark.range(200_000).select(F.col("id").cast("string").alias("id"))
    train, test = features.split_by_key(df, "id", share=0.9996)
    assert 40 < test.count() < 130


def test_one_hot(colours):
    df = features.one_hot(colours, ["colour", "mark"], features.category_levels(colours, ["colour", "mark"], most=9))
    assert df.columns[3:] == ["colour_blue", "colour_green", "colour_red", "mark_x", "mark_y"]
    total = rows(df.select("id", F.expr("colour_blue + colour_green + colour_red"), F.expr("mark_x + mark_y")))
    assert total == [(1, 1, 1), (2, 1, 1), (3, 1, 0), (4, 0, 1), (5, 1, 1)]


def test_indicator_names_are_safe_and_unique():
    names = features.indicator_names("p", ["a b", "a-b", "A b"], {"p_a_b_2"})
    assert list(names.values()) == ["p_a_b", "p_a_b_3", "p_A_b_4"]


def test_one_hot_vectors_hold_the_same_indicators(colours):
    levels = features.category_levels(colours, ["colour", "mark"], most=9)
    wide = features.one_hot(colours, ["colour", "mark"], levels)
    packed = features.one_hot_vectors(colours, ["colour", "mark"], levels)
    got = {r.id: list(r.c) + list(r.m) for r in
           packed.select("id", vector_to_array("colour").alias("c"), vector_to_array("mark").alias("m")).collect()}
    want = {r.id: [float(v) for v in r[3:]] for r in wide.collect()}
    assert got == want
    names = [name for _, name in features.vector_attributes(features.assemble(packed, ["colour", "mark"]))]
    assert names == wide.columns[3:]


def test_weights_balance_the_classes(spark):
    df = spark.createDataFrame([(0,)] * 80 + [(1,)] * 20, f"{LABEL_COLUMN} int")
    sums = features.add_class_weights(df).groupBy(LABEL_COLUMN).agg(F.sum(WEIGHT_COLUMN).alias("w"))
    assert [round(r.w, 9) for r in sums.collect()] == [16.0, 16.0]
    other = features.add_class_weights(df, share_of=0).select(LABEL_COLUMN, F.round(WEIGHT_COLUMN, 9)).distinct()
    assert rows(other) == [(0, 0.8), (1, 0.2)]


def test_the_weight_is_no_feature():
    class Table:
        columns = ["id", "a", LABEL_COLUMN, WEIGHT_COLUMN, "b"]

    assert features.feature_names(Table, ["id"]) == ["a", "b"]
    assert features.feature_names(Table, ["id"], keep_weight=True) == ["a", WEIGHT_COLUMN, "b"]


def test_null_features_raise_by_default(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 3.0)], "a double, b double")
    with pytest.raises(Exception):
        features.assemble(df, ["a", "b"]).collect()
    assert features.assemble(df, ["a", "b"], on_null="skip").count() == 1


def test_label_index(spark):
    df = spark.createDataFrame([(1,)] * 3 + [(0,)] * 5, f"{LABEL_COLUMN} int")
    assert rows(features.index_label(df).distinct()) == [(0, 0.0), (1, 1.0)]
    kept = features.index_label(df, unknown="keep", levels=[("0", 5), ("1", 3)])
    assert rows(kept.distinct()) == [(0, 0.0), (1, 1.0)]
    assert len(kept.schema["label"].metadata["ml_attr"]["vals"]) == 3


def test_key_split_is_complete_disjoint_and_stable(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("id"))
    train, test = features.split_by_key(df, "id")
    assert train.count() + test.count() == 20000
    assert train.join(test, "id", "left_semi").count() == 0
    assert abs(train.count() / 20000 - 0.7) < 0.02
    again, _ = features.split_by_key(df.repartition(13), "id")
    assert again.join(train, "id", "left_anti").count() == 0


def test_random_split_is_complete(spark):
    train, test = features.split_random(spark.range(1000))
    assert train.count() + test.count() == 1000


@pytest.fixture(scope="module")
def cleaned(spark, sf_dir):
    return loan_plan.clean_loans(loans(spark, sf_dir), keep=["id"])


def test_cleaning_leaves_no_null(cleaned):
    from tablecraft.operators.nulls import null_counts

    assert null_counts(cleaned, sparse=True).count() == 0
    assert "mths_since_rcnt_il" not in cleaned.columns
    assert cleaned.schema["loan_amnt"].dataType.simpleString() == "float"


def test_wide_and_vector_encoding_agree(cleaned):
    settled = loan_plan.settled_loans(cleaned)
    wide = loan_plan.encode_loans(settled)
    packed = loan_plan.encode_loans(settled, as_vectors=True)
    assert not set(LOAN_ONE_HOT_COLUMNS) & set(wide.columns)

    def sums(df):
        vectors = features.assemble(df, features.feature_names(df, ["id"]))
        names = [name for _, name in features.vector_attributes(vectors)]
        values = vector_to_array("features")
        row = vectors.select(values.alias("v")).agg(*[F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(len(names))]).first()
        return {n.replace("#", "_"): round(v, 3) for n, v in zip(names, row)}

    assert sums(wide) == sums(packed)


def test_feature_selection(spark, cleaned):
    vectors, names = loan_plan.loan_vectors(cleaned, key="id")
    train, _ = features.split_by_key(vectors, "id")
    importance, sliced = loan_plan.select_loan_features(vectors, train)
    chosen = [r.feature for r in importance.where("score >= 0.0001").orderBy(F.desc("score"), "idx").collect()]
    assert importance.count() == len(names)
    assert [name for _, name in features.vector_attributes(sliced, "features2")] == chosen
    with pytest.raises(ValueError):
        features.select_features(vectors, importance, 2.0)


def test_negative_features_are_refused_by_bayes(spark):
    df = features.assemble(
        spark.createDataFrame([(0.0, -1.0, 1.0), (1.0, 1.0, 1.0)], f"label double, a double, {WEIGHT_COLUMN} double"), ["a"]
    )
    with pytest.raises(Exception):
        models.naive_bayes().fit(df)
