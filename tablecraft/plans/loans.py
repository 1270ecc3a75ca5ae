"""The loan-default study: raw table -> clean -> encoded -> vectors -> four scored classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tablecraft.constants import (
    IMPORTANCE_FLOOR,
    LABEL_COLUMN,
    LOAN_CURRENT_COLUMNS,
    LOAN_FLOAT_COLUMNS,
    LOAN_ID_COLUMNS,
    LOAN_INDEXED_COLUMNS,
    LOAN_MINOR_COLUMNS,
    LOAN_ONE_HOT_COLUMNS,
    LOAN_UNUSED_COLUMNS,
    ONE_HOT_LEVELS,
    SETTLED_STATUSES,
    SPARSE_FRACTION,
    WEIGHT_COLUMN,
)
from tablecraft.operators import clean, features, models, nulls
from tablecraft.sources.workspace import release, stage


def without_unused(raw: DataFrame, *, keep: list[str] | None = None) -> DataFrame:
    """``raw`` without the identifiers and texts that the study leaves out, but for ``keep``: what is to be staged
    before :func:`clean_loans`, which drops them in any case."""
    return clean.drop_columns(raw, [c for c in LOAN_ID_COLUMNS + LOAN_MINOR_COLUMNS if c not in (keep or [])])


def clean_loans(raw: DataFrame, *, keep: list[str] | None = None, strip_percent: bool = True) -> DataFrame:
    """Cleaning in the order of the study. ``keep`` names columns that must stay (a row key).

    Two small results are fetched on the way: the names of the sparse columns, and nothing else; the
    mean used by the imputation stays inside the plan.
    """
    df = nulls.drop_sparse(raw, SPARSE_FRACTION)
    df = without_unused(df, keep=keep)
    df = nulls.fill_zero_when(
        df, [c for c in ("tot_cur_bal", "tot_coll_amt") if c in df.columns], "loan_status", SETTLED_STATUSES
    )
    if "total_rev_hi_lim" in df.columns:
        df = nulls.mean_impute(df, "total_rev_hi_lim")
    df = nulls.drop_any_null(df)
    df = clean.add_default_label(df)
    df = clean.cast_numbers(df, LOAN_FLOAT_COLUMNS, strip_percent=strip_percent)
    return clean.drop_columns(df, LOAN_CURRENT_COLUMNS)


def settled_loans(cleaned: DataFrame) -> DataFrame:
    """Loans that ended: paid or charged off."""
    return clean.any_equal(cleaned, "loan_status", SETTLED_STATUSES)


def loan_levels(settled: DataFrame) -> dict[str, list[tuple[str, int]]]:
    """Levels and counts of the ten categorical columns and of the label, from one pass."""
    columns = LOAN_INDEXED_COLUMNS + LOAN_ONE_HOT_COLUMNS + ["isDefault"]
    return features.category_levels(settled, [c for c in columns if c in settled.columns], most=ONE_HOT_LEVELS)


def encode_loans(
    settled: DataFrame, levels: dict[str, list[tuple[str, int]]] | None = None, *, as_vectors: bool = False
) -> DataFrame:
    """Index, one-hot and ordinal columns, the label, and the class weight.

    ``as_vectors`` keeps the indicators of a category together in one sparse vector column, the form
    the feature vectors are made from; otherwise every indicator is a column of its own.
    """
    levels = levels or loan_levels(settled)
    indexed = [c for c in LOAN_INDEXED_COLUMNS if c in settled.columns]
    flagged = [c for c in LOAN_ONE_HOT_COLUMNS if c in settled.columns]
    df = clean.drop_columns(features.index_strings(settled, indexed, levels), indexed)
    if as_vectors:
        df = features.one_hot_vectors(df, flagged, levels)
    else:
        df = clean.drop_columns(features.one_hot(df, flagged, levels), flagged)
    df = clean.drop_columns(clean.add_employment_years(df), ["emp_length"])
    df = clean.rename_to_end(df, "isDefault", LABEL_COLUMN)
    df = features.add_class_weights(df, levels=levels["isDefault"])
    return clean.drop_columns(df, LOAN_UNUSED_COLUMNS)


def loan_vectors(
    cleaned: DataFrame, *, key: str | None = None, compat: bool = False, spent: DataFrame | None = None
) -> tuple[DataFrame, list[str]]:
    """Key, label columns, weight and the feature vector of the settled loans, and the feature names.

    The settled loans are written first, as they lie, because the levels and the encoding each read them;
    the vectors are written next, because every model fit passes over them several times. ``compat``
    keeps the weight among the features and the third level of the label. ``spent`` is a staged table under
    ``cleaned`` that nothing else reads: it is deleted when the settled loans are written, as these are at the end.
    """
    keys = [key] if key else []
    settled = stage(settled_loans(cleaned), "settled-loans")
    if spent is not None:
        release(spent)
    levels = loan_levels(settled)
    encoded = encode_loans(settled, levels, as_vectors=True)
    df = features.assemble(encoded, features.feature_names(encoded, keys, keep_weight=compat))
    df = features.index_label(df, unknown="keep" if compat else "error", levels=levels["isDefault"])
    vectors = stage(df.select(*keys, LABEL_COLUMN, WEIGHT_COLUMN, "label", "features"), "vectors")
    release(settled)
    return vectors, [name for _, name in features.vector_attributes(vectors)]


def fit_rows(train: DataFrame, key: str | None = None) -> DataFrame:
    """The training rows of a tree fit, which reads no key, in partitions of bounded size."""
    return features.spread(train.drop(key) if key else train)


def select_loan_features(vectors: DataFrame, train: DataFrame, *, key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Importances of a small forest, and the vectors with the chosen features as ``features2``."""
    forest = models.importance_forest().fit(fit_rows(train, key))
    importance = features.feature_importance(train, forest.featureImportances)
    return importance, features.select_features(vectors, importance, IMPORTANCE_FLOOR)


def loan_study(
    raw: DataFrame, *, key: str = "id", compat: bool = False, spent: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Model name -> one-row scorecard on the test part.

    Cleaning passes over ``raw`` three times (sparse columns, mean, rows), so a CSV file or a join
    should be staged first; as ``spent`` the staged table is deleted when it has been read. ``key`` is a unique
    column that splits the rows.
    """
    vectors, _ = loan_vectors(clean_loans(raw, keep=[key]), key=key, compat=compat, spent=spent)
    train, test = features.split_by_key(vectors, key)
    spread = fit_rows(train, key)
    estimators = {
        "logistic_regression": (models.logistic_regression(), train),
        "naive_bayes": (models.naive_bayes(), train),
        "random_forest": (models.random_forest(), spread),
        "boosted_trees": (models.boosted_trees(), spread),
    }
    return {
        name: models.scorecard(estimator.fit(rows).transform(test), compat=compat)
        for name, (estimator, rows) in estimators.items()
    }
