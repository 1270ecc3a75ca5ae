"""Category encoding, class weights, feature vectors, splits and feature selection."""

from __future__ import annotations

import re

from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler, VectorSlicer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecraft.constants import LABEL_COLUMN, SPLIT_SEED, TRAIN_SHARE, WEIGHT_COLUMN
from tablecraft.sources.workspace import stage, stage_in_parts

SPREAD_ENTRIES = 20_000_000  # vector entries of one partition of training rows


def _level_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, level, n)`` of several columns from one pass, nulls left out."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return (
        texts.unpivot([], columns, "column", "level")
        .where("level is not null")
        .groupBy("column", "level")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def category_levels(df: DataFrame, columns: list[str], *, most: int) -> dict[str, list[tuple[str, int]]]:
    """Levels and counts of several categorical columns from one pass: most frequent first, ties in
    order of the text, nulls left out.

    For levels that become column names or metadata, which have to reach the driver. The caller says
    how many a column may have; a column with more is refused instead of being fetched.
    """
    rows = _level_counts(df, columns).limit(most * len(columns) + 1).collect()
    levels: dict[str, list[tuple[str, int]]] = {c: [] for c in columns}
    for row in rows:
        levels[row["column"]].append((row["level"], row["n"]))
    wide = [c for c in columns if len(levels[c]) > most]
    if wide:
        raise ValueError(f"more than {most} levels in {wide}")
    return {c: sorted(found, key=lambda x: (-x[1], x[0])) for c, found in levels.items()}


def number_levels(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, level, idx)``: levels numbered from 0.0, most frequent first, ties in order of the
    text. Any number of levels: they are dealt into ranges of that order, numbered inside each range,
    and shifted by the sizes of the ranges before, one row each. Nothing reaches the driver.
    """
    counts = _level_counts(df, columns).withColumn("less", -F.col("n"))
    order = ["column", "less", "level"]
    dealt = stage(counts.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "levels")
    inside = Window.partitionBy("column", "part").orderBy("less", "level")
    before = Window.partitionBy("column").orderBy("part")
    shifts = dealt.groupBy("column", "part").agg(F.count(F.lit(1)).alias("size"))
    shifts = shifts.withColumn("shift", F.sum("size").over(before) - F.col("size")).drop("size")
    place = F.row_number().over(inside) - 1
    return dealt.withColumn("place", place).join(shifts, ["column", "part"]).select(
        "column", "level", (F.col("place") + F.col("shift")).cast("double").alias("idx")
    )


def _join_levels(df: DataFrame, numbered: DataFrame, column: str, name: str, unknown: str) -> DataFrame:
    """Look the index of a column up. ``unknown`` texts and nulls: an extra index ("keep"), an error, or
    a dropped row ("skip")."""
    own = numbered.where(F.col("column") == column).select(F.col("level").alias("__level"), F.col("idx").alias("__idx"))
    met = df.join(own, F.col(column).cast("string") == F.col("__level"), "inner" if unknown == "skip" else "left")
    extra = {
        "keep": own.agg(F.count(F.lit(1)).cast("double").alias("n")).scalar(),
        "error": F.raise_error(F.lit(f"{column} holds a null")).cast("double"),
        "skip": F.lit(None).cast("double"),
    }[unknown]
    return met.select(*[df[c] for c in df.columns], F.coalesce("__idx", extra).alias(name))


def _place_levels(df: DataFrame, labels: dict[str, list[str]], names: dict[str, str]) -> DataFrame:
    """Index columns from known labels. One model per column: a model of several columns pads the
    shorter label lists with nulls."""
    for c, known in labels.items():
        model = StringIndexerModel.from_labels(known, inputCol=c, outputCol=names[c], handleInvalid="keep")
        df = model.transform(df)
    return df


def index_strings(
    df: DataFrame, columns: list[str], levels: dict[str, list[tuple[str, int]]] | None = None, *, suffix: str = "Index"
) -> DataFrame:
    """Frequency index per column (0.0 is the most frequent level); null and unknown texts share one
    extra index. The levels of all columns are numbered in the cluster from one pass and joined, so a
    column may have any number of them. Known ``levels`` (few by their nature) save the pass and the
    join, and the new columns then carry nominal metadata."""
    if levels is None:
        numbered = number_levels(df, columns)
        for c in columns:
            df = _join_levels(df, numbered, c, f"{c}{suffix}", "keep")
        return df
    return _place_levels(df, {c: [level for level, _ in levels[c]] for c in columns}, {c: f"{c}{suffix}" for c in columns})


def indicator_names(column: str, levels: list[str], taken: set[str]) -> dict[str, str]:
    """Level -> column name ``<column>_<level>``; only letters, digits and ``_``, unique without
    regard to case. ``taken`` holds the names in use (lower case) and is extended."""
    names = {}
    for level in levels:
        base = f"{column}_{re.sub(r'[^0-9A-Za-z_]', '_', level)}"
        name, n = base, 1
        while name.lower() in taken:
            n += 1
            name = f"{base}_{n}"
        taken.add(name.lower())
        names[level] = name
    return names


def one_hot(df: DataFrame, columns: list[str], levels: dict[str, list[tuple[str, int]]]) -> DataFrame:
    """Append one 0/1 column per level, levels in text order, every level kept. A null level gives
    all zeros. The levels become column names; :func:`category_levels` finds them."""
    taken = {c.lower() for c in df.columns}
    flags: list[Column] = []
    for c in columns:
        names = indicator_names(c, sorted(level for level, _ in levels[c]), taken)
        flags += [F.col(c).eqNullSafe(level).cast("int").alias(name) for level, name in names.items()]
    return df.select("*", *flags)


def one_hot_vectors(df: DataFrame, columns: list[str], levels: dict[str, list[tuple[str, int]]]) -> DataFrame:
    """Replace each categorical column by a sparse 0/1 vector of the same name.

    The same indicators as :func:`one_hot`, for use in feature vectors: one narrow column instead of
    dozens of wide ones, which keeps the generated code small. The extra index for null and unknown
    texts is the last one, which the encoder drops, so every real level is kept and they give zeros.
    """
    places = {c: f"__{c}_place" for c in columns}
    labels = {c: sorted(level for level, _ in levels[c]) for c in columns}
    placed = _place_levels(df, labels, places).drop(*columns)
    encoder = OneHotEncoder(inputCols=list(places.values()), outputCols=columns, dropLast=True)
    return encoder.fit(placed).transform(placed).drop(*places.values())


def add_class_weights(
    df: DataFrame,
    label: str = LABEL_COLUMN,
    name: str = WEIGHT_COLUMN,
    *,
    share_of: int = 1,
    levels: list[tuple[str, int]] | None = None,
) -> DataFrame:
    """Class 0 weighs r and every other class 1 - r, r being the share of defaults (label 1) in all
    labelled rows. ``share_of=0`` takes the share of the other class instead. The share is a scalar
    subquery, or comes from known ``levels`` of the label without another pass."""
    if levels:
        share = F.lit(dict(levels).get(str(share_of), 0) / sum(n for _, n in levels))
    else:
        share = df.agg(F.avg((F.col(label) == share_of).cast("int")).alias("share")).scalar()
    return df.withColumn(name, F.when(F.col(label) == 0, share).otherwise(1 - share))


def feature_names(df: DataFrame, leave_out: list[str] | None = None, *, keep_weight: bool = False) -> list[str]:
    """All columns but the label, and but the weight: it is made from the label and would leak it.
    ``keep_weight`` takes the weight in all the same."""
    out = {LABEL_COLUMN, *(leave_out or [])} | (set() if keep_weight else {WEIGHT_COLUMN})
    return [c for c in df.columns if c not in out]


def assemble(df: DataFrame, inputs: list[str], name: str = "features", *, on_null: str = "error") -> DataFrame:
    """Collect the columns into one vector. ``on_null``: "error", "skip" the row, or "keep" as NaN."""
    return VectorAssembler(inputCols=inputs, outputCol=name, handleInvalid=on_null).transform(df)


def index_label(
    df: DataFrame,
    source: str = LABEL_COLUMN,
    name: str = "label",
    *,
    unknown: str = "error",
    levels: list[tuple[str, int]] | None = None,
) -> DataFrame:
    """Label index: the most frequent class becomes 0.0. With ``unknown="keep"`` the label gets a
    third level, and some classifiers then train three classes. Known ``levels`` save a pass, and the
    new column then carries nominal metadata."""
    if levels is None:
        return _join_levels(df, number_levels(df, [source]), source, name, unknown)
    model = StringIndexerModel.from_labels(
        [level for level, _ in levels], inputCol=source, outputCol=name, handleInvalid=unknown
    )
    return model.transform(df)


def split_random(df: DataFrame, share: float = TRAIN_SHARE, seed: int = SPLIT_SEED) -> tuple[DataFrame, DataFrame]:
    """Random split. The rows are written first, so that both parts are cut from the same partitions
    whatever happens to either; which row falls where still depends on how they were partitioned. See
    :func:`split_by_key` for a split that does not."""
    train, test = stage(df, "split").randomSplit([share, 1.0 - share], seed)
    return train, test


def in_train(key: str, share: float = TRAIN_SHARE, seed: int = SPLIT_SEED) -> Column:
    """Whether a key falls into the training part: a fixed function of the key and the seed."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return number < share * 2.0**32


def split_by_key(
    df: DataFrame, key: str, share: float = TRAIN_SHARE, seed: int = SPLIT_SEED
) -> tuple[DataFrame, DataFrame]:
    """Repeatable split: two filters on the key, the same whatever the partitioning, a re-run task or
    the engine."""
    chosen = in_train(key, share, seed)
    return df.where(chosen), df.where(~chosen)


def spread(df: DataFrame, key: str | None = None, *, name: str = "features", entries: int | None = None) -> DataFrame:
    """The same rows, written in files of at most about ``entries`` vector entries, each read as one partition.

    A tree fit keeps every row as a dense array, many times the size of the sparse vector in a file, and reads
    these arrays again for each level of the trees. Partitions cut by the bytes of the files would then grow to
    gigabytes; cut by rows, their number grows with the table and their size does not. Rows are cut where they lie;
    with a unique ``key`` they are first dealt by it. Either way they are written once, because a fit asks for the plan of
    its rows several times (for its log, its passes and its summaries), and a plan with a shuffle would run each time.
    """
    rows = max(1, (entries or SPREAD_ENTRIES) // len(vector_attributes(df, name)))
    cores = df.sparkSession.sparkContext.defaultParallelism
    count = df.count()
    parts = cores * max(1, -(-count // (rows * cores)))  # whole rounds of tasks
    return stage_in_parts(df.repartition(parts, key) if key else df, "spread", 2 * rows if key else max(1, -(-count // parts)))


def vector_attributes(df: DataFrame, name: str = "features") -> list[tuple[int, str]]:
    """Position and name of every entry of a vector column, from all attribute groups (numeric,
    nominal and binary) of its metadata."""
    groups = df.schema[name].metadata["ml_attr"]["attrs"]
    return sorted((a["idx"], a["name"]) for group in groups.values() for a in group)


def feature_importance(df: DataFrame, scores, name: str = "features") -> DataFrame:
    """``(idx, feature, score)``, best first: importances of a fitted forest with feature names."""
    rows = [(idx, feature, float(scores[idx])) for idx, feature in vector_attributes(df, name)]
    schema = T.StructType.fromDDL("idx int, feature string, score double")
    return df.sparkSession.createDataFrame(rows, schema).orderBy(F.desc("score"), "idx")


def select_features(
    df: DataFrame, importance: DataFrame, floor: float, *, name: str = "features", into: str = "features2"
) -> DataFrame:
    """Slice the vectors to the features that score at least ``floor``, best first."""
    chosen = [r["idx"] for r in importance.where(F.col("score") >= floor).orderBy(F.desc("score"), "idx").collect()]
    if not chosen:
        raise ValueError(f"no feature scores {floor} or more")
    return VectorSlicer(inputCol=name, outputCol=into, indices=chosen).transform(df)
