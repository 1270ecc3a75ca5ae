"""Table profiles: shape, columns, description, box statistics, correlation."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecraft.operators.ranks import exact_quantiles
from tablecraft.operators.turn import rows_per_entry

_QUARTILES = [0.25, 0.5, 0.75]
SUMMERS = 8


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def shape(df: DataFrame) -> DataFrame:
    """One row ``(row_count, column_count)``."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "column_count", F.lit(len(df.columns)).cast("bigint")
    )


def preview(df: DataFrame, order_by: list[str], rows: int = 20) -> DataFrame:
    """The first rows in a stated order, taken as a top-k, not by sorting the table."""
    return df.orderBy(*order_by).limit(rows)


def column_info(df: DataFrame) -> DataFrame:
    """``(position, column, type, nullable, non_null_count)``, one aggregate over one scan."""
    return rows_per_entry(
        df,
        [
            {
                "position": F.lit(i).cast("bigint"),
                "column": F.lit(f.name),
                "type": F.lit(f.dataType.simpleString()),
                "nullable": F.lit(f.nullable),
                "non_null_count": F.count(F.col(f"`{f.name}`")),
            }
            for i, f in enumerate(df.schema.fields)
        ],
    )


def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per numeric column."""
    names = columns or numeric_columns(df)
    moments = rows_per_entry(
        df,
        [
            {
                "column": F.lit(c),
                "count": F.count(c),
                "mean": F.avg(c),
                "std": F.stddev_samp(c),
                "min": F.min(c).cast("double"),
                "max": F.max(c).cast("double"),
            }
            for c in names
        ],
    )
    quartiles = (
        exact_quantiles(df, names, _QUARTILES)
        .groupBy("column")
        .agg(*[F.max(F.when(F.col("probability") == p, F.col("quantile"))).alias(f"q{int(p * 100)}") for p in _QUARTILES])
    )
    return moments.join(quartiles, "column", "left").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def box_stats(df: DataFrame, column: str, reach: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (the extreme values inside the fences) and the number of outliers."""
    quartiles = exact_quantiles(df, [column], _QUARTILES).agg(
        *[F.max(F.when(F.col("probability") == p, F.col("quantile"))).alias(f"q{int(p * 100)}") for p in _QUARTILES]
    )
    box = quartiles.select(
        F.struct(
            "q25", "q50", "q75",
            (F.col("q25") - reach * (F.col("q75") - F.col("q25"))).alias("low_fence"),
            (F.col("q75") + reach * (F.col("q75") - F.col("q25"))).alias("high_fence"),
        )
    ).first()[0]
    value = F.col(column).cast("double")
    if box["q25"] is None:
        inside = F.lit(False)
    else:
        inside = value.between(box["low_fence"], box["high_fence"])
    quartile = {q: F.lit(box[q]).cast("double").alias(q) for q in ("q25", "q50", "q75")}
    return df.agg(
        *quartile.values(),
        F.min(F.when(inside, value)).alias("whisker_low"),
        F.max(F.when(inside, value)).alias("whisker_high"),
        F.count_if(value.isNotNull() & ~inside).alias("outliers"),
    )


def _gram(names: list[str], means: list[float]):
    """Sums of products of all pairs among (value or 0, value squared, known flag), over a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3 * len(names), 3 * len(names)))
        for batch in batches:
            known = np.stack([np.asarray(c.is_valid()) for c in batch.columns], axis=1)
            value = np.stack([c.fill_null(0).to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
            value = np.where(known, value - np.array(means), 0)
            wide = np.concatenate([value, value**2, known], axis=1)
            total += wide.T @ wide
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for blob in batch.column("sums"):
            part = np.frombuffer(blob.as_py())
            total = part.copy() if total is None else total + part
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])


def correlation_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pearson correlation in long form ``(a, b, r)``, each pair over the rows where both are known.

    A constant column gives null. Two scans at any width: the means, by which the values are centred,
    and one matrix of sums of products, from which the coefficient of every pair follows. Each task
    sends one matrix, they are added in ``SUMMERS`` tasks, and that many matrices reach the driver;
    their size depends on the number of columns only.
    """
    names = columns or numeric_columns(df)
    means = df.agg(*[F.avg(F.col(f"`{c}`").cast("double")).alias(f"m{i}") for i, c in enumerate(names)]).first()
    values = df.select(*[F.col(f"`{c}`").cast("double").alias(f"v{i}") for i, c in enumerate(names)])
    parts = values.mapInArrow(_gram(names, [m or 0.0 for m in means]), "sums binary")
    parts = parts.repartition(SUMMERS).mapInArrow(_added, "sums binary").collect()
    n = len(names)
    total = sum((np.frombuffer(r.sums).reshape(3 * n, 3 * n) for r in parts), np.zeros((3 * n, 3 * n)))
    both, product = total[2 * n :, 2 * n :], total[:n, :n]
    sums, squares = total[:n, 2 * n :], total[n : 2 * n, 2 * n :]  # of the first of a pair where both are known
    with np.errstate(divide="ignore", invalid="ignore"):
        spread = squares - sums**2 / both
        spread[spread <= 1e-12 * squares] = 0
        r = (product - sums * sums.T / both) / np.sqrt(spread * spread.T)
    rows = [(a, b, float(r[i, j]) if np.isfinite(r[i, j]) else None) for i, a in enumerate(names) for j, b in enumerate(names)]
    return df.sparkSession.createDataFrame(rows, "a string, b string, r double")


_SUMS = 6  # kinds of sums of a tile
_ROUND = 32  # rows of one tile that are first added apart


def _tile_sums(tiles: list[tuple[int, int]], block: int, means: list[float], places: dict[int, int]):
    """For each tile of column blocks, over a task: sums of products, of values, of squares and of rows, each over
    the rows where both columns of a pair are known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            part = batch.column(batch.num_columns - 1)[0].as_py() if batch.num_rows else 0
            sides = {}
            for b in {b for tile in tiles for b in tile}:
                columns = [batch.column(places[c]) for c in range(b * block, min((b + 1) * block, len(means)))]
                known = np.stack([np.asarray(c.is_valid()) for c in columns], axis=1).astype(float)
                value = np.stack([c.fill_null(0).to_numpy(zero_copy_only=False) for c in columns], axis=1)
                value = np.where(known > 0, value - np.array(means[b * block : b * block + len(columns)]), 0)
                sides[b] = (value, known, value**2)
            for i, j in tiles:
                (v, k, q), (w, h, r) = sides[i], sides[j]
                made = np.stack([v.T @ w, v.T @ h, k.T @ w, q.T @ h, k.T @ r, k.T @ h])
                totals[i, j] = totals[i, j] + made if (i, j) in totals else made
        for (i, j), made in totals.items():
            columns = [pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([part % _ROUND], pa.int32()), pa.array([made.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "part", "sums"])

    return run


def _added_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the rows of each (i, j, part), which come sorted; holds one of them."""
    held, total = None, None

    def row() -> pa.RecordBatch:
        columns = [pa.array([x], pa.int32()) for x in held] + [pa.array([total.tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["i", "j", "part", "sums"])

    for batch in batches:
        for n in range(batch.num_rows):
            key = tuple(batch.column(c)[n].as_py() for c in ("i", "j", "part"))
            sums = np.frombuffer(batch.column("sums")[n].as_py())
            if key == held:
                total = total + sums
            else:
                if held is not None:
                    yield row()
                held, total = key, sums
    if held is not None:
        yield row()


def _coefficients(names: list[str], block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                i, j = batch.column("i")[n].as_py(), batch.column("j")[n].as_py()
                left, right = names[i * block : (i + 1) * block], names[j * block : (j + 1) * block]
                product, sum_a, sum_b, square_a, square_b, both = np.frombuffer(batch.column("sums")[n].as_py()).reshape(_SUMS, len(left), len(right))
                with np.errstate(divide="ignore", invalid="ignore"):
                    spread_a, spread_b = square_a - sum_a**2 / both, square_b - sum_b**2 / both
                    spread_a, spread_b = (np.where(s <= 1e-12 * q, 0, s) for s, q in ((spread_a, square_a), (spread_b, square_b)))
                    r = (product - sum_a * sum_b / both) / np.sqrt(spread_a * spread_b)
                a, b, flat = np.repeat(left, len(right)), np.tile(right, len(left)), r.ravel()
                if i != j:
                    a, b, flat = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([flat, flat])
                values = pa.array(flat, pa.float64(), mask=~np.isfinite(flat))
                yield pa.RecordBatch.from_arrays([pa.array(a.tolist(), pa.string()), pa.array(b.tolist(), pa.string()), values], names=["a", "b", "r"])

    return run


def correlation_tiles(df: DataFrame, columns: list[str] | None = None, *, block: int = 64, cells: int = 4_000_000) -> DataFrame:
    """:func:`correlation_matrix` for any number of columns.

    The columns are cut into blocks, and a tile holds the sums of all pairs between two blocks. A scan fills as
    many tiles as ``cells`` numbers hold, so a task needs the same memory however wide the table is, and
    reads the columns of its tiles only; more tiles take more scans. The sums of a tile are added in two
    rounds, and its coefficients are computed where the last addition runs. Nothing but the means reaches the
    driver, in pieces of some hundred columns.
    """
    names = columns or numeric_columns(df)
    means: list[float] = []
    for start in range(0, len(names), 200):
        part = names[start : start + 200]
        row = df.agg(*[F.avg(F.col(f"`{c}`").cast("double")).alias(f"m{i}") for i, c in enumerate(part)]).first()
        means += [m or 0.0 for m in row]
    blocks = -(-len(names) // block)
    tiles = [(i, j) for i in range(blocks) for j in range(i, blocks)]
    at_once = max(1, cells // (_SUMS * block * block))
    kinds = "i int, j int, part int, sums binary"
    found = []
    for start in range(0, len(tiles), at_once):
        mine = tiles[start : start + at_once]
        wanted = sorted({c for tile in mine for b in tile for c in range(b * block, min((b + 1) * block, len(names)))})
        values = df.select(*[F.col(f"`{names[c]}`").cast("double").alias(f"v{c}") for c in wanted], F.spark_partition_id().alias("part"))
        sums = values.mapInArrow(_tile_sums(mine, block, means, {c: n for n, c in enumerate(wanted)}), kinds)
        first = sums.repartition("i", "j", "part").sortWithinPartitions("i", "j", "part").mapInArrow(_added_tiles, kinds)
        whole = first.withColumn("part", F.lit(0)).repartition("i", "j").sortWithinPartitions("i", "j").mapInArrow(_added_tiles, kinds)
        found.append(whole.mapInArrow(_coefficients(names, block), "a string, b string, r double"))
    empty = df.sparkSession.createDataFrame([], "a string, b string, r double")
    return reduce(DataFrame.unionAll, found) if found else empty
