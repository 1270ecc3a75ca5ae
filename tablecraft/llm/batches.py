"""Small helpers for work on Arrow batches and 64-bit hashes inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

SLICE_BYTES = 500_000


def plain_names(docs: DataFrame, *columns: str) -> tuple[DataFrame, list[str]]:
    """``docs`` with its columns named by their places, which clash with no other name, and the new names of
    ``columns``. ``toDF(*docs.columns)`` gives the names back."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]), [f"c{docs.columns.index(c)}" for c in columns]


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` bytes of text each, at least one row. Vector work on one range
    then needs memory for that much text, however many rows a batch has."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(ends):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, "right")))
        yield start, stop
        start = stop


def give_back() -> None:
    """Return memory that was freed to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim:
        trim(0)


def tidy(made: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``made``, which then leaves no freed memory in its process. Python workers outlive their tasks and wait for
    the next stage, so what one stage keeps is added to the needs of the later ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from made(batches)
        finally:
            give_back()

    return run


def mix64(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of unsigned 64-bit numbers (the SplitMix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbered(items: Sequence) -> tuple[np.ndarray, list]:
    """Index of every item in the list of distinct items, and that list."""
    seen: dict = {}
    index = np.fromiter((seen.setdefault(w, len(seen)) for w in items), np.int64, len(items))
    return index, list(seen)


def offsets(lengths: Sequence[int]) -> np.ndarray:
    """Where each group begins, and the end."""
    return np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])


def group_sums(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Sums of consecutive groups of rows; ``begins`` holds the offsets of the groups, empty ones too."""
    sums = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return sums[begins[1:]] - sums[begins[:-1]]
