"""Spelling variants: words one edit apart, found by dense tiles of code points.

Two different words are one inserted, deleted or replaced code point apart exactly when the lengths of
their common prefix and common suffix together reach the longer length minus one. Tiles test this for
blocks of words at once: the words stand in padded matrices of code points, from the left for the prefix
and from the right for the suffix, and every row of one block is held against every row of the other.

Which rows can meet follows from the same rule. With ``L`` the longer length, the edit lies in one part
``[lo, hi)`` of the ``L`` places; the words then agree in the ``lo`` code points before and the
``L - hi`` after it. So a word is dealt to the bucket of its head and tail for each of two halves, once as
a longest word (``L`` is its length) and once as the shorter one (``L`` is one more). A bucket of more than
``MOST`` words is not compared: its words are dealt again by the halves of its part, down to parts of one
place, where a bucket holds no more words than there are letters. Buckets are counted with partial sums
before any of them is brought together. A pair is counted in the one part that holds the first place its
edit can have, so that no pair is counted twice and no pair has to be written: a tile returns one row per
word, with the number of near words and the best of them.

Defined results: null texts have no words; a null key counts as the empty text in the hash that damages
runs; repeated rows count as often as they come; an empty table gives an empty result. Other columns of
any name do no harm.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.batches import slices
from tablecraft.sources import stage

LETTERS = "[A-Za-zÀ-ÿ]+"
MOST = 1024  # words of a bucket that are compared; larger ones are divided
TILE = 256  # rows of a block
CELLS = 1 << 20  # code points of a block, for long words
HELD = 300_000  # distinct words that a counting task holds before it passes them on

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def _counted(pattern: str, least: int, damage: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = re.compile(pattern).findall
        held: Counter = Counter()
        size = 0

        def passed_on() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for start, stop in slices(batch.column(1)):
                keys = batch.column(0).slice(start, stop - start).to_pylist()
                texts = batch.column(1).slice(start, stop - start).cast(pa.binary()).to_pylist()
                for key, text in zip(keys, texts):
                    runs = Counter(find((text or b"").translate(_LOWER).decode("utf-8", "replace")))
                    if damage:
                        begun = zlib.crc32(f"{key}:".encode())
                        for word in [w for w in runs if zlib.crc32(w.encode(), begun) % damage == 0]:
                            at = zlib.crc32(word.encode(), begun) % len(word)
                            n = runs.pop(word)
                            held[word[:at] + word[at + 1 :]] += n if len(word) > least else 0
                    for word, n in runs.items():
                        if len(word) >= least:
                            held[word] += n
                    size += len(text or b"")
                if len(held) >= HELD or size >= 64_000_000:
                    yield passed_on()
                    held.clear()
                    size = 0
        if held:
            yield passed_on()

    return run


def word_counts(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    pattern: str = LETTERS,
    least_length: int = 5,
    least_count: int = 3,
    damage: int | None = None,
) -> DataFrame:
    """``(word, n)`` of all runs of ``pattern`` with A-Z lower-cased, in whole texts.

    ``damage`` makes misspellings for trials: where it divides the unsigned crc32 of ``<key>:<run>``,
    the run loses the code point at that number modulo its length.
    """
    read = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.col(text).alias("text"))
    parts = read.mapInArrow(_counted(pattern, least_length, damage), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _buckets(rows: DataFrame) -> DataFrame:
    """The bucket of every row of (word, n, longest, lo, hi). Rows of different buckets with one number
    are told apart by their places and their letters."""
    head = F.expr("substring(word, 1, lo)")
    tail = F.expr("substring(word, char_length(word) - longest + hi + 1, longest - hi)")
    return rows.withColumn("bucket", F.xxhash64("longest", "lo", "hi", head, tail))


def _halves(rows: DataFrame, lo: str, hi: str) -> DataFrame:
    middle = f"({lo} + {hi}) div 2"
    parts = F.expr(
        f"inline(array(named_struct('lo', int({lo}), 'hi', int({middle})), named_struct('lo', int({middle}), 'hi', int({hi}))))"
    )
    return _buckets(rows.select("word", "n", "longest", parts))


class _Tile:
    """Some words as matrices of code points, from the left and from the right."""

    def __init__(self, words: list[str], n: np.ndarray, group: np.ndarray, places: np.ndarray):
        self.words, self.n, self.group, self.places = words, n, group, places
        self.lengths = np.array([len(w) for w in words], np.int64)
        width = int(self.lengths.max())
        self.left, self.right = (
            np.ascontiguousarray(np.array(x, f"<U{width}").view(np.uint32).reshape(len(x), width).T) for x in (words, [w[::-1] for w in words])
        )


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common beginning of all columns of ``a`` and ``b``."""
    same = np.ones((a.shape[1], b.shape[1]), bool)
    length = np.zeros(same.shape, np.int32)
    for x, y in zip(a, b):
        same &= x[:, None] == y[None, :]
        if not same.any():
            break
        length += same
    return length


def _near(a: _Tile, b: _Tile) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows one edit apart whose edit begins in the part of their bucket."""
    longer = np.maximum(a.lengths[:, None], b.lengths[None, :])
    prefix, suffix = _common(a.left, b.left), _common(a.right, b.right)
    longest, lo, hi = (a.places[i][:, None] for i in range(3))
    first = longer - 1 - suffix
    found = (prefix + suffix >= longer - 1) & (np.abs(a.lengths[:, None] - b.lengths[None, :]) < 2)
    found &= (a.group[:, None] == b.group[None, :]) & (longer == longest) & (first >= lo) & (first < hi)
    return np.nonzero(found)


def _blocks(group: np.ndarray, longest: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Blocks of rows: begin, end, and the number of the first block they meet. Small buckets share a
    block, a larger one has several, and each of these meets those of its own bucket up to itself."""
    ends = np.flatnonzero(np.concatenate([group[1:] != group[:-1], [True]])) + 1
    begin = made = 0
    for i, end in enumerate(ends):
        most = int(max(2, min(TILE, CELLS // max(1, longest[begin]))))
        if end - begin > most:
            first = made
            for at in range(begin, end, most):
                yield at, min(at + most, end), first
                made += 1
            begin = end
        elif i + 1 == len(ends) or ends[i + 1] - begin > most:
            yield begin, end, made
            made += 1
            begin = end


def _compared(words: list[str], n: np.ndarray, bucket: np.ndarray, places: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Near words of whole buckets; rows are sorted by bucket."""
    changed = (bucket[1:] != bucket[:-1]) | (places[:, 1:] != places[:, :-1]).any(axis=0)
    group = np.concatenate([[0], np.cumsum(changed)])
    keep = np.flatnonzero(np.bincount(group)[group] > 1)
    if not len(keep):
        return
    words, n, group, places = [words[i] for i in keep], n[keep], group[keep], places[:, keep]
    tiles: dict[int, _Tile] = {}
    for number, (begin, end, first) in enumerate(_blocks(group, places[0])):
        tiles = {k: t for k, t in tiles.items() if k >= first}
        mine = tiles[number] = _Tile(words[begin:end], n[begin:end], group[begin:end], places[:, begin:end])
        for k in range(first, number + 1):
            other = tiles[k]
            i, j = _near(mine, other)
            made = [(mine, i, other, j)] + ([(other, j, mine, i)] if k < number else [])
            for owner, at, near, to in made:
                if len(at):
                    yield _best(owner, at, near, to)


def _best(owner: _Tile, at: np.ndarray, near: _Tile, to: np.ndarray) -> pa.RecordBatch:
    """One row per word: how many near words a tile has for it, and the one of largest count."""
    rank = np.argsort(np.argsort(np.array(near.words)))
    order = np.lexsort((rank[to], -near.n[to], at))
    at, to = at[order], to[order]
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    counts = np.diff(first, append=len(at))
    columns = [
        pa.array([owner.words[i] for i in at[first]], pa.string()),
        pa.array(counts, pa.int64()),
        pa.array(near.n[to[first]], pa.int64()),
        pa.array([near.words[i] for i in to[first]], pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["word", "n_near", "best_n", "best"])


def _tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares the buckets of a task, which come sorted; holds one batch and one bucket."""
    held: list[pa.RecordBatch] = []

    def ready(last: bool) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        if not table.num_rows:
            return
        bucket = table["bucket"].to_numpy()
        upto = len(bucket)
        if not last:
            upto = int(np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))[-1])
            held.extend(table.slice(upto).to_batches())
        if upto:
            whole = table.slice(0, upto)
            places = np.stack([whole[c].to_numpy().astype(np.int64) for c in ("longest", "lo", "hi")])
            yield from _compared(whole["word"].to_pylist(), whole["n"].to_numpy(), bucket[:upto], places)

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            yield from ready(False)
    if held:
        yield from ready(True)


def near_words(words: DataFrame, *, most: int = MOST) -> DataFrame:
    """``(word, n_near, best_n, best)`` of the words of ``(word, n)`` that have near words. The words are
    distinct."""
    rows = _halves(words.withColumn("longest", F.explode(F.expr("array(char_length(word), char_length(word) + 1)"))), "0", "longest")
    found = []
    while True:
        large = rows.where("hi - lo > 1").groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > most)
        large = stage(large.select("bucket"), "spelling-large-buckets")
        divided = not large.isEmpty()
        alike = rows.join(large, "bucket", "left_anti").unionByName(rows.where("hi - lo = 1").join(large, "bucket", "left_semi")) if divided else rows
        sorted_rows = alike.select("bucket", "word", "n", "longest", "lo", "hi").repartition("bucket").sortWithinPartitions("bucket", "longest", "lo", "hi")
        found.append(stage(sorted_rows.mapInArrow(_tiled, "word string, n_near long, best_n long, best string"), "spelling-near"))
        if not divided:
            break
        rows = stage(_halves(rows.where("hi - lo > 1").join(large, "bucket", "left_semi"), "lo", "hi"), "spelling-divided")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best"))).alias("least")
    together = reduce(DataFrame.unionAll, found).groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return together.select("word", "n_near", (-F.col("least.less")).alias("best_n"), F.col("least.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for ``(word, form)``: the last word that forms lead to. Every step doubles the
    length of the paths, so a chain of ``n`` forms takes ``log2(n)`` joins; counts at least double along
    a chain, which keeps it short."""
    paths = stage(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = paths.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        longer = stage(paths.join(on, "root", "left").select("word", "root", "beyond"), "spelling-roots")
        if longer.where("beyond is not null").isEmpty():
            return paths
        paths = longer.select("word", F.coalesce("beyond", "root").alias("root"))


def variants(words: DataFrame, *, times: int = 2, most: int = MOST) -> DataFrame:
    """One row per word of ``(word, n)``: form, root, n, n_near, form_n. The form is the near word of
    largest count (ties: the first in order of code points) if it comes ``times`` as often."""
    words = stage(words.select("word", "n"), "spelling-words")
    near = near_words(words, most=most)
    is_form = F.col("best_n") >= F.col("n") * times
    told = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"),
        F.when(is_form, F.col("best_n")).alias("form_n"),
    )
    told = stage(told, "spelling-forms")
    return told.join(roots(told.where("form is not null")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
