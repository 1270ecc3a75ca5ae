"""Benchmark passages inside documents, found by a Wu-Manber search over words.

Words are the maximal runs ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text whose A-Z are lower-cased. A
pattern is a window of 10 consecutive words of a benchmark item; an item of fewer words is one shorter
window. Windows of one length share a set of tables:

* the shift table says, for the hash of the last two words below the search head, how many words the
  head may move on without missing a window; most pairs of words occur in no window at all;
* where the shift is 0, the suffix hash names a bucket of windows, ordered by fingerprint inside;
* the words of a document and those of the windows left over are compared byte by byte.

The heads of many stretches of text move at once, as one vector. A document word inside any occurrence
is hit.

The benchmark is read in blocks of at most ``block_bytes`` of words, so what is broadcast and what the
driver holds is bounded however long the benchmark is. One block is one pass without a shuffle. With more
blocks, the rows of the first pass and the hits of the others are written and joined by key and digest of
the text, spans and items without repeats.

Defined results: a null or wordless text has no words, no hits and is not contaminated; a null or wordless
item has no window; items with one id count as one item, a null id goes by the empty text; repeated rows
stay repeated; an empty benchmark hits nothing; an empty table gives an empty result. Other columns of
any name do no harm.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.batches import mix64, offsets, slices
from tablecraft.sources import stage

WINDOW = 10
BLOCK_BYTES = 8_000_000  # words of the benchmark that one pass searches for
PIECE = 2000  # words of an item in one row; pieces overlap, so that every window lies in one
CHUNK = 1_000_000  # bytes that are cut into words at once
LANE = 64  # places that one search head walks over
PAIRS = 20_000  # windows that are compared at once

_WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
_IS_WORD = np.array([0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
_LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)
_BASE = np.uint64(0x100000001B3)
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Words:
    """The words of some texts: lower-cased bytes, begin and length of each word, a hash of each, and the
    offsets of the texts among the words."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.data = _LOWER[data]
        begins, lengths, hashes = [], [], []
        start, end = int(bounds[0]), int(bounds[-1])
        while start < end:
            stop = min(end, start + CHUNK)
            while stop < end and _IS_WORD[data[stop]] and _IS_WORD[data[stop - 1]]:
                stop += 1  # no word is cut
            for found, part in zip((begins, lengths, hashes), self._cut(start, stop, bounds)):
                found.append(part)
            start = stop
        self.begins, self.lengths = (np.concatenate([*x, np.zeros(0, np.int64)]) for x in (begins, lengths))
        self.hashes = np.concatenate([*hashes, np.zeros(0, np.uint64)])
        self.texts = np.searchsorted(self.begins, bounds, "left")

    def _cut(self, start: int, stop: int, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        is_word = _IS_WORD[self.data[start:stop]]
        first = is_word.copy()
        first[1:] &= ~is_word[:-1]
        inner = bounds[(bounds >= start) & (bounds < stop)] - start
        first[inner] = is_word[inner]  # a text ends the word before it
        places = np.flatnonzero(is_word)
        begins = np.flatnonzero(first[places])
        if not len(begins):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        lengths = np.diff(begins, append=len(places))
        within = np.arange(len(places)) - np.repeat(begins, lengths)
        powers = np.cumprod(np.full(int(lengths.max()), _BASE, np.uint64))
        values = (self.data[start:stop][places].astype(np.uint64) + np.uint64(1)) * powers[within]
        return places[begins] + start, lengths, mix64(np.add.reduceat(values, begins))


def _mixed(hashes: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """One number for ``length`` words from each start."""
    made = np.zeros(len(starts), np.uint64)
    for i in range(length):
        made = mix64(made * _STEP + hashes[starts + i])
    return made


def _same_words(a: Words, at: np.ndarray, b: Words, bt: np.ndarray, length: int) -> np.ndarray:
    """Whether ``length`` words from ``at`` are, byte by byte, those from ``bt``."""
    good = np.ones(len(at), bool)
    for begin in range(0, len(at), PAIRS):
        part = slice(begin, begin + PAIRS)
        i, j = ((x[part, None] + np.arange(length)).ravel() for x in (at, bt))
        equal = a.lengths[i] == b.lengths[j]
        pairs, back = np.unique(np.stack([i[equal], j[equal]]), axis=1, return_inverse=True)
        sizes = a.lengths[pairs[0]]
        begins = offsets(sizes)
        within = np.arange(begins[-1]) - np.repeat(begins[:-1], sizes)
        differs = a.data[np.repeat(a.begins[pairs[0]], sizes) + within] != b.data[np.repeat(b.begins[pairs[1]], sizes) + within]
        bad = np.add.reduceat(differs, begins[:-1]) > 0 if len(sizes) else np.zeros(0, bool)
        equal[equal] = ~bad[back.ravel()]
        good[part] = equal.reshape(-1, length).all(axis=1)
    return good


class Tables:
    """Shift table and suffix buckets of the distinct windows of one length."""

    def __init__(self, words: Words, starts: np.ndarray, items: np.ndarray, length: int):
        self.length, self.block = length, min(2, length)
        marks = _mixed(words.hashes, starts, length)
        order = np.argsort(marks, kind="stable")
        starts, items, marks = starts[order], items[order], marks[order]
        first = np.flatnonzero(np.concatenate([[True], marks[1:] != marks[:-1]]))
        group = np.repeat(first, np.diff(first, append=len(marks)))
        alone = np.flatnonzero(~_same_words(words, starts, words, starts[group], length))
        group[alone] = alone  # equal fingerprints of different words
        shown, index = np.unique(group, return_inverse=True)
        self.starts = starts[shown]
        by_window = np.lexsort((items, index))
        self.items = items[by_window]
        self.item_bounds = offsets(np.bincount(index, minlength=len(shown)))

        n_blocks = length - self.block + 1
        bits = max(12, int(len(self.starts) * n_blocks).bit_length() + 2)
        self.mask = np.uint64((1 << min(bits, 24)) - 1)
        self.shift = np.full(int(self.mask) + 1, n_blocks, np.uint8)
        for i in range(n_blocks):
            here = (_mixed(words.hashes, self.starts + i, self.block) & self.mask).astype(np.int64)
            self.shift[here] = np.minimum(self.shift[here], n_blocks - 1 - i)
        keys = self._bucket(words.hashes, self.starts)
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]

    def _bucket(self, hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        suffix = _mixed(hashes, starts + self.length - self.block, self.block)
        return (suffix & ~np.uint64(2**40 - 1)) | (_mixed(hashes, starts, self.length) >> np.uint64(24))

    def candidates(self, words: Words) -> np.ndarray:
        """Places where the shift table cannot rule out a window."""
        first = words.texts[:-1]
        counts = np.maximum(np.diff(words.texts) - self.length + 1, 0)
        lanes = -(-counts // LANE)
        number = np.arange(lanes.sum()) - np.repeat(offsets(lanes)[:-1], lanes)
        head = np.repeat(first, lanes) + number * LANE
        end = np.minimum(head + LANE, np.repeat(first + counts, lanes))
        found = [np.zeros(0, np.int64)]
        while len(head):
            step = self.shift[(_mixed(words.hashes, head + self.length - self.block, self.block) & self.mask).astype(np.int64)]
            found.append(head[step == 0])
            head = head + np.maximum(step, 1)
            going = head < end
            head, end = head[going], end[going]
        return np.concatenate(found)

    def occurrences(self, words: Words, patterns: Words) -> tuple[np.ndarray, np.ndarray]:
        """Places and windows that are equal."""
        at = self.candidates(words)
        keys = self._bucket(words.hashes, at)
        low, high = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
        sizes = high - low
        begins = offsets(sizes)
        window = self.order[np.arange(begins[-1]) - np.repeat(begins[:-1] - low, sizes)]
        at = np.repeat(at, sizes)
        good = _same_words(words, at, patterns, self.starts[window], self.length)
        return at[good], window[good]


class Patterns:
    """What one pass searches for: windows of all lengths of the pieces of one block."""

    def __init__(self, pieces: list[tuple[str, str]], window: int):
        self.names = sorted({name for name, _ in pieces})
        number = {name: i for i, name in enumerate(self.names)}
        joined = [text.encode("utf-8", "surrogatepass") for _, text in pieces]
        self.words = Words(np.frombuffer(b"".join(joined), np.uint8), offsets([len(t) for t in joined]))
        sizes = np.diff(self.words.texts)
        item = np.array([number[name] for name, _ in pieces], np.int64)
        self.tables = []
        for length in np.unique(np.minimum(sizes[sizes > 0], window)).tolist():
            mine = np.flatnonzero(np.minimum(sizes, window) == length)
            counts = sizes[mine] - length + 1
            begins = offsets(counts)
            starts = np.arange(begins[-1]) - np.repeat(begins[:-1] - self.words.texts[mine], counts)
            self.tables.append(Tables(self.words, starts, np.repeat(item[mine], counts), length))


def _hits(words: Words, patterns: Patterns) -> tuple[pa.Array, pa.Array]:
    """Spans of hit words (begin, end exclusive, within the text) and names of items, per text."""
    n, n_texts = len(words.hashes), len(words.texts) - 1
    cover = np.zeros(n + 1, np.int64)
    pairs = [np.zeros((2, 0), np.int64)]
    for table in patterns.tables:
        at, window = table.occurrences(words, patterns.words)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + table.length, -1)
        sizes = np.diff(table.item_bounds)[window]
        begins = offsets(sizes)
        items = table.items[np.arange(begins[-1]) - np.repeat(begins[:-1] - table.item_bounds[window], sizes)]
        text = np.searchsorted(words.texts, at, "right") - 1
        pairs.append(np.unique(np.stack([np.repeat(text, sizes), items]), axis=1))
    hit = np.cumsum(cover[:-1]) > 0
    text_of = np.repeat(np.arange(n_texts), np.diff(words.texts))
    edge = np.concatenate([[True], text_of[1:] != text_of[:-1]]) if n else np.zeros(0, bool)
    begins = np.flatnonzero(hit & (edge | ~np.concatenate([[False], hit[:-1]])[:n]))
    last = np.concatenate([edge[1:], [True]]) if n else edge
    ends = np.flatnonzero(hit & (last | ~np.concatenate([hit[1:], [False]])[:n])) + 1
    owner = text_of[begins]
    spans = pa.StructArray.from_arrays([pa.array(x - words.texts[owner], pa.int64()) for x in (begins, ends)], names=["begin", "end"])
    found = np.unique(np.concatenate(pairs, axis=1), axis=1)
    names = pa.array(patterns.names, pa.string()).take(pa.array(found[1]))
    per_text = [pa.array(offsets(np.bincount(x, minlength=n_texts)), pa.int32()) for x in (owner, found[0])]
    return pa.ListArray.from_arrays(per_text[0], spans), pa.ListArray.from_arrays(per_text[1], names)


def _searched(patterns, only_hits: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for start, stop in slices(texts):
                part = texts.slice(start, stop - start).cast(pa.large_binary()).fill_null(b"")
                bounds = np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + len(part) + 1]
                data = np.frombuffer(part.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
                words = Words(data, bounds - bounds[0])
                spans, items = _hits(words, patterns.value)
                n_words = pa.array(np.diff(words.texts), pa.int64())
                kept = [c.slice(start, stop - start) for c in batch.columns[:-1]]
                made = pa.RecordBatch.from_arrays([*kept, n_words, spans, items], names=[*batch.schema.names[:-1], "n_words", "spans", "items"])
                yield made.filter(pc.greater(pc.list_value_length(spans), 0)) if only_hits else made

    return run


def _cut_items(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, pieces = [], []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = [m.group() for m in _WORD.finditer(text.translate(_ASCII))]
                for i in range(0, max(len(words) - window + 1, 1 if words else 0), PIECE):
                    names.append(name)
                    pieces.append(" ".join(words[i : i + PIECE + window - 1]))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(pieces, pa.string())], names=["name", "piece"])

    return run


_ASCII = {c: c + 32 for c in range(0x41, 0x5B)}


def _blocks(pieces: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """The pieces in lists of at most ``block_bytes`` (or one piece); one empty list where there are none."""
    held, size, given = [], 0, False
    for row in pieces.toLocalIterator():
        more = len(row.piece.encode("utf-8", "surrogatepass"))
        if held and size + more > block_bytes:
            yield held
            held, size, given = [], 0, True
        held.append((row.name, row.piece))
        size += more
    if held or not given:
        yield held


def search(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document: key, n_words, spans of hit words, and the names of the items that occur."""
    spark = docs.sparkSession
    given = benchmark.select(
        F.coalesce(F.col(item).cast("string"), F.lit("")).alias("name"), F.coalesce(F.col(item_text), F.lit("")).alias("text")
    )
    pieces = stage(given.mapInArrow(_cut_items(window), "name string, piece string"), "benchmark-pieces")
    size = pieces.agg(F.coalesce(F.sum(F.octet_length("piece")), F.lit(0))).first()[0]
    kinds = "n_words long, spans array<struct<begin:long,end:long>>, items array<string>"
    key_kind = docs.select(F.col(key)).schema[0].dataType.simpleString()
    if size <= block_bytes:
        patterns = spark.sparkContext.broadcast(Patterns(next(_blocks(pieces, block_bytes)), window))
        read = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
        return read.mapInArrow(_searched(patterns, False), f"key {key_kind}, {kinds}")

    told = docs.select(F.col(key).alias("key"), F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("digest"), F.col(text).alias("text"))
    passes = []
    for n, block in enumerate(_blocks(pieces, block_bytes)):
        patterns = spark.sparkContext.broadcast(Patterns(block, window))
        found = told.mapInArrow(_searched(patterns, n > 0), f"key {key_kind}, digest string, {kinds}")
        passes.append(stage(found.withColumn("rows", F.lit(1 if n == 0 else 0)), "benchmark-hits"))
        patterns.destroy()
    together = reduce(DataFrame.unionAll, passes).groupBy("key", "digest").agg(
        F.max("n_words").alias("n_words"),
        F.sum("rows").cast("int").alias("rows"),
        F.array_distinct(F.flatten(F.collect_set("spans"))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )
    return together.withColumn("row", F.explode(F.sequence(F.lit(1), "rows"))).select("key", "n_words", "spans", "items")


def hit_words(spans: str) -> Column:
    """Words inside any of the spans, which may overlap."""
    return F.expr(
        f"aggregate(array_sort({spans}), named_struct('upto', 0L, 'n', 0L),"
        " (s, x) -> named_struct('upto', greatest(s.upto, x.end), 'n', s.n + greatest(0L, x.end - greatest(s.upto, x.begin))), s -> s.n)"
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, *, most: float = 0.0, **names) -> DataFrame:
    """Keys of the documents whose share of hit words is at most ``most``."""
    found = search(docs, benchmark, **names)
    return found.where(hit_words("spans") <= F.col("n_words") * most).select("key")
