"""N-gram Jaccard join by PartEnum signatures.

A document is the set of its distinct word shingles. Two documents link when their sets have a Jaccard
similarity of at least ``PERCENT`` percent; linked documents form components.

Signatures. Sets are put into size bands; for a band, similar sets differ in at most ``k`` shingles.
The shingle domain is partitioned into more than ``k`` parts by a hash, and the enumerated subsets are
single parts (PartEnum with second-level groups one larger than their threshold): what a set holds in
one part is a signature, and because ``k`` differences spoil at most ``k`` parts, all other parts of
two similar sets agree. So if both order their signatures alike and give the first ``k + 1`` that are
not empty, they share one. The order is free, so signatures that many sets hold go last: a passage
that many documents share is then rarely asked for, and only sets that consist mostly of such passages
(*poor* sets) give frequent signatures at all.

Candidates. Signatures are gathered by their leading bits in packed rows. A signature with few holders
gives all pairs; one with many gives a star around one holder, and marks its holders, which are poor.
Parity sketches (one bit per hash place, twice as many places as shingles) bound the number of
differences from below and strike out pairs that cannot link; the sets of the remaining pairs are
compared exactly. Linked sets are joined into components. What is then left are links between poor
sets of different components. These are sought block by block: a task holds the sets of two blocks, passes
over sets that are already joined, compares the sketches and then the sets of the others, and joins
what links, so that it returns a spanning forest of its sets and never all their pairs. Each block first
meets itself, and components are joined again before blocks meet each other. No link is lost on the way.

Copies count once: equal sets form one class before anything is compared, and a class is sent once
from each task. Documents carry no text through any shuffle. Shingles are 64-bit hashes; sets are
named by a 64-bit hash of their shingles.

Defined results: documents without words or text have no shingles and are components of their own;
fewer words than a shingle form one shingle; repeated rows are links at distance 0; a null key links like
any other but never names a component, unless all keys of the component are null; an empty table gives
an empty result. Keys are integers. Other columns of any name do no harm.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.batches import mix64, numbered, offsets, plain_names, slices, tidy
from tablecraft.sources import stage

WIDTH, PERCENT = 5, 75
BAND = 2.0  # largest over smallest size of a band
PARTS, LEAST_PARTS = 2.0, 16  # parts per difference allowed for, and at least
FEW = 24  # holders up to which a signature gives all pairs
FLUSH = 1_000_000  # signatures a task holds before it packs them
PER_BUCKET = 400_000  # signatures a bucket is planned for
PER_DOCUMENT = 512  # signatures a document is planned with
FILTER_BITS = 16, 27  # places of a filter, as a power of two, at least and at most
PER_ENTRY = 16  # places for each entry of a filter
BLOCK = 1024  # poor sets of a block
BLOCK_SHINGLES = 1 << 20  # shingles of a block, for large sets
AT_ONCE = 500_000  # links a task makes stars of at once
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_U = np.uint64
_SIZE_BITS = 20
_MOST_SIZE = (1 << _SIZE_BITS) - 1


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    split = [(t or "").encode("utf-8", "surrogatepass").translate(_LOWER).split() for t in texts]
    index, distinct = numbered([w for s in split for w in s])
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, distinct), _U, len(distinct))[index]
    run = np.zeros(max(len(hashed) - WIDTH + 1, 0), _U)
    for i in range(WIDTH):
        run = mix64(run + hashed[i : i + len(run)] + _U(0x9E3779B97F4A7C15))
    begins = offsets([len(s) for s in split])
    out = []
    for words, a, b in zip(split, begins[:-1].tolist(), begins[1:].tolist()):
        if b - a >= WIDTH:
            out.append(np.unique(run[a : b - WIDTH + 1]))
        else:
            out.append(np.array([xxhash.xxh64_intdigest(b" ".join(words), 1)] if words else [], _U))
    return out


def set_name(shingles: np.ndarray) -> int:
    """64-bit name of a set, signed."""
    return xxhash.xxh64_intdigest(shingles.tobytes()) - (1 << 63)


def ticket(name: np.ndarray, size: np.ndarray) -> np.ndarray:
    """What stands for a set in packed rows: some bits of its name, and its size."""
    return (mix64(name.astype(_U)) << _U(_SIZE_BITS)) | np.minimum(size, _MOST_SIZE).astype(_U)


def partner_bound(size: int) -> int:
    """Size of the largest set that can link with a set of ``size``."""
    return size * 100 // PERCENT


def differences(total: int) -> int:
    """Most differing shingles of two linked sets whose sizes add up to ``total``."""
    return (100 - PERCENT) * total // (100 + PERCENT)


def bands(size: int) -> range:
    """Bands whose larger sets a set of ``size`` can link with: its own, perhaps the next."""
    own, far = (math.ceil(math.log(s) / math.log(BAND) - 1e-12) if s > 1 else 0 for s in (size, partner_bound(size)))
    return range(own, far + 1)


def signatures(shingles: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
    """``(band, given, signatures)`` of a set: the hashes of its parts that are not empty, and how many
    of them it gives. A set whose parts could all be spoiled gives all, and those of its empty parts."""
    size, out = len(shingles), []
    for band in bands(size) if size else ():
        top = max(int(BAND**band + 1e-9), 1)
        allowed = differences(size + min(top, partner_bound(size)))
        parts = max(LEAST_PARTS, math.ceil(PARTS * (differences(2 * top) + 1)))
        part = mix64(shingles) % _U(parts)
        order = np.argsort(part, kind="stable")
        at = part[order]
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        held = np.add.reduceat(mix64(shingles[order] * _U(3) + _U(1)), first)
        given = mix64(held + mix64(at[first] * _U(64) + _U(band)))
        if len(given) <= allowed:
            bare = np.setdiff1d(np.arange(parts).astype(_U), at)
            given = np.concatenate([given, mix64(mix64(bare * _U(64) + _U(band)) ^ _U(7))])
            allowed = len(given) - 1
        out.append((band, allowed + 1, given))
    return out


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity of the shingles at each of about twice as many places, packed."""
    places = 1 << max(6, (2 * len(shingles) - 1).bit_length())
    odd = np.bincount((mix64(shingles + _U(99)) & _U(places - 1)).astype(np.int64), minlength=places) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(_U)


def sketch_gap(a: np.ndarray, b: np.ndarray) -> np.ndarray | int:
    """Places where sketches differ (last axis), the larger one folded; never more than the shingles
    that differ."""
    while a.shape[-1] > b.shape[-1]:
        a = a[..., : a.shape[-1] // 2] ^ a[..., a.shape[-1] // 2 :]
    while b.shape[-1] > a.shape[-1]:
        b = b[..., : b.shape[-1] // 2] ^ b[..., b.shape[-1] // 2 :]
    return np.bitwise_count(a ^ b).sum(axis=-1)


def _measure(bits: int):
    """Rows for documents (name, size, sketch) and packed signatures for counting."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[np.ndarray] = []
        for batch in batches:
            texts = batch.column("text")
            for start, stop in slices(texts):
                sets = shingle_sets(texts[start:stop].to_pylist())
                names = [set_name(s) for s in sets]
                marks = []
                for name, s in zip(names, sets):
                    new = len(s) > 0 and name not in seen
                    if new:
                        seen.add(name)
                        held += [x for _, _, x in signatures(s)]
                    marks.append(sketch(s).tobytes() if new else None)
                yield _row(batch.column("key")[start:stop], batch.column("spot")[start:stop], [len(s) for s in sets], names, marks)
                if sum(map(len, held)) > FLUSH:
                    yield from _counted(held, bits)
                    held = []
        if held:
            yield from _counted(held, bits)

    return run


_MEASURED = "key long, spot long, size long, name long, sketch binary, bucket int, low binary, times binary"
_NAMES = [c.split()[0] for c in _MEASURED.split(", ")]


def _row(keys: pa.Array, spots: pa.Array, sizes: list[int], names: list[int], marks: list[bytes | None]) -> pa.RecordBatch:
    n = len(sizes)
    empty = [pa.nulls(n, t) for t in (pa.int32(), pa.binary(), pa.binary())]
    return pa.RecordBatch.from_arrays([keys, spots, pa.array(sizes, pa.int64()), pa.array(names, pa.int64()), pa.array(marks, pa.binary()), *empty], names=_NAMES)


def _split(sorted_keys: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """Bucket, begin and end of the runs of sorted signatures by their leading bits."""
    if not len(sorted_keys):
        return []
    bucket = (sorted_keys >> _U(64 - bits)).astype(np.int64) if bits else np.zeros(len(sorted_keys), np.int64)
    edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
    return [(int(bucket[a]), a, b) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]


def _counted(held: list[np.ndarray], bits: int) -> Iterator[pa.RecordBatch]:
    """Signatures with their counts, packed by bucket; 32 bits after the bucket's tell them apart,
    since a clash only makes a signature count as frequent."""
    found, times = np.unique(np.concatenate(held), return_counts=True)
    runs = _split(found, bits)
    low = (found << _U(bits) >> _U(32)).astype(np.uint32)
    times = np.minimum(times, FEW + 1).astype(np.uint8)
    n = len(runs)
    empty = [pa.nulls(n, t) for t in (*[pa.int64()] * 4, pa.binary())]
    packed = [pa.array([x[a:b].tobytes() for _, a, b in runs], pa.binary()) for x in (low, times)]
    yield pa.RecordBatch.from_arrays([*empty, pa.array([r[0] for r in runs], pa.int32()), *packed], names=_NAMES)


def _numbers(blobs: pa.ChunkedArray, kind: type) -> np.ndarray:
    """Packed numbers of several rows, one after the other."""
    return np.frombuffer(b"".join(x for x in blobs.to_pylist() if x) or b"", kind) if any(blobs.to_pylist()) else np.empty(0, kind)


def _filter_bits(entries: int) -> int:
    """Size of a filter by its entries. Where the largest is too small, more things only look wanted."""
    return min(max(math.ceil(math.log2(max(entries, 1) * PER_ENTRY)), FILTER_BITS[0]), FILTER_BITS[1])


def _mixed_low(bucket: int | np.ndarray, low: np.ndarray) -> np.ndarray:
    return mix64(low.astype(_U) + (_U(bucket) << _U(32) if isinstance(bucket, int) else bucket << _U(32)))


def _frequent(bucket: pa.Table) -> pa.Table:
    """Hashes of the signatures of a bucket that more than ``FEW`` classes hold."""
    low, times = _numbers(bucket.column("low"), np.uint32), _numbers(bucket.column("times"), np.uint8)
    found, of = np.unique(low, return_inverse=True)
    many = found[np.bincount(of, weights=times) > FEW]
    return pa.table({"h": pa.array(_mixed_low(bucket.column("bucket")[0].as_py(), many).view(np.int64))})


class Filter:
    """Which hashes look wanted, by their leading bits. At most ``2 ** (FILTER_BITS[1] - 6)`` words reach the
    driver and are sent to the tasks."""

    def __init__(self, hashes: DataFrame) -> None:
        """``hashes``: a written table with the column ``h``."""
        self.bits = _filter_bits(hashes.count())
        place = F.shiftrightunsigned("h", 64 - self.bits)
        words = hashes.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("word")).agg(
            F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("place") % 64).cast("int"))).alias("bits")
        )
        found = words.toPandas()
        self.words = np.zeros(1 << (self.bits - 6), _U)
        self.words[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(_U)

    def wanted(self, hashed: np.ndarray) -> np.ndarray:
        place = hashed >> _U(64 - self.bits)
        return ((self.words[(place >> _U(6)).astype(np.int64)] >> (place & _U(63))) & _U(1)).astype(bool)


def _give(bits: int, hot: Filter):
    """Packed rows ``bucket, sigs, holders, many``; the signatures that every class gives, those in the filter
    last. Long runs within a task become stars at once; their centre goes on, and their signatures as
    ``many``, since holders elsewhere have to learn that the signature is frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        sigs: list[np.ndarray] = []
        who: list[np.ndarray] = []
        for batch in batches:
            texts = batch.column("text")
            for start, stop in slices(texts):
                for s in shingle_sets(texts[start:stop].to_pylist()):
                    name = set_name(s)
                    if not len(s) or name in seen:
                        continue
                    seen.add(name)
                    holder = ticket(np.array([name]), np.array([len(s)]))
                    for _, n_given, x in signatures(s):
                        x = np.sort(x)
                        low = (x << _U(bits) >> _U(32)).astype(np.uint32)
                        bucket = x >> _U(64 - bits) if bits else np.zeros(len(x), _U)
                        late = hot.wanted(_mixed_low(bucket, low))
                        x = np.concatenate([x[~late], x[late]])[:n_given]
                        sigs.append(x)
                        who.append(np.repeat(holder, len(x)))
                if sum(map(len, sigs)) > FLUSH:
                    yield _packed(sigs, who, bits)
                    sigs, who = [], []
        if sigs:
            yield _packed(sigs, who, bits)

    return run


_GIVEN = "bucket int, sigs binary, holders binary, many binary, a binary, b binary"


def _groups(sig: np.ndarray, who: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted and distinct (signature, holder), and the offsets of the signatures."""
    order = np.lexsort((who, sig))
    sig, who = sig[order], who[order]
    new = np.ones(len(sig), bool)
    new[1:] = (sig[1:] != sig[:-1]) | (who[1:] != who[:-1])
    sig, who = sig[new], who[new]
    begins = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1], [True]])) if len(sig) else np.zeros(1, np.int64)
    return sig, who, begins


def _stars(who: np.ndarray, begins: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For groups of frequent signatures: pairs with the first holder, and which rows are in such groups
    but not first."""
    sizes = np.diff(begins)
    large = np.repeat(frequent, sizes)
    first = np.repeat(who[begins[:-1]], sizes)
    rest = large.copy()
    rest[begins[:-1]] = False
    return first[rest], who[rest], rest


def _packed(sigs: list[np.ndarray], who: list[np.ndarray], bits: int) -> pa.RecordBatch:
    sig, holder, begins = _groups(np.concatenate(sigs), np.concatenate(who))
    frequent = np.diff(begins) > FEW
    many = np.repeat(frequent, np.diff(begins))
    a, b, rest = _stars(holder, begins, frequent)
    pairs = np.unique(np.stack([a, b], axis=1), axis=0)
    sig, holder, many = sig[~rest], holder[~rest], many[~rest]
    runs = _split(sig, bits)
    rows = [(k, sig[i:j].tobytes(), holder[i:j].tobytes(), sig[i:j][many[i:j]].tobytes(), b"", b"") for k, i, j in runs]
    rows.append((runs[0][0] if runs else 0, b"", b"", b"", pairs[:, 0].tobytes(), pairs[:, 1].tobytes()))
    kinds = (pa.int32(), *[pa.binary()] * 5)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=[c.split()[0] for c in _GIVEN.split(", ")])


def _met(bucket: pa.Table) -> pa.Table:
    """Distinct candidate pairs ``a < b`` of a bucket; ``star`` marks pairs of frequent signatures, those
    that have many holders here or had them in one task."""
    sig, who, many, a, b = (_numbers(bucket.column(c), _U) for c in ("sigs", "holders", "many", "a", "b"))
    sig, who, begins = _groups(sig, who)
    frequent = (np.diff(begins) > FEW) | np.isin(sig[begins[:-1]], many)
    more_a, more_b, _ = _stars(who, begins, frequent)
    star = np.stack([np.concatenate([a, more_a]), np.concatenate([b, more_b])], axis=1)
    sizes, found = np.diff(begins), []
    for n in range(2, FEW + 1):
        at = begins[:-1][(sizes == n) & ~frequent]
        if len(at):
            i, j = np.triu_indices(n, 1)
            found.append(np.stack([who[at[:, None] + i].ravel(), who[at[:, None] + j].ravel()], axis=1))
    few = np.concatenate([np.zeros((0, 2), _U), *found])
    size = (few & _U(_MOST_SIZE)).astype(np.int64)
    few = few[_near_sizes(size[:, 0], size[:, 1])]
    few, star = np.unique(few, axis=0), np.unique(star, axis=0)
    both = np.concatenate([few, star]).view(np.int64)
    flag = np.arange(len(both)) >= len(few)
    return pa.table({"a": pa.array(both[:, 0]), "b": pa.array(both[:, 1]), "star": pa.array(flag)})


def _near_sizes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether sets of these sizes can link; sizes at the limit of a ticket are let through."""
    low, high = np.minimum(a, b), np.maximum(a, b)
    return (100 * low >= PERCENT * high) | (high >= _MOST_SIZE)


def _sketches_allow(a: pd.Series, b: pd.Series, size_a: pd.Series, size_b: pd.Series) -> pd.Series:
    gap = [int(sketch_gap(np.frombuffer(x, _U), np.frombuffer(y, _U))) for x, y in zip(a, b)]
    return pd.Series((100 + PERCENT) * np.array(gap, np.int64) <= (100 - PERCENT) * (size_a + size_b).to_numpy(), dtype=bool)


def _possible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """``name_a, name_b`` of candidate pairs of tickets that their sketches do not rule out."""
    allow = F.pandas_udf(_sketches_allow, "boolean")
    one, two = (classes.select(F.col("ticket").alias(c), F.col("name").alias(f"name_{c}"), F.col("size").alias(f"size_{c}"), F.col("sketch").alias(f"sketch_{c}")) for c in ("a", "b"))
    met = pairs.join(one, "a").join(two, "b").where(f"100 * least(size_a, size_b) >= {PERCENT} * greatest(size_a, size_b)")
    left = met.where(allow("sketch_a", "sketch_b", "size_a", "size_b"))
    return left.selectExpr("least(name_a, name_b) as name_a", "greatest(name_a, name_b) as name_b").where("name_a <> name_b").distinct()


def _wanted_sets(rows: DataFrame, names: DataFrame, classes: DataFrame) -> DataFrame:
    """``name, shingles`` of the sets in ``names``, from the text of one document of each class.

    Which texts are wanted goes to the tasks as a filter of the hashes of texts, sized by their number; a
    text that only looks wanted costs its set once and is left out again. A task makes and sends each set
    once, however many copies it reads.
    """
    asked = stage(names.join(classes.select("name", "spot"), "name").select("name", F.col("spot").alias("h")), "wanted-sets")
    filter_ = Filter(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            batch = batch.filter(pa.array(filter_.wanted(batch.column("spot").to_numpy().view(_U))))
            fresh = []
            for spot in batch.column("spot").to_pylist():
                fresh.append(spot not in seen)
                seen.add(spot)
            batch = batch.filter(pa.array(fresh, pa.bool_()))
            texts = batch.column("text")
            for start, stop in slices(texts):
                sets = shingle_sets(texts[start:stop].to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([set_name(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["name", "shingles"]
                )

    sets = rows.select("spot", "text").mapInArrow(tidy(run), "name long, shingles binary")
    return sets.join(asked.select("name"), "name", "left_semi").dropDuplicates(["name"])


def _similar_sets(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


def _similar(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([_similar_sets(np.frombuffer(x, _U), np.frombuffer(y, _U)) for x, y in zip(a, b)], dtype=bool)


def exact_links(pairs: DataFrame, rows: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose whole sets are similar enough."""
    names = pairs.select(F.col("name_a").alias("name")).union(pairs.select("name_b")).distinct()
    sets = stage(_wanted_sets(rows, names, classes), "shingle-sets")
    similar = F.pandas_udf(_similar, "boolean")
    met = pairs.join(sets.select(F.col("name").alias("name_a"), F.col("shingles").alias("set_a")), "name_a").join(
        sets.select(F.col("name").alias("name_b"), F.col("shingles").alias("set_b")), "name_b"
    )
    return met.where(similar("set_a", "set_b")).select("name_a", "name_b")


def _reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links ``u, v`` of a task as stars around the smallest name that they reach among themselves, at most
    as many as there were; ``AT_ONCE`` links at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) > AT_ONCE:
            yield _star_links(held)
            held = []
    if held:
        yield _star_links(held)


def _star_links(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    ends = [np.concatenate([x.column(c).to_numpy() for x in held]) for c in ("u", "v")]
    names, at = np.unique(np.concatenate(ends), return_inverse=True)
    u, v = np.split(at, 2)
    root = np.arange(len(names))
    while len(apart := np.flatnonzero(root[u] != root[v])):
        u, v = u[apart], v[apart]
        low = np.minimum(root[u], root[v])
        np.minimum.at(root, np.maximum(root[u], root[v]), low)
        while (root != (nearer := root[root])).any():
            root = nearer
    leaf = np.flatnonzero(root != np.arange(len(names)))
    return pa.RecordBatch.from_arrays([pa.array(names[leaf]), pa.array(names[root[leaf]])], names=["u", "v"])


def _nodes(edges: DataFrame) -> DataFrame:
    """``u, low, high``: the smallest and the largest neighbour of every node."""
    both = edges.unionByName(edges.selectExpr("v as u", "u as v"))
    return both.groupBy("u").agg(F.min("v").alias("low"), F.max("v").alias("high"))


def stars(links: DataFrame) -> DataFrame:
    """``links(name_a, name_b)`` as stars, written to the shared folder: one link, perhaps repeated, from each name
    to the smallest one that it reaches.

    Alternating large and small stars: neighbours above a node, then below it, are moved to its
    smallest neighbour, until every node with a smaller neighbour has no other one. Every task
    first makes stars of the links that it has read, so that few rounds are left, and none where
    links are stars already. A step makes no more links than it got; none is dropped but copies within a
    task, so links pass a shuffle only to meet the smallest neighbours.
    """

    def reduced(edges: DataFrame, name: str) -> DataFrame:
        return stage(edges.mapInArrow(tidy(_reduced), "u long, v long"), name)

    edges = reduced(links.selectExpr("greatest(name_a, name_b) as u", "least(name_a, name_b) as v").where("u <> v"), "links")
    while not _nodes(edges).where("low < u and low < high").isEmpty():
        least = _nodes(edges).selectExpr("u", "least(low, u) as m")
        both = edges.unionByName(edges.selectExpr("v as u", "u as v"))
        large = reduced(both.where("v > u").join(least, "u").selectExpr("v as u", "m as v"), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        edges = reduced(large.join(least, "u").selectExpr("if(v = m, u, v) as u", "m as v"), "small-star")
    return edges.selectExpr("u as name_a", "v as name_b")


def components(links: DataFrame) -> DataFrame:
    """``name, component`` for the ends of ``links(name_a, name_b)``: the smallest name reachable."""
    return _labels(stars(links))


def _labels(joined: DataFrame) -> DataFrame:
    """``name, component`` of the names in stars."""
    return _nodes(joined.selectExpr("name_a as u", "name_b as v")).selectExpr("u as name", "least(low, u) as component")


def _forest(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Links between the sets of two blocks (or of one) that join components, fewer than the sets.

    The component of every set is followed as links join them, and a set is only compared with sets of
    other components of near sizes and near sketches."""
    names = np.concatenate([left["name"], right["name"]])
    of = np.unique(np.concatenate([left["component"], right["component"]]), return_inverse=True)[1]
    sizes = np.concatenate([left["size"], right["size"]]).astype(np.int64)
    marks = [np.frombuffer(s, _U) for s in [*left["sketch"], *right["sketch"]]]
    sets = [np.frombuffer(s, _U) for s in [*left["shingles"], *right["shingles"]]]
    wide = {}
    for i in range(len(left), len(names)):
        wide.setdefault(len(marks[i]), []).append(i)
    tables = [(np.array(at), np.stack([marks[i] for i in at])) for at in wide.values()]
    out = []
    for i in range(len(left)):
        for at, table in tables:
            apart = np.flatnonzero(_near_sizes(sizes[i], sizes[at]) & (of[at] != of[i]))
            gap = sketch_gap(marks[i], table[apart]).astype(np.int64) if len(apart) else apart
            apart = at[apart[(100 + PERCENT) * gap <= (100 - PERCENT) * (sizes[i] + sizes[at[apart]])]]
            for j in apart.tolist():
                if of[i] != of[j] and _similar_sets(sets[i], sets[j]):
                    out.append((names[i], names[j]))
                    of[of == of[j]] = of[i]
    return pd.DataFrame(out, columns=["name_a", "name_b"], dtype=np.int64)


def _poor_blocks(poor: DataFrame, labels: DataFrame, rows: DataFrame, classes: DataFrame) -> DataFrame:
    """``block, span, name, size, sketch, shingles`` of the poor sets: sets of near sizes, of one component if
    it is large, else of some. A block holds about ``BLOCK`` sets, fewer where they are large."""
    known = poor.join(classes, "ticket").join(labels, "name", "left")
    known = stage(known.select("name", "size", "sketch", F.coalesce("component", "name").alias("component")).dropDuplicates(["name"]), "poor-sets")
    span = F.floor(F.log("size") / math.log(100 / PERCENT)).cast("int")
    spanned = known.withColumn("span", span)
    room = F.greatest(F.lit(2), F.least(F.lit(BLOCK), F.floor(BLOCK_SHINGLES / F.pow(F.lit(100 / PERCENT), F.col("span") + 1)))).cast("long")
    sizes = spanned.groupBy("component", "span").agg(F.count(F.lit(1)).alias("members"))
    groups = sizes.groupBy("span").agg(F.ceil(F.sum("members") / F.first(room)).alias("groups"))
    part = F.pmod(F.xxhash64("name"), F.ceil(F.col("members") / room))
    group = F.pmod(F.xxhash64("component"), F.col("groups"))
    placed = spanned.join(sizes, ["component", "span"]).join(groups, "span")
    placed = placed.select("name", "size", "sketch", "span", F.concat_ws("-", "span", group, part).alias("block"))
    sets = _wanted_sets(rows, known.select("name"), classes)
    return stage(placed.join(sets, "name"), "poor-blocks")


def _met_blocks(blocked: DataFrame, labels: DataFrame, met: DataFrame) -> DataFrame:
    """Links found where the blocks of ``met(block_a, block_b, pair)`` meet; ``labels`` are the components so far."""
    fields = [F.col(c).alias(c) for c in ("pair", "name", "size", "sketch", "shingles", "component")]
    current = blocked.join(labels, "name", "left").withColumn("component", F.coalesce("component", "name"))
    sides = [current.join(met.select(F.col(f"block_{k}").alias("block"), "pair"), "block").select(*fields) for k in "ab"]
    found = sides[0].groupBy("pair").cogroup(sides[1].groupBy("pair")).applyInPandas(_forest, "name_a long, name_b long")
    return stage(found, "links-between")


def between_components(poor: DataFrame, links: DataFrame, rows: DataFrame, classes: DataFrame) -> DataFrame:
    """``links`` as stars, and those links that the poor sets of different components still lack to be joined.

    Every block meets itself first, then those of the same and the next sizes, but never a block whose
    sets are all of the same component as its own."""
    joined = stars(links)
    labels = _labels(joined)
    blocked = _poor_blocks(poor, labels, rows, classes)
    own = blocked.select(F.col("block").alias("block_a"), F.col("block").alias("block_b"), F.col("block").alias("pair")).distinct()
    joined = stars(joined.unionByName(_met_blocks(blocked, labels, own)))
    labels = _labels(joined)
    current = blocked.select("block", "span", "name").join(labels, "name", "left").withColumn("component", F.coalesce("component", "name"))
    blocks = current.groupBy("block", "span").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    one, two = (blocks.select(*[F.col(c).alias(f"{c}_{k}") for c in blocks.columns]) for k in "ab")
    two = two.withColumn("span_a", F.explode(F.array("span_b", F.col("span_b") - 1)))
    met = one.join(two, "span_a").where(
        "(span_a < span_b or block_a < block_b) and not (least_a = most_a and least_b = most_b and least_a = least_b)"
    )
    met = stage(met.select("block_a", "block_b", F.concat_ws("|", "block_a", "block_b").alias("pair")), "block-pairs")
    return joined.unionByName(_met_blocks(blocked, labels, met))


def link(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, spot (a hash of the text), n_shingles, component (the smallest key that links
    reach), and cluster, a number of the component that also tells those without keys apart; it is null
    where a document has no shingles."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).withColumn("spot", F.xxhash64("text"))
    planned = rows.count() * PER_DOCUMENT
    bits = min(24, max(6, math.ceil(math.log2(max(planned / PER_BUCKET, 1)))))
    measured = stage(rows.mapInArrow(tidy(_measure(bits)), _MEASURED), "shingle-counts")
    owned = measured.where("bucket is null").select("key", "spot", "size", "name", "sketch")
    classes = owned.where("size > 0").groupBy("name").agg(
        F.min("key").alias("key"), F.min("spot").alias("spot"), F.max("size").alias("size"), F.max("sketch").alias("sketch")
    )
    number = F.pandas_udf(lambda name, size: pd.Series(ticket(name.to_numpy(), size.to_numpy()).view(np.int64)), "long")
    classes = stage(classes.withColumn("ticket", number("name", "size")), "shingle-classes")
    counted = measured.where("bucket is not null").select("bucket", "low", "times")
    hot = Filter(stage(counted.groupBy("bucket").applyInArrow(_frequent, "h long").distinct(), "frequent-signatures"))
    given = rows.select("text").mapInArrow(tidy(_give(bits, hot)), _GIVEN)
    met = stage(given.groupBy("bucket").applyInArrow(_met, "a long, b long, star boolean"), "candidates")
    first = stage(_possible(met.select("a", "b").distinct(), classes), "possible-links")
    links = stage(exact_links(first, rows, classes), "links-found")
    poor = met.where("star").select(F.explode(F.array("a", "b")).alias("ticket")).distinct()
    final = components(between_components(poor, links, rows, classes))
    told = classes.join(final, "name", "left").select("name", F.col("key").alias("class_key"), F.coalesce("component", "name").alias("component"))
    least = told.groupBy("component").agg(F.min("class_key").alias("least"))
    named = stage(told.join(least, "component").select("name", F.col("component").alias("cluster"), "least"), "component-keys")
    joined = owned.join(named, "name", "left")
    has_words = F.col("size") > 0
    return joined.select(
        "key", "spot", F.col("size").alias("n_shingles"), F.when(has_words, F.col("least")).otherwise(F.col("key")).alias("component"), F.when(has_words, F.col("cluster")).alias("cluster")
    )


def one_of_each(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without near copies, with their own columns: of linked documents the one with the
    smallest key, nulls last, and of these the one whose text has the smallest hash. Documents without
    shingles all stay."""
    linked = link(docs, key=key, text=text)
    first = F.min(F.struct(F.col("key").isNull().alias("unknown"), "key", "spot")).alias("head")
    heads = linked.where("cluster is not null").groupBy("cluster").agg(first).select("head.key", "head.spot")
    kept = heads.unionByName(linked.where("cluster is null").select("key", "spot")).distinct()
    kept = stage(kept, "group-heads")
    plain, (own_key, own_text) = plain_names(docs, key, text)
    same = F.col(own_key).cast("long").eqNullSafe(F.col("key")) & (F.xxhash64(own_text) == F.col("spot"))
    return plain.join(kept, same, "left_semi").toDF(*docs.columns)
