"""Sampled SentencePiece segmentations without replacement, and their decoding.

All segmentations of a text into vocabulary pieces form a lattice. Each has a probability from the
pieces, which is normalised exactly by summing the lattice backwards. Sampling ``k`` different ones
without replacement is the search for the ``k`` largest when every segmentation gets a Gumbel
perturbation, and that search runs over sets of segmentations: the agenda holds regions (a common
beginning and the pieces that may not follow it), each with its exact perturbed maximum as bound. The
best region is opened, its maximum is drawn as a path through the lattice, and what is left of the
region is split along that path into regions of their own, with maxima truncated below the one just
drawn. The ``k + 1``-th maximum is the threshold of the inclusion scores.

No piece of the vocabulary goes over the end of a word, so the lattice of a text is a chain of small
ones, made once for each distinct word of a slice. All random numbers are a hash of the row key, the
sample and the place, so a row gets the same samples in any partition and after any retry.

The vocabulary is read on the driver from a path and sent along, since it is bounded by its file. Its
scores are ranks of merges; piece probabilities fall with the rank (Zipf's law), ``flat`` flattens
them. Nothing is trained.

Defined results: null and empty texts have one segmentation, the empty one; a text with fewer than
``k`` segmentations gets all of them, with inclusion 1; characters without a piece become bytes, as
does a literal U+2581, so that decoding gives back every text exactly; rows that share key and text
get equal samples. Other columns of any name do no harm.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.batches import mix64, numbered, offsets, slices, tidy

SPACE = "▁"
_LITERAL = "\udc00"  # stands for a literal U+2581; no valid text holds it
_BASE = np.uint64(0x100000001B3)
_NEVER = -np.inf
SLICE = 100_000  # bytes of text whose words share a lattice
_ALL = (1 << 64) - 1


@dataclass
class Vocabulary:
    """Hash, length, id and log probability of all pieces, byte pieces, and the text of every id.

    A hash is looked up by its low bits (``slots``), and by other bits where two pieces share a slot.
    Both tables hold places of pieces, 0 for none: the first piece stands for no piece.
    """

    hashes: np.ndarray
    lengths: np.ndarray
    ids: np.ndarray
    logs: np.ndarray
    slots: tuple[np.ndarray, np.ndarray]
    begun: np.ndarray  # by the low bits of a hash: whether a longer piece may begin like that
    longest: int
    byte_ids: np.ndarray
    byte_log: float
    spelled: list[bytes]

    def find(self, hashed: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are pieces of a length, and the places of these pieces."""
        first = self.slots[0][hashed & _SLOTS]
        maybe = np.flatnonzero(first)
        at, wanted = first[maybe], hashed[maybe]
        other = np.flatnonzero(self.hashes[at] != wanted)
        at[other] = self.slots[1][(wanted[other] >> np.uint64(24)) & _SLOTS]
        good = (self.hashes[at] == wanted) & (self.lengths[at] == length)
        return maybe[good], at[good]


_SLOTS = np.uint64((1 << 20) - 1)


def _slots(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    tables = np.zeros(1 << 20, np.int32), np.zeros(1 << 20, np.int32)
    for i in range(1, len(hashes)):
        h = int(hashes[i])
        low, high = h & int(_SLOTS), (h >> 24) & int(_SLOTS)
        if not tables[0][low]:
            tables[0][low] = i
        elif not tables[1][high]:
            tables[1][high] = i
        else:
            raise ValueError("the vocabulary is too large for its tables")
    return tables


def load(model_file: str, flat: float = 1.0) -> Vocabulary:
    """Read a SentencePiece model with byte pieces."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=model_file)
    ids = range(model.vocab_size())
    byte_ids = np.full(256, -1, np.int64)
    spelled, normal = [b""] * len(ids), []
    for i in ids:
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            spelled[i] = bytes([int(piece[3:5], 16)])
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            if "\n" in piece or SPACE in piece.lstrip(SPACE):
                raise ValueError(f"piece {piece!r} goes over the end of a word")
            spelled[i] = piece.replace(SPACE, " ").encode()
            normal.append((-model.get_score(i), i, piece))
    if (byte_ids < 0).any():
        raise ValueError("the model has no byte pieces")
    normal.sort()
    log = -flat * np.log(np.arange(1, len(normal) + 2))
    log -= np.log(np.exp(log[:-1]).sum() + 256 * np.exp(log[-1]))
    whole, begins = [], []
    for _, _, piece in normal:
        rolled = 0
        for n, c in enumerate(piece):
            if n:
                begins.append(rolled)
            rolled = (rolled * int(_BASE) + ord(c)) & _ALL
        whole.append(rolled)
    hashes = np.concatenate([np.zeros(1, np.uint64), mix64(np.array(whole, np.uint64))])
    lengths = np.array([0, *(len(piece) for _, _, piece in normal)], np.int64)
    begun = np.zeros(1 << 20, bool)
    begun[mix64(np.array(begins, np.uint64)) & _SLOTS] = True
    ids = np.array([0, *(i for _, i, _ in normal)], np.int64)
    logs = np.concatenate([[0.0], log[:-1]])
    longest = int(lengths.max())
    return Vocabulary(hashes, lengths, ids, logs, _slots(hashes), begun, longest, byte_ids, float(log[-1]), spelled)


class Lattice:
    """The lattices of distinct words side by side. Nodes are places in a word, ends included; the
    edges of a node stand together, with their probabilities given the node as running sums."""

    def __init__(self, words: list[str] | tuple[np.ndarray, np.ndarray], vocabulary: Vocabulary) -> None:
        """``words``: texts, or the code points of all of them and their lengths."""
        codes, lengths = words if isinstance(words, tuple) else (_codes(words), np.fromiter(map(len, words), np.int64, len(words)))
        codes = codes.astype(np.uint64)
        begins = offsets(lengths)
        small = np.int32  # a slice has far fewer than 2^31 edges; half the memory of long numbers
        of = np.repeat(np.arange(len(lengths), dtype=small), lengths)
        left = (begins[1:][of] - np.arange(len(codes))).astype(small)  # characters to the end of the word
        node = np.arange(len(codes), dtype=small) + of
        self.first = begins[:-1] + np.arange(len(lengths))
        self.last = self.first + lengths
        found = []
        covered = np.zeros(len(codes), bool)
        inside, rolled = np.arange(len(codes), dtype=small), np.zeros(len(codes), np.uint64)
        for n in range(1, vocabulary.longest + 1):
            if n > 1:
                longer = np.flatnonzero((left[inside] >= n) & vocabulary.begun[hashed & _SLOTS])
                inside, rolled = inside[longer], rolled[longer]
            rolled = rolled * _BASE + codes[inside + (n - 1)]
            hashed = mix64(rolled)
            hit, at = vocabulary.find(hashed, n)
            where, ids, logs = inside[hit], vocabulary.ids[at], vocabulary.logs[at]
            if n == 1:
                covered[where] = True
            found.append((where, n, ids, logs))
        bare = np.flatnonzero(~covered)
        spelled = [(SPACE if c == ord(_LITERAL) else chr(c)).encode() for c in codes[bare].tolist()]
        found.insert(0, (bare, 1, -1 - np.arange(len(bare)), vocabulary.byte_log * np.array([len(b) for b in spelled], float)))
        degree = sum((np.bincount(where, minlength=len(codes)) for where, *_ in found), np.zeros(len(codes), np.int64))
        begins_at = offsets(degree)
        free = begins_at[:-1].copy()
        n_edges = int(begins_at[-1])
        size, piece, log = np.empty(n_edges, small), np.empty(n_edges, small), np.empty(n_edges)
        for where, n, ids, logs in reversed(found):  # long pieces first: they are the likely ones
            at = free[where]
            size[at], piece[at], log[at] = n, ids, logs
            free[where] += 1
        start = np.repeat(np.arange(len(codes), dtype=small), degree)
        del found, free
        self.source = node[start]
        self.target = self.source + size
        self.sums = self._backward(left[start], log)
        given = log + self.sums[self.target] - self.sums[self.source]
        self.log = np.minimum(given, 0)
        self.share = np.exp(given)
        n_nodes = len(codes) + len(lengths)
        self.begin, self.count, self.ends = np.zeros(n_nodes, small), np.zeros(n_nodes, small), np.zeros(n_nodes, bool)
        self.begin[node], self.count[node] = begins_at[:-1], degree
        self.ends[self.last] = True
        self.running = np.cumsum(self.share)
        if n_edges:
            self.running -= np.repeat(self.running[begins_at[:-1]] - self.share[begins_at[:-1]], degree)
            self.running[begins_at[1:] - 1] = 2.0  # the last edge of a node takes what rounding leaves
        with np.errstate(divide="ignore"):
            self.others = np.where(degree[start] == 1, _NEVER, np.log(np.maximum(1 - self.share, 1e-300)))
        n_bytes = np.ones(n_edges, small)
        odd = np.flatnonzero(piece < 0)
        n_bytes[odd] = [len(spelled[-1 - p]) for p in piece[odd].tolist()]
        self.id_begin, self.id_count = offsets(n_bytes).astype(small), n_bytes
        self.ids = np.repeat(piece, n_bytes)
        for e in odd.tolist():
            self.ids[self.id_begin[e] : self.id_begin[e + 1]] = vocabulary.byte_ids[list(spelled[-1 - piece[e]])]

    def _backward(self, left: np.ndarray, log: np.ndarray) -> np.ndarray:
        """Log of the summed probabilities from every node to the end of its word: all nodes at the
        same distance from their ends at once, from the ends outwards."""
        sums = np.zeros(int(self.last[-1]) + 1 if len(self.last) else 0)
        furthest = int(left.max(initial=0))
        order = np.argsort(left.astype(np.uint16) if furthest < 1 << 16 else left, kind="stable")
        ends = np.cumsum(np.bincount(left, minlength=furthest + 1))[1:]
        begin = 0
        for end in ends.tolist():
            edges = order[begin:end]
            begin = end
            if not len(edges):
                continue
            at = self.source[edges]
            head = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            sums[at[head]] = np.logaddexp.reduceat(log[edges] + sums[self.target[edges]], head)
        return sums

    def walk(self, nodes: np.ndarray, stops: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Draw a path from each node to its stop; the edges one path after the other, and offsets."""
        who, edges = [], []
        active = np.flatnonzero(nodes != stops)
        at = nodes[active]
        step = 0
        while len(active):
            u = uniform(seeds[active], step)
            edge = self.begin[at]
            later = np.flatnonzero(u > self.running[edge])
            while len(later):
                edge[later] += 1
                later = later[u[later] > self.running[edge[later]]]
            who.append(active)
            edges.append(edge)
            at = self.target[edge]
            going = ~self.ends[at]
            active, at = active[going], at[going]
            step += 1
        if not who:
            return np.empty(0, np.int64), np.zeros(len(nodes) + 1, np.int64)
        who, edges = np.concatenate(who), np.concatenate(edges)
        return edges[np.argsort(who, kind="stable")], offsets(np.bincount(who, minlength=len(nodes)))


def uniform(seeds: np.ndarray, step: int | np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) that depend on seed and step alone."""
    mixed = mix64(seeds + np.asarray(step).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    return np.clip((mixed >> np.uint64(11)).astype(np.float64) * 2.0**-53, 1e-16, 1 - 1e-9)


def _bounded(mass: np.ndarray, bound: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Maxima of regions with log probability ``mass``, given that they are below ``bound``."""
    with np.errstate(over="ignore", divide="ignore"):
        gumbel = mass - np.log(-np.log(u))
        return -np.logaddexp(-bound, -gumbel)


def _codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


def _cut(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the marked texts, where their words begin (and the end), and where the texts begin
    among the words. A word is a line break, or a run of spaces and what follows up to the next of either."""
    marked = [" " + t if t else "" for t in texts]
    codes = _codes(marked).copy()
    codes[codes == ord(SPACE)] = ord(_LITERAL)
    codes[codes == ord(" ")] = ord(SPACE)
    space, line = codes == ord(SPACE), codes == ord("\n")
    begin = line.copy()
    begin[1:] |= line[:-1] | (space[1:] & ~space[:-1])
    spans = offsets([len(t) for t in marked])
    begin[spans[:-1][spans[:-1] < spans[1:]]] = True
    words = np.append(np.flatnonzero(begin), len(codes))
    return codes, words, np.searchsorted(words, spans)


def _distinct(codes: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """For each word the number of its first like, and code points and lengths of the distinct words."""
    lengths = np.diff(begins)
    if not len(lengths):
        return np.zeros(0, np.int64), (codes, lengths)
    within = np.arange(len(codes)) - np.repeat(begins[:-1], lengths)
    powers = np.cumprod(np.full(int(lengths.max()) + 1, _BASE, np.uint64))
    hashed = np.add.reduceat((codes.astype(np.uint64) + np.uint64(1)) * powers[within], begins[:-1]) + lengths.astype(np.uint64)
    index, _ = pd.factorize(hashed)
    first = np.full(int(index.max()) + 1, -1, np.int64)
    first[index[::-1]] = np.arange(len(index))[::-1]
    like = first[index]
    if (lengths != lengths[like]).any() or (codes != codes[np.repeat(begins[like], lengths) + within]).any():
        shown = [codes[a:b].tobytes() for a, b in zip(begins[:-1], begins[1:])]  # two words share a hash
        index, _ = numbered(shown)
        first = np.unique(index, return_index=True)[1]
    sizes = lengths[first]
    ends = offsets(sizes)
    return index, (codes[np.arange(ends[-1]) - np.repeat(ends[:-1] - begins[first], sizes)], sizes)


def _number(seed: int, *parts: int) -> int:
    """A 64-bit number from a seed and small numbers."""
    for p in parts:
        seed = (seed ^ (seed >> 29)) * 0xBF58476D1CE4E5B9 + (p + 1) * 0xD1342543DE82EF95 & _ALL
    return (seed ^ (seed >> 32)) * 0x94D049BB133111EB & _ALL


def _one(seed: int) -> float:
    return min(max((seed >> 11) * 2.0**-53, 1e-16), 1 - 1e-9)


class _Sampler:
    """The agenda of one text: its samples so far and the regions they leave."""

    def __init__(self, key: str) -> None:
        self.seed = xxhash.xxh64_intdigest(key.encode("utf-8", "replace"))
        self.paths: list[np.ndarray] = []
        self.logs: list[np.ndarray] = []  # running log probability, with 0 in front
        self.tops: list[np.ndarray] = []  # maxima of the regions from step ``self.at`` on
        self.at: list[int] = []
        self.best: list[tuple[float, int]] = []  # of each path: the largest of them and its step
        self.barred: dict[tuple[int, int], list[int]] = {}
        self.values: list[float] = []

    def add(self, path: np.ndarray, at: int, value: float, barred: list[int], logs: np.ndarray, tops: np.ndarray) -> None:
        """A path drawn as the maximum ``value`` of the region that leaves a common beginning at step
        ``at`` where the edges ``barred`` were taken before, with the maxima of the regions it leaves."""
        n = len(self.paths)
        if len(path):
            self.barred[n, at] = [*barred, int(path[at])]
        self.paths.append(path)
        self.logs.append(logs)
        self.tops.append(tops)
        self.at.append(at)
        self.values.append(value)
        self.best.append((_NEVER, 0))
        self._find(n)

    def _find(self, n: int) -> None:
        if len(self.tops[n]):
            step = int(self.tops[n].argmax())
            self.best[n] = float(self.tops[n][step]), self.at[n] + step

    def take(self) -> tuple[int, int, float] | None:
        """Path and step of the region with the largest maximum, which leaves the agenda."""
        (value, step), n = max((b, -i) for i, b in enumerate(self.best))
        if value == _NEVER:
            return None
        self.tops[-n][step - self.at[-n]] = _NEVER
        self._find(-n)
        return -n, step, value


def _add_all(lattice: Lattice, drawn: list[tuple[_Sampler, np.ndarray, int, float, list[int], np.ndarray]]) -> None:
    """One more path for each of some texts: sampler, path, the step where it turns off, its value, the edges
    barred there, and the running logs up to there. What holds for single steps is computed for all
    texts at once."""
    sizes = [len(path) - at for _, path, at, *_ in drawn]
    begins = offsets(sizes)
    new = np.concatenate([path[at:] for _, path, at, *_ in drawn])
    steps = np.arange(len(new)) - np.repeat(begins[:-1] - np.array([at for _, _, at, *_ in drawn]), sizes)
    seeds = np.array([_number(s.seed, len(s.paths), 0) for s, *_ in drawn], np.uint64)
    logs, others = lattice.log[new], lattice.others[new]
    before = np.empty(len(new))
    through = []
    cuts = begins.tolist()
    for (s, path, at, _, barred, logs_before), a, b in zip(drawn, cuts[:-1], cuts[1:]):
        running = np.concatenate([logs_before, logs_before[-1] + np.cumsum(logs[a:b])])
        through.append(running)
        before[a:b] = running[at:-1]
        if barred:
            node = lattice.source[path[at]]
            taken = {*barred, int(path[at])}
            left = sum(lattice.share[e] for e in range(lattice.begin[node], lattice.begin[node] + lattice.count[node]) if e not in taken)
            others[a] = np.log(left) if left > 0 else _NEVER
    mass = before + others
    tops = _bounded(mass, np.repeat([value for _, _, _, value, _, _ in drawn], sizes), uniform(np.repeat(seeds, sizes), steps))
    tops[mass == _NEVER] = _NEVER
    for (s, path, at, value, barred, _), running, a, b in zip(drawn, through, cuts[:-1], cuts[1:]):
        s.add(path, at, value, barred, running, tops[a:b])


def sample(texts: list[str | None], keys: list[str], k: int, vocabulary: Vocabulary) -> tuple[Lattice, list[_Sampler]]:
    """The ``k`` largest perturbed segmentations of every text, fewer where there are no more, and the
    next largest perturbed value, which needs no path."""
    codes, word_begins, begins = _cut(texts)
    index, distinct = _distinct(codes, word_begins)
    lattice = Lattice(distinct, vocabulary)
    samplers = [_Sampler(key) for key in keys]
    whole = np.arange(len(index)) - np.repeat(begins[:-1], np.diff(begins))
    seeds = np.array([_number(s.seed, 0, 1) for s in samplers], np.uint64)
    edges, words_at = lattice.walk(lattice.first[index], lattice.last[index], mix64(np.repeat(seeds, np.diff(begins)) + whole.astype(np.uint64)))
    cuts = words_at[begins].tolist()
    nothing = np.zeros(1)
    values = [float(-np.log(-np.log(_one(_number(s.seed, 0, 2))))) for s in samplers]
    if samplers:
        _add_all(lattice, [(s, edges[a:b], 0, value, [], nothing) for s, value, a, b in zip(samplers, values, cuts[:-1], cuts[1:])])
    for n in range(1, k):
        jobs, nodes, stops, seeds, sizes = [], [], [], [], []
        for i, s in enumerate(samplers):
            top = s.take() if len(s.paths) == n else None
            if top is None:
                continue
            of, at, value = top
            path = s.paths[of]
            barred = s.barred.get((of, at), [int(path[at])])
            node = lattice.source[path[at]]
            open_ = [e for e in range(lattice.begin[node], lattice.begin[node] + lattice.count[node]) if e not in barred]
            aim = _one(_number(s.seed, n, 3)) * sum(lattice.share[e] for e in open_)
            turn = open_[-1]
            for e in open_:
                aim -= lattice.share[e]
                if aim < 0:
                    turn = e
                    break
            word = int(np.count_nonzero(lattice.ends[lattice.target[path[:at]]]))
            rest = index[begins[i] + word : begins[i + 1]]
            first = lattice.first[rest]
            first[0] = lattice.target[turn]
            jobs.append((s, of, at, value, barred, turn))
            nodes.append(first)
            stops.append(lattice.last[rest])
            seeds.append(mix64(np.uint64(_number(s.seed, n, 1)) + np.arange(word, word + len(rest)).astype(np.uint64)))
            sizes.append(len(rest))
        if not jobs:
            break
        edges, words_at = lattice.walk(np.concatenate(nodes), np.concatenate(stops), np.concatenate(seeds))
        cuts = words_at[offsets(sizes)].tolist()
        drawn = []
        for (s, of, at, value, barred, turn), a, b in zip(jobs, cuts[:-1], cuts[1:]):
            path = np.concatenate([s.paths[of][:at], [turn], edges[a:b]])
            drawn.append((s, path, at, value, barred, s.logs[of][: at + 1]))
        _add_all(lattice, drawn)
    for s in samplers:
        top = s.take() if len(s.paths) == k else None
        if top is not None:
            s.values.append(top[2])
    return lattice, samplers


def ids_of(lattice: Lattice, paths: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Vocabulary ids along paths, bytes written out, one path after the other, and where each begins."""
    path = np.concatenate([np.zeros(0, np.int64), *paths])
    begin, count = lattice.id_begin[path], lattice.id_count[path]
    ends = offsets(count)
    ids = lattice.ids[np.arange(ends[-1]) - np.repeat(ends[:-1] - begin, count)]
    return ids, ends[offsets([len(p) for p in paths])]


class Speller:
    """The bytes of all ids side by side, to spell many sequences at once."""

    def __init__(self, spelled: list[bytes]) -> None:
        self.begins = offsets([len(b) for b in spelled])
        self.data = np.frombuffer(b"".join(spelled), np.uint8)

    def exact(self, ids: np.ndarray, begins: np.ndarray, texts: list[bytes]) -> np.ndarray:
        """Whether each sequence of ids spells its text, whose first byte is the space that encoding adds."""
        sizes = self.begins[ids + 1] - self.begins[ids]
        ends = offsets(sizes)
        made = self.data[np.arange(ends[-1]) - np.repeat(ends[:-1] - self.begins[ids], sizes)]
        spans = ends[begins]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        right = np.diff(spans) == lengths
        if right.all():
            differs = np.flatnonzero(made != np.frombuffer(b"".join(texts), np.uint8))
            right[np.searchsorted(spans, differs, "right") - 1] = False
            return right
        return np.array([made[a:b].tobytes() == t for a, b, t in zip(spans[:-1], spans[1:], texts)], bool)


def spell(ids: list[int], spelled: list[bytes]) -> str:
    """The text of a sequence of ids: the reverse of encoding."""
    return b"".join([spelled[i] for i in ids])[1:].decode("utf-8", "replace")


def _rows(vocabulary: Vocabulary, k: int, check: bool):
    speller = Speller(vocabulary.spelled) if check else None

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column("key"), batch.column("text")
            for start, stop in slices(texts, SLICE):
                given = texts[start:stop].to_pylist()
                lattice, samplers = sample(given, [str(x) for x in keys[start:stop].to_pylist()], k, vocabulary)
                at, number, log, inclusion, paths = [], [], [], [], []
                for i, s in enumerate(samplers):
                    limit = s.values[k] if len(s.values) > k else _NEVER
                    for n, (path, logs) in enumerate(zip(s.paths, s.logs)):
                        over = math.exp(min(logs[-1] - limit, 50.0))
                        at.append(i)
                        number.append(n + 1)
                        log.append(float(logs[-1]))
                        inclusion.append(float(min(logs[-1] - limit, 0.0)) if over < 1e-9 else math.log(-math.expm1(-over)))
                        paths.append(path)
                ids, begins = ids_of(lattice, paths)
                lists = pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(ids.astype(np.int32)))
                columns = [keys.take(pa.array([start + i for i in at], pa.int64()))]
                columns += [pa.array(number, pa.int32()), pa.array(log, pa.float64()), pa.array(inclusion, pa.float64()), lists]
                names = ["key", "sample", "log_prob", "log_inclusion", "ids"]
                if speller:
                    expected = [b" " + t.encode() if t else b"" for t in given]
                    exact = speller.exact(ids, begins, [expected[i] for i in at])
                    columns, names = [*columns, pa.array(exact, pa.bool_())], [*names, "round_trip"]
                del lattice, samplers, paths, ids
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return made


def encode(docs: DataFrame, vocabulary: Vocabulary, k: int, *, key: str = "doc_id", text: str = "text", check: bool = False) -> DataFrame:
    """``key, sample, log_prob, log_inclusion, ids``: up to ``k`` different segmentations of every text,
    the first with the largest perturbed value. ``log_prob`` is normalised over the lattice;
    ``log_inclusion`` is the log probability of being above the threshold of the ``k + 1``-th.
    With ``check`` every sample is decoded again and ``round_trip`` says whether the text came back."""
    kind = docs.schema[key].dataType.simpleString()
    kinds = f"key {kind}, sample int, log_prob double, log_inclusion double, ids array<int>" + ", round_trip boolean" * check
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(tidy(_rows(vocabulary, k, check)), kinds)


def decode(encoded: DataFrame, vocabulary: Vocabulary, *, ids: str = "ids") -> DataFrame:
    """``encoded`` with the column ``text`` for its ids; null ids give a null text."""
    spelled = vocabulary.spelled

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [None if x is None else spell(x, spelled) for x in batch.column("__ids").to_pylist()]
            rest = [c for c in batch.schema.names if c != "__ids"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(made, pa.string())], names=[*rest, "text"])

    rest = [c for c in encoded.columns if c != "text"]
    kinds = ", ".join(f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in rest)
    return encoded.select(*rest, F.col(ids).alias("__ids")).mapInArrow(texts, f"{kinds}, text string")
