"""Quality scores by attention-based multiple-instance learning.

A document is a bag of passages, and only the document has a label. Every passage is encoded by a
small network from measurements of its characters and words; gated attention gives each passage a
weight within its document; the weighted sum of the encodings is scored. Encoder, attention and score
are trained together from the labels of documents.

Training takes a documented, bounded sample of labelled rows (``PER_CLASS`` documents of each label,
chosen by a hash of the key). What is measured in a passage is computed inside tasks; only the
measurements of the sample, ``FEATURES`` numbers a passage, reach the driver, where the network is
fitted. Scoring reads whole texts, all passages, slice by slice, and shuffles nothing.

Defined results: null and empty texts are a bag with one empty passage and get its score; documents
without a label are scored but not learned from; with no labelled row every score is 0.5; repeated
rows get equal scores. Other columns of any name do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.sampling import smallest_of_each
from tablecraft.llm.batches import group_sums, mix64, numbered, offsets, plain_names, slices, tidy

PER_CLASS = 1500  # documents of the sample per label
PASSAGE = 64  # words of a passage
HIDDEN, GATE = 24, 12
STEPS, RATE, DECAY = 300, 0.02, 1e-4
# Character classes, fixed values: class number by code point below 128; 0 for all others below.
CLASSES = ("\t\n\v\f\r", " ", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".", ",", "!?", "|", "#$%&*", "<>{}[]\\", "\"'`", "()", "-_/", "@:;=+~^")
FEATURES = 2 * (len(CLASSES) + 2) + 11
_TABLE = np.zeros(256, np.int64)
for _n, _chars in enumerate(CLASSES):
    for _c in _chars:
        _TABLE[ord(_c)] = _n + 1
_TABLE[128:] = len(CLASSES) + 1


def _repeats(group: np.ndarray, item: np.ndarray) -> np.ndarray:
    """Whether the same item occurs again in the same group."""
    pair = mix64(group.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + item)
    _, back, counts = np.unique(pair, return_inverse=True, return_counts=True)
    return counts[back] > 1


def measure(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """``FEATURES`` numbers for every passage of every text, and the offsets of the texts."""
    split = [(t or "").encode("utf-8", "replace").split() or [b""] for t in texts]
    counts = np.array([len(s) for s in split])
    passages = -(-counts // PASSAGE)
    begins = offsets(passages)
    doc = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(len(doc)) - np.repeat(offsets(counts)[:-1], counts)
    passage = begins[doc] + place // PASSAGE
    total = int(begins[-1])
    index, distinct = numbered([w for s in split for w in s])
    sizes = np.array([len(w) for w in distinct])
    data = np.frombuffer(b"".join(distinct), np.uint8)
    word_of = np.repeat(np.arange(len(distinct)), sizes)
    kinds = len(CLASSES) + 2
    by_word = np.bincount(word_of * kinds + _TABLE[data], minlength=len(distinct) * kinds).reshape(len(distinct), kinds).astype(float)
    ends = offsets(sizes)[1:] - 1
    last = np.zeros((len(distinct), kinds))
    some = np.flatnonzero(sizes)
    last[some, _TABLE[data[ends[some]]]] = 1
    words_at = offsets(np.bincount(passage, minlength=total))
    n_words = np.maximum(np.diff(words_at), 1)[:, None]
    chars = group_sums(by_word[index], words_at)
    length = sizes[index].astype(float)
    share = chars / np.maximum(chars.sum(axis=1, keepdims=True), 1)
    endings = group_sums(last[index], words_at) / n_words
    hashed = index.astype(np.uint64)
    same_next = np.zeros(len(index))
    same_next[1:] = (index[1:] == index[:-1]) & (passage[1:] == passage[:-1])
    triple = np.zeros(len(index))
    if len(index) > 2:
        run = mix64(mix64(hashed[:-2]) + mix64(hashed[1:-1] * np.uint64(3)) + hashed[2:] * np.uint64(5))
        within = doc[:-2] == doc[2:]
        triple[:-2] = within & _repeats(doc[:-2], run)
    per_word = np.stack(
        [
            length,
            length**2,
            (length <= 1).astype(float),
            (length >= 12).astype(float),
            _repeats(passage, hashed).astype(float),
            _repeats(doc, hashed).astype(float),
            same_next,
            triple,
            (by_word[:, 4] > by_word[:, 3])[index].astype(float),
        ],
        axis=1,
    )
    means = group_sums(per_word, words_at) / n_words
    spread = np.sqrt(np.maximum(means[:, 1] - means[:, 0] ** 2, 0))[:, None]
    return np.concatenate([share, endings, means[:, :1], spread, means[:, 2:], np.log1p(n_words), np.log1p(passages)[np.repeat(np.arange(len(texts)), passages)][:, None]], axis=1), begins


@dataclass
class Mil:
    """Weights of the network: encoder, gated attention, score."""

    mean: np.ndarray
    scale: np.ndarray
    parts: dict[str, np.ndarray]

    def run(self, x: np.ndarray, begins: np.ndarray) -> dict[str, np.ndarray]:
        p = self.parts
        of = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        code = np.tanh(x @ p["encode"] + p["encode_0"])
        side, gate = np.tanh(code @ p["side"]), 1 / (1 + np.exp(-(code @ p["gate"])))
        raw = (side * gate) @ p["attend"]
        top = np.maximum.reduceat(raw, begins[:-1])
        weight = np.exp(raw - top[of])
        weight /= np.add.reduceat(weight, begins[:-1])[of]
        bag = np.add.reduceat(weight[:, None] * code, begins[:-1])
        score = 1 / (1 + np.exp(-np.clip(bag @ p["score"] + p["score_0"], -40, 40)))
        return {"x": x, "of": of, "code": code, "side": side, "gate": gate, "weight": weight, "bag": bag, "score": score}

    def gradient(self, x: np.ndarray, begins: np.ndarray, label: np.ndarray, importance: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the weighted log loss by all weights."""
        p, r = self.parts, self.run(x, begins)
        out = (r["score"] - label) * importance
        by_bag = np.outer(out, p["score"])[r["of"]]
        along = np.einsum("ij,ij->i", by_bag, r["code"])
        by_raw = r["weight"] * (along - np.add.reduceat(r["weight"] * along, begins[:-1])[r["of"]])
        by_mixed = np.outer(by_raw, p["attend"])
        by_side = by_mixed * r["gate"] * (1 - r["side"] ** 2)
        by_gate = by_mixed * r["side"] * r["gate"] * (1 - r["gate"])
        by_code = r["weight"][:, None] * by_bag + by_side @ p["side"].T + by_gate @ p["gate"].T
        by_in = by_code * (1 - r["code"] ** 2)
        return {
            "encode": r["x"].T @ by_in,
            "encode_0": by_in.sum(axis=0),
            "side": r["code"].T @ by_side,
            "gate": r["code"].T @ by_gate,
            "attend": (r["side"] * r["gate"]).T @ by_raw,
            "score": r["bag"].T @ out,
            "score_0": np.array(out.sum()),
        }


def train(bags: list[np.ndarray], labels: list[int], seed: int = 11) -> Mil | None:
    """Fit the network to bags of passage measurements; both labels weigh the same in total."""
    if not bags:
        return None
    x, begins, label = np.concatenate(bags), offsets([len(b) for b in bags]), np.array(labels, float)
    random = np.random.default_rng(seed)
    shape = {"encode": (FEATURES, HIDDEN), "side": (HIDDEN, GATE), "gate": (HIDDEN, GATE), "attend": (GATE,), "score": (HIDDEN,)}
    parts = {k: random.normal(0, 1 / np.sqrt(s[0]), s) for k, s in shape.items()} | {"encode_0": np.zeros(HIDDEN), "score_0": np.array(0.0)}
    model = Mil(x.mean(axis=0), x.std(axis=0) + 1e-3, parts)
    importance = np.where(label == 1, 0.5 / max(label.sum(), 1), 0.5 / max((1 - label).sum(), 1))
    first, second = ({k: np.zeros_like(v) for k, v in parts.items()} for _ in range(2))
    for step in range(1, STEPS + 1):
        for k, g in model.gradient(x, begins, label, importance).items():
            g = g + DECAY * parts[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            parts[k] = parts[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, found = batch.column("text"), []
        for start, stop in slices(texts):
            x, begins = measure(texts[start:stop].to_pylist())
            found += [x[a:b].ravel().tolist() for a, b in zip(begins[:-1], begins[1:])]
        bags = pa.array(found, pa.list_(pa.float32()))
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("label"), bags], names=["key", "label", "bag"])


def learn(docs: DataFrame, labels: DataFrame, may_learn: Column, *, key: str = "doc_id", text: str = "text", label: str = "quality", per_class: int = PER_CLASS) -> Mil | None:
    """Train on at most ``per_class`` documents of each label among the rows of ``labels`` where
    ``may_learn`` holds. Only keys near the threshold of the sample are ranked; the chosen keys are few by that
    bound and are broadcast."""
    known = labels.where(may_learn & F.col(label).isin(0, 1)).select(F.col(key).alias("__key"), F.col(label).cast("int").alias("label"))
    chance = F.xxhash64(F.col("__key").cast("string"), F.lit("quality"))
    drawn = known.withColumn("__chance", chance)
    chosen = smallest_of_each(drawn, "label", "__chance", per_class, ties="__key").select("__key", "label").distinct()
    sample = docs.select(F.col(key).alias("__own"), F.col(text).alias("text")).join(F.broadcast(chosen), F.col("__own") == F.col("__key"))
    found = sample.select(F.col("__own").cast("string").alias("key"), "label", "text").mapInArrow(_measured, "key string, label int, bag array<float>").collect()
    found = sorted(found, key=lambda r: (r.key, r.label, r.bag))
    return train([np.array(r.bag, float).reshape(-1, FEATURES) for r in found], [r.label for r in found])


def score(docs: DataFrame, model: Mil | None, *keep: str | Column, text: str = "text") -> DataFrame:
    """The columns ``keep`` and ``score``, the probability of label 1, one row per document."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = batch.column("__text"), []
            for start, stop in slices(texts):
                if model is None:
                    found += [0.5] * (stop - start)
                else:
                    found += model.run(*measure(texts[start:stop].to_pylist()))["score"].tolist()
            rest = [c for c in batch.schema.names if c != "__text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(found, pa.float64())], names=[*rest, "score"])

    given = docs.select(*keep, F.col(text).alias("__text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields[:-1])
    return given.mapInArrow(tidy(scored), f"{kinds}, score double")


def keep_good(docs: DataFrame, model: Mil | None, *, text: str = "text", least: float = 0.5) -> DataFrame:
    """The documents whose score is at least ``least``, with their own columns, whatever their names. The
    text goes to Python once and comes back only if it is kept."""
    plain, (column,) = plain_names(docs, text)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(column)
            for start, stop in slices(texts):
                scores = model.run(*measure(texts[start:stop].to_pylist()))["score"] if model else np.full(stop - start, 0.5)
                yield batch.slice(start, stop - start).filter(pa.array(scores >= least))

    return plain.mapInArrow(tidy(kept), plain.schema).toDF(*docs.columns)
