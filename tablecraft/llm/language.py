"""Language identification with a linear-chain conditional random field over words.

Every word has features: all its character n-grams up to four, where n-grams that touch the ends of
the word are its affixes, and the word itself when it is in a lexicon of frequent words. Features and
transitions between neighbouring words have learned weights. Forward-backward gives every word of a
text its probability of being in each language, so a text that switches between languages is labelled
word by word; the language of a text is the one with the largest mean probability.

Training takes a documented, bounded sample of labelled rows (``PER_LANGUAGE`` documents a language, a
few stretches of words each), chosen by a hash of the key, and joins stretches of different documents
into code-switched sequences. Texts shorter than a stretch are joined with others of their language. Prediction reads whole texts, slice by slice, and shuffles nothing.

Defined results: ``und`` with score 1 for a text that is null or has no letter, and score 0 where
nothing could be learned; rows without a language are not learned from; repeated rows get equal
results. Other columns of any name do no harm.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import cycle, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.batches import group_sums, mix64, numbered, offsets, slices
from tablecraft.llm.sampling import smallest_of_each

PER_LANGUAGE = 400  # documents of the sample per language
STRETCHES, STRETCH = 4, 20  # stretches of words per sampled document, words per stretch
LEXICON = 4000  # most frequent words of the sample, those seen three times or more
SIZE = 1 << 16  # hashed features
LONGEST = 4  # characters of an n-gram
EPOCHS, BATCH, RATE = 4, 64, 0.3
CHUNK = 32  # words that forward-backward passes over in one stride
WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"


def words_of(text: str | None) -> list[str]:
    """Runs of letters, in lower case; empty when the text has no letter at all."""
    found = WORD.findall((text or "").lower())
    return found if any(map(str.isalpha, found)) else []


def word_features(words: list[str], lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed feature numbers of all words one after the other, and the offsets of the words."""
    codes = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    of = np.repeat(np.arange(len(words)), lengths)
    found, owner = [], []
    rolled = np.zeros(len(codes), np.uint64)
    for n in range(1, LONGEST + 1):
        rolled = rolled[: len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1 :]
        inside = of[: len(rolled)] == of[n - 1 :]
        found.append(mix64(rolled[inside] + np.uint64(n << 56)) % np.uint64(SIZE))
        owner.append(of[: len(rolled)][inside])
    begins = offsets(lengths)
    powers = np.ones(len(codes), np.uint64)
    powers[1:] = np.multiply.accumulate(np.full(max(len(codes) - 1, 0), 0x9E3779B97F4A7C15, np.uint64))
    place = np.arange(len(codes)) - np.repeat(begins[:-1], lengths)
    whole = np.add.reduceat(mix64(codes + np.uint64(1)) * powers[place], begins[:-1]) if words else np.empty(0, np.uint64)
    at = np.searchsorted(lexicon, whole)
    known = np.flatnonzero(lexicon[np.minimum(at, len(lexicon) - 1)] == whole) if len(lexicon) else np.empty(0, np.int64)
    found.append(mix64(whole[known] + np.uint64(77)) % np.uint64(SIZE))
    owner.append(known)
    ids, owner = np.concatenate(found).astype(np.int64), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return ids[order], offsets(np.bincount(owner, minlength=len(words)))


def word_hashes(words: list[str]) -> np.ndarray:
    """The hash by which the lexicon knows a word."""
    out = []
    for w in words:
        h, power = 0, 1
        for c in mix64(np.frombuffer(f"^{w}$".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)).tolist():
            h, power = (h + c * power) % 2**64, power * 0x9E3779B97F4A7C15 % 2**64
        out.append(h)
    return np.array(sorted(out), np.uint64)


@dataclass
class Crf:
    languages: list[str]
    weights: np.ndarray  # feature x language
    moves: np.ndarray  # language x language, log weights of transitions
    lexicon: np.ndarray

    def emissions(self, words: list[str]) -> np.ndarray:
        """Log weight of every word in every language."""
        ids, begins = word_features(words, self.lexicon)
        return np.add.reduceat(self.weights[ids], begins[:-1])

    def mean_posteriors(self, texts: list[list[str]]) -> np.ndarray:
        """Mean probability of each language over the words of each text."""
        return self._passed(texts, False)[0]

    def posteriors(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Probability of each language for every word of each text."""
        return self._passed(texts, True)[1]

    def _passed(self, texts: list[list[str]], by_word: bool) -> tuple[np.ndarray, list[np.ndarray]]:
        """Mean probabilities of the texts and, if asked for, those of their words, exactly as by
        forward-backward over whole texts.

        The words are cut into chunks of ``CHUNK``. The product of the transfer matrices of a chunk is
        formed for all chunks at once, the products are chained along each text, and with the messages
        at the chunk ends known, all chunks run forward and backward at once.
        """
        n_lang = len(self.languages)
        counts = np.array([len(t) for t in texts])
        index, distinct = numbered([w for t in texts for w in t])
        scores = self.emissions(distinct)
        likely = np.exp(scores - scores.max(axis=1, keepdims=True))
        chunks = -(-counts // CHUNK)
        first_chunk = offsets(chunks)
        total = int(first_chunk[-1])
        word_doc = np.repeat(np.arange(len(texts)), counts)
        place = np.arange(len(index)) - np.repeat(offsets(counts)[:-1], counts)
        slot = (first_chunk[word_doc] + place // CHUNK) * CHUNK + place % CHUNK
        potential = np.ones((total * CHUNK, n_lang))
        potential[slot] = likely[index]
        real = np.zeros(total * CHUNK, bool)
        real[slot] = True
        potential, real = potential.reshape(total, CHUNK, n_lang), real.reshape(total, CHUNK)
        move = np.exp(self.moves - self.moves.max())
        begin = np.zeros(total, bool)
        begin[first_chunk[:-1][chunks > 0]] = True
        stay = np.eye(n_lang)

        def transfer(t: int) -> np.ndarray:
            m = np.where((begin & (t == 0))[:, None, None], 1.0, move) * potential[:, t, None, :]
            return np.where(real[:, t, None, None], m, stay)

        product = np.broadcast_to(stay, (total, n_lang, n_lang))
        for t in range(CHUNK):
            product = product @ transfer(t)
            product = product / product.max(axis=(1, 2), keepdims=True)
        into, out_of = np.ones((total, n_lang)), np.ones((total, n_lang))
        for k in range(1, int(chunks.max(initial=0))):
            at = first_chunk[:-1][chunks > k] + k
            into[at] = np.einsum("ci,cij->cj", into[at - 1], product[at - 1])
            into[at] /= into[at].sum(axis=1, keepdims=True)
            back = first_chunk[1:][chunks > k] - 1 - k
            out_of[back] = np.einsum("cij,cj->ci", product[back + 1], out_of[back + 1])
            out_of[back] /= out_of[back].sum(axis=1, keepdims=True)
        forward = np.empty((CHUNK, total, n_lang))
        for t in range(CHUNK):
            into = np.einsum("ci,cij->cj", into, transfer(t))
            into /= into.sum(axis=1, keepdims=True)
            forward[t] = into
        sums = np.zeros((total, n_lang))
        words = np.empty((total, CHUNK, n_lang)) if by_word else None
        for t in range(CHUNK - 1, -1, -1):
            both = forward[t] * out_of
            both = both / both.sum(axis=1, keepdims=True)
            sums += np.where(real[:, t, None], both, 0)
            if by_word:
                words[:, t] = both
            out_of = np.einsum("cij,cj->ci", transfer(t), out_of)
            out_of /= out_of.sum(axis=1, keepdims=True)
        mean = group_sums(sums, first_chunk) / np.maximum(counts, 1)[:, None]
        if not by_word:
            return mean, []
        flat = words.reshape(total * CHUNK, n_lang)
        return mean, [flat[a * CHUNK : a * CHUNK + n] for a, n in zip(first_chunk[:-1].tolist(), counts.tolist())]


def _sequence_gradient(scores: np.ndarray, moves: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient of the log likelihood of equally long label sequences, by forward-backward:
    by word scores (sequence x word x language) and by transitions."""
    n, length, n_lang = scores.shape
    likely = np.exp(scores - scores.max(axis=2, keepdims=True))
    move = np.exp(moves - moves.max())
    forward, backward = np.empty_like(likely), np.ones_like(likely)
    forward[:, 0] = likely[:, 0] / likely[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, length):
        f = (forward[:, t - 1] @ move) * likely[:, t]
        forward[:, t] = f / f.sum(axis=1, keepdims=True)
    for t in range(length - 2, -1, -1):
        b = (backward[:, t + 1] * likely[:, t + 1]) @ move.T
        backward[:, t] = b / b.sum(axis=1, keepdims=True)
    posterior = forward * backward
    posterior /= posterior.sum(axis=2, keepdims=True)
    truth = np.eye(n_lang)[labels]
    pairs = np.einsum("sti,ij,stj->stij", forward[:, :-1], move, likely[:, 1:] * backward[:, 1:])
    pairs /= pairs.sum(axis=(2, 3), keepdims=True)
    seen = np.einsum("sti,stj->ij", truth[:, :-1], truth[:, 1:])
    return truth - posterior, seen - pairs.sum(axis=(0, 1))


def filled(stretches: list[tuple[str, list[str]]]) -> list[tuple[str, list[str]]]:
    """The stretches with all short ones of a language joined and cut anew to ``STRETCH`` words; the last
    of a language begins again with its first words until it is full."""
    full = [(lang, ws) for lang, ws in stretches if len(ws) == STRETCH]
    short: dict[str, list[str]] = {}
    for lang, ws in stretches:
        if len(ws) != STRETCH:
            short.setdefault(lang, []).extend(ws)
    for lang, ws in short.items():
        for at in range(0, len(ws), STRETCH):
            piece = ws[at : at + STRETCH]
            full.append((lang, [*piece, *islice(cycle(ws), STRETCH - len(piece))]))
    return full


def train(stretches: list[tuple[str, list[str]]], seed: int = 7) -> Crf:
    """Fit the field to ``(language, words)`` stretches, joined two by two into sequences."""
    languages = sorted({lang for lang, _ in stretches})
    counts = Counter(w for _, ws in stretches for w in ws)
    common = [w for w, c in counts.most_common(LEXICON) if c >= 3]
    model = Crf(languages, np.zeros((SIZE, max(len(languages), 1))), np.zeros((len(languages),) * 2), word_hashes(common))
    full = [(languages.index(lang), ws) for lang, ws in filled(sorted(stretches))]
    if not full or len(languages) < 2:
        return model
    index, distinct = numbered([w for _, ws in full for w in ws])
    index = index.reshape(len(full), STRETCH)
    ids, begins = word_features(distinct, model.lexicon)
    label = np.array([lang for lang, _ in full])
    random = np.random.default_rng(seed)
    past, past_moves = np.full_like(model.weights, 1e-6), np.full_like(model.moves, 1e-6)
    for _ in range(EPOCHS):
        order = random.permutation(len(full))
        order = order[: len(order) // 2 * 2].reshape(-1, 2)
        for at in range(0, len(order), BATCH):
            pair = order[at : at + BATCH]
            used = index[pair].reshape(-1)
            words, back = np.unique(used, return_inverse=True)
            spans = [np.arange(begins[w], begins[w + 1]) for w in words]
            feats, own = ids[np.concatenate(spans)], offsets([len(s) for s in spans])
            scores = np.add.reduceat(model.weights[feats], own[:-1])[back].reshape(len(pair), 2 * STRETCH, -1)
            labels = np.repeat(label[pair], STRETCH, axis=1).reshape(len(pair), 2 * STRETCH)
            by_score, by_move = _sequence_gradient(scores, model.moves, labels)
            by_word = np.zeros((len(words), len(languages)))
            np.add.at(by_word, back, by_score.reshape(len(used), -1))
            step = np.repeat(by_word, np.diff(own), axis=0) / len(used)
            touched, where = np.unique(feats, return_inverse=True)
            g = np.zeros((len(touched), len(languages)))
            np.add.at(g, where, step)
            past[touched] += g * g
            model.weights[touched] += RATE * g / np.sqrt(past[touched])
            by_move = by_move / len(used)
            past_moves += by_move * by_move
            model.moves += RATE * by_move / np.sqrt(past_moves)
    return model


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, found = [], []
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            words = words_of(text.as_py())
            free = max(0, len(words) - STRETCH)
            for begin in sorted({free * k // max(1, STRETCHES - 1) for k in range(STRETCHES)}):
                langs.append(lang)
                found.append(words[begin : begin + STRETCH])
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(found, pa.list_(pa.string()))], names=["lang", "words"])


def learn(docs: DataFrame, may_learn: Column, *, key: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> Crf:
    """Train on at most ``per_language`` documents of each language among the rows where ``may_learn``
    holds. Only keys near the threshold of the sample are ranked."""
    rows = docs.where(may_learn & F.col(lang).isNotNull() & F.col(text).isNotNull())
    chance = F.xxhash64(F.col(key).cast("string"), F.lit("language"))
    drawn = rows.select(F.col(key).alias("__key"), F.col(lang).alias("lang"), chance.alias("__chance"))
    chosen = smallest_of_each(drawn, "lang", "__chance", per_language, ties="__key").select("__key", "lang").distinct()
    sample = rows.select(F.col(key).alias("__own"), F.col(text).alias("text"), F.col(lang).alias("__own_lang")).join(
        F.broadcast(chosen), F.col("__own").eqNullSafe(F.col("__key")) & (F.col("__own_lang") == F.col("lang"))
    )
    found = sample.select("lang", "text").mapInArrow(_stretches, "lang string, words array<string>").collect()
    return train([(r.lang, list(r.words)) for r in found])


def word_places(text: str) -> list[tuple[int, int]]:
    """Where the words of :func:`words_of` begin and end in the text as it is written."""
    lower = text.lower()
    found = [m.span() for m in WORD.finditer(lower)]
    if len(lower) == len(text):
        return found
    at = offsets([len(c.lower()) for c in text])  # some letters become two
    return [(int(np.searchsorted(at, a, "right")) - 1, int(np.searchsorted(at, b, "left"))) for a, b in found]


def _spans(text: str, likely: np.ndarray, languages: list[str]) -> list[dict]:
    """Neighbouring words of one language as one span, with the least probability of its words."""
    made: list[dict] = []
    for (begin, end), best, p in zip(word_places(text), likely.argmax(axis=1).tolist(), likely.max(axis=1).tolist()):
        if made and made[-1]["lang"] == languages[best]:
            made[-1] |= {"end": end, "posterior": min(made[-1]["posterior"], p)}
        else:
            made.append({"begin": begin, "end": end, "lang": languages[best], "posterior": p})
    return made


def label_words(docs: DataFrame, model: Crf, *keep: str | Column, text: str = "text") -> DataFrame:
    """The columns ``keep`` and ``spans``: the stretches of each text with the language of their words, as
    ``(begin, end, lang, posterior)`` in code points, end exclusive. Texts without words have none."""
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("lang", pa.string()), ("posterior", pa.float64())]))

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = batch.column("__text"), []
            for start, stop in slices(texts):
                given = texts[start:stop].to_pylist()
                words = [words_of(t) for t in given]
                has = [i for i, w in enumerate(words) if w and model.languages]
                spans: list[list[dict]] = [[] for _ in given]
                for i, likely in zip(has, model.posteriors([words[i] for i in has]) if has else []):
                    spans[i] = _spans(given[i], likely, model.languages)
                found += spans
            rest = [c for c in batch.schema.names if c != "__text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(found, kind)], names=[*rest, "spans"])

    given = docs.select(*keep, F.col(text).alias("__text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields[:-1])
    return given.mapInArrow(labelled, f"{kinds}, spans array<struct<begin:long,end:long,lang:string,posterior:double>>")


def predict(docs: DataFrame, model: Crf, *keep: str | Column, text: str = "text") -> DataFrame:
    """The columns ``keep``, ``lang_pred`` and ``score``, one row per document."""

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("__text")
            langs, scores = [], []
            for start, stop in slices(texts):
                words = [words_of(t) for t in texts[start:stop].to_pylist()]
                has = [i for i, w in enumerate(words) if w]
                best = [UNKNOWN] * len(words)
                sure = [1.0] * len(words)
                if has and model.languages:
                    mean = model.mean_posteriors([words[i] for i in has])
                    for i, k, p in zip(has, mean.argmax(axis=1), mean.max(axis=1)):
                        best[i], sure[i] = model.languages[k], float(min(max(p, 0.0), 1.0))
                elif has:
                    sure = [0.0 if w else 1.0 for w in words]
                langs += best
                scores += sure
            rest = [c for c in batch.schema.names if c != "__text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*rest, "lang_pred", "score"]
            )

    given = docs.select(*keep, F.col(text).alias("__text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields[:-1])
    return given.mapInArrow(predicted, f"{kinds}, lang_pred string, score double")
