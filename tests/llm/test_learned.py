"""Language and quality: exact inference, gradients, held-out accuracy, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablecraft.llm import language, quality, sampling
from tablecraft.llm.batches import offsets
from tablecraft.llm.queries import QUERIES


@pytest.fixture(scope="module")
def field():
    random = np.random.default_rng(1)
    stretches = [(lang, list(random.choice(words.split(), language.STRETCH))) for lang, words in (("en", "the and with house of"), ("de", "der und mit haus von")) for _ in range(40)]
    return language.train(stretches)


def test_posteriors_match_forward_backward_over_the_whole_text(field):
    words = ("the house und der of von " * 20).split()
    score, move = field.emissions(words), field.moves
    n = len(words)
    forward, backward = np.zeros_like(score), np.zeros_like(score)
    forward[0] = score[0]
    for t in range(1, n):
        forward[t] = score[t] + np.logaddexp.reduce(forward[t - 1][:, None] + move, axis=0)
    for t in range(n - 2, -1, -1):
        backward[t] = np.logaddexp.reduce(move + score[t + 1] + backward[t + 1], axis=1)
    exact = np.exp(forward + backward - np.logaddexp.reduce(forward + backward, axis=1, keepdims=True)).mean(axis=0)
    found = field.mean_posteriors([words[:3], words, ["the"]])
    assert found[1] == pytest.approx(exact, abs=1e-9)
    assert found.sum(axis=1) == pytest.approx(np.ones(3))


def test_sequence_gradient_is_that_of_the_likelihood():
    random = np.random.default_rng(2)
    score, move, label = random.normal(size=(1, 4, 3)), random.normal(size=(3, 3)), np.array([[0, 2, 1, 1]])

    def likelihood(s, m):
        total = s[0, 0]
        for t in range(1, 4):
            total = s[0, t] + np.logaddexp.reduce(total[:, None] + m, axis=0)
        truth = sum(s[0, t, label[0, t]] for t in range(4)) + sum(m[label[0, t], label[0, t + 1]] for t in range(3))
        return truth - np.logaddexp.reduce(total)

    by_score, by_move = language._sequence_gradient(score, move, label)
    for i in range(3):
        step = np.zeros_like(move)
        step[i, 1] = 1e-6
        assert by_move[i, 1] == pytest.approx((likelihood(score, move + step) - likelihood(score, move - step)) / 2e-6, abs=1e-5)
        step = np.zeros_like(score)
        step[0, 2, i] = 1e-6
        assert by_score[0, 2, i] == pytest.approx((likelihood(score + step, move) - likelihood(score - step, move)) / 2e-6, abs=1e-5)


def test_language_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = [r for r in QUERIES["op8_language"](spark, sf_dir).collect()]
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97


def test_language_of_odd_documents(odd_docs):
    model = language.learn(odd_docs, F.lit(True))
    rows = language.predict(odd_docs, model, "doc_id", "name").collect()
    assert len(rows) == odd_docs.count()
    by = {r.doc_id: r for r in rows}
    assert {by[k].lang_pred for k in (4, 5, 6, 8)} == {"und"}
    assert all(r.lang_pred in ("en", "de", "fr", "und") and 0 <= r.score <= 1 for r in rows)
    assert language.predict(odd_docs.limit(0), model, "doc_id").count() == 0
    nothing = language.learn(odd_docs.limit(0), F.lit(True))
    assert {r.lang_pred for r in language.predict(odd_docs, nothing, "doc_id").collect()} == {"und"}


def test_languages_of_short_texts_are_learned(spark):
    random = np.random.default_rng(4)
    vocabulary = {"en": "the and with house of".split(), "de": "der und mit haus von".split(), "fr": "le et avec maison dans".split()}
    lengths = {"en": 60, "de": 3, "fr": 1}
    rows = [(lang, " ".join(random.choice(words, lengths[lang]))) for lang, words in vocabulary.items() for _ in range(60)]
    rows += [("zh", text) for text in ("今天天气很好", "我们去学校", "他是我的朋友", "这是一本书") * 15]
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")
    found = language.predict(docs, language.learn(docs, F.lit(True)), "doc_id", "lang").collect()
    for lang in ("en", "de", "fr", "zh"):
        assert np.mean([r.lang_pred == lang for r in found if r.lang == lang]) > 0.95, lang


def test_short_stretches_are_filled():
    n = language.STRETCH
    long, short = [f"l{i}" for i in range(n)], [f"s{i}" for i in range(n + 3)]
    assert language.filled([("a", long), ("b", short[:5]), ("b", short[5:])]) == [("a", long), ("b", short[:n]), ("b", [*short[n:], *short[: n - 3]])]
    assert language.filled([("c", ["x"])]) == [("c", ["x"] * n)]


def test_quality_gradient_is_that_of_the_loss():
    random = np.random.default_rng(3)
    bags = [random.normal(size=(n, quality.FEATURES)) for n in (1, 3, 2)]
    model = quality.train(bags, [1, 0, 1])
    x, begins, label, weight = np.concatenate(bags), offsets([1, 3, 2]), np.array([1.0, 0, 1]), np.array([0.3, 0.5, 0.2])
    random_parts = {k: random.normal(0, 0.3, np.shape(v)) for k, v in model.parts.items()}
    model.parts.update(random_parts)

    def loss():
        p = model.run(x, begins)["score"]
        return -(weight * (label * np.log(p) + (1 - label) * np.log(1 - p))).sum()

    for name, g in model.gradient(x, begins, label, weight).items():
        part = model.parts[name]
        at = tuple(0 for _ in np.shape(part))
        for sign in (1,):
            keep = part.copy()
            up, down = keep.copy(), keep.copy()
            up[at] += 1e-5
            down[at] -= 1e-5
            model.parts[name] = up
            high = loss()
            model.parts[name] = down
            low = loss()
            model.parts[name] = keep
        assert g[at] == pytest.approx((high - low) / 2e-5, abs=1e-6), name


def test_quality_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = QUERIES["op9_quality"](spark, sf_dir).collect()
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows) and len(rows) == 10_000


def test_quality_of_odd_documents(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1), (2, 1), (9, 0), (10, 0), (4, None), (None, 1), (99, 0)], "doc_id long, quality int")
    model = quality.learn(odd_docs, labels, F.lit(True))
    rows = quality.score(odd_docs, model, "doc_id", "name").collect()
    assert len(rows) == odd_docs.count()
    by = {r.doc_id: r.score for r in rows}
    assert by[1] > 0.5 > by[9] and by[4] == by[5] == by[6]
    assert quality.score(odd_docs.limit(0), model, "doc_id").count() == 0
    nothing = quality.learn(odd_docs, labels.limit(0), F.lit(True))
    assert {r.score for r in quality.score(odd_docs, nothing, "doc_id").collect()} == {0.5}


def test_words_of_switched_text_are_labelled(spark, field):
    text = "The house, and the house of THE İx House -- und der mit haus; der von haus und"
    docs = spark.createDataFrame([(1, text), (2, None), (3, "... 12"), (4, "the and of"), (4, "the and of")], "doc_id long, text string")
    rows = sorted(language.label_words(docs, field, "doc_id").collect(), key=lambda r: r.doc_id)
    assert [[s.lang for s in r.spans] for r in rows] == [["en", "de"], [], [], ["en"], ["en"]]
    first, second = rows[0].spans
    assert text[first.begin : first.end] == "The house, and the house of THE İx House"
    assert text[second.begin : second.end] == "und der mit haus; der von haus und"
    words = language.words_of(text)
    likely = field.posteriors([["the"], words, []])
    assert [len(x) for x in likely] == [1, len(words), 0]
    assert likely[1].mean(axis=0) == pytest.approx(field.mean_posteriors([words])[0], abs=1e-12)
    assert len(language.word_places(text)) == len(words)
    plain = text.replace("İ", "")
    assert [plain[a:b].lower() for a, b in language.word_places(plain)] == language.words_of(plain)
    empty = language.train([])
    assert [r.spans for r in language.label_words(docs, empty, "doc_id").collect()] == [[]] * 5


def test_samples_are_the_smallest_hashes_of_each_class(spark):
    rows = spark.range(30_000).selectExpr("id as k", "if(id % 10 = 0, 'few', if(id < 25, 'rare', 'many')) as c", "xxhash64(id) as h").repartition(9)
    sample = sampling.smallest_of_each(rows, "c", "h", 40, ties="k")
    want = {}
    for r in rows.collect():
        want.setdefault(r.c, []).append((r.h, r.k))
    got = {}
    for r in sample.collect():
        got.setdefault(r.c, []).append((r.h, r.k))
    assert {c: sorted(x) for c, x in got.items()} == {c: sorted(x)[:40] for c, x in want.items()}
    assert sampling.smallest_of_each(rows.limit(0), "c", "h", 40, ties="k").count() == 0


def test_attention_is_that_of_a_plain_loop():
    """Scores of documents by single passages, one after the other."""
    random = np.random.default_rng(6)
    bags = [random.normal(size=(n, quality.FEATURES)) for n in (1, 4, 2, 9)]
    model = quality.train(bags, [1, 0, 1, 0])
    p, wanted = model.parts, []
    for bag in bags:
        codes = [np.tanh(np.clip((x - model.mean) / model.scale, -8, 8) @ p["encode"] + p["encode_0"]) for x in bag]
        raw = [float((np.tanh(c @ p["side"]) / (1 + np.exp(-(c @ p["gate"])))) @ p["attend"]) for c in codes]
        weight = np.exp(np.array(raw) - max(raw))
        passage = sum(w * c for w, c in zip(weight / weight.sum(), codes))
        wanted.append(1 / (1 + np.exp(-(passage @ p["score"] + p["score_0"]))))
    assert model.run(np.concatenate(bags), offsets([len(b) for b in bags]))["score"] == pytest.approx(wanted, abs=1e-9)
