"""Forward-backward against all label sequences; held-out accuracy on a made-up corpus."""

import itertools

import numpy as np

from postpulse.llm import toxicity

rng = np.random.default_rng(8)


def a_model():
    return toxicity.Model(np.zeros(toxicity.BUCKETS), rng.normal(size=(2, 2)), start=0.7)


def plain(model, emit):
    """Marginals, and expected transitions, over all label sequences."""
    n, total = len(emit), 0.0
    p, pairs = np.zeros(n), np.zeros((2, 2))
    for labels in itertools.product((0, 1), repeat=n):
        score = labels[0] * model.start + np.dot(emit, labels)
        score += sum(model.transitions[a, b] for a, b in zip(labels, labels[1:]))
        weight = np.exp(score)
        total += weight
        p += weight * np.array(labels)
        for a, b in zip(labels, labels[1:]):
            pairs[a, b] += weight
    return p / total, pairs / total


def test_marginals_and_gradient():
    model = a_model()
    lengths = [1, 2, 5, 7]
    emit, inside = np.zeros((7, 4)), np.zeros((7, 4), bool)
    for c, n in enumerate(lengths):
        emit[:n, c], inside[:n, c] = rng.normal(size=n) * 2, True
    p = toxicity.marginals(model, emit, inside)
    gold = (rng.random((7, 4)) < 0.4) & inside
    _, by_transition, _ = toxicity._gradient(model, emit, inside, gold.astype(float))
    expected, seen = np.zeros((2, 2)), np.zeros((2, 2))
    for c, n in enumerate(lengths):
        own, pairs = plain(model, emit[:n, c])
        assert np.allclose(p[:n, c], own)
        expected += pairs
        for t in range(n - 1):
            seen[int(gold[t, c]), int(gold[t + 1, c])] += 1
    assert np.allclose(by_transition, seen - expected)


def test_windows_give_the_marginals_of_the_whole_text():
    model = toxicity.Model(np.zeros(toxicity.BUCKETS), np.array([[1.0, -1.0], [-0.5, 0.8]]))
    emissions = [rng.normal(size=n) - 1 for n in (0, 1, 255, 256, 257, 2000)]
    for e, p in zip(emissions, toxicity.window_marginals(model, emissions)):
        whole = toxicity.marginals(model, e[:, None], np.ones((len(e), 1), bool))[:, 0] if len(e) else e
        assert np.allclose(p, whole, atol=1e-6)


CLEAN = [f"w{a}{b}" for a in "bcdfgh" for b in ("an", "el", "it", "or", "us")]


def corpus(n):
    for i in range(n):
        words = list(rng.choice(CLEAN, rng.integers(5, 60)))
        bad = i % 4 == 0
        for _ in range(rng.integers(2, 5) if bad else 0):
            words.insert(rng.integers(len(words)), "Vile" + "".join(rng.choice(list("aeiou"), 2)) + "!")
        yield i, " ".join(words), int(bad)


def test_held_out_documents(spark):
    rows = list(corpus(600))
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id bigint, text string, Toxicity string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(3, None), (None, 1)], "doc_id bigint, toxic int")
    model = toxicity.train(docs.filter("doc_id % 5 > 0"), labels)
    found = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    wrong = [i for i, _, y in rows if i % 5 == 0 and (found[i].toxicity >= 0.5) != bool(y)]
    assert len(wrong) <= 1
    for i, text, y in rows[:40]:
        tagged = " ".join(text[s.start : s.end] for s in found[i].toxic_spans).split()
        assert tagged == [w for w in text.split() if w.startswith("Vile")]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, " \n"), (3, " \n"), (4, "x " * 50_000)],
                                 "doc_id bigint, text string")
    none = toxicity.train(docs, spark.createDataFrame([], "doc_id bigint, toxic int"))
    rows = toxicity.score(docs, none).collect()
    assert len(rows) == 5 and all(0 <= r.toxicity < 0.5 for r in rows)
    assert all(r.toxic_spans == [] for r in rows if r.doc_id < 4)
    assert toxicity.score(docs.limit(0), none).count() == 0
