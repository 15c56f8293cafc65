"""Scores against a plain model of the same definition."""

import math
from collections import Counter

import numpy as np
import pytest

from postpulse.llm import ngrams

rng = np.random.default_rng(11)
VOCABULARY = ["the", "a", "Tree", "grows", "é", "\x1cx", "of", "z"]


def texts(n):
    rows = [(i, " ".join(rng.choice(VOCABULARY, rng.integers(1, 30)))) for i in range(n)]
    return rows + [(n, None), (n + 1, ""), (n + 2, " \n"), (n + 3, "unseen words only"),
                   (n + 4, "the\x0ba  the \t of " * 3000), (n + 4, "the\x0ba  the \t of " * 3000)]


def tokens_of(text):
    return [*(text or "").encode().lower().split(), None]


def plain(rows, mix):
    """Counts, then both scores; ``mix`` are the operator's weights."""
    train = [tokens_of(t) for i, t in rows if i % 3]
    word = Counter(w for t in train for w in t)
    pair = Counter(p for t in train for p in zip(["start", *t], t))
    context = Counter(word) + Counter({"start": len(train)})
    n, v = sum(word.values()), len(word)
    out = []
    for i, text in rows:
        t = tokens_of(text)
        score = 0.0
        for h, w in zip(["start", *t], t):
            m = mix[ngrams.classes(np.array([context[h]]))[0]]
            score += math.log10(m[0] * pair[h, w] / max(1, context[h]) + m[1] * word[w] / n + m[2] / (v + 1))
        base = sum(math.log10((word[w] + 1) / (n + v + 1)) for w in t)
        out.append((i, len(t), sum(word[w] > 0 for w in t), n, base, score))
    return sorted(out, key=lambda r: (r[0], r[1])), n, v


@pytest.mark.parametrize("chunk_bytes", [1 << 20, 500])
def test_scores(spark, monkeypatch, chunk_bytes):
    rows = texts(150)
    docs = spark.createDataFrame([(i, t, bool(i % 3), "x") for i, t in rows],
                                 "doc_id bigint, text string, train boolean, Score string")
    docs = ngrams.stored(docs.repartition(3), "ngram-test")
    kept = []
    real = ngrams.weights
    monkeypatch.setattr(ngrams, "weights", lambda *a: kept.append(real(*a)) or kept[0])
    found = ngrams.score(docs, train_col="train", chunk_bytes=chunk_bytes).collect()
    expected, n, v = plain(rows, kept[0])
    ours = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
                   for r in found), key=lambda r: (r[0], r[1]))
    assert [r[:4] for r in ours] == [r[:4] for r in expected]
    assert np.allclose([r[4:] for r in ours], [r[4:] for r in expected], rtol=1e-9)
    assert np.allclose(kept[0].sum(axis=1), 1) and (kept[0][:, 1:] > 0).all() and kept[0][0, 0] == 0


def test_weights_raise_the_deleted_likelihood():
    cells = ngrams.pd.DataFrame({"class": [3, 3, 3], "n": [80, 15, 5], "pair_sum": [40.0, 1.5, 0.0],
                                 "word_sum": [800.0, 30.0, 0.0]})
    mix = ngrams.weights(cells, 1000, 99)[3]
    laws = np.array([[0.5, 10 / 999, 0.01], [0.1, 2 / 999, 0.01], [0, 0, 0.01]])
    gain = lambda m: np.array([80, 15, 5]) @ np.log(laws @ m)
    steps = [np.roll([0.01, -0.01, 0], k) for k in range(3)] + [np.roll([0, 0.01, -0.01], k) for k in range(3)]
    assert all(gain(mix) >= gain(mix + s) - 0.05 for s in steps if (mix + s >= 0).all())


def test_no_rows_and_no_training(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string, train boolean")
    assert ngrams.score(empty, train_col="train").count() == 0
    untrained = spark.createDataFrame([(1, "a b", False), (2, None, None)], empty.schema)
    rows = ngrams.score(untrained, train_col="train").collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens) for r in rows) == [(1, 3, 0, 0), (2, 1, 0, 0)]
    assert all(r.base_score == 0 and np.isfinite(r.score) for r in rows)


def test_packing_round_trip():
    for numbers in ([], [0], [1, 255, 256, 70000, 2**32 - 1]):
        assert ngrams.unpacked(ngrams.packed(np.array(numbers, np.int64))).tolist() == numbers
    keys = np.array([0, 1, 5, 2**63, 2**64 - 1], np.uint64)
    assert ngrams.unpacked_keys(ngrams.packed_keys(keys)).tolist() == keys.tolist()
