"""The model is a probability law; texts get their language, or none."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from postpulse.llm import language
from postpulse.llm.rows import draw_of, training_sample

rng = np.random.default_rng(9)
SYLLABLES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ei", "ung", "en"], "cc": ["é", "ño", "ci", "ra"]}


def text(lang, words=30):
    return " ".join("".join(rng.choice(SYLLABLES[lang], rng.integers(1, 4))) for _ in range(words)) + "."


@pytest.fixture(scope="module")
def trained(spark):
    rows = [(i, text(lang), lang) for i, lang in enumerate(list(SYLLABLES) * 40)]
    rows += [(900, None, "aa"), (901, "", "bb"), (902, "zz zz", None), (903, "123", "cc")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    return language.train(docs, id_col="doc_id")


def test_each_model_sums_to_one_over_what_may_come_next(trained):
    """Known letters and the end mark; the rest of the base law goes to unknown characters."""
    for context in ["", "k", "ka", "kal", "schei", "qqq"]:
        letters = sorted({c for s in SYLLABLES.values() for x in s for c in x})
        words = [context + c for c in letters] + [context]
        sums, _ = language.log2_words(trained, words)
        # log2 P(context, c) of a prefix: take the end mark off by the word's own model.
        codes, at, word = language._codes(words)
        p = np.zeros(len(trained.languages))
        for n, w in enumerate(words):
            one, _ = language.log2_words(trained, [w])
            p += np.exp2(one[0] - _prefix(trained, w if n == len(words) - 1 else w[:-1]) - (
                0 if n == len(words) - 1 else _end(trained, w)))
        assert (p <= 1 + 1e-6).all() and (p > 0.5).all()


def _end(model, word):
    """log2 probability of the end mark after ``word``."""
    return language.log2_words(model, [word])[0][0] - _prefix(model, word)


def _prefix(model, word):
    """log2 probability of the letters of ``word``, from the difference of two words."""
    codes, at, owner = language._codes([word])
    keep = at[:-1]
    grams, contexts = language._hashes(codes, keep), language._hashes(codes, keep - 1)
    p = np.broadcast_to(model.base, (len(keep), len(model.languages)))
    for k in range(language.ORDER):
        row, known = language._find(model.grams[k], grams[k])
        alpha = np.where(known[:, None], model.alphas[k][row], 0.0)
        if k:
            row, known = language._find(model.contexts[k], contexts[k - 1])
            gamma = np.where(known[:, None], model.gammas[k][row], 1.0)
        else:
            gamma = model.gammas[0]
        p = alpha + gamma * p
    return np.log2(p).sum(axis=0)


def test_languages_are_found(spark, trained):
    rows = [(lang, text(lang)) for lang in list(SYLLABLES) * 20]
    rows += [(lang, text(lang, 4000)) for lang in SYLLABLES]
    docs = spark.createDataFrame([(i, t, lang, "x") for i, (lang, t) in enumerate(rows)],
                                 "doc_id bigint, text string, true string, Score string")
    found = language.identify(docs, trained).collect()
    assert all(r.true == r.lang_pred and not r.rejected and 0.5 < r.score <= 1 for r in found)


def test_texts_without_a_language(spark, trained):
    rows = [(1, None), (2, ""), (3, "12 -- !"), (4, "xqzvw qqwwxz zvxq"), (5, "ka1lo"), (5, "ka1lo")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r for r in language.identify(docs, trained).collect()}
    assert [found[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3
    assert all(found[i].rejected and found[i].score == 0 for i in (1, 2, 3))
    assert found[4].rejected and found[4].lang_pred in SYLLABLES
    assert found[5].lang_pred == "aa"
    assert language.identify(docs.limit(0), trained).count() == 0


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id bigint, text string, lang string")
    model = language.train(docs, id_col="doc_id")
    assert [(r.lang_pred, r.score) for r in language.identify(docs, model).collect()] == [("und", 0.0)]


def test_sample_passes_over_texts_beyond_the_bound(spark):
    rows = [(i, "word " * 40, "en") for i in range(200)] + [(200 + i, "x" * 300_000, "en") for i in range(5)]
    rows += [(900 + i, "y" * 250_000, "long") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = docs.select(
        draw_of("doc_id", "text").alias("draw"), F.col("lang").alias("label"), F.length("text").alias("size")
    )
    found = training_sample(
        docs, labels, id_col="doc_id", text_col="text", documents=1000, characters=200_000
    ).groupBy("label").agg(F.count("*").alias("n"), F.max("n").alias("last"))
    assert {r.label: r.n for r in found.collect()} == {"en": 200, "long": 1}


def test_scorer_remembers_a_bounded_number_of_parts(trained):
    """Old and recent parts together keep the bound, in long batches too; totals stay the same."""
    own, plain = language._Scorer(trained, cached_words=600), language._Scorer(trained)
    learned = []
    learn, own.learn = own.learn, lambda parts: (learned.extend(parts), learn(parts))
    texts = ["kalo " + " ".join(f"mi{'tu' * (i % 15)}lo{'ka' * (i // 15)}{'sch' * j}" for i in range(150))
             + " " * 150_000 for j in range(12)]
    for at in range(0, 12, 6):
        some = [*texts[at : at + 6], None, "", "12"]
        np.testing.assert_allclose(own.totals(some), plain.totals(some), rtol=1e-12)
        assert len(own.known) + len(own.older) <= 600
    assert learned.count("kalo") == 1 and len(learned) > 1200
