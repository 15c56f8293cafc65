import random
import re

import pytest
from pyspark.sql import functions as F

from postpulse.functions import lexicons, text as t
from postpulse.operators import texts


def features(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, text string")
    rows = texts.with_sentiment(texts.with_clean_text(df)).orderBy("id").collect()
    return rows


# A plain statement of the rules, to compare random texts with.


def py_clean(text):
    if text is None or not text.strip():
        return ""
    text = re.sub(r"(?:http|www)\S+", "[URL]", text)
    text = re.sub(r"@\w+", "[USER]", text)
    text = re.sub(r"#\w+", "[TAG]", text)
    text = re.sub(r"[^\w\s\[\]]", " ", text)
    return re.sub(r"\s+", " ", text).strip().lower()


def py_sentiment(words):
    score = 0.0
    for group, weight in lexicons.SENTIMENT_WEIGHTS:
        score += sum(w in group for w in words) * weight
    glad = set(lexicons.POSITIVE + lexicons.STRONG_POSITIVE)
    pairs = zip(words, words[1:])
    score -= 1.5 * sum(a in lexicons.NEGATIONS and b in glad for a, b in pairs)
    return score / max(len(words), 5)


def py_topic(words):
    best, name = 0, "general"
    for topic, group in lexicons.TOPICS.items():
        n = len(set(words) & set(group))
        if n > best:
            best, name = n, topic
    return name


def py_terms(cleaned):
    found = re.findall(r"\b[a-zA-Z]{3,}\b", cleaned)
    return [w for w in found if w not in lexicons.TERM_STOP_WORDS]


def random_texts(n):
    rng = random.Random(7)
    words = t.marked_words() + "the naïve straße Éa x1 ab abc a_b 世界 ١٢ don't".split()
    marks = ["", "", "@", "#", "http://", "www.", "HTTP://", "[", "]", "!", "?", "_", "é", "@@"]
    gaps = [" ", " ", " ", "  ", "\n", "\t", "\u00a0", "\u2003", "\x85", "\x1c", "\u3000", ".", ""]
    out = [None, "", "   ", "\u00a0"]
    for _ in range(n):
        size = rng.randint(0, 25)
        parts = [rng.choice(marks) + rng.choice(words) + rng.choice(gaps) for _ in range(size)]
        out.append("".join(parts))
    return out


def test_clean_example(spark):
    [row] = features(spark, ["Don't visit HTTP://A.b http://c.d @bob #tag [x] awww.x"])
    assert row.clean == "don t visit http a b [url] [user] [tag] [x] a[url]"


@pytest.mark.parametrize(
    "text, score, category",
    [
        ("not good", -0.1, "slightly_negative"),
        ("amazing amazing", 0.8, "positive"),
        ("okay", 0.06, "slightly_positive"),
        ("table chair", 0.0, "neutral"),
        ("not no good", -0.1, "slightly_negative"),
        ("good not okay not", 0.26, "positive"),
    ],
)
def test_sentiment_examples(spark, text, score, category):
    [row] = features(spark, [text])
    assert row.sentiment == pytest.approx(score)
    assert row.sentiment_category == category


def test_topic_and_question_examples(spark):
    rows = features(spark, ["table chair", "code game", "game play code", "show me"])
    assert [r.topic for r in rows] == ["general", "technical", "gaming", "personal"]
    assert [r.has_question for r in rows] == [False, False, False, True]
    words = spark.createDataFrame([("show me",), ("how so",)], "c string").select(
        t.is_question(F.col("c"), t.tokens(F.col("c"))).alias("q")
    )
    assert [r.q for r in words.collect()] == [False, True]


def test_random_texts_match_plain_rules(spark):
    values = random_texts(400)
    rows = features(spark, values)
    for value, row in zip(values, rows, strict=True):
        cleaned = py_clean(value)
        words = cleaned.split()
        assert row.clean == cleaned
        assert row.word_count == len(words)
        assert row.sentiment == pytest.approx(py_sentiment(words), abs=1e-12)
        assert row.topic == py_topic(words)
        assert row.has_question == any(m in cleaned for m in lexicons.QUESTION_MARKERS)


def test_random_terms_match_plain_rules(spark):
    cleaned = [py_clean(v) for v in random_texts(400)]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cleaned)], "id int, text string")
    df = df.withColumn("words", t.meaningful_words("text"))
    rows = df.withColumn("pairs", t.bigrams("words")).orderBy("id").collect()
    for value, row in zip(cleaned, rows, strict=True):
        expected = py_terms(value)
        assert row.words == expected
        assert row.pairs == [f"{a} {b}" for a, b in zip(expected, expected[1:])]


def test_filter_empty_matches_clean(spark):
    values = random_texts(200)
    df = spark.createDataFrame([(v,) for v in values], "text string")
    rows = df.select(t.has_content(F.col("text")).alias("a"), t.clean(F.col("text")).alias("c"))
    assert all(r.a == (r.c != "") for r in rows.collect())


def test_enrich_combines_columns_and_defaults(spark):
    df = spark.createDataFrame(
        [("A Title", "body!", None, 3, None), ("", " ", None, 1, 2), (None, "x", None, None, 1)],
        "title string, text string, full_text string, score int, num_comments int",
    )
    rows = {r.text: r for r in texts.enrich(df).collect()}
    assert set(rows) == {"a title body", "x"}
    first = rows["a title body"]
    assert first.original_text == "A Title body!"
    assert (first.subreddit, first.author, first.engagement_score) == ("unknown", "unknown", None)
    assert first.length == 12 and first.word_count == 3
    again = {r.text: r for r in texts.enrich(df, comments_as_zero=True).collect()}
    assert again["a title body"].engagement_score == 3
    only = texts.enrich(df, text_cols=["title"]).collect()
    assert [r.text for r in only] == ["a title"]


def test_no_rows(spark):
    enriched = texts.enrich(spark.createDataFrame([], "text string, score int"))
    assert tuple(texts.question_counts(enriched).first()) == (0, 0, None, None)
    assert texts.text_summary(enriched).first().entries == 0
    assert texts.engagement_correlation(enriched).first().sentiment_corr is None


def test_enrich_needs_a_text_column(spark):
    with pytest.raises(ValueError):
        texts.enrich(spark.createDataFrame([(1,)], "score int"))


def test_top_terms_and_phrases(spark):
    df = spark.createDataFrame([("spark spark fun",), ("spark fun odd",), (None,)], "text string")
    assert [tuple(r) for r in texts.top_terms(df).collect()] == [("spark", 3)]
    assert [tuple(r) for r in texts.top_terms(df, frequent_only=False).collect()] == [
        ("spark", 3), ("fun", 2), ("odd", 1),
    ]
    assert [tuple(r) for r in texts.top_phrases(df).collect()] == [("spark fun", 2)]
    assert tuple(texts.unique_terms(df).first()) == (3, 3)
    assert tuple(texts.unique_terms(df, approximate=True).first()) == (3, 3)


def test_polarity_forms_agree(spark):
    lexicon = {"good": 0.5, "bad": -0.5, "odd": 0.25}
    rows = [(1, "good good bad"), (2, "odd"), (3, "table"), (4, None), (5, "")]
    df = spark.createDataFrame(rows, "id int, text string")
    table = spark.createDataFrame(list(lexicon.items()), "word string, polarity double")
    by_table = texts.polarity(df, table, ["id"], "text").orderBy("id").collect()
    words = df.withColumn("w", t.tokens(t.clean(F.col("text"))))
    by_plan = words.select("id", t.polarity("w", lexicon).alias("polarity")).collect()
    expected = [0.5 / 3, 0.25, 0.0, 0.0, 0.0]
    assert [r.polarity for r in by_table] == pytest.approx(expected)
    assert [r.polarity for r in by_plan] == pytest.approx(expected)


def test_own_scorer(spark):
    df = spark.createDataFrame([("abc",), ("",), (None,)], "text string")
    rows = texts.score_with(df, lambda s: s.str.len().astype("float64")).collect()
    assert [r.sentiment for r in rows] == [3.0, 0.0, 0.0]


def test_default_polarity(spark):
    df = spark.createDataFrame([("Amazing, not bad!",), (None,)], "text string")
    assert [r.sentiment for r in texts.with_polarity(df).collect()] == [0.25, 0.0]


def test_correlation_words(spark):
    rows = [(float(i), i, 10 - i) for i in range(6)]
    df = spark.createDataFrame(rows, "sentiment double, engagement_score int, word_count int")
    row = texts.engagement_correlation(df).first()
    assert row.sentiment_corr == pytest.approx(1.0)
    assert (row.sentiment_strength, row.sentiment_direction) == ("strongly", "positively")
    assert (row.length_strength, row.length_direction) == ("strongly", "shorter")
