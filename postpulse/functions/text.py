"""Text expressions: clean-up, tokens, sentiment, topic, question flag, terms.

All of them are built-in Spark expressions, so an item is handled inside its own
row: no shuffle and no Python worker.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F

from . import lexicons

# Unicode letters, digits and underscore: what \w means for text strings in Python.
WORD = r"\p{L}\p{N}_"
# Unicode whitespace, as for text strings in Python.
SPACE = r"\t-\r\x1c-\x20\x85\xA0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

URL_MARK, USER_MARK, TAG_MARK = "[URL]", "[USER]", "[TAG]"


def has_content(text: Column) -> Column:
    """True where :func:`clean` leaves something. Stops at the first word character."""
    return F.coalesce(text.rlike(rf"[{WORD}\[\]]"), F.lit(False))


def stripped(text):
    """Without white space at either end, as Python counts white space."""
    return F.regexp_replace(text, rf"\A[{SPACE}]+|[{SPACE}]+\z", "")


def clean(text: Column) -> Column:
    """Links, @users and #tags become marks, other punctuation blanks, all lower case.

    One look for a marker character spares plain texts the three mark patterns;
    punctuation and blanks are then squeezed in a single pass.
    """
    text = F.coalesce(text, F.lit(""))
    marked = F.regexp_replace(text, rf"(?:http|www)[^{SPACE}]+", URL_MARK)
    marked = F.regexp_replace(marked, rf"@[{WORD}]+", USER_MARK)
    marked = F.regexp_replace(marked, rf"#[{WORD}]+", TAG_MARK)
    has_link = text.contains("http") | text.contains("www")
    has_mark = has_link | text.contains("@") | text.contains("#")
    text = F.when(has_mark, marked).otherwise(text)
    return F.lower(F.trim(F.regexp_replace(text, rf"[^{WORD}\[\]]++", " ")))


def combine(columns: Iterable[str]) -> Column:
    """Cleaned, non-empty columns joined by a blank."""
    return F.concat_ws(" ", *[F.nullif(clean(F.col(c)), F.lit("")) for c in columns])


def tokens(cleaned: Column) -> Column:
    """Words of a cleaned text; none for the empty text."""
    return F.when(cleaned != "", F.split(cleaned, " ")).otherwise(F.array().cast("array<string>"))


# The functions below take column names: the word lists then reach Spark as one SQL
# expression each instead of one call per word.


def _quoted(words: Iterable[str]) -> str:
    return ", ".join("'" + w.replace("'", "\\'") + "'" for w in words)


def words_in(words: str, group: Iterable[str]) -> Column:
    """Words of the list that belong to the group, in order, repeats kept."""
    return F.expr(f"filter({words}, w -> w in ({_quoted(group)}))")


def words_not_in(words: str, group: Iterable[str]) -> Column:
    return F.expr(f"filter({words}, w -> w not in ({_quoted(group)}))")


def _count_in(words: str, group: Iterable[str]) -> str:
    return f"size(filter({words}, w -> w in ({_quoted(group)})))"


def marked_words() -> list[str]:
    """Every word that sentiment or topic looks at."""
    words = set(lexicons.NEGATIONS)
    for group, _ in lexicons.SENTIMENT_WEIGHTS:
        words.update(group)
    for group in lexicons.TOPICS.values():
        words.update(group)
    return sorted(words)


def lexicon_hits(words: str) -> Column:
    """The few words sentiment and topic care about.

    The one pass over all words of the text; the counts below run over this short list.
    """
    return words_in(words, marked_words())


def negated_words(words: str, hits: str) -> Column:
    """Number of (strong) positive words right after a negation.

    Most texts lack a negation or a positive word; only the others look at neighbours.
    """
    negations = _quoted(lexicons.NEGATIONS)
    glad = _quoted(lexicons.POSITIVE + lexicons.STRONG_POSITIVE)
    return F.expr(
        f"""case when exists({hits}, w -> w in ({negations}))
              and exists({hits}, w -> w in ({glad}))
        then size(filter(
            zip_with({words}, slice({words}, 2, size({words})),
                     (a, b) -> a in ({negations}) and b in ({glad})),
            found -> found))
        else 0 end"""
    )


def sentiment(hits: str, word_count: str, negated: str) -> Column:
    """Weighted lexicon score divided by the number of words (at least 5)."""
    score = "0.0D"
    for group, weight in lexicons.SENTIMENT_WEIGHTS:
        score += f" {'+' if weight > 0 else '-'} {_count_in(hits, group)} * {abs(weight)}D"
    penalty = f"{negated} * {lexicons.NEGATED_PENALTY}D"
    return F.expr(f"({score} - {penalty}) / greatest({word_count}, 5)")


def sentiment_category(score: Column) -> Column:
    return (
        F.when(score > 0.15, "positive")
        .when(score > 0.05, "slightly_positive")
        .when(score < -0.15, "negative")
        .when(score < -0.05, "slightly_negative")
        .otherwise("neutral")
    )


def topic_counts(hits: str) -> Column:
    """Distinct keywords per topic, in the declared order of topics."""
    counts = [
        f"size(array_distinct(filter({hits}, w -> w in ({_quoted(group)}))))"
        for group in lexicons.TOPICS.values()
    ]
    return F.expr(f"array({', '.join(counts)})")


def topic(counts: str) -> Column:
    """Topic with most distinct keywords; the first declared wins a tie."""
    names = _quoted(lexicons.TOPICS)
    return F.expr(
        f"""case when array_max({counts}) = 0 then '{lexicons.NO_TOPIC}'
        else element_at(array({names}),
                        cast(array_position({counts}, array_max({counts})) as int)) end"""
    )


def is_question(cleaned: Column, words: Column | None = None) -> Column:
    """Marker found anywhere in the text; given ``words``, only as a whole word."""
    if words is not None:
        return F.arrays_overlap(words, F.array(*[F.lit(m) for m in lexicons.QUESTION_MARKERS]))
    found = F.lit(False)
    for marker in lexicons.QUESTION_MARKERS:
        found = found | cleaned.contains(marker)
    return found


def meaningful_words(cleaned: str) -> Column:
    """Words of three and more plain letters that are not stop words."""
    found = rf"regexp_extract_all({cleaned}, r'(?<![{WORD}])[a-zA-Z]{{3,}}+(?![{WORD}])', 0)"
    return words_not_in(found, lexicons.TERM_STOP_WORDS)


def bigrams(words: str) -> Column:
    """Neighbouring words joined by a blank."""
    return F.expr(
        f"""case when size({words}) > 1 then
            zip_with(slice({words}, 1, size({words}) - 1), slice({words}, 2, size({words}) - 1),
                     (a, b) -> concat(a, ' ', b))
        else array() end"""
    )


def plain_tokens(text: str, stop_words: Iterable[str] = ()) -> Column:
    """Lower-case words between single white-space characters, without stop words."""
    return words_not_in(rf"split(lower({text}), r'\s')", ["", *stop_words])


def polarity(words: str, lexicon: Mapping[str, float]) -> Column:
    """Mean polarity of the words found in a small in-plan lexicon, 0.0 if there are none."""
    by_weight: dict[float, list[str]] = {}
    for word, weight in lexicon.items():
        by_weight.setdefault(float(weight), []).append(word)
    summed = " + ".join(
        f"{weight!r}D * {_count_in(words, group)}" for weight, group in sorted(by_weight.items())
    )
    found = _count_in(words, lexicon)
    return F.expr(f"case when {found} = 0 then 0.0D else ({summed}) / {found} end")


def term_frequencies(sorted_words: Column, starts: Column) -> Column:
    """(word, tf) pairs of one item from its sorted words and the run starts."""
    return F.transform(
        starts,
        lambda start, k: F.struct(
            F.get(sorted_words, start).alias("word"),
            (F.coalesce(F.get(starts, k + 1), F.size(sorted_words)) - start).alias("tf"),
        ),
    )


def run_starts(sorted_words: Column) -> Column:
    """Positions where a new word begins in sorted words."""
    return F.filter(
        F.transform(sorted_words, lambda w, i: i),
        lambda i: (i == 0) | (F.get(sorted_words, i) != F.get(sorted_words, i - 1)),
    )
