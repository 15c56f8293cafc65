"""Mentions of users, communities and URLs inside a text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

KINDS = ("user", "subreddit", "url")

# Per dialect and kind the pattern and the group that is the result.
DIALECTS = {
    "producer": {
        "user": (r"(?iu)/?u/([A-Za-z0-9_-]+)", 1),
        "subreddit": (r"(?iu)/?r/([A-Za-z0-9_-]+)", 1),
        # Equal to the class [a-zA-Z], [0-9], [$-_@.&+], [!*, ] taken together: the range from
        # $ to _ holds digits, capitals and the rest; only a-z, ! and the blank are outside.
        "url": (r"https?://[ !$-_a-z]+", 0),
    },
    "token": {
        "user": (r"/u/[^\s]+", 0),
        "subreddit": (r"/r/[^\s]+", 0),
        "url": (r"https?://[^\s]+", 0),
    },
    "word": {
        "user": (r"/u/\w+", 0),
        "subreddit": (r"/r/\w+", 0),
        "url": (r"https?://[^\s]+", 0),
    },
    "name": {
        "user": (r"/u/([a-zA-Z0-9_-]+)", 1),
        "subreddit": (r"/r/([a-zA-Z0-9_-]+)", 1),
        "url": (r"(https?://[^\s]+)", 1),
    },
}


def _may_hold(text: Column, kind: str, dialect: str) -> Column:
    if kind == "url":
        return text.contains("://")
    letter = kind[0] if kind == "user" else "r"
    if dialect == "producer":
        return text.contains(f"{letter}/") | text.contains(f"{letter.upper()}/")
    return text.contains(f"/{letter}/")


def references(text: Column, kind: str, dialect: str = "name") -> Column:
    """All mentions of one kind, in text order; empty for NULL and for no match.

    A byte search for the literal part decides first, so most texts never reach
    the pattern matcher.
    """
    pattern, group = DIALECTS[dialect][kind]
    return F.when(
        _may_hold(text, kind, dialect),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)),
    ).otherwise(F.array().cast("array<string>"))


def reference_count(column: Column) -> Column:
    """Array size, 0 for NULL."""
    return F.coalesce(F.size(column), F.lit(0))
