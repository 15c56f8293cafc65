"""Hits against a search at every position, and the SQL's rule."""

import random

import pytest

from postpulse.llm import decontaminate as d

rnd = random.Random(4)
WORDS = [w.encode() for w in "a b c d é x1".split()]


def plain_hits(words, items, size):
    """Word places inside occurrences, and items with one."""
    hit, found = set(), set()
    for number, (_, text) in enumerate(items):
        for window in d.windows_of(d.words_of(text), size):
            for at in range(len(words) - len(window) + 1):
                if tuple(words[at : at + len(window)]) == window:
                    hit.update(range(at, at + len(window)))
                    found.add(number)
    return hit, found


@pytest.mark.parametrize("size", [1, 2, 3, 5])
def test_search_finds_what_a_scan_finds(size):
    for _ in range(60):
        items = [(str(i), b" ".join(rnd.choices(WORDS, k=rnd.randint(0, 9))).decode()) for i in range(5)]
        words = rnd.choices(WORDS, k=rnd.randint(0, 60))
        hit, found = set(), set()
        for table in d.searchers(items, size):
            for start, numbers in table.occurrences(words):
                hit.update(range(start, start + table.length))
                found.update(numbers)
        assert (hit, found) == plain_hits(words, items, size)


def test_words():
    assert d.words_of("Ab-9_É.x\x7fy\nZ") == [b"ab", b"9", "É".encode(), b"x", b"y", b"z"]
    assert d.words_of(None) == d.words_of("") == d.words_of("--") == []


@pytest.mark.parametrize("slice_bytes", [1 << 20, 60])
def test_documents(spark, slice_bytes):
    items = [(1, " ".join(f"w{i}" for i in range(30))), (2, "Short one!"), (3, None), (4, "--"),
             (5, " ".join(f"v{i}" for i in range(13))), (5, "short ONE")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    long = " ".join(f"W{i}" for i in range(3, 17))
    rows = [(1, None), (2, ""), (3, f"{long} rest"), (3, f"{long} rest"), (4, "a short, one " + "b " * 60),
            (5, " ".join(f"w{i}" for i in range(12))), (6, f"{long} " + "pad " * 9999), (None, "short one")]
    docs = spark.createDataFrame([(*r, "keep", 7) for r in rows],
                                 "doc_id bigint, text string, source string, N_HIT int")
    found = d.find_benchmark_words(docs, benchmark, slice_bytes=slice_bytes).collect()
    ours = sorted((str(r.doc_id), r.n_words, r.n_hit, tuple(r.hit_items), r.contaminated) for r in found)
    assert ours == sorted([
        ("1", 0, 0, (), False), ("2", 0, 0, (), False), ("3", 15, 14, ("1",), True),
        ("3", 15, 14, ("1",), True), ("4", 63, 2, ("2", "5"), False), ("5", 12, 0, (), False),
        ("6", 10013, 14, ("1",), False), ("None", 2, 2, ("2", "5"), True)])
    assert all(r.source == "keep" for r in found)
    assert d.find_benchmark_words(docs.limit(0), benchmark).count() == 0
    assert d.find_benchmark_words(docs, benchmark.limit(0)).filter("n_hit > 0").count() == 0
