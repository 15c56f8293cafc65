"""Removed bytes against a plain table of all strings, and the parts of the method."""

import hashlib
import itertools

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st

from postpulse.llm import queries, suffixes


def plain(rows, length=50):
    texts = [(np.inf if i is None else i, (t or "").encode()) for i, t in rows]
    least = {}
    for i, t in texts:
        for p in range(len(t) - length + 1):
            s = t[p : p + length]
            least[s] = min(least.get(s, np.inf), i)
    out = []
    for i, t in texts:
        gone = [False] * len(t)
        for p in range(len(t) - length + 1):
            if least[t[p : p + length]] < i:
                gone[p : p + length] = [True] * length
        spans, at = [], 0
        for key, run in itertools.groupby(gone):
            n = len(list(run))
            spans += [(at, at + n)] if key else []
            at += n
        out.append((len(t), sum(gone), len(spans), spans, bytes(b for b, g in zip(t, gone) if not g)))
    return out


def found(spark, rows, **options):
    docs = spark.createDataFrame([(k, i, t) for k, (i, t) in enumerate(rows)], "row int, doc_id bigint, text string")
    got = suffixes.without_repeats(docs.repartition(3), **options).orderBy("row").collect()
    return [(r.n_bytes, r.n_removed, r.n_spans, [tuple(s) for s in r.spans], bytes(r.kept)) for r in got]


def texts(seed, n=120):
    rng = np.random.default_rng(seed)
    words = ["alpha", "beta", "é", "漢字", "of", "the", "x\x00y", "\n", "zeta"]
    make = lambda k: " ".join(words[i] for i in rng.integers(0, len(words), k))
    passages = [make(30) for _ in range(4)] + ["a" * 400, "ab" * 90]
    rows = []
    for i in rng.permutation(n):
        parts = [make(rng.integers(0, 50))]
        for _ in range(rng.integers(0, 3)):
            passage = passages[rng.integers(0, len(passages))]
            a = rng.integers(0, len(passage) // 2)
            parts += [passage[a : a + rng.integers(30, 200)], make(rng.integers(0, 9))]
        rows.append((int(i), "".join(parts)))
    rows += [(500 + i, rows[i][1]) for i in range(10)] + [(-3, rows[5][1]), (None, rows[6][1]), (None, None), (7, "")]
    return [*rows, (rows[0][0], rows[0][1]), (900, "b" * 49), (901, "b" * 49), (902, "c" * 50), (903, "c" * 50)]


@pytest.mark.parametrize("options", [{}, {"chunk_bytes": 1}, {"bucket_bytes": 2000}, {"length": 60}])
def test_same_as_plain_comparison(spark, monkeypatch, options):
    rows = texts(len(options)) * (2 if "chunk_bytes" in options else 1)
    if "chunk_bytes" in options:
        monkeypatch.setattr(suffixes, "WINDOW", 64)
    expected = plain(rows, options.get("length", 50))
    assert found(spark, rows, **options) == expected
    assert sum(e[1] for e in expected) > 3000


def test_cover():
    shifts = {(a - b) % suffixes.PERIOD for a in suffixes.COVER for b in suffixes.COVER}
    assert shifts == set(range(suffixes.PERIOD))
    with pytest.raises(ValueError):
        suffixes.without_repeats(None, length=49)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=90), max_size=6), st.integers(1, 200))
def test_places(documents, window):
    whole, suffixes.WINDOW = suffixes.WINDOW, window
    try:
        raw, sizes = b"".join(documents), np.array([len(d) for d in documents], np.int64)
        places = suffixes.Places(raw, sizes, 50)
        at, names = places.triples()
        starts, ends = places.stretches()
        begins, stops, _, _ = suffixes.stretch_names(places)
    finally:
        suffixes.WINDOW = whole
    bounds = list(zip(places.starts.tolist(), places.ends.tolist()))
    fits = [p for a, b in bounds for p in range(a, b) if p % 21 in suffixes.COVER and p + 30 <= b]
    assert at.tolist() == fits
    of = {}
    for p, name in zip(at.tolist(), names.tolist()):
        assert of.setdefault(raw[p : p + 30], name) == name
    assert starts.tolist() == sorted(set(starts.tolist())) and ends.tolist() == [*starts[1:].tolist(), *([len(raw)] if raw else [])]
    # Every place at which a prefix fits lies in one stretch.
    covered = [p for a, b in zip(begins.tolist(), stops.tolist()) for p in range(a, b)]
    assert covered == [p for a, b in bounds for p in range(a, b - 49)]


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(40, 300)), st.lists(st.integers(1, 40), min_size=2, max_size=12))
def test_prefixes_around_triples(sampled, gaps):
    ends = np.cumsum(gaps)
    starts, stops = ends[:-1:2], ends[1::2]
    starts = starts[: len(stops)]
    got = suffixes._prefixes(np.array(sorted(sampled), np.int64), starts, stops, 50)
    inside = [p for a, b in zip(starts, stops) for p in range(a, b)]
    assert got.tolist() == [p for p in inside if any(p <= s <= p + 20 for s in sampled)]


@pytest.mark.parametrize("count", [0, 1, 60, 5000])
def test_order_of_names_with_and_without_spare_bits(count):
    names = np.random.default_rng(count).integers(0, 700, count).astype(np.uint64) << np.uint64(12)
    for one, two in zip(suffixes._ordered(names, 12), suffixes._ordered(names, 0)):
        assert one.tolist() == two.tolist()


def test_questions_about_triples_are_names_and_bits():
    names = np.sort(np.random.default_rng(1).integers(0, 2**63, 1000).astype(np.uint64))
    several = np.arange(1000) % 3 == 0
    rows = suffixes._questions(7, suffixes._TRIPLE, 4, names, None, several)
    sizes = np.diff(suffixes.bucket_ends(names, 4)).tolist()
    assert [len(r[4]) for r in rows] == [0, 0]
    assert [len(r[5]) for r in rows] == [-(-n // 8) for n in sizes if n]
    columns = [f.split()[0] for f in suffixes._ASK.split(", ")]
    own = pd.DataFrame([r for r in rows if r[1] == 0], columns=columns)
    answer = suffixes._answered(pd.concat([own, own.assign(chunk=8)]))["answer"]
    assert all(np.unpackbits(np.frombuffer(a, np.uint8), count=sizes[0]).all() for a in answer)
    alone = suffixes._answered(own)["answer"].iloc[0]
    assert np.unpackbits(np.frombuffer(alone, np.uint8), count=sizes[0]).tolist() == several[: sizes[0]].tolist()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.integers(-4, 4)), max_size=30))
def test_least_where_keys_are_equal(rows):
    columns = np.array(rows, np.int64).reshape(-1, 3).T
    keys, second, documents = columns[0].astype(np.uint64), columns[1].astype(np.uint64), columns[2]
    one, two, least, rank = suffixes._least(keys, second, documents)
    found = {}
    for k, s, d in rows:
        found[k, s] = min(found.get((k, s), d), d)
    assert list(zip(one.tolist(), two.tolist(), least.tolist())) == [(*k, d) for k, d in sorted(found.items())]
    assert [(int(one[r]), int(two[r])) for r in rank] == [r[:2] for r in rows]


def test_columns_and_empty_tables(spark):
    schema = "Chunk string, DOC_ID int, text string, KEPT int, own_0 int, id string, words int, spans string"
    rows = [("c", 1, "x" * 60, 5, 6, "i", 7, "s"), (None,) * 8, ("d", 2, "x" * 60, 5, 6, "i", 7, "s")]
    got = suffixes.without_repeats(spark.createDataFrame(rows, schema))
    assert got.columns == ["Chunk", "DOC_ID", "own_0", "id", "words", *suffixes.ADDED]
    by_id = {r.DOC_ID: r for r in got.collect()}
    assert by_id[1].n_removed == 0 and by_id[2].n_removed == 60 and by_id[None].n_bytes == 0
    assert (by_id[1].own_0, by_id[1].id, by_id[1].words, by_id[1].Chunk) == (6, "i", 7, "c")
    assert suffixes.without_repeats(spark.createDataFrame([], schema)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    expected = {
        i: (*e[:3], hashlib.sha256(e[4]).hexdigest()) for (i, _), e in zip(docs, plain(docs))
    }
    assert {r.doc_id: tuple(r)[1:] for r in queries.op12_suffixes(spark, sf).collect()} == expected
