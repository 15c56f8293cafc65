"""The registered queries against SQL, or against plain Python, on the small tables."""

import html
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from checks.compare import _sorted_rows, connect
from postpulse.llm import queries, registry
from tests.llm.test_packing import plain_ids
from tests.llm.test_simhash import plain_components, plain_fingerprint

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").collect()


def run(spark, name, sf=SF):
    return registry.queries()[name](spark, sf)


def crc(value):
    return zlib.crc32(str(value).encode())


def test_all_are_registered():
    names = list(registry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows_as_sql(spark, name):
    found = run(spark, name)
    with connect(SF) as engine:
        result = engine.execute(registry.oracle_sql()[name])
        names = [d[0] for d in result.description]
        theirs = _sorted_rows(result.fetchall(), names)
    assert sorted(names) == sorted(found.columns)
    assert _sorted_rows(found.collect(), found.columns) == theirs


def test_sharding(spark, documents):
    rows = run(spark, "op1_sharding").collect()
    size = lambda t: len((t or "").encode()) + 8
    expected = sorted((d.doc_id, size(d.text), zlib.crc32((d.text or "").encode())) for d in documents)
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in rows) == expected
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r.slot)
    assert set(slots) == set(range(24)) and {r.law for r in rows} == {"rows"}
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(r.grown_shard is None for r in rows)


def test_sharding_moves_the_texts(spark, monkeypatch):
    given = []
    real = queries.sharding.shuffle_into_shards
    spy = lambda docs, *a, **k: given.append(docs.columns) or real(docs, *a, **k)
    monkeypatch.setattr(queries.sharding, "shuffle_into_shards", spy)
    plan = run(spark, "op1_sharding")._jdf.queryExecution().optimizedPlan().toString()
    assert given == [["doc_id", "text"]]
    # The digest is taken above the exchange into shards and the ranks there.
    assert plan.count(" crc32(") == 1 and plan.index(" crc32(") < plan.index("Window")


def test_sharding_is_native(spark):
    plan = run(spark, "op1_sharding")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_pages(spark):
    pages = {p.page_id: p.html for p in spark.read.parquet(f"{LARGER}/pages.parquet").collect()}
    for r in run(spark, "op2_pages", LARGER).collect():
        article = re.search("<article>(.*)</article>", pages[r.page_id], re.S)[1]
        blocks = re.split("</?(?:p|h1|article)>", article)
        plain = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in blocks]
        assert r.text == "\n".join(b for b in plain if b) and r.n_chars == len(r.text)


def test_simhash(spark, documents):
    prints = [plain_fingerprint(d.text) for d in documents]
    roots = plain_components(prints, 4)
    least = {}
    for d, root in zip(documents, roots):
        least[root] = min(least.get(root, d.doc_id), d.doc_id)
    expected = sorted((d.doc_id, f"{p:016x}", least[r]) for d, p, r in zip(documents, prints, roots))
    assert sorted(map(tuple, run(spark, "op4_simhash").collect())) == expected


def test_packing(spark, documents):
    rows = run(spark, "op7_packing").collect()
    expected = {}
    for d in documents:
        ids = plain_ids(d.text) + b"\x01\0\0\0"
        for at in range(0, len(ids), 4 * 4096):
            part = ids[at : at + 4 * 4096]
            expected[d.doc_id, at // 4 // 4096] = (at // 4, len(part) // 4, zlib.crc32(part))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == expected
    assert len(rows) == len(expected)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in bins.values():
        ends = np.cumsum([length for _, length in sorted(spans)])
        assert [o for o, _ in sorted(spans)] == [0, *ends[:-1]] and ends[-1] <= 4096
    assert len(bins) <= math.ceil(sum(n for _, n, _ in expected.values()) / 4096) + 1


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "lang")
    rows = run(spark, "op8_language", LARGER).join(docs, "doc_id").collect()
    assert all(r.held_out == (crc(r.doc_id) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held_out = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and np.mean([r.lang == r.lang_pred for r in held_out]) > 0.98


def test_toxicity_of_held_out_documents(spark):
    larger = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{larger}/labels.parquet")
    rows = run(spark, "op6_toxicity", larger).join(labels, "doc_id", "left").collect()
    assert all(r.held_out == (crc(r.doc_id) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == (r.score >= 0.5) for r in rows)
    judged = [r for r in rows if r.held_out and r.toxic is not None]
    of = lambda label: [r.predicted for r in judged if r.toxic == label]
    assert np.mean(of(0)) < 0.01 and np.mean(of(1)) > 0.8


def test_ngrams(spark, documents):
    words = lambda d: [*(d.text or "").encode().lower().split(), None]
    train = [words(d) for d in documents if crc(d.doc_id) % 7 != 2]
    count = Counter(w for t in train for w in t)
    total, distinct = sum(count.values()), len(count)
    rows = {r.doc_id: r for r in run(spark, "op9_ngrams").collect()}
    assert len(rows) == len(documents)
    for d in documents:
        r, w = rows[d.doc_id], words(d)
        assert r.held_out == (crc(d.doc_id) % 7 == 2)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(count[x] > 0 for x in w), total)
        base = sum(math.log10((count[x] + 1) / (total + distinct + 1)) for x in w)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    held_out = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in held_out) > sum(r.base_score for r in held_out)
