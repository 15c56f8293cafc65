"""Each stage against plain Python on the rows that the stage before it kept."""

import zlib
from collections import Counter

import pytest

import corpus_pipeline
from postpulse.llm import decontaminate, language, rows, simhash
from tests.llm.test_decontaminate import plain_hits
from tests.llm.test_lines import key
from tests.llm.test_packing import plain_ids
from tests.llm.test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"
DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """Rows before the first and after each stage; odd documents added."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    item = spark.read.parquet(f"{SF}/benchmark.parquet").filter("length(text) > 120").first().text
    odd = [(90_001, None, "en", "x", None), (90_002, "", "en", "x", 0), (90_003, "12 34", None, "x", 5),
           (90_004, item, "en", None, len(item)), (90_004, item, "en", None, len(item))]
    docs = docs.unionByName(spark.createDataFrame(odd, DDL))
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_path_factory.mktemp('stage')}/{name}"
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        out.append(docs.collect())
    return out


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language", "lines", "near_duplicates", "decontamination", "packing"]


def test_language(kept):
    before, after = kept[:2]
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    assert {90_001, 90_002, 90_003} <= gone
    assert all(not language._LETTERS.search(r.text or "") for r in before if r.doc_id in gone)
    assert all(r in before for r in after)


def test_lines(kept):
    before, after = kept[1:3]
    counts = Counter(k for r in before for k in {key(x) for x in r.text.split("\n")} if k)
    expected = []
    for r in before:
        text = "\n".join(x for x in r.text.split("\n") if not key(x) or counts[key(x)] < 10)
        expected.append((r.doc_id, text, r.lang, r.source or "", len(text)))
    assert sorted((r.doc_id, r.text, r.lang, r.source or "", r.n_chars) for r in after) == sorted(expected)


def test_near_duplicates(kept):
    before, after = kept[2:4]
    roots = plain_components([plain_fingerprint(r.text) for r in before], 4)
    least = {}
    for r, root in zip(before, roots):
        least[root] = min(least.get(root, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(least.values())
    assert all(r in before for r in after)


def test_decontamination(spark, kept):
    before, after = kept[3:5]
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    expected = []
    for r in before:
        words = decontaminate.words_of(r.text)
        hit, _ = plain_hits(words, items, 13)
        if not (hit and 20 * len(hit) >= len(words)):
            expected.append(r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(expected)
    assert 90_004 not in expected


def test_packing(kept):
    before, pieces = kept[4:6]
    expected = sorted(
        (r.doc_id, at // 4 // 4096, zlib.crc32(ids[at : at + 4 * 4096]))
        for r in before
        for ids in [plain_ids(r.text) + b"\x01\0\0\0"]
        for at in range(0, len(ids), 4 * 4096)
    )
    assert sorted((p.doc_id, p.piece, p.ids_crc32) for p in pieces) == expected


def test_packing_returns_the_ids(kept):
    before, pieces = kept[4:6]
    whole = {}
    for p in sorted(pieces, key=lambda p: p.start):
        whole.setdefault(p.doc_id, []).append(bytes(p.ids))
    assert {i: b"".join(w) for i, w in whole.items()} == {
        r.doc_id: plain_ids(r.text) + b"\x01\0\0\0" for r in before}


def test_run(spark, kept):
    pieces = corpus_pipeline.run(spark, SF)
    first = {(r.doc_id, r.piece, r.ids_crc32) for r in kept[-1] if r.doc_id < 90_000}
    ours = {(r.doc_id, r.piece, r.ids_crc32) for r in pieces.collect()}
    # The added documents may move the representative of a group, no more.
    assert len(first ^ ours) <= 4


def test_a_stage_lets_go_of_what_an_earlier_one_kept(monkeypatch):
    made = []
    for module in (simhash, decontaminate):
        monkeypatch.setattr(module, "append_columns", lambda docs, added, make, drop=(): made.append(make))
    simhash.fingerprints(None)
    made.append(decontaminate._search([], "text", 13))
    for make in made:
        rows.held(("kept", 1), dict)
        make()
        assert not rows._held
