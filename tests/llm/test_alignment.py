"""Groups, links and counts against the tokenizers on whole texts and plain sets."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from postpulse.llm import alignment, queries

A, B = (str(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
TOKENS = alignment.Tokenizers(A, B)

ODD = [
    "", None, " ", "  ", "\n", "\n\n", " a", "a ", "a  b", "a\t b", "a\t  b", "a \tb\t", "x\x1c y", "a\x85 b",
    "a　 b 　", "Don't we'll 's x's.", "<|endoftext|> a<s></s><unk><0x41>", "▁a", "a ▁", "é É ẖ",
    "İstanbul ﬁ ½ €. 漢字。 1234 12,5%", "a\r\nb\r\n\r\n c", "a\x00b \x00", "x " * 500, "z" * 3000, " \n \n b \n",
    "the of and the of and", "﻿a", "👍🏽 ok", "a" + " " * 40 + "b", "\t", "a  b", "a.\n\n\tb",
]


def plain(text, kind="end"):
    """Groups, token counts and links, from both tokenizers on the whole text."""
    found = TOKENS.encoded(" " + text) if text else None
    if found is None:
        return None
    ids = [x.tolist() for x in found]
    ends = [np.cumsum([len(y[i]) for i in x]).tolist() for x, y in zip(ids, (TOKENS.bytes_a, TOKENS.bytes_b))]
    cuts = sorted(set(ends[0]) & set(ends[1]))
    groups = []
    for low, high in zip([0, *cuts], cuts):
        groups.append([[i for i, e in zip(x, y) if low < e <= high] for x, y in zip(ids, ends)])
    start = [[0, *e[:-1]] for e in ends]
    if kind == "end":
        links = [(a[-1], b[-1]) for a, b in groups]
    elif kind == "group":
        links = [(x, y) for a, b in groups for x in a for y in b]
    else:
        links = [
            (x, y)
            for x, s, e in zip(ids[0], start[0], ends[0])
            for y, t, f in zip(ids[1], start[1], ends[1])
            if s < f and t < e
        ]
    text = ";".join("|".join(",".join(map(str, s)) for s in g) for g in groups)
    return text, len(ids[0]), len(ids[1]), len(groups), links


def expected(texts, kind="end"):
    found = [plain(t, kind) for t in texts]
    count = Counter(p for f in found if f for p in f[4])
    most = {}
    for (_, b), n in count.items():
        most[b] = max(most.get(b, 0), n)
    out = []
    for f in found:
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        links = f[4]
        best = sum(count[p] == most[p[1]] for p in links)
        out.append((*f[1:4], len(links), best, sum(count[p] for p in links), f[0]))
    return out


def given_by(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = alignment.align(docs, A, B, **options).orderBy("doc_id").collect()
    return [tuple(r)[1:] for r in rows]


@pytest.mark.parametrize("kind", alignment.LINKS)
@pytest.mark.parametrize("chunk_bytes", [1, alignment.CHUNK_BYTES])
def test_odd_texts(spark, kind, chunk_bytes):
    texts = ODD if kind != "overlap" else [t for t in ODD if len(t or "") < 1000]
    texts = texts + texts[-5:]
    assert given_by(spark, texts, links=kind, chunk_bytes=chunk_bytes) == expected(texts, kind)


ALPHABET = st.sampled_from(list("ab é漢▁\n\r\t\x1c\x85\xa0　'.1<|s>́ ") + ["<|endoftext|>", " the", "ing "])


@settings(max_examples=400, deadline=None)
@given(st.lists(ALPHABET | st.text(max_size=5), max_size=14).map("".join))
def test_units_give_the_tokens_of_the_whole_text(text):
    numbers = alignment._Numbers()
    order = alignment._unit_numbers(text, numbers) if text else []
    assert "".join(list(numbers)[i] for i in order) == (" " + text if text else "")
    table = alignment.UnitTable("end")
    units = sorted(numbers, key=lambda u: u[-1].isspace())
    table.add(units, TOKENS)
    lines = dict(zip(units, "".join(table.texts).split("\n")))
    sound = dict(zip(units, np.concatenate(table.sound))) if units else {}
    whole = plain(text)
    names = [list(numbers)[i] for i in order]
    if whole is None:
        assert not text or not all(sound[u] for u in names)
    else:
        assert all(sound[u] for u in names)
        assert ";".join(lines[u] for u in names) == whole[0]


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 6), st.integers(1, 6), st.integers(1, 6), st.data())
def test_row_products(n, k, m, data):
    dense = lambda r, c: np.array(data.draw(st.lists(st.lists(st.integers(0, 2), min_size=c, max_size=c), min_size=r, max_size=r)))

    def csr(x):
        at = np.nonzero(x)
        starts = np.concatenate([[0], np.cumsum((x != 0).sum(axis=1))])
        return alignment.Csr(starts, at[1], x[at], x.shape[1])

    def whole(c):
        out = np.zeros((len(c.starts) - 1, c.width), int)
        out[np.repeat(np.arange(len(c.starts) - 1), np.diff(c.starts)), c.columns] = c.values
        return out

    x, y = dense(n, k), dense(k, m)
    assert (whole(alignment.product(csr(x), csr(y))) == x @ y).all()
    assert (whole(alignment.transposed(csr(x))) == x.T).all()


def test_own_columns_and_empty_tables(spark):
    schema = "doc_id bigint, Text_A string, text string, N_A string, own_0 int, words int, chunk string, at int"
    rows = [(1, "x", "a b", "y", 1, 2, "c", None), (1, "x", "a b", "y", 1, 2, "c", None), (None,) * 8]
    found = alignment.align(spark.createDataFrame(rows, schema), A, B)
    assert found.columns == ["doc_id", "Text_A", "own_0", "words", "chunk", "at", *alignment.ADDED]
    assert sorted(map(repr, [tuple(r)[:6] for r in found.collect()])) == sorted(
        map(repr, [(r[0], r[1], *r[4:]) for r in rows])
    )
    assert alignment.align(spark.createDataFrame([], schema), A, B).count() == 0
    only = alignment.align(spark.createDataFrame([("a b",)], "text string"), A, B)
    assert only.columns == list(alignment.ADDED) and only.count() == 1
    with pytest.raises(ValueError):
        alignment.align(spark.createDataFrame(rows, schema), A, B, links="none")


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    wanted = {}
    for d, e in zip(docs, expected([d.text for d in docs])):
        wanted[d.doc_id] = (*e[:6], hashlib.sha256(e[6].encode()).hexdigest() if e[0] else "")
    rows = queries.op13_alignment(spark, sf).collect()
    assert {r.doc_id: tuple(r)[1:] for r in rows} == wanted and len(rows) == len(docs)
