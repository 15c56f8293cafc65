"""Token ids against the tokenizer itself, sequences against their definition and bounds."""

import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from postpulse.llm import packing

PATH = str(public_tokenizers.path("word_bpe_49k.json"))
TOKENIZER = Tokenizer.from_file(PATH)
TOKENIZER.encode_special_tokens = True


def plain_ids(text):
    return np.array(TOKENIZER.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


ODD = [
    "", None, " ", "\n\n", "Don't we'll 's 't x's.", "\x1cabc d\x00e \x00 \x00\x00", "é É ẖ H̱.",
    "İstanbul ΑΣ. Σ Ǆ ﬁ ½ x² €. a€. ...", "<|endoftext|> a<|startoftext|>.", "Ünïcode, Über!   z\u0085y",
    "漢字。 漢字. 1234. 12,5% _a_ __", "a.b.c. A.B.", "ͅ. qͅ. '́. '", "tab\there\r\n.",
]


@pytest.mark.parametrize("text", ODD)
def test_ids_of_odd_texts(text):
    assert list(packing.encoder(PATH).ids([text])) == [plain_ids(text)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=4))
def test_ids_of_any_texts(texts):
    assert list(packing.encoder(PATH).ids(texts)) == [plain_ids(t) for t in texts]


UNCHANGED = Tokenizer.from_file(PATH)
ADDED = ["<|endoftext|>", "<|startoftext|>"]


def contract_ids(text):
    return np.array(UNCHANGED.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*ADDED, "<|ENDOFTEXT|>", "<|endof", "text|>", " ", "a", "É", "é",
                                          "漢 b", "\u0301", "\x00", "\n"]) | st.text(max_size=6), max_size=9)
                .map("".join), max_size=4))
def test_added_tokens_in_texts_are_tokens(texts):
    assert list(packing.encoder(PATH).whole_ids(texts)) == [contract_ids(t) for t in texts]


def test_pieces_of_texts_with_added_tokens(spark):
    texts = ["a <|endoftext|> b", "<|startoftext|>x<|endoftext|><|endoftext|>", "É漢<|endoftext|>\u0301 y", *ODD]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: bytes(r.ids) for r in packing.token_pieces(docs, PATH).collect()}
    assert found == {i: contract_ids(t) + b"\x01\0\0\0" for i, t in enumerate(texts)}
    assert np.frombuffer(found[0], "<u4").tolist() == [320, 49407, 321, 1]


def test_remembering_is_bounded(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 50)
    own = packing._Encoder(PATH)
    texts = [" ".join(f"w{i}x{j}." for i in range(30)) for j in range(9)]
    for text in texts:
        assert list(own.ids([text, text])) == [plain_ids(text)] * 2
    assert len(own.known) <= 50 + 3 * 30


def test_parts_used_of_late_are_remembered():
    """Old and recent parts together keep the bound, in long batches too; frequent ones stay."""
    own = packing._Encoder(PATH, cached_words=2000)
    learned = []
    learn, own.learn = own.learn, lambda parts: (learned.extend(parts := list(parts)), learn(parts))
    texts = ["often " + " ".join(f"w{chr(97 + i % 26)}x{chr(97 + i // 26)}{'yz' * (j % 9)}q{'k' * (j // 9)}"
                                 for i in range(400)) + " " * 100_000 for j in range(30)]
    for at in range(0, 30, 10):
        assert list(own.ids(texts[at : at + 10])) == [plain_ids(t) for t in texts[at : at + 10]]
        assert len(own.known) + len(own.older) <= 2000
    assert learned.count("often") == 1 and len(learned) > 4000


def least_bins(lengths, capacity):
    """Fewest bins by trying all ways to fill them."""
    best = len(lengths)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for r in {room for room in rooms if room >= lengths[i]}:
            rest = list(rooms)
            rest.remove(r)
            place(i + 1, [*rest, r - lengths[i]])
        place(i + 1, [*rooms, capacity - lengths[i]])

    place(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_bounds_and_packing(lengths):
    sizes = np.array(lengths)
    bins, offsets = packing.best_fit_decreasing(sizes, 20)
    least = least_bins(lengths, 20)
    assert packing.lower_bound(sizes, 20) <= least <= bins.max() + 1
    spans = sorted(zip(bins.tolist(), offsets.tolist(), lengths))
    for _, group in itertools.groupby(spans, key=lambda s: s[0]):
        at = 0
        for _, offset, size in group:
            assert offset == at
            at += size
        assert at <= 20


@pytest.mark.parametrize("per_partition", [50_000, 40])
def test_documents_become_full_sequences(spark, per_partition):
    rng = np.random.default_rng(5)
    texts = [" ".join(["word"] * int(n)) for n in rng.integers(0, 60, 400)] + [None, "", "z " * 333]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(7, texts[7], "x"), (None, "a b", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, Sequence_ID string")
    pieces = packing.token_pieces(docs.drop("Sequence_ID"), PATH, capacity=100)
    found = packing.pack(pieces, capacity=100, pieces_per_partition=per_partition).collect()
    whole = {}
    for i, t, _ in rows:
        ids = plain_ids(t) + (1).to_bytes(4, "little")
        for p in range(0, len(ids), 400):
            key = (i, p // 400, p // 4, len(ids[p : p + 400]) // 4, zlib.crc32(ids[p : p + 400]))
            whole[key] = whole.get(key, 0) + 1
    ours = {}
    for r in found:
        key = (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
        ours[key] = ours.get(key, 0) + 1
    assert ours == whole
    bins = {}
    for r in found:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in bins.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 100
    total = sum(k[3] * n for k, n in whole.items())
    assert len(bins) <= -(-total // 100) + 3


def test_sequences_hold_the_token_ids(spark):
    rows = [(i, f"Some words, {i} of them. " * (i % 7 * 9)) for i in range(60)] + [(60, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = packing.pack(packing.token_pieces(docs, PATH, capacity=100), capacity=100).collect()
    whole, sequences = {}, {}
    for r in sorted(found, key=lambda r: r.start):
        whole[r.doc_id] = whole.get(r.doc_id, b"") + bytes(r.ids)
    for r in sorted(found, key=lambda r: r.offset):
        before = sequences.get(r.sequence_id, b"")
        assert len(before) == 4 * r.offset and len(r.ids) == 4 * r.length
        sequences[r.sequence_id] = before + bytes(r.ids)
    assert whole == {i: plain_ids(t) + b"\x01\0\0\0" for i, t in rows}
    assert max(map(len, sequences.values())) <= 400


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert packing.pack(packing.token_pieces(docs, PATH)).count() == 0


def test_own_columns_of_any_name(spark):
    rows = [(i, "a b " * i, "s", i, "c", 1.5, "row", 7) for i in range(50)]
    schema = "doc_id bigint, text string, Sequence_ID string, Offset int, cut string, Start double, row string, own int"
    docs = spark.createDataFrame(rows, schema)
    pieces = packing.token_pieces(docs, PATH, capacity=40)
    named = ["doc_id", "Sequence_ID", "Offset", "cut", "row", "own", "piece", "start", "length", "ids", "ids_crc32"]
    assert pieces.columns == named
    found = packing.pack(pieces, capacity=40)
    assert found.columns == [*(n for n in named if n not in ("Sequence_ID", "Offset")), "sequence_id", "offset"]
    got = found.collect()
    assert {(r.cut, r.row, r.own) for r in got} == {("c", "row", 7)}
    assert {r.doc_id for r in got} == set(range(50)) and all(0 <= r.offset < 40 for r in got)


def test_rounds_go_on_until_none_saves_a_bin(spark):
    rng = np.random.default_rng(11)
    lengths = [int(n) for n in rng.integers(15, 70, 1500)]
    frame = spark.createDataFrame([(n,) for n in lengths], "length bigint").repartition(1)
    found = packing.pack(frame, capacity=100, pieces_per_partition=6, certify=True).collect()
    assert sorted(r.length for r in found) == sorted(lengths)
    bins, groups = {}, {}
    for r in found:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        groups.setdefault(r.packed_in, set()).add(r.sequence_id)
    for spans in bins.values():
        ends = list(itertools.accumulate(n for _, n in sorted(spans)))
        assert [o for o, _ in sorted(spans)] == [0, *ends[:-1]] and ends[-1] <= 100
    # Each certificate tells the bins that its pieces take, and no more than they need at least.
    assert all(r.packed_bound <= r.packed_bins == len(groups[r.packed_in]) for r in found)
    rounds = {r.packed_in >> 56 for r in found}
    once = [packing.best_fit_decreasing(np.array(lengths[i : i + 6]), 100)[0].max() + 1 for i in range(0, 1500, 6)]
    assert len(rounds) > 4 and len(bins) < sum(once)


def test_one_partition_is_certified(spark):
    frame = spark.createDataFrame([(n,) for n in [60, 60, 60, 40, 40, 10]], "length bigint")
    found = packing.pack(frame, capacity=100, certify=True).collect()
    assert {(r.packed_bins, r.packed_bound) for r in found} == {(3, 3)}
