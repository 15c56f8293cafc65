"""Fingerprints and components against brute force."""

import numpy as np
import pytest
import xxhash

from postpulse.llm import simhash

rng = np.random.default_rng(7)


def plain_fingerprint(text):
    words = [w for w in (text or "").encode().lower().split()]
    runs = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \n", "A", "a b c", "Ab cD é F\tg\x0bh a b c d", "x " * 999])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def plain_components(values, max_bits):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (int(values[i]) ^ int(values[j])).bit_count() <= max_bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(values))]


def clustered(n):
    """Chains of values that differ in few bits, and lone ones."""
    values = list(rng.integers(0, 2**63, n // 3, dtype=np.uint64))
    while len(values) < n:
        flips = sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 8), replace=False))
        values.append(np.uint64(int(values[rng.integers(len(values))]) ^ flips))
    return np.unique(np.array(values, np.uint64))


def test_gray_neighbours_differ_in_one_bit():
    ranks = np.sort(simhash.gray_rank(np.arange(256, dtype=np.uint64)))
    assert ranks.tolist() == list(range(256))
    order = np.argsort(simhash.gray_rank(np.arange(256, dtype=np.uint64)))
    assert set(np.bitwise_count(order[1:] ^ order[:-1]).tolist()) == {1}


@pytest.mark.parametrize("tile", [50_000, 7])
def test_components_are_those_of_all_pairs(spark, tile):
    values = clustered(600)
    expected = plain_components(values, 4)
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fingerprint bigint")
    found = simhash.components(simhash.links(frame, tile=tile)).collect()
    root = {r.node: r.root for r in found}
    ours = [root.get(int(v), int(v)) for v in values.view(np.int64)]
    groups = lambda names: sorted(sorted(np.flatnonzero(np.array(names) == x)) for x in set(names))
    assert [list(g) for g in groups(ours)] == [list(g) for g in groups(expected)]


def test_near_duplicates_of_odd_rows(spark):
    rows = [(5, "a b c d e f"), (3, "A  b c\td e f"), (None, "a b c d e f"), (9, None), (8, ""),
            (1, "other words of no kin here"), (1, "other words of no kin here")]
    docs = spark.createDataFrame([(*r, "x", 0) for r in rows],
                                 "doc_id bigint, text string, Component_ID string, near_row int")
    found = simhash.near_duplicates(docs)
    ids = sorted((str(r.doc_id), r.component_id) for r in found.collect())
    assert ids == [("1", 1), ("1", 1), ("3", 3), ("5", 3), ("8", 8), ("9", 8), ("None", 3)]
    assert sorted(r.doc_id for r in simhash.one_of_each(docs).collect()) == [1, 3, 8]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
