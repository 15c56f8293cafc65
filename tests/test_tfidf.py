"""Hashed TF-IDF against an independent statement of the hash and the weights."""

import math
from collections import Counter

import pytest

from postpulse.functions.lexicons import ENGLISH_STOP_WORDS
from postpulse.operators import tfidf


def murmur3(data: bytes, seed: int = 42) -> int:
    """The published 32-bit hash, as a signed number."""
    mask = 0xFFFFFFFF

    def turned(x, r):
        return ((x << r) | (x >> (32 - r))) & mask

    def mixed(k):
        return turned(k * 0xCC9E2D51 & mask, 15) * 0x1B873593 & mask

    h = seed
    whole = len(data) // 4 * 4
    for i in range(0, whole, 4):
        h = turned(h ^ mixed(int.from_bytes(data[i : i + 4], "little")), 13) * 5 + 0xE6546B64 & mask
    if data[whole:]:
        h ^= mixed(int.from_bytes(data[whole:], "little"))
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & mask
    h = (h ^ h >> 13) * 0xC2B2AE35 & mask
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


def test_buckets_and_weights(spark):
    texts = ["Spark streams spark joy", "joy of café café windows", "too short", None,
             "the the the spark of words again", "a" * 11]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, full_text string")
    for buckets in (1000, 7):
        kept = {}
        for i, t in enumerate(texts):
            if t and len(t) > 10:
                words = [w for w in t.lower().split() if w not in ENGLISH_STOP_WORDS]
                kept[str(i)] = (words, Counter(murmur3(w.encode()) % buckets for w in words))
        df_of = Counter(b for _, counts in kept.values() for b in counts)
        rows = {r.id: r for r in tfidf.tfidf_vectors(df, num_features=buckets).collect()}
        assert set(rows) == set(kept)
        for i, (words, counts) in kept.items():
            assert rows[i].filtered_words == words
            expected = {b: n * math.log((len(kept) + 1) / (df_of[b] + 1)) for b, n in counts.items()}
            assert {f.bucket: f.weight for f in rows[i].features} == pytest.approx(expected)


def test_no_texts(spark):
    df = spark.createDataFrame([("1", "short")], "id string, full_text string")
    assert tfidf.tfidf_vectors(df).count() == 0
