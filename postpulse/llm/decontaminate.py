"""Benchmark decontamination: Wu-Manber search for runs of benchmark words.

The alphabet is words, a block is two words. A pattern is a window of an item; patterns of one
length share a SHIFT table (how far the search may jump after a block), HASH buckets by their
last block and PREFIX buckets by their first. A direct comparison confirms each occurrence.

The benchmark is cut into slices of bounded size; each slice is one search pass over the
documents, so the tables of a task never grow with the benchmark. Its size is read first.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .rows import append_columns, release, without

WINDOW = 13
BLOCK = 2
SLICE_BYTES = 1 << 20

# Bytes that are no letter or digit become blanks, A-Z become a-z; bytes beyond ASCII stay.
_FOLD = bytes(
    b if b > 0x7F or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower()
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_FOLD).split() if text else []


def windows_of(words: list[bytes], size: int) -> Iterable[tuple[bytes, ...]]:
    """Runs of ``size`` words; the whole of a shorter item."""
    for start in range(max(1, len(words) - size + 1) if words else 0):
        yield tuple(words[start : start + size])


class Searcher:
    """Wu-Manber tables for patterns of one length."""

    def __init__(self, length: int, patterns: dict[tuple[bytes, ...], list[int]]):
        self.length, self.block = length, min(BLOCK, length)
        self.jump = length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple, dict[tuple, list]] = defaultdict(lambda: defaultdict(list))
        for window, items in patterns.items():
            for end in range(self.block, length + 1):
                block = window[end - self.block : end]
                self.shift[block] = min(self.shift.get(block, self.jump), length - end)
            suffix, prefix = window[-self.block :], window[: self.block]
            self.buckets[suffix][prefix].append((window, items))

    def occurrences(self, words: list[bytes]) -> Iterable[tuple[int, list[int]]]:
        """Start of each occurrence and the items that hold its window."""
        length, block, shift, jump = self.length, self.block, self.shift, self.jump
        end, last = length, len(words)
        while end <= last:
            suffix = tuple(words[end - block : end])
            step = shift.get(suffix, jump)
            if step:
                end += step
                continue
            start = end - length
            for window, items in self.buckets[suffix].get(tuple(words[start : start + block]), ()):
                if tuple(words[start:end]) == window:
                    yield start, items
            end += 1


def searchers(items: list[tuple[str, str | None]], size: int = WINDOW) -> list[Searcher]:
    """One searcher for each length of pattern: ``size``, and the lengths of shorter items."""
    patterns: dict[int, dict] = defaultdict(lambda: defaultdict(list))
    for number, (_, text) in enumerate(items):
        for window in set(windows_of(words_of(text), size)):
            patterns[len(window)][window].append(number)
    return [Searcher(length, found) for length, found in sorted(patterns.items())]


def _search(items: list[tuple[str, str | None]], text_col: str, size: int):
    """A worker: words of each document, and what this slice adds to the hits so far."""

    def make():
        release()
        tables = searchers(items, size)

        def work(batch: pa.RecordBatch) -> list:
            columns = [[], [], [], []]
            earlier = zip(
                batch.column(text_col).to_pylist(),
                batch.column("hit_words").to_pylist(),
                batch.column("hit_items").to_pylist(),
                strict=True,
            )
            for text, bits, names in earlier:
                words = words_of(text)
                hit, found = None, set(names)
                for table in tables:
                    for start, numbers in table.occurrences(words):
                        if hit is None:
                            hit = np.zeros(len(words), bool)
                            if bits:
                                hit |= np.unpackbits(
                                    np.frombuffer(bits, np.uint8), count=len(words)
                                ).astype(bool)
                        hit[start : start + table.length] = True
                        found.update(items[n][0] for n in numbers)
                if hit is not None:
                    bits = np.packbits(hit).tobytes()
                n_hit = int.from_bytes(bits, "big").bit_count() if bits else 0
                row = (len(words), n_hit, bits, sorted(found))
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
            return columns

        return work

    return make


def slices_of(
    benchmark: DataFrame, item_col: str, text_col: str, slice_bytes: int
) -> list[list[tuple[str, str | None]]]:
    """The benchmark in parts of about ``slice_bytes``, fetched one after another."""
    items = benchmark.select(
        F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("words")
    ).filter("item is not null and words is not null")
    size = items.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    count = max(1, math.ceil(size / slice_bytes))
    part = F.pmod(F.xxhash64("item", "words"), F.lit(count))
    return [[tuple(r) for r in items.filter(part == n).collect()] for n in range(count)]


def find_benchmark_words(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text_col: str = "text",
    item_col: str = "item_id",
    benchmark_text_col: str = "text",
    window: int = WINDOW,
    least_share: float = 0.05,
    slice_bytes: int = SLICE_BYTES,
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` with n_words, n_hit, hit_items (sorted names) and contaminated.

    A document word inside any occurrence of a benchmark window is hit. A document is
    contaminated if at least one word and ``least_share`` of its words are hit. A null or empty
    text has no words; an item without words or id has no window; repeated rows are judged one
    by one; an empty benchmark hits nothing. Columns of ``docs`` with the added names are
    replaced.
    """
    added = ["n_words", "n_hit", "hit_items", "hit_words", "contaminated"]
    found = without(docs, added).withColumns(
        {
            "hit_words": F.lit(None).cast("binary"),
            "hit_items": F.array().cast("array<string>"),
        }
    )
    slices = slices_of(benchmark, item_col, benchmark_text_col, slice_bytes)
    for number, items in enumerate(slices, 1):
        found = append_columns(
            found,
            "n_words bigint, n_hit bigint, hit_words binary, hit_items array<string>",
            _search(items, text_col, window),
            drop=() if keep_text or number < len(slices) else (text_col,),
        )
    parts = round(1 / least_share)
    return found.drop("hit_words").withColumn(
        "contaminated", (F.col("n_hit") > 0) & (parts * F.col("n_hit") >= F.col("n_words"))
    )


def items_digest(names: str = "hit_items"):
    """Digest of the sorted item names, joined by commas."""
    return F.sha2(F.array_join(F.array_sort(F.col(names)), ","), 256)


def digest_of(names: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
