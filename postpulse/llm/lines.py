"""Line de-duplication that can be taken back.

Exact reference-count tables hold, for each line key, how many documents have it. Beside them,
each shard has a cuckoo filter of its frequent keys. Documents can be inserted and deleted: the
counts move, and keys that cross the threshold enter or leave the filter of their shard. To clean
documents, their keys are sent to the shards; the filter passes few, the exact table decides.

A key is 128 bits of hash. Shards with many requests, such as that of a very common line, are
split over several tasks, each with the shard's filter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .rows import reach_workers, shuffle_partitions, stored, without

MIN_DOCUMENTS = 10
MIN_LENGTH = 1
SLOTS = 4
KICKS = 500
_SPACE = " \t\n\x0b\f\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class CuckooFilter:
    """Sets of 64-bit pairs by 32-bit marks in one of two buckets each.

    A bucket has four slots. ``insert`` fails when no place is found; then the owner builds a
    larger filter from the exact table. ``delete`` takes out one copy of the mark.
    """

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        buckets = 1 << max(4, int(keys / (0.8 * SLOTS)).bit_length())
        return cls(np.zeros((buckets, SLOTS), np.uint32))

    def places(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mask = np.uint64(len(self.table) - 1)
        marks = np.maximum(h2.view(np.uint64) & np.uint64(0xFFFFFFFF), np.uint64(1))
        one = h1.view(np.uint64) & mask
        return marks, one, self._other(one, marks)

    def _other(self, place, mark):
        with np.errstate(over="ignore"):
            jump = (mark * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
        return (place ^ jump) & np.uint64(len(self.table) - 1)

    def contains(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        marks, one, two = self.places(h1, h2)
        marks = marks.astype(np.uint32)[:, None]
        return (self.table[one] == marks).any(axis=1) | (self.table[two] == marks).any(axis=1)

    def insert(self, h1: np.ndarray, h2: np.ndarray) -> bool:
        draw = np.random.default_rng(len(h1))
        for mark, one, two in zip(*self.places(h1, h2), strict=True):
            for place in (one, two):
                free = np.flatnonzero(self.table[place] == 0)
                if len(free):
                    self.table[place, free[0]] = mark
                    break
            else:
                place = two
                for _ in range(KICKS):
                    slot = draw.integers(SLOTS)
                    mark, self.table[place, slot] = np.uint64(self.table[place, slot]), mark
                    place = self._other(place, mark)
                    free = np.flatnonzero(self.table[place] == 0)
                    if len(free):
                        self.table[place, free[0]] = mark
                        break
                else:
                    return False
        return True

    def delete(self, h1: np.ndarray, h2: np.ndarray) -> None:
        for mark, one, two in zip(*self.places(h1, h2), strict=True):
            for place in (one, two):
                held = np.flatnonzero(self.table[place] == mark)
                if len(held):
                    self.table[place, held[0]] = 0
                    break


def lines_of(text: Column) -> Column:
    """Lines between line feeds; null and empty texts are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_of(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(_SPACE)), _UPPER, _LOWER)


def _hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(F.lit(7), key)


def document_keys(docs: DataFrame, text_col: str, min_length: int, *keep: Column) -> DataFrame:
    """(h1, h2) once for each document and key, beside the columns ``keep``."""
    keys = F.array_distinct(F.transform(lines_of(F.col(text_col)), key_of))
    exploded = docs.select(*keep, F.explode(keys).alias("key"))
    h1, h2 = _hashes(F.col("key"))
    return exploded.filter(F.length("key") >= min_length).select(
        *[c for c in exploded.columns if c != "key"], h1.alias("h1"), h2.alias("h2")
    )


def _update_filter(own: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
    """One shard: take keys out of its filter and put new ones in; grow it if it is full."""
    if own.empty and keys.empty:
        return pd.DataFrame(columns=["shard", "filter"])
    if keys.empty:
        return own[["shard", "filter"]]
    h1, h2 = keys["h1"].to_numpy(), keys["h2"].to_numpy()
    was, now = keys["was"].to_numpy(), keys["now"].to_numpy()
    done = False
    if len(own):
        table = np.frombuffer(own["filter"].iloc[0], np.uint32).reshape(-1, SLOTS).copy()
        cuckoo = CuckooFilter(table)
        cuckoo.delete(h1[was & ~now], h2[was & ~now])
        done = cuckoo.insert(h1[now & ~was], h2[now & ~was])
    size = int(now.sum())
    while not done:
        cuckoo = CuckooFilter.sized(size)
        done, size = cuckoo.insert(h1[now], h2[now]), 2 * size
    return pd.DataFrame({"shard": [keys["shard"].iloc[0]], "filter": [cuckoo.table.tobytes()]})


def _probe(requests: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
    """Requests whose key is frequent: those that pass the filter and are in the exact table."""
    out = requests[["row1", "row2", "h1"]]
    if shard.empty or requests.empty:
        return out.iloc[:0]
    held = shard.iloc[0]
    cuckoo = CuckooFilter(np.frombuffer(held["filter"], np.uint32).reshape(-1, SLOTS))
    maybe = requests[cuckoo.contains(requests["h1"].to_numpy(), requests["h2"].to_numpy())]
    exact = pd.MultiIndex.from_arrays([held["keys1"], held["keys2"]])
    asked = pd.MultiIndex.from_arrays([maybe["h1"], maybe["h2"]])
    return maybe.loc[asked.isin(exact), ["row1", "row2", "h1"]]


@dataclass
class LineIndex:
    """Stored tables: counts (shard, h1, h2, n) of all keys, filters (shard, filter)."""

    counts: DataFrame
    filters: DataFrame
    shards: int
    min_documents: int = MIN_DOCUMENTS
    min_length: int = MIN_LENGTH

    @classmethod
    def empty(cls, spark, shards: int | None = None, **bounds) -> LineIndex:
        reach_workers(spark)
        return cls(
            spark.createDataFrame([], "shard bigint, h1 bigint, h2 bigint, n bigint"),
            spark.createDataFrame([], "shard bigint, filter binary"),
            shards or shuffle_partitions(spark),
            **bounds,
        )

    def insert(self, docs: DataFrame, text_col: str = "text") -> LineIndex:
        return self._moved(docs, text_col, 1)

    def delete(self, docs: DataFrame, text_col: str = "text") -> LineIndex:
        """Take back documents that were inserted."""
        return self._moved(docs, text_col, -1)

    def _moved(self, docs: DataFrame, text_col: str, sign: int) -> LineIndex:
        delta = document_keys(docs, text_col, self.min_length).groupBy("h1", "h2").agg(
            (sign * F.count("*")).alias("delta")
        )
        moved = (
            self.counts.select("h1", "h2", "n", F.lit(0).cast("bigint").alias("delta"))
            .unionByName(delta.withColumn("n", F.lit(0).cast("bigint")))
            .groupBy("h1", "h2")
            .agg(F.sum("n").alias("was"), F.sum(F.col("n") + F.col("delta")).alias("n"))
            .withColumn("shard", F.pmod("h1", F.lit(self.shards).cast("bigint")))
        )
        moved = stored(moved.filter("was > 0 or n > 0"), "line-counts")
        frequent = moved.select(
            "shard",
            "h1",
            "h2",
            (F.col("was") >= self.min_documents).alias("was"),
            (F.col("n") >= self.min_documents).alias("now"),
        ).filter("was or now")
        filters = (
            self.filters.groupBy("shard")
            .cogroup(frequent.groupBy("shard"))
            .applyInPandas(_update_filter, "shard bigint, filter binary")
        )
        return LineIndex(
            moved.filter("n > 0").drop("was"),
            stored(filters, "line-filters"),
            self.shards,
            self.min_documents,
            self.min_length,
        )

    def frequent_keys(self) -> DataFrame:
        return self.counts.filter(F.col("n") >= self.min_documents)

    def clean(self, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``docs`` without the lines whose key is frequent, beside n_lines and n_dropped.

        The text of a null is empty afterwards. Repeated rows lose the same lines. Lines that
        the index has never seen stay. Columns named n_lines and n_dropped, in any case, are
        replaced; all others keep their name and content, whatever the name.
        """
        own = without(docs, ["n_lines", "n_dropped"])
        # Equal rows lose equal lines, so a hash of id and text is all that names a row.
        row = [
            F.xxhash64(id_col, text_col).alias("row1"),
            F.xxhash64(F.lit(7), id_col, text_col).alias("row2"),
        ]
        shard = F.pmod("h1", F.lit(self.shards).cast("bigint")).alias("shard")
        requests = document_keys(own, text_col, self.min_length, *row).select("*", shard)
        # One row for each shard: how many tasks share its requests, which its counts tell.
        loads = self.counts.groupBy("shard").agg(F.sum("n").alias("load"))
        mean = loads.agg(F.ceil(F.sum("load") / self.shards).alias("mean"))
        shares = loads.crossJoin(F.broadcast(mean)).select(
            "shard", F.ceil(F.col("load") / F.col("mean")).cast("int").alias("tasks")
        )
        shards = (
            self.filters.join(
                self.frequent_keys().groupBy("shard").agg(
                    F.collect_list(F.struct("h1", "h2")).alias("keys")
                ),
                "shard",
            )
            .join(F.broadcast(shares), "shard")
            .select(
                "shard",
                F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("task"),
                "filter",
                F.col("keys.h1").alias("keys1"),
                F.col("keys.h2").alias("keys2"),
            )
        )
        dealt = requests.join(F.broadcast(shares), "shard").withColumn(
            "task", F.pmod(F.xxhash64("row1"), F.col("tasks")).cast("int")
        )
        dropped = (
            dealt.drop("tasks")
            .groupBy("shard", "task")
            .cogroup(shards.groupBy("shard", "task"))
            .applyInPandas(_probe, "row1 bigint, row2 bigint, h1 bigint")
            .groupBy("row1", "row2")
            .agg(F.collect_set("h1").alias("dropped_keys"))
        )
        # Own columns travel under names that nothing else has.
        names = {c: f"own_{i}" for i, c in enumerate(own.columns)}
        text = next(n for c, n in names.items() if c.lower() == text_col.lower())
        lines = lines_of(F.col(text))
        kept = F.filter(
            lines,
            lambda x: F.col("dropped_keys").isNull()
            | ~F.array_contains("dropped_keys", _hashes(key_of(x))[0]),
        )
        renamed = own.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()], *row)
        texts = renamed.join(dropped, ["row1", "row2"], "left").withColumns(
            {"n_lines": F.size(lines).cast("bigint"), "kept_lines": kept}
        ).withColumns(
            {
                "n_dropped": F.col("n_lines") - F.size("kept_lines"),
                text: F.array_join("kept_lines", "\n"),
            }
        )
        back = [F.col(n).alias(c) for c, n in names.items()]
        return texts.select(*back, "n_lines", "n_dropped")
