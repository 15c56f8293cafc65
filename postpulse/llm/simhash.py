"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints that differ in at most ``max_bits`` bits agree on one of ``max_bits + 1`` blocks of
bits, so the top nodes of the index are the masked patterns (block, value). Below such a node the
fingerprints are sorted by Gray rank and grouped level by level; each node holds the bits that
all its members share. Two nodes are compared on shared bits only: the differences found add up
on the way down, and a pair of whole groups is dropped once they exceed ``max_bits``.

Only distinct fingerprints are compared. A node returns links to the smallest member of each
local component, never pairs; components of the links are found with large and small stars.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .rows import append_columns, reach_workers, release, shuffle_partitions, stored, without

SHINGLE = 4
SEED = 42
MAX_BITS = 4
BITS = 64
FANOUT = 16
#: Members of a top node in one task; fuller nodes are cut into tiles.
TILE = 50_000
#: Fingerprints of small top nodes that one task gets at a time, about.
PER_TASK = 100_000
PAIRS_AT_ONCE = 4096

_BYTE_BITS = np.unpackbits(
    np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little"
).astype(np.int64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash: each bit is set if over half of the shingle hashes have it."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    wide = min(shingle, len(words)) - 1
    spans = zip(starts[: len(words) - wide].tolist(), ends[wide:].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in spans], "<u8")
    octets = hashes.view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(octets[:, i], minlength=256) @ _BYTE_BITS for i in range(8)])
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(
    docs: DataFrame, *, text_col: str = "text", shingle: int = SHINGLE, keep_text: bool = True
) -> DataFrame:
    """``docs`` with ``fingerprint``, a bigint that holds the 64 bits; no words: zero."""

    def make():
        release()

        def work(batch: pa.RecordBatch) -> list:
            found = [fingerprint(t, shingle) for t in batch.column(text_col).to_pylist()]
            return [np.array(found, np.uint64).view(np.int64)]

        return work

    return append_columns(
        docs, "fingerprint bigint", make, drop=() if keep_text else (text_col,)
    )


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Place of each 64-bit pattern in the reflected Gray sequence."""
    rank = values.copy()
    for step in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(step)
    return rank


class _Level:
    """Nodes of one level: bits that all members share (``mask``), their values (``bits``),
    and the range of children in the level below."""

    def __init__(self, bits, mask, top, starts=None, below=0):
        self.bits, self.mask, self.top = bits, mask, top
        if starts is not None:
            self.first, self.last = starts, np.append(starts[1:], below)

    def above(self) -> _Level:
        place = np.arange(len(self.top)) - np.searchsorted(self.top, self.top)
        starts = np.flatnonzero(place % FANOUT == 0)
        both = np.bitwise_and.reduceat(self.bits & self.mask, starts)
        any_ = np.bitwise_or.reduceat(self.bits & self.mask, starts)
        mask = np.bitwise_and.reduceat(self.mask, starts) & ~(both ^ any_)
        return _Level(both & mask, mask, self.top[starts], starts, len(self.top))


class _Labels:
    """Components of items by hooking larger labels under smaller ones."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            la, lb = self.of[a], self.of[b]
            apart = la != lb
            a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
            np.minimum.at(self.of, np.maximum(la, lb), np.minimum(la, lb))
            while True:
                up = self.of[self.of]
                if np.array_equal(up, self.of):
                    break
                self.of = up


def local_components(values: np.ndarray, tops: np.ndarray, max_bits: int) -> np.ndarray:
    """Index of the smallest linked item for each item, all items sorted by (top, Gray rank).

    Items are compared with those of the same top node only.
    """
    full = np.full(len(values), ~np.uint64(0))
    levels = [_Level(values, full, tops)]
    while len(levels) < 2 or len(np.unique(levels[-1].top)) < len(levels[-1].top):
        levels.append(levels[-1].above())
    labels = _Labels(len(values))
    roots = np.arange(len(levels[-1].top))
    work = [(len(levels) - 1, roots, roots, np.zeros(len(roots), np.int64))]
    firsts = [np.arange(len(values))]
    for level in levels[1:]:
        firsts.append(firsts[-1][level.first])
    while work:
        depth, a, b, differ = work.pop()
        if len(a) > PAIRS_AT_ONCE:
            for at in range(0, len(a), PAIRS_AT_ONCE):
                part = slice(at, at + PAIRS_AT_ONCE)
                work.append((depth, a[part], b[part], differ[part]))
            continue
        # Groups that lie in one component already have nothing to add.
        low = np.minimum.reduceat(labels.of, firsts[depth])
        high = np.maximum.reduceat(labels.of, firsts[depth])
        open_ = (low[a] != high[b]) | (high[a] != low[b])
        a, b, differ = a[open_], b[open_], differ[open_]
        upper, level = levels[depth], levels[depth - 1]
        na, nb = upper.last[a] - upper.first[a], upper.last[b] - upper.first[b]
        sizes = na * nb
        pair = np.repeat(np.arange(len(a)), sizes)
        place = np.arange(len(pair)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        x = upper.first[a][pair] + place // nb[pair]
        y = upper.first[b][pair] + place % nb[pair]
        ahead = (x < y) | ((x == y) & (depth > 1))
        pair, x, y = pair[ahead], x[ahead], y[ahead]
        known = upper.mask[a] & upper.mask[b]
        fresh = level.mask[x] & level.mask[y] & ~known[pair]
        total = differ[pair] + np.bitwise_count((level.bits[x] ^ level.bits[y]) & fresh)
        near = total <= max_bits
        if depth == 1:
            labels.join(x[near], y[near])
        elif near.any():
            work.append((depth - 1, x[near], y[near], total[near]))
    return labels.of


def _linker(max_bits: int):
    def link(rows: pd.DataFrame) -> pd.DataFrame:
        values = rows["fingerprint"].to_numpy().view(np.uint64)
        order = np.lexsort((gray_rank(values), rows["value"].to_numpy()))
        values = values[order]
        tops = rows["value"].to_numpy()[order]
        roots = local_components(values, tops, max_bits)
        linked = roots != np.arange(len(roots))
        signed = values.view(np.int64)
        return pd.DataFrame({"a": signed[linked], "b": signed[roots[linked]]})

    return link


def links(prints: DataFrame, *, max_bits: int = MAX_BITS, tile: int = TILE) -> DataFrame:
    """Links (a, b) between distinct fingerprints that span their components.

    ``prints``: a stored table with one row for each distinct ``fingerprint``.
    """
    spark = prints.sparkSession
    reach_workers(spark)
    blocks = max_bits + 1
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    cuts = F.array(
        *[
            F.struct(
                F.lit(i).alias("block"),
                F.shiftrightunsigned("fingerprint", lo)
                .bitwiseAND(F.lit((1 << (hi - lo)) - 1))
                .alias("value"),
            )
            for i, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False))
        ]
    )
    nodes = prints.select("fingerprint", F.inline(cuts))
    # One row for each top node: at most blocks * 2 ** (bits of a block), whatever the input.
    sizes = nodes.groupBy("block", "value").agg(
        F.ceil(F.count("*") / tile).cast("int").alias("tiles")
    )
    parts = max(shuffle_partitions(spark), -(-prints.count() // PER_TASK))
    mine = F.pmod(F.xxhash64("fingerprint", "block"), F.col("tiles")).cast("int")
    dealt = (
        nodes.join(F.broadcast(sizes), ["block", "value"])
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .withColumn("low", F.least("mine", "other"))
        .withColumn("high", F.greatest("mine", "other"))
        .withColumn(
            "task",
            F.when(F.col("tiles") > 1, -1 - F.col("value")).otherwise(
                F.pmod(F.xxhash64("value"), F.lit(parts))
            ),
        )
    )
    found = dealt.groupBy("block", "task", "low", "high").applyInPandas(
        _linker(max_bits), "a bigint, b bigint"
    )
    return found.distinct()


def components(pairs: DataFrame, *, most_rounds: int = 50) -> DataFrame:
    """(node, root) for each node of the links (a, b): the smallest node that it is linked to.

    Large and small stars in turn until nothing moves; each round is a written table, and
    minima combine before the shuffle.
    """
    edges = stored(
        pairs.filter("a <> b").select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
        ).distinct(),
        "links",
    )

    def mark(frame: DataFrame):
        check = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        return tuple(frame.agg(F.count("*"), check).first())

    before = mark(edges)
    for _ in range(most_rounds):
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.distinct(), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(
                F.array(
                    F.struct(F.col("a"), F.col("m").alias("b")),
                    F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                )
            ).alias("e")
        )
        edges = stored(small.select("e.*").filter("a <> b").distinct(), "small-star")
        after = mark(edges)
        if after == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = after
    raise RuntimeError(f"components still move after {most_rounds} rounds")


def _grouped(docs, id_col, text_col, shingle, max_bits, keep_text) -> tuple[DataFrame, DataFrame]:
    """Stored rows with fingerprint and near_row; (fingerprint, component_id) of all of them."""
    own = without(docs, ["fingerprint", "component_id", "near_row"])
    rows = stored(
        fingerprints(own, text_col=text_col, shingle=shingle, keep_text=keep_text).withColumn(
            "near_row", F.monotonically_increasing_id()
        ),
        "fingerprints",
    )
    prints = stored(
        rows.groupBy("fingerprint").agg(F.min(id_col).alias("least_id")), "distinct-fingerprints"
    )
    roots = components(links(prints, max_bits=max_bits)).withColumnRenamed("node", "fingerprint")
    rooted = prints.join(roots, "fingerprint", "left").withColumn(
        "root", F.coalesce("root", "fingerprint")
    )
    named = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return rows, rooted.join(named, "root").select("fingerprint", "root", "component_id")


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` with fingerprint and component_id (smallest id reachable).

    Texts without words have fingerprint zero and are linked like any other. Repeated rows
    belong to one component; rows without an id take part, and a component of such rows alone
    has a null component_id. Columns with the added names are replaced.
    """
    rows, known = _grouped(docs, id_col, text_col, shingle, max_bits, keep_text)
    return rows.drop("near_row").join(known.drop("root"), "fingerprint")


def one_of_each(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """Of each group of near-duplicates the row with the smallest id (null last), then first row."""
    rows, known = _grouped(docs, id_col, text_col, shingle, max_bits, True)
    place = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col), "near_row")
    first = (
        rows.select(id_col, "fingerprint", "near_row")
        .join(known, "fingerprint")
        .groupBy("root")
        .agg(F.min(place).alias("first"))
    )
    kept = rows.join(first.select("first.near_row"), "near_row", "left_semi")
    return kept.drop("near_row", "fingerprint")
