"""Uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

How many rows each partition sends to each shard is drawn first, with the law that a uniformly
random permutation of all rows would give. Then each partition is permuted locally and cut into
runs of the drawn lengths, the runs are exchanged, and each shard is permuted again. Shard sizes
are exact and differ by one row at most. Only DataFrame functions are used.

All randomness is a hash of the seed and a row's place in a stored table, so a lost task repeats
its own draws.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from .rows import stored, without

ROWS_PER_BLOCK = 200_000
#: Below so many possible values a count is drawn by inversion, else by rejection.
FEW = 16
TRIES = 80


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _uniform(*key: Column) -> Column:
    """A number inside (0, 1) from a hash."""
    return (F.shiftrightunsigned(F.xxhash64(*key), 11).cast("double") + 0.5) * F.lit(2.0**-53)


def log_factorial(n: Column) -> Column:
    """Logarithm of n!, from a table for small n, else Stirling's series."""
    table = F.array(*[F.lit(math.lgamma(i + 1)) for i in range(16)])
    x = F.greatest(n, F.lit(1)).cast("double")
    series = (
        (x + 0.5) * F.log(x)
        - x
        + 0.5 * math.log(2 * math.pi)
        + 1 / (12 * x)
        - 1 / (360 * x * x * x)
        + 1 / (1260 * x * x * x * x * x)
    )
    return F.when(n < 16, F.get(table, n.cast("int"))).otherwise(series)


def _inverted(good: Column, bad: Column, sample: Column, u: Column) -> Column:
    """Inversion along the support, for at most FEW + 1 possible values."""
    low = F.greatest(F.lit(0).cast("bigint"), sample - bad)
    high = F.least(good, sample)

    def log_p(k: Column) -> Column:
        return -(
            log_factorial(k)
            + log_factorial(good - k)
            + log_factorial(sample - k)
            + log_factorial(bad - sample + k)
        )

    total = (
        log_factorial(good + bad)
        - log_factorial(sample)
        - log_factorial(good + bad - sample)
        - log_factorial(good)
        - log_factorial(bad)
    )
    # The last value of the support takes what rounding leaves.
    found = F.aggregate(
        F.sequence(low, high),
        F.struct(u.alias("left"), low.alias("at"), F.lit(False).alias("done")),
        lambda acc, k: _let(
            F.exp(log_p(k) - total),
            lambda p: F.struct(
                (acc["left"] - p).alias("left"),
                F.when(acc["done"], acc["at"]).otherwise(k).alias("at"),
                (acc["done"] | (acc["left"] <= p)).alias("done"),
            ),
        ),
        lambda acc: acc["at"],
    )
    return found


def _rejected(good: Column, bad: Column, sample: Column, *key: Column) -> Column:
    """Ratio of uniforms under a table hat around the mode (Stadlober's method)."""
    few, many = F.least(good, bad), F.greatest(good, bad)
    m = F.least(sample, good + bad - sample)

    def drawn(v: Column) -> Column:
        def weight(z: Column) -> Column:
            return (
                log_factorial(z)
                + log_factorial(v["few"] - z)
                + log_factorial(v["m"] - z)
                + log_factorial(v["many"] - v["m"] + z)
            )

        pop = (v["few"] + v["many"]).cast("double")
        share = v["few"] / pop
        centre = v["m"] * share + 0.5
        width = F.sqrt((pop - v["m"]) * v["m"] * share * (1 - share) / (pop - 1) + 0.5)
        mode = F.floor((v["m"] + 1) * ((v["few"] + 1) / (pop + 2)))
        hat = F.struct(
            centre.alias("centre"),
            (width * (2 * math.sqrt(2 / math.e)) + (3 - 2 * math.sqrt(3 / math.e))).alias("scale"),
            weight(mode).alias("top"),
            (F.least(v["m"], v["few"]) + 1).cast("double").alias("end"),
            mode.alias("mode"),
        )

        def attempt(h: Column, t: Column) -> Column:
            x, y = _uniform(*key, t, F.lit(1)), _uniform(*key, t, F.lit(2))
            return _let(
                F.struct(x.alias("x"), (h["centre"] + h["scale"] * (y - 0.5) / x).alias("w")),
                lambda a: F.when(
                    (a["w"] >= 0)
                    & (a["w"] < h["end"])
                    & (2 * F.log(a["x"]) <= h["top"] - weight(F.floor(a["w"]))),
                    F.floor(a["w"]),
                ),
            )

        return _let(
            hat,
            lambda h: F.coalesce(
                F.aggregate(
                    F.sequence(F.lit(1), F.lit(TRIES)),
                    F.lit(None).cast("bigint"),
                    lambda acc, t: F.coalesce(acc, attempt(h, t)),
                ),
                h["mode"],
            ),
        )

    z = _let(F.struct(few.alias("few"), many.alias("many"), m.alias("m")), drawn)
    z = F.when(good > bad, m - z).otherwise(z)
    return F.when(m < sample, good - z).otherwise(z)


def hypergeometric(good: Column, bad: Column, sample: Column, *key: Column) -> Column:
    """How many of ``good`` are among ``sample`` drawn from ``good + bad``, all bigint."""
    possible = F.least(good, bad, sample, good + bad - sample)
    return (
        F.when(possible <= FEW, _inverted(good, bad, sample, _uniform(*key, F.lit(0))))
        .otherwise(_rejected(good, bad, sample, *key))
        .cast("bigint")
    )


def _row(room: Column, size: Column, *key: Column) -> Column:
    """One row of the matrix: ``size`` rows drawn from shards with ``room`` places."""
    zero = F.lit(0).cast("bigint")
    start = F.struct(
        F.aggregate(room, zero, lambda a, x: a + x).alias("places"),
        size.alias("rows"),
        F.array().cast("array<bigint>").alias("counts"),
    )

    def step(acc: Column, s: Column) -> Column:
        good = F.get(room, s)
        count = hypergeometric(good, acc["places"] - good, acc["rows"], *key, s)
        return _let(
            count,
            lambda x: F.struct(
                (acc["places"] - good).alias("places"),
                (acc["rows"] - x).alias("rows"),
                F.concat(acc["counts"], F.array(x)).alias("counts"),
            ),
        )

    shards = F.sequence(F.lit(0), F.size(room) - 1)
    return F.aggregate(shards, start, step, lambda acc: acc["counts"])


def _matrix(parts: Column, room: Column, *key: Column) -> Column:
    """Rows of the matrix for an array of (id, n), one after another."""
    start = F.struct(
        room.alias("room"), F.array().cast("array<struct<id:bigint,counts:array<bigint>>>").alias("out")
    )

    def step(acc: Column, part: Column) -> Column:
        return _let(
            _row(acc["room"], part["n"], *key, part["id"]),
            lambda row: F.struct(
                F.zip_with(acc["room"], row, lambda a, b: a - b).alias("room"),
                F.concat(
                    acc["out"], F.array(F.struct(part["id"].alias("id"), row.alias("counts")))
                ).alias("out"),
            ),
        )

    return F.aggregate(parts, start, step, lambda acc: acc["out"])


def communication_matrix(sizes: DataFrame, shards: int, seed: int) -> DataFrame:
    """(part, counts): rows from each partition to each shard; ``sizes`` has (part, n).

    Drawn for groups of about sqrt(partitions) partitions first, then inside each group, so no
    task handles more than that many partitions.
    """
    group = sizes.select(
        F.col("part").alias("id"),
        "n",
        F.floor(F.col("part") / F.lit(1 << 10)).alias("big"),
    )
    listed = group.groupBy("big").agg(
        F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct("id", "n"))).alias("parts")
    )
    whole = listed.agg(
        F.array_sort(F.collect_list(F.struct(F.col("big").alias("id"), "n"))).alias("groups"),
        F.sum("n").alias("rows"),
    )
    room = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda s: F.floor(F.col("rows") / shards)
        + F.when(s < F.col("rows") % shards, 1).otherwise(0),
    ).cast("array<bigint>")
    outer = whole.filter("rows > 0").select(
        F.inline(_matrix(F.col("groups"), room, F.lit(seed), F.lit("group")))
    )
    inner = listed.join(
        outer.select(F.col("id").alias("big"), F.col("counts").alias("room")), "big"
    )
    rows = inner.select(
        F.inline(_matrix(F.col("parts"), F.col("room"), F.lit(seed), F.lit("part")))
    )
    return rows.select(F.col("id").alias("part"), "counts")


def shuffle_into_shards(
    docs: DataFrame, shards: int, *, seed: int = 0, rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """``docs`` with shard and slot: a uniform shuffle, shard sizes at most one apart.

    Slots run from 0 without gaps. Nulls and repeated rows are rows like any other; with fewer
    rows than shards some stay empty. Columns named shard and slot are replaced.
    """
    own = without(docs, ["shard", "slot"])
    keyed = own.select(
        F.struct(*[F.col(f"`{c}`") for c in own.columns]).alias("own"),
        F.spark_partition_id().cast("bigint").alias("part"),
        F.xxhash64(
            F.lit(seed), F.lit("local"), F.spark_partition_id(), F.monotonically_increasing_id()
        ).alias("draw"),
    )
    # The low bits of the running id are the place in the permuted partition.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    permuted = stored(
        keyed.sortWithinPartitions("draw").select("own", "part", place.alias("place")), "permuted"
    )
    sizes = permuted.groupBy("part").agg(F.count("*").alias("n"))
    matrix = stored(communication_matrix(sizes, shards, seed), "matrix")
    ends = matrix.select(
        "part",
        F.transform(
            F.sequence(F.lit(1), F.lit(shards)),
            lambda k: F.aggregate(
                F.slice("counts", F.lit(1), k), F.lit(0).cast("bigint"), lambda a, x: a + x
            ),
        ).alias("ends"),
    )
    blocks = F.lit(max(1, -(-(sizes.agg(F.sum("n")).first()[0] or 0) // (shards * rows_per_block))))
    sent = permuted.join(ends, "part").select(
        "own",
        "part",
        "place",
        F.size(F.filter("ends", lambda end: end <= F.col("place"))).alias("shard"),
        F.floor(_uniform(F.lit(seed), F.lit("block"), "part", "place") * blocks).alias("block"),
        F.xxhash64(F.lit(seed), F.lit("shard"), "part", "place").alias("draw"),
    )
    by_shard = Window.partitionBy("shard").orderBy("block")
    bases = (
        sent.groupBy("shard", "block")
        .agg(F.count("*").alias("n"))
        .select("shard", "block", (F.sum("n").over(by_shard) - F.col("n")).alias("base"))
    )
    in_block = Window.partitionBy("shard", "block").orderBy("draw", "part", "place")
    placed = sent.withColumn("rank", F.row_number().over(in_block) - 1)
    return placed.join(bases, ["shard", "block"]).select(
        "own.*", "shard", (F.col("base") + F.col("rank")).alias("slot")
    )
