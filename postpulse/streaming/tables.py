"""Tables that grow with a stream: published versions, rows by key, and the ids of the whole run.

Each table has numbered versions, by default the number of the micro-batch. A version is made from
the one before it and the batch, written to new folders, and published by the rename of one small
file. So readers always see one whole version, a replayed batch gives the same version again, and a
run that starts over with lower numbers replaces the versions it makes anew.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..files import Files
from ..operators.ingest import dedupe

#: Bits of one binary of ``bitmap_construct_agg``.
PAGE_BITS = 4096 * 8


class Versions:
    """Published versions below ``root``; a version is a dict that names folders of data."""

    def __init__(self, spark: SparkSession, root: str):
        self.files, self.folder = Files(spark, root), f"{root}/versions"

    def numbers(self) -> list[int]:
        found = self.files.names(self.folder)
        return sorted(int(n.removesuffix(".json")) for n in found if n.endswith(".json"))

    def get(self, number: int) -> dict:
        return json.loads(self.files.read(f"{self.folder}/{number}.json"))

    def latest(self, below: int | None = None) -> dict | None:
        """The last version, or the last one before ``below``."""
        found = [n for n in self.numbers() if below is None or n < below]
        return self.get(found[-1]) if found else None

    def publish(self, number: int, version: dict) -> None:
        """Make ``version`` the last one: the same number and later ones are of an earlier run."""
        for old in reversed([n for n in self.numbers() if n >= number]):
            self.files.remove(f"{self.folder}/{old}.json")
        self.files.put(json.dumps(version), f"{self.folder}/{number}.json")

    def prune(self, keep: int = 2) -> list[dict]:
        """Forget all but the last versions; those that are left."""
        found = self.numbers()
        for old in found[:-keep]:
            self.files.remove(f"{self.folder}/{old}.json")
        return [self.get(n) for n in found[-keep:]]


def _bucket(keys: list[str], buckets: int) -> Column:
    return (F.pmod(F.xxhash64(*keys), F.lit(buckets)) if keys else F.lit(0)).cast("int")


class KeyedTable:
    """One row for each key, kept in buckets; a batch rewrites only the buckets of its keys.

    ``merge`` turns old and new rows of the same keys into one row each. The changes of a batch
    are written first (they are computed once), then merged with the buckets they touch, then
    published. Readers of the version before keep its files until the next batch.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        keys: list[str],
        merge: Callable[[DataFrame], DataFrame],
        buckets: int = 16,
    ):
        self.spark, self.root, self.keys, self.merge, self.buckets = spark, root, keys, merge, buckets
        self.versions = Versions(spark, root)
        self.files = self.versions.files

    def upsert(self, changes: DataFrame, version: int) -> None:
        delta = f"{self.root}/changes/{version}"
        bucket = _bucket(self.keys, self.buckets)
        changes.withColumn("bucket", bucket).write.mode("overwrite").partitionBy("bucket").parquet(delta)
        touched = [n for n in self.files.names(delta) if n.startswith("bucket=")]
        before = self.versions.latest(version) or {"buckets": {}, "schema": changes.schema.json()}
        if touched:
            schema = StructType.fromJson(json.loads(before["schema"]))
            old = [before["buckets"][b] for b in touched if b in before["buckets"]]
            rows = self.spark.read.schema(schema).parquet(*[f"{delta}/{b}" for b in touched])
            if old:
                kept = self.spark.read.schema(schema).parquet(*[f"{self.root}/{p}" for p in old])
                rows = kept.unionByName(rows)
            merged = self.merge(rows).select(*schema.names).withColumn("bucket", bucket)
            folder = f"data/{version}-{uuid.uuid4().hex}"
            merged.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{self.root}/{folder}")
            before["buckets"] |= {b: f"{folder}/{b}" for b in touched}
        self.versions.publish(version, before)
        self.files.remove(delta)
        self._clean()

    def _clean(self) -> None:
        """Remove the data that the last two versions do not name."""
        live = {p for v in self.versions.prune() for p in v["buckets"].values()}
        for folder in self.files.names(f"{self.root}/data"):
            for bucket in self.files.names(f"{self.root}/data/{folder}"):
                if bucket.startswith("bucket=") and f"data/{folder}/{bucket}" not in live:
                    self.files.remove(f"{self.root}/data/{folder}/{bucket}")
            if not any(p.startswith(f"data/{folder}/") for p in live):
                self.files.remove(f"{self.root}/data/{folder}")

    def read(self) -> DataFrame:
        """The rows of the last version."""
        version = self.versions.latest()
        if version is None:
            raise FileNotFoundError(f"no version of a table below {self.root}")
        schema = StructType.fromJson(json.loads(version["schema"]))
        paths = [f"{self.root}/{p}" for p in version["buckets"].values()]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)


class SeenIds:
    """Which ids a stream has had, from its first batch on and without forgetting any.

    Ids lie in buckets. Each bucket has a Bloom filter, a fixed number of pages of bits; an id has
    all its bits in one page. Ids that the filters do not know are new, and no stored id is read
    for them. For the others the buckets they fall into are opened and decide exactly. Ids are
    only ever added: each batch writes a folder, and ``fan`` folders of one size become one of the
    next, so their number grows with the logarithm of the number of batches.

    The filters have buckets * pages * 4 KB for whatever number of ids, which bounds what is
    broadcast; with more ids than a tenth of their bits, buckets are opened more often.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        keys: tuple[str, ...] = ("type", "id"),
        buckets: int = 32,
        pages: int = 16,
        hashes: int = 7,
        fan: int = 8,
    ):
        self.spark, self.root, self.keys, self.fan = spark, root, list(keys), fan
        self.buckets, self.pages, self.hashes = buckets, pages, hashes
        self.versions = Versions(spark, root)
        self.files = self.versions.files

    def _page(self) -> Column:
        return F.pmod(F.xxhash64(F.lit(-1), *self.keys), F.lit(self.pages)).cast("int")

    def _bits(self) -> list[Column]:
        return [
            F.pmod(F.xxhash64(F.lit(i), *self.keys), F.lit(PAGE_BITS)).cast("int")
            for i in range(self.hashes)
        ]

    def _filter_of(self, ids: DataFrame) -> DataFrame:
        bits = ids.select("bucket", self._page().alias("page"), F.explode(F.array(*self._bits())).alias("bit"))
        return bits.groupBy("bucket", "page").agg(F.bitmap_construct_agg("bit").alias("bits"))

    def _known(self) -> Column:
        """Whether all bits of a row's keys are set in the page beside it."""
        is_set = F.lit(True)
        for bit in self._bits():
            byte = F.conv(F.hex(F.substring("bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10)
            # Two to the power of the bit's place within its byte.
            is_set &= F.floor(byte.cast("int") / F.pow(F.lit(2), bit % 8)) % 2 == 1
        return F.coalesce(is_set, F.lit(False))

    def first_copies(self, batch: DataFrame, version: int, target: str, order: tuple[str, ...]) -> None:
        """Write the rows of a batch whose ids no earlier batch had, once each, to ``target``."""
        state = self.versions.latest(version) or {"folders": [], "filter": None}
        once = dedupe(batch, order).withColumn("bucket", _bucket(self.keys, self.buckets))
        staged_at = f"{self.root}/staged/{version}"
        if state["filter"]:
            filters = self.spark.read.parquet(f"{self.root}/{state['filter']}")
            paged = once.withColumn("page", self._page()).join(F.broadcast(filters), ["bucket", "page"], "left")
            once = paged.withColumn("known", self._known()).drop("page", "bits")
        else:
            once = once.withColumn("known", F.lit(False))
        once.write.mode("overwrite").parquet(staged_at)
        staged = self.spark.read.schema(once.schema).parquet(staged_at)
        hit = [r.bucket for r in staged.filter("known").select("bucket").distinct().collect()]
        fresh = staged.filter("not known")
        paths = self._open(state, hit)
        if paths:
            old = self.spark.read.parquet(*paths).select(*self.keys)
            maybe = staged.filter("known").alias("a")
            same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in self.keys]
            fresh = fresh.unionByName(maybe.join(old.alias("b"), same, "left_anti"))
        else:
            fresh = staged
        fresh.drop("known").write.mode("overwrite").parquet(target)
        self._remember(self.spark.read.schema(fresh.drop("known").schema).parquet(target), state, version)
        self.files.remove(staged_at)

    def _open(self, state: dict, buckets: list[int]) -> list[str]:
        """The folders of these buckets, where there are any."""
        found = []
        for folder in state["folders"]:
            names = set(self.files.names(f"{self.root}/{folder['path']}")) if buckets else ()
            found += [
                f"{self.root}/{folder['path']}/bucket={b}" for b in buckets if f"bucket={b}" in names
            ]
        return found

    def _remember(self, fresh: DataFrame, state: dict, version: int) -> None:
        folder, name = (f"{kind}/{version}-{uuid.uuid4().hex}" for kind in ("ids", "filters"))
        ids = fresh.select(*self.keys, "bucket")
        ids.write.partitionBy("bucket").parquet(f"{self.root}/{folder}")
        bits = self._filter_of(ids)
        if state["filter"]:
            bits = bits.unionByName(self.spark.read.parquet(f"{self.root}/{state['filter']}"))
        merged = bits.groupBy("bucket", "page").agg(F.bitmap_or_agg("bits").alias("bits"))
        merged.coalesce(1).write.parquet(f"{self.root}/{name}")
        folders = self._gathered([*state["folders"], {"path": folder, "level": 0}], version)
        self.versions.publish(version, {"folders": folders, "filter": name})
        self._clean()

    def _gathered(self, folders: list[dict], version: int) -> list[dict]:
        """Where ``fan`` folders have one level, one folder of the next level instead."""
        level = 0
        while len(own := [f for f in folders if f["level"] == level]) >= self.fan:
            path = f"ids/{version}-{uuid.uuid4().hex}"
            paths = [
                f"{self.root}/{f['path']}/{n}"
                for f in own
                for n in self.files.names(f"{self.root}/{f['path']}")
                if n.startswith("bucket=")
            ]
            if paths:
                bucket = _bucket(self.keys, self.buckets)
                rows = self.spark.read.parquet(*paths).select(*self.keys).withColumn("bucket", bucket)
                rows.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{self.root}/{path}")
            folders = [f for f in folders if f["level"] != level]
            folders += [{"path": path, "level": level + 1}] if paths else []
            level += 1
        return folders

    def _clean(self) -> None:
        live = {p for v in self.versions.prune() for p in [v["filter"], *(f["path"] for f in v["folders"])]}
        for kind in ("ids", "filters"):
            for name in self.files.names(f"{self.root}/{kind}"):
                if f"{kind}/{name}" not in live:
                    self.files.remove(f"{self.root}/{kind}/{name}")
