"""Stored batches ``<root>/batch_<id>``: reading, tagging, choosing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..files import Files
from ..schemas import METRICS, RICH_ITEM
from .items import parse_times
from .merging import read_merged
from .sinks import write_raw_batch

# Where the batch number stands in a path, and the file kinds that hold data.
BATCH_IN_PATH = r"batch_(\d+)"
COMMUNITY_IN_PATH = r"/subreddit=([^/]*)/"
DATA_EXTENSIONS = ("csv", "json", "parquet", "txt")


def batch_number(path: Column) -> Column:
    """Number in the path, 0 where there is none."""
    found = F.regexp_extract(path, BATCH_IN_PATH, 1)
    return F.coalesce(F.nullif(found, F.lit("")).try_cast("int"), F.lit(0))


def _has_community(path: Column) -> Column:
    return F.regexp_extract(path, COMMUNITY_IN_PATH, 1) != ""


def _community(path: Column) -> Column:
    """Community in the path; folder names are escaped, and so is the path as a whole."""

    def unescaped(text: Column) -> Column:
        return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))

    folder = F.regexp_extract(path, COMMUNITY_IN_PATH, 1)
    name = unescaped(unescaped(folder))
    return F.when(folder != "", F.nullif(name, F.lit("__HIVE_DEFAULT_PARTITION__")))


_TAGS = ("batch_number", "file_path", "file_timestamp")


def read_batches(
    spark: SparkSession,
    root: str,
    schema: StructType = RICH_ITEM,
    batch: int | str = "*",
    community: str = "*",
    skip_broken: bool = False,
    times: bool = True,
    merge: bool = True,
) -> DataFrame:
    """Stored batches, each row with batch number, file path and file time.

    All Parquet files below ``root`` are read, whatever the folders; outside a batch folder
    the number is 0. A broken file is an error, unless ``skip_broken`` is set: then
    :func:`files_without_rows` tells what was passed over. Columns beyond ``schema`` follow it,
    NULL in files without them; a column stored in several types has one that holds them all.
    Without ``merge`` no footer is read ahead and only the columns of ``schema`` are. ``times`` turns
    the time texts of ``schema`` into timestamps. The community comes from the folder name, else from
    the file; ``batch`` and ``community`` (glob patterns) list the wanted folders only, and
    :func:`in_communities` is a filter that opens only the files of some communities.
    """
    folder = root
    if community != "*":
        folder = f"{root}/batch_{batch}/subreddit={community}"
    elif batch != "*":
        folder = f"{root}/batch_{batch}"
    tags = {
        "__path": F.col("_metadata.file_path"),
        "__time": F.col("_metadata.file_modification_time"),
    }
    if merge:
        pattern = f"{root}/*" if folder == root else folder
        paths = Files(spark, root).matching(pattern) or [folder]
        rows = read_merged(spark, paths, schema, tags, skip_broken)
    else:
        rows = (
            spark.read.schema(schema)
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet")
            .option("ignoreCorruptFiles", str(skip_broken).lower())
            .parquet(folder)
            .select(*schema.names, *[c.alias(n) for n, c in tags.items()])
        )
    path = F.col("__path")
    named = F.when(_has_community(path), _community(path)).otherwise(F.col("subreddit"))
    # Stored columns of these names are of an earlier reading.
    own = [c for c in rows.columns if c.lower() not in (*_TAGS, *tags)]
    tagged = rows.select(
        *[named.alias(n) if n == "subreddit" else F.col(f"`{n}`") for n in own],
        batch_number(path).alias("batch_number"),
        path.alias("file_path"),
        F.col("__time").alias("file_timestamp"),
    )
    return parse_times(tagged) if times else tagged


def in_communities(*names: str) -> Column:
    """Rows of some communities of stored batches, by their folders alone: others are not opened."""
    return _community(F.col("file_path")).isin(*names)


def files_without_rows(spark: SparkSession, root: str, batches: DataFrame) -> DataFrame:
    """Parquet files below ``root`` that gave ``batches`` no row: path, length, is_parquet.

    A file whose end is no Parquet end (``is_parquet`` false) was skipped as broken. A sound
    file may hold no rows; one that is damaged inside gives its first rows, so only a strict
    read shows it. Paths are compared first; of the files that are left, whose names are fewer
    than those that any scan of them lists, the contents are read.
    """
    mark = F.lit(b"PAR1")

    def files(*paths: str) -> DataFrame:
        return (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet")
            .load(list(paths))
        )

    read = batches.select(F.col("file_path").alias("path")).distinct()
    left = [r.path for r in files(root).select("path").join(read, "path", "left_anti").collect()]
    found = files(*left) if left else files(root).limit(0)
    return found.select(
        "path", "length", (F.substring("content", -4, 4) == mark).alias("is_parquet")
    )


def compact_batch(spark: SparkSession, root: str, target: str, batch: int) -> str:
    """One stored batch written anew below ``target``, small files of a community gathered."""
    rows = read_batches(spark, root, batch=batch, times=False)
    return write_raw_batch(rows.drop(*_TAGS), target, batch)


def batch_files(batches: DataFrame) -> DataFrame:
    """Files and records per batch."""
    files = batches.groupBy("batch_number", "file_path").agg(F.count("*").alias("records"))
    return (
        files.groupBy("batch_number")
        .agg(F.count("*").alias("files"), F.sum("records").alias("records"))
        .orderBy("batch_number")
    )


def latest_batch(df: DataFrame, by: str = "batch_number") -> DataFrame:
    """Rows of the highest batch number of a frame."""
    latest = df.agg(F.max(by).alias(by))
    return df.join(F.broadcast(latest), by, "left_semi")


def file_inventory(spark: SparkSession, *roots: str) -> DataFrame:
    """Data files below the roots: path, size, modification time. File contents are not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(roots))
    )
    extension = F.lower(F.regexp_extract("path", r"\.([A-Za-z]+)$", 1))
    return files.select("path", "length", "modificationTime", extension.alias("extension")).filter(
        F.col("extension").isin(*DATA_EXTENSIONS)
    )


def current_batch(
    spark: SparkSession, root: str, schema: StructType = RICH_ITEM
) -> DataFrame | None:
    """Rows of the newest stored batch; only that folder is read.

    The number comes from the file names (one value to the driver).
    """
    latest = file_inventory(spark, root).agg(F.max(batch_number(F.col("path")))).first()[0]
    if latest is None:
        return None
    return read_batches(spark, root, schema, batch=latest)


def read_newest(spark: SparkSession, *roots: str) -> DataFrame | None:
    """The newest data file, read by its extension; None if there is no file.

    One path comes to the driver. ``json`` is read as lines; a file in which no line
    is an object is read as one document.
    """
    newest = (
        file_inventory(spark, *roots)
        .agg(F.max(F.struct("modificationTime", "path", "extension")).alias("f"))
        .select("f.path", "f.extension")
        .first()
    )
    if newest is None or newest.path is None:
        return None
    if newest.extension == "parquet":
        return spark.read.parquet(newest.path)
    if newest.extension == "json":
        lines = spark.read.json(newest.path)
        if "_corrupt_record" in lines.columns:
            return spark.read.option("multiLine", "true").json(newest.path)
        return lines
    return spark.read.option("header", "true").option("inferSchema", "true").csv(newest.path)


def read_metrics(spark: SparkSession, root: str) -> DataFrame:
    """Stored metrics rows of all batches."""
    return spark.read.schema(METRICS).json(f"{root}/batch_*[0-9]")
