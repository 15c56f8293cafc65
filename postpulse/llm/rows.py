"""How the corpus operators run Python on Spark's tasks, and the sizes they ask of Spark.

Workers get Arrow batches; columns that an operator adds replace input columns of the same
name (in any case), all other columns pass through untouched.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..scratch import shared_folder

# So many rows are Python objects at a time.
ROWS_AT_ONCE = 512

# A classifier is trained for so many labels at most.
MOST_LABELS = 1000

Worker = Callable[[pa.RecordBatch], list]


_held: dict = {}


def held(key: tuple, make: Callable):
    """What ``make`` gives, kept for the next tasks of this Python worker.

    One thing is kept at a time, so the memory of one operator does not add to that of another.
    """
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def release() -> None:
    """Let go of what an earlier operator has kept in this Python worker."""
    _held.clear()


def runs_of(texts: list[str | None], characters: int) -> Iterator[list]:
    """``texts`` in order, in runs of at most so many characters; a longer text is a run alone."""
    run, size = [], 0
    for text in texts:
        own = len(text) if text else 0
        if run and size + own > characters:
            yield run
            run, size = [], 0
        run.append(text)
        size += own
    if run:
        yield run


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver has it.

    On a cluster the library comes with ``--py-files`` or the image; then this changes nothing.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """The columns of ``df`` but those named, in any case."""
    low = {n.lower() for n in names}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in low])


def append_columns(
    df: DataFrame, added: str, make: Callable[[], Worker], drop: tuple[str, ...] = ()
) -> DataFrame:
    """Add columns computed by ``make()``, a function from a batch to one list per new column.

    ``drop`` names input columns that the worker reads but that are not returned.
    """
    reach_workers(df.sparkSession)
    new = StructType.fromDDL(added)
    taken = {n.lower() for n in (*new.names, *drop)}
    kept = [f for f in df.schema if f.name.lower() not in taken]
    schema = StructType([*kept, *new])
    kept_names, types = [f.name for f in kept], [f.type for f in to_arrow_schema(new)]
    names = [*kept_names, *new.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                columns = [pa.array(v, t) for v, t in zip(work(batch), types, strict=True)]
                yield pa.RecordBatch.from_arrays([*map(batch.column, kept_names), *columns], names)

    return df.mapInArrow(run, schema)


def fold(id_col: str, parts: int):
    """crc32 of the id as text, modulo ``parts``; a null id counts as an empty one."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % parts


def training_sample(
    docs: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, documents: int, characters: int
) -> DataFrame:
    """(label, draw, n, words): for each label at most so many texts and characters, by hash.

    ``labels``: (draw, label, size) of the texts to choose from, ``draw`` being
    :func:`draw_of`. Only these narrow rows are shuffled; the chosen texts, a bounded number,
    are then looked up. A text that repeats with its id is taken once. Texts that alone have more
    characters than the bound are drawn only where a label has no others, and then one.
    """
    narrow = labels.groupBy("draw").agg(F.min("label").alias("label"), F.max("size").alias("size"))
    fits = F.col("size") <= characters
    # One row for each label, their number checked, so that no row moves to its label before
    # the draw has thinned them out.
    counted = narrow.groupBy("label").agg(
        F.count("*").alias("all_texts"),
        F.count_if(fits).alias("fitting"),
        F.coalesce(F.sum(F.when(fits, F.col("size"))), F.lit(1)).alias("total"),
    )
    known = counted.limit(MOST_LABELS + 1).collect()
    if len(known) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} different labels")
    totals = F.broadcast(docs.sparkSession.createDataFrame(known, counted.schema))
    texts = F.when(F.col("fitting") > 0, F.col("fitting")).otherwise(F.col("all_texts"))
    chance = 1.2 * F.least(documents / texts, characters / F.greatest("total", F.lit(1)))
    uniform = F.pmod("draw", F.lit(1 << 40)) / float(1 << 40)
    by_label = Window.partitionBy("label").orderBy("draw")
    chosen = (
        narrow.join(totals, "label")
        .filter((uniform < chance) & (fits | (F.col("fitting") == 0)))
        .withColumn("n", F.row_number().over(by_label))
        .withColumn("so_far", F.sum("size").over(by_label))
        .filter((F.col("n") <= documents) & ((F.col("so_far") <= characters) | (F.col("n") == 1)))
        .select("draw", "label", "n")
    )
    texts = docs.select(F.col(text_col).alias("words"), draw_of(id_col, text_col).alias("draw"))
    return texts.join(F.broadcast(chosen), "draw").dropDuplicates(["draw"])


def draw_of(id_col: str, text_col: str):
    return F.xxhash64(id_col, text_col)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lost executors cost no recomputation."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a stored table that nothing will read again."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
