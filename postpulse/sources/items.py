"""Item sources: JSON lines from files, a message log or a socket, batch and streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schemas import RICH_ITEM

LINE_FORMATS = {"text", "socket", "kafka"}


def parse_lines(
    lines: DataFrame, schema: StructType = RICH_ITEM, corrupt_column: str | None = None
) -> DataFrame:
    """JSON lines in ``value`` as item columns; a ``timestamp`` becomes ``spark_timestamp``.

    A bad line gives NULLs, a bad field a NULL for that field. With ``corrupt_column``
    the text of a bad line is kept there.
    """
    options = {"mode": "PERMISSIVE"}
    target = schema
    if corrupt_column:
        target = StructType([*schema.fields, StructField(corrupt_column, StringType())])
        options["columnNameOfCorruptRecord"] = corrupt_column
    parsed = F.from_json(F.col("value").cast("string"), target, options)
    arrival = [F.col("timestamp").alias("spark_timestamp")] if "timestamp" in lines.columns else []
    return lines.select(parsed.alias("data"), *arrival).select(
        "data.*", *["spark_timestamp" for _ in arrival]
    )


def stamp(items: DataFrame) -> DataFrame:
    """Add the processing time and, where the source gave none, the arrival time."""
    if "spark_timestamp" not in items.columns:
        items = items.withColumn("spark_timestamp", F.current_timestamp())
    return items.withColumn("processing_timestamp", F.current_timestamp())


def read_items(
    spark: SparkSession, path: str, schema: StructType = RICH_ITEM, **options: str
) -> DataFrame:
    """A folder of JSON-lines files."""
    return parse_lines(spark.read.options(**options).text(path), schema)


def read_items_stream(
    spark: SparkSession,
    fmt: str = "text",
    schema: StructType = RICH_ITEM,
    path: str | None = None,
    **options: str,
) -> DataFrame:
    """A stream of items.

    ``text``, ``socket`` and ``kafka`` carry one JSON item per record; other file
    formats carry the columns themselves. Intake is limited by the source's own
    options (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``).
    """
    if fmt == "socket":
        options.setdefault("includeTimestamp", "true")
    reader = spark.readStream.format(fmt).options(**options)
    if fmt not in LINE_FORMATS:
        reader = reader.schema(schema)
    loaded = reader.load(path) if path else reader.load()
    return stamp(parse_lines(loaded, schema) if fmt in LINE_FORMATS else loaded)


def item_lines(df: DataFrame) -> DataFrame:
    """Each row as one JSON line in ``value``; characters outside ASCII stay as they are."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def parse_times(
    df: DataFrame, columns: tuple[str, ...] = ("created_datetime", "timestamp_received")
) -> DataFrame:
    """ISO text columns, where present, as timestamps; text that is no time becomes NULL."""

    def parsed(name: str) -> Column:
        return F.try_to_timestamp(F.col(name))

    return df.withColumns({c: parsed(c) for c in columns if c in df.columns})


def table_if_exists(spark: SparkSession, name: str) -> DataFrame | None:
    return spark.table(name) if spark.catalog.tableExists(name) else None
