"""One schema for stored files whose columns changed over time.

Spark merges the footers of files that differ in columns only, in one distributed pass. Where types
differ too, the paths are halved until each part has one schema; parts with equal schemas become
one scan, and the scans are united with each column in the narrowest type that holds all of it.
"""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from ..files import Files

_WHOLE = (ByteType(), ShortType(), IntegerType(), LongType())


def wider(a: DataType, b: DataType) -> DataType:
    """The narrowest type that holds the values of both; text where nothing else does."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    numbers = (*_WHOLE, FloatType(), DoubleType())
    if a in numbers and b in numbers:
        return DoubleType()
    if isinstance(a, DecimalType) and isinstance(b, DecimalType):
        scale = max(a.scale, b.scale)
        whole = max(a.precision - a.scale, b.precision - b.scale)
        return DecimalType(whole + scale, scale) if whole + scale <= 38 else StringType()
    if {type(a), type(b)} == {DateType, TimestampType}:
        return TimestampType()
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(wider(a.elementType, b.elementType))
    if isinstance(a, StructType) and isinstance(b, StructType):
        return merged(a, b)
    if isinstance(a, MapType) and isinstance(b, MapType):
        return MapType(wider(a.keyType, b.keyType), wider(a.valueType, b.valueType))
    return StringType()


def merged(a: StructType, b: StructType) -> StructType:
    """The fields of ``a``, then those that only ``b`` has; names in any case are one name."""
    own = {f.name.lower(): f for f in b.fields}
    fields = [
        StructField(f.name, wider(f.dataType, own.pop(f.name.lower()).dataType))
        if f.name.lower() in own
        else StructField(f.name, f.dataType)
        for f in a.fields
    ]
    return StructType([*fields, *[StructField(f.name, f.dataType) for f in own.values()]])


def _reader(spark: SparkSession, skip_broken: bool):
    return (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .option("ignoreCorruptFiles", str(skip_broken).lower())
    )


# Footers that cannot be merged, as their types or the case of their names differ.
_DIFFERENT = ("CANNOT_MERGE", "COLUMN_ALREADY_EXISTS")


def schemas_of(
    spark: SparkSession, paths: list[str], skip_broken: bool = False
) -> list[tuple[list[str], StructType]]:
    """Paths by the schema that their files share; no files, no fields."""
    try:
        schema = _reader(spark, skip_broken).option("mergeSchema", "true").parquet(*paths).schema
        return [(paths, schema)]
    except (PySparkException, Py4JJavaError) as error:
        said = str(error)
        if "UNABLE_TO_INFER_SCHEMA" in said:
            return [(paths, StructType([]))]
        if not any(d in said for d in _DIFFERENT):
            raise
        parts = paths if len(paths) > 1 else Files(spark, paths[0]).matching(f"{paths[0]}/*")
        if not parts:
            raise
    half = max(1, len(parts) // 2)
    found: list[tuple[list[str], StructType]] = []
    for part in filter(None, (parts[:half], parts[half:])):
        for own, schema in schemas_of(spark, part, skip_broken):
            same = next((p for p, s in found if s == schema), None)
            if same is None:
                found.append((list(own), schema))
            else:
                same += own
    return found


def _as(column: Column, have: DataType, want: DataType) -> Column:
    """A column in a wider type; a list or group as text is JSON."""
    if have == want:
        return column
    if isinstance(want, StringType) and isinstance(have, (ArrayType, StructType, MapType)):
        return F.to_json(column)
    if isinstance(want, ArrayType) and isinstance(have, ArrayType):
        return F.transform(column, lambda x: _as(x, have.elementType, want.elementType))
    if isinstance(want, StructType) and isinstance(have, StructType):
        own = {f.name.lower(): f for f in have.fields}
        fields = []
        for f in want.fields:
            from_ = own.get(f.name.lower())
            value = F.lit(None).cast(f.dataType)
            if from_ is not None:
                value = _as(column.getField(from_.name), from_.dataType, f.dataType)
            fields.append(value.alias(f.name))
        return F.when(column.isNotNull(), F.struct(*fields))
    return column.cast(want)


def read_merged(
    spark: SparkSession,
    paths: list[str],
    declared: StructType,
    tags: dict[str, Column],
    skip_broken: bool = False,
) -> DataFrame:
    """All columns of all files: the declared ones first, then the others; NULL where absent.

    ``tags`` are further columns of each scan, which may use its ``_metadata``.
    """
    groups = schemas_of(spark, paths, skip_broken)
    whole = declared
    for _, schema in groups:
        whole = merged(whole, schema)
    scans = []
    for own_paths, schema in groups:
        stored = merged(schema, StructType([f for f in declared.fields if f not in schema.fields]))
        # A stored type wins over the declared one, which is only asked of columns that are absent.
        names = {f.name.lower(): f for f in schema.fields}
        stored = StructType([names.get(f.name.lower(), f) for f in stored.fields])
        of = {f.name.lower(): f for f in stored.fields}
        columns = []
        for f in whole.fields:
            have = of.get(f.name.lower())
            value = F.lit(None).cast(f.dataType)
            if have is not None:
                value = _as(F.col(f"`{have.name}`"), have.dataType, f.dataType)
            columns.append(value.alias(f.name))
        rows = _reader(spark, skip_broken).schema(stored).parquet(*own_paths)
        scans.append(rows.select(*columns, *[c.alias(n) for n, c in tags.items()]))
    return reduce(DataFrame.unionByName, scans)
