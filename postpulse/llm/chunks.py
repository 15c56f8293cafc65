"""Chunks of rows: a bounded part of a task's rows that is worked on as arrays.

A chunk's own columns travel with it as one list of structs, so that no name can clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, StructType

from .rows import ROWS_AT_ONCE


def text_chunks(
    batches: Iterator[pa.RecordBatch], column: str, chunk_bytes: int
) -> Iterator[tuple[int, pa.Table]]:
    """(number, rows) with about ``chunk_bytes`` in ``column``; a longer text is a chunk of its own size."""
    number = TaskContext.get().partitionId() << 24
    held, size = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(at, ROWS_AT_ONCE)
            held.append(part)
            size += part.column(column).nbytes
            if size >= chunk_bytes:
                yield number, pa.Table.from_batches(held).combine_chunks()
                number, held, size = number + 1, [], 0
    if held:
        yield number, pa.Table.from_batches(held).combine_chunks()


def with_own(docs: DataFrame, kept: DataFrame, text_col: str) -> tuple[DataFrame, StructType]:
    """The columns of ``kept`` as own_0, own_1, ... beside the text as ``words``; and their type.

    One more column stands for rows that have none, as no file holds an empty struct.
    """
    read = docs.select(
        *[F.col(f"`{c}`").alias(f"own_{i}") for i, c in enumerate(kept.columns)],
        F.lit(True).alias("own_row"),
        F.col(f"`{text_col}`").alias("words"),
    )
    return read, StructType(read.schema.fields[:-1])


def own_list(rows: pa.Table, listed: pa.DataType) -> pa.Array:
    """The own columns of a chunk as one list of structs of the given list type."""
    fields = list(listed.value_type)
    arrays = [rows.column(f.name).combine_chunks().cast(f.type) for f in fields]
    own = pa.StructArray.from_arrays(arrays, fields=fields)
    return pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own)


def own_type(fields: StructType) -> ArrayType:
    return ArrayType(fields)
