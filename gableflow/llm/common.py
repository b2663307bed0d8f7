"""Shared helpers: the job's shared folder, written tables, ASCII word rules and bounded Arrow batches."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship
from ..staging import discard, shared_dir, written

__all__ = ["discard", "held", "in_batches", "shared_dir", "slices", "table", "whole_text", "written"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_held: dict = {}


def held(key, make):
    """The worker's own instance of something costly, kept from task to task of the stages that hold it."""
    if key not in _held:
        _held[key] = make()
    return _held[key]


def keep_only(key, stage) -> None:
    """Give back what stages before this one held, and the memory that the process keeps for itself: a worker serves all stages, one after the other."""
    if _held.get("stage") == stage:
        return
    for k in [k for k in _held if k != key]:
        del _held[k]
    _held["stage"] = stage
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every system's C library can
        ctypes.CDLL(None).malloc_trim(0)


#: Rows of documents in one Arrow batch at most: executors hold batches twice, in Spark and in Python.
BATCH_ROWS, _ROWS = 2000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def in_batches(df: DataFrame, run, schema, holds=None) -> DataFrame:
    """mapInArrow over functions of this package, which is sent to the executors first. holds: the key that run keeps.

    The session's Arrow batches are limited to BATCH_ROWS rows from here on, unless it has a lower limit already.
    """
    ship(df.sparkSession)
    if not 0 < int(df.sparkSession.conf.get(_ROWS)) <= BATCH_ROWS:
        df.sparkSession.conf.set(_ROWS, str(BATCH_ROWS))

    stage = uuid.uuid4().hex

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only(holds, stage)
        return run(batches)

    return df.mapInArrow(own, schema)


def struct_of_row(df: DataFrame) -> Column:
    """All columns as one struct, whatever their names: what is added beside it cannot clash with them."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns))


def unused(name: str, columns: list[str]) -> str:
    """The name, made longer until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body) -> Column:
    """body(value) with value computed once: an expression written several times would be evaluated as often."""
    return F.element_at(F.transform(F.array(value), body), 1)


def whole_text(col: str | Column = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], text: str | int, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the texts of one slice stay near max_bytes; a longer text makes a slice by itself."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(text)
        if batch.num_rows == 1 or col.nbytes <= max_bytes:
            yield batch
            continue
        sizes = pa.compute.fill_null(pa.compute.binary_length(col), 0).to_pylist()
        start, total = 0, 0
        for i, n in enumerate(sizes):
            if i > start and total + n > max_bytes:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        yield batch.slice(start)
