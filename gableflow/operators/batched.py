"""Arrow-batched application of a Python kernel to columns: the only way in which the library runs Python on executors."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..shipping import ship


def arrow_type(kind: T.DataType) -> pa.DataType:
    return to_arrow_schema(T.StructType([T.StructField("x", kind)])).field(0).type


def arrow_function(kind: T.DataType, run: Callable):
    """run(arrays) -> array as a function of columns."""

    def own(*arrays: pa.Array) -> pa.Array:
        return run(*arrays)

    own.__annotations__ = {"arrays": pa.Array, "return": pa.Array}
    return F.arrow_udf(own, kind)


def row_function(kind: T.DataType, kernel: Callable):
    """kernel(values) -> value as a function of columns, called for every row of a batch."""
    made = arrow_type(kind)
    return arrow_function(kind, lambda *arrays: pa.array([kernel(*row) for row in zip(*(a.to_pylist() for a in arrays), strict=True)], made))


def batched(df: DataFrame, kind: T.DataType, run: Callable, *columns: str | Column) -> Column:
    """run(arrays) -> array as a column: only these columns travel to Python, the rest of the row stays where it is.

    It is marked as not deterministic, so that no filter on the result moves below and has it computed twice.
    """
    ship(df.sparkSession)
    return arrow_function(kind, run).asNondeterministic()(*columns)


def with_kernel(df: DataFrame, name: str, kind: T.DataType, kernel: Callable, *columns: str) -> DataFrame:
    """df with the column name = kernel(*columns) for every row."""
    ship(df.sparkSession)
    return df.withColumn(name, row_function(kind, kernel).asNondeterministic()(*columns))
