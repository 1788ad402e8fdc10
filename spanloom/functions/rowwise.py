"""Functions of single rows over Arrow batches, for rules that no built-in expresses."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType


def rowwise(fn: Callable, kind: str) -> Callable:
    """``fn`` of plain Python values, as a function of columns that gives values of the type ``kind``."""
    arrow = to_arrow_type(DataType.fromDDL(kind))

    @F.arrow_udf(kind)
    def run(*columns: pa.Array) -> pa.Array:
        return pa.array([fn(*row) for row in zip(*(c.to_pylist() for c in columns))], arrow)

    return run
