"""The user's row function, applied before encoding."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, types as T
from pyspark.sql.pandas.types import to_arrow_schema


def map_rows(df: DataFrame, mapper: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A mapper written as column expressions; it stays inside the optimizer's view."""
    return df.transform(mapper)


def map_records(df: DataFrame, mapper: Callable[[dict], dict],
                schema: T.StructType | str) -> DataFrame:
    """A mapper from dict to dict, for what expressions cannot say. It may add, drop or rename
    columns; ``schema`` is what it returns."""
    result = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(result)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist([mapper(r) for r in batch.to_pylist()], schema=arrow)

    return df.mapInArrow(run, result)
