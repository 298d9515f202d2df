"""Sequential work per group in Arrow batches: groups stream through a task one after the other."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

OUT_ROWS = 10_000


def map_groups(df: DataFrame, keys: list[str], order: list[str], work: Callable[[list[dict]], list[tuple]], schema: str) -> DataFrame:
    """work() of each group's rows in an order. A task holds one group at a time, not one data frame per group."""
    fields = StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, arrow = [], to_arrow_schema(fields)

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(arrow)], schema=arrow)

        rows = (r for b in batches for r in b.to_pylist())
        for _, group in groupby(rows, key=lambda r: [r[k] for k in keys]):
            out += work(list(group))
            if len(out) >= OUT_ROWS:
                yield batch()
                out.clear()
        yield batch()

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, fields)
