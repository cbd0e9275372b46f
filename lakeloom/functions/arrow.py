"""Arrow-batched kernels: one Python call for a slice of rows, never for a row."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lakeloom.session import ship

#: Rows that a kernel sees at once; bounds a Python worker's memory.
SLICE_ROWS = 512


def map_slices(df: DataFrame, columns: list[str], schema: StructType, factory: Callable[[], Callable[..., list[list]]]) -> DataFrame:
    """Apply a kernel to slices of rows.

    ``factory()`` runs once a task and gives the kernel; the kernel takes one list a
    column of ``columns`` and returns one list a field of ``schema``.
    """
    ship(df.sparkSession)
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = factory()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                out = kernel(*(part.column(i).to_pylist() for i in range(part.num_columns)))
                yield pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(out, target, strict=True)], schema=target)

    return df.select(*columns).mapInArrow(run, schema)
