"""What the text operators share: reading, batches cut by size, shared tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from basketloom.sources.durable import durable

#: Bytes of text a Python worker handles at a time; a longer text is alone.
CHUNK_BYTES = 1 << 21

SPACE = b" \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once, as a table in the shared folder."""
    return durable(df, name)


def chunks(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes of ``column``; rows keep their order."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        sizes = sizes.to_numpy(zero_copy_only=False).astype(np.int64)
        slot = (np.cumsum(sizes) - sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(slot)) + 1).tolist(), len(sizes)]
        for start, end in zip(cuts, cuts[1:]):
            if end > start:
                yield batch.slice(start, end - start)


def utf8(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The values of a string column in UTF-8, null as empty."""
    return [v or b"" for v in batch.column(column).cast(pa.binary()).to_pylist()]


def strings(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The values of a string column, null as empty."""
    return [v or "" for v in batch.column(column).to_pylist()]


def filtered(docs: DataFrame, keep: Callable[[pa.RecordBatch], list[bool]]) -> DataFrame:
    """The rows of ``docs`` that ``keep`` chooses from batches cut by size; all columns, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            yield batch.filter(pa.array(keep(batch), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
