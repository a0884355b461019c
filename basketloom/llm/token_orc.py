"""Token ids in ORC files: run-length encoded integers, row indexes and Bloom filters.

Documents are dealt out by ranges of their id and sorted, so each file, stripe and
row group covers a narrow range of ids. A reader that asks for some ids skips the
stripes whose statistics or Bloom filters exclude them; one that reads all gets
stripes as separate tasks.
"""

from __future__ import annotations

import functools
import os
import re
import struct
import zlib
from collections.abc import Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketloom.llm.common import chunks, strings, written
from basketloom.llm.token_count import FROM_LATIN, added_tokens

END_ID = 0
#: Rows of one row index entry, bytes of a stripe, and false positives of the Bloom filters.
ROW_INDEX_STRIDE = 1000
STRIPE_BYTES = 16 << 20
BLOOM_FPP = 0.01

#: Distinct units whose ids a Python worker remembers, and their longest length.
CACHED_UNITS = 800_000
CACHED_CHARS = 64

# White space and what follows up to the next, or up to a comma or full stop behind a
# letter or digit. The vocabulary's own split never reaches across either place, so
# units are encoded apart. Added tokens hold neither, so each stays inside a unit.
_UNIT = re.compile(r"\s*+(?:[^\s,.]++(?:(?!\S)|(?<=[^\W_]))|\S++)|\s++")
# White space to Python, but not to the split: texts with one are encoded whole.
_NO_UNITS = "\x1c\x1d\x1e\x1f"
_PACK = [struct.Struct(f"<{n}I").pack for n in range(16)]

BLANK = FROM_LATIN[0x20]

SCHEMA = "chunk int, row bigint, doc_id bigint, ids array<int>"


class UnitIds(dict):
    """Little-endian unsigned 32-bit ids by unit; new units are encoded when asked for.

    When there is no room the older half goes, so that the units of the last batches
    stay known.
    """

    def __init__(self, tokenizer, most: int = CACHED_UNITS) -> None:
        super().__init__()
        self.tokenizer, self.most = tokenizer, most
        self.merge = tokenizer.model.tokenize

    def __missing__(self, unit: str) -> bytes:
        letters = unit[1:] if unit[0] == " " else unit
        if letters.isalpha():  # one word of the split: only the merges are left to do
            if unit.isascii():
                word = unit.replace(" ", BLANK)
            else:
                word = unit.encode().decode("latin-1").translate(FROM_LATIN)
            found = [t.id for t in self.merge(word)]
        else:
            found = self.tokenizer.encode(unit, add_special_tokens=False).ids
        ids = _PACK[len(found)](*found) if len(found) < len(_PACK) else np.array(found, "<u4").tobytes()
        if len(unit) <= CACHED_CHARS:
            if len(self) >= self.most:
                for old in list(islice(self, self.most // 2 + 1)):
                    del self[old]
            self[unit] = ids
        return ids


class UnitEncoder:
    """Ids of texts by the tokenizers library, each distinct unit encoded once."""

    def __init__(self, path: str, most: int = CACHED_UNITS) -> None:
        added_tokens(path)  # refuses what is not byte-level
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known = UnitIds(self.tokenizer, most)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        known = self.known.__getitem__
        return [
            b"".join(map(known, [t] if any(map(t.__contains__, _NO_UNITS)) else _UNIT.findall(t)))
            for t in texts
        ]


@functools.lru_cache(maxsize=2)
def unit_encoder(path: str) -> UnitEncoder:
    """One encoder per Python worker, which keeps its units from task to task."""
    return UnitEncoder(path)


def write_tokens(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID) -> None:
    """Encode every document and write its ids in ascending order of ``doc_id``.

    Rows are ``(chunk, row, doc_id, ids)``: the file's number, the place in it, and
    the document's ids with ``end_id`` behind them. A null text has only that one,
    a null id comes first, equal ids follow each other by text. Ranges are dealt
    out before the encoding, so that texts and not ids are shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = unit_encoder(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        row = 0
        for batch in chunks(batches):
            ids = [i + end for i in encoder.encode(strings(batch))]
            flat = np.frombuffer(b"".join(ids), "<i4")
            ends = np.cumsum([0, *(len(i) // 4 for i in ids)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("chunk"), pa.array(np.arange(row, row + len(ids))),
                 batch.column("doc_id").cast(pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                ["chunk", "row", "doc_id", "ids"],
            )
            row += len(ids)

    dealt = docs.select("doc_id", "text").repartitionByRange("doc_id")
    ordered = dealt.sortWithinPartitions("doc_id", "text")
    (
        ordered.withColumn("chunk", F.spark_partition_id())
        .mapInArrow(run, SCHEMA)
        .write.option("orc.compress", "ZSTD")
        .option("orc.row.index.stride", ROW_INDEX_STRIDE)
        .option("orc.stripe.size", STRIPE_BYTES)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", BLOOM_FPP)
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str, doc_ids: Sequence[int] | None = None) -> DataFrame:
    """``DF[chunk, row, doc_id, ids]`` of all documents, or of some, which skips other stripes."""
    rows = spark.read.schema(SCHEMA).orc(path)
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin(list(doc_ids)))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        ends = lists.offsets.to_numpy()
        flat = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
        crc = [zlib.crc32(flat[a:b]) for a, b in zip(ends, ends[1:])]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("chunk", "row", "doc_id")),
             pa.array(np.diff(ends).astype(np.int64)), pa.array(crc, pa.int64())],
            ["chunk", "row", "doc_id", "n_tokens", "ids_crc32"],
        )


def token_index(tokens: DataFrame) -> DataFrame:
    """``DF[doc_id, start, n_tokens, ids_crc32]`` of the rows of :func:`read_tokens`.

    ``start`` is the number of ids of all documents before this one: running sums
    within each file's rows, and over the files' totals, one row per file.
    """
    sums = written(
        tokens.mapInArrow(
            _sums, "chunk int, row bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint"
        ),
        "token-sums",
    )
    before = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = sums.groupBy("chunk").agg(F.sum("n_tokens").alias("total"))
    shift = totals.select("chunk", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("shift"))
    inside = Window.partitionBy("chunk").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    placed = sums.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return placed.join(shift, "chunk").select(
        "doc_id", (F.col("shift") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )
