"""Byte-level BPE: texts to token ids and back, by a local file of ranks."""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from basketloom.llm.common import chunks, strings

#: Characters after which a long text is cut at the next safe boundary.
PIECE_CHARS = 1 << 16

# White space after anything else: no match of the split pattern reaches across it,
# as none holds white space after another character. The characters 1C to 1F are
# white space to Python only, so they are no boundary.
_SAFE = re.compile(r"(?<=[^\s\x1c-\x1f])(?=[ \t\n\r])")

SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


@functools.lru_cache(maxsize=4)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file, once per Python worker; no special tokens."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file) if a}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """A text in pieces of ``size`` characters or more, cut where every split of it has a cut."""
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def encode(text: str, enc: tiktoken.Encoding, size: int = PIECE_CHARS) -> list[int]:
    """Token ids of a text; its length only shows in the number of pieces."""
    if len(text) <= size:
        return enc.encode_ordinary(text)
    ids: list[int] = []
    for piece in pieces(text, size):
        ids.extend(enc.encode_ordinary(piece))
    return ids


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Token ids of every document: ``DF[doc_id, ids: array<int>]``; a null text has none.

    Narrow, one row per row; ``path`` is read on the executors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path, pattern)
        for batch in chunks(batches):
            ids = [encode(t, enc) for t in strings(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(ids, pa.list_(pa.int32()))],
                ["doc_id", "ids"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, ids array<int>")


def decode_documents(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """Bytes of every document from its ids: ``DF[doc_id, decoded: binary]``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                raw = [enc.decode_bytes(ids or []) for ids in some.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), pa.array(raw, pa.binary())], ["doc_id", "decoded"]
                )

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, decoded binary")


def bpe_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode every document, decode the ids again, and give digests of both.

    ``DF[doc_id, n_tokens, ids_sha256, decoded_sha256]``: the ids as decimals
    joined by commas, and the decoded bytes. One pass without a shuffle, as
    neither ids nor bytes leave the worker. A null text counts as empty, repeated
    rows give repeated rows, a null id stays null, other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path, pattern)
        decimal = [str(i) for i in range(enc.n_vocab)].__getitem__
        for batch in chunks(batches):
            rows = []
            for text in strings(batch):
                ids = encode(text, enc)
                joined = ",".join(map(decimal, ids)).encode()
                rows.append(
                    (len(ids), hashlib.sha256(joined).hexdigest(),
                     hashlib.sha256(enc.decode_bytes(ids)).hexdigest())
                )
            counts, of_ids, of_bytes = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(counts, pa.int64()),
                 pa.array(of_ids), pa.array(of_bytes)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
