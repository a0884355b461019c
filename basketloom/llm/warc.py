"""WARC archives in seekable Zstandard bundles.

Records are grouped into frames that decompress independently. Behind its frames a
bundle has a seek table with their sizes, in a frame that decoders skip. An index
maps each record to its bundle, frame and place in the frame, so one record costs
one frame, and a whole bundle is read by many tasks.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketloom.llm.common import chunks, utf8, written
from basketloom.sources.durable import fresh_path

#: Bytes of records in a frame before compression, and of a bundle after it.
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 256 << 20
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"

# The skippable frame and the footer of the seek table, the profile of revisits.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Compressed bytes of frames that a task reads, and the most tasks.
TASK_BYTES = 2 << 20
MAX_TASKS = 20_000

INDEX = (
    "record_id string, page_id bigint, record_type string, bundle string, frame int,"
    " frame_start bigint, frame_bytes bigint, at bigint, length bigint"
)
FRAMES = "bundle string, frame int, frame_start bigint, frame_bytes bigint"
RECORDS = (
    "record_id string, page_id bigint, url string, record_type string, refers_to bigint,"
    " payload_bytes bigint, payload_digest string"
)


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    types = [kinds[c.split()[1]] for c in schema.split(", ")]
    columns = list(zip(*rows)) or [[]] * len(types)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types)], _names(schema)
    )


def opened(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a URI, of any store pyarrow knows, and the path in it."""
    if uri.startswith("file:"):
        return pa.fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pa.fs.FileSystem.from_uri(uri)


def dedupe_payloads(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Which page holds each payload: ``DF[page_id, url, html, sha1, n_bytes, refers_to]``.

    Of equal payloads of ``min_bytes`` or more the page with the largest id holds
    it; the others refer to that id and lose their html here, so that it is not
    carried further. Digests are counted before they meet the pages.
    """
    html = F.coalesce("html", F.lit(""))
    digests = pages.select("page_id", "url", html.alias("html")).withColumns(
        {"sha1": F.sha1("html"), "n_bytes": F.octet_length("html").cast("bigint")}
    )
    shared = (
        digests.where(F.col("n_bytes") >= min_bytes)
        .groupBy("sha1")
        .agg(F.max("page_id").alias("holder"), F.count("*").alias("n"))
        .where("n > 1 AND holder IS NOT NULL")
        .drop("n")
    )
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("holder")), F.col("holder"))
    return digests.join(written(shared, "digests"), "sha1", "left").select(
        "page_id", "url",
        F.when(refers.isNull(), F.col("html")).alias("html"),
        "sha1", "n_bytes", refers.alias("refers_to"),
    )


def _urn(page_id: int | None) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def record(
    page_id: int | None, url: str | None, payload: bytes, sha1: str, n_bytes: int,
    refers_to: int | None, record_id: str,
) -> bytes:
    """A response, or a revisit of another page, with an HTTP header as its block."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {n_bytes}\r\n\r\n"
    ).encode()
    block = http + (payload if refers_to is None else b"")
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{record_id}>",
        f"WARC-Concurrent-To: <{_urn(page_id)}>",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=_URI)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{_urn(refers_to)}>", f"WARC-Profile: {REVISIT}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


_URI = ":/?#[]@!$&'()*+,;=-._~%"
_HEADER = re.compile(rb"([A-Za-z-]+): ?(.*)\r\n")


def parse(frame: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a frame."""
    at = 0
    while at < len(frame):
        end = frame.index(b"\r\n\r\n", at) + 2
        head = {k.decode().lower(): v.decode() for k, v in _HEADER.findall(frame, at, end)}
        start = end + 2
        stop = start + int(head["content-length"])
        yield head, frame[start:stop]
        at = stop + 4


class Bundle:
    """Writes records as frames, and the seek table when closed."""

    def __init__(self, folder: str) -> None:
        self.uri = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        store, path = opened(self.uri)
        self.file = store.open_output_stream(path, compression=None)
        self.press = zstandard.ZstdCompressor(level=LEVEL)
        self.sizes: list[tuple[int, int]] = []
        self.start = 0

    def frame(self, records: list[bytes]) -> tuple[str, int, int, int]:
        raw = b"".join(records)
        packed = self.press.compress(raw)
        self.file.write(packed)
        self.sizes.append((len(packed), len(raw)))
        where = (self.uri, len(self.sizes) - 1, self.start, len(packed))
        self.start += len(packed)
        return where

    def close(self) -> None:
        table = b"".join(struct.pack("<II", *s) for s in self.sizes)
        table += struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        self.file.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.file.close()


def seek_table(store: pa.fs.FileSystem, path: str) -> list[tuple[int, int]]:
    """Start and compressed size of each frame of a bundle, from its last bytes."""
    with store.open_input_file(path) as file:
        size = file.size()
        file.seek(size - 9)
        count, _, magic = struct.unpack("<IBI", file.read(9))
        if magic != SEEKABLE:
            raise ValueError(f"no seek table in {path}")
        file.seek(size - 9 - 8 * count)
        sizes = [a for a, _ in struct.iter_unpack("<II", file.read(8 * count))]
    starts = [0]
    for s in sizes:
        starts.append(starts[-1] + s)
    return list(zip(starts, sizes))


def _write(folder: str, frame_bytes: int, bundle_bytes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, held, keys = None, [], []

        def flush() -> pa.RecordBatch:
            where = bundle.frame(held)
            rows, at = [], 0
            for (record_id, page_id, kind), data in zip(keys, held):
                rows.append((record_id, page_id, kind, *where, at, len(data)))
                at += len(data)
            held.clear()
            keys.clear()
            return _rows(rows, INDEX)

        waiting = 0
        for batch in chunks(batches, "html"):
            others = [batch.column(c).to_pylist() for c in ("page_id", "url", "sha1", "n_bytes", "refers_to")]
            for payload, page_id, url, sha1, n_bytes, refers_to in zip(utf8(batch, "html"), *others):
                if bundle is None:
                    bundle = Bundle(folder)
                record_id = uuid.uuid4().urn
                held.append(record(page_id, url, payload, sha1, n_bytes, refers_to, record_id))
                keys.append((record_id, page_id, "response" if refers_to is None else "revisit"))
                waiting += len(held[-1])
                if waiting >= frame_bytes:
                    yield flush()
                    waiting = 0
                    if bundle.start >= bundle_bytes:
                        bundle.close()
                        bundle = None
        if held:
            yield flush()
        if bundle is not None:
            bundle.close()

    return run


def write_bundles(
    pages: DataFrame,
    folder: str,
    min_bytes: int = 0,
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
) -> DataFrame:
    """Write a record for each page and give the index, a table in the shared folder.

    A null payload counts as empty, a null url is left out, a null page id is
    written as none: it never holds a payload others have, and revisits the page
    that does. Repeated rows of the holding page are responses each. ``folder`` is
    a URI that all executors reach. A repeated task writes bundles of new names;
    only those named in the index count. Memory is bounded by a frame.
    """
    store, path = opened(folder)
    store.create_dir(path, recursive=True)
    rows = dedupe_payloads(pages, min_bytes)
    return written(rows.mapInArrow(_write(folder, frame_bytes, bundle_bytes), INDEX), "warc-index")


def frames_of(index: DataFrame) -> DataFrame:
    """All frames of the bundles of an index, from their seek tables: ``DF[bundle, frame, ...]``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for uri in batch.column("bundle").to_pylist():
                for i, (start, size) in enumerate(seek_table(*opened(uri))):
                    rows.append((uri, i, start, size))
            yield _rows(rows, FRAMES)

    return index.select("bundle").distinct().mapInArrow(run, FRAMES)


def _page(urn: str | None) -> int | None:
    number = (urn or "").strip("<>").removeprefix("urn:page:")
    return int(number) if number else None


def _record(head: dict[str, str], block: bytes) -> tuple:
    """A row of ``RECORDS`` and the payload of a parsed record."""
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = head["warc-payload-digest"].removeprefix("sha1:")
    refers = head.get("warc-refers-to")
    if refers is None:
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if (found, len(payload)) != (digest, size):
            raise ValueError(f"damaged record {head['warc-record-id']}")
    return (
        head["warc-record-id"].strip("<>"), _page(head["warc-concurrent-to"]),
        head.get("warc-target-uri"), head["warc-type"], _page(refers), size, digest, payload,
    )


def _dealt(frames: DataFrame) -> DataFrame:
    """Frames over as many tasks as their bytes ask for.

    Rows that name frames are tiny: by their own size all would go to one task.
    """
    frames = written(frames, "frames")
    total = frames.agg(F.sum("frame_bytes")).first()[0] or 0
    return frames.repartition(min(MAX_TASKS, 1 + total // TASK_BYTES), "bundle", "frame")


def _unpacked(row: dict, unpack: zstandard.ZstdDecompressor) -> bytes:
    store, path = opened(row["bundle"])
    with store.open_input_file(path) as file:
        file.seek(row["frame_start"])
        return unpack.decompress(file.read(row["frame_bytes"]))


def read_frames(frames: DataFrame, payloads: bool = False) -> DataFrame:
    """Records of frames: ``DF[record_id, page_id, url, record_type, refers_to,
    payload_bytes, payload_digest]``, and the payload if asked for.

    Frames are dealt out to tasks. Size and digest of a response are those of the
    payload read, compared with its headers; a revisit has them in its headers.
    """
    schema = RECORDS + ", payload binary" * payloads

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for row in batch.to_pylist():
                rows = [_record(*r) for r in parse(_unpacked(row, unpack))]
                yield _rows(rows if payloads else [r[:-1] for r in rows], schema)

    return _dealt(frames).mapInArrow(run, schema)


def read_bundles(index: DataFrame, payloads: bool = False) -> DataFrame:
    """All records of the bundles of an index, frames in parallel."""
    return read_frames(frames_of(index), payloads)


def read_records(index: DataFrame, record_ids: DataFrame) -> DataFrame:
    """Some records with their payloads, by their places in the frames that hold them.

    A frame is read and unpacked once for all its wanted records; of what is unpacked
    only their bytes are parsed. An id that the index has not gives no row.
    """
    schema = RECORDS + ", payload binary"
    wanted = index.join(record_ids.select("record_id").distinct(), "record_id", "left_semi")
    places = F.sort_array(F.collect_set(F.struct("at", "length"))).alias("places")
    frames = wanted.groupBy(*_names(FRAMES)).agg(places)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for row in batch.to_pylist():
                raw = _unpacked(row, unpack)
                cut = (raw[p["at"] : p["at"] + p["length"]] for p in row["places"])
                yield _rows([_record(*r) for piece in cut for r in parse(piece)], schema)

    return _dealt(frames).mapInArrow(run, schema)


def archive(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to bundles in the shared folder and read them back."""
    return read_bundles(write_bundles(pages, fresh_path(spark, "warc"), min_bytes))
