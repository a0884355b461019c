"""Substring dedup: passages that are, nearly, in an earlier document too.

Texts share seeds: all runs of five words. Each seed leads to the document of
smallest id that has it and to the last one before, so a passage in very many
documents gives each of them two partners and not all others. Equal seeds of two
documents that follow each other are runs; runs are chained, and chains aligned with
the texts around them.

Seeds are joined packed: a row holds those of many documents that fall into one
bucket of hashes, so a seed takes about nine bytes of a shuffle. Seeds in very many
documents, found in some of the documents beforehand, are joined as rows dealt out
by ranges of ids; that changes no result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketloom.functions.numbering import number_sorted
from basketloom.llm.chaining import REACH, SEED_WORDS, chains, passages
from basketloom.llm.common import CHUNK_BYTES, chunks, utf8, written

MIN_WORDS = 50
SIMILARITY = 0.8
#: Seeds of a chain, and words from its first to its last, to be aligned.
MIN_SEEDS = 2
MIN_SPAN = 8
#: Words of a window that is a seed too if it repeats itself: so many of its seeds are the
#: same as one of the PERIODS before.
WIDE_WORDS = 50
PERIODS = 8
WIDE_REPEATS = 12
#: Added to the place of such a window, to tell it from a seed.
WIDE = 1 << 40
#: Bytes of text whose seeds a bucket of hashes holds, and matches a bucket of documents.
BUCKET_BYTES = 1 << 24
#: Fewest buckets, a power of two.
BUCKETS = 32
#: Rows of one seed, as estimated from one document in SAMPLE, from which they are dealt
#: out by ranges of ids, and the seeds this is done for at most, those of most rows.
HOT_ROWS = 1 << 20
SAMPLE = 64
HOT_SEEDS = 1 << 16
#: Stretches of one text that a row asks for, on average.
REQUESTS = 256

CHAIN = "doc_id bigint, source_id bigint, places array<int>, others array<int>, sizes array<int>"
PACKED = "bucket int, n int, packed binary"
PASSAGES = (
    "doc_id bigint, start_word int, end_word int, source_id bigint, source_start int,"
    " source_end int, similarity double"
)


def seeds(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and word numbers of the seeds of a text.

    The second and further occurrences of a seed are there once more, under a hash
    of the seed and their number: so they also meet those of the other text, and
    not its first occurrence only. Windows of :func:`_wide_seeds` follow.
    """
    words = text.lower().split()
    n = len(words) - SEED_WORDS + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    codes = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    # Two hashes of a word, as one of 32 bits is the same for some words.
    codes |= np.fromiter(map(zlib.adler32, words), np.uint64, len(words)) << np.uint64(32)
    hashes = np.zeros(n, np.uint64)
    for i in range(SEED_WORDS):
        hashes = (hashes ^ codes[i : n + i]) * np.uint64(0x9E3779B97F4A7C15)
        hashes ^= hashes >> np.uint64(31)
    order = np.argsort(hashes, kind="stable")
    at = np.arange(n)
    start = np.append(True, hashes[order][1:] != hashes[order][:-1])
    nth = at - np.maximum.accumulate(np.where(start, at, 0))
    again = order[nth > 0]
    numbered = (hashes[again] ^ nth[nth > 0].astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
    numbered ^= numbered >> np.uint64(32)
    wide, start = _wide_seeds(hashes)
    return np.concatenate([hashes, numbered, wide]), np.concatenate([at, again, start + WIDE])


def _wide_seeds(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the windows of ``WIDE_WORDS`` words that repeat themselves.

    The seeds of such a stretch lead to any document with a stretch like it, and not
    to the one with the same words before and behind; a hash of the window does.
    Whether a window repeats itself is a matter of its words alone.
    """
    n, inside = len(hashes), WIDE_WORDS - SEED_WORDS + 1
    if n < inside:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    periodic = np.zeros(n + 1, np.int64)
    for period in range(1, PERIODS + 1):
        periodic[period + 1 :] |= hashes[period:] == hashes[:-period]
    total = np.cumsum(periodic)
    start = np.arange(n - inside + 1)
    start = start[total[start + inside] - total[start + PERIODS] >= WIDE_REPEATS]
    wide = np.zeros(len(start), np.uint64)
    for i in range(0, inside, SEED_WORDS):
        wide = (wide ^ hashes[start + i]) * np.uint64(0xD6E8FEB86659FD93)
        wide ^= wide >> np.uint64(32)
    # Of one window that stands in many places, those that together hold all its words.
    order = np.argsort(wide, kind="stable")
    kept = np.ones(len(order), bool)
    cell = start[order] // (WIDE_WORDS // 2)
    same = wide[order][1:] == wide[order][:-1]
    kept[1:] = ~same | (cell[1:] != cell[:-1])
    kept[:-1] |= ~same
    order = order[kept]
    return wide[order], start[order]


def _planes(column: np.ndarray) -> bytes:
    """The values as all their first bytes, then all their second ones and so on."""
    return column.view(np.uint8).reshape(len(column), -1).T.tobytes()


def _values(raw: bytes, n: int, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(-1, n).T).view(kind).ravel()


def _pack(columns: list[np.ndarray]) -> bytes:
    """Columns of integers of 64 bits as differences, those below zero odd, compressed."""
    steps = [np.diff(c, prepend=np.int64(0)) for c in columns]
    folded = [(d << 1) ^ (d >> 63) for d in steps]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(map(_planes, folded)))


def _unpack(packed: bytes, n: int, columns: int) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    size = 8 * n
    out = []
    for i in range(columns):
        folded = _values(raw[i * size : (i + 1) * size], n, np.uint64)
        signs = -(folded & np.uint64(1)).view(np.int64)
        out.append(np.cumsum((folded >> np.uint64(1)).view(np.int64) ^ signs))
    return out


_PACKED = pa.schema([("bucket", pa.int32()), ("n", pa.int32()), ("packed", pa.binary())])


def _dealt(bucket: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch:
    """A packed row per bucket; columns keep their order within it."""
    order = np.argsort(bucket, kind="stable")
    bucket, columns = bucket[order], [c[order] for c in columns]
    cuts = [*np.flatnonzero(np.diff(bucket, prepend=-1)).tolist(), len(bucket)]
    spans = list(zip(cuts, cuts[1:]))
    return pa.RecordBatch.from_arrays(
        [pa.array([int(bucket[a]) for a, _ in spans], pa.int32()),
         pa.array([b - a for a, b in spans], pa.int32()),
         pa.array([_pack([c[a:b] for c in columns]) for a, b in spans], pa.binary())],
        schema=_PACKED,
    )


def _buckets(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[list[np.ndarray]]:
    """The columns of each bucket of a partition sorted by bucket."""
    now, parts = None, []
    for batch in batches:
        for bucket, n, packed in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if bucket != now and parts:
                yield [np.concatenate(c) for c in zip(*parts)]
                parts = []
            now = bucket
            parts.append(_unpack(packed, n, columns))
    if parts:
        yield [np.concatenate(c) for c in zip(*parts)]


def _seeds_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Seeds, documents and places of a batch, by document and place."""
    found = [seeds(t) for t in utf8(batch)]
    ids = batch.column("doc_id").cast(pa.int64()).to_numpy()
    order = np.argsort(ids, kind="stable").tolist()
    return (
        np.concatenate([np.zeros(0, np.uint64), *(found[i][0] for i in order)]),
        np.repeat(ids[order], [len(found[i][0]) for i in order]),
        np.concatenate([np.zeros(0, np.int64), *(found[i][1] for i in order)]),
    )


def hot_seeds(docs: DataFrame, hot_rows: int = HOT_ROWS) -> np.ndarray:
    """Seeds of at least ``hot_rows`` rows, as one document in ``SAMPLE`` has them, sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            seed, n = np.unique(_seeds_of(batch)[0].view(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(seed), pa.array(n)], ["seed", "n"])

    some = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0).select("doc_id", "text")
    found = (
        some.mapInArrow(run, "seed bigint, n bigint").groupBy("seed").agg(F.sum("n").alias("n"))
        .where(F.col("n") * SAMPLE >= hot_rows).orderBy(F.desc("n"), "seed").limit(HOT_SEEDS)
    )
    return np.array(sorted(r.seed for r in found.select("seed").collect()), np.int64)


def _is_hot(seed: np.ndarray, hot: np.ndarray) -> np.ndarray:
    if not len(hot):
        return np.zeros(len(seed), bool)
    at = np.searchsorted(hot, seed.view(np.int64))
    return hot[np.minimum(at, len(hot) - 1)] == seed.view(np.int64)


def _linked(seed: np.ndarray, doc: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
    """Each place of a seed with its first one in the smallest and in the last earlier document."""
    order = np.argsort(seed)
    ordered = seed[order]
    same = ordered[1:] == ordered[:-1]
    order = order[np.append(False, same) | np.append(same, False)]
    order = order[np.lexsort((place[order], doc[order], seed[order]))]
    seed, doc, place = seed[order], doc[order], place[order]
    at = np.arange(len(seed))
    new = np.ones(len(seed), bool)
    new[1:] = seed[1:] != seed[:-1]
    holder = new.copy()
    holder[1:] |= doc[1:] != doc[:-1]
    first = np.maximum.accumulate(np.where(new, at, 0))
    own = np.maximum.accumulate(np.where(holder, at, 0))
    # The first place in the document before: where the row before the own holder began.
    before = own[np.maximum(own - 1, 0)]
    linked = doc[first] != doc
    two = linked & (before != first)
    rows = np.concatenate([at[linked], at[two]])
    source = np.concatenate([first[linked], before[two]])
    return [doc[rows], doc[source], place[rows], place[source]]


def _as_seeds(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Matches of windows as those of their seeds, each once."""
    wide = columns[2] >= WIDE
    if not wide.any():
        return columns
    doc, source, place, other = (np.repeat(c[wide], WIDE_WORDS - SEED_WORDS + 1) for c in columns)
    step = np.tile(np.arange(WIDE_WORDS - SEED_WORDS + 1), int(wide.sum()))
    place, other = place - WIDE + step, other - WIDE + step
    order = np.lexsort((other, place, source, doc))
    some = [c[order] for c in (doc, source, place, other)]
    new = np.append(True, np.any([c[1:] != c[:-1] for c in some], axis=0))
    return [np.concatenate([c[~wide], x[new]]) for c, x in zip(columns, some)]


def _by_document(columns: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    """Matches packed by bucket of their document."""
    columns = _as_seeds(columns)
    order = np.lexsort((columns[2], columns[1], columns[0]))
    columns = [c[order] for c in columns]
    mixed = columns[0].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    bucket = ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    # Sources as a distance, places of the other text as one: equal in a copy.
    doc, source, place, other = columns
    return _dealt(bucket, [doc, doc - source, place, other - place])


def _hot_matches(docs: DataFrame, hot: np.ndarray, hot_rows: int) -> DataFrame:
    """Matches of the ``hot`` seeds, each dealt out over ranges of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            seed, doc, place = _seeds_of(batch)
            some = _is_hot(seed, hot)
            yield pa.RecordBatch.from_arrays(
                [pa.array(seed[some].view(np.int64)), pa.array(doc[some]), pa.array(place[some])],
                ["seed", "doc_id", "place"],
            )

    rows = written(docs.mapInArrow(run, "seed bigint, doc_id bigint, place bigint"), "hot-seeds")
    low, high, n = rows.agg(F.min("doc_id"), F.max("doc_id"), F.count("*")).first()
    ranges = max(1, n // hot_rows)
    width = max(1, -(-((high or 0) - (low or 0) + 1) // ranges))
    part = F.floor((F.col("doc_id").cast("decimal(20,0)") - F.lit(low or 0)) / width).cast("int")
    # Of the places in one document the first one stands for it.
    held = rows.groupBy("seed", "doc_id").agg(F.min("place").alias("place")).withColumn("part", part)
    ends = held.groupBy("seed", "part").agg(
        F.min(F.struct("doc_id", "place")).alias("least"), F.max(F.struct("doc_id", "place")).alias("most")
    )
    past = Window.partitionBy("seed").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        "seed", "part", F.max("most").over(past).alias("carried"),
        F.min("least").over(Window.partitionBy("seed")).alias("first"),
    )
    before = Window.partitionBy("seed", "part").orderBy("doc_id")
    sources = held.withColumn("last", F.lag(F.struct("doc_id", "place")).over(before)).join(
        carried, ["seed", "part"]
    ).where("doc_id <> first.doc_id").select(
        "seed", "doc_id",
        F.explode(F.array_distinct(F.array("first", F.coalesce("last", "carried")))).alias("source"),
    )
    return rows.join(sources, ["seed", "doc_id"]).select(
        "doc_id", F.col("source.doc_id").alias("source_id"), "place",
        F.col("source.place").alias("other"),
    )


_CHAIN = pa.schema(
    [("doc_id", pa.int64()), ("source_id", pa.int64())]
    + [(name, pa.list_(pa.int32())) for name in ("places", "others", "sizes")]
)


def _runs(doc: np.ndarray, source: np.ndarray, place: np.ndarray, other: np.ndarray) -> list[np.ndarray]:
    """Runs of matches on one diagonal, one word after the other: their first match and words."""
    lead = place - other
    order = np.lexsort((place, lead, source, doc))
    doc, source, place, lead = doc[order], source[order], place[order], lead[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (source[1:] != source[:-1]) | (lead[1:] != lead[:-1])
    # A match may be there twice, by a seed and by its number.
    new[1:] |= np.diff(place) > 1
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc))[: len(first)] - 1
    size = place[last] - place[first] + SEED_WORDS
    doc, source, place, other = doc[first], source[first], place[first], (place - lead)[first]
    order = np.lexsort((other, place, source, doc))
    return [c[order] for c in (doc, source, place, other, size)]


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chains of the pairs of documents of each bucket."""
    for doc, apart, place, other in _buckets(batches, 4):
        if not len(doc):
            continue
        doc, source, place, other, size = _runs(doc, doc - apart, place, other + place)
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (source[1:] != source[:-1])
        first = np.flatnonzero(new)
        end = np.append(first[1:], len(doc))
        some = np.add.reduceat(size - SEED_WORDS + 1, first) >= MIN_SEEDS
        some &= np.maximum.reduceat(place + size - SEED_WORDS, first) - place[first] >= MIN_SPAN
        rows = []
        for a, b in zip(first[some].tolist(), end[some].tolist()):
            for chain in chains(place[a:b], other[a:b], size[a:b]):
                chosen = np.array(chain) + a
                span = place[chosen[-1]] + size[chosen[-1]] - SEED_WORDS - place[chosen[0]]
                if (size[chosen] - SEED_WORDS + 1).sum() >= MIN_SEEDS and span >= MIN_SPAN:
                    rows.append(
                        {"doc_id": int(doc[a]), "source_id": int(source[a]),
                         "places": place[chosen], "others": other[chosen], "sizes": size[chosen]}
                    )
            if len(rows) >= 4096:
                yield pa.RecordBatch.from_pylist(rows, _CHAIN)
                rows = []
        yield pa.RecordBatch.from_pylist(rows, _CHAIN)


def seed_chains(docs: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``DF[doc_id, source_id, places, others, sizes]``: chains of runs of two documents.

    The sources of a seed are the smallest id that has it, and the largest one below
    the document's own. One shuffle of packed seeds by their hash, one of packed
    matches by document; the buckets grow in number with the text.
    """
    docs = docs.select("doc_id", "text")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(BUCKETS.bit_length() - 1, (-(-total // BUCKET_BYTES) - 1).bit_length())
    buckets = 1 << bits
    hot = hot_seeds(docs, hot_rows)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, limit=2 * CHUNK_BYTES):
            seed, doc, place = _seeds_of(batch)
            if len(hot):
                cold = ~_is_hot(seed, hot)
                seed, doc, place = seed[cold], doc[cold], place[cold]
            bucket = (seed >> np.uint64(64 - bits)).astype(np.int64)
            yield _dealt(bucket, [doc, place, seed.view(np.int64)])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, place, seed in _buckets(batches, 3):
            yield _by_document(_linked(seed, doc, place), buckets)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i).to_numpy().astype(np.int64) for i in range(4)]
            yield _by_document(columns, buckets)

    def by_bucket(df: DataFrame) -> DataFrame:
        return df.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket")

    matches = by_bucket(docs.mapInArrow(deal, PACKED)).mapInArrow(link, PACKED)
    if len(hot):
        matches = matches.union(_hot_matches(docs, hot, hot_rows).mapInArrow(pack, PACKED))
    return by_bucket(matches).mapInArrow(_chained, CHAIN)


_KEY = ["doc_id", "source_id", "place", "other"]


def _stretches(docs: DataFrame, requests: DataFrame) -> DataFrame:
    """Words asked for by ``DF[id, low, high, side, *_KEY]``: ``DF[side, *_KEY, low, words]``.

    Requests of a text are taken together, a text of very many in several rows.
    """
    many = written(requests.groupBy("id").agg(F.count("*").alias("n")), "requested")
    parts = F.ceil(F.col("n") / REQUESTS)
    lists = requests.join(many, "id").withColumn(
        "part", F.pmod(F.xxhash64("side", *_KEY), parts)
    ).repartition("id", "part").groupBy("id", "part").agg(F.collect_list(F.struct("low", "high", "side", *_KEY)).alias("asked"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            rows = []
            for text, asked in zip(utf8(batch), batch.column("asked").to_pylist()):
                words = text.lower().split()
                for r in asked:
                    part = b" ".join(words[r["low"] : r["high"]])
                    rows.append((r["side"], *(r[k] for k in _KEY), r["low"], part))
            columns = list(zip(*rows)) or [()] * 7
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["side", *_KEY, "low", "words"]
            )

    texts = docs.select(F.col("doc_id").alias("id"), "text")
    return texts.join(written(lists, "requests"), "id").select("text", "asked").mapInArrow(
        run,
        "side int, doc_id bigint, source_id bigint, place int, other int, low int, words binary",
    )


def _uncovered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passages of each document whose words are not all in another of that or a smaller source."""
    for batch in batches:
        column = batch.column("passages")
        kept = [column.flatten().slice(0, 0)]
        for i in range(batch.num_rows):
            rows = column.slice(i, 1).flatten()
            source, start, end, place = (
                rows.field(c).to_numpy()
                for c in ("source_id", "start_word", "end_word", "source_start")
            )
            # Those that cover a passage come before it, of equal ones the smallest source.
            order = np.lexsort((place, source, -end, start))
            out = np.ones(len(rows), bool)
            for at, r in enumerate(order.tolist()):
                before = order[:at]
                out[r] = not ((end[before] >= end[r]) & (source[before] <= source[r])).any()
            kept.append(rows.filter(pa.array(out)))
        yield pa.RecordBatch.from_struct_array(pa.concat_arrays(kept))


def repeated_passages(
    docs: DataFrame, min_words: int = MIN_WORDS, similarity: float = SIMILARITY
) -> DataFrame:
    """Passages of at least ``min_words`` words that are alike in an earlier document.

    ``DF[doc_id, start_word, end_word, source_id, source_start, source_end,
    similarity]``: words, split at ASCII white space and compared without upper
    case, and 1 less the edits by words of the longer side. ``source_id`` is
    smaller than ``doc_id``; a passage whose words are all in another of the same or a
    smaller source is left out. Copies have one passage, all their words. Rows without an id take no
    part, nor do null or empty texts; equal rows are one. Of an id with several texts
    each is a document, the smaller text the earlier one: only there ``source_id`` may
    be ``doc_id``. Of alignments that are equally long the most alike is taken. Texts of
    any length are read whole: a gap between equal runs is aligned on ``BAND`` diagonals
    beside its own, and counts as different words beyond. No rows give no rows; other
    columns are not read, whatever their names.
    """
    docs = docs.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    repeated = docs.groupBy("doc_id").count().where("count > 1").select("doc_id")
    if not repeated.isEmpty():
        return _of_repeated_ids(docs, written(repeated, "repeated-ids"), min_words, similarity)
    return _passages(docs, min_words, similarity)


def _of_repeated_ids(
    docs: DataFrame, repeated: DataFrame, min_words: int, similarity: float
) -> DataFrame:
    """Passages of documents whose ids, some of which are on several rows, are numbered anew."""
    some = docs.join(repeated, "doc_id").distinct()
    rows = docs.join(repeated, "doc_id", "left_anti").unionByName(some)
    by_id = number_sorted(rows, [], ["doc_id", "text"], "row")
    rows = written(by_id.select("doc_id", "text", F.col("row").cast("bigint")), "numbered")
    found = written(
        _passages(rows.select(F.col("row").alias("doc_id"), "text"), min_words, similarity), "found"
    )
    ids = rows.select("row", F.col("doc_id").alias("id"))
    for name in ("doc_id", "source_id"):
        found = found.withColumnRenamed(name, "row").join(ids, "row").drop("row")
        found = found.withColumnRenamed("id", name)
    return found.select([c.split()[0] for c in PASSAGES.split(", ")]).distinct()


def _passages(docs: DataFrame, min_words: int, similarity: float) -> DataFrame:
    found = written(
        seed_chains(docs).withColumns(
            {"place": F.col("places")[0], "other": F.col("others")[0]}
        ),
        "chains",
    )

    def ask(side: int, ident: str, places: str) -> DataFrame:
        return found.select(
            F.col(ident).alias("id"),
            F.greatest(F.lit(0), F.col(places)[0] - REACH).alias("low"),
            (F.element_at(places, -1) + F.element_at("sizes", -1) + REACH).alias("high"),
            F.lit(side).alias("side"),
            *_KEY,
        )

    words = written(
        _stretches(docs, ask(0, "doc_id", "places").union(ask(1, "source_id", "others"))), "words"
    )
    own = words.where("side = 0").select(*_KEY, F.col("low").alias("low_a"), F.col("words").alias("a"))
    source = words.where("side = 1").select(*_KEY, F.col("low").alias("low_b"), F.col("words").alias("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for at in range(0, batch.num_rows, 512):
                for r in batch.slice(at, 512).to_pylist():
                    low_a, low_b = r["low_a"], r["low_b"]
                    runs = [
                        (x - low_a, y - low_b, n)
                        for x, y, n in zip(r["places"], r["others"], r["sizes"])
                    ]
                    for s, e, t, f, alike in passages(
                        r["a"].split(), r["b"].split(), runs, min_words, similarity
                    ):
                        rows.append((r["doc_id"], s + low_a, e + low_a, r["source_id"],
                                     t + low_b, f + low_b, alike))
            columns = list(zip(*rows)) or [()] * 7
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                [c.split()[0] for c in PASSAGES.split(", ")],
            )

    judged = (
        found.join(own, _KEY).join(source, _KEY)
        .select("doc_id", "source_id", "places", "others", "sizes", "low_a", "a", "low_b", "b")
        .mapInArrow(run, PASSAGES)
    )
    return judged.groupBy("doc_id").agg(
        F.collect_set(F.struct(*judged.columns)).alias("passages")
    ).select("passages").mapInArrow(_uncovered, PASSAGES)
