"""Quality rules: a trained n-gram classifier over text statistics.

Base rules reject texts of very few words or of repeated passages. The others are
judged by a logistic regression on hashed word and character n-grams, trained on
labelled rows, calibrated on rows it was not trained on, and scored in Arrow
batches against a fixed threshold. A text is never cut.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketloom.llm.common import chunks, filtered, utf8, written

#: Most labelled rows the classifier is fitted on, chosen by a hash of their id.
MAX_LABELLED = 4000
ITERATIONS = 60
#: One of so many labelled rows calibrates and is not trained on.
CALIBRATION_FOLDS = 5
#: Texts with at least this probability of quality are kept.
THRESHOLD = 0.5
#: Partitions of the sample; a few, as it is bounded.
FIT_PARTITIONS = 4
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

BITS = 12
KINDS = 3  # words, word pairs, four-byte windows
DIMENSIONS = KINDS << BITS
SYMBOLS = b"#*$%&|<>"

_COUNTED = np.zeros((3, 256), bool)
_COUNTED[0, list(b" \t\n\x0b\x0c\r")] = True
_COUNTED[1, 0x80:0xC0] = True  # the later bytes of a character
_COUNTED[2, list(SYMBOLS)] = True

SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint,"
    " n_repeat_words bigint, base_failed boolean, kept boolean, probability double"
)


@dataclass(frozen=True)
class QualityModel:
    """Weights of the hashed n-grams, and the line that turns scores into probabilities."""

    weights: np.ndarray
    intercept: float
    slope: float = 1.0
    offset: float = 0.0

    def probability(self, score: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * score + self.offset, -500, 500))))


def word_ids(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Words as numbers within their text, and the hash of each number's word."""
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    return ids, np.fromiter(map(zlib.crc32, seen), np.uint32, len(seen))


def repeated_words(ids: np.ndarray) -> int:
    """Words inside a window of three words that occurs twice or more."""
    n = len(ids)
    if n < 4:
        return 0
    base = int(ids.max()) + 1
    pair = ids[:-2] * base + ids[1:-1]
    if base > 1 << 20:
        pair = np.unique(pair, return_inverse=True)[1]
    _, which, times = np.unique(pair * base + ids[2:], return_inverse=True, return_counts=True)
    again = times[which] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= again
    return int(covered.sum())


def repeated_lines(text: bytes) -> int:
    """Lines with a word that are equal to an earlier line."""
    return sum(n - 1 for n in Counter(x for x in text.split(b"\n") if x.strip()).values())


def vector(text: bytes, ids: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Roots of the shares of a text's hashed words, word pairs and four-byte windows.

    ``codes`` are hashes by word number. Each of the three parts has length one, so
    the length of a text does not show.
    """
    words = codes[ids]
    pairs = (words[:-1] * np.uint32(0x9E3779B1) + words[1:]) * np.uint32(0x85EBCA6B)
    n = max(0, len(text) - 3)
    windows = np.ndarray(n, "<u4", text, strides=(1,)) if n else np.zeros(0, np.uint32)
    out = np.zeros((KINDS, 1 << BITS))
    for kind, some in enumerate((words * np.uint32(0x9E3779B1), pairs, windows * np.uint32(2654435761))):
        if len(some):
            out[kind] = np.bincount(some >> (32 - BITS), minlength=1 << BITS)
            out[kind] /= len(some)
    return np.sqrt(out).ravel()


def featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse frequencies of a text's n-grams beside its label and fold."""
    for batch in chunks(batches):
        indices, values = [], []
        for text in utf8(batch):
            total = vector(text, *word_ids(text.split()))
            at = np.flatnonzero(total)
            indices.append(at.astype(np.int32))
            values.append(total[at])
        yield pa.RecordBatch.from_arrays(
            [batch.column("label"), batch.column("fold"), pa.array(indices, pa.list_(pa.int32())),
             pa.array(values, pa.list_(pa.float64()))],
            ["label", "fold", "indices", "values"],
        )


def fit_quality(
    docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED
) -> QualityModel | None:
    """Fit on labelled documents; None where the labels are not of two kinds.

    ``labels`` is ``DF[doc_id, quality]``; null labels and ids are left out. The
    ``max_labelled`` rows of smallest hash take part, so their number is bounded,
    and the same rows give the same sample however they are partitioned.
    """
    chosen = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .select("doc_id", F.col("quality").cast("double").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(max_labelled)
    )
    fold = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(CALIBRATION_FOLDS)).cast("int")
    # The chosen rows are few by their limit, so they are sent to the texts.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    sparse = rows.select("label", fold.alias("fold"), "text").mapInArrow(
        featurize, "label double, fold int, indices array<int>, values array<double>"
    )
    sparse = written(sparse, "quality-sample").coalesce(FIT_PARTITIONS)
    labels_in = {
        held: {r["label"] for r in sparse.where(where).select("label").distinct().collect()}
        for held, where in ((False, "fold > 0"), (True, "fold = 0"))
    }
    if len(labels_in[False]) < 2:
        return None
    to_vector = F.udf(lambda i, v: Vectors.sparse(DIMENSIONS, i, v), VectorUDT())
    train = written(
        sparse.where("fold > 0").select("label", to_vector("indices", "values").alias("features")),
        "quality-train",
    )
    fitted = LogisticRegression(
        maxIter=ITERATIONS, regParam=1e-5, standardization=False
    ).fit(train.coalesce(FIT_PARTITIONS))
    model = QualityModel(fitted.coefficients.toArray(), float(fitted.intercept))
    if len(labels_in[True]) < 2:
        return model
    weights, intercept = model.weights, model.intercept
    score = F.udf(
        lambda i, v: Vectors.dense(float(weights[i] @ np.array(v)) + intercept), VectorUDT()
    )
    scores = sparse.where("fold = 0").select(
        "label", score("indices", "values").alias("features")
    )
    line = LogisticRegression(maxIter=ITERATIONS, regParam=1e-3, standardization=False).fit(scores)
    return QualityModel(weights, intercept, float(line.coefficients[0]), float(line.intercept))


def judge(
    texts: list[bytes], model: QualityModel | None, threshold: float
) -> list[tuple[int, int, int, int, int, bool, bool, float | None]]:
    """Statistics and verdict of each text, in the order of ``SCHEMA``."""
    rows = []
    for text in texts:
        raw = np.frombuffer(text, np.uint8)
        spaces, later, symbols = (int(_COUNTED[k][raw].sum()) for k in range(3))
        ids, codes = word_ids(text.split())
        n, repeats = len(ids), repeated_words(ids)
        failed = n < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * n
        probability = None
        if model is not None:
            score = model.intercept + float(model.weights @ vector(text, ids, codes))
            probability = model.probability(score)
        kept = not failed and (probability is None or probability >= threshold)
        rows.append(
            (n, len(raw) - spaces - later, symbols, repeated_lines(text), repeats, failed,
             kept, probability)
        )
    return rows


def quality_rules(
    docs: DataFrame, model: QualityModel | None, threshold: float = THRESHOLD
) -> DataFrame:
    """Statistics and verdict of every document, one row per row of ``docs``.

    ``DF[doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, probability]``. Narrow: no shuffle. A null text has no
    words and fails; a null id stays null; repeated rows are judged alike. Without
    a model the base rules alone decide. Other columns of ``docs`` are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()]
        for batch in chunks(batches):
            rows = judge(utf8(batch), model, threshold)
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), *columns],
                [c.split()[0] for c in SCHEMA.split(", ")],
            )

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def keep_good(
    docs: DataFrame, model: QualityModel | None, threshold: float = THRESHOLD
) -> DataFrame:
    """The documents that :func:`quality_rules` keeps, with all their columns."""
    return filtered(docs, lambda batch: [r[6] for r in judge(utf8(batch), model, threshold)])
