"""License scans: a trained classifier of windows of words, confirmed by templates.

Lines, and paragraphs of several lines, are read in overlapping windows of words. A multinomial
logistic regression on sparse word n-grams names the licence family of a window;
its class ``unknown`` is trained on lines of the corpus, and the probability of
being any licence is calibrated on windows held out. All families are reported of which
such a window also holds most of a template.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketloom.llm.common import chunks, utf8

# Usual notices of licence families, in lower case without punctuation.
TEMPLATES = {
    "Apache-2.0": [
        "licensed under the apache license version 2.0",
        "licensed under the apache license version 2.0 the license you may not use this file "
        "except in compliance with the license you may obtain a copy of the license at",
        "unless required by applicable law or agreed to in writing software distributed under "
        "the license is distributed on an as is basis without warranties or conditions of any kind",
    ],
    "MIT": [
        "released under the mit license",
        "licensed under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files the software to deal in the software "
        "without restriction",
    ],
    "GPL-3.0": [
        "this work is licensed under the gnu general public license version 3",
        "gnu general public license as published by the free software foundation either version "
        "3 of the license or at your option any later version",
    ],
    "GPL-2.0": [
        "licensed under the gnu general public license version 2",
        "gnu general public license as published by the free software foundation either version "
        "2 of the license or at your option any later version",
    ],
    "LGPL": [
        "licensed under the gnu lesser general public license",
        "gnu lesser general public license as published by the free software foundation",
    ],
    "AGPL": [
        "licensed under the gnu affero general public license",
        "gnu affero general public license as published by the free software foundation",
    ],
    "BSD": [
        "licensed under the bsd license",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
    ],
    "MPL-2.0": [
        "this source code form is subject to the terms of the mozilla public license v 2.0",
        "licensed under the mozilla public license version 2.0",
    ],
    "CC-BY-NC": [
        "licensed under cc by nc 4.0",
        "licensed under a creative commons attribution noncommercial 4.0 international license",
    ],
    "CC-BY-SA": [
        "licensed under cc by sa 4.0",
        "licensed under a creative commons attribution sharealike 4.0 international license",
    ],
    "CC-BY": [
        "licensed under cc by 4.0",
        "licensed under a creative commons attribution 4.0 international license",
    ],
    "CC0": [
        "released under cc0 1.0 universal",
        "to the extent possible under law the author has waived all copyright and related rights "
        "to this work",
    ],
    "Unlicense": [
        "this is free and unencumbered software released into the public domain",
        "dedicated to the public domain",
    ],
    "ISC": [
        "permission to use copy modify and or distribute this software for any purpose with or "
        "without fee is hereby granted",
    ],
    "Proprietary": [
        "all rights reserved",
        "unauthorized copying of this file via any medium is strictly prohibited",
        "this document is confidential and proprietary",
    ],
}
FAMILIES = ["unknown", *TEMPLATES]

#: Words of half a window; a window is two halves, the next starts one half later.
HALF = 24
BITS = 13
DIMENSIONS = 1 << BITS
SCALE = 1.5
#: Most documents whose lines train the unknown class, chosen by a hash of id and text.
MAX_UNKNOWN_DOCS = 300
MAX_UNKNOWN_WINDOWS = 3000
VARIANTS = 30
FIT_PARTITIONS = 4
#: Calibrated probability of a licence, and share of a template's word pairs, to report.
THRESHOLD = 0.5
SIMILARITY = 0.7
SEED = 42

SCHEMA = (
    "doc_id bigint, paragraph int, word int, family string, probability double, similarity double"
)

_STRIP = b".,;:!?()[]{}<>\"'`*#-_/|"


@dataclass(frozen=True)
class LicenseModel:
    """Weights by bucket and family, and the line that calibrates the odds of a licence."""

    weights: np.ndarray
    intercepts: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def licence(self, scores: np.ndarray) -> np.ndarray:
        """Calibrated probability that a window is any licence."""
        top = scores[:, 1:].max(axis=1, keepdims=True)
        known = np.log(np.exp(scores[:, 1:] - top).sum(axis=1)) + top[:, 0]
        odds = self.slope * (known - scores[:, 0]) + self.offset
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def tokens(line: bytes) -> list[bytes]:
    """Words of a line in lower case, hyphens and slashes between them as blanks."""
    words = line.lower().replace(b"-", b" ").replace(b"/", b" ").split()
    return [w for w in (x.strip(_STRIP) for x in words) if w]


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return (first * np.uint32(0x9E3779B1) + second) * np.uint32(0x85EBCA6B) >> np.uint32(32 - BITS)


def vector(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sparse counts of the words and word pairs of one window, over the root of its length."""
    codes = np.array([zlib.crc32(w) for w in words], np.uint32)
    total = np.bincount(codes & (DIMENSIONS - 1), minlength=DIMENSIONS) * (SCALE / len(codes) ** 0.5)
    if len(codes) > 1:
        total += np.bincount(_pair(codes[:-1], codes[1:]), minlength=DIMENSIONS) * (
            SCALE / len(codes) ** 0.5
        )
    at = np.flatnonzero(total)
    return at, total[at]


def similarity(words: list[bytes], template: list[bytes]) -> float:
    """Share of a template's word pairs that are in a window."""
    wanted = set(zip(template, template[1:])) or {(template[0],)}
    return len(wanted & set(zip(words, words[1:]))) / len(wanted)


def _variants(rng: random.Random) -> Iterator[tuple[int, list[bytes]]]:
    """Windows of each family: templates with words lost, and others before and behind."""
    other = [w for texts in TEMPLATES.values() for t in texts for w in t.encode().split()]
    for label, (_, templates) in enumerate(TEMPLATES.items(), 1):
        for text in templates:
            words = text.encode().split()
            for i in range(VARIANTS):
                kept = [w for w in words if i < 5 or rng.random() > 0.05] or words
                cut = kept[: 2 * HALF]
                room = 2 * HALF - len(cut)
                extra = [rng.choice(other) + b"x" for _ in range(rng.randrange(room + 1) if i % 3 else 0)]
                at = rng.randrange(len(extra) + 1)
                yield label, extra[:at] + cut + extra[at:]


def halves(line: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """The windows of a line and the number of their first words."""
    words = tokens(line)
    for at in range(0, max(1, len(words) - HALF), HALF):
        if words:
            yield at, words[at : at + 2 * HALF]


def fit_licenses(docs: DataFrame) -> LicenseModel:
    """Fit on variants of the templates and on windows of a bounded number of documents.

    The ``MAX_UNKNOWN_DOCS`` documents of smallest hash of id and text give at most
    ``MAX_UNKNOWN_WINDOWS`` windows of class unknown; windows that hold half of a
    template do not. Every fifth window of a class calibrates instead of training.
    """
    spark = docs.sparkSession
    templates = [[t.encode().split() for t in texts] for texts in TEMPLATES.values()]

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            rows = []
            for text in utf8(batch):
                for line in text.split(b"\n"):
                    for _, words in halves(line):
                        if all(similarity(words, t) < 0.5 for ts in templates for t in ts):
                            rows.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["words"])

    # All but a few tasks' rows stay where they are: only hashes under a bound, about four
    # times as many as wanted, are sorted.
    share = min(1.0, 4 * MAX_UNKNOWN_DOCS / max(1, docs.count()))
    chosen = (
        docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("code"))
        .where("text IS NOT NULL").where(F.col("code") <= int(share * (1 << 63)) * 2 - (1 << 63) - 1)
        .orderBy("code", "doc_id", "text").limit(MAX_UNKNOWN_DOCS)
    )
    lines = chosen.mapInArrow(sample, "words binary")
    lines = lines.distinct().orderBy(F.xxhash64("words"), "words").limit(MAX_UNKNOWN_WINDOWS)
    known = list(_variants(random.Random(SEED)))
    labelled = [(0, bytes(r[0]).split()) for r in lines.collect()] + known
    rows = []
    for i, (label, words) in enumerate(labelled):
        at, values = vector(words)
        rows.append((float(label), i % 5 == 0, Vectors.sparse(DIMENSIONS, at, values)))
    examples = spark.createDataFrame(rows, ["label", "held", "features"]).coalesce(FIT_PARTITIONS)
    fitted = LogisticRegression(
        family="multinomial", maxIter=40, regParam=1e-4, standardization=False
    ).fit(examples.where("NOT held"))
    classes = fitted.coefficientMatrix.numRows
    weights = np.zeros((DIMENSIONS, len(FAMILIES)), np.float32)
    weights[:, :classes] = fitted.coefficientMatrix.toArray().T
    intercepts = np.zeros(len(FAMILIES))
    intercepts[:classes] = fitted.interceptVector.toArray()
    model = LicenseModel(weights, intercepts)
    odds = []
    for label, held, features in rows:
        if held:
            p = model.licence((features.values @ weights[features.indices] + intercepts)[None])[0]
            p = min(max(p, 1e-9), 1 - 1e-9)
            odds.append((float(label > 0), Vectors.dense(float(np.log(p / (1 - p))))))
    if len({label for label, _ in odds}) < 2:
        return model
    line = LogisticRegression(maxIter=60, regParam=1e-3, standardization=False).fit(
        spark.createDataFrame(odds, ["label", "features"])
    )
    return LicenseModel(weights, intercepts, float(line.coefficients[0]), float(line.intercept))


_PAIRS = {
    family: [list(dict.fromkeys(zip(w, w[1:]))) for w in (t.encode().split() for t in texts)]
    for family, texts in TEMPLATES.items()
}


def confirmed(words: list[bytes]) -> list[tuple[str, float, int, int]]:
    """(family, similarity, first word, last word) of the families a window holds, best first.

    A family whose template is like that of a better one must also hold most of the
    pairs that are not in the better one's: a GPL notice is no LGPL notice.
    """
    at: dict[tuple[bytes, bytes], int] = {}
    for i, pair in enumerate(zip(words, words[1:])):
        at.setdefault(pair, i)
    found = []
    for family, templates in _PAIRS.items():
        for template in templates:
            held = [p for p in template if p in at]
            if len(held) >= SIMILARITY * len(template):
                found.append((len(held) / len(template), len(template), family, template, held))
    found.sort(key=lambda f: (-f[0], -f[1], f[2]))
    out: list[tuple[str, float, int, int]] = []
    better: list[tuple[str, set]] = []
    for alike, _, family, template, held in found:
        own = [[p for p in template if p not in known] for f, known in better if f != family]
        if all(o and sum(p in at for p in o) >= SIMILARITY * len(o) for o in own):
            if all(f != family for f, _ in better):
                out.append((family, alike, at[held[0]], at[held[-1]] + 1))
            better.append((family, set(template)))
    return out


def classify(texts: list[bytes], model: LicenseModel, threshold: float) -> list[tuple]:
    """(text, line, word, family, probability, similarity) of confirmed windows.

    Windows are those of each line, and those of each paragraph of several lines,
    up to one without words. A notice over several lines counts for its first line;
    it is left out if one of its lines holds the family by itself.
    """
    seen: dict[bytes, int] = {}
    ids: list[int] = []
    starts, owners = [], []  # of halves of lines: first word, and (text, line, half)
    wide_starts, wide_owners = [], []  # of halves of paragraphs
    lines: list[tuple[int, int]] = []  # first word and number of each line with words
    for number, text in enumerate(texts):
        block: list[int] = []  # first words of the lines of a paragraph
        for paragraph, line in enumerate([*text.split(b"\n"), b""]):
            words = tokens(line)
            if words:
                block.append(len(ids))
                lines.append((len(ids), paragraph))
            else:
                if len(block) > 1:
                    for half, at in enumerate(range(block[0], len(ids), HALF)):
                        wide_starts.append(at)
                        wide_owners.append((number, len(lines), half))
                block = []
            for half, at in enumerate(range(0, len(words), HALF)):
                starts.append(len(ids) + at)
                owners.append((number, paragraph, half))
            ids += [seen.setdefault(w, len(seen)) for w in words]
    if not ids:
        return []
    names = list(seen)
    codes = np.array([zlib.crc32(w) for w in names], np.uint32)
    flat = np.array(ids)
    by_word = codes[flat]
    singles = model.weights[by_word & (DIMENSIONS - 1)]
    leads = np.zeros((len(flat), len(FAMILIES)), np.float32)
    leads[1:] = model.weights[_pair(by_word[:-1], by_word[1:])]
    both_sums = singles + leads

    def likely(first: np.ndarray, ends: np.ndarray, own: np.ndarray) -> Iterator[tuple]:
        """(owner, first word, words, probability) of the windows that are likely a licence."""
        sizes = ends - first
        # Word pairs inside a half, and the one that leads to the next half.
        bounds = np.column_stack([first, ends]).ravel()
        sums = np.add.reduceat(
            np.concatenate([both_sums, np.zeros((1, len(FAMILIES)), np.float32)]), bounds, axis=0
        )[::2] - leads[first]
        follows = np.zeros(len(first), bool)
        follows[1:] = (own[1:, :2] == own[:-1, :2]).all(axis=1)
        # A window begins at each half that has a next one, or is alone in its line.
        nexts = np.append(follows[1:], False)
        begin = np.flatnonzero(nexts | ~follows)
        after = np.minimum(begin + 1, len(first) - 1)
        both = nexts[begin]
        total = sums[begin] + np.where(both[:, None], sums[after] + leads[first[after]], 0)
        count = sizes[begin] + np.where(both, sizes[after], 0)
        scores = total * (SCALE / np.sqrt(count))[:, None] + model.intercepts
        probability = model.licence(scores)
        for i in np.flatnonzero(probability >= threshold):
            yield own[begin[i]], int(first[begin[i]]), int(count[i]), float(probability[i])

    def window(start: int, count: int) -> list[bytes]:
        return [names[w] for w in flat[start : start + count]]

    out = []
    taken: dict[str, list[tuple[int, int]]] = {}  # words of what is reported, by family
    first = np.array(starts)
    for (number, paragraph, half), start, count, p in likely(
        first, np.append(first[1:], len(flat)), np.array(owners)
    ):
        for family, alike, low, high in confirmed(window(start, count)):
            out.append((int(number), int(paragraph), int(half) * HALF, family, p, alike))
            taken.setdefault(family, []).append((start + low, start + high))
    if not wide_starts:
        return out
    first, own = np.array(wide_starts), np.array(wide_owners)
    line_first = np.array([f for f, _ in lines])
    # A half ends at the next one, the last of a paragraph where its last line does.
    ends = np.append(line_first, len(flat))[own[:, 1]]
    same = (own[1:, :2] == own[:-1, :2]).all(axis=1)
    ends[:-1] = np.where(same, first[1:], ends[:-1])
    wide = []
    for (number, _, _), start, count, p in likely(first, ends, own):
        for family, alike, low, high in confirmed(window(start, count)):
            wide.append((alike, p, -start - low, start + high, int(number), family))
    for alike, p, low, high, number, family in sorted(wide, reverse=True):
        spans = taken.setdefault(family, [])
        if any(a <= high and -low <= b for a, b in spans):
            continue
        spans.append((-low, high))
        at = int(np.searchsorted(line_first, -low, "right")) - 1
        out.append((number, lines[at][1], -low - lines[at][0], family, p, alike))
    return out


def license_scan(docs: DataFrame, model: LicenseModel, threshold: float = THRESHOLD) -> DataFrame:
    """Licences named in documents: ``DF[doc_id, paragraph, word, family, probability, similarity]``.

    One row per family and line, the best of the line's windows: the number of the
    line, the first word of the window, or of the notice if it goes over several
    lines, the calibrated probability and the share of a template found. Narrow: no shuffle. Null and empty texts have no rows, a
    null id stays null, repeated rows are reported each. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, limit=1 << 20):
            ids = batch.column("doc_id").to_pylist()
            best: dict[tuple, tuple] = {}
            for number, paragraph, word, family, p, alike in classify(utf8(batch), model, threshold):
                key = (number, paragraph, family)
                if key not in best or (p, alike) > best[key][1:]:
                    best[key] = (word, p, alike)
            rows = [(ids[n], par, w, f, p, s) for (n, par, f), (w, p, s) in best.items()]
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.float64()]
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                [c.split()[0] for c in SCHEMA.split(", ")],
            )

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
