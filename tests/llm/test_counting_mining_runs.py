"""Token counts, hard negatives and periodic runs against plain Python and the libraries."""

from __future__ import annotations

import hashlib
import math
import random
import unicodedata
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from basketloom.llm import hard_negatives, periodic_runs, token_count
from basketloom.llm.lce import COVER, PERIOD
from basketloom.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
DOC = "doc_id bigint, text string, n_tokens string, start int, period binary"
LONG = " ".join(f"word{i % 997}x{i % 13}" for i in range(30_000))
EDGES = [
    (1, None), (2, ""), (3, " \n\t "), (None, "a text without id"), (4, LONG),
    (5, "same words here " * 9), (5, "same words here " * 9), (6, "ÀÉ   x　y \x1c\x85 z's DON'T 12,5. " * 30),
    (7, "x" * 70_000), (8, "a <|endoftext|> b<|endoftext|><|endoftext|>  "), (9, " " * 70_000 + "a\r\n\r\n b"),
    (10, "\U000323b0 ՘a \U0001f600"), (11, "'s 're ''s I'LL <|endoftext"),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1, b"") for i, t in rows], DOC)


def by_id(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is None, v) for v in r))


# Token counts


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(TOKENIZER)


def test_token_counts_equal_the_library(spark, tokenizer):
    corpus = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    for rows in (EDGES, corpus):
        found = token_count.token_counts(frame(spark, rows), TOKENIZER)
        assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
        expected = []
        for i, text in rows:
            n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
            expected.append((i, len((text or "").encode()), n, n > 1024))
        assert by_id(found.collect()) == by_id(expected)


def test_token_limit_is_not_over_at_the_limit(spark):
    rows = [(n, "\n".join(["a"] * n)) for n in (2, 3)]  # 2 n - 1 tokens
    found = token_count.token_counts(frame(spark, rows), TOKENIZER, max_tokens=3).collect()
    assert [(r.n_tokens, r.over_limit) for r in found] == [(3, False), (5, True)]


def test_token_counts_of_nothing(spark):
    assert token_count.token_counts(frame(spark, []), TOKENIZER).collect() == []


def test_whole_tokens_are_proven(tokenizer):
    whole = token_count.whole_tokens(TOKENIZER)
    assert len(set(whole)) == len(whole) > 45_000
    assert "<|endoftext|>" not in whole
    assert all(len(tokenizer.encode(w).ids) == 1 for w in whole[::97])


def test_words_are_split_as_the_library_does(tokenizer):
    """Every character the standard library knows, beside a letter, a digit and a mark."""
    known = [
        c for c in map(chr, range(0x110000)) if unicodedata.category(c) not in ("Cn", "Co", "Cs")
    ]
    for at in range(0, len(known), 5000):
        text = "\n".join(f"a{c}a 1{c}1 !{c}!" for c in known[at : at + 5000])
        split = tokenizer.pre_tokenizer.pre_tokenize_str(text)
        assert [text[a:b] for _, (a, b) in split] == regex.findall(public_tokenizers.PATTERN, text)


def test_pieces_and_forgotten_words_do_not_change_counts(tokenizer):
    rng = random.Random(3)
    counter = token_count.TokenCounter(TOKENIZER, token_count.whole_tokens(TOKENIZER), remembered=10)
    alphabet = ["a", "bc", "'s", " ", "  ", "\n", "é", "12", "<|endoftext|>", "!?", "zq", "՘"]
    for _ in range(300):
        text = "".join(rng.choices(alphabet, k=rng.randrange(60)))
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert counter.count(text) == counter.count(text, 5) == n
    assert len(counter.words) <= counter.words.whole + 10


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        token_count.added_tokens(public_tokenizers.path("word_bpe_49k.json"))


# Hard negatives

VECTOR = "vec_id bigint, embedding array<double>, label int, rank string, parts int, item string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, "clash", 1, "") for i, v, label in rows], VECTOR)


def mined(rows, is_anchor, positives=5, negatives=3, low=50, high=95):
    """The contract, row by row."""
    items = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        item = (label, [math.floor(256 * x) for x in v])
        items[i] = min(items.get(i, item), item)
    out = []
    for a, (label, v) in items.items():
        if not is_anchor(a):
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(v, w)), b, other) for b, (other, w) in items.items() if b != a
        )
        for ps, p, _ in [s for s in scored if s[2] == label][:positives]:
            near = [
                (-ns, b) for ns, b, other in scored
                if other != label and low * -ps <= 100 * -ns <= high * -ps
            ]
            out += [(a, p, k + 1, b, -ps, ns) for k, (ns, b) in enumerate(near[:negatives])]
    return out


def made_vectors(n, seed, dims=6, copies=0):
    rng = random.Random(seed)
    one = [rng.uniform(-1, 1) for _ in range(dims)]
    rows = [(i, [rng.uniform(-1, 1) for _ in range(dims)], rng.randrange(3)) for i in range(n)]
    rows += [(n + i, one, rng.randrange(2)) for i in range(copies)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [4096, 50])
def test_hard_negatives_equal_brute_force(spark, block):
    rows = made_vectors(90, 1, copies=60)
    rows += [rows[0], rows[0], (rows[1][0], rows[2][1], 2), (10, [0.0] * 6, 1), (20, [], 1), (30, [0.5], 0)]
    rows += [(200, None, 1), (201, [0.1, None], 1), (202, [float("nan")], 1), (203, [float("inf")], 0),
             (None, [0.3] * 6, 1), (204, [0.2] * 6, None), (-10, [1e-9] * 6, 1)]
    found = hard_negatives.hard_negatives(vectors(spark, rows), F.col("vec_id") % 10 == 0, block=block)
    expected = mined(rows, lambda i: i % 10 == 0)
    assert len(expected) > 50
    assert by_id(found.collect()) == by_id(expected)


def test_hard_negatives_of_nothing(spark):
    anchors = F.col("vec_id") % 10 == 0
    for rows in ([], [(10, None, 1)], [(10, [1.0], 1)], [(10, [1.0], 1), (11, [1.0], 2)], [(11, [1.0], 1)]):
        assert hard_negatives.hard_negatives(vectors(spark, rows), anchors).collect() == []


def test_products_are_exact():
    rng = np.random.default_rng(5)
    for most, dims in ((1, 3), (150, 64), (1 << 20, 8), (1 << 24, 64), (1 << 30, 4)):
        a, c = (rng.integers(-most, most + 1, (n, dims)) for n in (9, 31))
        products = hard_negatives.Products(a, c)
        assert products.doubles == (most <= 1 << 20)
        exact = [[sum(int(x) * int(y) for x, y in zip(v, w)) for w in c] for v in a]
        assert products.scores(slice(0, 9)).tolist() == exact
    assert hard_negatives.Products(np.full((1, 64), 100), np.full((50, 64), 90)).fields > 1
    near = np.array([[150] * 64, [-150] * 64])
    small = hard_negatives.Products(near, np.repeat(near, 5, axis=0))
    assert small.fields == 2
    assert small.scores(slice(0, 2)).tolist() == (near @ np.repeat(near, 5, axis=0).T).tolist()


def test_best_keeps_the_smaller_column_of_equal_scores():
    none = hard_negatives._NONE
    scores = np.array([[5, 7, 7, 7, 1], [none, 2, none, none, none], [none] * 5])
    row, column = hard_negatives.best(scores, 2)
    assert (row.tolist(), column.tolist()) == ([0, 0, 1], [1, 2, 1])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_sql(spark, name):
    found = QUERIES[name](spark, SF)
    with duckdb.connect() as db:
        for table in ("documents", "pages", "embeddings"):
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
        rows = db.execute(ORACLES[name]).fetchall()
        names = [d[0] for d in db.description]
    assert found.columns == names
    assert rows and by_id(found.collect()) == by_id(rows)


# Periodic runs


def brute_runs(words, least=12):
    """All runs by comparing every place with every later one: start, length, period."""
    found = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(least, 2 * p):
                found.setdefault((i, j - i + p), p)
            i = j + 1
    return sorted((s, n, p) for (s, n), p in found.items())


def brute_row(doc_id, text, planted):
    words = [w.encode() for w in regex.findall(r"[^\x20\x09-\x0D]+", text or "")]
    n = len(words)
    if planted and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = sorted(brute_runs(words), key=lambda r: (r[0], r[2]))
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    dropped = {i for s, length, p in runs for i in range(s + p, s + length)}
    lines = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    longest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *longest, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(kept).hexdigest())


def test_cover_meets_every_distance():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))


@pytest.mark.parametrize("seed", range(3))
def test_runs_equal_brute_force(seed, monkeypatch):
    monkeypatch.setattr(periodic_runs, "PAIRS", 50 if seed else 1 << 20)
    rng = random.Random(seed)
    texts = []
    for _ in range(400):
        n, kinds = rng.choice([0, 1, 11, 12, 13, 30, 80, 250]), rng.choice([1, 2, 3, 30])
        words = [b"%d" % rng.randrange(kinds) for _ in range(n)]
        if rng.random() < 0.5 and n > 12:
            a = rng.randrange(n)
            p = rng.randrange(1, max(2, (n - a) // 2))
            words = words[:a] + [words[a + i % p] for i in range(n - a)]
        texts.append(words)
    for least in (12, 2):
        text, start, length, period = periodic_runs.find_runs(texts, least)
        for k, words in enumerate(texts):
            some = text == k
            found = zip(start[some].tolist(), length[some].tolist(), period[some].tolist())
            assert sorted(found) == brute_runs(words, least)


def test_run_digests_equal_brute_force(spark):
    corpus = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    short = [(i, t) for i, t in EDGES if i != 4]
    # two runs of one length, and nested ones
    ties = [(20, "a b " * 8 + "x y z " + "c d " * 8), (21, ("a a a a a a a a a a a a b " * 3))]
    for rows in (short + ties, corpus):
        found = periodic_runs.run_digests(frame(spark, rows), planted=True)
        assert by_id(found.collect()) == by_id(brute_row(i, t, True) for i, t in rows)
    found = {r.doc_id: r for r in periodic_runs.run_digests(frame(spark, EDGES + ties)).collect()}
    assert (found[4].n_runs, found[4].period, found[4].length) == (1, 12961, 30_000)
    assert (found[20].n_runs, found[20].start) == (2, 0)
    assert periodic_runs.run_digests(frame(spark, [])).collect() == []


def test_collapse_keeps_other_columns(spark):
    rows = [(1, None), (2, "a  b\n" * 10 + "end"), (3, "as it   is"), (4, "")]
    found = periodic_runs.collapse_runs(frame(spark, rows))
    assert found.columns == ["doc_id", "text", "n_tokens", "start", "period"]
    assert [r.text for r in found.orderBy("doc_id").collect()] == [None, "a b end", "as it   is", ""]
    assert found.where("n_tokens = 'clash' AND start = 1").count() == 4
