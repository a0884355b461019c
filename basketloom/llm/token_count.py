"""Token counts of a byte-level BPE tokenizer without encoding most of the text.

Words are split off as the tokenizer does. Which strings of its vocabulary come out
as one token when they stand alone is proven once, before any text is read; such a
word counts one. Only the others are merged, each distinct one once as long as it
is remembered.
"""

from __future__ import annotations

import functools
import json
import os
import unicodedata
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from basketloom.llm.bpe import PIECE_CHARS, pieces
from basketloom.llm.common import chunks, strings

#: Tokens above which a document is over the limit.
MAX_TOKENS = 1024

#: Merged words a Python worker remembers, and their longest length.
REMEMBERED = 200_000
REMEMBERED_CHARS = 64

# Fixed by the byte-level format: its split of a text into words.
_WORD = regex.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)

#: Stands for a word with characters younger than the split's tables; a sum with it is negative.
_UNSURE = -(1 << 62)

SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"


def _byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable characters of Latin-1 stand for themselves, the others for those
    from 256 on, in their order.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in plain)
    shifted = {b: chr(256 + k) for k, b in enumerate(others)}
    return [shifted.get(b, chr(b)) for b in range(256)]


_CHARACTERS = _byte_characters()
_TO_BYTE = {c: b for b, c in enumerate(_CHARACTERS)}
FROM_LATIN = {b: c for b, c in enumerate(_CHARACTERS)}


def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _assigned(text: str) -> bool:
    """True if all characters are in the standard library's tables, older than the split's."""
    return text.isascii() or all(unicodedata.category(c) != "Cn" for c in text)


def added_tokens(path: str) -> list[str]:
    """Strings that the tokenizer takes out of a text as one token each.

    Raises ValueError for a tokenizer whose counts the shortcut does not give.
    """
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    split, model = parts["pre_tokenizer"] or {}, parts["model"]
    plain = (
        split.get("type") == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"]
        and model["type"] == "BPE" and not model.get("dropout") and not parts["normalizer"]
        and not parts["truncation"] and not parts["padding"]
        and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
        and not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in parts["added_tokens"])
    )
    if not plain:
        raise ValueError(f"{path} is no plain byte-level BPE tokenizer")
    return [t["content"] for t in parts["added_tokens"]]


def whole_tokens(path: str) -> list[str]:
    """Strings of the vocabulary that, alone, the tokenizer gives as their own one token.

    The proof is the encoding of every string: one id, the string's own, also says
    that the split leaves the string whole. Words are encoded apart from each other,
    so a word equal to such a string is one token in every text. Strings that are
    cut characters, or hold characters the split may not know, are left out.
    """
    tokenizer, added = _tokenizer(path), set(added_tokens(path))
    texts, ids = [], []
    for token, number in sorted(tokenizer.get_vocab().items()):
        raw = bytes(_TO_BYTE.get(c, 0) for c in token)
        text = raw.decode("utf-8", "ignore")
        if token not in added and text.encode() == raw and _assigned(text):
            texts.append(text)
            ids.append(number)
    alone = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    return [t for t, i, e in zip(texts, ids, alone) if e.ids == [i] and _WORD.findall(t) == [t]]


class WordTokens(dict):
    """Number of tokens by word: proven ones for good, merged ones as long as there is room."""

    def __init__(self, tokenizer, whole: list[str], remembered: int = REMEMBERED) -> None:
        super().__init__(dict.fromkeys(whole, 1))
        self.whole, self.remembered = len(self), remembered
        self.merge = tokenizer.model.tokenize

    def __missing__(self, word: str) -> int:
        if not _assigned(word):
            return _UNSURE
        n = len(self.merge(word.encode().decode("latin-1").translate(FROM_LATIN)))
        if len(word) <= REMEMBERED_CHARS:
            if len(self) >= self.whole + self.remembered:  # the older half goes
                for old in list(islice(self, self.whole, self.whole + self.remembered // 2 + 1)):
                    del self[old]
            self[word] = n
        return n


class TokenCounter:
    """Numbers of tokens of texts, as encoding them would give."""

    def __init__(self, path: str, whole: list[str], remembered: int = REMEMBERED) -> None:
        self.tokenizer = _tokenizer(path)
        self.words = WordTokens(self.tokenizer, whole, remembered)
        added = sorted(added_tokens(path), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added)) or r"(?!)")

    def count(self, text: str, size: int = PIECE_CHARS) -> int:
        """Tokens of ``text``; a long one is counted in pieces of about ``size`` characters."""
        parts = self.added.split(text)
        n = len(parts) - 1
        for part in parts:
            for piece in pieces(part, size):
                n += sum(map(self.words.__getitem__, _WORD.findall(piece)))
        if n < 0:
            n = len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return n


@functools.lru_cache(maxsize=2)
def _counter(path: str, whole: tuple[str, ...]) -> TokenCounter:
    """One counter per Python worker, which keeps its words from task to task."""
    return TokenCounter(path, list(whole))


def token_counts(docs: DataFrame, path: str, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """``DF[doc_id, n_bytes, n_tokens, over_limit]``: one row per row, whole texts, no shuffle.

    ``path`` is a tokenizer file (.json) that driver and executors can read. Begin,
    end and padding tokens are not added; the tokenizer's added strings inside a
    text count as the tokenizer handles them by default, one token each. The proven
    strings go to all tasks once: they are bounded by the vocabulary. A null text
    counts as empty (0 bytes, 0 tokens), repeated rows give repeated rows, a null id
    stays null, an empty table gives no rows, other columns are not read. A text
    exactly at ``max_tokens`` is not over the limit. A very long text is split piece
    by piece; one with characters newer than the tables of the split is encoded whole.
    """
    proven = docs.sparkSession.sparkContext.broadcast(tuple(whole_tokens(path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path, proven.value)
        for batch in chunks(batches):
            counts = [counter.count(t) for t in strings(batch)]
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), sizes.cast(pa.int64()),
                 pa.array(counts, pa.int64()),
                 pa.array([n > max_tokens for n in counts], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
