"""Secret scans: patterns, and strings that nothing around them explains.

Three patterns find assignments, access keys and long hex strings. Beside them,
every long string that follows a sensitive word is compressed by zstandard with a
dictionary of common identifiers and the text around it. What still takes nearly
its own length, as a whole or in most pieces of 32 characters, is no identifier and
no word of its surroundings: it is reported as ``novel``, with all its copies.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketloom.llm.common import chunks, strings

# The patterns, and how many characters a match needs.
ASSIGN = re.compile(
    r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGNED_CHARS = 6
KINDS = ["assign", "access", "hex", "novel"]

# A word of ASSIGN is in a text only if one of these is in its lower case.
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

SENSITIVE = re.compile(
    r"(?ai:passw|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential"
    r"|private[_-]?key|bearer|signature)"
)
#: Characters of the shortest candidate.
SHORTEST = 16
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")

#: Characters after a sensitive word in which a candidate starts.
REACH = 64
#: Characters before and behind a candidate that prime the dictionary.
AROUND = 512
#: Marginal compressed bytes for a character, from which a candidate is novel.
NOVELTY = 0.85
#: Characters of a piece of a long candidate.
PIECE = 32

IDENTIFIERS = (
    "access account action address admin algorithm application argument array assert async "
    "attribute authentication authorization backend backup balance base64 binary boolean branch "
    "browser buffer builder bytes cache callback certificate channel character checksum class "
    "client cluster collection column command comment commit component config configuration "
    "connection const container content context controller convert counter create credential "
    "customer database dataframe dataset datetime debug decode default define delete deploy "
    "description destination development dictionary directory document domain download element "
    "email encode encryption endpoint engine environment error event example exception execute "
    "export expression extension factory false field filename filter float folder foreign format "
    "function generate get_ group handler hash header helper hostname identifier implements "
    "import index initialize input insert instance integer interface internal iterator java "
    "javascript json_ kernel key_ label language length library license list local location lock "
    "logger login long manager mapping master message metadata method migration model module "
    "monitor name_ namespace network node notification null_ number object offset operation "
    "option order output package parameter parent parser partition password path_ pattern "
    "payload permission pipeline platform plugin pointer port position prefix primary private "
    "process production profile project property protected protocol provider public python query "
    "queue random read_ record reference register release remote repository request resource "
    "response result return schema scope script search secret section select sequence server "
    "service session setting signature socket source spark_ static status storage stream string "
    "structure subject suffix system table target task template test_ text_ thread timeout "
    "timestamp token_ transaction transform true type_ undefined update upload user_ username "
    "utility validate value variable vector version view_ warning window worker write_ "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 ---- ==== ____ xxxxxxxx"
)


def assignments(text: str) -> Iterator[tuple[int, int]]:
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        for found in ASSIGN.finditer(text):
            if len(found[2]) >= ASSIGNED_CHARS:
                yield found.span()


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Matches of the three patterns as (start, end, kind), each kind leftmost and not overlapping."""
    spans = [(*s, "assign") for s in assignments(text)]
    if "AKIA" in text:
        spans += [(*m.span(), "access") for m in ACCESS.finditer(text)]
    spans += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return spans


def novelties(pieces: list[str], around: str) -> list[float]:
    """Compressed bytes a character that each piece takes beyond an empty text."""
    primer = zstandard.ZstdCompressionDict(
        (IDENTIFIERS + around).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT
    )
    press = zstandard.ZstdCompressor(
        level=19, dict_data=primer, write_checksum=False, write_content_size=False,
        write_dict_id=False,
    )
    empty = len(press.compress(b""))
    return [(len(press.compress(p.encode())) - empty) / len(p.encode()) for p in pieces]


def is_novel(candidate: str, around: str, threshold: float = NOVELTY) -> bool:
    """Whether the whole candidate, or most of its pieces, is novel.

    The coder comes near the entropy of a small alphabet only in long strings, so
    a long candidate is judged by pieces of one length.
    """
    last = max(0, len(candidate) - PIECE)
    pieces = [candidate[i : i + PIECE] for i in sorted({*range(0, last, PIECE), last})]
    whole, *parts = novelties([candidate, *pieces], around)
    return whole >= threshold or 2 * sum(p >= threshold for p in parts) > len(parts)


def _mixed(candidate: str) -> bool:
    kinds = (str.islower, str.isupper, str.isdigit)
    return sum(any(map(kind, candidate)) for kind in kinds) > 1


def _candidates(text: str) -> Iterator[tuple[int, int]]:
    """Long strings of mixed characters that start in reach of a sensitive word."""
    done = 0
    for word in SENSITIVE.finditer(text):
        at = max(word.end(), done)
        while (found := CANDIDATE.search(text, at, word.end() + REACH + 16)) is not None:
            found = CANDIDATE.match(text, found.start())
            at = done = found.end()
            if found.start() <= word.end() + REACH and _mixed(found[0]):
                yield found.span()


def _core(candidate: str) -> str:
    """A candidate without an assignment's sign before it."""
    core = candidate.lstrip("=")
    return core if len(core) >= SHORTEST else candidate


def _occurrences(text: str, cores: set[str]) -> dict[str, list[tuple[int, int]]]:
    """All places of the strings in a text, found by their first characters."""
    heads: dict[str, list[str]] = {}
    for core in cores:
        heads.setdefault(core[:SHORTEST], []).append(core)
    places: dict[str, list[tuple[int, int]]] = {core: [] for core in cores}
    for run in CANDIDATE.finditer(text):
        for i in range(run.start(), run.end() - SHORTEST + 1):
            for core in heads.get(text[i : i + SHORTEST], ()):
                if text.startswith(core, i):
                    places[core].append((i, i + len(core)))
    return places


def novel_spans(
    text: str, known: list[tuple[int, int, str]], threshold: float = NOVELTY
) -> list[tuple[int, int, str]]:
    """Incompressible strings after a sensitive word that no known span touches.

    Neither copies of a candidate nor other candidates and known spans explain it:
    they are blank in its surroundings. A novel string is reported wherever it stands.
    """
    spans = list(_candidates(text))
    if not spans:
        return []
    taken = np.zeros(len(text), bool)
    for s, e, _ in known:
        taken[s:e] = True
    places = _occurrences(text, {_core(text[s:e]) for s, e in spans})
    hidden = taken.copy()
    for s, e in [*spans, *(p for found in places.values() for p in found)]:
        hidden[s:e] = True
    letters = list(text)
    for i in np.flatnonzero(hidden).tolist():
        letters[i] = " "
    plain = "".join(letters)
    novel: set[str] = set()
    out: list[tuple[int, int, str]] = []

    def report(start: int, end: int) -> None:
        if not taken[start:end].any():
            taken[start:end] = True
            out.append((start, end, "novel"))

    for start, end in spans:
        if taken[start:end].any():
            continue
        around = plain[max(0, start - AROUND) : start] + plain[end : end + AROUND]
        core = _core(text[start:end])
        if core in novel or is_novel(text[start:end], around, threshold):
            novel.add(core)
            report(start, end)
    for core in sorted(novel, key=lambda c: (-len(c), c)):
        for start, end in places[core]:
            report(start, end)
    return sorted(out)


def joined(spans: list[tuple[int, int, str]]) -> str:
    """Spans as kind:start:end in their order, by start and then kind."""
    ordered = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in ordered)


SCHEMA = (
    "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_novel bigint,"
    " base_sha256 string, spans string"
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        rows = []
        for text in strings(batch):
            base = base_spans(text)
            novel = novel_spans(text, base)
            counts = [sum(s[2] == k for s in base) for k in KINDS[:3]]
            digest = hashlib.sha256(joined(base).encode()).hexdigest()
            rows.append((*counts, len(novel), digest, joined(base + novel)))
        kinds = [pa.int64()] * 4 + [pa.string()] * 2
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()),
             *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))],
            [c.split()[0] for c in SCHEMA.split(", ")],
        )


def secret_scan(docs: DataFrame) -> DataFrame:
    """Secrets of every whole text, one row per row of ``docs``.

    ``DF[doc_id, n_assign, n_access, n_hex, n_novel, base_sha256, spans]``; spans
    count code points, their end is exclusive. A null text has none; a null id
    stays null. Narrow: no shuffle. Other columns are not read.
    """
    return docs.select("doc_id", "text").mapInArrow(_scan, SCHEMA)


def redacted(text: str, mark: str = "[SECRET]") -> str:
    """A text with each of its secrets, overlapping ones together, replaced by ``mark``."""
    base = base_spans(text)
    spans = sorted((s, e) for s, e, _ in base + novel_spans(text, base))
    out, at = [], 0
    for start, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:] if out else text


def redact_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets replaced in ``text``, and ``n_chars``, if there, counted anew.

    All rows and other columns stay as they are; a null text stays null.
    """

    @F.pandas_udf("string")
    def hide(text):
        return text.map(redacted, na_action="ignore")

    out = docs.withColumn("text", hide("text"))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if (
        "n_chars" in docs.columns
    ) else out
