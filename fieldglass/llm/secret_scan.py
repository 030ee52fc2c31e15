"""Secret scans: a keyword automaton finds where to look, anchored patterns decide, checksums confirm.

An Aho-Corasick automaton over the kinds' fixed keywords passes once over the text. A pattern is tried only
where one of its keywords starts, so a text without keywords costs one automaton pass and the search for long
hexadecimal runs, which have no keyword. Tokens that embed a checksum (CRC-32 in base 62) or a readable
header (base64 JSON) must prove it. Everything happens inside a row: no shuffle, memory of one text.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import record_batch, row_slices

BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def crc_base62(random_part: str) -> str:
    """The six base-62 digits of the CRC-32 that such tokens carry at their end."""
    value, digits = binascii.crc32(random_part.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits


def _checksummed(match: re.Match) -> bool:
    body = match[1]
    return crc_base62(body[:-6]) == body[-6:]


def _json_header(match: re.Match) -> bool:
    head = match[1]
    try:
        return isinstance(json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4))), dict)
    except ValueError:
        return False


@dataclass(frozen=True)
class Kind:
    """One kind of secret. ``keywords`` are where the pattern may start; ``folded`` ones match in either case."""

    name: str
    keywords: tuple[str, ...]
    pattern: re.Pattern
    accept: Callable[[re.Match], bool]
    folded: bool = False


# The formats of the three base kinds and of tokens whose formats are published.
ASSIGN = Kind(
    "assign",
    ("password", "passwd", "secret", "token", "api_key", "apikey"),
    re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
    lambda m: len(m[2]) >= 8,
    folded=True,
)
ACCESS = Kind("access", ("AKIA",), re.compile(r"AKIA[A-Z0-9]+"), lambda m: m.end() - m.start() >= 16)
HEX_RUN = re.compile(r"[0-9a-f]{32,}")
OTHERS = (
    Kind("github", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), re.compile(r"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])"), _checksummed),
    Kind("npm", ("npm_",), re.compile(r"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])"), _checksummed),
    Kind("jwt", ("eyJ",), re.compile(r"(eyJ[A-Za-z0-9_-]+)\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"), _json_header),
    Kind("slack", ("xoxb-", "xoxa-", "xoxp-", "xoxr-", "xoxs-"), re.compile(r"xox[abprs]-[0-9]+-[A-Za-z0-9-]{10,}"), lambda m: True),
    Kind("stripe", ("sk_live_", "rk_live_"), re.compile(r"[sr]k_live_[A-Za-z0-9]{24,}"), lambda m: True),
    Kind("google", ("AIza",), re.compile(r"AIza[A-Za-z0-9_-]{35}(?![A-Za-z0-9_-])"), lambda m: True),
    Kind("private_key", ("-----BEGIN ",), re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*-----END [A-Z ]*PRIVATE KEY-----"), lambda m: True),
)
KINDS = (ASSIGN, ACCESS, *OTHERS)
#: Order of kinds for spans with the same start.
ORDER = ("assign", "access", "hex", *(k.name for k in OTHERS))
RANK = {name: i for i, name in enumerate(ORDER)}


@cache
def _automaton(folded: bool) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for at, kind in enumerate(KINDS):
        if kind.folded == folded:
            for word in kind.keywords:
                found.add_word(word, (at, len(word)))
    found.make_automaton()
    return found


def lower_same_length(text: str) -> str:
    """Lower case without moving positions; only letters A-Z need to be folded."""
    lowered = text.lower()
    return lowered if len(lowered) == len(text) else re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in code points, end exclusive, sorted by start and then by kind.

    Within a kind matches are leftmost and do not overlap; a match that fails its test still uses up its characters,
    as when all matches are taken first and the failing ones dropped.
    """
    starts: dict[int, list[int]] = {}
    for folded, searched in ((False, text), (True, lower_same_length(text))):
        for end, (at, length) in _automaton(folded).iter(searched):
            starts.setdefault(at, []).append(end - length + 1)
    spans = [("hex", m.start(), m.end()) for m in HEX_RUN.finditer(text)]
    for at, places in starts.items():
        kind, free = KINDS[at], 0
        for place in sorted(places):
            if place >= free and (match := kind.pattern.match(text, place)):
                free = match.end()
                if kind.accept(match):
                    spans.append((kind.name, match.start(), free))
    return sorted(spans, key=lambda s: (s[1], RANK[s[0]]))


def spans_text(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def mask_secrets(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each stretch of overlapping spans replaced by one mark that names the first kind."""
    parts, done, i = [], 0, 0
    while i < len(spans):
        kind, start, end = spans[i]
        while (i := i + 1) < len(spans) and spans[i][1] < end:
            end = max(end, spans[i][2])
        parts += [text[done:start], f"<{kind}>"]
        done = end
    return "".join(parts) + text[done:] if parts else text


SCAN = pa.schema([("id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string())])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: counts of the base kinds, the digest of their spans, and all spans.

    A null or empty text has no spans (digest of the empty string). Null and repeated ids are kept as they are,
    other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in row_slices(batches):
            out: list[list] = [ids, [], [], [], [], []]
            for text in texts:
                spans = find_secrets(text or "")
                base = [s for s in spans if s[0] in ("assign", "access", "hex")]
                for column, kind in zip(out[1:4], ("assign", "access", "hex")):
                    column.append(sum(s[0] == kind for s in base))
                out[4].append(hashlib.sha256(spans_text(base).encode()).hexdigest())
                out[5].append(spans_text(spans))
            yield record_batch(SCAN, out)

    picked = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    found = picked.mapInArrow(run, "id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    return found.withColumnRenamed("id", id_col)


def mask(docs: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` with all secrets in ``text_col`` masked; ``length_col``, if given, gets the new number of code points.

    Rows, row order within a partition, null texts and all other columns stay.
    """
    schema = docs.schema
    at = docs.columns.index(text_col)
    length_at = docs.columns.index(length_col) if length_col else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            masked = [t and mask_secrets(t, find_secrets(t)) for t in texts]
            columns = list(batch.columns)
            columns[at] = pa.array(masked, columns[at].type)
            if length_at is not None:
                kept = columns[length_at].to_pylist()
                changed = [n if a == b else len(b) for n, a, b in zip(kept, texts, masked)]
                columns[length_at] = pa.array(changed, columns[length_at].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, schema)
