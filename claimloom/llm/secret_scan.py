"""Secret scans: keyword prefilter, anchored patterns near hits, embedded checksums.

An Aho-Corasick automaton finds all keywords of all kinds in one pass over the text; a pattern is
only tried where a keyword of its kind begins. Kinds with an embedded checksum are reported when
it holds. Long hexadecimal runs have no keyword, so one linear pattern finds those.
"""

from __future__ import annotations

import hashlib
import re
import string
import zlib
from collections.abc import Iterable, Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.shared import small_batches

#: Kinds in the order in which spans of one start are listed; the first three are the base.
KINDS = ("assign", "access", "hex", "forge", "registry", "iban")
BASE = KINDS[:3]

# The keywords of each kind, lower case where either case counts.
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("AKIA",),
    "forge": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "registry": ("npm_",),
    "iban": ("iban",),
}
EITHER_CASE = {"assign", "iban"}

# What a kind looks like from its keyword on. Texts are UTF-8 bytes, one
# character each, so that case folding and classes are ASCII's.
PATTERNS = {
    "assign": re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.IGNORECASE | re.ASCII,
    ),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "forge": re.compile(r"gh[pousr]_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])"),
    "registry": re.compile(r"npm_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])"),
    "iban": re.compile(
        r"iban[\x20:=]{0,4}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})(?![A-Z0-9])",
        re.IGNORECASE | re.ASCII,
    ),
}
HEX = re.compile(r"[0-9a-f]{24,}")
#: Length of an account number by country.
ACCOUNT_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
        21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
        24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
        28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC",
        32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
BASE62 = string.digits + string.ascii_uppercase + string.ascii_lowercase


def crc32_holds(body: str, check: str) -> bool:
    """Forge and registry tokens end in the CRC-32 of their body, six digits in base 62."""
    value, digits = zlib.crc32(body.encode("latin-1")), ""
    while value:
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits.rjust(6, "0") == check


def mod97_holds(iban: str) -> bool:
    """International account numbers are 1 modulo 97, read from the fifth character on."""
    plain = iban.replace(" ", "").upper()
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def account_end(m: re.Match) -> int | None:
    """Where the account number ends whose checksum holds; words may follow it.

    The country says how long it is. Of an unknown country, or where that fails, the match as a
    whole counts, and of an unknown country then every end of a word, the last first.
    """
    found = m[1]
    ends = [at for at in range(1, len(found) + 1) if at == len(found) or found[at] == " "]
    plain = [at - found.count(" ", 0, at) for at in ends]
    length = ACCOUNT_LENGTHS.get(found[:2].upper())
    if length is None:
        tried = [end for end, n in zip(ends, plain) if n >= 15][::-1]
    else:
        tried = [end for end, n in zip(ends, plain) if n == length] + [len(found)]
    return next((m.start(1) + end for end in tried if mod97_holds(found[:end])), None)


HOLDS = {
    "assign": lambda m: len(m[2]) >= 6,
    "access": lambda m: len(m[0]) >= 20,
    "forge": lambda m: crc32_holds(m[1], m[2]),
    "registry": lambda m: crc32_holds(m[1], m[2]),
}


@cache
def _automaton(folded: bool) -> ahocorasick.Automaton:
    found: dict[str, list[str]] = {}
    for kind, words in KEYWORDS.items():
        if (kind in EITHER_CASE) == folded:
            for word in words:
                found.setdefault(word, []).append(kind)
    automaton = ahocorasick.Automaton()
    for word, kinds in found.items():
        automaton.add_word(word, (len(word), tuple(kinds)))
    automaton.make_automaton()
    return automaton


def _code_points(data: bytes, at: list[int]) -> dict[int, int]:
    """Byte offsets to code points, in one pass over the text."""
    out, last, points = {}, 0, 0
    for offset in sorted(set(at)):
        points += len(data[last:offset].decode(errors="replace"))
        out[offset], last = points, offset
    return out


def secret_spans(text: str | None) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in code points, by start and then kind.

    Per kind, matches are leftmost and do not overlap; one that fails its condition is dropped
    but still takes its place. An account number ends where its checksum holds; one that fails
    takes no place, as the words after it matched too. NULL counts as empty.
    """
    if not text:
        return []
    data = text.encode()
    line = data.decode("latin-1")
    hits: dict[str, list[int]] = {}
    for folded, source in ((True, data.lower().decode("latin-1")), (False, line)):
        for end, (length, kinds) in _automaton(folded).iter(source):
            for kind in kinds:
                hits.setdefault(kind, []).append(end - length + 1)
    spans = [("hex", m.start(), m.end()) for m in HEX.finditer(line)]
    for kind, starts in hits.items():
        pattern, free = PATTERNS[kind], 0
        for start in sorted(starts):
            if start >= free and (m := pattern.match(line, start)):
                if kind == "iban":
                    if (end := account_end(m)) is not None:
                        free = end
                        spans.append((kind, start, free))
                    continue
                free = m.end()
                if HOLDS[kind](m):
                    spans.append((kind, start, free))
    if len(data) != len(text):
        points = _code_points(data, [x for _, a, b in spans for x in (a, b)])
        spans = [(kind, points[a], points[b]) for kind, a, b in spans]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def masked(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """``text`` with its spans replaced by ``[kind]``; overlapping spans are one."""
    if not spans:
        return text
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


SPAN_COLUMNS = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id>, n_assign, n_access, n_hex, base_sha256, spans`` for every row.

    ``base_sha256`` digests the joined base spans (assign, access, hex), ``spans`` has all kinds.
    NULL and empty texts have no span. Identifiers may be NULL or repeat; rows are independent.
    Other columns are not read; an empty table gives no rows.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [secret_spans(t) for t in part.column(1).to_pylist()]
                base = [[s for s in spans if s[0] in BASE] for spans in found]
                counts = [
                    pa.array([sum(s[0] == kind for s in spans) for spans in base], pa.int64())
                    for kind in BASE
                ]
                digests = [hashlib.sha256(joined(spans).encode()).hexdigest() for spans in base]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), *counts, pa.array(digests, pa.string()),
                        pa.array([joined(s) for s in found], pa.string()),
                    ],
                    names=[id_col, "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
                )

    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, {SPAN_COLUMNS}")


def mask_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every secret in ``text_col`` replaced by its kind in brackets.

    All rows, columns and NULLs stay; texts without a secret are unchanged.
    """
    place = docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [masked(t, secret_spans(t)) for t in part.column(place).to_pylist()]
                yield part.set_column(
                    place, part.schema.field(place), pa.array(texts, part.schema.field(place).type)
                )

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)


def with_length(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``chars_col`` (where there is one) set to the length of the text as it is now."""
    if chars_col not in docs.columns:
        return docs
    length = F.length(text_col).cast(docs.schema[chars_col].dataType)
    return docs.withColumn(chars_col, F.when(F.col(text_col).isNull(), F.col(chars_col)).otherwise(length))
