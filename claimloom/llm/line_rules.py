"""Quality rules: cross-document line frequency, with document statistics.

Lines are normalised and hashed, distinct documents are counted per host and line, and lines in
more documents than the limit are removed. A document that loses most of its words is rejected.
Documents are distinct when their normalised lines differ: copies, and copies that differ in case
or white space only, count once. The rule is a count alone, so it depends on no order and no
partitioning; edited copies are documents of their own.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.shared import saved, small_batches

SYMBOLS = re.compile(r"[#*$%&|<>]")
SPACES = str.maketrans("", "", "\x20\x09\x0a\x0b\x0c\x0d")
MIN_WORDS = 50
REPEATED_PERCENT = 50
#: A line is common at a host in more distinct documents than this, however large the host.
LINE_DOCS = 10
#: A document is depleted when less than this share of its words is left.
KEPT_PERCENT = 30
#: Hexadecimal digits of a line's MD5.
DIGITS = 16


def normalised(line: str) -> str:
    """Words joined by one space, A-Z in lower case; empty without a word."""
    return b" ".join(line.encode().lower().split()).decode()


def line_key(line: str) -> str:
    return hashlib.md5(normalised(line).encode()).hexdigest()[:DIGITS]


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    marked = total = 0  # marked: where the last repeated window ended
    for at, window in enumerate(windows):
        if seen[window] > 1:
            total += at + 3 - max(at, marked)
            marked = at + 3
    return total


def statistics(text: str | None) -> tuple[dict, str, dict[str, int]]:
    """The counts of one text, the key of its normalised lines, and words by line key."""
    text = text or ""
    words = text.encode().split()
    lines: dict[str, int] = {}
    plain: list[bytes] = []
    seen: set[str] = set()
    duplicates = 0
    for line in text.split("\n"):
        found = line.encode().lower().split()
        if found:
            duplicates += line in seen
            seen.add(line)
            plain.append(b" ".join(found))
            key = hashlib.md5(plain[-1]).hexdigest()[:DIGITS]
            lines[key] = lines.get(key, 0) + len(found)
    counts = {
        "n_words": len(words),
        "word_chars": len(text.translate(SPACES)),
        "n_symbols": len(SYMBOLS.findall(text)),
        "n_dup_lines": duplicates,
        "n_repeat_words": repeated_words(words),
    }
    return counts, hashlib.md5(b"\n".join(plain)).hexdigest(), lines


COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
LINES = "text_key string, lines_key string, lines array<struct<key:string,words:int>>"


def line_facts(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """Statistics of every document, keys of its text and of its normalised lines, and its lines."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("key", pa.string()), ("words", pa.int32())]))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column(2).to_pylist()
                found = [statistics(t) for t in texts]
                columns = [
                    pa.array([counts[name] for counts, _, _ in found], pa.int64())
                    for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
                ]
                columns += [
                    pa.array([hashlib.md5((t or "").encode()).hexdigest() for t in texts], pa.string()),
                    pa.array([key for _, key, _ in found], pa.string()),
                    pa.array([[{"key": k, "words": n} for k, n in lines.items()] for _, _, lines in found], kind),
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *columns], schema=schema_of(part, columns)
                )

    def schema_of(part: pa.RecordBatch, columns: list) -> pa.Schema:
        names = [c.split()[0] for c in (COUNTS + ", text_key x, lines_key x, lines x").split(", ")]
        fields = [pa.field("id", part.schema.field(0).type), pa.field("host", pa.string())]
        return pa.schema(fields + [pa.field(n, c.type) for n, c in zip(names, columns)])

    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"),
        F.col(text_col).alias("text"),
    ).mapInArrow(run, f"id {kind}, host string, {COUNTS}, {LINES}")


def common_lines(facts: DataFrame, line_docs: int = LINE_DOCS) -> DataFrame:
    """``host, key`` of lines in more than ``line_docs`` distinct documents of a host.

    Both steps combine on the map side: a line that a third of all documents share is dealt by
    document, and then costs one row a task.
    """
    rows = facts.select("host", "lines_key", F.explode("lines.key").alias("key"))
    return (
        rows.distinct().groupBy("host", "key").agg(F.count(F.lit(1)).alias("documents"))
        .where(F.col("documents") > line_docs).select("host", "key")
    )


def removals(facts: DataFrame, common: DataFrame) -> DataFrame:
    """``host, text_key, removed_words, removed``: common lines by distinct text of a host.

    ``removed`` lists the keys, no more than the text has lines.
    """
    rows = facts.select("host", "text_key", F.explode("lines").alias("l")).select(
        "host", "text_key", F.col("l.key").alias("key"), F.col("l.words").alias("words")
    )
    hits = rows.join(common, ["host", "key"]).groupBy("host", "text_key").agg(
        F.collect_set(F.struct("key", "words")).alias("hits")
    )
    return hits.select(
        "host",
        "text_key",
        F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["words"]).alias("removed_words"),
        F.col("hits.key").alias("removed"),
    )


def line_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    *,
    line_docs: int = LINE_DOCS,
    kept_percent: int = KEPT_PERCENT,
) -> DataFrame:
    """Statistics and verdict of every document, with ``host``, ``text_key`` and ``removed``.

    A document fails the base rules below ``MIN_WORDS`` words or when over half of its words
    stand in repeated windows. Else it is kept while ``kept_percent`` of its words are left after
    common lines went. A line is common in more than ``line_docs`` distinct documents of a host,
    however large the host and however many copies hold it; the rows' order and partitioning do
    not matter. NULL texts have no words, NULL hosts are one host (the empty one), NULL and
    repeated identifiers keep their rows. Equal texts of a host share a verdict. An empty table
    gives no rows. Other columns are not read.
    """
    facts = saved(line_facts(docs, id_col, text_col, host_col), "lines")
    found = removals(facts, common_lines(facts, line_docs))
    lost = F.coalesce("removed_words", F.lit(0).cast("long"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * REPEATED_PERCENT
    )
    left = (F.col("n_words") - lost) * 100 >= F.col("n_words") * kept_percent
    return facts.drop("lines", "lines_key").join(found, ["host", "text_key"], "left").select(
        F.col("id").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & left).alias("kept"),
        lost.alias("removed_words"),
        "host",
        "text_key",
        "removed",
    )


def without_common_lines(text: str, removed: set[str]) -> str:
    return "\n".join(line for line in text.split("\n") if line_key(line) not in removed)


def apply_line_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", **limits
) -> DataFrame:
    """``docs`` without rejected documents and without common lines; columns unchanged."""
    verdict = line_rules(docs, id_col, text_col, host_col, **limits)
    # The verdict is the same for equal texts of a host: one row of each is enough.
    verdict = verdict.where("kept").groupBy("host", "text_key").agg(F.first("removed").alias("__gone"))
    keyed = docs.withColumns(
        {
            "__host": F.coalesce(F.col(host_col).cast("string"), F.lit("")),
            "__key": F.md5(F.coalesce(F.col(text_col), F.lit(""))),
        }
    )
    same = (keyed["__host"] == verdict.host) & (keyed["__key"] == verdict.text_key)
    joined = keyed.join(verdict, same).select(*(keyed[c] for c in docs.columns), "__gone")
    place, gone = docs.columns.index(text_col), len(docs.columns)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                pairs = zip(part.column(place).to_pylist(), part.column(gone).to_pylist())
                texts = [without_common_lines(t, set(keys)) if keys else t for t, keys in pairs]
                field = part.schema.field(place)
                part = part.set_column(place, field, pa.array(texts, field.type))
                yield part.select(list(range(gone)))

    return joined.mapInArrow(run, docs.schema)
