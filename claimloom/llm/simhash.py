"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints are compared vertically: bit ``b`` of all lanes is one plane, a machine word holds a
plane of 64 lanes. Planes are added to carry-save counters, and words whose lanes all exceed the
radius are abandoned. Which lanes meet follows from the pigeonhole principle, so no pair within
the radius is missed: of ``radius + 2`` pieces of a fingerprint two at least are equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.components import components
from claimloom.llm.shared import forest, group_numbers, saved, small_batches, whole_groups

BITS = 64
SEED = 42
#: Fingerprints of one block; a task compares two blocks of a bucket.
BLOCK = 4096
#: Shingles hashed and counted at once.
CHUNK = 32_768


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Bits set in over half of the shingles' hashes; no words give zero."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hash_of = xxhash.xxh64_intdigest
    if len(words) < shingle:
        return hash_of(b" ".join(words), SEED)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    count = len(words) - shingle + 1
    ones = np.zeros(BITS, np.int64)
    for at in range(0, count, CHUNK):
        to = min(at + CHUNK, count)
        spans = zip(starts[at:to].tolist(), ends[at + shingle - 1 : to + shingle - 1].tolist())
        hashes = np.fromiter((hash_of(line[a:b], SEED) for a, b in spans), np.uint64, to - at)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    value = np.packbits(2 * ones > count, bitorder="little").view(np.uint64)[0]
    return int(value)


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``id, fp, text_key``: the fingerprint as a signed long and the MD5 of the text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [t or "" for t in part.column(1).to_pylist()]
                fps = np.array([fingerprint(t, shingle) for t in texts], np.uint64)
                keys = [hashlib.md5(t.encode()).hexdigest() for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(fps.view(np.int64)), pa.array(keys)],
                    names=["id", "fp", "text_key"],
                )

    small_batches(docs.sparkSession)
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, "id long, fp long, text_key string")


def _bucket_keys(fp: Column, radius: int) -> Column:
    """One key per choice of two pieces: its number, then their bits."""
    pieces = radius + 2
    bounds = [round(BITS * k / pieces) for k in range(pieces + 1)]
    cut = [
        F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1))
        for lo, hi in zip(bounds, bounds[1:])
    ]
    return F.array(
        *(
            F.struct(F.lit(n).alias("choice"), cut[i].alias("p"), cut[j].alias("q"))
            for n, (i, j) in enumerate(combinations(range(pieces), 2))
        )
    )


def _shifted(planes: np.ndarray, plane: int, words: np.ndarray, by: int) -> np.ndarray:
    """The lanes ``by`` further on, for the given words."""
    whole, rest = divmod(by, 64)
    low = planes[plane, words + whole]
    if not rest:
        return low
    high = planes[plane, words + whole + 1]
    return (low >> np.uint64(rest)) | (high << np.uint64(64 - rest))


def _packed(flags: np.ndarray, words: int) -> np.ndarray:
    out = np.zeros(words * 8, np.uint8)
    packed = np.packbits(flags, axis=-1, bitorder="little")
    out[: packed.shape[-1]] = packed
    return out.view(np.uint64)


def close_pairs(
    fps: np.ndarray, group: np.ndarray, side: np.ndarray | None, radius: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of pairs of one group that differ in ``radius`` bits at most.

    ``fps`` (unsigned 64-bit) is sorted by ``group``. With ``side``, groups whose rows have two
    sides yield pairs across the sides only.
    """
    n = len(fps)
    sizes = np.bincount(group)
    longest = int(sizes.max())
    words = -(-n // 64)
    spare = longest // 64 + 2
    planes = np.stack(
        [_packed((fps >> np.uint64(b)) & np.uint64(1) != 0, words + spare) for b in range(BITS)]
    )
    counters = (radius + 1).bit_length()
    limit = [(radius + 1) >> k & 1 for k in range(counters)]
    full = ~np.uint64(0)
    for by in range(1, longest):
        valid = group[by:] == group[:-by]
        if side is not None:
            valid &= side[by:] != side[:-by]
        if not valid.any():
            continue
        over = ~_packed(valid, words)
        active = np.flatnonzero(over != full)
        over = over[active]
        counts = [np.zeros(len(active), np.uint64) for _ in range(counters)]
        for b in range(BITS):
            carry = planes[b, active] ^ _shifted(planes, b, active, by)
            for k in range(counters):
                counts[k], carry = counts[k] ^ carry, counts[k] & carry
            reached = carry
            hit = np.full(len(active), full)
            for k in range(counters):
                hit &= counts[k] if limit[k] else ~counts[k]
            over |= reached | hit
            if b % 8 == 7:
                alive = over != full
                if not alive.all():
                    active, over = active[alive], over[alive]
                    counts = [c[alive] for c in counts]
                    if not len(active):
                        break
        if len(active):
            lanes = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            word, bit = np.nonzero(lanes)
            at = active[word] * 64 + bit
            yield at, at + by


def _links(radius: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["choice", "p", "q", "lo", "hi"]
        for table in whole_groups(batches, keys):
            fps = table.column("fp").to_numpy().view(np.uint64)
            group = group_numbers(table, keys)
            block = table.column("block").to_numpy()
            # Two blocks: only pairs across them; one block has its own task.
            lo, hi = table.column("lo").to_numpy(), table.column("hi").to_numpy()
            side = np.where(lo == hi, np.arange(len(lo)), block) if (lo != hi).any() else None
            found_a, found_b, held = [], [], 0
            for a, b in close_pairs(fps, group, side, radius):
                found_a.append(fps[a].view(np.int64))
                found_b.append(fps[b].view(np.int64))
                held += len(a)
                if held > 1_000_000:
                    a, b = forest(np.concatenate(found_a), np.concatenate(found_b))
                    found_a, found_b, held = [a], [b], 0
            if found_a:
                a, b = forest(np.concatenate(found_a), np.concatenate(found_b))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def fingerprint_links(distinct: DataFrame, radius: int = 2, block: int = BLOCK) -> DataFrame:
    """``a, b``: links that join the same fingerprints as all pairs within ``radius`` do.

    ``distinct`` holds each fingerprint ``fp`` once. Buckets of more than ``block`` fingerprints
    are dealt as pairs of blocks to tasks of their own; a task returns a spanning forest of the
    pairs it found, so neither a task nor its result grows with the square of a bucket.
    """
    rows = distinct.select("fp", F.explode(_bucket_keys(F.col("fp"), radius)).alias("k")).select(
        "fp", "k.choice", "k.p", "k.q"
    )
    keys = ["choice", "p", "q"]
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / block).cast("long")
    dealt = (
        rows.join(sizes, keys)
        .select(*keys, "fp", parts.alias("parts"), F.pmod(F.xxhash64("fp"), parts).alias("block"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        .select(
            *keys, F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
            "block", "fp",
        )
    )
    tasks = dealt.repartition(*keys, "lo", "hi").sortWithinPartitions(*keys, "lo", "hi", "fp")
    return tasks.mapInArrow(_links(radius), "a long, b long")


def simhash_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    radius: int = 2,
) -> DataFrame:
    """``<id>, fingerprint, component_id, text_key, root``, one row per row of ``docs``.

    Texts are lower-cased (A-Z) and cut at the six ASCII white-space characters. Documents whose
    fingerprints differ in ``radius`` bits or fewer are linked; ``component_id`` is the least
    identifier reachable, the document's own included, and ``root`` a number of the component.

    NULL and empty texts have fingerprint zero and link like any other. NULL identifiers keep
    their rows but are never the least; a component without any identifier has NULL. Repeated
    rows and identifiers keep their rows. An empty table gives no rows. Other columns are not
    read.
    """
    rows = saved(fingerprints(docs, id_col, text_col, shingle), "simhash")
    distinct = rows.groupBy("fp").agg(F.min("id").alias("first_id"))
    roots = components(fingerprint_links(distinct.select("fp"), radius))
    labelled = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    least = labelled.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = labelled.join(least, "root").select("fp", "root", "component_id")
    return rows.join(labels, "fp").select(
        F.col("id").alias(id_col),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
        "text_key",
        "root",
    )


def keep_one_of_each(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    radius: int = 2,
) -> DataFrame:
    """``docs`` with one row per component: the one with the least identifier.

    Ties (repeated or NULL identifiers) fall to the least MD5 of the text; of rows equal in both,
    one stays.
    """
    found = simhash_components(docs, id_col, text_col, shingle, radius)
    order = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), "text_key")
    first = (
        found.groupBy("root").agg(F.min(order).alias("w"))
        .select(_row_key(F.col("w.id"), F.col("w.text_key")).alias("__row"))
    )
    text_key = F.md5(F.coalesce(F.col(text_col), F.lit("")))
    keyed = docs.withColumn("__row", _row_key(F.col(id_col).cast("long"), text_key))
    return keyed.join(first, "__row", "left_semi").dropDuplicates(["__row"]).drop("__row")


def _row_key(id_: Column, text_key: Column) -> Column:
    return F.concat_ws(":", F.coalesce(id_.cast("string"), F.lit("none")), text_key)
