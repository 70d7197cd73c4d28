"""Embedding near-duplicates by collision counting on one-dimensional projections.

Unit vectors are projected on random directions. Leading projections, cut into cells, deal vectors
into groups. In a group the vectors are sorted by each of the counting projections in turn, and
every pair inside a query-centred window ``|x_j - q| <= w`` of the sorted values gets one more
collision. Pairs that collide often enough are verified by cosine in double precision. Window,
count, cells and tables follow from the recall wanted for a pair just at the threshold.

Counting needs no vectors: a value is rounded to a byte, so 32 bytes a class travel to its cells.
Only classes with enough collisions in a cell go there once more with their vectors. No pair is
ever written out: tasks return link counts and a spanning forest of their links.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.components import components
from claimloom.llm.shared import forest, group_numbers, saved, whole_groups

#: Vectors of one block; a task compares two blocks of a cell.
BLOCK = 1024
#: Half a window in steps of a code. Windows reach from half a step below to half a step above.
REACH = 12
#: Pairs of places whose collisions are counted at once.
PLACES = 1 << 18
#: A group: a cell, and the two blocks of it that meet.
KEYS = ["cell", "lo", "hi"]


@dataclass(frozen=True)
class Projections:
    """Directions and windows for pairs of cosine ``threshold`` or more.

    ``recall`` is kept in choosing the tables, ``count_recall`` in choosing the collisions asked
    for, both for a pair exactly at the threshold; closer pairs are found more often. Pairs of one
    dense group share their cells, so their recall varies together: hence the wide margin.
    """

    rows: int
    threshold: float = 0.95
    recall: float = 0.995
    count_recall: float = 0.998
    counting: int = 32
    cell: float = 2.0
    occupancy: int = 32
    seed: int = 42

    @property
    def spread(self) -> float:
        """Standard deviation of a projection's difference at the threshold."""
        return math.sqrt(2 - 2 * self.threshold)

    def same_cell(self, spread: float) -> float:
        """Chance that a normal difference leaves two values in one randomly shifted cell."""
        r = self.cell / (spread * math.sqrt(2))
        return math.erf(r) - (1 - math.exp(-r * r)) / (r * math.sqrt(math.pi))

    @property
    def leading(self) -> int:
        """Leading projections: as many as leave ``occupancy`` unrelated vectors in a cell."""
        wanted = math.log(max(self.rows / self.occupancy, 1)) / -math.log(self.same_cell(math.sqrt(2)))
        return max(1, math.ceil(wanted))

    @property
    def tables(self) -> int:
        found = self.same_cell(self.spread) ** self.leading
        return max(1, math.ceil(math.log(1 - self.recall) / math.log1p(-found)))

    @property
    def window(self) -> float:
        return self.spread

    @property
    def needed(self) -> int:
        """Collisions that a pair at the threshold reaches with chance ``count_recall``."""
        p, total = math.erf(self.window / (self.spread * math.sqrt(2))), 0.0
        for count in range(self.counting + 1):
            total += math.comb(self.counting, count) * p**count * (1 - p) ** (self.counting - count)
            if total > 1 - self.count_recall:
                return count
        return self.counting

    def directions(self, length: int, count: int, purpose: int) -> np.ndarray:
        return np.random.default_rng([self.seed, purpose, length]).standard_normal((length, count))

    def cells(self, units: np.ndarray) -> np.ndarray:
        """A hash of each row's cell in every table; cells of two tables or lengths differ."""
        n, length = units.shape
        flat = units @ self.directions(length, self.tables * self.leading, 1)
        shift = np.random.default_rng([self.seed, 2]).random(self.tables * self.leading)
        grid = np.floor(flat / self.cell + shift).astype(np.int64).astype(np.uint64)
        grid = grid.reshape(n, self.tables, self.leading)
        out = np.tile(np.arange(self.tables, dtype=np.uint64) << np.uint64(32) | np.uint64(length), (n, 1))
        for k in range(self.leading):
            out = (out ^ (grid[:, :, k] + np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
            out ^= out >> np.uint64(29)
        return out.view(np.int64)

    def codes(self, units: np.ndarray) -> np.ndarray:
        """The counting projections in steps of a window. Values off the scale share its ends: more
        collisions, none lost."""
        values = units @ self.directions(units.shape[1], self.counting, 4)
        step = self.window / (REACH + 0.5)
        return (np.clip(np.rint(values / step), -128, 127) + 128).astype(np.uint8)


def _units(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of one length as a matrix of unit vectors."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    length = len(lists[0])
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    matrix = flat.reshape(-1, length)
    # Scaled first, so that squares neither vanish nor overflow.
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))


def usable(vector: str) -> Column:
    """Whether a vector can link: no NULL, no NaN or infinity, not all zero, not empty."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    return F.coalesce(F.col(vector).isNotNull() & ~bad & some, F.lit(False))


def _projected(plan: Projections):
    """``cid, vector, copies`` rows with the cells and codes of each."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pc.list_value_length(batch.column(1))
            for length in pc.unique(lengths):
                part = batch.filter(pc.equal(lengths, length))
                units = _units(part.column(1))
                cells, codes = plan.cells(units), plan.codes(units)
                n = len(units)
                starts = pa.array(np.arange(n + 1, dtype=np.int32) * plan.tables)
                ends = np.arange(n + 1, dtype=np.int32) * plan.counting
                buffers = [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(codes.tobytes())]
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns,
                        pa.ListArray.from_arrays(starts, pa.array(cells.reshape(-1))),
                        pa.Array.from_buffers(pa.binary(), n, buffers),
                    ],
                    names=["cid", "vector", "copies", "cells", "codes"],
                )

    return run


def collisions(codes: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """How often two rows of a group collide, by place: those of rows ``i`` and ``j`` of group ``g``
    are the sum of ``base[g] + i * size[g] + j`` and ``base[g] + j * size[g] + i``, where ``base``
    adds up the squares before.

    Groups are runs of rows, ``size`` long from ``start``. For each projection all groups are sorted
    at once; from each value on, a window holds the rows up to ``REACH`` steps above, so a pair
    within reach is met once, from the one sorted first.
    """
    squares = size * size
    local = (np.arange(len(codes)) - np.repeat(start, size)).astype(np.int32)
    row = (np.repeat(np.cumsum(squares) - squares, size) + local * np.repeat(size, size)).astype(np.int32)
    # Groups lie so far apart that no window reaches the next one.
    group = np.repeat(np.arange(len(size), dtype=np.int32), size) * 512
    counts = np.zeros(int(squares.sum()), np.uint8)
    after_place = np.arange(1, len(codes) + 1, dtype=np.int32)
    for k in range(codes.shape[1]):
        key = group + codes[:, k]
        order = np.argsort(key)
        key = key[order]
        inside = np.searchsorted(key, key + np.int32(REACH), side="right").astype(np.int32) - after_place
        total = np.cumsum(inside, dtype=np.int32)
        other = np.arange(total[-1], dtype=np.int32) + np.repeat(after_place - total + inside, inside)
        counts[np.repeat(row[order], inside) + local[order][other]] += 1
    return counts


def _colliding(table: pa.Table, plan: Projections) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one group, of two blocks where it has two, with enough collisions."""
    codes = np.frombuffer(b"".join(table.column("codes").to_pylist()), np.uint8).reshape(-1, plan.counting)
    whole = table.column("lo").to_numpy() == table.column("hi").to_numpy()
    block = table.column("block").to_numpy()
    group = group_numbers(table, KEYS)
    size = np.bincount(group)
    start = np.cumsum(size) - size
    chunk = (np.cumsum(size * size) - 1) // PLACES
    for number in np.unique(chunk):
        mine = np.flatnonzero(chunk == number)
        first, sizes = start[mine[0]], size[mine]
        starts = start[mine] - first
        squares = sizes * sizes
        base = np.cumsum(squares) - squares
        found = collisions(codes[first : first + sizes.sum()], starts, sizes)
        # One of a pair's two places has half of what it needs; where both have, the first counts.
        half = (plan.needed + 1) // 2
        hits = np.flatnonzero(found >= half)
        g = np.searchsorted(base, hits, side="right") - 1
        i, j = np.divmod(hits - base[g], sizes[g])
        back = found[base[g] + j * sizes[g] + i]
        enough = (found[hits] + back >= plan.needed) & ((i < j) | (back < half))
        a, b = (first + starts[g] + i)[enough], (first + starts[g] + j)[enough]
        across = whole[a] | (block[a] != block[b])
        yield a[across], b[across]


def _candidates(plan: Projections):
    """The rows of a group that collide often enough with another one."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, KEYS, rows=16_384):
            some = np.zeros(table.num_rows, bool)
            for a, b in _colliding(table, plan):
                some[a] = some[b] = True
            yield from table.drop_columns("codes").filter(pa.array(some)).combine_chunks().to_batches()

    return run


def _verified(plan: Projections):
    """Links of the classes of a group: ``cid, links`` counts, and ``cid, other`` forest rows."""

    def pairs(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        units = _units(table.column("vector"))
        cells = table.column("cells").combine_chunks().flatten().to_numpy().reshape(-1, plan.tables)
        cell = table.column("cell").to_numpy()
        for left, right in _colliding(table, plan):
            for at in range(0, len(left), 65_536):
                a, b = left[at : at + 65_536], right[at : at + 65_536]
                # A pair belongs to the first table in which it shares a cell.
                first = (cells[a] == cells[b]).argmax(axis=1)
                mine = cells[a, first] == cell[a]
                a, b = a[mine], b[mine]
                near = np.einsum("ij,ij->i", units[a], units[b]) >= plan.threshold
                yield a[near], b[near]

    def by_length(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
        """Whole groups, vectors of one length at a time."""
        for table in whole_groups(batches, KEYS, rows=8_192):
            lengths = pc.list_value_length(table.column("vector"))
            for length in pc.unique(lengths):
                yield table.filter(pc.equal(lengths, length))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_length(batches):
            cid, copies = table.column("cid").to_numpy(), table.column("copies").to_numpy()
            links = np.zeros(len(cid), np.int64)
            left, right, held = [], [], 0
            for a, b in pairs(table):
                np.add.at(links, a, copies[b])
                np.add.at(links, b, copies[a])
                left.append(cid[a])
                right.append(cid[b])
                held += len(a)
                if held > 1_000_000:
                    one, two = forest(np.concatenate(left), np.concatenate(right))
                    left, right, held = [one], [two], 0
            if not left:
                continue
            one, two = forest(np.concatenate(left), np.concatenate(right))
            nodes, place = np.unique(cid, return_inverse=True)
            sums = np.bincount(place, links).astype(np.int64)
            some = sums > 0
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([nodes[some], one])),
                    pa.array(np.concatenate([sums[some], np.zeros(len(one), np.int64)])),
                    pa.concat_arrays([pa.nulls(int(some.sum()), pa.int64()), pa.array(two)]),
                ],
                names=["cid", "links", "other"],
            )

    return run


def class_links(classes: DataFrame, plan: Projections, block: int = BLOCK) -> DataFrame:
    """``cid, links, other`` from ``classes`` (``cid, vector, copies``).

    ``links`` adds up, over rows of a class, to the copies of other classes linked with it;
    ``other`` joins the classes of a component. A cell of more than ``block`` classes is dealt as
    pairs of blocks. Vectors of different lengths never link. Cells and codes are computed once and
    stored, so that every task sees the same ones.
    """
    kind = classes.schema["vector"].dataType.simpleString()
    placed = saved(
        classes.select("cid", "vector", "copies").mapInArrow(
            _projected(plan), f"cid long, vector {kind}, copies long, cells array<long>, codes binary"
        ),
        "projected",
    )
    rows = placed.select("cid", F.explode("cells").alias("cell"), "codes")
    # Stored, so that its size is known: Spark broadcasts it if small, else joins by sorting.
    large = saved(
        rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
        .select("cell", F.ceil(F.col("n") / block).cast("int").alias("parts")),
        "large-cells",
    )
    parts = F.coalesce("parts", F.lit(1))
    dealt = (
        rows.join(large, "cell", "left")
        .withColumn("parts", parts)
        .withColumn("block", F.pmod(F.xxhash64("cid"), "parts").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "cell", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
            "block", "cid", "codes",
        )
    )

    def grouped(df: DataFrame) -> DataFrame:
        return df.repartition(*KEYS).sortWithinPartitions(*KEYS, "cid")

    candidates = grouped(dealt).mapInArrow(
        _candidates(plan), "cell long, lo int, hi int, block int, cid long"
    )
    return grouped(candidates.join(placed, "cid")).mapInArrow(
        _verified(plan), "cid long, links long, other long"
    )


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.95
) -> DataFrame:
    """``<id>, n_links, component_id, kept``, one row per row of ``vectors``.

    ``n_links`` counts the other rows linked by a cosine of ``threshold`` or more, equal vectors
    included; ``component_id`` is the least identifier reachable, the own included. A row is kept
    if that is its own.

    Vectors that are NULL, empty or zero or hold a NULL, NaN or infinity link with nothing.
    Vectors of different lengths do not link. A NULL identifier keeps its row and is never the
    least; rows that repeat count as rows. An empty table gives no rows. Other columns are not
    read.
    """
    hashes = [F.xxhash64(F.lit(n), "vector").alias(f"k{n}") for n in (1, 2)]
    named = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vector"))
    good = named.where(usable("vector")).select("id", "vector", *hashes)
    keys = ["k1", "k2"]
    classes = saved(
        good.groupBy(*keys)
        .agg(F.first("vector").alias("vector"), F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .withColumn("cid", F.monotonically_increasing_id()),
        "classes",
    )
    plan = Projections(max(classes.count(), 1), threshold)
    found = saved(class_links(classes, plan), "found")
    roots = components(found.where("other IS NOT NULL").select(F.col("cid").alias("a"), F.col("other").alias("b")))
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    labelled = (
        classes.select("cid", *keys, "first_id", "copies")
        .join(counts, "cid", "left")
        .join(roots, F.col("cid") == F.col("node"), "left")
        .withColumn("root", F.coalesce("root", "cid"))
    )
    least = labelled.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = labelled.join(least, "root").select(
        *keys, (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    linked = good.join(labels, keys).select("id", "n_links", "component_id")
    alone = named.where(~usable("vector")).select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")
    )
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col),
        "n_links",
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
