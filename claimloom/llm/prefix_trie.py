"""The trie of conversation prefixes, from sorted conversations and their common prefix lengths.

Conversations become sequences of turn digests and are sorted by range. Members of a prefix are
then an interval, and the interval of a prefix of ``d`` turns is as wide as the common prefix
lengths (LCPs) of neighbours stay at ``d`` or more. A block of sorted rows builds a sparse table of
range minima over its LCPs; every candidate prefix finds its left and right end by binary search
on that table, each apart from all others, without a stack.

An interval may run over the ends of a block. Such a prefix is open there: each of its blocks gives
a piece, and pieces add up. A block has no more open prefixes than the turns of its first and last
row, so however many rows share a prefix, a piece stands for a whole block of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.shared import saved

#: Bytes of a turn's digest, and rows of a block as a power of two.
DIGEST = 16
BLOCK_BITS = 14
#: Bits of a row number inside a sorted partition (as Spark numbers rows).
ROW_BITS = 33

NO_ENDS = hashlib.sha256(b"").hexdigest()
#: Where a prefix goes on: nowhere, before the block's first row, or only after its last.
CLOSED, LEFT, RIGHT = 0, 1, 2


def sequences(
    turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str
) -> DataFrame:
    """``conv, turns``: digest and code points of each turn, in order. Texts stay where they are."""
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.substring(F.sha2(whole, 256), 1, 2 * DIGEST).alias("digest"),
        F.length(text).alias("chars"),
    )
    return (
        turns.select(F.col(conv_col).cast("long").alias("conv"), turn.alias("turn"))
        .where("conv IS NOT NULL")
        .groupBy("conv")
        .agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    )


def regrown(sequences: DataFrame, family: int = 100, most: int = 5) -> DataFrame:
    """Every conversation with the first turns of its family's first one in place of its own.

    The family of ``c`` begins at ``c - c % family``; crc32 of the decimal ``c`` modulo
    ``most + 1`` says how many turns are exchanged.
    """
    first = F.col("conv") - F.col("conv") % family
    heads = sequences.where(F.col("conv") % family == 0).select(
        F.col("conv").alias("first"), F.slice("turns", 1, most).alias("head")
    )
    n = F.col("n")
    own = F.slice("turns", n + 1, F.greatest(F.size("turns") - n, F.lit(0)))
    return (
        sequences.withColumn("first", first)
        .withColumn("n", (F.crc32(F.col("conv").cast("string")) % (most + 1)).cast("int"))
        .join(heads, "first", "left")
        .withColumn("head", F.slice("head", F.lit(1), n))
        .select("conv", F.when(F.col("head").isNull(), own).otherwise(F.concat("head", own)).alias("turns"))
    )


def _sorted_blocks(sequences: DataFrame) -> DataFrame:
    """``block, place, conv, key, chars`` in the order of keys, blocks numbered in that order.

    The key is all digests in a row: a prefix of turns is a prefix of bytes. Equal keys are
    ordered by identifier, so a crowd of equal conversations is many blocks too.
    """
    keyed = sequences.select(
        "conv", F.unhex(F.array_join("turns.digest", "")).alias("key"), F.col("turns.chars").alias("chars")
    )
    row = F.monotonically_increasing_id()
    return saved(
        keyed.repartitionByRange("key", "conv")
        .sortWithinPartitions("key", "conv")
        .withColumn("row", row)
        .select(F.shiftright("row", BLOCK_BITS).alias("block"), "row", "conv", "key", "chars"),
        "sorted",
    )


def _borders(blocks: DataFrame) -> DataFrame:
    """``of, before, after``: the last key before each block and the first one after it."""
    partition = F.shiftright("block", ROW_BITS - BLOCK_BITS)
    ends = blocks.groupBy("block").agg(
        F.min_by("key", "row").alias("first"), F.max_by("key", "row").alias("last")
    )
    # One row per partition that has rows: the block with which the partition before it ends.
    runs = ends.groupBy(partition.alias("run")).agg(F.max("block").alias("end"), F.min("block").alias("start"))
    runs = runs.select(
        "start", F.lag("end").over(Window.orderBy("start")).alias("before_start")
    )
    chained = ends.join(F.broadcast(runs), ends["block"] == runs["start"], "left").select(
        "block", "first", "last",
        F.when(F.col("start").isNull(), F.col("block") - 1).otherwise(F.col("before_start")).alias("previous"),
    )
    chained = saved(chained, "borders")
    before = chained.select(F.col("block").alias("p"), F.col("last").alias("before"))
    after = chained.select(F.col("previous").alias("a"), F.col("first").alias("after"))
    return (
        chained.join(before, F.col("previous") == F.col("p"), "left")
        .join(after, F.col("block") == F.col("a"), "left")
        .select(F.col("block").alias("of"), "before", "after")
    )


def common_turns(left: bytes | None, right: bytes | None) -> int:
    """Turns that two keys share at their beginning; -1 if one of them is none."""
    if left is None or right is None:
        return -1
    n = min(len(left), len(right)) // DIGEST
    x, y = (np.frombuffer(k, np.uint64, 2 * n).reshape(n, 2) for k in (left, right))
    other = np.flatnonzero((x != y).any(axis=1))
    return int(other[0]) if len(other) else n


def neighbour_lcps(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Common turns of each row and the one before it; -1 for the first. ``words`` are the digests
    of all rows one below the other."""
    lcps = np.zeros(len(starts), np.int64)
    lcps[:1] = -1
    live, depth = np.arange(1, len(starts)), 0
    while len(live):
        live = live[(lengths[live] > depth) & (lengths[live - 1] > depth)]
        same = (words[starts[live] + depth] == words[starts[live - 1] + depth]).all(axis=1)
        live = live[same]
        depth += 1
        lcps[live] = depth
    return lcps


def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """Minima of all runs of 1, 2, 4, .. values."""
    levels = [values]
    while 2 * (width := 1 << (len(levels) - 1)) <= len(values):
        below = levels[-1]
        levels.append(np.minimum(below[: len(below) - width], below[width:]))
    return levels


def extents(
    table: list[np.ndarray], rows: np.ndarray, depths: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """First and last row around each of ``rows`` that shares ``depths`` turns with it.

    ``table`` is over LCPs, the one at ``i`` being of rows ``i - 1`` and ``i``.
    """
    n = len(table[0])
    left, right = rows.copy(), rows.copy()
    for level in range(len(table) - 1, -1, -1):
        width, minima = 1 << level, table[level]
        # LCPs left - width + 1 .. left, and right + 1 .. right + width.
        at = np.maximum(left - width + 1, 0)
        fits = (left - width >= 0) & (minima[np.minimum(at, len(minima) - 1)] >= depths)
        left = np.where(fits, left - width, left)
        at = np.minimum(right + 1, len(minima) - 1)
        fits = (right + width < n) & (minima[at] >= depths)
        right = np.where(fits, right + width, right)
    return left, right


def range_minima(table: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Least value of each range, by two runs that cover it."""
    level = np.frexp((right - left + 1).astype(np.float64))[1] - 1
    out = np.empty(len(left), table[0].dtype)
    for one in np.unique(level):
        at = level == one
        minima = table[one]
        out[at] = np.minimum(minima[left[at]], minima[right[at] - (1 << int(one)) + 1])
    return out


def block_nodes(
    convs: np.ndarray, keys: list[bytes], chars: list[list[int]], before: bytes | None, after: bytes | None
) -> dict[str, np.ndarray | list]:
    """All prefixes of the rows of a block, one entry each, from the rows alone and the keys around.

    Sums are over the block's part of a prefix's members and of its subtree.
    """
    n = len(keys)
    lengths = np.fromiter((len(k) // DIGEST for k in keys), np.int64, n)
    starts = np.cumsum(lengths) - lengths
    words = np.frombuffer(b"".join(keys), np.uint64).reshape(-1, 2)
    lcps = neighbour_lcps(words, starts, lengths)
    to_before, to_after = common_turns(before, keys[0]), common_turns(keys[-1], after)
    # Candidates: a prefix at the first row that has it.
    new = np.where(np.arange(n) == 0, 0, lcps + 1)
    count = lengths - new + 1
    rows = np.repeat(np.arange(n), count)
    depths = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + new[rows]
    left, right = extents(sparse_table(lcps), rows, depths)
    members = right - left + 1
    # Code points: of a row's first turns, and over rows.
    points = np.concatenate([[0], np.cumsum(np.fromiter((c for one in chars for c in one), np.int64))])
    upto = lambda row, depth: points[starts[row] + depth] - points[starts[row]]
    whole = upto(np.arange(n), lengths)
    over = lambda values: np.concatenate([[0], np.cumsum(values)])
    # The first depth of a row that no row before it has, in this block or another.
    fresh = np.concatenate([[to_before + 1], lcps[1:] + 1])
    first_chars = whole - upto(np.arange(n), np.maximum(fresh - 1, 0))
    all_chars, own_chars = over(whole), over(first_chars)
    begin = np.maximum(depths, fresh[left])
    # A row may have no prefix of its own (an equal row came before): then begin is past its end.
    at_left = np.maximum(whole[left] - upto(left, np.clip(begin - 1, 0, lengths[left])), 0)
    saved_tokens = (
        all_chars[right + 1] - all_chars[left] - members * upto(rows, np.maximum(depths - 1, 0))
        - (own_chars[right + 1] - own_chars[left + 1]) - at_left
    )
    leaf = over(np.append(lcps[1:], to_after) < lengths)
    # Children begin at the first row, or where neighbours part at just this depth.
    parts = np.flatnonzero((lcps >= 0) & (lengths > lcps))
    parted = np.sort(lcps[parts] * n + parts)
    children = parted.searchsorted(depths * n + right, "right") - parted.searchsorted(depths * n + left, "right")
    children += (lengths[left] > depths) & (fresh[left] <= depths + 1)
    side = np.where(
        (left == 0) & (depths <= to_before), LEFT, np.where((right == n - 1) & (depths <= to_after), RIGHT, CLOSED)
    )
    least = range_minima(sparse_table(convs), left, right)
    ends, digests = _ends(convs, lengths, rows, depths, right, side)
    keys_of_open = _open_keys(keys, rows, depths, side)
    # The parent is the candidate before, at the same row, or the one at an earlier row.
    parent_left, _ = extents(sparse_table(lcps), rows, np.maximum(depths - 1, 0))
    place = np.cumsum(count) - count
    parent = place[parent_left] + depths - 1 - new[parent_left]
    parent = np.where(depths > 0, parent, 0)
    return {
        "depth": depths, "conv": least, "n_convs": members, "n_children": children,
        "n_leaves": leaf[right + 1] - leaf[left], "saved_tokens": saved_tokens, "side": side,
        "ends": ends, "ends_sha256": digests, "node": keys_of_open,
        "parent_side": np.where(depths > 0, side[parent], CLOSED),
        "parent_conv": least[parent],
        "parent_node": [keys_of_open[p] if d else None for p, d in zip(parent.tolist(), depths.tolist())],
    }


def _ends(convs, lengths, rows, depths, right, side) -> tuple[list, list]:
    """Identifiers of the rows that end with a prefix: as text where it is open, else digested.

    They come first among its rows, in ascending order.
    """
    texts: list[str | None] = [None] * len(rows)
    digests: list[str | None] = [NO_ENDS if s == CLOSED else None for s in side.tolist()]
    some = np.flatnonzero(lengths[rows] == depths)
    # How far rows of the same length and prefix go: up to the first longer row.
    longer = np.append(np.flatnonzero(lengths[1:] != lengths[:-1]) + 1, len(lengths))
    stops = np.minimum(longer[longer.searchsorted(rows[some], "right")], right[some] + 1)
    for at, start, stop in zip(some.tolist(), rows[some].tolist(), stops.tolist()):
        text = ",".join(map(str, convs[start:stop].tolist()))
        if side[at] == CLOSED:
            digests[at] = hashlib.sha256(text.encode()).hexdigest()
        else:
            texts[at] = text
    return texts, digests


def _open_keys(keys, rows, depths, side) -> list[bytes | None]:
    """A digest of each open prefix: the same in all blocks. They lie on two paths."""
    out: list[bytes | None] = [None] * len(rows)
    # Their rows differ, but all on a path are prefixes of the block's first or last row.
    for which, key in ((LEFT, keys[0]), (RIGHT, keys[-1])):
        at = np.flatnonzero(side == which)
        running, done = hashlib.sha256(), 0
        for place in at[np.argsort(depths[at])].tolist():
            depth = int(depths[place])
            running.update(key[done * DIGEST : depth * DIGEST])
            done = depth
            out[place] = running.digest()[:DIGEST] + depth.to_bytes(8, "big")
    return out


PIECE = (
    "block long, depth long, conv long, n_convs long, n_children long, n_leaves long, saved_tokens long,"
    " side int, ends string, ends_sha256 string, node binary, parent_side int, parent_conv long,"
    " parent_node binary"
)
_NUMBERS = ("depth", "conv", "n_convs", "n_children", "n_leaves", "saved_tokens")


def _pieces(rows: pa.Table, border: pa.Table) -> pa.Table:
    rows = rows.sort_by("row")
    found = block_nodes(
        rows.column("conv").to_numpy(),
        rows.column("key").to_pylist(),
        rows.column("chars").to_pylist(),
        border.column("before")[0].as_py(),
        border.column("after")[0].as_py(),
    )
    block = rows.column("block")[0].as_py()
    types = {"side": pa.int32(), "parent_side": pa.int32(), "node": pa.binary(), "parent_node": pa.binary()}
    types |= {"ends": pa.string(), "ends_sha256": pa.string()}
    columns = {"block": pa.array([block] * len(found["depth"]), pa.int64())}
    columns |= {k: pa.array(v, types.get(k, pa.int64())) for k, v in found.items()}
    return pa.table({field.split()[0]: columns[field.split()[0]] for field in PIECE.split(", ")})


def _joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces, sorted by prefix and block, as one row per prefix; held is one row and a digest."""
    state = digest = None

    def out() -> pa.RecordBatch:
        columns = [pa.array([state["node"]], pa.binary()), pa.array([state["parent_node"]], pa.binary())]
        columns += [pa.array([state[n]], pa.int64()) for n in _NUMBERS]
        columns.append(pa.array([digest.hexdigest()]))
        return pa.RecordBatch.from_arrays(columns, names=["node", "parent_node", *_NUMBERS, "ends_sha256"])

    for batch in batches:
        for row in batch.to_pylist():
            if state is None or row["node"] != state["node"]:
                if state:
                    yield out()
                state, digest, any_ends = row, hashlib.sha256(), False
            else:
                state["conv"] = min(state["conv"], row["conv"])
                for name in _NUMBERS[2:]:
                    state[name] += row[name]
            if row["ends"] is not None:
                digest.update((("," if any_ends else "") + row["ends"]).encode())
                any_ends = True
    if state:
        yield out()


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """One row per distinct prefix of ``sequences`` (``conv``, and ``turns`` of digest and chars).

    ``conv_id`` (least member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``. The empty prefix is the root; a conversation
    without turns ends there. Sums are over whole subtrees. No conversations give no rows, not
    even a root. A conversation is one row (16 bytes a turn), its nodes one row a turn.
    """
    blocks = _sorted_blocks(sequences)
    pieces = saved(
        blocks.groupBy("block").cogroup(_borders(blocks).groupBy("of")).applyInArrow(_pieces, PIECE), "pieces"
    )
    open_pieces = pieces.where(F.col("side") != CLOSED)
    totals = saved(
        open_pieces.select("node", "block", "parent_node", *_NUMBERS, "ends")
        .repartition("node")
        .sortWithinPartitions("node", "block")
        .mapInArrow(
            _joined,
            "node binary, parent_node binary, " + ", ".join(f"{n} long" for n in _NUMBERS) + ", ends_sha256 string",
        ),
        "open",
    )

    def rows(df: DataFrame, parent: Column) -> DataFrame:
        return df.select(
            F.col("conv").alias("conv_id"), "depth",
            F.when(F.col("depth") > 0, parent).alias("parent_conv_id"),
            "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
        )

    least = totals.select(F.col("node").alias("of"), F.col("conv").alias("of_conv"))
    opened = rows(totals.join(least, F.col("parent_node") == F.col("of"), "left"), F.col("of_conv"))
    closed = pieces.where(F.col("side") == CLOSED)
    inside = rows(closed.where(F.col("parent_side") == CLOSED), F.col("parent_conv"))
    # An open parent has one entry a block, so a parent of very many is no hot key.
    known = open_pieces.select(F.col("block").alias("of_block"), F.col("node").alias("of_node")).join(
        least, F.col("of_node") == F.col("of")
    )
    hanging = closed.where(F.col("parent_side") != CLOSED).join(
        known, (F.col("block") == F.col("of_block")) & (F.col("parent_node") == F.col("of_node"))
    )
    return inside.unionByName(rows(hanging, F.col("of_conv"))).unionByName(opened)


def conversation_trie(
    turns: DataFrame,
    family: int = 100,
    most: int = 5,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``prefix_trie`` of the conversations of a table of turns, regrown by family.

    Turns are ordered by ``turn_col`` (NULL first), ties by a digest of role and text, so repeated
    rows are repeated turns. NULL roles and texts count as empty. Rows without an identifier belong
    to no conversation and are left out. Identifiers are whole numbers; a negative one has the
    remainder of its sign. Other columns are not read.
    """
    found = saved(sequences(turns, conv_col, turn_col, role_col, text_col), "sequences")
    return prefix_trie(regrown(found, family, most))
