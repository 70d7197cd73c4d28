"""Byte-level BPE by recursive DuckDB queries, one in-memory database per Python worker.

Distinct pieces of a batch become token-position rows. A recursive query joins adjacent rows with
the merge table and contracts each piece's leftmost pair of minimum rank until no pair is left.
Further occurrences of the same pair go in the same step as long as no merge before them makes a
pair of lower rank: the same sequence in fewer steps. Decoding joins ids with the vocabulary and
aggregates the bytes in order.

A long piece is contracted in windows that overlap. Two windows are joined at a token that both
have. That is exact: tokens are the encoding of their bytes if and only if every two neighbours
are the encoding of theirs. For a merge across a border that no merge crossed before would be the
minimum among the two tokens' own pairs as well, so the two alone would merge across it too. All
neighbours in a joined sequence are neighbours in some window, and parts of an encoding that begin
and end at its tokens are encodings.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterable, Iterator
from functools import cache

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.shared import small_batches

#: Token rows that one recursive query starts with, and characters of texts held at once.
QUERY_ROWS = 200_000
BATCH_CHARS = 2_000_000
#: Tokens that one query decodes; a longer document is decoded in consecutive ranges.
DECODE_ROWS = 1_000_000
#: Distinct pieces whose ids a worker remembers, and bytes of those pieces and ids.
KNOWN_PIECES = 1_000_000
KNOWN_BYTES = 64_000_000

#: Pieces of more bytes are contracted in windows of so many, each beginning ``STRIDE`` after the
#: one before: a query takes as many steps as its longest piece has merges. Where two windows have
#: no token in common (long runs of one sign), a wide window takes over.
LONG = 96
STRIDE = 64
WIDE = 32_768

#: ``piece`` rows (loc, id) lie one after the other, ``loc`` being piece number * 256 + offset. A
#: step contracts the leftmost pair of minimum rank of every live piece (``key``: its rank, then
#: its place); a piece without a pair goes through once more, no longer live, and is done.
CONTRACT_SHORT = """
WITH RECURSIVE step(loc, next_loc, id, next_id, live) AS (
    SELECT loc, lead(loc) OVER o, id, lead(id) OVER o, true FROM piece WINDOW o AS (ORDER BY loc)
  UNION ALL
    SELECT * FROM (
        WITH hit AS MATERIALIZED (
            SELECT s.loc >> 8 AS w, min((m.rank::BIGINT << 40) + s.loc) AS key
            FROM step s JOIN merges m ON m.l = s.id AND m.r = s.next_id
            WHERE s.live AND s.next_loc >> 8 = s.loc >> 8
            GROUP BY ALL
        ), after AS MATERIALIZED (
            SELECT s.loc, key IS NOT NULL AS live,
                   CASE WHEN s.loc = key & 1099511627775 THEN (key >> 40)::INTEGER ELSE s.id END AS id,
                   lag(s.loc = key & 1099511627775, 1, false) OVER (ORDER BY s.loc) AS eaten
            FROM step s LEFT JOIN hit ON w = s.loc >> 8
            WHERE s.live
        )
        SELECT loc, lead(loc) OVER o, id, lead(id) OVER o, live
        FROM after WHERE eaten IS NOT TRUE WINDOW o AS (ORDER BY loc)
    )
)
SELECT loc >> 8 AS w, id FROM step WHERE NOT live ORDER BY loc
"""

#: The same for wide windows, on rows (w, pos, id). ``hits`` are the pairs of minimum rank;
#: of overlapping ones the leftmost counts, then every second. ``early``: the merge makes a pair of
#: lower rank with a neighbour, so later hits have to wait. A token that its left one took has -1.
CONTRACT_LONG = """
WITH RECURSIVE step(w, pos, id) USING KEY (w, pos) AS (
    SELECT w, pos, id FROM piece
  UNION
    SELECT w, unnest([pos, next_pos]), unnest([rank, -1])
    FROM (
        WITH pairs AS (
            SELECT w, pos, id,
                   lag(id) OVER o AS before, lead(id) OVER o AS next_id, lead(id, 2) OVER o AS after,
                   lead(pos) OVER o AS next_pos, row_number() OVER o AS place
            FROM recurring.step
            WHERE id >= 0 AND w IN (SELECT w FROM step)
            WINDOW o AS (PARTITION BY w ORDER BY pos)
        ), ranked AS (
            SELECT p.*, m.rank, m.unsafe, min(m.rank) OVER (PARTITION BY w) AS least
            FROM pairs p LEFT JOIN merges m ON m.l = p.id AND m.r = p.next_id
        ), hits AS (
            SELECT *, place - row_number() OVER (PARTITION BY w ORDER BY place) AS run
            FROM ranked WHERE rank = least
        ), chosen AS (
            SELECT *, lag(place) OVER (PARTITION BY w ORDER BY place) AS chosen_before
            FROM (SELECT *, row_number() OVER (PARTITION BY w, run ORDER BY place) AS nth FROM hits)
            WHERE nth % 2 = 1
        ), judged AS (
            SELECT c.w, c.pos, c.next_pos, c.rank, c.place,
                   coalesce(c.unsafe AND least(x.rank, y.rank) < c.rank, false) AS early
            FROM chosen c
            LEFT JOIN merges x
              ON x.l = CASE WHEN c.chosen_before = c.place - 2 THEN c.rank ELSE c.before END
             AND x.r = c.rank
            LEFT JOIN merges y ON y.l = c.rank AND y.r = c.after
        )
        SELECT w, pos, next_pos, rank FROM judged
        QUALIFY place <= coalesce(min(place) FILTER (early) OVER (PARTITION BY w), place)
    )
)
SELECT w, id FROM step WHERE id >= 0 ORDER BY w, pos
"""

#: Eight neighbours are put side by side by place, so that few strings remain to be ordered.
DECODE = f"""
SELECT doc, string_agg(part, '' ORDER BY run) AS hex
FROM (
    SELECT doc, pos // 8 AS run,
           concat({", ".join(f"min(hex) FILTER (pos % 8 = {k})" for k in range(8))}) AS part
    FROM tokens JOIN vocabulary USING (id) GROUP BY ALL
) GROUP BY doc
"""


class Codec:
    """A rank file's vocabulary and merges, with a database to query them."""

    def __init__(self, rank_file: str, pattern: str):
        with open(rank_file, "rb") as lines:
            self.ranks = {
                base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)
            }
        self.split = regex.compile(pattern).findall
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.lengths = np.zeros(max(self.ranks.values()) + 1, np.int64)
        for token, rank in self.ranks.items():
            self.lengths[rank] = len(token)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.known_bytes = 0
        self.db = duckdb.connect(
            config={"threads": 1, "memory_limit": "400MB", "temp_directory": "", "preserve_insertion_order": False}
        )
        self._load()

    def _load(self) -> None:
        ranks = self.ranks
        rows = [
            (ranks[token[:k]], ranks[token[k:]], rank)
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks
        ]
        left, right, merged = (np.array(c, np.int32) for c in zip(*rows))
        # The lowest rank of a pair that a token takes part in.
        lowest = np.full(max(ranks.values()) + 1, np.iinfo(np.int32).max, np.int32)
        np.minimum.at(lowest, left, merged)
        np.minimum.at(lowest, right, merged)
        merges = pa.table({"l": left, "r": right, "rank": merged, "unsafe": lowest[merged] < merged})
        vocabulary = pa.table(
            {
                "id": pa.array(list(ranks.values()), pa.int32()),
                "hex": pa.array([token.hex() for token in ranks]),
            }
        )
        for name, table in (("merges", merges), ("vocabulary", vocabulary)):
            self.db.register("given", table)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.db.unregister("given")

    def _contract(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of pieces that are all of at most ``LONG`` bytes or all longer."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        starts = np.cumsum(lengths) - lengths
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        w = np.repeat(np.arange(len(pieces)), lengths)
        pos = np.arange(len(raw)) - starts[w]
        if long := lengths[0] > LONG:
            rows = {"w": w, "pos": pos}
        else:
            rows = {"loc": (w << 8) + pos}
        self.db.register("piece", pa.table(rows | {"id": self.byte_ids[raw]}))
        found = self.db.execute(CONTRACT_LONG if long else CONTRACT_SHORT).fetchnumpy()
        self.db.unregister("piece")
        ids = np.asarray(found["id"], "<i4")
        return np.split(ids, np.searchsorted(np.asarray(found["w"]), np.arange(1, len(pieces))))

    def learn(self, pieces: set[str]) -> None:
        """Make the ids of ``pieces`` known."""
        # Two generations: pieces that come again stay, others go with the older one.
        if len(self.known) > KNOWN_PIECES // 2 or self.known_bytes > KNOWN_BYTES // 2:
            self.older, self.known, self.known_bytes = self.known, {}, 0
        short: list[tuple[str, bytes]] = []
        long: list[tuple[str, bytes]] = []
        for piece in pieces:
            if piece in self.known:
                continue
            if (ids := self.older.get(piece)) is not None:
                self._remember(piece, ids)
                continue
            data = piece.encode()
            if (rank := self.ranks.get(data)) is not None:
                self._remember(piece, rank.to_bytes(4, "little"))
            else:
                (long if len(data) > LONG else short).append((piece, data))
        # Pieces and windows of longer ones go through the same queries.
        distinct = dict.fromkeys(data for _, data in short)
        for _, data in long:
            distinct.update(dict.fromkeys(data[at : at + LONG] for at in _starts(data)))
        found: dict[bytes, np.ndarray] = {}
        for some in _portioned(list(distinct), QUERY_ROWS):
            found.update(zip(some, self._contract(some)))
        for piece, data in short:
            self._remember(piece, found[data].tobytes())
        for piece, data in long:
            self._remember(piece, self._joined(data, found).tobytes())

    def _remember(self, piece: str, ids: bytes) -> None:
        self.known[piece] = ids
        self.known_bytes += len(piece) + len(ids)

    def _joined(self, data: bytes, known: dict[bytes, np.ndarray]) -> np.ndarray:
        """Ids of a long piece, from those of its windows."""
        # ``ids`` and ``ends`` are the window at hand; before ``first`` its tokens are not its own.
        ids = known[data[:LONG]]
        ends = np.cumsum(self.lengths[ids])
        first, out = 0, []
        while ends[-1] < len(data):
            # The last window that begins well inside the one at hand.
            at = max((int(ends[-1]) - (LONG - STRIDE)) // STRIDE, 0) * STRIDE
            new = known[data[at : at + LONG]]
            new_ends = at + np.cumsum(self.lengths[new])
            here = new_ends[-1] > ends[-1] and _same_token(ids, ends, first, new, new_ends)
            if not here:
                new, new_ends, here = self._wide(data, ids, ends, first)
            mine, theirs = here
            out.append(ids[first : mine + 1])
            ids, ends, first = new, new_ends, theirs + 1
        return np.concatenate([*out, ids[first:]])

    def _wide(self, data: bytes, ids: np.ndarray, ends: np.ndarray, first: int):
        """A wide window that begins at a token of the window at hand and has it too, and where.

        Windows grow to the whole rest; from the first token on that is the rest's own encoding.
        """
        size = WIDE
        while True:
            for mine in range(max(first, (first + 3 * len(ids)) // 4), first - 1, -max(len(ids) // 8, 1)):
                start = int(ends[mine - 1]) if mine else int(ends[0]) - int(self.lengths[ids[0]])
                window = data[start : start + size]
                if len(window) <= LONG or start + len(window) <= ends[-1]:
                    continue
                new = self._contract([window])[0]
                if new[0] == ids[mine]:
                    return new, start + np.cumsum(self.lengths[new]), (mine, 0)
            if size >= len(data):
                raise ValueError(f"a piece of {len(data)} bytes has no window that can be joined")
            size *= 4

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        split = [self.split(text or "") for text in texts]
        self.learn(set().union(*split))
        ids_of = self.known.__getitem__
        return [np.frombuffer(b"".join(map(ids_of, pieces)), "<i4") for pieces in split]

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """The bytes of each document, however long."""
        out: list[list[bytes]] = [[] for _ in ids]
        docs, ranges, held = [], [], 0
        for doc, tokens in enumerate(ids):
            for at in range(0, len(tokens), DECODE_ROWS):
                part = tokens[at : at + DECODE_ROWS]
                if held + len(part) > DECODE_ROWS:
                    self._decode_into(out, docs, ranges)
                    docs, ranges, held = [], [], 0
                docs.append(doc)
                ranges.append(part)
                held += len(part)
        self._decode_into(out, docs, ranges)
        return [b"".join(parts) for parts in out]

    def _decode_into(self, out: list[list[bytes]], docs: list[int], ranges: list[np.ndarray]) -> None:
        """Add the bytes of each range, at most one of a document, to those of its document."""
        if not ranges:
            return
        lengths = [len(x) for x in ranges]
        tokens = pa.table(
            {
                "doc": np.repeat(np.array(docs, np.int32), lengths),
                "pos": np.concatenate([np.arange(n, dtype=np.int32) for n in lengths]),
                "id": np.concatenate(ranges),
            }
        )
        self.db.register("tokens", tokens)
        for doc, text in self.db.execute(DECODE).fetchall():
            out[doc].append(bytes.fromhex(text))
        self.db.unregister("tokens")


def _starts(data: bytes) -> range:
    """Where the windows of a long piece begin; the last one reaches its end."""
    return range(0, len(data) - LONG + STRIDE, STRIDE)


def _portioned(pieces: list[bytes], rows: int) -> Iterator[list[bytes]]:
    """Runs of pieces of about ``rows`` bytes."""
    start = held = 0
    for at, piece in enumerate(pieces):
        held += len(piece)
        if held >= rows:
            yield pieces[start : at + 1]
            start, held = at + 1, 0
    if start < len(pieces):
        yield pieces[start:]


def _same_token(ids, ends, first: int, new, new_ends) -> tuple[int, int] | None:
    """Places of the first token that two windows share, from ``first`` on in one of them."""
    low = int(ends.searchsorted(new_ends[0]))
    mine = np.arange(max(low, first, 1), len(ends))
    theirs = np.minimum(new_ends.searchsorted(ends[mine]), len(new_ends) - 1)
    same = (new_ends[theirs] == ends[mine]) & (ids[mine] == new[theirs])
    # Equal tokens that end at one place are the same bytes.
    found = np.flatnonzero(same)
    return (int(mine[found[0]]), int(theirs[found[0]])) if len(found) else None


@cache
def codec(rank_file: str, pattern: str) -> Codec:
    return Codec(rank_file, pattern)


def _portions(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about ``BATCH_CHARS`` characters, none much shorter than others."""
    whole = sum(len(text or "") for text in texts)
    most = whole / max(1, round(whole / BATCH_CHARS)) or BATCH_CHARS
    start = chars = 0
    for at, text in enumerate(texts):
        chars += len(text or "")
        if chars >= most:
            yield start, at + 1
            start, chars = at + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode_texts(
    docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``<id>, ids, n_tokens, ids_sha256, decoded_sha256`` for every row.

    ``ids`` are those of the rank file, pieces of ``pattern`` taken separately, without special
    tokens. ``decoded_sha256`` digests the bytes decoded from ``ids``. The rank file is read by
    path on the executors. NULL and empty texts have no ids. Identifiers may be NULL or repeat;
    rows are independent. Other columns are not read; an empty table gives no rows.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(rank_file, pattern)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for start, end in _portions(texts):
                ids = coder.encode(texts[start:end])
                raw = coder.decode(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, end - start),
                        pa.array(ids, pa.list_(pa.int32())),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids]),
                        pa.array([hashlib.sha256(x).hexdigest() for x in raw]),
                    ],
                    names=[id_col, "ids", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(
        run,
        f"`{id_col}` {kind}, ids array<int>, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
