"""Two tokenizers over the same texts: which of their tokens overlap, and where both may be cut.

A task takes a batch of texts. Tokens of both tokenizers lie one after the other on one axis of
bytes, and a lane walks over a stretch of it with a pointer into each sequence. One NumPy state
vector moves the lanes of all documents of the batch together: a step emits a link per lane, a cut
where both tokens end, advances the token that ends first, and drops lanes that are through. A
document is a lane, a long one several: a link belongs to the lane in whose stretch it begins, so
no step depends on the longest text.

Counts of identifier pairs are summed over the corpus from one row per batch and pair. They come
back to the batch as one row per pair of it, never as one row per link.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.shared import saved

#: Bytes of text a lane walks over.
LANE_BYTES = 256
#: Characters encoded at a time, and characters of a batch that shares its pairs.
ENCODE_CHARS = 1_000_000
BATCH_CHARS = 12_000_000
#: A pair of identifiers is one long: the A identifier above these bits, the B identifier in them.
B_BITS = 24

# How byte-level vocabularies spell bytes, and how piece vocabularies spell a space.
PRINTABLE = (range(33, 127), range(161, 173), range(174, 256))
PIECE_SPACE = "▁"


def spelled_bytes() -> dict[str, int]:
    """Byte-level spelling: printable bytes stand for themselves, others follow from U+0100 on."""
    plain = {b for run in PRINTABLE for b in run}
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class ByteLevel:
    """Tokenizer A: ``encode`` gives the identifiers of space and text, ``tokens`` their bytes."""

    def __init__(self, json_file: str):
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._slow = Tokenizer.from_file(json_file)
        self._slow.encode_special_tokens = True
        with open(json_file, encoding="utf-8") as file:
            stated = json.load(file)
        special = {t["content"] for t in stated["added_tokens"]}
        spell = spelled_bytes()
        names = {n: t for t, n in stated["model"]["vocab"].items()}
        self.tokens = [
            bytes(spell[c] for c in names[n]) if n in names and names[n] not in special else b""
            for n in range(max(names) + 1)
        ]
        # Where merges are ranked as their results are numbered, the file is a rank file.
        merges = [m if isinstance(m, list) else m.split(" ") for m in stated["model"]["merges"]]
        vocab = stated["model"]["vocab"]
        ranked = [vocab["".join(m)] for m in merges]
        ranks = {token: n for n, token in enumerate(self.tokens) if token}
        self._fast = None
        if ranked == sorted(ranked) and len(ranks) == 256 + len(merges):
            self._fast = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self._fast:
            try:
                return [self._fast.encode_ordinary(" " + t) for t in texts]
            except Exception:  # its pattern engine gives up on some very long runs of one kind
                pass
        spaced = [" " + t for t in texts]
        return [e.ids for e in self._slow.encode_batch_fast(spaced, add_special_tokens=False)]


class Pieces:
    """Tokenizer B, which adds the space itself."""

    def __init__(self, model_file: str):
        from sentencepiece import SentencePieceProcessor

        self._model = SentencePieceProcessor(model_file=model_file)
        self.tokens = [
            bytes([int(self._model.id_to_piece(n)[3:5], 16)])
            if self._model.is_byte(n)
            else self._model.id_to_piece(n).replace(PIECE_SPACE, " ").encode()
            for n in range(self._model.get_piece_size())
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1)


class Pair:
    """Both tokenizers, with the tables that the alignment looks up by identifier."""

    def __init__(self, json_file: str, model_file: str):
        self.a, self.b = ByteLevel(json_file), Pieces(model_file)
        self.a_lengths = np.array([len(t) for t in self.a.tokens], np.int64)
        self.b_lengths = np.array([len(t) for t in self.b.tokens], np.int64)
        # Decimal identifiers with what follows them: inside a group, at the end of its side.
        self.spelled = [
            b"%d%c" % (n, mark)
            for tokens, marks in ((self.a.tokens, b",|"), (self.b.tokens, b",;"))
            for mark in marks
            for n in range(len(tokens))
        ]

    def encode(self, texts: list[str | None]) -> tuple[list[list[int]], list[list[int]]]:
        """Identifiers of both sides; none where the bytes of either differ from space and text."""
        full = [n for n, t in enumerate(texts) if t]
        some = [texts[n] for n in full]
        a: list[list[int]] = [[] for _ in texts]
        b: list[list[int]] = [[] for _ in texts]
        for n, text, left, right in zip(full, some, self.a.encode(some), self.b.encode(some)):
            raw = b" " + text.encode()
            if (
                b"".join(map(self.a.tokens.__getitem__, left)) == raw
                and b"".join(map(self.b.tokens.__getitem__, right)) == raw
            ):
                a[n], b[n] = left, right
        return a, b


@cache
def pair_of(json_file: str, model_file: str) -> Pair:
    return Pair(json_file, model_file)


def lockstep(
    a_ends: np.ndarray, b_ends: np.ndarray, starts: np.ndarray, lane_bytes: int = LANE_BYTES
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links (A token, B token) and whether both end there, of token ends on one axis of bytes.

    ``starts`` are the first bytes of the documents, ascending from 0, each of at least a byte;
    both sequences have a token that ends where a document does.
    """
    if not len(a_ends):
        none = np.zeros(0, np.int64)
        return none, none, none.astype(bool)
    total = a_ends[-1]
    sizes = np.diff(np.append(starts, total))
    per = -(-sizes // lane_bytes)
    begin = np.repeat(starts, per) + lane_bytes * (
        np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    )
    stop = np.append(begin[1:], total)
    a, b = a_ends.searchsorted(begin, "right"), b_ends.searchsorted(begin, "right")
    # A lane's first pair may begin before it: that link is the lane's before.
    a_first = np.where(a > 0, a_ends[a - 1], 0)
    b_first = np.where(b > 0, b_ends[b - 1], 0)
    earlier = np.maximum(a_first, b_first) < begin
    lefts, rights, cuts = [], [], []
    first = True
    while len(a):
        x, y = a_ends[a], b_ends[b]
        if first:
            own = ~earlier
            lefts.append(a[own])
            rights.append(b[own])
            cuts.append((x == y)[own])
            first = False
        else:
            lefts.append(a)
            rights.append(b)
            cuts.append(x == y)
        a, b = a + (x <= y), b + (y <= x)
        live = np.minimum(x, y) < stop
        if not live.all():
            a, b, stop = a[live], b[live], stop[live]
    return np.concatenate(lefts), np.concatenate(rights), np.concatenate(cuts)


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.array([*chain.from_iterable(ids)], np.int64), counts


def align(pair: Pair, texts: list[str | None]) -> dict[str, np.ndarray | list]:
    """Per text: counts of tokens, groups and links and the groups' digest; per link: its text
    (``doc``) and its pair of identifiers (``code``)."""
    a_lists, b_lists = pair.encode(texts)
    a_ids, n_a = _flat(a_lists)
    b_ids, n_b = _flat(b_lists)
    a_ends, b_ends = np.cumsum(pair.a_lengths[a_ids]), np.cumsum(pair.b_lengths[b_ids])
    a_stop, b_stop = np.cumsum(n_a), np.cumsum(n_b)
    held = np.flatnonzero(n_a)
    starts = np.concatenate([[0], a_ends[a_stop[held] - 1]])[:-1] if len(held) else held
    left, right, cut = lockstep(a_ends, b_ends, starts)
    doc_of_a = np.repeat(np.arange(len(texts)), n_a)
    doc = doc_of_a[left]
    # Ends of groups on both sides, in order.
    a_cut, b_cut = np.sort(left[cut]), np.sort(right[cut])
    return {
        "n_a": n_a,
        "n_b": n_b,
        "n_groups": np.bincount(doc_of_a[a_cut], minlength=len(texts)),
        "n_links": np.bincount(doc, minlength=len(texts)),
        "digest": _digests(pair, a_ids, b_ids, a_cut, b_cut, a_stop, b_stop, n_a),
        "doc": doc,
        "code": (a_ids[left] << B_BITS) | b_ids[right],
    }


def _digests(pair, a_ids, b_ids, a_cut, b_cut, a_stop, b_stop, n_a) -> list[str]:
    """SHA-256 of every text's groups, written out; '' without tokens."""
    group_a = np.repeat(np.arange(len(a_cut)), np.diff(a_cut, prepend=-1))
    group_b = np.repeat(np.arange(len(b_cut)), np.diff(b_cut, prepend=-1))
    b_before = np.concatenate([[0], b_cut + 1])
    # Each group: its A tokens, then its B tokens.
    order = np.empty(len(a_ids) + len(b_ids), np.int64)
    a_last = np.zeros(len(a_ids), np.int64)
    a_last[a_cut] = 1
    b_last = np.zeros(len(b_ids), np.int64)
    b_last[b_cut] = 1
    of_a, of_b = len(pair.a.tokens), len(pair.b.tokens)
    order[np.arange(len(a_ids)) + b_before[group_a]] = a_ids + a_last * of_a
    order[np.arange(len(b_ids)) + a_cut[group_b] + 1] = b_ids + (2 * of_a + b_last * of_b)
    spelled = pair.spelled
    out, at = [], 0
    for stop, some in zip((a_stop + b_stop).tolist(), n_a.tolist()):
        if some:
            text = b"".join([spelled[c] for c in order[at:stop].tolist()])
            out.append(hashlib.sha256(text[:-1]).hexdigest())
        else:
            out.append("")
        at = stop
    return out


def _runs(texts: list[str | None], size: int) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about ``size`` characters."""
    start = chars = 0
    for at, text in enumerate(texts):
        chars += len(text or "")
        if chars >= size:
            yield start, at + 1
            start, chars = at + 1, 0
    if start < len(texts):
        yield start, len(texts)


COUNTS = ("n_a", "n_b", "n_groups", "n_links")


class _Batch:
    """Texts whose pairs are counted together, until they have ``BATCH_CHARS`` characters.

    Of every run of texts only its distinct pairs are kept, and by text their places among those.
    """

    def __init__(self):
        self.runs: list[tuple[pa.Array, dict]] = []
        self.chars = self.docs = 0

    def add(self, pair: Pair, ids: pa.Array, texts: list[str | None]) -> None:
        found = align(pair, texts)
        codes, place = np.unique(found.pop("code"), return_inverse=True)
        size = max(len(codes), 1)
        held, repeats = np.unique(found.pop("doc") * size + place, return_counts=True)
        doc, place = np.divmod(held, size)
        found["codes"], found["place"], found["repeats"] = codes, place, repeats
        found["times"] = np.bincount(place, repeats, size)[: len(codes)].astype(np.int64)
        found["bounds"] = doc.searchsorted(np.arange(len(texts) + 1))
        self.runs.append((ids, found))
        self.docs += len(texts)
        self.chars += sum(len(t or "") for t in texts)

    def table(self, part: int, id_type: pa.DataType) -> pa.RecordBatch:
        """A row per text (its pairs as places in the batch's list), and one with that list."""
        runs = [found for _, found in self.runs]
        codes = np.unique(np.concatenate([f["codes"] for f in runs]))
        times = np.zeros(len(codes), np.int64)
        steps, repeats = [], []
        for f in runs:
            places = codes.searchsorted(f["codes"])
            times[places] += f["times"]
            place = places[f["place"]]
            # Steps between the ascending places of a text are small numbers.
            step = np.diff(place, prepend=0)
            first = f["bounds"][:-1][np.diff(f["bounds"]) > 0]
            step[first] = place[first]
            spans = list(zip(f["bounds"][:-1].tolist(), f["bounds"][1:].tolist()))
            step, repeat = step.astype("<i4"), f["repeats"].astype("<i4")
            steps += [step[x:y].tobytes() for x, y in spans]
            repeats += [repeat[x:y].tobytes() for x, y in spans]
        columns = [
            pa.array([part] * (self.docs + 1), pa.int64()),
            pa.concat_arrays([ids.cast(id_type) for ids, _ in self.runs] + [pa.nulls(1, id_type)]),
            *(pa.array([*np.concatenate([f[n] for f in runs]).tolist(), None], pa.int64()) for n in COUNTS),
            pa.array([d for f in runs for d in f["digest"]] + [None], pa.string()),
            pa.array([*steps, None], pa.binary()),
            pa.array([*repeats, None], pa.binary()),
            pa.array([None] * self.docs + [codes], pa.list_(pa.int64())),
            pa.array([None] * self.docs + [times], pa.list_(pa.int64())),
        ]
        names = ["part", "id", *COUNTS, "digest", "steps", "repeats", "codes", "times"]
        return pa.RecordBatch.from_arrays(columns, names=names)


def align_texts(
    docs: DataFrame, json_file: str, model_file: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``<id>, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row.

    A is the byte-level vocabulary of ``json_file``, B the pieces of ``model_file``; special
    tokens inside texts are plain text. A link is a pair of an A and a B token whose bytes overlap;
    its count is the number of links of the corpus with the same two identifiers; ``n_best`` counts
    links whose count is the highest of their B identifier, ties included. Byte offsets where
    tokens of both end cut a text into groups. NULL and empty texts, and texts that either
    tokenizer does not reproduce byte for byte, have no tokens: zeros and an empty digest.
    Identifiers may be NULL or repeat; rows are independent, a repeated row counts twice. Other
    columns are not read; an empty table gives no rows. Both files are read by path on the
    executors.

    What a worker holds is a batch of ``BATCH_CHARS`` characters, or one longer text.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def first(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(json_file, model_file)
        part = TaskContext.get().partitionId() << 32
        held = _Batch()
        id_type = None
        for batch in batches:
            id_type = batch.column(0).type
            texts = batch.column(1).to_pylist()
            for start, end in _runs(texts, ENCODE_CHARS):
                held.add(pair, batch.column(0).slice(start, end - start), texts[start:end])
                if held.chars >= BATCH_CHARS:
                    yield held.table(part, id_type)
                    part, held = part + 1, _Batch()
        if held.docs:
            yield held.table(part, id_type)

    found = saved(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
            first,
            f"part long, id {kind}, n_a long, n_b long, n_groups long, n_links long, digest string,"
            " steps binary, repeats binary, codes array<long>, times array<long>",
        ),
        "aligned",
    )
    pairs = found.where("codes IS NOT NULL").select(
        F.col("part").alias("batch"), F.posexplode(F.arrays_zip("codes", "times")).alias("place", "p")
    ).select("batch", "place", F.col("p.codes").alias("code"), F.col("p.times").alias("times"))
    counts = pairs.groupBy("code").agg(F.sum("times").alias("count"))
    b_id = F.col("code").bitwiseAND(F.lit((1 << B_BITS) - 1))
    # At most one row per B identifier.
    highest = counts.groupBy(b_id.alias("b")).agg(F.max("count").alias("highest"))
    judged = counts.join(F.broadcast(highest), b_id == F.col("b")).select(
        "code", "count", (F.col("count") == F.col("highest")).alias("best")
    )
    known = pairs.select("batch", "place", "code").join(judged, "code").select(
        "batch", "place", "count", "best"
    )

    def second(rows: pa.Table, known: pa.Table) -> pa.Table:
        place = known.column("place").to_numpy()
        count = np.zeros(len(place), np.int64)
        best = np.zeros(len(place), np.int64)
        count[place] = known.column("count").to_numpy()
        best[place] = known.column("best").to_numpy().astype(np.int64)
        n_best, count_sum = [], []
        for steps, repeats in zip(rows.column("steps").to_pylist(), rows.column("repeats").to_pylist()):
            at = np.cumsum(np.frombuffer(steps, "<i4"))
            times = np.frombuffer(repeats, "<i4").astype(np.int64)
            n_best.append(int(best[at] @ times))
            count_sum.append(int(count[at] @ times))
        return pa.table(
            [rows.column("id"), *(rows.column(n) for n in COUNTS), pa.array(n_best, pa.int64()),
             pa.array(count_sum, pa.int64()), rows.column("digest")],
            names=[id_col, *COUNTS, "n_best", "count_sum", "groups_sha256"],
        )

    rows = found.where("codes IS NULL").select("part", "id", *COUNTS, "digest", "steps", "repeats")
    return rows.groupBy("part").cogroup(known.groupBy("batch")).applyInArrow(
        second,
        f"`{id_col}` {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long,"
        " count_sum long, groups_sha256 string",
    )
