"""The prefix trie against a trie built one conversation at a time."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from llm_fixtures import SF

from claimloom.llm import prefix_trie
from claimloom.llm.queries import op12_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, conv long, block long, node string, key string"


def turns_table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x", "y") for r in rows], SCHEMA)


def regrown(rows):
    """Turns of every rebuilt conversation."""
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            held[conv].append((turn is not None, turn or 0, role or "", text or ""))
    plain = {c: [t[2:] for t in sorted(v)] for c, v in held.items()}
    out = {}
    for c, own in plain.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = plain.get(c - c % 100, [])[:h] + own[h:]
    return out


def trie(conversations):
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    below = defaultdict(list)
    for node in members:
        for d in range(len(node) + 1):
            below[node[:d]].append(node)
    rows = set()
    for node, convs in members.items():
        children = sum(len(v) == len(node) + 1 for v in below[node])
        leaves = sum(not any(len(w) == len(v) + 1 for w in below[v]) for v in below[node])
        tokens = sum((len(members[v]) - 1) * len(v[-1][1]) for v in below[node] if v)
        ends = ",".join(str(c) for c in sorted(convs) if len(conversations[c]) == len(node))
        rows.add(
            (
                min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), children,
                leaves, tokens, hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return rows


COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def check(got, rows):
    assert got.columns == COLUMNS
    found = [tuple(r) for r in got.collect()]
    want = trie(regrown(rows))
    assert len(found) == len(want) and set(found) == want


def talk(seed, families=3, each=12):
    """Few distinct turns, so that many prefixes are shared, some by equal conversations."""
    rng = random.Random(seed)
    rows = []
    for family in range(families):
        for member in range(each):
            conv = family * 100 + member + (family == 2)  # the last family lacks its first
            for turn in range(rng.randrange(0, 7)):
                rows.append((conv, turn, "ua"[turn % 2], rng.choice(["a", "bb", "ccc", None, ""])))
    return rows


@pytest.mark.parametrize("bits", [0, 1, 3, 14])
def test_against_a_plain_trie(spark, monkeypatch, bits):
    monkeypatch.setattr(prefix_trie, "BLOCK_BITS", bits)
    rows = talk(bits)
    check(prefix_trie.conversation_trie(turns_table(spark, rows)), rows)


def test_copies_over_many_blocks(spark, monkeypatch):
    """A group of equal conversations, their extensions, and a long one."""
    monkeypatch.setattr(prefix_trie, "BLOCK_BITS", 2)
    rows = [(c * 100, t, "user", f"t{t}") for c in range(30) for t in range(8 if c % 3 else 9)]
    rows += [(7777, t, "user", f"t{t}") for t in range(300)]
    check(prefix_trie.conversation_trie(turns_table(spark, rows)), rows)


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "x"), (0, None, "user", "first"), (0, 1, "assistant", None), (0, 1, None, "z"),
        (3, 0, "user", ""), (3, 0, "user", ""), (-7, 0, "user", "é😀"), (99, 5, "", "x" * 100_000),
        (200, 0, "a:", "b"), (201, 0, "a", ":b"), (301, 0, "u", "a"),
    ]
    # -7 has a remainder of its own sign: its family begins at 0. Two turns of 0 tie.
    plain = regrown([r for r in rows if r[0] != -7])
    h = zlib.crc32(b"-7") % 6
    got = {tuple(r) for r in prefix_trie.conversation_trie(turns_table(spark, rows)).collect()}
    options = []
    for tie in ([("assistant", ""), ("", "z")], [("", "z"), ("assistant", "")]):
        zero = [("user", "first"), *tie]
        options.append(trie({**plain, **_with_zero(plain, zero), -7: zero[:h] + [("user", "é😀")][h:]}))
    assert got in options
    empty = turns_table(spark, rows).limit(0)
    assert prefix_trie.conversation_trie(empty).count() == 0


def _with_zero(plain, zero):
    out = {}
    for c in (0, 3, 99):
        own = {0: zero, 3: [("user", "")] * 2, 99: [("", "x" * 100_000)]}[c]
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = zero[:h] + own[h:]
    return out


def test_intervals():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 17, 64, 100):
        lcps = rng.integers(0, 5, n)
        lcps[0] = -1
        rows = np.repeat(np.arange(n), 5)
        depths = np.tile(np.arange(5), n)
        left, right = prefix_trie.extents(prefix_trie.sparse_table(lcps), rows, depths)
        for i, d, lo, hi in zip(rows.tolist(), depths.tolist(), left.tolist(), right.tolist()):
            assert all(lcps[lo + 1 : hi + 1] >= d) and lo <= i <= hi
            assert (lo == 0 or lcps[lo] < d) and (hi == n - 1 or lcps[hi + 1] < d)


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check(op12_prefix_trie(spark, SF), rows)
