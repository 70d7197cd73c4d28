"""Embedding links against all cosines; recall on pairs just at the threshold."""

import struct
import tracemalloc

import numpy as np
import pytest
import xxhash
from llm_fixtures import components
from pyspark.sql import functions as F

from claimloom.llm import projections as p


def near(rng, v, cosine):
    """A vector at the given cosine."""
    u = v / np.linalg.norm(v)
    w = rng.standard_normal(len(v))
    w -= (w @ u) * u
    return cosine * u + np.sqrt(1 - cosine**2) * w / np.linalg.norm(w)


def table(spark, rows):
    full = [(i, None if v is None else [None if x is None else float(x) for x in v], 0, "x") for i, v in rows]
    return spark.createDataFrame(full, "vec_id long, embedding array<float>, cid int, vector string")


def good(v):
    return bool(v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v))


def plain(rows, threshold=0.95):
    """(links, component) of every row, by all cosines."""
    usable = [n for n, (_, v) in enumerate(rows) if good(v)]
    links = []
    for k, a in enumerate(usable):
        for b in usable[k + 1 :]:
            x, y = (np.array(rows[n][1], np.float32).astype(float) for n in (a, b))
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                links.append((a, b))
    root = components(range(len(rows)), links)
    least = {}
    for n, (id_, _) in enumerate(rows):
        if id_ is not None:
            least[root[n]] = min(id_, least.get(root[n], id_))
    count = np.bincount(np.array(links, int).reshape(-1), minlength=len(rows))
    return sorted(((id_, int(count[n]), least.get(root[n])) for n, (id_, _) in enumerate(rows)), key=str)


def found(df):
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in df.collect()), key=str)


def test_clusters_copies_and_chains(spark):
    rng = np.random.default_rng(1)
    rows = [(n, rng.standard_normal(48)) for n in range(300)]
    for n in range(40):
        rows.append((1000 + n, near(rng, rows[n][1], 0.99)))
        rows.append((2000 + n, rows[n][1] * 3))
    rows += [(3000 + n, rows[0][1]) for n in range(100)]
    rows += [(4000 + n, near(rng, rows[1][1], 0.995)) for n in range(60)]
    assert found(p.near_vectors(table(spark, rows))) == plain(rows)


def test_hot_cells_in_blocks(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal(32)
    rows = [(n, near(rng, base, 0.98)) for n in range(150)]
    classes = table(spark, rows).selectExpr("vec_id as cid", "embedding as vector", "1L as copies")
    plan = p.Projections(len(rows))
    links = p.class_links(classes, plan, block=20).groupBy("cid").sum("links")
    got = {r[0]: r[1] for r in links.collect()}
    want = {i: n for i, n, _ in plain(rows) if n}
    # Pairs just above the threshold, each found with chance 0.98 or a little more.
    assert sum(got.values()) >= 0.94 * sum(want.values())
    assert all(got[i] <= want[i] for i in got)


def test_odd_vectors(spark):
    v = [1.0, 2.0, 3.0]
    rows = [
        (1, v), (2, v), (2, v), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [1.0, None, 3.0]), (None, v),
        (7, [float("nan"), 1.0, 1.0]), (8, [float("inf"), 1.0, 1.0]), (9, [1.0, 2.0]), (None, None), (10, [1e-30, 2e-30, 3e-30]),
        (11, [3e38, 3e38, 3e38]), (12, [1.0, 1.0, 1.0]), (13, [-1.0, -2.0, -3.0]), (14, [-0.0, 0.0, 5.0]), (15, [0.0, 0.0, 5.0]),
    ]
    df = p.near_vectors(table(spark, rows))
    assert found(df) == plain(rows)
    kept = {r.vec_id: r.kept for r in df.collect() if r.vec_id is not None}
    assert kept[1] and not kept[2] and kept[3] and kept[9]
    assert p.near_vectors(table(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("rows", [1000, 10**6, 10**9])
def test_recall_at_the_threshold(rows):
    """Chance of a shared cell times chance of enough collisions, over random pairs."""
    plan = p.Projections(rows, recall=0.98)
    rng = np.random.default_rng(3)
    n = 400
    a = rng.standard_normal((n, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = np.stack([near(rng, v, 0.95) for v in a])
    shared = (plan.cells(a) == plan.cells(b)).any(axis=1)
    hits = collided(plan, a, b) >= plan.needed
    assert (shared & hits).mean() >= 0.94
    unrelated = collided(plan, a, np.roll(a, 1, axis=0))
    assert (unrelated >= plan.needed).mean() < 0.05


def collided(plan, a, b):
    """Collisions of two vectors, code by code."""
    return (np.abs(plan.codes(a).astype(int) - plan.codes(b)) <= p.REACH).sum(axis=1)


def test_windows_on_sorted_projections_count_every_collision():
    """Against a comparison of all pairs: sizes from one row on, ends of the scale, ties."""
    rng = np.random.default_rng(5)
    size = np.array([1, 7, 2, 40, 1, 90])
    codes = rng.integers(0, 256, (size.sum(), 32)).astype(np.uint8)
    codes[10:30] = codes[9] // 2
    codes[60:70, :16] = 255
    codes[70:80, :16] = 255 - p.REACH
    start = np.cumsum(size) - size
    got, base = p.collisions(codes, start, size), np.cumsum(size**2) - size**2
    for g, n in enumerate(size):
        part = codes[start[g] : start[g] + n].astype(int)
        want = np.triu((np.abs(part[:, None] - part[None]) <= p.REACH).sum(axis=2), 1)
        places = got[base[g] : base[g] + n * n].reshape(n, n)
        assert (np.triu(places + places.T, 1) == want).all() and not places.diagonal().any()


def test_small_groups_cost_what_their_rows_cost():
    """No array with a place for each of 256 codes of every group: a few bytes a row and a pair."""
    rng = np.random.default_rng(8)
    size = np.full(20_000, 2)
    codes = rng.integers(0, 256, (size.sum(), 4)).astype(np.uint8)
    tracemalloc.start()
    try:
        got = p.collisions(codes, np.cumsum(size) - size, size)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    want = (np.abs(codes[::2].astype(int) - codes[1::2]) <= p.REACH).sum(axis=1)
    assert (got.reshape(-1, 4)[:, 1] + got.reshape(-1, 4)[:, 2] == want).all()
    assert peak < 200 * len(codes)


def test_codes_travel_and_vectors_only_of_candidates(spark):
    """Of unlike vectors next to none is read again; the rows dealt to cells hold no vector."""
    rng = np.random.default_rng(6)
    rows = [(n, rng.standard_normal(64)) for n in range(3000)]
    rows += [(9000 + n, near(rng, rows[n][1], 0.99)) for n in range(20)]
    classes = table(spark, rows).selectExpr("vec_id as cid", "embedding as vector", "1L as copies")
    plan = p.Projections(len(rows))
    placed = classes.mapInArrow(
        p._projected(plan), "cid long, vector array<float>, copies long, cells array<long>, codes binary"
    )
    dealt = placed.selectExpr("explode(cells) as cell", "0 as lo", "0 as hi", "0 as block", "cid", "codes")
    tasks = dealt.repartition(*p.KEYS).sortWithinPartitions(*p.KEYS)
    again = tasks.mapInArrow(p._candidates(plan), "cell long, lo int, hi int, block int, cid long")
    ids = {r.cid for r in again.select("cid").distinct().collect()}
    assert ids >= {n for n in range(20)} | {9000 + n for n in range(20)}
    assert again.count() < 0.1 * dealt.count()


def colliding():
    """Two unlike vectors of one 64-bit hash: the second element is solved for."""
    p1, p2, whole = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, (1 << 64) - 1

    def turned(x, by):
        return (x << by | x >> (64 - by)) & whole

    def state(x):
        return xxhash.xxh64_intdigest(struct.pack("<d", x), 42) + 0x27D4EB2F165667C5 + 8

    for n in range(1_000_000):
        first = 1.0 + n / 64
        bits = struct.unpack("<Q", struct.pack("<d", first))[0]
        mixed = turned(bits * p2 & whole, 31) * p1 & whole
        want = (state(1.0) & whole) ^ (state(2.0) & whole) ^ mixed
        other = turned(want * pow(p1, -1, 1 << 64) & whole, 33) * pow(p2, -1, 1 << 64) & whole
        second = struct.unpack("<d", struct.pack("<Q", other))[0]
        a, b = np.array([1.0, first]), np.array([2.0, second])
        if 0.01 < abs(second) < 100 and a @ b / np.linalg.norm(a) / np.linalg.norm(b) < 0.8:
            return a.tolist(), b.tolist()
    raise AssertionError("no pair")


def test_vectors_of_one_hash_stay_apart(spark):
    a, b = colliding()
    rows = spark.createDataFrame([(1, a), (2, b), (3, b)], "vec_id long, embedding array<double>")
    assert rows.select(F.xxhash64("embedding")).distinct().count() == 1
    got = sorted(map(tuple, p.near_vectors(rows).collect()))
    assert got == [(1, 0, 1, True), (2, 1, 2, True), (3, 1, 2, False)]
