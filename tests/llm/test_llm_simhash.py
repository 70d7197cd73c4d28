"""SimHash near-duplicates against plain counting and all pairs."""

import random

import numpy as np
import pytest
import xxhash
from llm_fixtures import SF, components, documents, odd_rows

from claimloom.llm import simhash
from claimloom.llm.components import components as spark_components
from claimloom.llm.shared import forest


def plain_fingerprint(text, shingle=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [words[i : i + shingle] for i in range(len(words) - shingle + 1)] or [words]
    hashes = [xxhash.xxh64_intdigest(b" ".join(p), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_rows(rows):
    """(doc_id, fingerprint, component) of every row."""
    fps = [plain_fingerprint(t) for _, t in rows]
    distinct = sorted(set(fps))
    links = [
        (a, b) for i, a in enumerate(distinct) for b in distinct[i + 1 :] if (a ^ b).bit_count() <= 2
    ]
    root = components(distinct, links)
    least = {}
    for (id_, _), fp in zip(rows, fps):
        if id_ is not None:
            least[root[fp]] = min(id_, least.get(root[fp], id_))
    return sorted(
        ((id_, f"{fp:016x}", least.get(root[fp])) for (id_, _), fp in zip(rows, fps)), key=str
    )


def found(df):
    return sorted(((r[0], r.fingerprint, r.component_id) for r in df.collect()), key=str)


def test_fingerprint_over_several_chunks():
    text = " ".join(f"w{i}" for i in range(simhash.CHUNK + 10))
    assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 6])
def test_bit_sliced_pairs_equal_all_pairs(radius):
    rng = random.Random(radius)
    fps, group, side = [], [], []
    for g in range(40):
        base = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 3, 70])):
            flips = rng.sample(range(64), rng.choice([0, 1, 2, 3, 5, 30]))
            fps.append(base ^ sum(1 << f for f in flips))
            group.append(g)
            side.append(rng.randrange(2))
    for sides in (None, np.array(side)):
        got = set()
        for a, b in simhash.close_pairs(np.array(fps, np.uint64), np.array(group), sides, radius):
            got |= set(zip(a.tolist(), b.tolist()))
        want = {
            (i, j)
            for i in range(len(fps))
            for j in range(i + 1, len(fps))
            if group[i] == group[j]
            and (fps[i] ^ fps[j]).bit_count() <= radius
            and (sides is None or side[i] != side[j])
        }
        assert got == want


def test_forest_joins_the_same_nodes():
    rng = random.Random(1)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(180)]
    a, b = forest(*(np.array(x) for x in zip(*links)))
    assert len(a) < 200
    assert components(range(200), links) == components(range(200), list(zip(a.tolist(), b.tolist())))


def test_components_of_chains_stars_and_nothing(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (300, 200)]
    df = spark.createDataFrame(links * 2, "a long, b long")
    nodes = {n for link in links for n in link}
    assert dict(map(tuple, spark_components(df).collect())) == components(nodes, links)
    assert spark_components(df.where("a < 0")).count() == 0


def test_odd_documents(spark):
    rows = odd_rows()
    got = found(simhash.simhash_components(documents(spark, rows)))
    assert got == plain_rows(rows)


def test_registered_query_equals_all_pairs(spark):
    from claimloom.llm.queries import op1_simhash

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert found(op1_simhash(spark, SF)) == plain_rows(rows)


def test_hot_buckets_in_blocks(spark):
    base = random.Random(3).getrandbits(64)
    fps = {base ^ (1 << i) ^ (1 << j) for i in range(40, 52) for j in range(52, 64)}
    signed = [(int(np.uint64(f).astype(np.int64)),) for f in fps]
    df = spark.createDataFrame(signed, "fp long")
    links = simhash.fingerprint_links(df, 2, block=16).collect()
    root = components([s for (s,) in signed], [(r.a, r.b) for r in links])
    assert len(set(root.values())) == 1


def test_one_of_each_stays(spark):
    rows = odd_rows()
    docs = documents(spark, rows)
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    firsts = sorted({c for _, _, c in plain_rows(rows)}, key=str)
    assert sorted((r.doc_id for r in kept.collect()), key=str) == firsts


def test_empty_table(spark):
    empty = documents(spark, odd_rows()).limit(0)
    assert simhash.simhash_components(empty).count() == 0
    assert simhash.keep_one_of_each(empty).count() == 0
