"""Weights against plain arithmetic, budgets, and the order of the mix."""

import math
from collections import Counter

import pytest
from llm_fixtures import SF, documents, odd_rows

from claimloom.llm import mixing
from claimloom.llm.mixing import Mix
from claimloom.llm.queries import op2_mixing

SIZES = {"big": 300, "middle": 60, "small": 12}


def corpus(spark):
    rows = [
        (k * 1000 + n, f"{name} document {n} ".ljust(100, "x"), name)
        for k, (name, count) in enumerate(SIZES.items())
        for n in range(count)
    ]
    return documents(spark, rows)


def totals(spark):
    return spark.createDataFrame([(n, 100 * c) for n, c in SIZES.items()], "source string, tokens long")


def weights(alpha):
    z = sum(c**alpha for c in SIZES.values())
    return {n: c**alpha / z for n, c in SIZES.items()}


def entropy(alpha):
    return -sum(w * math.log(w) for w in weights(alpha).values())


@pytest.mark.parametrize("target", [0.6, 0.75, 0.9, 0.99])
def test_entropy_target_is_met(spark, target):
    alpha = mixing.bisect_exponent(totals(spark), Mix(entropy=target, max_epochs=None))
    assert entropy(alpha) >= target * math.log(3) - 1e-9
    assert alpha == 1 or abs(entropy(alpha) - target * math.log(3)) < 1e-6


@pytest.mark.parametrize("limit", [1.0, 2.0, 5.0, 24.9, 100.0])
def test_repetition_limit_is_met(spark, limit):
    alpha = mixing.bisect_exponent(totals(spark), Mix(entropy=None, max_epochs=limit))
    assert (300 / 12) ** (1 - alpha) <= limit + 1e-9
    assert alpha == 0 or abs((300 / 12) ** (1 - alpha) - limit) < 1e-5


def test_limit_comes_before_entropy(spark):
    alpha = mixing.bisect_exponent(totals(spark), Mix(entropy=0.99, max_epochs=2.0))
    assert abs((300 / 12) ** (1 - alpha) - 2) < 1e-5


def test_every_document_once_and_budgets(spark):
    mix = Mix(entropy=None, max_epochs=3.0)
    docs = corpus(spark)
    out = mixing.mix_documents(docs, mix)
    assert out.columns == docs.columns
    copies = Counter(r.doc_id for r in out.collect())
    assert len(copies) == sum(SIZES.values()) and max(copies.values()) <= 3
    alpha = mixing.bisect_exponent(totals(spark), mix)
    for k, (name, count) in enumerate(SIZES.items()):
        got = sum(n for d, n in copies.items() if d // 1000 == k)
        wanted = count * (count / 300) ** (alpha - 1)
        assert wanted - 1e-6 <= got < wanted + 1  # whole documents: at most one more
        assert max(n for d, n in copies.items() if d // 1000 == k) - min(
            n for d, n in copies.items() if d // 1000 == k
        ) <= 1


def test_fixed_budget(spark):
    mix = Mix(entropy=0.999, max_epochs=None, tokens=15_000)
    rows = mixing.mixed_order(corpus(spark), mix).collect()
    spent = Counter()
    for r in rows:
        spent[r.source] += r.tokens
    alpha = mixing.bisect_exponent(totals(spark), mix)
    for name, weight in weights(alpha).items():
        assert abs(next(r.weight for r in rows if r.source == name) - weight) < 1e-9
        assert 0 <= spent[name] - 15_000 * weight < 100 + 1e-6


def test_blocks_hold_the_weights(spark):
    mix = Mix(entropy=0.95, max_epochs=None, block_tokens=40_000)
    rows = mixing.mixed_order(corpus(spark), mix).collect()
    assert all(0 <= r.place <= 1 + 1e-6 for r in rows)
    blocks = {}
    for r in rows:
        blocks.setdefault(r.block, Counter())[r.source] += 1
    assert set(blocks) == set(range(max(blocks) + 1)) and len(blocks) > 1
    share = len([r for r in rows if r.source == "big"]) / len(rows)
    assert all(abs(b["big"] / sum(b.values()) - share) < 0.2 for b in blocks.values())


def test_blocks_have_budgets_of_their_own(spark):
    """Uneven documents: of every source a block has its share of the budget, to one document."""
    rows = [
        (k * 10_000 + n, "x" * (1 + (n * 37) % 400), name)
        for k, (name, count) in enumerate({"big": 900, "middle": 300, "small": 90}.items())
        for n in range(count)
    ]
    mix = Mix(entropy=0.95, max_epochs=3.0, block_tokens=30_000)
    got = mixing.mixed_order(documents(spark, rows), mix).collect()
    blocks = 1 + max(r.block for r in got)
    assert blocks > 5
    spent = Counter()
    for r in got:
        spent[r.source, r.block] += r.tokens
    for name in ("big", "middle", "small"):
        budget = sum(n for (s, _), n in spent.items() if s == name)
        for block in range(blocks):
            assert abs(spent[name, block] - budget / blocks) <= 2 * 400
    # Places follow the order of epochs and keys, from nothing spent to all.
    assert min(r.place for r in got) == 0 and max(r.place for r in got) < 1
    for name in ("big", "small"):
        order = sorted((r.place, r.epoch) for r in got if r.source == name)
        assert [e for _, e in order] == sorted(e for _, e in order)


def test_token_counts_as_a_column(spark):
    """Weights, budgets and places by counted tokens: against a plain mix of a small corpus."""
    docs = corpus(spark).selectExpr("doc_id", "text", "source", "cast(doc_id % 7 + 1 as int) as counted", "1 as tokens")
    mix = Mix(entropy=0.9, max_epochs=None, block_tokens=500)
    got = mixing.mixed_order(docs, mix, token_col="counted").collect()
    sums = Counter()
    for r in docs.collect():
        sums[r.source] += r.counted
    frame = spark.createDataFrame(list(sums.items()), "source string, tokens long")
    alpha = mixing.bisect_exponent(frame, mix)
    z = sum((n / sum(sums.values())) ** alpha for n in sums.values())
    for name, n in sums.items():
        weight = (n / sum(sums.values())) ** alpha / z
        assert abs(next(r.weight for r in got if r.source == name) - weight) < 1e-9
        epochs = (n / max(sums.values())) ** (alpha - 1)
        spent = sorted(((r.epoch, r.place, r.tokens) for r in got if r.source == name))
        assert 0 <= sum(t for _, _, t in spent) - n * epochs < 8
        before = 0
        for _, place, tokens in sorted(spent, key=lambda x: x[1]):
            assert abs(place - before / (n * epochs)) < 1e-9
            before += tokens
    none = docs.withColumn("counted", docs.counted * 0 - 1)
    assert {r.place for r in mixing.mixed_order(none, mix, token_col="counted").collect()} == {0.0}


def test_odd_documents(spark):
    rows = [(i, t, s) for (i, t), s in zip(odd_rows(), ["a", None, "a", "b", "c", None, "c"] * 9)]
    docs = documents(spark, rows)
    out = mixing.mix_documents(docs).collect()
    once, many = Counter((i, t, s) for i, t, s in rows), Counter((r.doc_id, r.text, r.source) for r in out)
    assert set(many) == set(once) and all(many[k] >= once[k] for k in once)
    assert mixing.mix_documents(docs.limit(0)).count() == 0
    assert mixing.mixed_order(docs.limit(0)).count() == 0
    assert mixing.mix_documents(docs.where("text = ''")).count() == 1


def test_registered_query(spark):
    rows = op2_mixing(spark, SF).collect()
    ids = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    assert {r.doc_id for r in rows} == ids
    assert abs(sum({r.source: r.weight for r in rows}.values()) - 1) < 1e-9
    assert max(Counter(r.doc_id for r in rows).values()) <= 2
