"""Mixing sources to target weights by temperature, realised as budgeted permutations.

A source's weight is its token share to the power of an exponent, normalised. The exponent is
bisected: the largest one that reaches a target entropy, but no smaller than a limit on repetition
allows. A source's budget is its weight times the tokens of the mix. It is spent epoch by epoch:
whole permutations of its documents, then the head of one more. The mix is cut into blocks, and
every block has its share of every source's budget. Everything is DataFrame expressions; the
driver sees a few numbers per round of the bisection.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.shared import saved

#: Halvings of the bisection that one pass over the sources evaluates, and passes.
LEVELS, ROUNDS = 5, 6


@dataclass(frozen=True)
class Mix:
    """Targets of a mix.

    ``entropy``: share of the largest possible entropy of the weights. ``max_epochs``: how often a
    document may be repeated. ``tokens``: budget of the mix; None is the least at which every
    document of every source appears once. ``block_tokens``: size of the blocks of the mix.
    """

    entropy: float | None = 0.97
    max_epochs: float | None = 2.0
    tokens: int | None = None
    block_tokens: int = 4_000_000
    seed: int = 42


def _tokens(text_col: str, token_col: str | None) -> Column:
    """Tokens as counted in ``token_col``; else bytes of the text, the tokens of a byte-level model
    before merges."""
    counted = F.octet_length(F.col(text_col).cast("string")) if token_col is None else F.col(token_col)
    return F.greatest(F.coalesce(counted.cast("long"), F.lit(0).cast("long")), F.lit(0).cast("long"))


def _document(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), F.col(text_col))


def _key(seed: int, epoch: Column, document: Column) -> Column:
    """Place of a document in the permutation of an epoch, 0 to 2^63 - 1."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), epoch.cast("long"), document), 1)


def bisect_exponent(totals: DataFrame, mix: Mix) -> float:
    """The exponent in [0, 1] for ``totals`` (``source, tokens``); 1 keeps the shares.

    A target no exponent reaches gives the end of the range that comes closest.
    """
    positive = totals.where("tokens > 0")
    all_tokens, largest, sources = positive.agg(
        F.sum("tokens"), F.max("tokens"), F.count(F.lit(1))
    ).first()
    if not sources:
        return 1.0
    share = F.col("tokens") / F.lit(float(all_tokens))
    most = largest / all_tokens

    def repeats(alpha: float, z: float, least: float) -> float:
        """Epochs of the smallest source."""
        scale = 1.0 if mix.tokens is None else mix.tokens / all_tokens / z * most ** (alpha - 1)
        return scale * (least / most) ** (alpha - 1)

    def measured(alphas: list[float]) -> list[tuple[float, float]]:
        """Entropy and greatest epochs by exponent, in one pass."""
        row = positive.agg(
            F.min(share).alias("least"),
            *(F.sum(F.pow(share, F.lit(a))).alias(f"z{n}") for n, a in enumerate(alphas)),
            *(
                F.sum(F.pow(share, F.lit(a)) * F.log(share) * a).alias(f"e{n}")
                for n, a in enumerate(alphas)
            ),
        ).first()
        return [
            (math.log(row[f"z{n}"]) - row[f"e{n}"] / row[f"z{n}"], repeats(a, row[f"z{n}"], row["least"]))
            for n, a in enumerate(alphas)
        ]

    def bisect(holds, low_holds: bool) -> float:
        """The border between exponents; the end returned is on the side that holds."""
        low, high = 0.0, 1.0
        at_low, at_high = (holds(*m) for m in measured([low, high]))
        if at_low == at_high:  # all of the range holds, or none of it
            return high if low_holds == at_low else low
        for _ in range(ROUNDS):
            cells = 2**LEVELS
            alphas = [low + (high - low) * k / cells for k in range(1, cells)]
            held = [holds(*m) for m in measured(alphas)]
            a, b = 0, cells
            while b - a > 1:
                middle = (a + b) // 2
                a, b = (middle, b) if held[middle - 1] == low_holds else (a, middle)
            low, high = low + (high - low) * a / cells, low + (high - low) * b / cells
        return low if low_holds else high

    alpha = 0.0
    if mix.entropy is not None:
        alpha = bisect(lambda h, _: h >= mix.entropy * math.log(sources), low_holds=True)
    if mix.max_epochs is not None:
        alpha = max(alpha, bisect(lambda _, e: e <= mix.max_epochs, low_holds=False))
    return alpha


def plan_mix(
    docs: DataFrame, mix: Mix, id_col: str, text_col: str, source_col: str, token_col: str | None = None
) -> DataFrame:
    """``source, tokens, docs, weight, epochs, whole, cut``, one row per source, stored.

    A source gives ``whole`` epochs and, of one more, the documents whose key is at most ``cut``.
    """
    keyed = saved(
        docs.select(
            F.col(source_col).cast("string").alias("source"),
            _tokens(text_col, token_col).alias("tokens"),
            _document(id_col, text_col).alias("document"),
        ),
        "keyed",
    )
    totals = saved(
        keyed.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")),
        "totals",
    )
    alpha = bisect_exponent(totals, mix)
    most, all_tokens, docs_most = totals.agg(F.max("tokens"), F.sum("tokens"), F.max("docs")).first()
    share = F.col("tokens") / F.lit(float(all_tokens or 1))
    z = totals.where("tokens > 0").agg(F.sum(F.pow(share, F.lit(alpha)))).first()[0] or 1.0
    scale = 1.0
    if mix.tokens is not None and most:
        scale = mix.tokens / all_tokens / z * (most / all_tokens) ** (alpha - 1)
    relative = F.col("tokens") / F.lit(float(most or 1))
    empty = F.col("tokens") <= 0
    weighted = totals.select(
        "source",
        "tokens",
        "docs",
        F.when(empty, 0.0).otherwise(F.pow(share, F.lit(alpha)) / F.lit(z)).alias("weight"),
        F.when(empty, 1.0).otherwise(F.pow(relative, F.lit(alpha - 1)) * scale).alias("epochs"),
    ).select("*", F.floor("epochs").alias("whole"))
    wanted = weighted.select(
        F.col("source").alias("of"),
        "whole",
        ((F.col("epochs") - F.col("whole")) * F.col("tokens")).alias("wanted"),
    ).where("wanted > 0")
    # Blocks of the last epoch's permutation: sums first, then the rows of the block that is cut.
    bits = max(1, math.ceil(math.log2(max(docs_most or 1, 2)) / 2))
    last = (
        keyed.join(wanted, F.col("source").eqNullSafe(F.col("of")))
        .select("source", "tokens", "wanted", _key(mix.seed, F.col("whole"), F.col("document")).alias("key"))
        .withColumn("block", F.shiftright("key", 63 - bits))
    )
    by_block = Window.partitionBy("source").orderBy("block")
    cut_block = (
        last.groupBy("source", "wanted", "block")
        .agg(F.sum("tokens").alias("n"))
        .select("source", "block", "wanted", (F.sum("n").over(by_block) - F.col("n")).alias("before"))
        .where("before < wanted")
        .groupBy(F.col("source").alias("of"))
        .agg(F.max(F.struct("block", "before")).alias("c"))
    )
    in_cut = F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("c.block"))
    by_key = Window.partitionBy("source").orderBy("key").rangeBetween(Window.unboundedPreceding, -1)
    cuts = (
        last.join(cut_block, in_cut)
        .withColumn("start", F.col("c.before") + F.coalesce(F.sum("tokens").over(by_key), F.lit(0)))
        .where("start < wanted")
        .groupBy(F.col("source").alias("of"))
        .agg(F.max("key").alias("cut"))
    )
    plan = weighted.join(cuts, F.col("source").eqNullSafe(F.col("of")), "left").select(
        "source", "tokens", "docs", "weight", "epochs", "whole", F.coalesce("cut", F.lit(-1)).alias("cut")
    )
    return saved(plan, "plan")


def realise(
    docs: DataFrame, plan: DataFrame, mix: Mix, id_col: str, text_col: str, source_col: str
) -> DataFrame:
    """``docs`` as often as the plan says, with ``__mix``: ``epoch``, ``key`` (the place in that
    epoch's permutation), ``weight`` and ``budget`` of the source."""
    joined = docs.join(
        plan.select(F.struct("*").alias("__plan")),
        F.col(source_col).cast("string").eqNullSafe(F.col("__plan.source")),
    )
    document = _document(id_col, text_col)
    one_more = (_key(mix.seed, F.col("__plan.whole"), document) <= F.col("__plan.cut")).cast("long")
    copies = F.col("__plan.whole") + one_more
    epochs = F.when(copies > 0, F.sequence(F.lit(0).cast("long"), copies - 1))
    copied = joined.withColumn("__epoch", F.explode(epochs))
    return copied.select(
        *(docs[c] for c in docs.columns),
        F.struct(
            F.col("__epoch").alias("epoch"),
            _key(mix.seed, F.col("__epoch"), document).alias("key"),
            F.col("__plan.weight").alias("weight"),
            (F.col("__plan.tokens") * F.col("__plan.epochs")).alias("budget"),
        ).alias("__mix"),
    )


def _starts(copies: DataFrame, bits: int) -> DataFrame:
    """``copies`` (``source, epoch, key, tokens``) with ``start``: tokens of the source before it.

    Two levels: sums of runs of keys, then the rows of a run. A source of ``n`` copies has about
    ``sqrt(n)`` runs of ``sqrt(n)`` copies, so a source of any size is many tasks.
    """
    runs = copies.withColumn("run", F.shiftright("key", 63 - bits))
    by_run = Window.partitionBy("source").orderBy("epoch", "run")
    before = (
        runs.groupBy("source", "epoch", "run").agg(F.sum("tokens").alias("n"))
        .select(
            F.col("source").alias("of"), F.col("epoch").alias("in_epoch"), F.col("run").alias("at"),
            (F.sum("n").over(by_run) - F.col("n")).alias("before"),
        )
    )
    same = (
        F.col("source").eqNullSafe(F.col("of")) & (F.col("epoch") == F.col("in_epoch")) & (F.col("run") == F.col("at"))
    )
    by_key = Window.partitionBy("source", "epoch", "run").orderBy("key").rangeBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("tokens").over(by_key), F.lit(0).cast("long"))
    return (
        runs.join(before, same)
        .withColumn("start", F.col("before") + inside)
        .drop("of", "in_epoch", "at", "before", "run")
    )


def mix_documents(
    docs: DataFrame,
    mix: Mix = Mix(),
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    token_col: str | None = None,
) -> DataFrame:
    """The mix as documents: every column of ``docs``, a row per copy. Tokens are those counted in
    ``token_col``, or else bytes of the text.

    Empty and NULL texts have no tokens and cost no budget; a source of those only is kept once.
    NULL is a source of its own. Repeated rows share their place in a permutation and are taken
    together. An empty table gives no rows.
    """
    plan = plan_mix(docs, mix, id_col, text_col, source_col, token_col)
    return realise(docs, plan, mix, id_col, text_col, source_col).drop("__mix")


def mixed_order(
    docs: DataFrame,
    mix: Mix = Mix(),
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    token_col: str | None = None,
) -> DataFrame:
    """``<id>, <source>, tokens, weight, epoch, place, block``: the mix as an order.

    ``place`` is the share of the source's budget spent before the copy; ordered by it, the mix
    has the target weights all the way. ``block`` numbers the blocks of ``block_tokens``: of
    every source a block has its weight, to within one document. Odd inputs as in
    ``mix_documents``; copies without tokens, and repeated rows, share a place.
    """
    plan = plan_mix(docs, mix, id_col, text_col, source_col, token_col)
    copies = realise(docs, plan, mix, id_col, text_col, source_col).select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("given"),
        F.col(source_col).cast("string").alias("source"),
        _tokens(text_col, token_col).alias("tokens"),
        "__mix.*",
    )
    budget, most = plan.agg(F.sum(F.col("tokens") * F.col("epochs")), F.max("docs")).first()
    blocks = max(1, math.ceil((budget or 0) / mix.block_tokens))
    bits = max(1, math.ceil(math.log2(max(most or 1, 2)) / 2))
    place = F.when(F.col("budget") > 0, F.least(F.col("start") / F.col("budget"), F.lit(1.0))).otherwise(0.0)
    return _starts(copies, bits).withColumn("place", place).select(
        F.col("id").alias(id_col),
        F.col("given").alias(source_col),
        "tokens",
        "weight",
        "epoch",
        "place",
        F.least(F.floor(F.col("place") * blocks), F.lit(blocks - 1).cast("long")).alias("block"),
    )
