"""Hot keys: a few groups so large that one task must never hold them.

Grouping by key is safe whatever the skew, because Spark combines on the map side. Windows and
joins are not: they bring every row of a key to one task. The helpers here find the hot keys
and let a caller send them down a path made of partial aggregates and broadcast joins, while
all other keys take the one-shuffle path. Which path a key takes never changes a result.

How many keys can be hot is bounded: a hot key holds more than ``1/max_keys`` of all rows, so
there are fewer than ``max_keys`` of them, and a table with one row per hot key may be
broadcast. If none is hot, adaptive execution finds the list empty and drops the hot path
before it starts.

Hot keys are found without a count of every key. A task summarises its rows by a sketch of
frequent items, of bounded size however many keys there are; sketches merge. The merged one names
every key above its bound, and perhaps some below: those candidates alone are counted exactly.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


@dataclass(frozen=True)
class HotKeyRule:
    """A key is hot when it has more than ``min_rows`` rows and more than 1/max_keys of all."""

    min_rows: int = 500_000
    max_keys: int = 10_000

    @property
    def tracked(self) -> int:
        """Items that a sketch tracks, so that it names every key with 1/max_keys of all rows.

        A sketch of ``m`` slots (a power of two, three quarters of them filled) is wrong by at
        most 3.5/m of all rows, and names a key that has more than twice that.
        """
        return min(max(1000, math.ceil(0.75 * 7 * self.max_keys)), 1_000_000)


DEFAULT_RULE = HotKeyRule()
#: Tasks that merge the sketches of all others.
GROUPS = 256


def hot_candidates(df: DataFrame, keys: Sequence[str], rule: HotKeyRule = DEFAULT_RULE) -> DataFrame:
    """``item, total``: hashes of keys that may be hot, every hot key among them, and all rows.

    At most ``2 * rule.max_keys`` rows. What is shuffled is a sketch per task; they are merged in
    ``GROUPS`` tasks, then in one.
    """
    tracked = F.lit(rule.tracked)
    item = F.xxhash64(*keys)
    some = df.groupBy(F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("_group")).agg(
        F.call_function("approx_top_k_accumulate", item, tracked).alias("_sketch"),
        F.count("*").alias("_n"),
    )
    # Grouped, if by a constant: a global aggregate can not combine a partition without sketches.
    whole = some.groupBy(F.lit("all")).agg(
        F.call_function("approx_top_k_combine", "_sketch", tracked).alias("_sketch"),
        F.sum("_n").alias("total"),
    )
    # The estimate is never below the true number of rows.
    found = whole.select(F.explode(F.call_function("approx_top_k_estimate", "_sketch", tracked)).alias("c"), "total")
    return found.where(
        (F.col("c.count") > rule.min_rows) & (F.col("c.count") * rule.max_keys > F.col("total"))
    ).select("c.item", "total")


def hot_keys(df: DataFrame, keys: Sequence[str], rule: HotKeyRule = DEFAULT_RULE) -> DataFrame:
    """The hot key values, one row each, NULL included; fewer than ``rule.max_keys`` rows.

    Reads the key columns only: once for the sketches and, if there are candidates, once more to
    count those.
    """
    candidates = F.broadcast(hot_candidates(df, keys, rule))
    counts = (
        df.select(*keys)
        .join(candidates, F.xxhash64(*keys) == F.col("item"))
        .groupBy(*keys)
        .agg(F.count("*").alias("_n"), F.max("total").alias("_total"))
    )
    return counts.where(
        (F.col("_n") > rule.min_rows) & (F.col("_n") * rule.max_keys > F.col("_total"))
    ).select(*keys)


def rows_without(df: DataFrame, hot: DataFrame) -> DataFrame:
    """Rows whose key is not hot."""
    return df.alias("r").join(F.broadcast(hot).alias("h"), _same_key(hot.columns), "left_anti")


def rows_with(df: DataFrame, hot: DataFrame) -> DataFrame:
    """Rows whose key is hot."""
    return df.alias("r").join(F.broadcast(hot).alias("h"), _same_key(hot.columns), "left_semi")


def attach_broadcast(df: DataFrame, per_key: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the columns of a bounded one-row-per-key table, NULL keys matching NULL keys."""
    renamed = per_key.withColumnsRenamed({k: f"_h_{k}" for k in keys})
    match = [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in keys]
    return df.join(F.broadcast(renamed), match, "inner").drop(*(f"_h_{k}" for k in keys))


def with_group_facts(
    df: DataFrame,
    keys: Sequence[str],
    facts: dict[str, Column],
    rule: HotKeyRule = DEFAULT_RULE,
) -> DataFrame:
    """Add aggregates of each row's group to the row; a NULL key is a group like any other.

    Cold groups: one shuffle and a window. Hot groups: partial aggregates, then a broadcast of
    one row per hot key, so their rows stay where they are.
    """
    hot = hot_keys(df, keys, rule)
    window = Window.partitionBy(*keys)
    cold = rows_without(df, hot).select("*", *(f.over(window).alias(n) for n, f in facts.items()))
    hot_rows = rows_with(df, hot)
    hot_facts = hot_rows.groupBy(*keys).agg(*(f.alias(n) for n, f in facts.items()))
    return cold.unionByName(attach_broadcast(hot_rows, hot_facts, keys))


def left_join_facts(
    df: DataFrame, per_key: DataFrame, key: str, rule: HotKeyRule = DEFAULT_RULE
) -> DataFrame:
    """Left join a large one-row-per-key table onto rows that may be skewed on ``key``.

    A NULL key matches nothing. Cold keys meet in a shuffle join; hot keys, and rows without a
    key, are joined to a broadcast of at most ``rule.max_keys`` rows.
    """
    hot = hot_keys(df, [key], rule)
    cold = rows_without(df, hot).join(per_key, key, "left")
    few = rows_with(per_key, hot)
    return cold.unionByName(rows_with(df, hot).join(F.broadcast(few), key, "left"))


def _same_key(keys: Sequence[str]) -> Column:
    match = F.lit(True)
    for k in keys:
        match = match & F.col(f"r.{k}").eqNullSafe(F.col(f"h.{k}"))
    return match
