"""One current row per key.

Rows are ranked by the columns a caller prefers, highest first and NULL last, and then by all
their other columns. Rows that still tie are equal, so the choice is the same in every run,
whatever order the rows arrive in. The trailing columns are only ever compared on a tie.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimloom.operators.skew import (
    DEFAULT_RULE,
    HotKeyRule,
    attach_broadcast,
    hot_keys,
    rows_with,
    rows_without,
)
from claimloom.sources.shared import stored


def then_all_others(df: DataFrame, prefer: Sequence[str]) -> list[str]:
    """Columns in ranking order: the preferred ones, then the rest."""
    return [*prefer, *(c for c in df.columns if c not in prefer)]


def pick_current(
    df: DataFrame,
    keys: Sequence[Column | str],
    prefer: Sequence[Column],
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """The row of each key that ranks highest by ``prefer``, then ``tiebreak``.

    NULL keys form a group. Spark keeps only the top row per key and map task before the
    shuffle (``WindowGroupLimit``), so a hot key costs a row per task.
    """
    ranking = [*prefer, *then_all_others(df, tiebreak)]
    rank = F.row_number().over(
        Window.partitionBy(*keys).orderBy(*map(F.desc_nulls_last, ranking))
    )
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def best(ranking: Sequence[str]) -> Column:
    """Aggregate form of the same choice: a struct of the group's highest-ranking row.

    For grouped aggregation next to other aggregates; combines on the map side.
    """
    return F.max(F.struct(*ranking))


def number_lines(
    df: DataFrame, claim: str, order: Sequence[str], name: str, rule: HotKeyRule = DEFAULT_RULE
) -> DataFrame:
    """Number the rows of each claim by ``order``, then by all other columns, NULLs first.

    Claims of ordinary size take a window. The rows of hot claims are sorted by range into blocks,
    so that a claim of any size is many blocks; a row's number is the rows of its claim in the
    blocks before, plus its place in its own. Rows without a claim are a claim. Whether a claim is
    hot is looked up when this is called.
    """
    ranking = [F.asc_nulls_first(c) for c in then_all_others(df.drop(claim), order)]
    window = Window.partitionBy(claim).orderBy(*ranking)
    hot = hot_keys(df, [claim], rule)
    if hot.isEmpty():
        return df.withColumn(name, F.row_number().over(window))
    cold = rows_without(df, hot).withColumn(name, F.row_number().over(window))
    return cold.unionByName(_number_by_blocks(rows_with(df, hot), claim, ranking, name))


def _number_by_blocks(df: DataFrame, claim: str, ranking: list[Column], name: str) -> DataFrame:
    """Two-level prefix sums: rows before a block of a claim, and a row's place in the block.

    The sorted rows are written once, so that places and counts are of the same rows whatever
    task is run again. Counts are one row per block and hot claim in it: no more than there are
    blocks and hot claims together.
    """
    key = F.asc_nulls_first(claim)
    # Equal rows may lie in one block only if the last sort column is equal, so rows are dealt too.
    dealt = df.withColumn("_deal", F.monotonically_increasing_id())
    blocks = stored(
        dealt.repartitionByRange(key, *ranking, F.col("_deal").asc())
        .sortWithinPartitions(key, *ranking)
        .drop("_deal")
        .withColumns({"_block": F.spark_partition_id(), "_place": F.monotonically_increasing_id()}),
        "blocks",
    )
    counts = blocks.groupBy(claim, "_block").agg(F.count("*").alias("_n"), F.min("_place").alias("_start"))
    before = Window.partitionBy(claim).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    number = F.col("_before") + F.col("_place") - F.col("_start") + 1
    return (
        attach_broadcast(blocks, offsets, [claim, "_block"])
        .withColumn(name, number.cast("int"))
        .drop("_block", "_place", "_start", "_before")
    )
