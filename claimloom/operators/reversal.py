"""Reversals: a key whose amounts have both signs has been booked and taken back."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.amounts import to_double
from claimloom.operators.skew import DEFAULT_RULE, HotKeyRule, with_group_facts


def has_both_signs(lowest: str, highest: str) -> Column:
    """Zero and unreadable amounts are neutral; a key with no readable amount is not reversed."""
    return F.coalesce((F.col(lowest) < 0) & (F.col(highest) > 0), F.lit(False))


def sign_facts(amount: Column | str) -> dict[str, Column]:
    """What ``has_both_signs`` needs to know of a group."""
    return {"_low": F.min(amount), "_high": F.max(amount)}


def matches_reversal(keys: Sequence[str]) -> Column:
    """A row of a reversed key (NOT EXISTS fails): one with a NULL key matches nothing."""
    present = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    return has_both_signs("_low", "_high") & present


def reversed_keys(df: DataFrame, keys: Sequence[str], amount: str) -> DataFrame:
    """Keys that carry a negative and a positive amount; NULL keys group together."""
    facts = sign_facts(to_double(amount))
    return (
        df.groupBy(*keys)
        .agg(*(fact.alias(name) for name, fact in facts.items()))
        .where(has_both_signs("_low", "_high"))
        .select(*keys)
    )


def drop_reversed(
    df: DataFrame, keys: Sequence[str], amount: str, rule: HotKeyRule = DEFAULT_RULE
) -> DataFrame:
    """Rows with no reversed key equal to theirs (NOT EXISTS): a row with a NULL key stays.

    The signs of a key's amounts are attached to its rows, which takes one shuffle where an
    anti join takes two, and no hot key is gathered.
    """
    return (
        with_group_facts(df, keys, sign_facts(to_double(amount)), rule)
        .where(~matches_reversal(keys))
        .drop("_low", "_high")
    )


def reversed_in(group: DataFrame, amount: str) -> Column:
    """Whether the rows of one group, all of ``group``, have both signs; false for no rows."""
    signs = group.agg(*(fact.alias(name) for name, fact in sign_facts(amount).items()))
    return signs.select(has_both_signs("_low", "_high")).scalar()


def is_any_reversed(df: DataFrame, keys: Sequence[str], value: str) -> Column:
    """Whether any key of ``df`` has both signs; ``value`` is a number."""
    signs = df.groupBy(*keys).agg(*(fact.alias(name) for name, fact in sign_facts(value).items()))
    return signs.where(has_both_signs("_low", "_high")).select(F.count("*") > 0).scalar()


def kept_by_not_in(key_reversed: str, null_reversed: Column) -> Column:
    """What NOT IN asks of a row with a key: its key is not in the set, and no NULL is.

    ``null_reversed`` is a subquery. In this form, which Spark neither splits nor folds, it stays
    above the grouping and holds up no scan.
    """
    own = F.nullif(F.col(key_reversed), F.lit(False))
    return F.when(own, F.lit(False)).otherwise(~null_reversed)


def drop_reversed_not_in(
    df: DataFrame, key: str, amount: str, rule: HotKeyRule = DEFAULT_RULE
) -> DataFrame:
    """Rows whose key is NOT IN the reversed keys, with SQL's treatment of NULL.

    A NULL in the set empties the result; a row without a key passes only an empty set. Spark
    would plan NOT IN as a broadcast of the whole set. Here rows with a key are kept by the signs
    of their own group and one subquery over the rows without a key. Whether anything was reversed
    is asked for the sake of those rows only, and only if there are some.
    """
    valued = df.withColumn("_value", to_double(amount))
    unnamed, named = valued.where(F.col(key).isNull()), valued.where(F.col(key).isNotNull())
    null_reversed = reversed_in(unnamed, "_value")
    any_unnamed = unnamed.select(F.count("*") > 0).scalar()
    any_reversed = is_any_reversed(named.where(any_unnamed), [key], "_value")
    flagged = with_group_facts(named, [key], sign_facts("_value"), rule).withColumn(
        "_reversed", has_both_signs("_low", "_high")
    )
    kept = flagged.where(kept_by_not_in("_reversed", null_reversed))
    return kept.select(*df.columns).unionByName(
        unnamed.where(~null_reversed & ~any_reversed).select(*df.columns)
    )
