"""Claim type and claim date span."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.amounts import to_double
from claimloom.functions.codes import is_filled, is_yes
from claimloom.operators.reversal import has_both_signs, sign_facts
from claimloom.operators.skew import DEFAULT_RULE, HotKeyRule, left_join_facts, with_group_facts


def type_label(has_bill_type: str, has_place: str) -> Column:
    return (
        F.when(F.col(has_bill_type), "institutional")
        .when(F.col(has_place), "professional")
        .otherwise("undetermined")
    )


def type_facts(bill_type: str, place: str) -> dict[str, Column]:
    """What a line's versions say about the type of its claim; every version counts."""
    return {"_bill": F.max(is_filled(bill_type)), "_place": F.max(is_filled(place))}


def claim_type_facts() -> dict[str, Column]:
    """What a claim's lines say together, from their sign and type facts."""
    return {
        "_any_reversed": F.max(has_both_signs("_low", "_high")),
        "_claim_bill": F.max("_bill"),
        "_claim_place": F.max("_place"),
    }


def span_facts(current: Column, date: str) -> dict[str, Column]:
    """First and last date of a group's current rows."""
    current_date = F.when(current, F.col(date))
    return {"_first": F.min(current_date), "_last": F.max(current_date)}


def _named(facts: dict[str, Column]) -> list[Column]:
    return [fact.alias(name) for name, fact in facts.items()]


def classify_claims(
    df: DataFrame, claim: str, line: str, amount: str, bill_type: str, place: str
) -> DataFrame:
    """(claim, claim_type) of the claims that have no reversed line.

    Every line counts, current or not. NULL claims form a group that no reversal can match.
    Two grouped aggregates, no join: lines fold into claims.
    """
    lines = df.groupBy(claim, line).agg(
        *_named(sign_facts(to_double(amount)) | type_facts(bill_type, place))
    )
    return (
        lines.groupBy(claim)
        .agg(*_named(claim_type_facts()))
        .where(~F.col("_any_reversed") | F.col(claim).isNull())
        .select(claim, type_label("_claim_bill", "_claim_place").alias("claim_type"))
    )


def attach_claim_type(
    df: DataFrame, types: DataFrame, claim: str, rule: HotKeyRule = DEFAULT_RULE
) -> DataFrame:
    """Left join the claim types; a claim that was not classified gets NULL."""
    return left_join_facts(df, types, claim, rule)


def claim_span(
    df: DataFrame, claim: str, date: str, flag: str, rule: HotKeyRule = DEFAULT_RULE
) -> DataFrame:
    """Add first and last date of the claim's current lines.

    A claim without a current line falls back to each line's own date.
    """
    return with_group_facts(df, [claim], span_facts(is_yes(flag), date), rule).withColumns(
        {
            "claim_start_date": F.coalesce("_first", date),
            "claim_end_date": F.coalesce("_last", date),
        }
    ).drop("_first", "_last")
