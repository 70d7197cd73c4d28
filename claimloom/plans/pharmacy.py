"""Pharmacy claims: the current version of each claim that was not reversed.

A reversal removes a claim as a whole, so choosing the current version and detecting reversals
share one partitioning by claim: one wide shuffle, one sort, no join. Claims too large for one task
take a path of partial aggregates instead; both paths give the same rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimloom.functions.amounts import to_double, to_int, truncated
from claimloom.functions.codes import is_yes
from claimloom.functions.ids import member_key, person_id, valid_npi
from claimloom.operators.conform import conform, renamed
from claimloom.operators.pick import best, then_all_others
from claimloom.operators.quality import SAME_KEY, with_same_key
from claimloom.operators.reversal import (
    has_both_signs,
    is_any_reversed,
    kept_by_not_in,
    reversed_in,
    sign_facts,
)
from claimloom.operators.skew import DEFAULT_RULE, HotKeyRule, hot_keys, rows_with, rows_without
from claimloom.operators.snapshot import latest_snapshot
from claimloom.payer import DEFAULT_PROFILE, PayerProfile
from claimloom.schemas import PHARMACY_CLAIM

CLAIM = "claim_id"

# Raw column of each output column that is only renamed.
RENAMED = {
    "claim_id": "int_clm_num",
    "plan": "lob",
    "dispensing_provider_npi": "pharm_npi",
    "prescribing_provider_npi": "clm_pdea_npi",
    "dispensing_date": "svcdt",
    "ndc_code": "clm_ndc",
    "paid_date": "pddate",
    "file_name": "s3_path",
    "file_date": "date_id",
    "ingest_datetime": "_run_time",
}
# Raw text column of each number. The first two become whole numbers later.
NUMBERS = {
    "quantity": "metric_quantity",
    "days_supply": "days_supply",
    "paid_amount": "netpay",
    "allowed_amount": "paid",
    "charge_amount": "charge_amt",
    "coinsurance_amount": "coins_amt",
    "copayment_amount": "copay_amt",
    "deductible_amount": "deduct_amt",
}

AMOUNT = "allowed_amount"

# Which version of a claim is the current one: highest first, NULL last.
VERSION_ORDER = ("_current", "file_date", "ingest_datetime", "file_name")
# Columns that decide on a claim.
DECIDING = (CLAIM, *VERSION_ORDER, AMOUNT, "ndc_code")


def read_claims(staged: DataFrame) -> DataFrame:
    """Row-local part. Provider identifiers are taken over as they are."""
    computed: dict[str, Column] = {new: to_double(raw) for new, raw in NUMBERS.items()}
    computed |= {
        "member_id": member_key(),
        "refills": to_int("num_refills"),
        "_current": is_yes("rx_curr_clm_ind"),
    }
    return renamed(staged, RENAMED, computed)


def pack(rows: DataFrame) -> DataFrame:
    """Columns that take part in the choice stay columns; all others travel as one struct.

    Shuffle, sort and window then copy the struct as a block of bytes, not field by field.
    """
    rest = [c for c in rows.columns if c not in DECIDING]
    return rows.select(*DECIDING, F.struct(*rest).alias("_rest"))


def _by_window(rows: DataFrame) -> DataFrame:
    """The best version of each claim with the signs of all; one shuffle, by claim."""
    ranking = then_all_others(rows.drop(CLAIM), VERSION_ORDER)
    by_claim = Window.partitionBy(CLAIM).orderBy(*map(F.desc_nulls_last, ranking))
    whole = by_claim.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        rows.select(
            "*",
            F.row_number().over(by_claim).alias("_rank"),
            *(fact.over(whole).alias(name) for name, fact in sign_facts(AMOUNT).items()),
        )
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def _by_aggregate(rows: DataFrame) -> DataFrame:
    """The same for few but huge claims, combined on the map side."""
    per_claim = rows.groupBy(CLAIM).agg(
        best(then_all_others(rows.drop(CLAIM), VERSION_ORDER)).alias("_row"),
        *(fact.alias(name) for name, fact in sign_facts(AMOUNT).items()),
    )
    return per_claim.select(CLAIM, "_row.*", *sign_facts(AMOUNT))


def _current_versions(rows: DataFrame, rule: HotKeyRule, count_keys: bool) -> DataFrame:
    """The best version of each claim, and whether the claim was reversed. Claims without a number
    are one claim here."""

    def counted(versions: DataFrame) -> DataFrame:
        # On each side of the union: there the rows are partitioned by claim.
        kept = F.col("ndc_code").isNotNull()
        return with_same_key(versions, [CLAIM], kept=kept) if count_keys else versions

    hot = hot_keys(rows, [CLAIM], rule)
    cold, few = _by_window(rows_without(rows, hot)), _by_aggregate(rows_with(rows, hot))
    return counted(cold).unionByName(counted(few)).withColumn("_reversed", has_both_signs("_low", "_high"))


def intermediate_pharmacy_claims(
    staged: DataFrame,
    profile: PayerProfile = DEFAULT_PROFILE,
    newest: dt.date | None = None,
    count_keys: bool = False,
    rule: HotKeyRule = DEFAULT_RULE,
) -> DataFrame:
    """Staged pharmacy claims to the output contract.

    Reversed claims are removed with the meaning of NOT IN. The winning version is chosen
    first; if it has no drug code its claim is gone.

    Claims without a number depend on whether anything was reversed. Their own signs are read with
    a test for NULL that reaches the Parquet reader; the pass that finds out about all others has
    "is there such a claim" among its filters, and where the table is partitioned by file date it
    opens no file if there is none. ``count_keys`` adds how many rows have the row's key
    (``SAME_KEY``).
    """
    rows = read_claims(latest_snapshot(staged, newest=newest))
    unnamed, named = rows.where(F.col(CLAIM).isNull()), rows.where(F.col(CLAIM).isNotNull())
    null_reversed = reversed_in(unnamed, AMOUNT)
    any_unnamed = unnamed.select(F.count("*") > 0).scalar()
    any_reversed = is_any_reversed(named.where(any_unnamed), [CLAIM], AMOUNT)
    versions = _current_versions(pack(rows), rule, count_keys)
    # NOT IN: a claim without a number is in no set, but passes an empty one only.
    passes = F.when(
        F.col(CLAIM).isNull(), ~F.col("_reversed") & ~any_reversed
    ).otherwise(kept_by_not_in("_reversed", null_reversed))
    winners = versions.where(passes).select("*", "_rest.*")
    return conform(
        winners.where(F.col("ndc_code").isNotNull()),
        PHARMACY_CLAIM,
        {
            # One row per claim is left, so numbering the lines of a claim always gives 1.
            "claim_line_number": F.lit(1),
            "person_id": person_id(profile, "member_id"),
            # Checked once per claim, not on every delivered row.
            "prescribing_provider_npi": valid_npi("prescribing_provider_npi"),
            "ingest_datetime": F.col("ingest_datetime").cast("timestamp"),
            "payer": F.lit(profile.payer),
            "payer_type": F.lit(profile.payer_type),
            # Strict casts: only after the choice, so that a discarded row can not fail the job.
            "quantity": truncated(F.col("quantity")),
            "days_supply": truncated(F.col("days_supply")),
            "data_source": F.lit(profile.data_source),
        },
        [SAME_KEY] if count_keys else [],
    )


def pharmacy_claim(intermediate: DataFrame) -> DataFrame:
    """Final table: the intermediate rows, none filtered."""
    return conform(intermediate, PHARMACY_CLAIM)
