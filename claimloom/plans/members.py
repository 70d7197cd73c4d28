"""Member months: eligibility and provider attribution, both from the HMO and PPO feeds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions import codes
from claimloom.functions.ids import member_key, person_id, valid_npi
from claimloom.operators.conform import conform, renamed
from claimloom.operators.pick import pick_current
from claimloom.operators.quality import SAME_KEY, with_same_key
from claimloom.operators.snapshot import latest_snapshot
from claimloom.operators.union import tagged_union
from claimloom.payer import DEFAULT_PROFILE, PayerProfile
from claimloom.schemas import ELIGIBILITY, PROVIDER_ATTRIBUTION

FULL_MONTH = 1

# Raw column of each output column that is only renamed.
_LINEAGE = {"file_name": "filename", "file_date": "date_id", "ingest_datetime": "_run_time"}
ELIGIBILITY_RENAMED = {
    "plan": "plan",
    "birth_date": "mem_birth_dt",
    "enrollment_start_date": "mem_mth_st_dt",
    "enrollment_end_date": "mem_mth_end_dt",
    "first_name": "mem_first_name",
    "last_name": "mem_last_name",
    "address": "mem_street",
    "city": "mem_city",
    "state": "mem_state",
    "zip_code": "mem_zip_cd",
    "phone": "mem_phone_num",
    "x_mem_mth_cnt": "mem_mth_cnt",
    **_LINEAGE,
}
ATTRIBUTION_RENAMED = {
    "plan": "plan",
    "member_effective_date": "mem_mth_st_dt",
    "member_term_date": "mem_mth_end_dt",
    "payer_attributed_provider": "pcp_npi",
    **_LINEAGE,
}


def member_feeds(hmo: DataFrame, ppo: DataFrame) -> DataFrame:
    """Both staged feeds, ``plan`` telling which one a row came from."""
    return tagged_union({"HMO": hmo, "PPO": ppo}, "plan")


def _keyed(feeds: DataFrame, names: dict[str, str], computed: dict[str, Column]) -> DataFrame:
    """Rows that have a member key, cut down to the columns the output needs."""
    has_key = F.col("cursubid").isNotNull() & F.col("bcmbrnbr").isNotNull()
    return renamed(feeds.where(has_key), names, {"member_id": member_key()} | computed)


def intermediate_member_eligibility(
    feeds: DataFrame,
    profile: PayerProfile = DEFAULT_PROFILE,
    full_months_only: bool = False,
    newest: dt.date | None = None,
    count_keys: bool = False,
) -> DataFrame:
    """One row per member and month of the newest file date over both feeds.

    Prefers the highest month count, then the latest end, then the latest ingestion.

    ``full_months_only`` is for callers that go on to ``eligibility``: as the choice prefers the
    highest count, rows below one can never lead to a full month and are dropped at the scan,
    before the shuffle. Rows above one still take part: they hide their month. ``count_keys`` adds
    how many rows of ``eligibility`` have the row's key (``SAME_KEY``).
    """
    months = _keyed(
        latest_snapshot(feeds, newest=newest), ELIGIBILITY_RENAMED, {"gender": codes.gender("mem_gender")}
    )
    if full_months_only:
        months = months.where(F.col("x_mem_mth_cnt") >= FULL_MONTH)
    group = ["member_id", "_month"]
    picked = pick_current(
        months.withColumn("_month", F.trunc("enrollment_start_date", "MM")),
        group,
        [F.col("x_mem_mth_cnt"), F.col("enrollment_end_date"), F.col("ingest_datetime")],
        ["file_name"],
    )
    if count_keys:
        span = ["enrollment_start_date", "enrollment_end_date"]
        picked = with_same_key(picked, group, span, F.col("x_mem_mth_cnt").eqNullSafe(FULL_MONTH))
    return conform(
        picked.withColumn("death_date", F.lit(None).cast("date")),
        ELIGIBILITY,
        {
            "person_id": person_id(profile, "member_id"),
            "subscriber_id": F.col("member_id"),
            "ingest_datetime": F.col("ingest_datetime").cast("timestamp"),
            "death_flag": F.when(F.col("death_date").isNotNull(), 1).otherwise(0),
            "payer": F.lit(profile.payer),
            "payer_type": F.lit(profile.payer_type),
            "data_source": F.lit(profile.data_source),
            "x_program_type": F.col("plan"),
            "x_market": F.lit(profile.market),
        },
        [SAME_KEY] if count_keys else [],
    )


def eligibility(intermediate: DataFrame) -> DataFrame:
    """Final table: members whose chosen row of a month covers exactly the full month."""
    full_months = intermediate.where(
        F.col("person_id").isNotNull()
        & F.col("member_id").isNotNull()
        & (F.col("x_mem_mth_cnt") == FULL_MONTH)
    )
    return conform(full_months, ELIGIBILITY)


def intermediate_provider_attribution(
    feeds: DataFrame, profile: PayerProfile = DEFAULT_PROFILE, count_keys: bool = False
) -> DataFrame:
    """One row per member, plan and month over all file dates, newest file first."""
    months = _keyed(
        feeds,
        ATTRIBUTION_RENAMED,
        {"year_month": codes.year_month("mem_mth_st_dt")},
    )
    group = ["member_id", "plan", "year_month"]
    picked = pick_current(
        months,
        group,
        [F.col("file_date"), F.col("member_term_date"), F.col("ingest_datetime")],
        ["file_name"],
    )
    if count_keys:
        picked = with_same_key(picked, group)
    return conform(
        picked,
        PROVIDER_ATTRIBUTION,
        {
            "person_id": person_id(profile, "member_id"),
            "patient_id": F.col("member_id"),
            # Checked once per month kept, not on every row of every cumulative delivery.
            "payer_attributed_provider": valid_npi("payer_attributed_provider"),
            "ingest_datetime": F.col("ingest_datetime").cast("timestamp"),
            "payer": F.lit(profile.payer),
            "data_source": F.lit(profile.data_source),
            "payer_attributed_provider_lob": F.lit(profile.line_of_business),
            "custom_attributed_provider_lob": F.lit(profile.line_of_business),
            "x_program_type": F.col("plan"),
            "x_market": F.lit(profile.market),
        },
        [SAME_KEY] if count_keys else [],
    )


def provider_attribution(intermediate: DataFrame) -> DataFrame:
    """Final table: rows that have a person."""
    return conform(intermediate.where(F.col("person_id").isNotNull()), PROVIDER_ATTRIBUTION)
