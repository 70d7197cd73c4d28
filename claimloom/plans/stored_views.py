"""Intermediate relations as stored views: the plans' rules as one SELECT each.

A stored view outlives the session and is read by name, as SQL users expect. It is computed when it
is read. Renames, amounts, contracts and ranking columns are the plans' own constants; each SELECT has
the shape of its plan: windows over one partitioning, no join. A view keeps a hot claim in one task,
which spills; the build's own path for hot claims needs what a stored text can not have, a look
at the data before the plan is made. The number of partitions by claim is in the text: it follows
from the lines that were there when the view was stored, and does not change the rows.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable, Mapping

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession
from pyspark.sql import types as T

from claimloom.functions.codes import NO_CODE
from claimloom.functions.ids import NPI_DIGITS, NPI_LUHN_PREFIX
from claimloom.operators.snapshot import newest_with_rows
from claimloom.payer import DEFAULT_PROFILE, PayerProfile
from claimloom.plans import medical, members, pharmacy
from claimloom.plans.build import FINALIZE, intermediate_name, staging_views
from claimloom.schemas import ELIGIBILITY, MEDICAL_CLAIM, PHARMACY_CLAIM, PROVIDER_ATTRIBUTION
from claimloom.sources.tables import (
    HMO_MEMBER,
    MEDICAL_CLAIMS,
    PHARMACY_CLAIMS,
    PPO_MEMBER,
    database_of,
    literal,
)

MEMBER_KEY = "concat(cursubid, bcmbrnbr)"


def _number(text: str) -> str:
    return f"CASE WHEN octet_length({text}) > 0 THEN try_cast({text} AS DOUBLE) END"


def _npi(column: str) -> str:
    digits = f"regexp_replace({column}, '[^0-9]', '')"
    holds = f"luhn_check(concat({literal(NPI_LUHN_PREFIX)}, {digits}))"
    return f"CASE WHEN length({digits}) = {NPI_DIGITS} AND {holds} THEN {digits} END"


def _is_yes(flag: str) -> str:
    return f"coalesce(upper({flag}) = 'Y', false)"


def _is_filled(column: str) -> str:
    return f"coalesce(trim({column}) <> '', false)"


def _both_signs(lowest: str, highest: str) -> str:
    return f"coalesce({lowest} < 0 AND {highest} > 0, false)"


def _named(columns: Mapping[str, str]) -> str:
    return ", ".join(f"{value} AS {name}" for name, value in columns.items())


def _ranked(prefer: Iterable[str], columns: Iterable[str]) -> str:
    """Highest first, NULL last, and all other columns on ties."""
    order = [*prefer, *(c for c in columns if c not in prefer)]
    return ", ".join(f"{c} DESC NULLS LAST" for c in order)


def _fitted(schema: T.StructType, values: Mapping[str, str], known: Iterable[str]) -> str:
    """The contract's columns in order, each from ``values``, of that name, or a typed NULL."""
    own = set(known)
    return ", ".join(
        f"CAST({values.get(f.name, f.name if f.name in own else 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}"
        for f in schema
    )


def _identity(profile: PayerProfile) -> dict[str, str]:
    return {
        "person_id": f"concat({literal(profile.person_prefix)}, member_id)",
        "payer": literal(profile.payer),
        "payer_type": literal(profile.payer_type),
        "data_source": literal(profile.data_source),
        "x_market": literal(profile.market),
    }


def _of(schema: T.StructType, values: Mapping[str, str]) -> dict[str, str]:
    return {name: value for name, value in values.items() if name in schema.names}


def _newest(relation: str) -> str:
    return f"SELECT * FROM {relation} WHERE date_id = (SELECT max(date_id) FROM {relation})"


def medical_claims(
    staged: str, profile: PayerProfile = DEFAULT_PROFILE, partitions: int | None = None
) -> str:
    """The SELECT of ``plans.medical.intermediate_medical_claims``, in so many partitions by claim,
    or the reading session's own number."""
    number = "" if partitions is None else f"{partitions}, "
    lines = {
        **medical.RENAMED,
        **{raw: raw for raw in medical.READ_LATER},
        **{new: _number(raw) for new, raw in medical.AMOUNTS.items()},
        "member_id": MEMBER_KEY,
        "service_unit_quantity": _number("coalesce(srv_units, dw_srv_units)"),
        "hcpcs_code": f"nullif(coalesce(hcpcs_proc_cd, cpt_proc_cd), {literal(NO_CODE)})",
        "total_cost_amount": " + ".join(map(_number, ("dw_mem_liab_amt", "netpay", "cobamt"))),
        "_current": _is_yes("curr_clm_ind"),
    }
    rest = [c for c in lines if c not in medical.DECIDING]
    keys = (medical.CLAIM, medical.LINE)
    ranking = _ranked(medical.VERSION_ORDER, [c for c in (*medical.DECIDING, "_rest") if c not in keys])
    code = f"nullif(revenue_cd, {literal(NO_CODE)})"
    values = _of(MEDICAL_CLAIM, _identity(profile)) | {
        "claim_type": """CASE WHEN claim_id IS NOT NULL AND NOT _any_reversed THEN CASE
            WHEN _claim_bill THEN 'institutional' WHEN _claim_place THEN 'professional'
            ELSE 'undetermined' END END""",
        "claim_start_date": "coalesce(_claim_first, claim_line_start_date)",
        "claim_end_date": "coalesce(_claim_last, claim_line_start_date)",
        "revenue_center_code": f"CASE WHEN length({code}) = 3 THEN concat('0', {code}) ELSE {code} END",
        "diagnosis_code_type": "CASE icd_subm_ind WHEN '10' THEN 'icd-10-cm' WHEN '9' THEN 'icd-9-cm' END",
        "in_network_flag": "CASE dw_netwk_ind WHEN 'Y' THEN 1 WHEN 'N' THEN 0 END",
        "drg_code_type": "CASE WHEN drg_code IS NOT NULL THEN 'ms-drg' END",
        "procedure_code_type": "CASE WHEN procedure_code_1 IS NOT NULL THEN 'icd-10-pcs' END",
    }
    ids = medical.CHECKED_IDS
    passes = " AND ".join(f"({raw} IS NULL OR {npi} IS NOT NULL)" for npi, raw in ids.items())
    return f"""
WITH snapshot AS ({_newest(staged)}),
lines AS (SELECT {_named(lines)} FROM snapshot),
packed AS (SELECT /*+ REPARTITION({number}claim_id) */ {", ".join(medical.DECIDING)}, struct({", ".join(rest)}) AS _rest FROM lines),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY claim_id, claim_line_number ORDER BY {ranking}) AS _rank,
    {_both_signs("min(allowed_amount) OVER line", "max(allowed_amount) OVER line")} AS _reversed,
    min(CASE WHEN _current THEN claim_line_start_date END) OVER line AS _first,
    max(CASE WHEN _current THEN claim_line_start_date END) OVER line AS _last,
    max({_is_filled("bill_type_code")}) OVER line AS _bill,
    max({_is_filled("place_of_service_code")}) OVER line AS _place
  FROM packed WINDOW line AS (PARTITION BY claim_id, claim_line_number)),
winners AS (
  SELECT *, {_named({npi: _npi(raw) for npi, raw in ids.items()})},
    _reversed AND claim_id IS NOT NULL AND claim_line_number IS NOT NULL AS _dropped
  FROM ranked WHERE _rank = 1),
claims AS (
  SELECT *, max(_reversed) OVER claim AS _any_reversed,
    max(_bill) OVER claim AS _claim_bill, max(_place) OVER claim AS _claim_place,
    min(CASE WHEN NOT _dropped THEN _first END) OVER claim AS _claim_first,
    max(CASE WHEN NOT _dropped THEN _last END) OVER claim AS _claim_last
  FROM winners WINDOW claim AS (PARTITION BY claim_id)),
kept AS (SELECT *, _rest.* FROM claims WHERE NOT _dropped AND {passes})
SELECT {_fitted(MEDICAL_CLAIM, values, [*lines, *ids])} FROM kept"""


def pharmacy_claims(staged: str, profile: PayerProfile = DEFAULT_PROFILE) -> str:
    """The SELECT of ``plans.pharmacy.intermediate_pharmacy_claims``.

    NOT IN as there: a key's own signs, those of the rows without a key, and, for the sake of
    such rows only, whether anything was reversed.
    """
    rows = {
        **pharmacy.RENAMED,
        **{new: _number(raw) for new, raw in pharmacy.NUMBERS.items()},
        "member_id": MEMBER_KEY,
        "refills": "try_cast(num_refills AS INT)",
        "_current": _is_yes("rx_curr_clm_ind"),
    }
    rest = [c for c in rows if c not in pharmacy.DECIDING]
    others = [c for c in (*pharmacy.DECIDING, "_rest") if c != pharmacy.CLAIM]
    signs = _both_signs(f"min({pharmacy.AMOUNT})", f"max({pharmacy.AMOUNT})")
    values = _of(PHARMACY_CLAIM, _identity(profile)) | {
        "claim_line_number": "1",
        "prescribing_provider_npi": _npi("prescribing_provider_npi"),
    }
    return f"""
WITH snapshot AS ({_newest(staged)}),
lines AS (SELECT {_named(rows)} FROM snapshot),
packed AS (SELECT {", ".join(pharmacy.DECIDING)}, struct({", ".join(rest)}) AS _rest FROM lines),
ranked AS (
  SELECT *, row_number() OVER (
      PARTITION BY claim_id ORDER BY {_ranked(pharmacy.VERSION_ORDER, others)}) AS _rank,
    {_both_signs(f"min({pharmacy.AMOUNT}) OVER claim", f"max({pharmacy.AMOUNT}) OVER claim")} AS _reversed
  FROM packed WINDOW claim AS (PARTITION BY claim_id)),
kept AS (
  SELECT *, _rest.* FROM ranked
  WHERE _rank = 1 AND ndc_code IS NOT NULL AND NOT _reversed AND CASE
    WHEN claim_id IS NULL THEN NOT (
      SELECT count(*) > 0 FROM (
        SELECT claim_id FROM lines
        WHERE claim_id IS NOT NULL AND (SELECT count(*) > 0 FROM lines WHERE claim_id IS NULL)
        GROUP BY claim_id HAVING {signs}))
    ELSE NOT (SELECT {signs} FROM lines WHERE claim_id IS NULL) END)
SELECT {_fitted(PHARMACY_CLAIM, values, rows)} FROM kept"""


def _months(hmo: str, ppo: str, newest_only: bool, names: dict[str, str], group: list[str], prefer: list[str]) -> str:
    """The best row of each group of both feeds, as ``picked``."""
    newest = "date_id = (SELECT max(date_id) FROM feeds) AND" if newest_only else ""
    return f"""
WITH feeds AS (SELECT *, 'HMO' AS plan FROM {hmo} UNION ALL SELECT *, 'PPO' AS plan FROM {ppo}),
months AS (
  SELECT {_named(names)} FROM feeds
  WHERE {newest} cursubid IS NOT NULL AND bcmbrnbr IS NOT NULL),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY {", ".join(group)} ORDER BY {_ranked(prefer, names)}) AS _rank
  FROM months),
picked AS (SELECT * FROM ranked WHERE _rank = 1)"""


def member_eligibility(hmo: str, ppo: str, profile: PayerProfile = DEFAULT_PROFILE) -> str:
    """The SELECT of ``plans.members.intermediate_member_eligibility``."""
    names = {
        **members.ELIGIBILITY_RENAMED,
        "member_id": MEMBER_KEY,
        "gender": "CASE upper(mem_gender) WHEN 'M' THEN 'male' WHEN 'F' THEN 'female' ELSE 'unknown' END",
        "_month": "trunc(mem_mth_st_dt, 'MM')",
    }
    prefer = ["x_mem_mth_cnt", "enrollment_end_date", "ingest_datetime", "file_name"]
    # The payer delivers no date of death, so the flag that follows from it is always 0.
    values = _of(ELIGIBILITY, _identity(profile)) | {
        "subscriber_id": "member_id", "death_flag": "0", "x_program_type": "plan",
    }
    return f"""{_months(hmo, ppo, True, names, ["member_id", "_month"], prefer)}
SELECT {_fitted(ELIGIBILITY, values, names)} FROM picked"""


def provider_attribution(hmo: str, ppo: str, profile: PayerProfile = DEFAULT_PROFILE) -> str:
    """The SELECT of ``plans.members.intermediate_provider_attribution``."""
    names = {
        **members.ATTRIBUTION_RENAMED,
        "member_id": MEMBER_KEY,
        "year_month": "date_format(mem_mth_st_dt, 'yyyyMM')",
    }
    prefer = ["file_date", "member_term_date", "ingest_datetime", "file_name"]
    lob = literal(profile.line_of_business)
    values = _of(PROVIDER_ATTRIBUTION, _identity(profile)) | {
        "patient_id": "member_id",
        "payer_attributed_provider": _npi("payer_attributed_provider"),
        "payer_attributed_provider_lob": lob,
        "custom_attributed_provider_lob": lob,
        "x_program_type": "plan",
    }
    return f"""{_months(hmo, ppo, False, names, ["member_id", "plan", "year_month"], prefer)}
SELECT {_fitted(PROVIDER_ATTRIBUTION, values, names)} FROM picked"""


def intermediate_selects(
    staging_database: str, profile: PayerProfile = DEFAULT_PROFILE, by_claim: int | None = None
) -> dict[str, str]:
    """The SELECT of each output's intermediate relation, over the stored staging views.

    ``by_claim`` is the number of partitions of medical lines, if not the session's own."""
    stg = {raw: f"`{staging_database}`.{name}" for name, (raw, _) in staging_views(profile).items()}
    feeds = stg[HMO_MEMBER], stg[PPO_MEMBER]
    return {
        "eligibility": member_eligibility(*feeds, profile),
        "provider_attribution": provider_attribution(*feeds, profile),
        "medical_claim": medical_claims(stg[MEDICAL_CLAIMS], profile, by_claim),
        "pharmacy_claim": pharmacy_claims(stg[PHARMACY_CLAIMS], profile),
    }


def _partitions_by_claim(spark: SparkSession, staging_database: str, profile: PayerProfile) -> int | None:
    """What the newest medical lines ask for. Lines that can not be read are left to the reader."""
    [staged] = [name for name, (raw, _) in staging_views(profile).items() if raw == MEDICAL_CLAIMS]
    try:
        _, rows = newest_with_rows(spark.read.table(f"`{staging_database}`.{staged}"))
    except PySparkException:
        return None
    return medical.partitions_by_claim(spark, rows)


def store_intermediate_views(
    spark: SparkSession,
    staging_layer: str,
    layer: str,
    profile: PayerProfile = DEFAULT_PROFILE,
    outputs: Collection[str] = tuple(FINALIZE),
) -> dict[str, str]:
    """Stored views over the stored staging views; returns their qualified names by output.

    The newest medical lines are counted, by one pass over their dates: store the views anew when
    the table has grown by much, or large tasks spill.
    A table of such a name (from a build that stored its intermediate rows) is not replaced:
    Spark raises.
    """
    database = database_of(spark, layer)
    spark.sql("CREATE DATABASE IF NOT EXISTS IDENTIFIER(:db)", args={"db": database})
    stored = {}
    staging = database_of(spark, staging_layer)
    by_claim = _partitions_by_claim(spark, staging, profile) if "medical_claim" in outputs else None
    selects = intermediate_selects(staging, profile, by_claim)
    for output in outputs:
        stored[output] = f"{database}.{intermediate_name(output, profile)}"
        spark.sql(f"CREATE OR REPLACE VIEW IDENTIFIER(:v) AS {selects[output]}", args={"v": stored[output]})
    return stored


def drop_intermediate_views(spark: SparkSession, layer: str, profile: PayerProfile = DEFAULT_PROFILE) -> None:
    """Make room for stored tables under the views' names; tables stay."""
    for output in FINALIZE:
        name = f"{database_of(spark, layer)}.{intermediate_name(output, profile)}"
        if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "VIEW":
            spark.sql("DROP VIEW IDENTIFIER(:v)", args={"v": name})
