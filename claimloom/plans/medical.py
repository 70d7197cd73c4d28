"""Medical claims: the current version of each line that was not reversed.

Shape of the plan. Renames and number reading are row-local and run before the shuffle, so that
the shuffle carries short typed values instead of raw text. Then each row
is shuffled once, by claim: reversal, version choice, claim type and claim span are windows over
that one partitioning, in place of four aggregates joined back together. Claims too large for
one task take a path of partial aggregates instead; both paths give the same rows.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimloom.functions import codes
from claimloom.functions.amounts import to_double, total_of
from claimloom.functions.ids import absent_or_valid, member_key, person_id, valid_npi
from claimloom.operators.classify import claim_type_facts, span_facts, type_facts, type_label
from claimloom.operators.conform import conform, renamed
from claimloom.operators.pick import best, then_all_others
from claimloom.operators.quality import SAME_KEY, with_same_key
from claimloom.operators.reversal import matches_reversal, sign_facts
from claimloom.operators.skew import (
    DEFAULT_RULE,
    HotKeyRule,
    attach_broadcast,
    hot_keys,
    rows_with,
    rows_without,
)
from claimloom.operators.snapshot import latest_snapshot, newest_with_rows
from claimloom.payer import DEFAULT_PROFILE, PayerProfile
from claimloom.schemas import MEDICAL_CLAIM
from claimloom.sources.shared import in_compiled_methods

CLAIM, LINE = "claim_id", "claim_line_number"
#: Lines that one task sorts by claim: some 300 MB of memory.
TASK_ROWS = 400_000

# Raw column of each output column that is only renamed.
RENAMED = {
    "claim_id": "int_clm_num",
    "claim_line_number": "clm_line_num",
    "plan": "lob",
    "claim_line_start_date": "svcdt",
    "admission_date": "admitdt",
    "discharge_date": "dischdt",
    "admit_source_code": "admit_source_cd",
    "admit_type_code": "type_admit_cd",
    "discharge_disposition_code": "disch_stat_cd",
    "place_of_service_code": "cms_place_srv_cd",
    "bill_type_code": "bill_type_cd",
    "drg_code": "drg_cd",
    **{f"hcpcs_modifier_{i}": f"cpt_pmod{i}_cd" for i in range(1, 4)},
    "paid_date": "pddate",
    **{f"diagnosis_code_{i}": f"icd_diag{i}_cd" for i in range(1, 11)},
    **{f"procedure_code_{i}": f"icd_proc{i}_cd" for i in range(1, 6)},
    "file_name": "s3_path",
    "file_date": "date_id",
    "ingest_datetime": "_run_time",
}
# Raw text column of each amount.
AMOUNTS = {
    "charge_amount": "charge_amt",
    "allowed_amount": "paid",
    "paid_amount": "netpay",
    "coinsurance_amount": "coins_amt",
    "copayment_amount": "copay_amt",
    "deductible_amount": "deduct_amt",
}
# Which version of a line is the current one: highest first, NULL last.
VERSION_ORDER = ("_current", "file_date", "ingest_datetime", "file_name")
# Raw columns carried along and read after the version choice, on fewer rows. Reading them
# earlier would not shorten them, and would push the code generated for the scan beyond the
# 8000 bytes per method that the JVM is willing to compile.
READ_LATER = ("revenue_cd", "icd_subm_ind", "dw_netwk_ind", "sprovnpi", "bprovnpi")
# Provider identifiers that drop their line when present and invalid.
CHECKED_IDS = {"rendering_npi": "sprovnpi", "billing_npi": "bprovnpi"}
# Columns that decide on a line or its claim.
DECIDING = (
    CLAIM,
    LINE,
    *VERSION_ORDER,
    "claim_line_start_date",
    "allowed_amount",
    "place_of_service_code",
    "bill_type_code",
    *CHECKED_IDS.values(),
)


def read_lines(staged: DataFrame) -> DataFrame:
    """Row-local part: every output column that depends on one raw row alone.

    Adds ``_current``, the line's current flag.
    """
    computed: dict[str, Column] = {new: to_double(raw) for new, raw in AMOUNTS.items()}
    computed |= {
        "member_id": member_key(),
        "service_unit_quantity": to_double(F.coalesce("srv_units", "dw_srv_units")),
        "hcpcs_code": codes.procedure_code("hcpcs_proc_cd", "cpt_proc_cd"),
        "total_cost_amount": total_of("dw_mem_liab_amt", "netpay", "cobamt"),
        "_current": codes.is_yes("curr_clm_ind"),
    }
    return renamed(staged, RENAMED | {raw: raw for raw in READ_LATER}, computed)


def pack(lines: DataFrame) -> DataFrame:
    """Columns that take part in the choice stay columns; all others travel as one struct.

    Shuffle, sort and windows then copy the struct as a block of bytes, not field by field.
    """
    rest = [c for c in lines.columns if c not in DECIDING]
    return lines.select(*DECIDING, F.struct(*rest).alias("_rest"))


def _line_facts() -> dict[str, Column]:
    """What a line's versions say together."""
    return (
        sign_facts("allowed_amount")
        | span_facts(F.col("_current"), "claim_line_start_date")
        | type_facts("bill_type_code", "place_of_service_code")
    )


def _line_dropped() -> Column:
    """A reversed line; lines without claim or line number can not be matched to a reversal."""
    return matches_reversal([CLAIM, LINE])


def _claim_facts() -> dict[str, Column]:
    """What a claim's lines say together: type over all lines, span over the kept ones."""
    return claim_type_facts() | {
        "_claim_first": F.min(F.when(~_line_dropped(), F.col("_first"))),
        "_claim_last": F.max(F.when(~_line_dropped(), F.col("_last"))),
    }


def _checked_ids() -> dict[str, Column]:
    """Once per winning line, and on this side of the claim window: further up, filter and
    projection would each check again. A wrong identifier may drop its line only after the
    claim's facts are known."""
    return {target: valid_npi(source) for target, source in CHECKED_IDS.items()}


def _ids_pass() -> Column:
    passes = F.lit(True)
    for target, source in CHECKED_IDS.items():
        passes = passes & absent_or_valid(source, target)
    return passes


def _with_counted_keys(winners: DataFrame, count_keys: bool) -> DataFrame:
    return with_same_key(winners, [CLAIM, LINE], kept=_ids_pass()) if count_keys else winners


def partitions_by_claim(spark: SparkSession, rows: int) -> int | None:
    """Partitions that ``rows`` lines ask for, so that the sort of none is larger than a task's
    memory; None if the session's own number is enough."""
    tasks = math.ceil(rows / TASK_ROWS)
    return tasks if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def _by_claim(lines: DataFrame, rows: int) -> DataFrame:
    """Shuffled by claim, into as many partitions as the session says or more."""
    tasks = partitions_by_claim(lines.sparkSession, rows)
    return lines.repartition(CLAIM) if tasks is None else lines.repartition(tasks, CLAIM)


def _by_window(
    lines: DataFrame, count_keys: bool = False, clustered: bool = False, rows: int = 0
) -> DataFrame:
    """Winning version of each line with line and claim facts; one shuffle, by claim, or none
    where the table has its rows by claim already. ``rows`` is about how many lines there are."""
    ranking = then_all_others(lines.drop(CLAIM, LINE), VERSION_ORDER)
    by_line = Window.partitionBy(CLAIM, LINE).orderBy(*map(F.desc_nulls_last, ranking))
    all_versions = by_line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_claim = Window.partitionBy(CLAIM)
    winners = (
        (lines if clustered else _by_claim(lines, rows))
        .select(
            "*",
            F.row_number().over(by_line).alias("_rank"),
            *(fact.over(all_versions).alias(name) for name, fact in _line_facts().items()),
        )
        .where(F.col("_rank") == 1)
        .drop("_rank")
        .withColumns(_checked_ids())
    )
    return _with_counted_keys(winners, count_keys).select(
        "*", *(fact.over(by_claim).alias(name) for name, fact in _claim_facts().items())
    )


def _by_aggregate(lines: DataFrame, count_keys: bool = False, clustered: bool = False) -> DataFrame:
    """The same for few but huge claims: map-side combined, one broadcast row per claim."""
    if clustered:
        # A huge claim lies in one bucket; its lines need not.
        lines = lines.repartition(CLAIM, LINE)
    per_line = lines.groupBy(CLAIM, LINE).agg(
        best(then_all_others(lines.drop(CLAIM, LINE), VERSION_ORDER)).alias("_row"),
        *(fact.alias(name) for name, fact in _line_facts().items()),
    )
    per_claim = per_line.groupBy(CLAIM).agg(
        *(fact.alias(name) for name, fact in _claim_facts().items())
    )
    winners = (
        attach_broadcast(per_line, per_claim, [CLAIM])
        .select("*", "_row.*")
        .drop("_row")
        .withColumns(_checked_ids())
    )
    return _with_counted_keys(winners, count_keys)


def intermediate_medical_claims(
    staged: DataFrame,
    profile: PayerProfile = DEFAULT_PROFILE,
    rule: HotKeyRule = DEFAULT_RULE,
    newest: dt.date | None = None,
    count_keys: bool = False,
    clustered: bool = False,
) -> DataFrame:
    """Staged medical claims to the output contract.

    The winning version is chosen first; if it then fails the provider check its line is gone.
    A claim with any reversed line keeps its other lines, without a claim type. ``count_keys``
    adds how many rows have the row's key (``SAME_KEY``). ``clustered`` says that the table is
    bucketed by claim number: its partitioning serves all windows, and nothing wide is shuffled.
    Else the lines of the newest date are counted when this is called.
    """
    in_compiled_methods(staged.sparkSession)
    rows = 0
    if not clustered:
        newest, rows = newest_with_rows(staged, newest=newest)
    lines = pack(read_lines(latest_snapshot(staged, newest=newest)))
    hot = hot_keys(lines, [CLAIM], rule)
    versions = _by_window(rows_without(lines, hot), count_keys, clustered, rows).unionByName(
        _by_aggregate(rows_with(lines, hot), count_keys, clustered)
    )
    kept = versions.where(~_line_dropped() & _ids_pass())
    classified = F.col(CLAIM).isNotNull() & ~F.col("_any_reversed")
    return conform(
        kept.select("*", "_rest.*"),
        MEDICAL_CLAIM,
        {
            "claim_type": F.when(classified, type_label("_claim_bill", "_claim_place")),
            "person_id": person_id(profile, "member_id"),
            "ingest_datetime": F.col("ingest_datetime").cast("timestamp"),
            "payer": F.lit(profile.payer),
            "payer_type": F.lit(profile.payer_type),
            "claim_start_date": F.coalesce("_claim_first", "claim_line_start_date"),
            "claim_end_date": F.coalesce("_claim_last", "claim_line_start_date"),
            "revenue_center_code": codes.revenue_center_code("revenue_cd"),
            "diagnosis_code_type": codes.diagnosis_code_type("icd_subm_ind"),
            "in_network_flag": codes.network_flag("dw_netwk_ind"),
            "drg_code_type": codes.tag_if_present("drg_code", "ms-drg"),
            "procedure_code_type": codes.tag_if_present("procedure_code_1", "icd-10-pcs"),
            "data_source": F.lit(profile.data_source),
        },
        [SAME_KEY] if count_keys else [],
    )


def medical_claim(intermediate: DataFrame) -> DataFrame:
    """Final table: the intermediate rows, none filtered."""
    return conform(intermediate, MEDICAL_CLAIM)
