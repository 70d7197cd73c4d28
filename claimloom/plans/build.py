"""Building all four tables from the raw ones, with their data-quality checks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import types as T

from claimloom.operators.quality import SAME_KEY, check_not_null, duplicates_seen, null_counts
from claimloom.operators.staging import stage
from claimloom.payer import DEFAULT_PROFILE, PayerProfile
from claimloom.plans import medical, members, pharmacy
from claimloom.schemas import MEDICAL_RAW, MEMBER_RAW, PHARMACY_RAW
from claimloom.sources.tables import (
    HMO_MEMBER,
    MEDICAL_CLAIMS,
    PHARMACY_CLAIMS,
    PPO_MEMBER,
    Sink,
)

RAW_SCHEMAS = {
    HMO_MEMBER: MEMBER_RAW,
    PPO_MEMBER: MEMBER_RAW,
    MEDICAL_CLAIMS: MEDICAL_RAW,
    PHARMACY_CLAIMS: PHARMACY_RAW,
}

# Columns that must not be NULL.
STAGING_NOT_NULL = {
    HMO_MEMBER: ["cursubid"],
    PPO_MEMBER: ["cursubid"],
    MEDICAL_CLAIMS: ["int_clm_num"],
    PHARMACY_CLAIMS: ["int_clm_num"],
}
INTERMEDIATE_NOT_NULL = {
    "eligibility": ["person_id", "member_id"],
    "provider_attribution": ["person_id", "member_id"],
    "medical_claim": ["claim_id", "person_id"],
    "pharmacy_claim": ["claim_id", "person_id"],
}
FINAL_NOT_NULL = {
    "eligibility": ["person_id", "member_id", "birth_date"],
    "provider_attribution": ["person_id", "member_id"],
    "medical_claim": ["claim_id", "claim_line_number", "person_id"],
    "pharmacy_claim": ["claim_id", "person_id"],
}
# Columns whose combination must be unique.
FINAL_UNIQUE = {
    "eligibility": [
        "person_id",
        "enrollment_start_date",
        "enrollment_end_date",
        "payer",
        "payer_type",
    ],
    "provider_attribution": ["person_id", "plan", "year_month"],
    "medical_claim": ["claim_id", "claim_line_number"],
    "pharmacy_claim": ["claim_id", "claim_line_number"],
}
# Raw tables each output is made from.
INPUTS = {
    "eligibility": [HMO_MEMBER, PPO_MEMBER],
    "provider_attribution": [HMO_MEMBER, PPO_MEMBER],
    "medical_claim": [MEDICAL_CLAIMS],
    "pharmacy_claim": [PHARMACY_CLAIMS],
}
# Last step of each output.
FINALIZE: dict[str, Callable[[DataFrame], DataFrame]] = {
    "eligibility": members.eligibility,
    "provider_attribution": members.provider_attribution,
    "medical_claim": medical.medical_claim,
    "pharmacy_claim": pharmacy.pharmacy_claim,
}


@dataclass(frozen=True)
class Check:
    """Outcome of one data-quality check; ``failures`` counts rows or key combinations."""

    layer: str
    table_name: str
    column_name: str
    failures: int


@dataclass
class BuildReport:
    """``skipped`` and ``errors`` give the reason by output; errors of staging checks are listed
    by raw table."""

    written: dict[str, str] = field(default_factory=dict)
    skipped: dict[str, str] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)
    checks: list[Check] = field(default_factory=list)

    @property
    def failed(self) -> list[Check]:
        return [c for c in self.checks if c.failures]

    @property
    def ok(self) -> bool:
        return not (self.failed or self.errors or self.skipped)


def staging_relations(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Raw tables with the contract's columns and types."""
    return {name: stage(df, RAW_SCHEMAS[name]) for name, df in raw.items()}


def intermediate_relation(
    name: str,
    raw: dict[str, DataFrame],
    profile: PayerProfile = DEFAULT_PROFILE,
    full_months_only: bool = False,
    newest: dict[str, dt.date] | None = None,
    count_keys: bool = False,
    clustered: Collection[str] = (),
) -> DataFrame:
    """Normalized rows of an output before its final filter. Lazy, nothing is stored.

    ``newest`` gives the newest file date of raw tables where a caller knows it. ``count_keys``
    adds ``SAME_KEY``, how many rows of the output have the row's unique key. ``clustered`` names
    raw tables that are bucketed by claim number.
    """
    staged = staging_relations({table: raw[table] for table in INPUTS[name]})
    dates = [(newest or {}).get(table) for table in INPUTS[name]]
    date = None if None in dates else max(dates)
    if name == "medical_claim":
        return medical.intermediate_medical_claims(
            staged[MEDICAL_CLAIMS], profile, newest=date, count_keys=count_keys,
            clustered=MEDICAL_CLAIMS in clustered,
        )
    if name == "pharmacy_claim":
        return pharmacy.intermediate_pharmacy_claims(
            staged[PHARMACY_CLAIMS], profile, date, count_keys
        )
    feeds = members.member_feeds(staged[HMO_MEMBER], staged[PPO_MEMBER])
    if name == "eligibility":
        return members.intermediate_member_eligibility(
            feeds, profile, full_months_only, date, count_keys
        )
    return members.intermediate_provider_attribution(feeds, profile, count_keys)


def final_relation(
    name: str,
    raw: dict[str, DataFrame],
    profile: PayerProfile = DEFAULT_PROFILE,
    clustered: Collection[str] = (),
) -> DataFrame:
    """One output table as a lazy frame."""
    rows = intermediate_relation(name, raw, profile, full_months_only=True, clustered=clustered)
    return FINALIZE[name](rows)


def staging_views(profile: PayerProfile = DEFAULT_PROFILE) -> dict[str, tuple[str, T.StructType]]:
    """Raw table and contract of each staging relation, by the name SQL users know it by."""
    # Relation names.
    names = {
        HMO_MEMBER: HMO_MEMBER,
        PPO_MEMBER: PPO_MEMBER,
        MEDICAL_CLAIMS: "medical_claims",
        PHARMACY_CLAIMS: "pharmacy_claims",
    }
    return {f"stg_{profile.payer}_{names[table]}": (table, RAW_SCHEMAS[table]) for table in names}


def intermediate_name(name: str, profile: PayerProfile = DEFAULT_PROFILE) -> str:
    """The name SQL users know an output's intermediate relation by."""
    # Relation names.
    names = {
        "eligibility": "member_eligibility",
        "provider_attribution": "provider_attribution",
        "medical_claim": "medical_claims",
        "pharmacy_claim": "pharmacy_claims",
    }
    return f"int_{profile.payer}_{names[name]}"


def named_relations(
    raw: dict[str, DataFrame], profile: PayerProfile = DEFAULT_PROFILE
) -> dict[str, DataFrame]:
    """Staging and intermediate relations under the names SQL users know them by."""
    staged = staging_relations(raw)
    return {
        **{name: staged[table] for name, (table, _) in staging_views(profile).items()},
        **{intermediate_name(name, profile): intermediate_relation(name, raw, profile) for name in FINALIZE},
    }


def build(
    raw: dict[str, DataFrame],
    sink: Sink,
    profile: PayerProfile = DEFAULT_PROFILE,
    newest: dict[str, dt.date] | None = None,
    intermediate_sink: Sink | None = None,
    hold_final: bool = False,
    clustered: Collection[str] = (),
) -> BuildReport:
    """Write all outputs and check every layer.

    Staging is checked first, and an output with a failed input is skipped. An output is stored
    as pending, and its rows are observed on the way, at no second pass: intermediate ones, all of
    them, for NULLs, final ones for NULLs and repeated keys. Repeated keys are found among
    neighbours, in the partitioning and order that the choice of versions left. It is published
    only if its intermediate rows pass, with ``hold_final`` only if the final ones pass as well;
    else the published table stays as it was. Nothing is read back.

    With ``intermediate_sink`` the intermediate rows are stored there, under the names SQL users
    know, by the one pass that computes them; the output is then a filter over what was stored.

    The four outputs are independent jobs and run side by side; one that raises is reported and
    stops no other.
    """
    staged = staging_relations(raw)
    report = BuildReport()

    def staging_check(name: str) -> list[Check]:
        return _run("staging", check_not_null(staged[name], name, STAGING_NOT_NULL[name]))

    def published(target: Sink, pending: str, name: str) -> None:
        try:
            report.written[name] = target.publish(pending, name)
        except Exception:
            target.discard(pending)
            raise

    def output(name: str) -> None:
        unique = "+".join(FINAL_UNIQUE[name])
        seen, final_seen = Observation(name), Observation(f"final {name}")
        rows = (
            intermediate_relation(
                name, raw, profile, newest=newest, count_keys=True, clustered=clustered
            )
            .observe(seen, *null_counts(INTERMEDIATE_NOT_NULL[name]), duplicates_seen(unique))
            .drop(SAME_KEY)
        )
        failed_rows = "a check of its intermediate rows failed"
        if intermediate_sink is not None:
            int_name = intermediate_name(name, profile)
            pending = intermediate_sink.store(rows, int_name)
            duplicates, checks = _observed("intermediate", name, seen, unique)
            report.checks += checks
            if any(c.failures for c in checks):
                intermediate_sink.discard(pending)
                report.skipped[name] = failed_rows
                return
            published(intermediate_sink, pending, int_name)
            rows = intermediate_sink.read(report.written[int_name])
        final = FINALIZE[name](rows).observe(final_seen, *null_counts(FINAL_NOT_NULL[name]))
        pending = sink.store(final, name)
        if intermediate_sink is None:
            duplicates, checks = _observed("intermediate", name, seen, unique)
            report.checks += checks
        final_checks = [Check("final", name, c, n) for c, n in final_seen.get.items()]
        final_checks.append(Check("final", name, unique, duplicates))
        held = failed_rows if any(c.failures for c in checks) else ""
        if not held:
            report.checks += final_checks
            if hold_final and any(c.failures for c in final_checks):
                held = "a check of its final rows failed"
        if held:
            sink.discard(pending)
            report.skipped[name] = held
            return
        published(sink, pending, name)

    with ThreadPoolExecutor(len(FINALIZE)) as pool:
        jobs = {name: pool.submit(staging_check, name) for name in STAGING_NOT_NULL}
        for name, job in jobs.items():
            try:
                report.checks += job.result()
            except Exception as error:
                report.errors[name] = str(error)
        bad = {c.table_name for c in report.failed} | set(report.errors)
        for name in FINALIZE:
            if inputs := sorted(bad & set(INPUTS[name])):
                report.skipped[name] = f"an input failed its check: {', '.join(inputs)}"
        jobs = {name: pool.submit(output, name) for name in FINALIZE if name not in report.skipped}
        for name, job in jobs.items():
            try:
                job.result()
            except Exception as error:
                report.errors[name] = str(error)
    return report


def _observed(layer: str, name: str, seen: Observation, unique: str) -> tuple[int, list[Check]]:
    """Repeated keys, and the NULL checks, of a pass that is over."""
    counts = dict(seen.get)
    return counts.pop(unique), [Check(layer, name, c, n) for c, n in counts.items()]


def _run(layer: str, result: DataFrame) -> list[Check]:
    """A check's handful of result rows."""
    return [Check(layer, **row.asDict()) for row in result.collect()]
