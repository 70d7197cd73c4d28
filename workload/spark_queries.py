"""Registered queries: every operator and table over the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions import amounts, codes, ids
from claimloom.operators import classify, identifiers, pick, quality, reversal
from claimloom.operators.skew import DEFAULT_RULE, HotKeyRule
from claimloom.operators.snapshot import latest_snapshot
from claimloom.operators.staging import stage
from claimloom.payer import DEFAULT_PROFILE
from claimloom.plans import build, medical, members
from claimloom.plans.stored_views import store_intermediate_views
from claimloom.schemas import MEDICAL_RAW, MEMBER_RAW, PHARMACY_RAW
from claimloom.sources.shared import new_folder
from claimloom.sources.tables import (
    HMO_MEMBER,
    MEDICAL_CLAIMS,
    PHARMACY_CLAIMS,
    PPO_MEMBER,
    descriptions,
    newest_from_statistics,
    raw_from_files,
    store_bucketed,
    store_staging_views,
    write_deliveries,
    write_files,
    write_layer,
)
from workload.raw_tables import as_delivered, medical_with_null_keys, raw_tables

Query = Callable[[SparkSession, str], DataFrame]

LINE_KEY = ["int_clm_num", "clm_line_num"]
# Low enough that, on the test tables, claims take the hot path as well as the cold one.
FEW_ROWS_ARE_HOT = HotKeyRule(min_rows=5)


def _comparable(df: DataFrame) -> DataFrame:
    """Timestamps without zone, so that the session's zone does not show in the comparison."""
    return df.withColumns(
        {name: F.col(name).cast("timestamp_ntz") for name, kind in df.dtypes if kind == "timestamp"}
    )


def _staged(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return build.staging_relations(raw_tables(spark, sf_dir))


def _medical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir)[MEDICAL_CLAIMS]


def _medical_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_snapshot(_medical(spark, sf_dir))


def _pharmacy_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_snapshot(_staged(spark, sf_dir)[PHARMACY_CLAIMS])


def _feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = _staged(spark, sf_dir)
    return members.member_feeds(staged[HMO_MEMBER], staged[PPO_MEMBER])


# --- sources and staging -----------------------------------------------------------------


def _stage_query(table: str, schema) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _comparable(stage(as_delivered(raw_tables(spark, sf_dir)[table]), schema))

    return query


def table_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eligibility written as a table in the shared folder and read back."""
    table = build.final_relation("eligibility", raw_tables(spark, sf_dir))
    where = write_files(table, "eligibility", new_folder(spark, "sink"))
    return _comparable(spark.read.parquet(where))


def _delivered_files(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All raw tables written as deliveries, by file date, and read with the file reader."""
    root = new_folder(spark, "raw")
    for name, df in raw_tables(spark, sf_dir).items():
        write_deliveries(df, f"{root}/{name}")
    return raw_from_files(spark, root)


def raw_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pharmacy deliveries as the file reader returns them."""
    return _comparable(_delivered_files(spark, sf_dir)[PHARMACY_CLAIMS].select(*PHARMACY_RAW.names))


def pharmacy_claim_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(build.final_relation("pharmacy_claim", _delivered_files(spark, sf_dir)))


def _database(spark: SparkSession) -> str:
    """A database of its own below the shared folder."""
    name = f"run_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{new_folder(spark, 'db')}'")
    return name


def layer_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attribution written to a layer's database, twice, and read back from the catalog."""
    database = _database(spark)
    table = build.final_relation("provider_attribution", raw_tables(spark, sf_dir))
    write_layer(table.limit(1), "provider_attribution", f" {database} ")
    return _comparable(spark.read.table(write_layer(table, "provider_attribution", database)))


def staging_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored staging view of pharmacy deliveries that are text, read by name."""
    database = _database(spark)
    write_layer(as_delivered(raw_tables(spark, sf_dir)[PHARMACY_CLAIMS]), PHARMACY_CLAIMS, database)
    name = "stg_bcbs_pharmacy_claims"
    views = {name: build.staging_views()[name]}
    return _comparable(spark.read.table(store_staging_views(spark, database, database, views)[0]))


def _final_from_view(name: str) -> Query:
    """The last step of an output over its stored intermediate view, read by name."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        database, raw = _database(spark), raw_tables(spark, sf_dir)
        inputs = build.INPUTS[name]
        for table in inputs:
            write_layer(raw[table], table, database)
        views = {view: of for view, of in build.staging_views().items() if of[0] in inputs}
        store_staging_views(spark, database, database, views)
        view = store_intermediate_views(spark, database, database, outputs=[name])[name]
        return _comparable(build.FINALIZE[name](spark.read.table(view)))

    return query


def _text_deliveries(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    raw = raw_tables(spark, sf_dir)
    return {name: as_delivered(df, ("_run_time",)) for name, df in raw.items()}


def lineage_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineage of member months whose ingestion time arrives as text."""
    rows = build.intermediate_relation("provider_attribution", _text_deliveries(spark, sf_dir))
    return _comparable(
        rows.select("member_id", "plan", "year_month", "file_name", "file_date", "ingest_datetime")
    )


def medical_claim_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(build.final_relation("medical_claim", _text_deliveries(spark, sf_dir)))


def lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File name, file date and ingestion time that output rows carry."""
    rows = medical.read_lines(_medical(spark, sf_dir))
    return _comparable(
        rows.select("claim_id", "claim_line_number", "file_name", "file_date", "ingest_datetime")
    )


# --- snapshots and unions ----------------------------------------------------------------


def latest_snapshot_medical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _medical_snapshot(spark, sf_dir).select(*LINE_KEY, "date_id", "s3_path")


def latest_snapshot_pharmacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pharmacy_snapshot(spark, sf_dir).select("int_clm_num", "date_id", "s3_path")


def latest_snapshot_from_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pharmacy snapshot of files not partitioned by date, its date from their footers."""
    path = f"{new_folder(spark, 'unpartitioned')}/rows"
    raw_tables(spark, sf_dir)[PHARMACY_CLAIMS].write.parquet(path)
    staged = stage(spark.read.parquet(path), PHARMACY_RAW)
    rows = latest_snapshot(staged, newest=newest_from_statistics(spark, path))
    return rows.select("int_clm_num", "date_id", "s3_path")


def latest_snapshot_member_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_snapshot(_feeds(spark, sf_dir)).select("plan", "date_id", "filename")


def latest_snapshot_one_feed_behind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The HMO feed a month older than the PPO feed: all of it drops out."""
    behind = F.when(F.col("plan") == "HMO", F.date_sub("date_id", 31)).otherwise(F.col("date_id"))
    feeds = _feeds(spark, sf_dir).withColumn("date_id", behind)
    return latest_snapshot(feeds).select("plan", "date_id", "filename")


def member_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(_feeds(spark, sf_dir))


# --- reversals ---------------------------------------------------------------------------


def reversed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reversal.reversed_keys(_medical_snapshot(spark, sf_dir), LINE_KEY, "paid")


def reversed_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reversal.reversed_keys(_pharmacy_snapshot(spark, sf_dir), ["int_clm_num"], "paid")


def drop_reversed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _medical_snapshot(spark, sf_dir).select(*LINE_KEY, "paid", "s3_path")
    return reversal.drop_reversed(rows, LINE_KEY, "paid")


def drop_reversed_claims_not_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _pharmacy_snapshot(spark, sf_dir).select("int_clm_num", "paid", "s3_path")
    return reversal.drop_reversed_not_in(rows, "int_clm_num", "paid")


def _not_in(spark: SparkSession, sf_dir: str, paid: str) -> DataFrame:
    rows = _pharmacy_snapshot(spark, sf_dir).withColumn("paid", F.expr(paid))
    rows = rows.select("int_clm_num", "paid", "s3_path")
    return reversal.drop_reversed_not_in(rows, "int_clm_num", "paid")


def not_in_with_nothing_reversed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty set: every row passes, those without a claim number too."""
    return _not_in(spark, sf_dir, "ltrim('-', paid)")


def not_in_with_null_reversed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts signed by row, also where the claim number is missing: a NULL in the set."""
    signed = "if(clm_ndc is null, '-', '') || ltrim('-', paid)"
    return _not_in(spark, sf_dir, f"if(int_clm_num is null, {signed}, paid)")


def not_in_case_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that pass, of those with and without a claim number, in each of the three cases."""
    cases = {
        "some reversed": drop_reversed_claims_not_in,
        "nothing reversed": not_in_with_nothing_reversed,
        "null reversed": not_in_with_null_reversed,
    }
    counts = [F.count("int_clm_num").alias("named"), F.count_if(F.col("int_clm_num").isNull()).alias("unnamed")]
    return reduce(
        DataFrame.unionByName,
        (
            query(spark, sf_dir).agg(*counts).withColumn("passing", F.lit(name))
            for name, query in cases.items()
        ),
    )


# --- claims ------------------------------------------------------------------------------


def _claim_types(rows: DataFrame) -> DataFrame:
    return classify.classify_claims(rows, *LINE_KEY, "paid", "bill_type_cd", "cms_place_srv_cd")


def claim_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _claim_types(_medical_snapshot(spark, sf_dir))


def claim_type_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _medical_snapshot(spark, sf_dir)
    return classify.attach_claim_type(
        rows.select(*LINE_KEY, "s3_path"), _claim_types(rows), "int_clm_num", FEW_ROWS_ARE_HOT
    )


def claim_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _medical_snapshot(spark, sf_dir).select(*LINE_KEY, "svcdt", "curr_clm_ind", "s3_path")
    return classify.claim_span(rows, "int_clm_num", "svcdt", "curr_clm_ind", FEW_ROWS_ARE_HOT)


# --- one row per key ---------------------------------------------------------------------


def _run_order(flag: str | None = None) -> list:
    prefer = [F.col("date_id"), F.col("_run_time")]
    return prefer if flag is None else [codes.is_yes(flag), *prefer]


def pick_medical_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _medical_snapshot(spark, sf_dir).select(
        *LINE_KEY, "curr_clm_ind", "date_id", "_run_time", "s3_path"
    )
    return _comparable(pick.pick_current(rows, LINE_KEY, _run_order("curr_clm_ind"), ["s3_path"]))


def pick_pharmacy_claim(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _pharmacy_snapshot(spark, sf_dir).select(
        "int_clm_num", "rx_curr_clm_ind", "date_id", "_run_time", "s3_path"
    )
    order = _run_order("rx_curr_clm_ind")
    return _comparable(pick.pick_current(rows, ["int_clm_num"], order, ["s3_path"]))


def _member_rows(df: DataFrame) -> DataFrame:
    return df.select(
        ids.member_key().alias("member_id"),
        "plan",
        "mem_mth_st_dt",
        "mem_mth_end_dt",
        "mem_mth_cnt",
        "date_id",
        "_run_time",
        "filename",
    ).where(F.col("member_id").isNotNull())


def pick_member_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = pick.pick_current(
        _member_rows(latest_snapshot(_feeds(spark, sf_dir))),
        ["member_id", F.trunc("mem_mth_st_dt", "MM")],
        [F.col("mem_mth_cnt"), F.col("mem_mth_end_dt"), F.col("_run_time")],
        ["filename"],
    )
    return _comparable(picked)


def pick_member_plan_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = pick.pick_current(
        _member_rows(_feeds(spark, sf_dir)),
        ["member_id", "plan", codes.year_month("mem_mth_st_dt")],
        [F.col("date_id"), F.col("mem_mth_end_dt"), F.col("_run_time")],
        ["filename"],
    )
    return _comparable(picked)


def line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _pharmacy_snapshot(spark, sf_dir).select(
        "int_clm_num", "rx_curr_clm_ind", "svcdt", "clm_ndc", "date_id", "_run_time", "s3_path"
    )
    order = _run_order("rx_curr_clm_ind")
    picked = pick.pick_current(rows, ["int_clm_num"], order, ["s3_path"])
    numbered = pick.number_lines(
        picked.where(F.col("clm_ndc").isNotNull()),
        "int_clm_num",
        ["svcdt", "clm_ndc"],
        "claim_line_number",
    )
    return numbered.select("int_clm_num", "svcdt", "clm_ndc", "claim_line_number")


# --- identifiers -------------------------------------------------------------------------


def valid_npi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _medical(spark, sf_dir).select(
        "s3_path", "sprovnpi", ids.valid_npi("sprovnpi").alias("rendering_npi")
    )


def npi_null_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _feeds(spark, sf_dir).select("filename", "pcp_npi")
    return identifiers.with_valid_id(rows, "pcp_npi", "payer_attributed_provider", "null")


def npi_drop_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _medical(spark, sf_dir).select(*LINE_KEY, "s3_path", "sprovnpi", "bprovnpi")
    rows = identifiers.with_valid_id(rows, "sprovnpi", "rendering_npi", "drop_row")
    return identifiers.with_valid_id(rows, "bprovnpi", "billing_npi", "drop_row")


def npi_passthrough_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _staged(spark, sf_dir)[PHARMACY_CLAIMS].select("s3_path", "pharm_npi")
    return identifiers.with_valid_id(rows, "pharm_npi", "dispensing_provider_npi", "passthrough")


# --- columns -----------------------------------------------------------------------------


def revenue_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = codes.revenue_center_code("revenue_cd").alias("revenue_center_code")
    return _medical(spark, sf_dir).select("s3_path", "revenue_cd", code)


def procedure_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = codes.procedure_code("hcpcs_proc_cd", "cpt_proc_cd").alias("hcpcs_code")
    return _medical(spark, sf_dir).select("s3_path", "hcpcs_proc_cd", "cpt_proc_cd", code)


def code_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _medical(spark, sf_dir).select(
        "s3_path",
        codes.tag_if_present("drg_cd", "ms-drg").alias("drg_code_type"),
        codes.diagnosis_code_type("icd_subm_ind").alias("diagnosis_code_type"),
        codes.tag_if_present("icd_proc1_cd", "icd-10-pcs").alias("procedure_code_type"),
    )


def gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feeds(spark, sf_dir).select(
        "filename", "mem_gender", codes.gender("mem_gender").alias("gender")
    )


def network_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = codes.network_flag("dw_netwk_ind").alias("in_network_flag")
    return _medical(spark, sf_dir).select("s3_path", "dw_netwk_ind", flag)


def total_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = amounts.total_of("dw_mem_liab_amt", "netpay", "cobamt").alias("total_cost_amount")
    return _medical(spark, sf_dir).select("s3_path", total)


def service_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = amounts.to_double(F.coalesce("srv_units", "dw_srv_units"))
    return _medical(spark, sf_dir).select(
        "s3_path", "srv_units", "dw_srv_units", units.alias("service_unit_quantity")
    )


def tolerant_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir)[PHARMACY_CLAIMS].select(
        "s3_path",
        amounts.to_double("copay_amt").alias("copayment_amount"),
        amounts.to_double("paid").alias("allowed_amount"),
        amounts.truncated(amounts.to_double("metric_quantity")).alias("quantity"),
        amounts.truncated(amounts.to_double("days_supply")).alias("days_supply"),
        amounts.to_int("num_refills").alias("refills"),
    )


def person_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feeds(spark, sf_dir).select(
        "filename",
        ids.member_key().alias("member_id"),
        ids.person_id(DEFAULT_PROFILE, ids.member_key()).alias("person_id"),
    )


def year_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feeds(spark, sf_dir).select(
        "filename", codes.year_month("mem_mth_st_dt").alias("year_month")
    )


# --- quality -----------------------------------------------------------------------------


def not_null_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All not-null checks of all layers."""
    raw = raw_tables(spark, sf_dir)
    staged = build.staging_relations(raw)
    rows = {t: build.intermediate_relation(t, raw) for t in build.INTERMEDIATE_NOT_NULL}
    checks = [
        *(("staging", staged[t], t, cols) for t, cols in build.STAGING_NOT_NULL.items()),
        *(("intermediate", rows[t], t, cols) for t, cols in build.INTERMEDIATE_NOT_NULL.items()),
        *(
            ("final", build.FINALIZE[t](rows[t]), t, cols)
            for t, cols in build.FINAL_NOT_NULL.items()
        ),
    ]
    return reduce(
        DataFrame.unionByName,
        (
            quality.check_not_null(df, t, cols).withColumn("layer", F.lit(layer))
            for layer, df, t, cols in checks
        ),
    )


def unique_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The uniqueness check of every output."""
    raw = raw_tables(spark, sf_dir)
    return reduce(
        DataFrame.unionByName,
        (
            quality.check_unique(build.final_relation(t, raw), t, keys)
            for t, keys in build.FINAL_UNIQUE.items()
        ),
    )


def duplicate_raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same check on a table that does have duplicates: undeduplicated lines."""
    return quality.duplicate_keys(_medical(spark, sf_dir), LINE_KEY)


# --- tables ------------------------------------------------------------------------------


def _final(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _comparable(build.final_relation(name, raw_tables(spark, sf_dir)))

    return query


def int_member_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(members.intermediate_member_eligibility(_feeds(spark, sf_dir)))


def medical_claim_with_hot_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(
        medical.intermediate_medical_claims(_medical(spark, sf_dir), rule=FEW_ROWS_ARE_HOT)
    )


def medical_claim_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries stored by claim: the windows take their partitioning over."""
    database = _database(spark)
    lines = raw_tables(spark, sf_dir)[MEDICAL_CLAIMS]
    raw = {MEDICAL_CLAIMS: spark.read.table(store_bucketed(lines, f"{database}.{MEDICAL_CLAIMS}", "int_clm_num", 8))}
    return _comparable(build.final_relation("medical_claim", raw, clustered=[MEDICAL_CLAIMS]))


def line_numbers_of_hot_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All medical lines numbered by claim, a third of them under one claim: by blocks."""
    lines = _medical(spark, sf_dir).select("int_clm_num", "clm_line_num", "svcdt", "s3_path")
    hot = F.dayofmonth("svcdt") % 3 == 0
    lines = lines.withColumn("int_clm_num", F.when(hot, "hot").otherwise(F.col("int_clm_num")))
    return pick.number_lines(lines, "int_clm_num", ["svcdt", "s3_path"], "number", FEW_ROWS_ARE_HOT)


def table_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptions of all tables and their columns as stored, with the tables' numbers of rows."""
    database, raw = _database(spark), raw_tables(spark, sf_dir)
    tables = [write_layer(build.final_relation(name, raw), name, database) for name in build.FINALIZE]
    rows = reduce(
        DataFrame.unionByName,
        (spark.read.table(t).agg(F.lit(t.rpartition(".")[2]).alias("table_name"), F.count("*").alias("n_rows")) for t in tables),
    )
    return descriptions(spark, tables).join(rows, "table_name")


def _null_keys(rule: HotKeyRule) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        staged = stage(medical_with_null_keys(spark, sf_dir), MEDICAL_RAW)
        return _comparable(medical.intermediate_medical_claims(staged, rule=rule))

    return query


QUERIES: dict[str, Query] = {
    "stage_hmo_members": _stage_query(HMO_MEMBER, MEMBER_RAW),
    "stage_ppo_members": _stage_query(PPO_MEMBER, MEMBER_RAW),
    "stage_medical": _stage_query(MEDICAL_CLAIMS, MEDICAL_RAW),
    "stage_pharmacy": _stage_query(PHARMACY_CLAIMS, PHARMACY_RAW),
    "table_sink": table_sink,
    "raw_files": raw_files,
    "layer_table": layer_table,
    "staging_view": staging_view,
    "medical_claim_from_view": _final_from_view("medical_claim"),
    "pharmacy_claim_from_view": _final_from_view("pharmacy_claim"),
    "latest_snapshot_from_statistics": latest_snapshot_from_statistics,
    "lineage": lineage,
    "lineage_from_text": lineage_from_text,
    "latest_snapshot_medical": latest_snapshot_medical,
    "latest_snapshot_pharmacy": latest_snapshot_pharmacy,
    "latest_snapshot_member_union": latest_snapshot_member_union,
    "latest_snapshot_one_feed_behind": latest_snapshot_one_feed_behind,
    "member_union": member_union,
    "reversed_lines": reversed_lines,
    "reversed_claims": reversed_claims,
    "drop_reversed_lines": drop_reversed_lines,
    "drop_reversed_claims_not_in": drop_reversed_claims_not_in,
    "not_in_with_nothing_reversed": not_in_with_nothing_reversed,
    "not_in_with_null_reversed": not_in_with_null_reversed,
    "not_in_case_counts": not_in_case_counts,
    "claim_type": claim_type,
    "claim_type_of_lines": claim_type_of_lines,
    "claim_span": claim_span,
    "pick_medical_line": pick_medical_line,
    "pick_pharmacy_claim": pick_pharmacy_claim,
    "pick_member_month": pick_member_month,
    "pick_member_plan_month": pick_member_plan_month,
    "line_numbers": line_numbers,
    "line_numbers_of_hot_claims": line_numbers_of_hot_claims,
    "valid_npi": valid_npi,
    "npi_null_policy": npi_null_policy,
    "npi_drop_policy": npi_drop_policy,
    "npi_passthrough_policy": npi_passthrough_policy,
    "revenue_code": revenue_code,
    "procedure_code": procedure_code,
    "code_types": code_types,
    "gender": gender,
    "network_flag": network_flag,
    "total_cost": total_cost,
    "service_units": service_units,
    "tolerant_numbers": tolerant_numbers,
    "person_ids": person_ids,
    "year_month": year_month,
    "not_null_report": not_null_report,
    "unique_report": unique_report,
    "duplicate_raw_lines": duplicate_raw_lines,
    "table_descriptions": table_descriptions,
    "int_member_eligibility": int_member_eligibility,
    "eligibility": _final("eligibility"),
    "provider_attribution": _final("provider_attribution"),
    "medical_claim": _final("medical_claim"),
    "medical_claim_with_hot_claims": medical_claim_with_hot_claims,
    "medical_claim_bucketed": medical_claim_bucketed,
    "medical_claim_from_text": medical_claim_from_text,
    "medical_claim_null_keys": _null_keys(DEFAULT_RULE),
    "medical_claim_null_keys_hot": _null_keys(FEW_ROWS_ARE_HOT),
    "pharmacy_claim": _final("pharmacy_claim"),
    "pharmacy_claim_from_files": pharmacy_claim_from_files,
}
