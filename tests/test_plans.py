"""The four tables on hand-written rows, and properties on the derived tables."""

import datetime as dt

import pytest
from compare import rows_of_spark
from conftest import DAY, GOOD_NPI, OLD_DAY, run_time
from pyspark.sql import functions as F
from test_skew import main_plan

from claimloom.payer import PayerProfile
from claimloom.plans import build, medical, members, pharmacy
from claimloom.schemas import (
    ELIGIBILITY,
    MEDICAL_CLAIM,
    MEDICAL_RAW,
    MEMBER_RAW,
    PHARMACY_CLAIM,
    PHARMACY_RAW,
    PROVIDER_ATTRIBUTION,
)
from claimloom.sources.tables import HMO_MEMBER, MEDICAL_CLAIMS, PHARMACY_CLAIMS, PPO_MEMBER
from workload.raw_tables import raw_tables

FINAL = {
    "eligibility": ELIGIBILITY,
    "provider_attribution": PROVIDER_ATTRIBUTION,
    "medical_claim": MEDICAL_CLAIM,
    "pharmacy_claim": PHARMACY_CLAIM,
}


def by_line(df):
    return {(r.claim_id, r.claim_line_number): r for r in df.collect()}


# --- contracts ---------------------------------------------------------------------------


def test_contract_sizes():
    assert [len(s) for s in (MEMBER_RAW, MEDICAL_RAW, PHARMACY_RAW)] == [24, 57, 25]
    assert [len(s) for s in FINAL.values()] == [42, 23, 151, 26]
    for schema in FINAL.values():
        assert len(set(schema.names)) == len(schema)


def always_null(df):
    """Columns that the optimizer knows to be NULL literals."""
    top = df._jdf.queryExecution().optimizedPlan()
    while top.nodeName() == "Union":
        top = top.children().apply(0)
    null_columns = []
    for expression in top.projectList().mkString("\u0001").split("\u0001"):
        if expression.startswith("null AS "):
            null_columns.append(expression[len("null AS ") :].split("#")[0])
    return null_columns


@pytest.mark.parametrize(
    "name, count", [("eligibility", 17), ("provider_attribution", 6), ("pharmacy_claim", 1)]
)
def test_placeholder_counts(spark, sf_dir, name, count):
    df = build.intermediate_relation(name, raw_tables(spark, sf_dir))
    assert len(always_null(df)) == count


def test_medical_placeholders(spark, sf_dir):
    df = build.intermediate_relation("medical_claim", raw_tables(spark, sf_dir))
    counts = df.agg(*(F.count(c).alias(c) for c in df.columns)).first().asDict()
    written = [f.name for f in MEDICAL_CLAIM if f.name not in medical.RENAMED]
    placeholders = [
        "claim_line_end_date", "hcpcs_modifier_4", "hcpcs_modifier_5", "rendering_tin",
        "billing_tin", "facility_npi", "group_id", "group_name",
        *(f"diagnosis_code_{i}" for i in range(11, 26)),
        *(f"diagnosis_poa_{i}" for i in range(1, 26)),
        *(f"procedure_code_{i}" for i in range(6, 26)),
        *(f"procedure_date_{i}" for i in range(1, 26)),
    ]
    assert len(placeholders) == 93 and set(placeholders) <= set(written)
    assert all(counts[p] == 0 for p in placeholders)


@pytest.mark.parametrize("name", ["provider_attribution", "pharmacy_claim", "medical_claim"])
def test_identifiers_are_checked_after_the_choice(spark, sf_dir, name):
    """No check digit is computed below the grouping or window that chooses a row."""
    plan = build.final_relation(name, raw_tables(spark, sf_dir))._jdf.queryExecution().optimizedPlan()
    lines = plan.toString().splitlines()
    depth = {n: len(line) - len(line.lstrip(" :+-")) for n, line in enumerate(lines)}
    checks = [n for n, line in enumerate(lines) if "uhn" in line]
    chooses = [n for n, line in enumerate(lines) if line.lstrip(" :+-").startswith(("Window", "Aggregate"))]
    assert checks and chooses
    for check in checks:
        below = [n for n in chooses if n > check and depth[n] > depth[check]]
        assert below, lines[check][:200]


@pytest.mark.parametrize("name", FINAL)
def test_final_columns_and_types(spark, sf_dir, name):
    df = build.final_relation(name, raw_tables(spark, sf_dir))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in FINAL[name]]


# --- medical -----------------------------------------------------------------------------


def test_medical_reversed_line_takes_the_claim_type_of_its_claim(medical_rows):
    rows = medical_rows(
        dict(paid="10", bill_type_cd="111"),
        dict(paid="-10", bill_type_cd="111"),
        dict(clm_line_num=2, bill_type_cd="111"),
        dict(int_clm_num="c2", bill_type_cd="111"),
    )
    got = by_line(medical.intermediate_medical_claims(rows))
    assert {k: r.claim_type for k, r in got.items()} == {("c1", 2): None, ("c2", 1): "institutional"}


def test_medical_null_keys_cannot_be_reversed(medical_rows):
    rows = medical_rows(
        dict(clm_line_num=None, paid="1", s3_path="a"),
        dict(clm_line_num=None, paid="-1", s3_path="b"),
        dict(int_clm_num=None, paid="1", s3_path="a", cms_place_srv_cd="11"),
        dict(int_clm_num=None, paid="-1", s3_path="b", cms_place_srv_cd="11"),
    )
    got = by_line(medical.intermediate_medical_claims(rows))
    assert {k: (r.claim_type, r.file_name) for k, r in got.items()} == {
        ("c1", None): (None, "b"),
        (None, 1): (None, "b"),
    }


def test_medical_winner_first_then_provider_check(medical_rows):
    rows = medical_rows(
        dict(sprovnpi="12345", _run_time=run_time(2)),
        dict(sprovnpi=GOOD_NPI, _run_time=run_time(1)),
        dict(clm_line_num=2, bprovnpi=""),
        dict(clm_line_num=3, sprovnpi="123-456-7893", bprovnpi=None),
    )
    got = by_line(medical.intermediate_medical_claims(rows))
    assert set(got) == {("c1", 3)}
    assert (got["c1", 3].rendering_npi, got["c1", 3].billing_npi) == (GOOD_NPI, None)


def test_medical_span_counts_lines_dropped_later_but_not_reversed_ones(medical_rows):
    d = [dt.date(2024, 1, i) for i in range(1, 8)]
    rows = medical_rows(
        dict(svcdt=d[3]),
        dict(clm_line_num=2, svcdt=d[1], sprovnpi="bad"),
        dict(clm_line_num=3, svcdt=d[0], paid="5"),
        dict(clm_line_num=3, svcdt=d[0], paid="-5"),
        dict(clm_line_num=1, svcdt=d[5], curr_clm_ind="Y", _run_time=run_time(0)),
        dict(clm_line_num=4, svcdt=d[6], curr_clm_ind="N"),
        dict(int_clm_num="c2", svcdt=d[2], curr_clm_ind="N"),
        dict(int_clm_num="c2", clm_line_num=2, svcdt=d[4], curr_clm_ind=" Y"),
    )
    got = by_line(medical.intermediate_medical_claims(rows))
    assert {k: (r.claim_start_date, r.claim_end_date) for k, r in got.items()} == {
        ("c1", 1): (d[1], d[5]),
        ("c1", 4): (d[1], d[5]),
        ("c2", 1): (d[2], d[2]),
        ("c2", 2): (d[4], d[4]),
    }


def test_medical_only_newest_file(medical_rows):
    rows = medical_rows(
        dict(), dict(int_clm_num="old", date_id=OLD_DAY), dict(int_clm_num="none", date_id=None)
    )
    assert set(by_line(medical.intermediate_medical_claims(rows))) == {("c1", 1)}


def test_medical_columns(medical_rows):
    row = medical_rows(
        dict(
            revenue_cd="120", hcpcs_proc_cd="*", cpt_proc_cd="99213", srv_units=None,
            dw_srv_units="2.5", netpay="7", dw_mem_liab_amt="2", cobamt="0.5", paid="N/A",
            icd_subm_ind="10", icd_diag10_cd="E11", icd_proc1_cd="0DT", icd_proc5_cd="0DX",
            drg_cd="470", dw_netwk_ind="N", type_admit_cd="3", admit_source_cd="1",
            disch_stat_cd="01", cpt_pmod3_cd="25", bcmbrnbr="01", curr_clm_ind="N",
        )
    )
    got = medical.intermediate_medical_claims(row).first().asDict()
    want = dict(
        claim_id="c1", claim_line_number=1, claim_type="undetermined",
        person_id="bcbs|MA|COMM.101", member_id="101", payer="bcbs", payer_type="COMM", plan="COM",
        revenue_center_code="0120", hcpcs_code=None, service_unit_quantity=2.5, paid_amount=7.0,
        allowed_amount=None, total_cost_amount=9.5, diagnosis_code_type="icd-10-cm",
        diagnosis_code_10="E11", procedure_code_type="icd-10-pcs", procedure_code_1="0DT",
        procedure_code_5="0DX", drg_code_type="ms-drg", drg_code="470", in_network_flag=0,
        admit_type_code="3", admit_source_code="1", discharge_disposition_code="01",
        hcpcs_modifier_3="25", data_source="bcbs|MA|COMM", file_name="p", file_date=DAY,
        ingest_datetime=run_time(), claim_start_date=dt.date(2024, 1, 5),
    )
    assert {k: got[k] for k in want} == want


def test_claims_may_lack_a_person(medical_rows, pharmacy_rows):
    assert medical.intermediate_medical_claims(medical_rows(dict(bcmbrnbr=None))).first().person_id is None
    assert (
        pharmacy.intermediate_pharmacy_claims(pharmacy_rows(dict(cursubid=None))).first().person_id
        is None
    )


def test_profile_is_a_parameter(medical_rows):
    other = PayerProfile("acme", "NH", "MCR", "MCR")
    got = medical.intermediate_medical_claims(medical_rows(dict()), other).first()
    assert (got.person_id, got.payer, got.data_source) == ("acme|NH|MCR.100", "acme", "acme|NH|MCR")


# --- pharmacy ----------------------------------------------------------------------------


def test_pharmacy_reversed_claim_is_gone(pharmacy_rows):
    rows = pharmacy_rows(
        dict(paid="5"), dict(paid="-5"), dict(int_clm_num="r2", paid="-5"), dict(int_clm_num="r3")
    )
    assert set(by_line(pharmacy.intermediate_pharmacy_claims(rows))) == {("r2", 1), ("r3", 1)}


def test_pharmacy_missing_claim_number(pharmacy_rows):
    kept = pharmacy_rows(dict(int_clm_num=None, paid="1"), dict())
    assert set(by_line(pharmacy.intermediate_pharmacy_claims(kept))) == {(None, 1), ("r1", 1)}
    dropped = pharmacy_rows(
        dict(int_clm_num=None), dict(), dict(int_clm_num="x"), dict(int_clm_num="x", paid="-1")
    )
    assert set(by_line(pharmacy.intermediate_pharmacy_claims(dropped))) == {("r1", 1)}
    poisoned = pharmacy_rows(dict(int_clm_num=None), dict(int_clm_num=None, paid="-1"), dict())
    assert pharmacy.intermediate_pharmacy_claims(poisoned).count() == 0


def test_pharmacy_winner_first_then_drug_code(pharmacy_rows):
    rows = pharmacy_rows(
        dict(clm_ndc=None, _run_time=run_time(2)),
        dict(_run_time=run_time(1)),
        dict(int_clm_num="r2", clm_ndc="N2", rx_curr_clm_ind="N", _run_time=run_time(2)),
        dict(int_clm_num="r2", clm_ndc="N3", rx_curr_clm_ind="y", _run_time=run_time(1)),
    )
    got = by_line(pharmacy.intermediate_pharmacy_claims(rows))
    assert {k: r.ndc_code for k, r in got.items()} == {("r2", 1): "N3"}


def test_pharmacy_columns(pharmacy_rows):
    row = pharmacy_rows(
        dict(
            clm_pdea_npi="bad", pharm_npi="12345", metric_quantity="2.7", days_supply="-2.7",
            num_refills="1.0", copay_amt="n/a", netpay="3",
        )
    )
    got = pharmacy.intermediate_pharmacy_claims(row).first().asDict()
    want = dict(
        prescribing_provider_npi=None, dispensing_provider_npi="12345", quantity=2, days_supply=-2,
        refills=None, copayment_amount=None, paid_amount=3.0, claim_line_number=1, plan="COM",
        in_network_flag=None, person_id="bcbs|MA|COMM.100",
    )
    assert {k: got[k] for k in want} == want


def test_pharmacy_discarded_row_cannot_fail_the_job(pharmacy_rows):
    rows = pharmacy_rows(
        dict(metric_quantity="1e99", rx_curr_clm_ind="N"), dict(metric_quantity="3")
    )
    assert pharmacy.intermediate_pharmacy_claims(rows).first().quantity == 3


def test_pharmacy_plan_has_one_wide_shuffle_and_no_join(spark, sf_dir):
    """Where no claim is hot, adaptive execution drops the path of hot claims with its joins."""
    plan = main_plan(build.intermediate_relation("pharmacy_claim", raw_tables(spark, sf_dir)))
    assert "Join" not in plan and "SortAggregate" not in plan
    assert plan.count("Exchange hashpartitioning(claim_id") == 1


# --- members -----------------------------------------------------------------------------


def test_eligibility_full_months_only_after_the_choice(member_rows):
    feeds = members.member_feeds(
        member_rows(
            dict(cursubid="a", mem_mth_cnt=2), dict(cursubid="a"),
            dict(cursubid="b"), dict(cursubid="b", mem_mth_cnt=0, _run_time=run_time(5)),
            dict(cursubid="c", mem_mth_cnt=None), dict(cursubid="d", mem_mth_cnt=0),
            dict(cursubid="e", bcmbrnbr=None), dict(cursubid=None),
        ),
        member_rows(dict(cursubid="b", _run_time=run_time(9))),
    )
    for full_months_only in (False, True):
        months = members.intermediate_member_eligibility(feeds, full_months_only=full_months_only)
        got = [(r.member_id, r.plan) for r in members.eligibility(months).collect()]
        assert got == [("b00", "PPO")]
    all_months = members.intermediate_member_eligibility(feeds)
    assert {(r.member_id, r.x_mem_mth_cnt) for r in all_months.collect()} == {
        ("a00", 2), ("b00", 1), ("c00", None), ("d00", 0),
    }


def test_eligibility_one_row_a_month_across_feeds(member_rows):
    jan, late_jan = dt.date(2024, 1, 1), dt.date(2024, 1, 15)
    feeds = members.member_feeds(
        member_rows(dict(mem_mth_st_dt=jan), dict(mem_mth_st_dt=dt.date(2024, 2, 1))),
        member_rows(dict(mem_mth_st_dt=late_jan, mem_mth_end_dt=dt.date(2024, 2, 2))),
    )
    months = members.eligibility(members.intermediate_member_eligibility(feeds)).collect()
    assert {(r.enrollment_start_date, r.plan) for r in months} == {
        (late_jan, "PPO"),
        (dt.date(2024, 2, 1), "HMO"),
    }


def test_older_feed_leaves_eligibility_but_not_attribution(member_rows):
    feeds = members.member_feeds(member_rows(dict(date_id=OLD_DAY)), member_rows(dict()))
    months = members.eligibility(members.intermediate_member_eligibility(feeds)).collect()
    assert [r.plan for r in months] == ["PPO"]
    plans = members.provider_attribution(members.intermediate_provider_attribution(feeds)).collect()
    assert sorted(r.plan for r in plans) == ["HMO", "PPO"]


def test_eligibility_columns(member_rows):
    feeds = members.member_feeds(member_rows(dict(mem_gender="f", mem_city="Lynn")), member_rows())
    got = members.intermediate_member_eligibility(feeds).first().asDict()
    want = dict(
        person_id="bcbs|MA|COMM.100", member_id="100", subscriber_id="100", gender="female",
        death_date=None, death_flag=0, plan="HMO", x_program_type="HMO", x_market="MA",
        x_mem_mth_cnt=1, city="Lynn", file_name="f", file_date=DAY, ingest_datetime=run_time(),
        birth_date=dt.date(1980, 1, 1), payer="bcbs", payer_type="COMM",
    )
    assert {k: got[k] for k in want} == want


def test_attribution_newest_file_wins(member_rows):
    feeds = members.member_feeds(
        member_rows(
            dict(pcp_npi="bad", filename="new"),
            dict(pcp_npi=GOOD_NPI, date_id=OLD_DAY, filename="old", _run_time=run_time(9)),
            dict(cursubid="2", pcp_npi="123-456-7893", date_id=None, filename="undated"),
        ),
        member_rows(),
    )
    rows = {r.member_id: r for r in members.intermediate_provider_attribution(feeds).collect()}
    assert (rows["100"].file_name, rows["100"].payer_attributed_provider) == ("new", None)
    assert (rows["200"].file_date, rows["200"].payer_attributed_provider) == (None, GOOD_NPI)
    got = rows["100"].asDict()
    want = dict(
        patient_id="100", year_month="202401", payer_attributed_provider_lob="COMM",
        custom_attributed_provider_lob="COMM", member_effective_date=dt.date(2024, 1, 1),
        member_term_date=dt.date(2024, 1, 31), x_program_type="HMO", x_market="MA",
        data_source="bcbs|MA|COMM",
    )
    assert {k: got[k] for k in want} == want


# --- properties --------------------------------------------------------------------------


@pytest.mark.parametrize("name", FINAL)
def test_output_does_not_depend_on_input_order(spark, sf_dir, name):
    raw = raw_tables(spark, sf_dir)
    shuffled = {t: df.orderBy(F.xxhash64(*df.columns)).repartition(3) for t, df in raw.items()}
    first = rows_of_spark(build.final_relation(name, raw))
    assert first == rows_of_spark(build.final_relation(name, shuffled))
    assert first.total() > 0


@pytest.mark.parametrize("name", FINAL)
def test_full_duplicates_of_a_delivery_change_nothing(spark, sf_dir, name):
    raw = raw_tables(spark, sf_dir)
    twice = {t: df.unionAll(df) for t, df in raw.items()}
    assert rows_of_spark(build.final_relation(name, raw)) == rows_of_spark(
        build.final_relation(name, twice)
    )


def test_snapshot_filter_prunes_partitions(spark, sf_dir, tmp_path):
    raw = raw_tables(spark, sf_dir)
    for table in (HMO_MEMBER, PPO_MEMBER, MEDICAL_CLAIMS, PHARMACY_CLAIMS):
        raw[table].write.partitionBy("date_id").parquet(f"{tmp_path}/{table}")
    from claimloom.sources.tables import raw_from_files

    stored = raw_from_files(spark, str(tmp_path))
    for name in ("eligibility", "medical_claim", "pharmacy_claim"):
        plan = build.final_relation(name, stored)._jdf.queryExecution().toString()
        assert "PartitionFilters: [isnotnull(date_id" in plan
    attribution = build.final_relation("provider_attribution", stored)
    text = attribution._jdf.queryExecution().toString()
    assert "mem_street" not in text[text.index("== Physical Plan ==") :]
