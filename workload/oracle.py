"""SQL twins of the registered queries, for an independent engine.

Written as plain relational SQL (joins, HAVING, QUALIFY) and digit arithmetic, not after the
plans of the Spark side. Engine notes: ``||`` is used where NULL must propagate, truncation and
whole-number text are spelled out, and NULL order is always explicit.
"""

from __future__ import annotations

from claimloom.payer import DEFAULT_PROFILE as P
from claimloom.plans.build import FINAL_NOT_NULL, FINAL_UNIQUE, INTERMEDIATE_NOT_NULL
from claimloom.schemas import MEDICAL_RAW, MEMBER_RAW, PHARMACY_RAW
from workload.raw_tables import MEDICAL_NULL_KEYS_SQL, MEDICAL_SQL, MEMBER_SQL, PHARMACY_SQL, TABLES

_NAMES = {t: t for t in TABLES}


def _npi(column: str) -> str:
    """Ten digits whose alternately doubled digit sum, plus 24, ends in zero; else NULL."""
    digits = f"regexp_replace({column}, '[^0-9]', '', 'g')"
    terms = []
    for i in range(1, 11):
        digit = f"try_cast(substr({digits}, {i}, 1) as int)"
        terms.append(f"({digit} * 2) // 10 + ({digit} * 2) % 10" if i % 2 else digit)
    return (
        f"case when length({digits}) = 10 and (24 + {' + '.join(terms)}) % 10 = 0"
        f" then {digits} end"
    )


def _dbl(column: str) -> str:
    return f"try_cast({column} as double)"


MEMBER_KEY = "cursubid || bcmbrnbr"
PERSON_ID = f"'{P.payer}|{P.market}|{P.payer_type}.' || {MEMBER_KEY}"
REVENUE = """case when revenue_cd = '*' then null
  when length(revenue_cd) = 3 then '0' || revenue_cd else revenue_cd end"""
PROCEDURE = "nullif(coalesce(hcpcs_proc_cd, cpt_proc_cd), '*')"
DRG_TYPE = "if(drg_cd is null, null, 'ms-drg')"
DIAGNOSIS_TYPE = "case icd_subm_ind when '10' then 'icd-10-cm' when '9' then 'icd-9-cm' end"
PROCEDURE_TYPE = "if(icd_proc1_cd is null, null, 'icd-10-pcs')"
NETWORK = "case dw_netwk_ind when 'Y' then 1 when 'N' then 0 end"
TOTAL = f"{_dbl('dw_mem_liab_amt')} + {_dbl('netpay')} + {_dbl('cobamt')}"
UNITS = _dbl("coalesce(srv_units, dw_srv_units)")
GENDER = "case upper(mem_gender) when 'M' then 'male' when 'F' then 'female' else 'unknown' end"
QUANTITY = f"cast(trunc({_dbl('metric_quantity')}) as int)"
DAYS = f"cast(trunc({_dbl('days_supply')}) as int)"
REFILLS = r"""case when regexp_matches(num_refills, '^\s*[+-]?[0-9]+\s*$')
  then try_cast(num_refills as int) end"""
YEAR_MONTH = "strftime(mem_mth_st_dt, '%Y%m')"


def _current_first(flag: str) -> str:
    return (
        f"upper(coalesce({flag}, '')) = 'Y' desc, date_id desc nulls last,"
        " _run_time desc nulls last, s3_path desc nulls last"
    )


# Common tables, each usable after the ones it names.
CTE = {
    "med": MEDICAL_SQL.format(**_NAMES),
    "rx": PHARMACY_SQL.format(**_NAMES),
    "mem": MEMBER_SQL.format(**_NAMES),
    "feeds": """select * exclude (feed), case when feed = 'F' then 'HMO' else 'PPO' end as plan
  from mem""",
    "med_new": "select * from med where date_id = (select max(date_id) from med)",
    "rx_new": "select * from rx where date_id = (select max(date_id) from rx)",
    "feeds_new": "select * from feeds where date_id = (select max(date_id) from feeds)",
    "bad_line": f"""select int_clm_num, clm_line_num from med_new
  group by int_clm_num, clm_line_num
  having min({_dbl('paid')}) < 0 and max({_dbl('paid')}) > 0""",
    "bad_claim": f"""select int_clm_num from rx_new
  group by int_clm_num having min({_dbl('paid')}) < 0 and max({_dbl('paid')}) > 0""",
    "med_kept": """select m.* from med_new m left join bad_line b
  on b.int_clm_num = m.int_clm_num and b.clm_line_num = m.clm_line_num
  where b.int_clm_num is null""",
    "rx_kept": """select * from rx_new
  where int_clm_num not in (select int_clm_num from bad_claim)""",
    "types": """select m.int_clm_num,
    case when count(*) filter (where trim(m.bill_type_cd) <> '') > 0 then 'institutional'
         when count(*) filter (where trim(m.cms_place_srv_cd) <> '') > 0 then 'professional'
         else 'undetermined' end as claim_type
  from med_new m left join (select distinct int_clm_num from bad_line) b
    on b.int_clm_num = m.int_clm_num
  where b.int_clm_num is null
  group by m.int_clm_num""",
    "spans": """select int_clm_num, min(svcdt) as first_day, max(svcdt) as last_day
  from med_kept where upper(curr_clm_ind) = 'Y' group by int_clm_num""",
    "med_pick": f"""select * from med_kept qualify row_number() over (
    partition by int_clm_num, clm_line_num order by {_current_first('curr_clm_ind')}) = 1""",
    "rx_pick": f"""select * from rx_kept qualify row_number() over (
    partition by int_clm_num order by {_current_first('rx_curr_clm_ind')}) = 1""",
    "month_pick": f"""select *, {MEMBER_KEY} as member_id from feeds_new
  where {MEMBER_KEY} is not null
  qualify row_number() over (
    partition by {MEMBER_KEY}, date_trunc('month', mem_mth_st_dt)
    order by mem_mth_cnt desc nulls last, mem_mth_end_dt desc nulls last,
      _run_time desc nulls last, filename desc nulls last) = 1""",
    "plan_month_pick": f"""select *, {MEMBER_KEY} as member_id from feeds
  where {MEMBER_KEY} is not null
  qualify row_number() over (
    partition by {MEMBER_KEY}, plan, {YEAR_MONTH}
    order by date_id desc nulls last, mem_mth_end_dt desc nulls last,
      _run_time desc nulls last, filename desc nulls last) = 1""",
}


def _nulls(kind: str, *names: str) -> str:
    return ", ".join(f"cast(null as {kind}) as {n}" for n in names)


def _family(prefix: str, first: int, last: int) -> list[str]:
    return [f"{prefix}{i}" for i in range(first, last + 1)]


_CONSTANTS = f"'{P.payer}' as payer, '{P.payer_type}' as payer_type"
_SOURCE = f"'{P.payer}|{P.market}|{P.payer_type}' as data_source"

CTE["final_medical"] = f"""select w.int_clm_num as claim_id, w.clm_line_num as claim_line_number,
  t.claim_type, {PERSON_ID} as person_id, {MEMBER_KEY} as member_id, {_CONSTANTS}, lob as plan,
  coalesce(s.first_day, svcdt) as claim_start_date, coalesce(s.last_day, svcdt) as claim_end_date,
  svcdt as claim_line_start_date, {_nulls('date', 'claim_line_end_date')},
  admitdt as admission_date, dischdt as discharge_date, admit_source_cd as admit_source_code,
  type_admit_cd as admit_type_code, disch_stat_cd as discharge_disposition_code,
  cms_place_srv_cd as place_of_service_code, bill_type_cd as bill_type_code,
  {DRG_TYPE} as drg_code_type, drg_cd as drg_code, {REVENUE} as revenue_center_code,
  {UNITS} as service_unit_quantity, {PROCEDURE} as hcpcs_code,
  {", ".join(f"cpt_pmod{i}_cd as hcpcs_modifier_{i}" for i in range(1, 4))},
  {_nulls('varchar', 'hcpcs_modifier_4', 'hcpcs_modifier_5', 'rendering_tin', 'billing_tin')},
  {_nulls('varchar', 'facility_npi', 'group_id', 'group_name')},
  {_npi('sprovnpi')} as rendering_npi, {_npi('bprovnpi')} as billing_npi, pddate as paid_date,
  {_dbl('charge_amt')} as charge_amount, {_dbl('paid')} as allowed_amount,
  {_dbl('netpay')} as paid_amount, {_dbl('coins_amt')} as coinsurance_amount,
  {_dbl('copay_amt')} as copayment_amount, {_dbl('deduct_amt')} as deductible_amount,
  {TOTAL} as total_cost_amount, {DIAGNOSIS_TYPE} as diagnosis_code_type,
  {", ".join(f"icd_diag{i}_cd as diagnosis_code_{i}" for i in range(1, 11))},
  {_nulls('varchar', *_family('diagnosis_code_', 11, 25), *_family('diagnosis_poa_', 1, 25))},
  {PROCEDURE_TYPE} as procedure_code_type,
  {", ".join(f"icd_proc{i}_cd as procedure_code_{i}" for i in range(1, 6))},
  {_nulls('varchar', *_family('procedure_code_', 6, 25))},
  {_nulls('date', *_family('procedure_date_', 1, 25))}, {NETWORK} as in_network_flag, {_SOURCE},
  s3_path as file_name, date_id as file_date, _run_time as ingest_datetime
from med_pick w
left join types t on t.int_clm_num = w.int_clm_num
left join spans s on s.int_clm_num is not distinct from w.int_clm_num
where (sprovnpi is null or {_npi('sprovnpi')} is not null)
  and (bprovnpi is null or {_npi('bprovnpi')} is not null)"""

CTE["final_pharmacy"] = f"""select int_clm_num as claim_id, 1 as claim_line_number,
  {PERSON_ID} as person_id, {MEMBER_KEY} as member_id, {_CONSTANTS}, lob as plan,
  {_npi('clm_pdea_npi')} as prescribing_provider_npi, pharm_npi as dispensing_provider_npi,
  svcdt as dispensing_date, clm_ndc as ndc_code, {QUANTITY} as quantity, {DAYS} as days_supply,
  {REFILLS} as refills, pddate as paid_date, {_dbl('netpay')} as paid_amount,
  {_dbl('paid')} as allowed_amount, {_dbl('charge_amt')} as charge_amount,
  {_dbl('coins_amt')} as coinsurance_amount, {_dbl('copay_amt')} as copayment_amount,
  {_dbl('deduct_amt')} as deductible_amount, {_nulls('int', 'in_network_flag')}, {_SOURCE},
  s3_path as file_name, date_id as file_date, _run_time as ingest_datetime
from rx_pick where clm_ndc is not null"""

CTE["all_months"] = f"""select {PERSON_ID} as person_id, member_id, member_id as subscriber_id,
  {GENDER} as gender, mem_birth_dt as birth_date, {_nulls('date', 'death_date')}, 0 as death_flag,
  mem_mth_st_dt as enrollment_start_date, mem_mth_end_dt as enrollment_end_date, {_CONSTANTS},
  plan, mem_first_name as first_name, mem_last_name as last_name, mem_street as address,
  mem_city as city, mem_state as state, mem_zip_cd as zip_code, mem_phone_num as phone,
  {_nulls('varchar', 'race', 'original_reason_entitlement_code', 'dual_status_code')},
  {_nulls('varchar', 'medicare_status_code', 'group_id', 'group_name', 'name_suffix')},
  {_nulls('varchar', 'middle_name', 'email', 'ethnicity', 'social_security_number')},
  {_nulls('varchar', 'subscriber_relation', 'enrollment_status')},
  {_nulls('int', 'hospice_flag', 'institutional_snp_flag', 'long_term_institutional_flag')},
  {_SOURCE}, filename as file_name, date_id as file_date, _run_time as ingest_datetime,
  plan as x_program_type, '{P.market}' as x_market, mem_mth_cnt as x_mem_mth_cnt
from month_pick"""
CTE["final_eligibility"] = "select * from all_months where x_mem_mth_cnt = 1"

CTE["final_attribution"] = f"""select {PERSON_ID} as person_id, member_id as patient_id,
  member_id, '{P.payer}' as payer, plan, {_SOURCE}, {_npi('pcp_npi')} as payer_attributed_provider,
  {_nulls('varchar', 'payer_attributed_provider_practice')},
  {_nulls('varchar', 'payer_attributed_provider_organization', 'custom_attributed_provider')},
  {_nulls('varchar', 'custom_attributed_provider_practice')},
  {_nulls('varchar', 'custom_attributed_provider_organization', 'x_provider_specialty')},
  '{P.line_of_business}' as payer_attributed_provider_lob,
  '{P.line_of_business}' as custom_attributed_provider_lob,
  mem_mth_st_dt as member_effective_date, mem_mth_end_dt as member_term_date,
  {YEAR_MONTH} as year_month, filename as file_name, date_id as file_date,
  _run_time as ingest_datetime, plan as x_program_type, '{P.market}' as x_market
from plan_month_pick"""

# Which common tables each one reads.
_READS = {
    "feeds": ["mem"],
    "med_new": ["med"],
    "rx_new": ["rx"],
    "feeds_new": ["feeds"],
    "bad_line": ["med_new"],
    "bad_claim": ["rx_new"],
    "med_kept": ["med_new", "bad_line"],
    "rx_kept": ["rx_new", "bad_claim"],
    "types": ["med_new", "bad_line"],
    "spans": ["med_kept"],
    "med_pick": ["med_kept"],
    "rx_pick": ["rx_kept"],
    "month_pick": ["feeds_new"],
    "plan_month_pick": ["feeds"],
    "final_medical": ["med_pick", "types", "spans"],
    "final_pharmacy": ["rx_pick"],
    "all_months": ["month_pick"],
    "final_eligibility": ["all_months"],
    "final_attribution": ["plan_month_pick"],
}


def _with(tables: list[str], select: str, **instead: str) -> str:
    """``select`` after the tables it needs; ``instead`` replaces some of them."""
    needed: list[str] = []

    def visit(name: str) -> None:
        if name not in needed:
            for other in _READS.get(name, []):
                visit(other)
            needed.append(name)

    for name in tables:
        visit(name)
    text = CTE | instead
    return "with " + ",\n".join(f"{n} as ({text[n]})" for n in needed) + "\n" + select


def _columns(schema) -> str:
    return ", ".join(schema.names)


_FINAL = {
    "eligibility": "final_eligibility",
    "provider_attribution": "final_attribution",
    "medical_claim": "final_medical",
    "pharmacy_claim": "final_pharmacy",
}
# Only eligibility filters between its intermediate and its final rows.
_INTERMEDIATE = _FINAL | {"eligibility": "all_months"}


def _null_check(layer: str, table: str, relation: str, column: str) -> str:
    return (
        f"select '{layer}' as layer, '{table}' as table_name, '{column}' as column_name,"
        f" count(*) filter (where {column} is null) as failures from {relation}"
    )


def _not_null_report() -> str:
    parts = [
        _null_check("staging", "commercial_hmo_member", "feeds where plan = 'HMO'", "cursubid"),
        _null_check("staging", "commercial_ppo_member", "feeds where plan = 'PPO'", "cursubid"),
        _null_check("staging", "commercial_medical_claims", "med", "int_clm_num"),
        _null_check("staging", "commercial_pharmacy_claims", "rx", "int_clm_num"),
    ]
    for layer, columns, relation in (
        ("intermediate", INTERMEDIATE_NOT_NULL, _INTERMEDIATE),
        ("final", FINAL_NOT_NULL, _FINAL),
    ):
        parts += [_null_check(layer, t, relation[t], c) for t, cs in columns.items() for c in cs]
    return _with(["rx", *_INTERMEDIATE.values(), *_FINAL.values()], "\nunion all ".join(parts))


def _unique_report() -> str:
    parts = [
        f"select '{table}' as table_name, '{'+'.join(keys)}' as column_name, count(*) as failures"
        f" from (select 1 from {_FINAL[table]} group by {', '.join(keys)} having count(*) > 1)"
        for table, keys in FINAL_UNIQUE.items()
    ]
    return _with(list(_FINAL.values()), "\nunion all ".join(parts))


def _passing(paid: str) -> str:
    return f"""select int_clm_num, {paid} as paid, s3_path from rx_new
where int_clm_num not in (
  select int_clm_num from rx_new group by int_clm_num
  having min({_dbl(paid)}) < 0 and max({_dbl(paid)}) > 0)"""


def _not_in(paid: str) -> str:
    return _with(["rx_new"], _passing(paid))


UNSIGNED = "ltrim(paid, '-')"
NULL_SIGNED = (
    "case when int_clm_num is not null then paid when clm_ndc is null"
    " then '-' || ltrim(paid, '-') else ltrim(paid, '-') end"
)


def _case_counts() -> str:
    cases = {"some reversed": "paid", "nothing reversed": UNSIGNED, "null reversed": NULL_SIGNED}
    parts = [
        f"select count(int_clm_num) as named, count(*) filter (where int_clm_num is null) as unnamed,"
        f" '{name}' as passing from ({_passing(paid)})"
        for name, paid in cases.items()
    ]
    return _with(["rx_new"], "\nunion all ".join(parts))


_MEMBER_ROW = f"""{MEMBER_KEY} as member_id, plan, mem_mth_st_dt, mem_mth_end_dt, mem_mth_cnt,
  date_id, _run_time, filename"""

ORACLE: dict[str, str] = {
    "stage_hmo_members": _with(
        ["mem"], f"select {_columns(MEMBER_RAW)} from mem where feed = 'F'"
    ),
    "stage_ppo_members": _with(
        ["mem"], f"select {_columns(MEMBER_RAW)} from mem where feed <> 'F'"
    ),
    "stage_medical": _with(["med"], f"select {_columns(MEDICAL_RAW)} from med"),
    "stage_pharmacy": _with(["rx"], f"select {_columns(PHARMACY_RAW)} from rx"),
    "table_sink": _with(["final_eligibility"], "select * from final_eligibility"),
    "raw_files": _with(["rx"], f"select {_columns(PHARMACY_RAW)} from rx"),
    "staging_view": _with(["rx"], f"select {_columns(PHARMACY_RAW)} from rx"),
    "layer_table": _with(["final_attribution"], "select * from final_attribution"),
    "lineage_from_text": _with(
        ["final_attribution"],
        "select member_id, plan, year_month, file_name, file_date, ingest_datetime"
        " from final_attribution",
    ),
    "medical_claim_from_text": _with(["final_medical"], "select * from final_medical"),
    **{
        name: _with(
            ["final_medical"],
            "select * from final_medical",
            med=MEDICAL_NULL_KEYS_SQL.format(**_NAMES),
        )
        for name in ("medical_claim_null_keys", "medical_claim_null_keys_hot")
    },
    "medical_claim_from_view": _with(["final_medical"], "select * from final_medical"),
    "pharmacy_claim_from_view": _with(["final_pharmacy"], "select * from final_pharmacy"),
    "pharmacy_claim_from_files": _with(["final_pharmacy"], "select * from final_pharmacy"),
    "lineage": _with(
        ["med"],
        """select int_clm_num as claim_id, clm_line_num as claim_line_number,
  s3_path as file_name, date_id as file_date, _run_time as ingest_datetime from med""",
    ),
    "latest_snapshot_medical": _with(
        ["med_new"], "select int_clm_num, clm_line_num, date_id, s3_path from med_new"
    ),
    "latest_snapshot_pharmacy": _with(
        ["rx_new"], "select int_clm_num, date_id, s3_path from rx_new"
    ),
    "latest_snapshot_from_statistics": _with(
        ["rx_new"], "select int_clm_num, date_id, s3_path from rx_new"
    ),
    "latest_snapshot_member_union": _with(
        ["feeds_new"], "select plan, date_id, filename from feeds_new"
    ),
    "latest_snapshot_one_feed_behind": _with(
        ["feeds"],
        """, shifted as (select plan, filename,
  date_id - (case when plan = 'HMO' then 31 else 0 end) as date_id from feeds)
select plan, date_id, filename from shifted
where date_id = (select max(date_id) from shifted)""",
    ),
    "member_union": _with(["feeds"], f"select {_columns(MEMBER_RAW)}, plan from feeds"),
    "reversed_lines": _with(["bad_line"], "select * from bad_line"),
    "reversed_claims": _with(["bad_claim"], "select * from bad_claim"),
    "drop_reversed_lines": _with(
        ["med_kept"], "select int_clm_num, clm_line_num, paid, s3_path from med_kept"
    ),
    "drop_reversed_claims_not_in": _with(
        ["rx_kept"], "select int_clm_num, paid, s3_path from rx_kept"
    ),
    "not_in_with_nothing_reversed": _not_in(UNSIGNED),
    "not_in_with_null_reversed": _not_in(NULL_SIGNED),
    "not_in_case_counts": _case_counts(),
    "claim_type": _with(["types"], "select * from types"),
    "claim_type_of_lines": _with(
        ["types"],
        """select m.int_clm_num, m.clm_line_num, m.s3_path, t.claim_type
  from med_new m left join types t on t.int_clm_num = m.int_clm_num""",
    ),
    "claim_span": _with(
        ["med_new"],
        """select int_clm_num, clm_line_num, svcdt, curr_clm_ind, s3_path,
  coalesce(min(svcdt) filter (where upper(curr_clm_ind) = 'Y')
    over (partition by int_clm_num), svcdt) as claim_start_date,
  coalesce(max(svcdt) filter (where upper(curr_clm_ind) = 'Y')
    over (partition by int_clm_num), svcdt) as claim_end_date
from med_new""",
    ),
    "pick_medical_line": _with(
        ["med_new"],
        f"""select int_clm_num, clm_line_num, curr_clm_ind, date_id, _run_time, s3_path
from med_new qualify row_number() over (
  partition by int_clm_num, clm_line_num order by {_current_first('curr_clm_ind')}) = 1""",
    ),
    "pick_pharmacy_claim": _with(
        ["rx_new"],
        f"""select int_clm_num, rx_curr_clm_ind, date_id, _run_time, s3_path
from rx_new qualify row_number() over (
  partition by int_clm_num order by {_current_first('rx_curr_clm_ind')}) = 1""",
    ),
    "pick_member_month": _with(["month_pick"], f"select {_MEMBER_ROW} from month_pick"),
    "pick_member_plan_month": _with(
        ["plan_month_pick"], f"select {_MEMBER_ROW} from plan_month_pick"
    ),
    "line_numbers": _with(
        ["rx_new"],
        f"""select int_clm_num, svcdt, clm_ndc, cast(row_number() over (
  partition by int_clm_num order by svcdt nulls first, clm_ndc nulls first) as int)
  as claim_line_number
from (select * from rx_new qualify row_number() over (
  partition by int_clm_num order by {_current_first('rx_curr_clm_ind')}) = 1)
where clm_ndc is not null""",
    ),
    "valid_npi": _with(
        ["med"], f"select s3_path, sprovnpi, {_npi('sprovnpi')} as rendering_npi from med"
    ),
    "npi_null_policy": _with(
        ["feeds"],
        f"select filename, pcp_npi, {_npi('pcp_npi')} as payer_attributed_provider from feeds",
    ),
    "npi_drop_policy": _with(
        ["med"],
        f"""select int_clm_num, clm_line_num, s3_path, sprovnpi, bprovnpi,
  {_npi('sprovnpi')} as rendering_npi, {_npi('bprovnpi')} as billing_npi
from med where (sprovnpi is null or {_npi('sprovnpi')} is not null)
  and (bprovnpi is null or {_npi('bprovnpi')} is not null)""",
    ),
    "npi_passthrough_policy": _with(
        ["rx"], "select s3_path, pharm_npi, pharm_npi as dispensing_provider_npi from rx"
    ),
    "revenue_code": _with(
        ["med"], f"select s3_path, revenue_cd, {REVENUE} as revenue_center_code from med"
    ),
    "procedure_code": _with(
        ["med"],
        f"select s3_path, hcpcs_proc_cd, cpt_proc_cd, {PROCEDURE} as hcpcs_code from med",
    ),
    "code_types": _with(
        ["med"],
        f"""select s3_path, {DRG_TYPE} as drg_code_type, {DIAGNOSIS_TYPE} as diagnosis_code_type,
  {PROCEDURE_TYPE} as procedure_code_type from med""",
    ),
    "gender": _with(["feeds"], f"select filename, mem_gender, {GENDER} as gender from feeds"),
    "network_flag": _with(
        ["med"], f"select s3_path, dw_netwk_ind, {NETWORK} as in_network_flag from med"
    ),
    "total_cost": _with(["med"], f"select s3_path, {TOTAL} as total_cost_amount from med"),
    "service_units": _with(
        ["med"], f"select s3_path, srv_units, dw_srv_units, {UNITS} as service_unit_quantity from med"
    ),
    "tolerant_numbers": _with(
        ["rx"],
        f"""select s3_path, {_dbl('copay_amt')} as copayment_amount,
  {_dbl('paid')} as allowed_amount, {QUANTITY} as quantity, {DAYS} as days_supply,
  {REFILLS} as refills from rx""",
    ),
    "person_ids": _with(
        ["feeds"],
        f"select filename, {MEMBER_KEY} as member_id, {PERSON_ID} as person_id from feeds",
    ),
    "year_month": _with(["feeds"], f"select filename, {YEAR_MONTH} as year_month from feeds"),
    "not_null_report": _not_null_report(),
    "unique_report": _unique_report(),
    "line_numbers_of_hot_claims": _with(
        ["med"],
        """select *, cast(row_number() over (partition by int_clm_num order by svcdt nulls first,
  s3_path nulls first, clm_line_num nulls first) as int) as number
from (select case when extract(day from svcdt) % 3 = 0 then 'hot' else int_clm_num end as int_clm_num,
        clm_line_num, svcdt, s3_path from med)""",
    ),
    "table_descriptions": _with(
        ["final_eligibility", "final_attribution", "final_medical", "final_pharmacy"],
        """select d.table_name, column_name, description, n_rows from (values
  ('eligibility', '', 'One row per member and full month of enrollment'),
  ('eligibility', 'enrollment_status', 'Not delivered by the payer; always null'),
  ('eligibility', 'hospice_flag', '1 in hospice, 0 not, null unknown; always null here'),
  ('eligibility', 'institutional_snp_flag',
   '1 in an institutional special needs plan, 0 not, null unknown; always null here'),
  ('eligibility', 'long_term_institutional_flag',
   '1 in a long-term institution, 0 not, null unknown; always null here'),
  ('provider_attribution', '',
   'One row per member, plan and month with the attributed primary care provider'),
  ('medical_claim', '', 'Current version of each medical claim line'),
  ('pharmacy_claim', '', 'Current version of each pharmacy claim')
) d(table_name, column_name, description)
join (select 'eligibility' as table_name, count(*) as n_rows from final_eligibility
  union all select 'provider_attribution', count(*) from final_attribution
  union all select 'medical_claim', count(*) from final_medical
  union all select 'pharmacy_claim', count(*) from final_pharmacy) n using (table_name)""",
    ),
    "duplicate_raw_lines": _with(
        ["med"],
        """select int_clm_num, clm_line_num, count(*) as n_rows from med
group by int_clm_num, clm_line_num having count(*) > 1""",
    ),
    "int_member_eligibility": _with(["all_months"], "select * from all_months"),
    "eligibility": _with(["final_eligibility"], "select * from final_eligibility"),
    "provider_attribution": _with(["final_attribution"], "select * from final_attribution"),
    "medical_claim": _with(["final_medical"], "select * from final_medical"),
    "medical_claim_bucketed": _with(["final_medical"], "select * from final_medical"),
    "medical_claim_with_hot_claims": _with(["final_medical"], "select * from final_medical"),
    "pharmacy_claim": _with(["final_pharmacy"], "select * from final_pharmacy"),
}
