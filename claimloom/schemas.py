"""Column contracts of every layer, as ``StructType`` constants.

A contract is written as text, one name after another; a name without a type is a string.
Numbered families (``diagnosis_code_1 .. 25``) are generated.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def contract(text: str, comments: dict[str, str] | None = None) -> T.StructType:
    """Parse ``"name name:type ..."``; comments become column comments of the written table."""
    comments = comments or {}
    fields = []
    for token in text.split():
        name, _, kind = token.partition(":")
        metadata = {"comment": comments[name]} if name in comments else {}
        fields.append(T.StructField(name, _TYPES[kind or "string"], True, metadata))
    return T.StructType(fields)


def numbered(prefix: str, last: int, kind: str = "string") -> str:
    """Contract text of a numbered family."""
    return " ".join(f"{prefix}{i}:{kind}" for i in range(1, last + 1))


# Raw columns that staging passes on without a cast.
PASSTHROUGH = frozenset({"payer", "market", "lob", "filename", "s3_path", "_run_time"})

_RAW_COMMENTS = {
    "cursubid": "Subscriber number, first half of the member key",
    "bcmbrnbr": "Member number, second half of the member key",
    "pcp_npi": "NPI of the primary care provider the member is attributed to",
    "payer": "Unreliable in the raw files; outputs use the profile's payer",
    "market": "Unreliable in the raw files; outputs use the profile's market",
    "lob": "Unreliable in the raw files; only claims expose it, as plan",
    "int_clm_num": "Claim number",
    "clm_line_num": "Line number within the claim",
    "curr_clm_ind": "Y marks the current version of a line, N a negative adjustment",
    "charge_amt": "Charged amount",
    "netpay": "What the insurer paid; becomes paid_amount",
    "paid": "Allowed amount, insurer plus patient; becomes allowed_amount",
    "coins_amt": "Coinsurance amount",
    "copay_amt": "Copayment amount",
    "deduct_amt": "Deductible amount",
    "dw_mem_liab_amt": "Member liability, part of total_cost_amount",
    "cobamt": "Coordination of benefits, part of total_cost_amount",
    "clm_ndc": "National drug code",
    "pddate": "Paid date",
    "date_id": "Date of the delivered file; each file restates all history",
    "s3_path": "Path of the delivered file",
    "_run_time": "Time the file was ingested",
}

# Raw column names in delivery order.
MEMBER_RAW = contract(
    """cursubid bcmbrnbr mem_first_name mem_last_name mem_birth_dt:date mem_gender
    mem_mth_st_dt:date mem_mth_end_dt:date payer market netwk_prod_cd lob mem_street mem_street2
    mem_city mem_state mem_zip_cd mem_phone_num pcp_npi mem_mth_cnt:int filename date_id:date
    s3_path _run_time:timestamp""",
    _RAW_COMMENTS,
)
MEDICAL_RAW = contract(
    f"""int_clm_num clm_line_num:int revenue_cd cms_place_srv_cd cursubid bcmbrnbr payer market lob
    svcdt:date admitdt:date dischdt:date admit_source_cd type_admit_cd disch_stat_cd bill_type_cd
    drg_cd srv_units dw_srv_units hcpcs_proc_cd cpt_proc_cd cpt_pmod1_cd cpt_pmod2_cd cpt_pmod3_cd
    sprovnpi bprovnpi pddate:date charge_amt netpay paid coins_amt copay_amt deduct_amt
    dw_mem_liab_amt cobamt icd_subm_ind {" ".join(f"icd_diag{i}_cd" for i in range(1, 11))}
    {" ".join(f"icd_proc{i}_cd" for i in range(1, 6))} dw_netwk_ind curr_clm_ind date_id:date
    _run_time:timestamp s3_path filename""",
    _RAW_COMMENTS,
)
PHARMACY_RAW = contract(
    """int_clm_num cursubid bcmbrnbr payer market lob clm_pdea_npi pharm_npi svcdt:date clm_ndc
    metric_quantity days_supply num_refills pddate:date charge_amt netpay paid coins_amt copay_amt
    deduct_amt rx_curr_clm_ind date_id:date _run_time:timestamp s3_path filename""",
    _RAW_COMMENTS,
)

# Output column names in contract order.
ELIGIBILITY = contract(
    """person_id member_id subscriber_id gender race birth_date:date death_date:date death_flag:int
    enrollment_start_date:date enrollment_end_date:date payer payer_type plan
    original_reason_entitlement_code dual_status_code medicare_status_code group_id group_name
    name_suffix first_name middle_name last_name email ethnicity social_security_number
    subscriber_relation enrollment_status hospice_flag:int institutional_snp_flag:int
    long_term_institutional_flag:int address city state zip_code phone data_source file_name
    file_date:date ingest_datetime:timestamp x_program_type x_market x_mem_mth_cnt:int""",
    {
        "enrollment_status": "Not delivered by the payer; always null",
        "hospice_flag": "1 in hospice, 0 not, null unknown; always null here",
        "institutional_snp_flag": "1 in an institutional special needs plan, 0 not, null unknown; always null here",
        "long_term_institutional_flag": "1 in a long-term institution, 0 not, null unknown; always null here",
    },
)
PROVIDER_ATTRIBUTION = contract(
    """person_id patient_id member_id payer plan data_source payer_attributed_provider
    payer_attributed_provider_practice payer_attributed_provider_organization
    payer_attributed_provider_lob custom_attributed_provider custom_attributed_provider_practice
    custom_attributed_provider_organization custom_attributed_provider_lob
    member_effective_date:date member_term_date:date year_month file_name file_date:date
    ingest_datetime:timestamp x_provider_specialty x_program_type x_market"""
)
MEDICAL_CLAIM = contract(
    f"""claim_id claim_line_number:int claim_type person_id member_id payer payer_type plan
    claim_start_date:date claim_end_date:date claim_line_start_date:date claim_line_end_date:date
    admission_date:date discharge_date:date admit_source_code admit_type_code
    discharge_disposition_code place_of_service_code bill_type_code drg_code_type drg_code
    revenue_center_code service_unit_quantity:double hcpcs_code {numbered("hcpcs_modifier_", 5)}
    rendering_npi rendering_tin billing_npi billing_tin facility_npi paid_date:date
    charge_amount:double allowed_amount:double paid_amount:double coinsurance_amount:double
    copayment_amount:double deductible_amount:double total_cost_amount:double diagnosis_code_type
    {numbered("diagnosis_code_", 25)} {numbered("diagnosis_poa_", 25)} procedure_code_type
    {numbered("procedure_code_", 25)} {numbered("procedure_date_", 25, "date")} in_network_flag:int
    group_id group_name data_source file_name file_date:date ingest_datetime:timestamp"""
)
PHARMACY_CLAIM = contract(
    """claim_id claim_line_number:int person_id member_id payer payer_type plan
    prescribing_provider_npi dispensing_provider_npi dispensing_date:date ndc_code quantity:int
    days_supply:int refills:int paid_date:date paid_amount:double allowed_amount:double
    charge_amount:double coinsurance_amount:double copayment_amount:double deductible_amount:double
    in_network_flag:int data_source file_name file_date:date ingest_datetime:timestamp"""
)

# What each table is.
TABLE_COMMENTS = {
    "eligibility": "One row per member and full month of enrollment",
    "provider_attribution": "One row per member, plan and month with the attributed primary care provider",
    "medical_claim": "Current version of each medical claim line",
    "pharmacy_claim": "Current version of each pharmacy claim",
}
