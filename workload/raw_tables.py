"""Claims-shaped raw tables derived from the test tables.

One text serves both engines: the braces stand for the tables it reads. Every expression aims
at a branch of the claims logic (missing keys, reversals, bad identifiers, sentinels).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.schemas import MEDICAL_RAW, PASSTHROUGH
from claimloom.sources.shared import in_compiled_methods
from claimloom.sources.tables import HMO_MEMBER, MEDICAL_CLAIMS, PHARMACY_CLAIMS, PPO_MEMBER

MEDICAL_SQL = """
select cast(l_orderkey as string) as int_clm_num,
  l_linenumber as clm_line_num,
  case when l_partkey % 7 = 0 then '*' when l_partkey % 7 = 1 then null
       when l_partkey % 7 < 4 then substr(cast(1000 + l_suppkey % 1000 as string), 2, 3)
       else '0' || substr(cast(1000 + l_suppkey % 1000 as string), 2, 3) end as revenue_cd,
  case when l_orderkey % 3 = 0 then '11' when l_orderkey % 3 = 1 then ' ' else null end as cms_place_srv_cd,
  cast(o_custkey as string) as cursubid,
  case when o_custkey % 50 = 0 then null else '0' || cast(o_custkey % 3 as string) end as bcmbrnbr,
  'wrong' as payer, 'wrong' as market, o_orderpriority as lob,
  cast(l_shipdate as date) as svcdt,
  case when l_orderkey % 5 = 0 then cast(o_orderdate as date) else null end as admitdt,
  case when l_orderkey % 5 = 0 then cast(l_shipdate as date) else null end as dischdt,
  cast(l_linenumber as string) as admit_source_cd,
  cast(l_linenumber % 3 as string) as type_admit_cd,
  '01' as disch_stat_cd,
  case when l_orderkey % 5 = 0 then '111' when l_orderkey % 5 = 1 then '' else null end as bill_type_cd,
  case when l_orderkey % 5 = 0 then '470' else null end as drg_cd,
  case when l_partkey % 9 = 0 then null else cast(cast(l_quantity as int) as string) end as srv_units,
  case when l_partkey % 2 = 0 then 'x' else '1' end as dw_srv_units,
  case when l_partkey % 6 = 0 then null when l_partkey % 6 = 1 then '*' else 'G0' || cast(l_suppkey as string) end as hcpcs_proc_cd,
  '9921' || cast(l_linenumber as string) as cpt_proc_cd,
  '25' as cpt_pmod1_cd, cast(null as string) as cpt_pmod2_cd, cast(null as string) as cpt_pmod3_cd,
  case when l_partkey % 11 = 0 then null when l_partkey % 11 = 1 then '12345'
       when l_partkey % 11 = 2 then '123-456-7893'
       when l_partkey % 11 = 3 then cast(1000000000 + l_partkey * 7919 as string)
       else '1234567893' end as sprovnpi,
  case when l_suppkey % 13 = 0 then '' when l_suppkey % 13 < 6 then '1245319599' else null end as bprovnpi,
  cast(o_orderdate as date) as pddate,
  cast(l_extendedprice as string) as charge_amt,
  cast(l_quantity as string) as netpay,
  case when l_returnflag = 'R' then '-' || cast(l_extendedprice as string)
       when l_partkey % 17 = 0 then 'N/A' else cast(l_extendedprice as string) end as paid,
  cast(l_tax as string) as coins_amt, cast(l_discount as string) as copay_amt, '' as deduct_amt,
  cast(l_discount as string) as dw_mem_liab_amt,
  case when l_partkey % 19 = 0 then null else '0' end as cobamt,
  case when l_partkey % 3 = 0 then '10' when l_partkey % 3 = 1 then '9' else '0' end as icd_subm_ind,
  'E' || cast(l_partkey % 100 as string) as icd_diag1_cd, 'I' || cast(l_suppkey % 100 as string) as icd_diag2_cd,
  cast(null as string) as icd_diag3_cd, cast(null as string) as icd_diag4_cd, cast(null as string) as icd_diag5_cd,
  cast(null as string) as icd_diag6_cd, cast(null as string) as icd_diag7_cd, cast(null as string) as icd_diag8_cd,
  cast(null as string) as icd_diag9_cd, cast(null as string) as icd_diag10_cd,
  case when l_partkey % 4 = 0 then '0DT' else null end as icd_proc1_cd,
  cast(null as string) as icd_proc2_cd, cast(null as string) as icd_proc3_cd,
  cast(null as string) as icd_proc4_cd, cast(null as string) as icd_proc5_cd,
  case when l_suppkey % 4 = 0 then 'Y' when l_suppkey % 4 = 1 then 'N' when l_suppkey % 4 = 2 then 'y' else null end as dw_netwk_ind,
  case when l_linestatus = 'O' then 'Y' when l_partkey % 3 = 0 then 'y' when l_partkey % 3 = 1 then 'N' else null end as curr_clm_ind,
  case when l_suppkey % 10 < 8 then date '2024-03-31' when l_suppkey % 10 = 8 then date '2024-02-29' else null end as date_id,
  l_shipdate as _run_time,
  's3://raw/' || cast(l_partkey as string) || '/' || cast(l_suppkey as string) as s3_path,
  'f' || cast(l_partkey as string) as filename
from {lineitem} join {orders} on l_orderkey = o_orderkey
"""

# ``feed`` tells the two member tables apart: F is HMO, everything else PPO.
MEMBER_SQL = """
select cast(o_custkey as string) as cursubid,
  case when o_custkey % 50 = 0 then null else '0' || cast(o_custkey % 3 as string) end as bcmbrnbr,
  c_name as mem_first_name, c_mktsegment as mem_last_name,
  date '1950-01-01' + cast(c_custkey % 20000 as int) as mem_birth_dt,
  case o_custkey % 5 when 0 then 'M' when 1 then 'f' when 2 then 'F' when 3 then 'U' else null end as mem_gender,
  cast(date_trunc('quarter', o_orderdate) as date) + cast(o_orderkey % 20 as int) as mem_mth_st_dt,
  cast(date_trunc('quarter', o_orderdate) as date) + 30 as mem_mth_end_dt,
  'wrong' as payer, 'wrong' as market, o_orderpriority as netwk_prod_cd, 'wrong' as lob,
  'st' || cast(c_nationkey as string) as mem_street, cast(null as string) as mem_street2,
  c_mktsegment as mem_city, 'MA' as mem_state, '02139' as mem_zip_cd, cast(null as string) as mem_phone_num,
  case o_orderkey % 4 when 0 then null when 1 then '12345' when 2 then '123-456-7893'
       else cast(1000000000 + o_orderkey * 7919 as string) end as pcp_npi,
  case o_orderkey % 10 when 0 then 2 when 1 then 0 when 2 then null else 1 end as mem_mth_cnt,
  'f' || cast(o_orderkey as string) as filename,
  case when o_orderkey % 10 < 8 then date '2024-03-31' when o_orderkey % 10 = 8 then date '2024-02-29' else null end as date_id,
  's3://mem/' || cast(o_orderkey as string) as s3_path,
  o_orderdate as _run_time, o_orderstatus as feed
from {orders} join {customer} on o_custkey = c_custkey
"""

PHARMACY_SQL = """
select case when event_id % 997 = 0 then null else cast(event_id % 4000 as string) end as int_clm_num,
  cast(user_id as string) as cursubid, '0' || cast(user_id % 3 as string) as bcmbrnbr,
  'wrong' as payer, 'wrong' as market, event_type as lob,
  case event_id % 4 when 0 then null when 1 then '12345' when 2 then '123-456-7893'
       else cast(1000000000 + event_id * 7919 as string) end as clm_pdea_npi,
  '12345' as pharm_npi, cast(ts as date) as svcdt,
  case when event_id % 9 = 0 then null else 'N' || cast(user_id as string) end as clm_ndc,
  cast(value as string) as metric_quantity,
  case event_id % 4 when 0 then '30' when 1 then '30.7' when 2 then 'x' else '-2.5' end as days_supply,
  case event_id % 3 when 0 then '2' when 1 then '' else 'x' end as num_refills,
  cast(ts as date) + 3 as pddate,
  cast(value as string) as charge_amt, cast(value as string) as netpay,
  case when event_type = 'error' and event_id % 997 <> 0 then '-' || cast(value as string)
       else cast(value as string) end as paid,
  '1.5' as coins_amt, 'n/a' as copay_amt, cast(null as string) as deduct_amt,
  case when event_type in ('click', 'view') then 'y' when event_type = 'signup' then 'N' else null end as rx_curr_clm_ind,
  case when event_id % 10 < 8 then date '2024-03-31' else date '2024-02-29' end as date_id,
  ts as _run_time, 's3://rx/' || cast(event_id as string) as s3_path, 'r' || cast(event_id as string) as filename
from {events}
"""

# Medical lines with missing claim numbers, line numbers and service dates mixed in.
MISSING = {
    "int_clm_num": "case when bprovnpi = '' then null else int_clm_num end",
    "clm_line_num": "case when revenue_cd = '*' then null else clm_line_num end",
    "svcdt": "case when dw_netwk_ind is null then null else svcdt end",
}
MEDICAL_NULL_KEYS_SQL = "select {} from ({}) as lines".format(
    ", ".join(f"{MISSING.get(name, name)} as {name}" for name in MEDICAL_RAW.names), MEDICAL_SQL
)

TABLES = ("lineitem", "orders", "customer", "events")


def _derive(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    in_compiled_methods(spark)
    used = [t for t in TABLES if f"{{{t}}}" in sql]
    return spark.sql(sql, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used})


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four raw tables, lazily."""
    member = _derive(spark, sf_dir, MEMBER_SQL)
    hmo = F.col("feed") == "F"
    return {
        HMO_MEMBER: member.where(hmo).drop("feed"),
        PPO_MEMBER: member.where(~hmo).drop("feed"),
        MEDICAL_CLAIMS: _derive(spark, sf_dir, MEDICAL_SQL),
        PHARMACY_CLAIMS: _derive(spark, sf_dir, PHARMACY_SQL),
    }


def medical_with_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, MEDICAL_NULL_KEYS_SQL)


def as_delivered(df: DataFrame, metadata: tuple[str, ...] = ()) -> DataFrame:
    """The same table with every contract column as text, as a raw file would have it.

    Metadata columns keep their types but for those named.
    """
    typed = set(PASSTHROUGH) - set(metadata)
    return df.select(
        *(F.col(c) if c in typed else F.col(c).cast(T.StringType()).alias(c) for c in df.columns)
    )
