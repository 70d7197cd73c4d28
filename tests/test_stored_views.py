"""Stored intermediate views against the plans; newest dates from file statistics."""

import datetime as dt

import pytest
from compare import rows_of_spark
from conftest import DAY, OLD_DAY
from pyspark.sql import functions as F

from claimloom.__main__ import main
from claimloom.operators.snapshot import latest_snapshot
from claimloom.plans import build
from claimloom.plans.stored_views import store_intermediate_views
from claimloom.sources.tables import (
    HMO_MEMBER,
    MEDICAL_CLAIMS,
    PHARMACY_CLAIMS,
    PPO_MEMBER,
    newest_delivery,
    newest_from_statistics,
    newest_in_footers,
    store_staging_views,
)
from workload.raw_tables import raw_tables


def views_of(spark, raw, database):
    spark.sql(f"create database if not exists {database}")
    for name, df in raw.items():
        df.write.mode("overwrite").saveAsTable(f"{database}.{name}")
    store_staging_views(spark, database, database, build.staging_views())
    return store_intermediate_views(spark, database, database)


def same(spark, views, raw):
    # By name, in a session that knows nothing of the plans.
    fresh = spark.newSession()
    fresh.conf.set("spark.sql.session.timeZone", "UTC")
    for output, view in views.items():
        got, want = fresh.read.table(view), build.intermediate_relation(output, raw)
        assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]
        assert rows_of_spark(got) == rows_of_spark(want), output


def test_views_equal_the_plans(spark, sf_dir):
    raw = raw_tables(spark, sf_dir)
    views = views_of(spark, raw, "views_all")
    same(spark, views, raw)
    # Lines and claims share the one shuffle by claim.
    plan = spark.read.table(views["medical_claim"])._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert physical.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("rows", ["none", "some", "unnamed", "unnamed reversed"])
def test_views_of_odd_rows(spark, medical_rows, pharmacy_rows, member_rows, rows):
    """Ties, NULL keys, reversals, unreadable amounts, and what NOT IN makes of them."""
    medical = [
        dict(int_clm_num="1", paid="5", curr_clm_ind="y"), dict(int_clm_num="1", paid="-5"),
        dict(int_clm_num="1", clm_line_num=2, revenue_cd="*", sprovnpi="12"), dict(int_clm_num="1", clm_line_num=3),
        dict(int_clm_num=None, paid="5"), dict(int_clm_num=None, paid="-5"), dict(int_clm_num="2", date_id=OLD_DAY),
        dict(int_clm_num="3", paid="x", drg_cd="1"), dict(int_clm_num="3", paid="x", drg_cd="2", netpay=""),
    ]
    pharmacy = [
        dict(int_clm_num="1", paid="5"), dict(int_clm_num="1", paid="-5"), dict(int_clm_num="2", clm_ndc=None),
        dict(int_clm_num="3", num_refills="1.0", days_supply="3.9"), dict(int_clm_num="3", num_refills=" 2 ", days_supply="3.9"),
    ]
    pharmacy += {
        "unnamed": [dict(int_clm_num=None, paid="7")],
        "unnamed reversed": [dict(int_clm_num=None, paid="7"), dict(int_clm_num=None, paid="-7")],
    }.get(rows, [])
    if rows == "unnamed":
        pharmacy = pharmacy[2:]
    member = [
        dict(cursubid="1", mem_gender="m"), dict(cursubid="1", mem_gender="f"), dict(cursubid=None),
        dict(cursubid="2", date_id=OLD_DAY), dict(cursubid="3", mem_mth_cnt=None, pcp_npi="1"),
    ]
    cut = 0 if rows == "none" else None
    raw = {
        HMO_MEMBER: member_rows(*member),
        PPO_MEMBER: member_rows(*member[:2]),
        MEDICAL_CLAIMS: medical_rows(*medical),
        PHARMACY_CLAIMS: pharmacy_rows(*pharmacy),
    }
    if cut == 0:
        raw = {name: df.limit(0) for name, df in raw.items()}
    same(spark, views_of(spark, raw, f"views_{rows.replace(' ', '_')}"), raw)


def test_job_with_views_then_tables(spark, medical_rows, pharmacy_rows, member_rows):
    raw = {
        HMO_MEMBER: member_rows(dict()), PPO_MEMBER: member_rows(dict(cursubid="3")),
        MEDICAL_CLAIMS: medical_rows(dict()), PHARMACY_CLAIMS: pharmacy_rows(dict()),
    }
    spark.sql("create database if not exists views_raw")
    for name, df in raw.items():
        df.write.mode("overwrite").saveAsTable(f"views_raw.{name}")
    args = ["--raw-database", "views_raw", "--final-database", "views_out", "--staging-database", "views_stg"]
    args += ["--intermediate-database", "views_int"]
    name = "views_int.int_bcbs_medical_claims"
    for flag, kind in (("--intermediate-views", "VIEW"), ("--store-intermediate", "EXTERNAL")):
        assert main([*args, flag]) == 0
        assert spark.catalog.getTable(name).tableType == kind
        assert spark.newSession().read.table(name).count() == 1


def test_newest_date_from_footers(spark, tmp_path, medical_rows):
    """The plan reads one column that the reader made from footers; the session is as before."""
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    rows = medical_rows(dict(date_id=OLD_DAY), dict(date_id=DAY), dict(date_id=DAY))
    path = f"{tmp_path}/plain"
    rows.write.parquet(path)
    plan = newest_in_footers(spark, path)._jdf.queryExecution().toString()
    assert "PushedAggregation: [MAX(date_id)]" in plan and "ReadSchema: struct<max(date_id):date>" in plan
    assert newest_from_statistics(spark, path) == DAY
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    raw = spark.read.parquet(path)
    assert latest_snapshot(raw, newest=DAY).count() == latest_snapshot(raw).count() == 2


def test_no_statistics_no_date(spark, tmp_path, medical_rows):
    """Blocks without a date, no rows, text, a missing column: the plan's own scan decides."""
    rows = medical_rows(dict(date_id=DAY), dict(date_id=None))
    frames = {
        "undated": rows.repartition(2), "empty": rows.limit(0), "text": rows.withColumn("date_id", F.lit("x")),
        "stamp": rows.withColumn("date_id", F.lit(dt.datetime(2024, 1, 1))), "none": rows.drop("date_id"),
    }
    frames["undated"] = rows.where("date_id IS NULL")
    for name, df in frames.items():
        df.write.parquet(f"{tmp_path}/{name}")
        assert newest_from_statistics(spark, f"{tmp_path}/{name}") is None, name


def test_newest_delivery_of_tables(spark, medical_rows):
    spark.sql("create database if not exists newest")
    rows = medical_rows(dict(date_id=OLD_DAY), dict(date_id=DAY))
    rows.write.mode("overwrite").saveAsTable("newest.plain")
    rows.write.mode("overwrite").partitionBy("date_id").saveAsTable("newest.parts")
    rows.write.mode("overwrite").partitionBy("lob").saveAsTable("newest.other")
    rows.write.mode("overwrite").format("orc").saveAsTable("newest.orc")
    got = [newest_delivery(spark, f"newest.{t}") for t in ("plain", "parts", "other", "orc")]
    assert got == [DAY, DAY, None, None]
