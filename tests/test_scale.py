"""Large tables: bucket numbers, deliveries written without a sort, code that Java compiles."""

import datetime as dt
import os
import re
import time

import pytest
from compare import rows_of_spark
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from claimloom.operators.snapshot import newest_with_rows
from claimloom.plans import build, medical
from claimloom.plans.stored_views import store_intermediate_views
from claimloom.sources import shared, tables
from claimloom.sources.shared import METHOD_LIMIT, OPEN_WRITERS, in_compiled_methods, open_writers
from claimloom.sources.tables import MEDICAL_CLAIMS


def test_buckets_grow_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(tables, "BUCKET_ROWS", 100)
    spark.sql("create database if not exists buckets")
    for rows, buckets in ((150, 4), (950, 10)):
        df = spark.range(rows).selectExpr("cast(id as string) as k", "date '2024-03-31' as date_id")
        table = tables.store_bucketed(df, f"buckets.t{rows}", "k", 4)
        facts = {r.col_name: r.data_type for r in spark.sql(f"describe extended {table}").collect()}
        assert int(facts["Num Buckets"]) == buckets
        assert rows_of_spark(spark.read.table(table)) == rows_of_spark(df)


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def _tables(spark, database):
    return [r.tableName for r in spark.sql(f"show tables in {database}").collect() if not r.isTemporary]


def _delivered(spark, rows):
    """Keys that repeat, some NULL, as some dates are; the keys come out of a shuffle."""
    return (
        spark.range(rows)
        .selectExpr("if(id % 50 = 0, null, cast(id % 900 as string)) as k", "id")
        .repartition(3, "id")
        .selectExpr("k", "id", "if(id % 7 = 0, null, date_add(date '2024-03-01', cast(id % 2 as int))) as date_id")
    )


def test_a_large_bucketed_table_is_stored_in_passes(spark, monkeypatch):
    """No shuffle holds the whole table or is left behind; the table is as one pass would make it."""
    monkeypatch.setattr(tables, "BUCKET_ROWS", 100)
    monkeypatch.setattr(tables, "PASSES", 3)
    spark.sql("create database if not exists passes")
    df, store, seen, before = _delivered(spark, 2950), tables._store_in_passes, [], _shuffle_files(spark)

    def noting(table, writer, rows, passes):
        seen.extend(rows.where(p).count() for p in passes)
        store(table, writer, rows, passes)

    monkeypatch.setattr(tables, "_store_in_passes", noting)
    table = tables.store_bucketed(df, "passes.t", "k", 4)
    assert len(seen) == 3 and sum(seen) == 2950 and max(seen) < 2950 / 2
    until = time.time() + 20
    while (left := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left and shared.DROP_SHUFFLES not in spark.conf.getAll

    facts = {r.col_name: r.data_type for r in spark.sql(f"describe extended {table}").collect()}
    assert (facts["Num Buckets"], facts["Type"]) == ("30", "MANAGED") and tables.is_bucketed_by(spark, table, "k")
    got = spark.newSession().read.table(table)
    assert rows_of_spark(got.select(*df.columns)) == rows_of_spark(df)
    assert tables.newest_partition(spark, table) == dt.date(2024, 3, 2)
    # A bucket of a delivery is one file, and groups by key need no shuffle.
    files = [(os.path.dirname(f), re.search(r"_(\d{5})\.", f)[1]) for f in got.inputFiles()]
    assert len(files) == len(set(files)) and len({bucket for _, bucket in files}) > 20
    assert "Exchange" not in got.groupBy("k").count()._jdf.queryExecution().toString()
    assert _tables(spark, "passes") == ["t"]


def test_a_pass_that_fails_leaves_no_table(spark, monkeypatch):
    monkeypatch.setattr(tables, "BUCKET_ROWS", 100)
    spark.sql("create database if not exists stopped")
    df = _delivered(spark, 950)
    number = F.when(F.col("id") == 77, F.raise_error(F.lit("no row"))).otherwise(F.col("id"))
    with pytest.raises(Exception, match="no row"):
        tables.store_bucketed(df.withColumn("id", number), "stopped.t", "k", 4)
    assert not _tables(spark, "stopped")
    tables.store_bucketed(df, "stopped.t", "k", 4)
    with pytest.raises(AnalysisException, match="ALREADY_EXISTS"):
        tables.store_bucketed(df.limit(500), "stopped.t", "k", 4)
    assert _tables(spark, "stopped") == ["t"]
    assert rows_of_spark(spark.read.table("stopped.t").select(*df.columns)) == rows_of_spark(df)
    assert spark.read.table(tables.store_bucketed(df.limit(0), "stopped.none", "k", 4)).count() == 0


def _insert_sorts(spark):
    plan = spark.sql("explain insert into deliveries.t select k, date_id from delivered").first()[0]
    return "Sort " in plan


def test_deliveries_are_written_without_a_sort(spark, tmp_path, monkeypatch):
    df = spark.range(200).selectExpr(
        "id as k", "if(id % 5 = 0, null, date_add(date '2024-03-01', cast(id % 20 as int))) as date_id"
    )
    df.createOrReplaceTempView("delivered")
    spark.sql("create database if not exists deliveries")
    spark.sql("create table deliveries.t (k bigint, date_id date) using parquet partitioned by (date_id)")
    assert _insert_sorts(spark)
    with open_writers(spark, 8):
        assert not _insert_sorts(spark)
    spark.catalog.dropTempView("delivered")
    assert OPEN_WRITERS not in spark.conf.getAll
    inside = []

    def noting(*args):
        inside.append(args)
        return open_writers(*args)

    monkeypatch.setattr(tables, "open_writers", noting)
    # More dates than open files: the rest is sorted, and no row is lost.
    tables.write_deliveries(df.coalesce(1), f"{tmp_path}/t")
    assert inside and rows_of_spark(spark.read.parquet(f"{tmp_path}/t")) == rows_of_spark(df)


def test_partitions_grow_with_the_lines(spark, medical_rows, monkeypatch):
    """At any number of lines a task the rows are the same; without a date there are none."""
    old, none = dt.date(2024, 2, 29), {"date_id": None}
    lines = medical_rows(*({"int_clm_num": str(i), "clm_line_num": i % 3} for i in range(50)), {"date_id": old}, none)
    assert newest_with_rows(lines) == (dt.date(2024, 3, 31), 50)
    assert newest_with_rows(lines, newest=old) == (old, 1)
    assert newest_with_rows(medical_rows(none)) == (None, 0)
    assert newest_with_rows(lines.withColumn("date_id", F.col("date_id").cast("string"))) == (None, 52)
    plain = rows_of_spark(medical.intermediate_medical_claims(lines))
    monkeypatch.setattr(medical, "TASK_ROWS", 5)
    df = medical.intermediate_medical_claims(lines)
    assert "hashpartitioning(claim_id" in (plan := df._jdf.queryExecution().toString()) and ", 10), REPARTITION_BY_NUM" in plan
    assert len(plain) == 50 and rows_of_spark(df) == plain
    assert medical.intermediate_medical_claims(medical_rows(none)).count() == 0


def test_stored_view_has_partitions_for_its_lines(spark, medical_rows, monkeypatch):
    """Counted when the view is stored; the rows are the plan's at any number, and without lines."""
    lines = medical_rows(*({"int_clm_num": str(i), "clm_line_num": i % 3} for i in range(50)), {"date_id": None})
    spark.sql("create database if not exists views_scale")
    monkeypatch.setattr(medical, "TASK_ROWS", 5)
    for df, number in ((lines, ", 10), REPARTITION_BY_NUM"), (lines.limit(0), "), REPARTITION_BY_COL")):
        df.write.mode("overwrite").saveAsTable(f"views_scale.{MEDICAL_CLAIMS}")
        staged = {name: of for name, of in build.staging_views().items() if of[0] == MEDICAL_CLAIMS}
        tables.store_staging_views(spark, "views_scale", "views_scale", staged)
        view = store_intermediate_views(spark, "views_scale", "views_scale", outputs=["medical_claim"])["medical_claim"]
        got = spark.newSession().read.table(view)
        assert number in got._jdf.queryExecution().toString()
        assert rows_of_spark(got) == rows_of_spark(medical.intermediate_medical_claims(df))


def test_wide_projections_are_cut_into_methods(spark, medical_rows):
    spark.conf.unset(METHOD_LIMIT)
    medical.intermediate_medical_claims(medical_rows({"date_id": dt.date(2024, 3, 31)}))
    assert int(spark.conf.get(METHOD_LIMIT)) == shared.METHOD_BYTES == 8000
    spark.conf.set(METHOD_LIMIT, 65535)
    in_compiled_methods(spark)
    assert spark.conf.get(METHOD_LIMIT) == "65535"
    spark.conf.unset(METHOD_LIMIT)
