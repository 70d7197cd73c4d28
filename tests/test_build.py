"""Sources, sinks and the whole build."""

import uuid

import pytest
from compare import rows_of_spark
from conftest import DAY, OLD_DAY, run_time
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimloom import DEFAULT_PROFILE
from claimloom.__main__ import main
from claimloom.operators import pick
from claimloom.operators.quality import SAME_KEY, check_unique
from claimloom.operators.snapshot import latest_snapshot
from claimloom.plans import build, medical, members, pharmacy
from claimloom.sources import tables
from claimloom.sources.tables import (
    HMO_MEMBER,
    MEDICAL_CLAIMS,
    PHARMACY_CLAIMS,
    PPO_MEMBER,
    RAW_TABLES,
    FileSink,
    Layers,
    TableSink,
    database_of,
    newest_partition,
    raw_from_catalog,
    raw_from_files,
    register_views,
    write_layer,
)
from workload.raw_tables import raw_tables


@pytest.fixture
def clean_raw(medical_rows, pharmacy_rows, member_rows):
    """Deliveries that pass every check."""
    return {
        HMO_MEMBER: member_rows(dict(), dict(cursubid="2", mem_mth_cnt=0)),
        PPO_MEMBER: member_rows(dict(cursubid="3")),
        MEDICAL_CLAIMS: medical_rows(dict(), dict(clm_line_num=2), dict(int_clm_num="c2")),
        PHARMACY_CLAIMS: pharmacy_rows(dict(), dict(_run_time=run_time(1))),
    }


def files(spark, root):
    return dict(sink=FileSink(spark, str(root)))


def test_layer_names():
    layers = Layers.of(DEFAULT_PROFILE)
    assert (layers.raw, layers.final) == ("raw_data", "input_layer")
    assert (layers.staging, layers.intermediate) == ("bcbs_staging", "bcbs_intermediate")


def test_layer_is_used_verbatim(spark):
    assert database_of(spark, "  input_layer ") == "input_layer"
    assert database_of(spark, None) == spark.catalog.currentDatabase()


def test_write_layer_replaces_the_table_and_keeps_comments(spark, sf_dir):
    df = build.final_relation("eligibility", raw_tables(spark, sf_dir))
    assert write_layer(df.limit(0), "eligibility", " layer_a ") == "layer_a.eligibility"
    table = write_layer(df, "eligibility", "layer_a")
    assert rows_of_spark(spark.read.table(table)) == rows_of_spark(df)
    described = {r.col_name: r.comment for r in spark.sql(f"describe {table}").collect()}
    assert "hospice" in described["hospice_flag"]
    details = {r.col_name: r.data_type for r in spark.sql(f"describe extended {table}").collect()}
    assert details["Comment"].startswith("One row per member")


def test_write_without_layer_goes_to_the_current_database(spark):
    assert write_layer(spark.range(3), "no_layer").endswith("default.no_layer")
    assert spark.read.table("no_layer").count() == 3


def test_build_writes_four_tables_and_passes(spark, tmp_path, clean_raw):
    report = build.build(clean_raw, **files(spark, tmp_path))
    assert not report.failed and not report.skipped
    counts = {n: spark.read.parquet(p).count() for n, p in report.written.items()}
    assert counts == {
        "eligibility": 2, "provider_attribution": 3, "medical_claim": 3, "pharmacy_claim": 1,
    }
    kinds = [(c.layer, c.table_name) for c in report.checks]
    not_null = [c for c in report.checks if "+" not in c.column_name]
    assert len(not_null) == 22 and len(kinds) - len(not_null) == 4
    again = build.build(clean_raw, **files(spark, tmp_path / "again"))
    for name, path in report.written.items():
        assert rows_of_spark(spark.read.parquet(path)) == rows_of_spark(
            spark.read.parquet(again.written[name])
        )


def test_build_skips_outputs_of_a_failed_input(spark, tmp_path, clean_raw, pharmacy_rows):
    raw = clean_raw | {PHARMACY_CLAIMS: pharmacy_rows(dict(), dict(int_clm_num=None))}
    report = build.build(raw, **files(spark, tmp_path))
    assert list(report.skipped) == ["pharmacy_claim"] and not report.errors
    assert [(c.layer, c.table_name, c.failures) for c in report.failed] == [
        ("staging", PHARMACY_CLAIMS, 1)
    ]
    assert set(report.written) == {"eligibility", "provider_attribution", "medical_claim"}


def broken_medical(medical_rows):
    return {MEDICAL_CLAIMS: medical_rows(dict(), dict(clm_line_num=2, bcmbrnbr=None))}


@pytest.fixture(params=["files", "tables"])
def sink(request, spark, tmp_path):
    if request.param == "files":
        return FileSink(spark, str(tmp_path))
    return TableSink(spark, f"safe_{uuid.uuid4().hex[:8]}")


def test_failed_intermediate_check_keeps_the_published_table(sink, clean_raw, medical_rows):
    first = build.build(clean_raw, sink)
    assert first.ok
    before = rows_of_spark(sink.read(first.written["medical_claim"]))
    report = build.build(clean_raw | broken_medical(medical_rows), sink)
    assert {(c.layer, c.column_name, c.failures) for c in report.failed} == {
        ("intermediate", "person_id", 1)
    }
    assert list(report.skipped) == ["medical_claim"] and not report.ok
    assert set(report.written) == set(build.FINALIZE) - {"medical_claim"}
    assert rows_of_spark(sink.read(first.written["medical_claim"])) == before


def test_raising_refresh_keeps_the_published_table(sink, clean_raw):
    where = sink.publish(sink.store(clean_raw[MEDICAL_CLAIMS], "some"), "some")
    before = rows_of_spark(sink.read(where))
    with pytest.raises(Exception, match="too bad"):
        sink.store(clean_raw[MEDICAL_CLAIMS].withColumn("lob", F.raise_error(F.lit("too bad"))), "some")
    assert rows_of_spark(sink.read(where)) == before
    again = sink.publish(sink.store(clean_raw[MEDICAL_CLAIMS].limit(1), "some"), "some")
    assert again == where and sink.read(where).count() == 1


def test_nothing_pending_is_left(spark, clean_raw, medical_rows):
    sink = TableSink(spark, "tidy")
    build.build(clean_raw, sink)
    build.build(clean_raw | broken_medical(medical_rows), sink)
    assert {t.name for t in spark.catalog.listTables("tidy")} == set(build.FINALIZE)


def test_final_checks_are_reported(spark, tmp_path, clean_raw, medical_rows):
    raw = clean_raw | {MEDICAL_CLAIMS: medical_rows(dict(), dict(clm_line_num=None))}
    report = build.build(raw, **files(spark, tmp_path))
    assert {(c.layer, c.column_name, c.failures) for c in report.failed} == {
        ("final", "claim_line_number", 1)
    }
    assert "medical_claim" in report.written


def two_winners(df, keys, prefer, tiebreak=()):
    """A choice that is broken: it leaves two rows of a key."""
    ranking = [*prefer, *pick.then_all_others(df, tiebreak)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*map(F.desc_nulls_last, ranking)))
    return df.withColumn("_rank", rank).where("_rank <= 2").drop("_rank")


@pytest.fixture
def broken_choice(monkeypatch, clean_raw, member_rows, medical_rows, pharmacy_rows):
    """Two rows a key in every table."""
    monkeypatch.setattr(members, "pick_current", two_winners)
    version = pharmacy._by_window
    monkeypatch.setattr(pharmacy, "_by_window", lambda rows: version(rows).unionByName(version(rows)))
    by_window = medical._with_counted_keys
    monkeypatch.setattr(medical, "_with_counted_keys", lambda rows, count: by_window(rows.unionByName(rows), count))
    return clean_raw | {
        HMO_MEMBER: member_rows(dict(mem_first_name="x"), dict(), dict(), dict(cursubid="2"), dict(cursubid="4", mem_mth_cnt=2), dict(cursubid="4")),
        MEDICAL_CLAIMS: medical_rows(dict(), dict(clm_line_num=2), dict(int_clm_num="c2")),
        PHARMACY_CLAIMS: pharmacy_rows(dict(), dict(int_clm_num="r2"), dict(int_clm_num="r3", clm_ndc=None)),
    }


#: Keys with two rows: member 1's month; its plan and month, and member 4's; all lines; claims with a drug.
REPEATED = {"eligibility": 1, "provider_attribution": 2, "medical_claim": 3, "pharmacy_claim": 2}


@pytest.mark.parametrize("hold", [False, True])
def test_repeated_keys_are_found_on_the_way(sink, broken_choice, hold):
    report = build.build(broken_choice, sink, hold_final=hold)
    assert not report.errors
    unique = {c.table_name: c.failures for c in report.checks if c.layer == "final" and "+" in c.column_name}
    assert unique == REPEATED
    assert set(report.skipped if hold else report.written) == set(build.FINALIZE)
    if not hold:
        for name, keys in build.FINAL_UNIQUE.items():
            assert check_unique(sink.read(report.written[name]), name, keys).first().failures == REPEATED[name]


def shuffles(df):
    return str(df._jdf.queryExecution().executedPlan()).count("Exchange hashpartitioning")


def test_counting_keys_shuffles_nothing(spark, sf_dir):
    raw = raw_tables(spark, sf_dir)
    for name in build.FINALIZE:
        plain, counted = (build.intermediate_relation(name, raw, count_keys=c) for c in (False, True))
        assert shuffles(plain) == shuffles(counted) > 0, name
        assert counted.columns == [*plain.columns, SAME_KEY]
        assert counted.where(f"{SAME_KEY} > 1").count() == 0


def test_intermediate_rows_are_stored_in_the_pass(spark, clean_raw, medical_rows):
    layer = f"inter_{uuid.uuid4().hex[:8]}"
    inner, outer = TableSink(spark, layer), TableSink(spark, f"{layer}_final")
    report = build.build(clean_raw, outer, intermediate_sink=inner)
    assert report.ok and len(report.written) == 8
    for name in build.FINALIZE:
        stored = inner.read(report.written[build.intermediate_name(name)])
        assert rows_of_spark(stored) == rows_of_spark(build.intermediate_relation(name, clean_raw))
        assert rows_of_spark(outer.read(report.written[name])) == rows_of_spark(build.final_relation(name, clean_raw))
    before = rows_of_spark(inner.read(f"{layer}.int_bcbs_medical_claims"))
    # A value that can not be read, and rows that fail: their tables stay, the others are written.
    raw = clean_raw | broken_medical(medical_rows)
    raw |= {HMO_MEMBER: clean_raw[HMO_MEMBER].withColumn("mem_birth_dt", F.lit("19x0-01-01"))}
    report = build.build(raw, outer, intermediate_sink=inner)
    assert set(report.errors) == {"eligibility"} and set(report.skipped) == {"medical_claim"}
    assert rows_of_spark(inner.read(f"{layer}.int_bcbs_medical_claims")) == before
    assert {"pharmacy_claim", "provider_attribution"} <= set(report.written)


def test_one_bad_value_stops_its_tables_only(sink, clean_raw):
    raw = clean_raw | {
        HMO_MEMBER: clean_raw[HMO_MEMBER].withColumn("mem_birth_dt", F.lit("19x0-01-01"))
    }
    report = build.build(raw, sink)
    assert set(report.written) == set(build.FINALIZE) - {"eligibility"}
    assert "19x0-01-01" in report.errors["eligibility"] and not report.ok
    assert {c.table_name for c in report.checks if c.layer == "final"} == set(report.written)


def test_intermediate_check_sees_every_row(spark, tmp_path, clean_raw, monkeypatch):
    """Rows that can not become full months are checked, too."""
    seen = []
    whole = build.intermediate_relation

    def spy(name, raw, profile, full_months_only=False, newest=None, **rest):
        seen.append(full_months_only)
        return whole(name, raw, profile, full_months_only, newest, **rest)

    monkeypatch.setattr(build, "intermediate_relation", spy)
    build.build(clean_raw, **files(spark, tmp_path))
    assert seen == [False] * 4


def test_comments_may_hold_quotes(spark, monkeypatch):
    monkeypatch.setitem(tables.TABLE_COMMENTS, "quoted", "it's a \\ 'table'")
    table = write_layer(spark.range(1), "quoted", "layer_q")
    details = {r.col_name: r.data_type for r in spark.sql(f"describe extended {table}").collect()}
    assert details["Comment"] == "it's a \\ 'table'"


def test_newest_partition_has_rows(spark, medical_rows):
    spark.sql("create database if not exists parts")
    rows = medical_rows(dict(date_id=OLD_DAY), dict(date_id=DAY), dict(date_id=DAY))
    rows.write.mode("overwrite").partitionBy("date_id").saveAsTable("parts.medical")
    spark.sql("alter table parts.medical add partition (date_id = date'2024-05-31')")
    assert newest_partition(spark, "parts.medical") == DAY
    raw = spark.read.table("parts.medical")
    assert latest_snapshot(raw, newest=DAY).count() == latest_snapshot(raw).count() == 2


def test_job_from_catalog(spark, clean_raw, capsys):
    spark.sql("create database if not exists delivered")
    for name, df in clean_raw.items():
        df.write.mode("overwrite").partitionBy("date_id").saveAsTable(f"delivered.{name}")
    assert set(raw_from_catalog(spark, "delivered")) == set(RAW_TABLES)
    code = main(["--raw-database", "delivered", "--final-database", "job_out"])
    out = capsys.readouterr().out
    assert code == 0 and "FAIL" not in out and "SKIPPED" not in out
    assert spark.read.table("job_out.medical_claim").count() == 3
    assert spark.read.table("bcbs_staging.stg_bcbs_medical_claims").count() == 3
    assert not spark.catalog.tableExists("bcbs_intermediate.int_bcbs_member_eligibility")
    main(["--raw-database", "delivered", "--final-database", "job_out", "--store-intermediate"])
    assert spark.read.table("bcbs_intermediate.int_bcbs_member_eligibility").count() == 3


def test_raw_from_files_in_any_format(spark, tmp_path, clean_raw):
    for name, df in clean_raw.items():
        df.write.format("orc").partitionBy("date_id").save(f"{tmp_path}/{name}")
    raw = raw_from_files(spark, str(tmp_path), "orc")
    report = build.build(raw, **files(spark, tmp_path / "out"))
    assert not report.failed


def test_named_relations(spark, sf_dir):
    relations = build.named_relations(raw_tables(spark, sf_dir))
    assert set(relations) == {
        "stg_bcbs_commercial_hmo_member", "stg_bcbs_commercial_ppo_member",
        "stg_bcbs_medical_claims", "stg_bcbs_pharmacy_claims", "int_bcbs_member_eligibility",
        "int_bcbs_provider_attribution", "int_bcbs_medical_claims", "int_bcbs_pharmacy_claims",
    }
    register_views(relations)
    got = spark.sql("select count(*) as n from stg_bcbs_medical_claims").first().n
    assert got == relations["stg_bcbs_medical_claims"].agg(F.count("*")).first()[0]


def test_unknown_output(spark, sf_dir):
    with pytest.raises(KeyError):
        build.intermediate_relation("other", raw_tables(spark, sf_dir))
