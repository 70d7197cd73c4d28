"""Operators on hand-written rows."""

import datetime as dt

import pytest
from conftest import DAY, OLD_DAY, run_time
from pyspark.sql import functions as F

from claimloom.operators import classify, identifiers, pick, quality, reversal
from claimloom.operators.conform import conform
from claimloom.operators.snapshot import latest_snapshot
from claimloom.operators.staging import stage
from claimloom.operators.union import tagged_union
from claimloom.schemas import MEMBER_RAW, contract

LINE_KEY = ["int_clm_num", "clm_line_num"]


def lines(spark, *rows):
    return spark.createDataFrame(list(rows), "int_clm_num string, clm_line_num int, paid string")


def test_stage_casts_and_drops_unknown_columns(spark):
    row = {n: None for n in MEMBER_RAW.names} | {
        "cursubid": "7", "mem_birth_dt": "1980-01-02", "mem_mth_cnt": "1", "date_id": "2024-03-31",
    }
    raw = spark.createDataFrame(
        [tuple(row.values()) + ("x",)], ", ".join(f"{n} string" for n in [*row, "extra"])
    )
    staged = stage(raw, MEMBER_RAW)
    assert staged.columns == MEMBER_RAW.names
    got = staged.first()
    assert (got.mem_birth_dt, got.mem_mth_cnt, got.date_id) == (dt.date(1980, 1, 2), 1, DAY)


@pytest.mark.parametrize("bad", ["20240105", "01/05/2024", "x"])
def test_stage_is_strict(spark, bad):
    raw = spark.createDataFrame(
        [tuple(bad if n == "mem_birth_dt" else None for n in MEMBER_RAW.names)],
        ", ".join(f"{n} string" for n in MEMBER_RAW.names),
    )
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stage(raw, MEMBER_RAW).collect()


def test_latest_snapshot_ignores_missing_dates(spark):
    df = spark.createDataFrame([(1, DAY), (2, OLD_DAY), (3, None)], "i int, date_id date")
    assert [r.i for r in latest_snapshot(df).collect()] == [1]
    assert latest_snapshot(df.where("date_id is null")).count() == 0


def test_latest_snapshot_of_a_union_drops_the_feed_behind(spark):
    old = spark.createDataFrame([(1, OLD_DAY)], "i int, date_id date")
    new = spark.createDataFrame([(2, DAY)], "i int, date_id date")
    got = latest_snapshot(tagged_union({"HMO": old, "PPO": new}, "plan")).collect()
    assert [(r.i, r.plan) for r in got] == [(2, "PPO")]


def test_reversed_keys(spark):
    df = lines(
        spark,
        ("a", 1, "10"), ("a", 1, "-10"),  # reversed
        ("b", 1, "-5"),  # all negative
        ("c", 1, "0"), ("c", 1, "5"),  # zero is neutral
        ("d", 1, "N/A"), ("d", 1, "-5"),  # unreadable is neutral
        ("e", None, "1"), ("e", None, "-1"),  # NULL line groups together
    )
    got = {tuple(r) for r in reversal.reversed_keys(df, LINE_KEY, "paid").collect()}
    assert got == {("a", 1), ("e", None)}


def test_drop_reversed_keeps_rows_that_cannot_match(spark):
    df = lines(
        spark,
        ("a", 1, "10"), ("a", 1, "-10"), ("a", 2, "3"),
        ("e", None, "1"), ("e", None, "-1"),
        (None, 1, "1"), (None, 1, "-1"),
    )
    got = reversal.drop_reversed(df, LINE_KEY, "paid")
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(
        [("a", 2, "3"), ("e", None, "1"), ("e", None, "-1"), (None, 1, "1"), (None, 1, "-1")],
        key=str,
    )


@pytest.mark.parametrize(
    "rows, kept",
    [
        ([("a", "1"), ("a", "-1"), ("b", "2"), (None, "3")], ["b"]),
        ([("a", "1"), ("b", "2"), (None, "3")], ["a", "b", None]),
        ([(None, "1"), (None, "-1"), ("b", "2")], []),
        ([("a", "1"), ("a", "-1"), (None, "1"), (None, "-1")], []),
    ],
)
def test_drop_reversed_not_in_treats_null_like_sql(spark, rows, kept):
    df = spark.createDataFrame(rows, "k string, paid string")
    df.createOrReplaceTempView("not_in_rows")
    got = [r.k for r in reversal.drop_reversed_not_in(df, "k", "paid").collect()]
    literal = spark.sql(
        """select k from not_in_rows where k not in (
             select k from not_in_rows group by k
             having min(cast(paid as double)) < 0 and max(cast(paid as double)) > 0)"""
    )
    assert sorted(got, key=str) == sorted((r.k for r in literal.collect()), key=str)
    assert sorted(got, key=str) == sorted(kept, key=str)


def test_not_in_never_broadcasts_the_set(spark):
    df = spark.createDataFrame([("a", "1")], "k string, paid string")
    plan = reversal.drop_reversed_not_in(df, "k", "paid")._jdf.queryExecution().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "isNullAware" not in plan


def test_pick_prefers_current_then_newest(spark):
    df = spark.createDataFrame(
        [
            ("a", "N", run_time(9), "p1"), ("a", "y", run_time(1), "p2"), ("a", "Y", run_time(2), "p3"),
            ("b", "N", run_time(1), "p4"), ("b", None, run_time(2), "p5"),
            ("c", "Y", None, "p6"), ("c", "Y", run_time(1), "p7"),
            (None, "Y", run_time(1), "p8"), (None, "Y", run_time(1), "p9"),
        ],
        "k string, flag string, at timestamp, path string",
    )
    from claimloom.functions.codes import is_yes

    picked = pick.pick_current(df, ["k"], [is_yes("flag"), F.col("at")], ["path"])
    assert sorted(r.path for r in picked.collect()) == ["p3", "p5", "p7", "p9"]


def test_pick_is_independent_of_input_order(spark):
    df = spark.range(2000).selectExpr(
        "id % 7 as k", "cast(id % 3 as string) as a", "cast(id % 5 as string) as b"
    )
    forward = pick.pick_current(df, ["k"], [F.col("a")])
    backward = pick.pick_current(df.orderBy(F.desc("b"), "a").repartition(5), ["k"], [F.col("a")])
    assert sorted(map(tuple, forward.collect())) == sorted(map(tuple, backward.collect()))


def test_pick_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id")
    plan = pick.pick_current(df, ["k"], [F.col("id")])._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert "Partial" in physical and physical.count("WindowGroupLimit") == 2
    assert physical.index("Exchange") < physical.index("row_number(), 1, Partial")


def test_best_is_the_same_choice(spark):
    df = spark.range(1000).selectExpr(
        "id % 11 as k", "if(id % 13 = 0, null, id % 17) as a", "id as b"
    )
    by_rank = pick.pick_current(df, ["k"], [F.col("a"), F.col("b")])
    by_max = df.groupBy("k").agg(pick.best(["a", "b"]).alias("r"))
    assert sorted(map(tuple, by_rank.collect())) == sorted(
        map(tuple, by_max.select("k", "r.*").collect())
    )


def test_number_lines_puts_nulls_first(spark):
    df = spark.createDataFrame(
        [("a", DAY, "x"), ("a", None, "y"), ("a", DAY, None)], "k string, d date, n string"
    )
    got = {(r.d, r.n): r.line for r in pick.number_lines(df, "k", ["d", "n"], "line").collect()}
    assert got == {(None, "y"): 1, (DAY, None): 2, (DAY, "x"): 3}


def test_claim_types(spark, medical_rows):
    rows = medical_rows(
        dict(int_clm_num="inst", bill_type_cd="111", curr_clm_ind="N"),
        dict(int_clm_num="inst", clm_line_num=2, cms_place_srv_cd="11"),
        dict(int_clm_num="prof", bill_type_cd=" ", cms_place_srv_cd="11"),
        dict(int_clm_num="none", bill_type_cd="", cms_place_srv_cd=" "),
        dict(int_clm_num="rev", paid="1", bill_type_cd="111"),
        dict(int_clm_num="rev", paid="-1", bill_type_cd="111"),
        dict(int_clm_num="rev", clm_line_num=2, bill_type_cd="111"),
        dict(int_clm_num="nline", clm_line_num=None, paid="1"),
        dict(int_clm_num="nline", clm_line_num=None, paid="-1"),
        dict(int_clm_num=None, paid="1"),
        dict(int_clm_num=None, paid="-1", cms_place_srv_cd="11"),
    )
    types = classify.classify_claims(rows, *LINE_KEY, "paid", "bill_type_cd", "cms_place_srv_cd")
    assert {tuple(r) for r in types.collect()} == {
        ("inst", "institutional"),
        ("prof", "professional"),
        ("none", "undetermined"),
        (None, "professional"),
    }
    attached = classify.attach_claim_type(rows.select(*LINE_KEY, "paid"), types, "int_clm_num")
    got = {(r.int_clm_num, r.claim_type) for r in attached.collect()}
    assert attached.count() == rows.count()
    assert got == {
        ("inst", "institutional"), ("prof", "professional"), ("none", "undetermined"),
        ("rev", None), ("nline", None), (None, None),
    }


def test_claim_span_uses_current_lines_else_each_line(spark, medical_rows):
    d = [dt.date(2024, 1, i) for i in range(1, 6)]
    rows = medical_rows(
        dict(int_clm_num="a", svcdt=d[1]),
        dict(int_clm_num="a", clm_line_num=2, svcdt=d[3], curr_clm_ind="y"),
        dict(int_clm_num="a", clm_line_num=3, svcdt=d[4], curr_clm_ind="N"),
        dict(int_clm_num="b", svcdt=d[0], curr_clm_ind="N"),
        dict(int_clm_num="b", clm_line_num=2, svcdt=d[2], curr_clm_ind=None),
    )
    spans = classify.claim_span(rows, "int_clm_num", "svcdt", "curr_clm_ind")
    got = {(r.int_clm_num, r.clm_line_num): (r.claim_start_date, r.claim_end_date) for r in spans.collect()}
    assert got == {
        ("a", 1): (d[1], d[3]), ("a", 2): (d[1], d[3]), ("a", 3): (d[1], d[3]),
        ("b", 1): (d[0], d[0]), ("b", 2): (d[2], d[2]),
    }


def test_id_policies(spark):
    df = spark.createDataFrame([("1234567893",), ("bad",), ("",), (None,)], "npi string")

    def run(policy):
        return [r.out for r in identifiers.with_valid_id(df, "npi", "out", policy).collect()]

    assert run("null") == ["1234567893", None, None, None]
    assert run("drop_row") == ["1234567893", None]
    assert run("passthrough") == ["1234567893", "bad", "", None]
    with pytest.raises(ValueError):
        run("other")


def test_conform(spark):
    schema = contract("b:int a x:date c", {"a": "letters"})
    df = spark.createDataFrame([(1, "z", "dropped")], "b long, a string, other string")
    out = conform(df, schema, {"c": F.lit("k")})
    assert out.dtypes == [("b", "int"), ("a", "string"), ("x", "date"), ("c", "string")]
    assert tuple(out.first()) == (1, "z", None, "k")
    assert out.schema["a"].metadata == {"comment": "letters"}
    with pytest.raises(ValueError, match="nope"):
        conform(df, schema, {"nope": F.lit(1)})
    with pytest.raises(Exception, match="INVALID_COLUMN_OR_FIELD_DATA_TYPE"):
        conform(df, schema, {"b": F.lit("text")})


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x"), (None, "x")], "a int, b string")
    got = {(r.column_name, r.failures) for r in quality.check_not_null(df, "t", ["a", "b"]).collect()}
    assert got == {("a", 1), ("b", 2)}
    assert [tuple(r) for r in quality.duplicate_keys(df, ["a", "b"]).collect()] == [(1, None, 2)]
    assert quality.check_unique(df, "t", ["a", "b"]).first().failures == 1
    assert quality.check_unique(df.where("a = 2"), "t", ["a", "b"]).first().failures == 0
