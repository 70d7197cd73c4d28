"""Hot keys: same results on both paths, bounded broadcasts, no cost when nothing is hot."""

from compare import rows_of_spark
from pyspark.sql import functions as F

from claimloom.operators import classify, pick, reversal, skew
from claimloom.operators.skew import DEFAULT_RULE, HotKeyRule
from claimloom.operators.staging import stage
from claimloom.plans import build, medical, pharmacy
from claimloom.schemas import MEDICAL_RAW, PHARMACY_RAW
from claimloom.sources.tables import MEDICAL_CLAIMS, PHARMACY_CLAIMS, is_bucketed_by, store_bucketed
from workload.raw_tables import raw_tables

ALL_HOT = HotKeyRule(min_rows=0)
SOME_HOT = HotKeyRule(min_rows=5)
NONE_HOT = HotKeyRule(min_rows=10**9)
RULES = [ALL_HOT, SOME_HOT, NONE_HOT]


def skewed(spark):
    """A third of the rows under one key, a tenth without key, the rest spread."""
    return spark.range(3000).selectExpr(
        "case when id % 3 = 0 then 'hot' when id % 10 = 1 then null"
        " else cast(id % 400 as string) end as k",
        "cast(id % 50 as int) as line",
        "cast(if(id % 7 = 0, -1, 1) * (id % 5) as string) as paid",
        "if(id % 4 = 0, 'Y', 'N') as flag",
        "date_add(date '2024-01-01', cast(id % 90 as int)) as d",
    )


def final_plan(df):
    """The plan adaptive execution ended up with."""
    df.collect()
    text = df._jdf.queryExecution().toString()
    return text.split("== Final Plan ==")[1].split("== Initial Plan ==")[0]


def test_hot_keys_follow_the_rule(spark):
    df = skewed(spark)
    assert {r.k for r in skew.hot_keys(df, ["k"], HotKeyRule(100, 100)).collect()} == {"hot", None}
    assert {r.k for r in skew.hot_keys(df, ["k"], HotKeyRule(500, 100)).collect()} == {"hot"}
    assert skew.hot_keys(df, ["k"], NONE_HOT).count() == 0
    # More than a quarter of all rows: at most three keys, whatever min_rows says.
    assert {r.k for r in skew.hot_keys(df, ["k"], HotKeyRule(0, 4)).collect()} == {"hot"}


def test_number_of_hot_keys_is_bounded(spark):
    for max_keys in (1, 3, 10, 50):
        assert skew.hot_keys(skewed(spark), ["k"], HotKeyRule(0, max_keys)).count() < max(max_keys, 1)


def test_every_hot_key_is_a_candidate(spark):
    """Many keys, a few of them just above the bound, under a sketch that can not hold them all."""
    rule = HotKeyRule(min_rows=100, max_keys=200)
    rows = spark.range(0, 400_000, 1, 16).selectExpr(
        "case when id % 190 < 5 then concat('h', id % 190) else cast(id as string) end as k"
    )
    assert rule.tracked == 1050
    candidates = skew.hot_candidates(rows, ["k"], rule)
    hashes = {r.item for r in candidates.collect()}
    hot = {r.k for r in skew.hot_keys(rows, ["k"], rule).collect()}
    exact = rows.groupBy("k").count().where("count > 100 and count * 200 > 400000")
    assert hot == {r.k for r in exact.collect()} == {f"h{n}" for n in range(5)}
    assert hashes >= {r.h for r in exact.select(F.xxhash64("k").alias("h")).collect()} and len(hashes) <= 400
    assert skew.hot_keys(rows.limit(0), ["k"], rule).count() == 0


def shuffled_bytes(spark, df):
    """What the sketches of ``df`` take, all tasks together."""
    sketch = F.call_function("approx_top_k_accumulate", F.xxhash64("k"), F.lit(HotKeyRule(max_keys=200).tracked))
    return df.groupBy(F.spark_partition_id()).agg(sketch.alias("s")).select(F.sum(F.length("s.sketch"))).first()[0]


def test_sketches_do_not_grow_with_keys(spark):
    few, many = (spark.range(0, n, 1, 4).selectExpr("cast(id as string) as k") for n in (20_000, 400_000))
    assert shuffled_bytes(spark, many) < 1.5 * shuffled_bytes(spark, few)


def test_split_is_complete_and_disjoint(spark):
    df = skewed(spark)
    for rule in (HotKeyRule(100, 100), ALL_HOT, NONE_HOT):
        hot = skew.hot_keys(df, ["k", "line"], rule)
        cold, warm = skew.rows_without(df, hot), skew.rows_with(df, hot)
        assert rows_of_spark(cold) + rows_of_spark(warm) == rows_of_spark(df)


def test_operators_do_not_depend_on_the_rule(spark):
    df = skewed(spark)
    types = classify.classify_claims(df, "k", "line", "paid", "flag", "flag")

    def results(rule):
        return [
            rows_of_spark(out)
            for out in (
                skew.with_group_facts(df, ["k"], {"n": F.count("*"), "m": F.max("d")}, rule),
                reversal.drop_reversed(df, ["k", "line"], "paid", rule),
                reversal.drop_reversed(df, ["k"], "paid", rule),
                reversal.drop_reversed_not_in(df.where("k is not null"), "k", "paid", rule),
                classify.claim_span(df, "k", "d", "flag", rule),
                classify.attach_claim_type(df, types, "k", rule),
            )
        ]

    expected = results(NONE_HOT)
    assert expected[0].total() == 3000
    assert results(HotKeyRule(100, 100)) == expected
    assert results(ALL_HOT) == expected


def test_medical_does_not_depend_on_the_rule(spark, sf_dir):
    staged = build.staging_relations(raw_tables(spark, sf_dir))[MEDICAL_CLAIMS]
    # A third of the lines in one claim, some without claim or line number.
    staged = staged.withColumns(
        {
            "int_clm_num": F.expr(
                "case when svcdt is null or day(svcdt) % 3 = 0 then 'hot'"
                " when day(svcdt) = 7 then null else int_clm_num end"
            ),
            "clm_line_num": F.expr(
                "case when day(svcdt) = 9 then null when day(svcdt) % 3 = 0"
                " then cast(day(svcdt) * 1000 + cast(cursubid as int) % 300 as int)"
                " else clm_line_num end"
            ),
        }
    )
    results = [
        rows_of_spark(medical.intermediate_medical_claims(staged, rule=rule)) for rule in RULES
    ]
    assert results[0] == results[1] == results[2]
    assert results[0].total() > 1000


def test_no_hot_key_leaves_one_wide_shuffle_and_no_join(spark, sf_dir):
    staged = build.staging_relations(raw_tables(spark, sf_dir))[MEDICAL_CLAIMS]
    lines = medical.read_lines(staged)
    hot = skew.hot_keys(lines, ["claim_id"])
    versions = medical._by_window(skew.rows_without(lines, hot)).unionByName(
        medical._by_aggregate(skew.rows_with(lines, hot))
    )
    plan = final_plan(versions)
    assert "LeftAnti" not in plan and "LeftSemi" not in plan and "SortAggregate" not in plan
    assert plan.count("REPARTITION_BY_COL") == 1


def test_line_numbers_of_hot_claims(spark):
    """The same numbers by blocks as by a window; equal rows included."""
    df = skewed(spark).drop("flag").unionByName(skewed(spark).drop("flag").where("k = 'hot'"))
    order = ["d", "line"]
    want = rows_of_spark(pick.number_lines(df, "k", order, "n", NONE_HOT))
    for rule in (ALL_HOT, SOME_HOT, HotKeyRule(500, 100)):
        got = pick.number_lines(df, "k", order, "n", rule)
        assert got.columns == [*df.columns, "n"] and rows_of_spark(got) == want
    assert pick.number_lines(df.limit(0), "k", order, "n", ALL_HOT).count() == 0


def test_a_hot_claim_is_many_blocks(spark, monkeypatch):
    """A third of all rows under one claim, many of them equal: no block has more than a few parts."""
    held = []
    keep = pick.stored
    monkeypatch.setattr(pick, "stored", lambda df, label: held.append(keep(df, label)) or held[-1])
    rows = spark.range(30_000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) as k", "cast(id % 2 as int) as d")
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = pick.number_lines(rows, "k", ["d"], "n", HotKeyRule(1000, 100))
        numbers = [r.n for r in got.where("k = 'hot'").collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(numbers) == list(range(1, 10_001))
    sizes = [r["count"] for r in held[0].groupBy("_block").count().collect()]
    assert len(sizes) > 8 and max(sizes) < 3 * 10_000 / 16


def test_deliveries_bucketed_by_claim(spark, sf_dir):
    """Nothing is shuffled by claim, and the rows are those of the plain table, skew or not."""
    raw = raw_tables(spark, sf_dir)[MEDICAL_CLAIMS]
    spark.sql("create database if not exists bucketed")
    table = store_bucketed(raw, "bucketed.medical", "int_clm_num", 4)
    assert is_bucketed_by(spark, table, "int_clm_num") and not is_bucketed_by(spark, table, "svcdt")
    staged = stage(spark.read.table(table), MEDICAL_RAW)
    plain = rows_of_spark(medical.intermediate_medical_claims(stage(raw, MEDICAL_RAW)))
    for rule in (DEFAULT_RULE, SOME_HOT, ALL_HOT):
        df = medical.intermediate_medical_claims(staged, rule=rule, clustered=True)
        assert rows_of_spark(df) == plain
    df = medical.intermediate_medical_claims(staged, clustered=True)
    assert "hashpartitioning" not in final_plan(df)


def test_pharmacy_does_not_depend_on_the_rule(spark, sf_dir):
    """A third of the rows under one claim, some without a claim number; reversed or not."""
    staged = build.staging_relations(raw_tables(spark, sf_dir))[PHARMACY_CLAIMS]
    number = F.expr(
        "case when day(svcdt) % 3 = 0 then 'hot' when day(svcdt) = 7 then null else int_clm_num end"
    )
    for paid in ("paid", "'5'"):
        rows = staged.withColumn("int_clm_num", number).withColumn("paid", F.expr(paid))
        results = [rows_of_spark(pharmacy.intermediate_pharmacy_claims(rows, rule=rule)) for rule in RULES]
        assert results[0] == results[1] == results[2]
        assert results[0].total() > 50 or paid == "paid"


def test_pharmacy_takes_one_wide_shuffle(spark, sf_dir, tmp_path):
    """From files, all claims with a number: nothing is aggregated by sorting, one wide exchange."""
    rows = raw_tables(spark, sf_dir)[PHARMACY_CLAIMS].where("int_clm_num is not null")
    rows.write.partitionBy("date_id").parquet(f"{tmp_path}/rx")
    staged = stage(spark.read.parquet(f"{tmp_path}/rx"), PHARMACY_RAW)
    plan = main_plan(pharmacy.intermediate_pharmacy_claims(staged))
    assert "SortAggregate" not in plan and "Join" not in plan
    assert plan.count("Exchange hashpartitioning(claim_id") == 1


def main_plan(df):
    """The plan adaptive execution ended up with, without its subqueries."""
    df.collect()
    lines = df._jdf.queryExecution().toString().split("== Final Plan ==", 1)[1].splitlines()
    end = next(n for n, line in enumerate(lines) if line.startswith("+- == Initial Plan =="))
    kept, inside = [], None
    for line in lines[:end]:
        depth = len(line) - len(line.lstrip(" :+-"))
        if inside is not None and depth > inside:
            continue
        inside = depth if line.lstrip(" :+-").startswith("Subquery ") else None
        kept.append(line)
    return "\n".join(kept)
