"""Headline timings: one JSON line.

The four raw tables are first derived from the test tables and stored the way deliveries are,
as Parquet partitioned by file date. Each output is then timed from those files to a stored
table, planning included. One untimed round warms the JVM; the median of the timed rounds
counts. Other inputs are timed beside the four tables and do not count in the sum: a third of all
medical lines under one claim, twelve cumulative pharmacy deliveries, and pharmacy claims that all
have a number.

``calibration_sec`` is a fixed job that calls no code of this library: rows made, shuffled, sorted and
grouped. It is timed in every round, so that a slower machine can be told from slower code:
``per_calibration`` are the seconds of the tables divided by it.

``shuffles`` are the stages of a run that wrote shuffle records, whatever became of them in the
final plan, and ``shuffle_mb`` what they wrote; both are read from Spark's event log.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from collections import defaultdict
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.plans.build import FINALIZE, final_relation
from claimloom.sources.shared import new_folder
from claimloom.sources.tables import MEDICAL_CLAIMS, PHARMACY_CLAIMS, write_files
from workload.raw_tables import raw_tables

ROUNDS = 3
DELIVERIES = 12


def session(events: str) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        # Keep the generated code of all plans between rounds.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", f"file://{events}")
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.rolling.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def skewed(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """A third of the medical lines under one claim."""
    hot = F.pmod(F.xxhash64("s3_path"), F.lit(3)) == 0
    lines = raw[MEDICAL_CLAIMS]
    number = F.when(hot, "hot").otherwise(F.col("int_clm_num"))
    return {MEDICAL_CLAIMS: lines.withColumn("int_clm_num", number)}


def restated(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The pharmacy rows in twelve monthly deliveries, each with all of them."""
    dates = F.sequence(F.lit("2023-04-30").cast("date"), F.lit("2024-03-31").cast("date"), F.expr("interval 1 month"))
    rows = raw[PHARMACY_CLAIMS].drop("date_id").withColumn("date_id", F.explode(dates))
    return {PHARMACY_CLAIMS: rows}


def calibration(spark: SparkSession) -> float:
    """Seconds of a job that stays the same in every round of development."""
    started = time.perf_counter()
    rows = spark.range(0, 6_000_000, 1, 8).select(
        F.xxhash64("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"), F.col("id") % 400_000
    ).toDF("k", "v", "g")
    rows.repartition(8, "k").sortWithinPartitions("k").groupBy("g").agg(F.max("v").alias("m")).agg(F.max("m")).collect()
    return time.perf_counter() - started


def shuffled(events: str) -> dict[str, tuple[int, float]]:
    """Stages that wrote shuffle records, and their MB, by job description."""
    stage_of: dict[int, str] = {}
    written: dict[int, int] = defaultdict(int)
    for path in Path(events).iterdir():
        for line in path.open():
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                name = event["Properties"].get("spark.job.description", "")
                stage_of.update({stage: name for stage in event["Stage IDs"] if stage not in stage_of})
            elif event["Event"] == "SparkListenerTaskEnd":
                metrics = (event.get("Task Metrics") or {}).get("Shuffle Write Metrics", {})
                if metrics.get("Shuffle Records Written"):
                    written[event["Stage ID"]] += metrics["Shuffle Bytes Written"]
    out: dict[str, tuple[int, float]] = {}
    for stage, size in written.items():
        count, mb = out.get(stage_of[stage], (0, 0.0))
        out[stage_of[stage]] = (count + 1, mb + size / 1e6)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    events = tempfile.mkdtemp(prefix="run-")  # one machine: the log is the driver's own
    spark = session(events)
    scratch = new_folder(spark, "bench")
    started = time.perf_counter()
    raw = raw_tables(spark, sf_dir)
    inputs = {"raw": raw, "skewed": skewed(raw), "restated": restated(raw)}
    for folder, tables in inputs.items():
        for name, df in tables.items():
            df.repartition(8).write.partitionBy("date_id").parquet(f"{scratch}/{folder}/{name}")
    prepared = time.perf_counter() - started

    rows = raw[PHARMACY_CLAIMS].where("int_clm_num is not null")
    inputs["named"] = {PHARMACY_CLAIMS: rows}
    rows.repartition(8).write.partitionBy("date_id").parquet(f"{scratch}/named/{PHARMACY_CLAIMS}")
    runs = {name: (name, "raw") for name in FINALIZE}
    runs |= {
        "medical_claim_skewed": ("medical_claim", "skewed"),
        "pharmacy_claim_12_deliveries": ("pharmacy_claim", "restated"),
        "pharmacy_claim_all_named": ("pharmacy_claim", "named"),
    }
    timings: dict[str, list[float]] = {run: [] for run in runs}
    calibrations = []
    for round_ in range(ROUNDS + 1):
        spark.sparkContext.setJobDescription("calibration")
        calibrations.append(calibration(spark))
        for run, (name, folder) in runs.items():
            if folder != "raw" and 0 < round_ < ROUNDS:
                continue  # the harder inputs: once to warm up, once timed
            spark.sparkContext.setJobDescription(f"{run} {round_}")
            started = time.perf_counter()
            tables = {t: spark.read.parquet(f"{scratch}/{folder}/{t}") for t in inputs[folder]}
            write_files(final_relation(name, tables), run, f"{scratch}/out{round_}")
            if round_:
                timings[run].append(time.perf_counter() - started)
    unit = statistics.median(calibrations[1:])
    seconds = {run: round(statistics.median(t), 3) for run, t in timings.items()}
    spark.stop()
    moved = shuffled(events)
    last = {run: moved.get(f"{run} {ROUNDS}", (0, 0.0)) for run in runs}
    print(
        json.dumps(
            {
                "metric": "four claims tables, raw files to stored tables",
                "value": round(sum(seconds[name] for name in FINALIZE), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "shuffles": {run: count for run, (count, _) in last.items()},
                "shuffle_mb": {run: round(mb, 2) for run, (_, mb) in last.items()},
                "calibration_sec": round(unit, 3),
                "per_calibration": {run: round(sec / unit, 3) for run, sec in seconds.items()},
                "prepare_raw_sec": round(prepared, 3),
            }
        )
    )


if __name__ == "__main__":
    main()
