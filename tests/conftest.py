import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from claimloom.schemas import MEDICAL_RAW, MEMBER_RAW, PHARMACY_RAW  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
DAY = dt.date(2024, 3, 31)
OLD_DAY = dt.date(2024, 2, 29)
GOOD_NPI = "1234567893"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def _frame(spark, schema, defaults, rows):
    full = [{**dict.fromkeys(schema.names), **defaults, **row} for row in rows]
    return spark.createDataFrame([tuple(r[n] for n in schema.names) for r in full], schema)


def run_time(minute=0):
    return dt.datetime(2024, 4, 1, 6, minute)


@pytest.fixture
def medical_rows(spark):
    """Raw medical lines; only what a test cares about need be given."""
    defaults = dict(
        int_clm_num="c1", clm_line_num=1, cursubid="1", bcmbrnbr="00", lob="COM", paid="10",
        svcdt=dt.date(2024, 1, 5), curr_clm_ind="Y", date_id=DAY, _run_time=run_time(),
        s3_path="p", filename="f",
    )
    return lambda *rows: _frame(spark, MEDICAL_RAW, defaults, rows)


@pytest.fixture
def pharmacy_rows(spark):
    defaults = dict(
        int_clm_num="r1", cursubid="1", bcmbrnbr="00", lob="COM", paid="10", clm_ndc="N1",
        svcdt=dt.date(2024, 1, 5), rx_curr_clm_ind="Y", date_id=DAY, _run_time=run_time(),
        s3_path="p", filename="f",
    )
    return lambda *rows: _frame(spark, PHARMACY_RAW, defaults, rows)


@pytest.fixture
def member_rows(spark):
    defaults = dict(
        cursubid="1", bcmbrnbr="00", mem_birth_dt=dt.date(1980, 1, 1), mem_gender="F",
        mem_mth_st_dt=dt.date(2024, 1, 1), mem_mth_end_dt=dt.date(2024, 1, 31), mem_mth_cnt=1,
        date_id=DAY, _run_time=run_time(), s3_path="p", filename="f",
    )
    return lambda *rows: _frame(spark, MEMBER_RAW, defaults, rows)
