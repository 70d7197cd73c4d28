"""Column functions on hand-written values."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimloom.functions import amounts, codes, ids


def evaluate(spark, column, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in df.select("i", column.alias("out")).orderBy("i").collect()]


def check_digit_ok(digits):
    total = 24
    for i, ch in enumerate(digits[:9]):
        d = int(ch) * (2 if i % 2 == 0 else 1)
        total += d // 10 + d % 10
    return total % 10 == (10 - int(digits[9])) % 10


def expected_npi(value):
    if value is None:
        return None
    digits = "".join(c for c in value if c in "0123456789")
    return digits if len(digits) == 10 and check_digit_ok(digits) else None


def test_npi_hand_values(spark):
    values = [
        "1234567893", "123-456-7893", " 1234567893 ", "1234567890", "12345", "", None,
        "1234567893.0",
    ]
    good = "1234567893"
    want = [good, good, good, None, None, None, None, None]
    assert evaluate(spark, ids.valid_npi("v"), values) == want


def test_npi_digits_of_other_scripts_are_not_digits(spark):
    # Arabic-Indic digits: the clean-up must remove them as it removes letters.
    values = ["١234567893", "1234567893١", "12345678٣"]
    want = [expected_npi(v) for v in values]
    assert evaluate(spark, ids.valid_npi("v"), values) == want


def test_npi_accepts_numbers(spark):
    assert evaluate(spark, ids.valid_npi("v"), [1234567893, 1], "long") == ["1234567893", None]


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        st.one_of(
            st.text(alphabet="0123456789", min_size=10, max_size=10),
            st.text(alphabet="0123456789-. x", max_size=14),
        ),
        min_size=200,
        max_size=400,
    )
)
def test_npi_equals_digit_formula(spark, values):
    assert evaluate(spark, ids.valid_npi("v"), values) == [expected_npi(v) for v in values]


def test_npi_exactly_one_check_digit_per_prefix(spark):
    prefixes = [f"{n:09d}" for n in range(100_000_000, 999_999_999, 7_654_321)]
    values = [p + str(d) for p in prefixes for d in range(10)]
    got = evaluate(spark, ids.valid_npi("v"), values)
    assert sum(v is not None for v in got) == len(prefixes)
    assert got == [expected_npi(v) for v in values]


@pytest.mark.parametrize(
    "value, want",
    [("*", None), ("120", "0120"), ("0120", "0120"), ("12", "12"), (None, None), ("", "")],
)
def test_revenue_code(spark, value, want):
    assert evaluate(spark, codes.revenue_center_code("v"), [value]) == [want]


def test_procedure_code_mark_hides_second_code(spark):
    df = spark.createDataFrame(
        [("*", "99213"), (None, "99213"), ("G1", None), (None, "*"), (None, None)], "a string, b string"
    )
    got = [r[0] for r in df.select(codes.procedure_code("a", "b")).collect()]
    assert got == [None, "99213", "G1", None, None]


def test_current_flag(spark):
    assert evaluate(spark, codes.is_yes("v"), ["Y", "y", " Y", "N", "", None]) == [
        True, True, False, False, False, False,
    ]


def test_filled(spark):
    got = evaluate(spark, codes.is_filled("v"), ["11", " 11", " ", "", None])
    assert got == [True, True, False, False, False]


def test_gender(spark):
    got = evaluate(spark, codes.gender("v"), ["M", "m", "F", "f", "U", " M", None])
    assert got == ["male", "male", "female", "female", "unknown", "unknown", "unknown"]


def test_network_flag_is_case_sensitive(spark):
    assert evaluate(spark, codes.network_flag("v"), ["Y", "N", "y", "", None]) == [1, 0, None, None, None]


def test_code_tags(spark):
    got = evaluate(spark, codes.diagnosis_code_type("v"), ["10", "9", "0", "", None])
    assert got == ["icd-10-cm", "icd-9-cm", None, None, None]
    assert evaluate(spark, codes.tag_if_present("v", "ms-drg"), ["470", "", None]) == ["ms-drg", "ms-drg", None]


def test_quantities_are_cut_toward_zero(spark):
    got = evaluate(spark, amounts.truncated(amounts.to_double("v")), ["2.7", "-2.7", "x", "", None])
    assert got == [2, -2, None, None, None]


def test_quantity_out_of_range_raises(spark):
    with pytest.raises(Exception, match="OVERFLOW"):
        evaluate(spark, amounts.truncated(amounts.to_double("v")), ["1e12"])


def test_refills_read_whole_numbers_only(spark):
    got = evaluate(spark, amounts.to_int("v"), ["1.0", " 3 ", "1.9", "x", "", "-2", None])
    assert got == [None, 3, None, None, None, -2, None]


def test_blank_amounts_read_like_a_plain_tolerant_cast(spark):
    values = ["", " ", "\t", " ", "\t1", " 1.5 ", "1e3", "NaN", "N/A", "-0", None]
    plain = evaluate(spark, F.col("v").try_cast("double").cast("string"), values)
    assert evaluate(spark, amounts.to_double("v").cast("string"), values) == plain


def test_total_needs_every_amount(spark):
    df = spark.createDataFrame([("1", "2.5"), ("1", None), ("1", "x")], "a string, b string")
    assert [r[0] for r in df.select(amounts.total_of("a", "b")).collect()] == [3.5, None, None]


def test_member_key_needs_both_halves(spark):
    df = spark.createDataFrame(
        [("12", "3"), ("1", "23"), ("1", None), (None, "1")], "cursubid string, bcmbrnbr string"
    )
    assert [r[0] for r in df.select(ids.member_key()).collect()] == ["123", "123", None, None]


def test_year_month(spark):
    df = spark.sql("select date '2024-02-29' as d union all select null")
    assert {r[0] for r in df.select(codes.year_month("d")).collect()} == {"202402", None}
