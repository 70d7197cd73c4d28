"""Code columns: flags, code-set tags and code clean-up. All row-local JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the raw files write this for "no code".
NO_CODE = "*"


def is_yes(flag: str) -> Column:
    """Y or y, without trimming; NULL counts as no."""
    return F.coalesce(F.upper(flag) == "Y", F.lit(False))


def is_filled(column: str) -> Column:
    """Neither NULL nor blank."""
    return F.coalesce(F.trim(column) != "", F.lit(False))


def revenue_center_code(column: str) -> Column:
    """Three characters get a leading zero; other lengths stay as they are."""
    code = F.nullif(F.col(column), F.lit(NO_CODE))
    return F.when(F.length(code) == 3, F.concat(F.lit("0"), code)).otherwise(code)


def procedure_code(first: str, second: str) -> Column:
    """First non-NULL code, then the no-code mark to NULL: a mark in ``first`` hides ``second``."""
    return F.nullif(F.coalesce(first, second), F.lit(NO_CODE))


def tag_if_present(column: str, tag: str) -> Column:
    return F.when(F.col(column).isNotNull(), F.lit(tag))


def diagnosis_code_type(indicator: str) -> Column:
    return F.when(F.col(indicator) == "10", "icd-10-cm").when(F.col(indicator) == "9", "icd-9-cm")


def gender(column: str) -> Column:
    letter = F.upper(column)
    return F.when(letter == "M", "male").when(letter == "F", "female").otherwise("unknown")


def network_flag(column: str) -> Column:
    """Y is 1 and N is 0, upper case only; anything else is NULL."""
    return F.when(F.col(column) == "Y", 1).when(F.col(column) == "N", 0)


def year_month(column: str) -> Column:
    return F.date_format(column, "yyyyMM")
