"""What to do with rows whose provider identifier is wrong."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.functions.ids import absent_or_valid, valid_npi

Policy = Literal["null", "drop_row", "passthrough"]


def with_valid_id(df: DataFrame, source: str, target: str, policy: Policy) -> DataFrame:
    """Add ``target`` from ``source``.

    ``null``: invalid becomes NULL. ``drop_row``: invalid removes the row, absent is NULL.
    ``passthrough``: taken over unchecked.
    """
    if policy == "passthrough":
        return df.withColumn(target, F.col(source))
    if policy not in ("null", "drop_row"):
        raise ValueError(f"unknown policy {policy!r}")
    checked = df.withColumn(target, valid_npi(source))
    return checked.where(absent_or_valid(source, target)) if policy == "drop_row" else checked
