"""Cumulative files: every delivery restates all history, so only the newest one counts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_snapshot(
    df: DataFrame, date_col: str = "date_id", newest: dt.date | None = None
) -> DataFrame:
    """Rows of the newest file date; rows without a date never qualify.

    A caller that knows the newest date (``sources.tables.newest_partition``) passes it: the
    filter then prunes folders without reading a footer. Else the maximum is a scalar subquery,
    not a driver round trip: on a table partitioned by the file date it prunes directories,
    otherwise it reaches the Parquet reader as a filter. On a union it is taken over all members
    together, so a feed that lags behind drops out.
    """
    date = df.select(F.max(date_col)).scalar() if newest is None else F.lit(newest)
    return df.where(F.col(date_col) == date)


def newest_with_rows(
    df: DataFrame, date_col: str = "date_id", newest: dt.date | None = None
) -> tuple[dt.date | None, int]:
    """The newest file date, the given one if any, and its number of rows, by one pass now.

    The pass reads the date alone; of files partitioned by it, no page. A date that is not of type
    date is left to ``latest_snapshot``'s own subquery: None, with the number of all rows.
    """
    if newest is not None:
        return newest, df.where(F.col(date_col) == F.lit(newest)).count()
    if df.schema[date_col].dataType.typeName() != "date":
        return None, df.count()
    dated = df.where(F.col(date_col).isNotNull()).groupBy(date_col).count()
    last = dated.orderBy(F.desc(date_col)).first()
    return (None, 0) if last is None else (last[0], last[1])
