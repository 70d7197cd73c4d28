"""Data-quality checks as Spark jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: How many rows of an output have a row's key; NULL for rows that the output does not keep.
SAME_KEY = "_same_key"


def null_counts(columns: Sequence[str]) -> list[Column]:
    """One NULL count per column, for one aggregate or one observation over a frame."""
    return [F.count_if(F.col(c).isNull()).alias(c) for c in columns]


def check_not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """(table_name, column_name, failures) for each column, in one pass over the frame."""
    counts = df.agg(*null_counts(columns))
    return counts.select(
        F.lit(table).alias("table_name"),
        F.inline(
            F.array(
                *(
                    F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures"))
                    for c in columns
                )
            )
        ),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)


def check_unique(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """(table_name, column_name, failures): how many key combinations are not unique."""
    return duplicate_keys(df, keys).agg(
        F.lit(table).alias("table_name"),
        F.lit("+".join(keys)).alias("column_name"),
        F.count("*").alias("failures"),
    )


def with_same_key(
    df: DataFrame, group: Sequence[str], key: Sequence[str] = (), kept: Column | None = None
) -> DataFrame:
    """Add ``SAME_KEY``: the rows of the row's group, of those ``kept``, that have its ``key``.

    ``group`` is what the rows are partitioned and sorted by already, as after a choice of one row
    per group, so equal keys are neighbours and nothing is shuffled. A key decides its group; it is
    empty where the group is the key. After a choice that works a group has one row.
    """
    kept = F.lit(True) if kept is None else kept
    window = Window.partitionBy(*group)
    if key:
        own = F.struct(*key)
        keys = F.collect_list(F.when(kept, own)).over(window)
        same = F.size(F.filter(keys, lambda other: other.eqNullSafe(own)))
    else:
        same = F.count(F.when(kept, F.lit(1))).over(window)
    return df.withColumn(SAME_KEY, F.when(kept, same.cast("long")))


def duplicates_seen(name: str) -> Column:
    """How many keys have more than one row, for an observation of rows with ``SAME_KEY``."""
    share = F.when(F.col(SAME_KEY) > 1, 1.0 / F.col(SAME_KEY)).otherwise(0.0)
    return F.coalesce(F.round(F.sum(share)), F.lit(0.0)).cast("long").alias(name)
