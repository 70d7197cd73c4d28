"""Stacking feeds of the same shape."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tagged_union(feeds: dict[str, DataFrame], tag_col: str) -> DataFrame:
    """All rows of all feeds, each row tagged with its feed's name."""
    tagged = [df.withColumn(tag_col, F.lit(tag)) for tag, df in feeds.items()]
    return reduce(DataFrame.unionByName, tagged)
