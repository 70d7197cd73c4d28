"""Typed staging of a raw table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.schemas import PASSTHROUGH


def stage(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The contract's columns in order, cast strictly (bad text raises under ANSI mode).

    Metadata columns pass through with whatever type they arrive in. Columns outside the
    contract are not read.
    """
    present = dict(df.dtypes)

    def column(field: T.StructField) -> Column:
        kind = field.dataType.simpleString()
        if field.name in PASSTHROUGH or present.get(field.name) == kind:
            return F.col(field.name)
        return F.col(field.name).cast(kind).alias(field.name)

    return df.select(*map(column, schema))
