"""Fitting a frame to an output contract."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T


def conform(
    df: DataFrame,
    schema: T.StructType,
    values: Mapping[str, Column] | None = None,
    also: Sequence[str] = (),
) -> DataFrame:
    """Exactly the contract's columns, in order, with its types and comments, and ``also`` others.

    A column comes from ``values``, else from ``df``, else it is a typed NULL placeholder.
    Placeholders are added here, at the very end, so they never travel through a shuffle.
    Types are reconciled as in a table insert: text never turns into a date or number silently.
    """
    values = values or {}
    unknown = set(values) - set(schema.names)
    if unknown:
        raise ValueError(f"not in the contract: {sorted(unknown)}")
    fitted = df.withColumns(dict(values))
    return fitted.to(T.StructType([*schema.fields, *(fitted.schema[c] for c in also)]))


def renamed(
    df: DataFrame, names: Mapping[str, str], computed: Mapping[str, Column] | None = None
) -> DataFrame:
    """The columns of ``names`` (new name: old name) and the computed ones, nothing else."""
    computed = dict(computed or {})
    return (
        df.withColumns(computed)
        .withColumnsRenamed({old: new for new, old in names.items()})
        .select(*names, *computed)
    )
