"""Helpers of the operators: tables in the shared folder, batches of whole groups."""

from __future__ import annotations

import contextlib
import os
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from claimloom.sources.shared import new_folder

BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of rows that Spark hands to a Python worker at a time.
BATCH_BYTES = 4_000_000


def small_batches(spark: SparkSession) -> None:
    """Let Spark hand rows to Python workers in batches of few bytes, however long their texts.

    Of up to 64 MB otherwise, held by the executor, by the worker, and there as strings once more.
    A row longer than a batch is one by itself. A limit that the user has set stays.
    """
    if BATCH_LIMIT not in spark.conf.getAll:
        spark.conf.set(BATCH_LIMIT, BATCH_BYTES)


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import this package from where the driver did.

    On a cluster the package is shipped with ``--py-files``; there the folder is not found, which
    does no harm.
    """
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        paths = [p for p in paths if p] + [root]
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(paths)


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: computed once, lineage cut.

    A lost executor costs the tasks that read it nothing but a new read.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete a table made by ``saved`` that nothing will read again."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        with contextlib.suppress(Exception):
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def whole_groups(
    batches: Iterable[pa.RecordBatch], keys: list[str], rows: int = 65_536
) -> Iterator[pa.Table]:
    """Tables of about ``rows`` rows that hold whole groups of equal ``keys``.

    The input is sorted by ``keys``, so a group is a run of rows. What is held at once is
    ``rows`` plus one group; callers bound their groups.
    """
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < rows:
            continue
        table = pa.Table.from_batches(held)
        cut = _last_start(table, keys)
        if cut:
            yield table.slice(0, cut)
        rest = table.slice(cut).combine_chunks()
        held, count = rest.to_batches(), rest.num_rows
    if count:
        yield pa.Table.from_batches(held)


def _last_start(table: pa.Table, keys: list[str]) -> int:
    """First row of the last group."""
    return int(group_numbers(table, keys).searchsorted(group_numbers(table, keys)[-1]))


def group_numbers(table: pa.Table, keys: list[str]) -> np.ndarray:
    """0, 1, 2, .. per run of equal integer keys."""
    new = np.zeros(table.num_rows, dtype=bool)
    for key in keys:
        column = table.column(key).to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return np.cumsum(new)


def forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links: as many links as join the same nodes, and no more."""
    if not len(left):
        return left, right
    nodes, ends = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = ends[: len(left)], ends[len(left) :]
    root = np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        if (low == high).all():
            break
        np.minimum.at(root, high, low)
        while (root != root[root]).any():
            root = root[root]
    member = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[member], nodes[root[member]]
