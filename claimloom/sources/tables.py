"""Raw tables in, layered tables out."""

from __future__ import annotations

import datetime as dt
import math
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.payer import PayerProfile
from claimloom.schemas import PASSTHROUGH, TABLE_COMMENTS
from claimloom.sources.journal import SWITCHING, Files, Journal
from claimloom.sources.shared import open_writers, shuffles_dropped

# Names of the raw tables.
HMO_MEMBER = "commercial_hmo_member"
PPO_MEMBER = "commercial_ppo_member"
MEDICAL_CLAIMS = "commercial_medical_claims"
PHARMACY_CLAIMS = "commercial_pharmacy_claims"
RAW_TABLES = (HMO_MEMBER, PPO_MEMBER, MEDICAL_CLAIMS, PHARMACY_CLAIMS)

#: Rows of a bucket, all deliveries together: some 100 MB of a wide table.
BUCKET_ROWS = 500_000
#: Passes in which a large table is brought to its buckets, at most; each reads its source again.
PASSES = 16
#: Such a table is read by column and once a job: smaller files are worth their time.
BUCKET_CODEC = "zstd"
#: Deliveries that one task writes at once, and bytes that each of them gathers before it writes.
OPEN_DELIVERIES = 8
ROW_GROUP_BYTES = 32 << 20


@dataclass(frozen=True)
class Layers:
    """Database of each layer."""

    raw: str
    staging: str
    intermediate: str
    final: str

    @classmethod
    def of(cls, profile: PayerProfile) -> Layers:
        # Layer databases.
        return cls(
            raw="raw_data",
            staging=f"{profile.payer}_staging",
            intermediate=f"{profile.payer}_intermediate",
            final="input_layer",
        )


def raw_from_catalog(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    return {name: spark.read.table(f"{database}.{name}") for name in RAW_TABLES}


def raw_from_files(spark: SparkSession, root: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """One folder per raw table, best partitioned by ``date_id``: the snapshot filter then
    prunes folders."""
    return {name: spark.read.format(fmt).load(f"{root}/{name}") for name in RAW_TABLES}


def write_deliveries(df: DataFrame, path: str, partition: str = "date_id") -> None:
    """A raw table as files, a folder for each delivery.

    A task holds a few dates only, so their files are written side by side: wide rows are not
    sorted by date, and a large task does not spill them.
    """
    with open_writers(df.sparkSession, OPEN_DELIVERIES):
        df.write.option("parquet.block.size", ROW_GROUP_BYTES).partitionBy(partition).parquet(path)


def database_of(spark: SparkSession, layer: str | None) -> str:
    """A configured layer is used verbatim, without blanks around it; none means the current
    database."""
    return spark.catalog.currentDatabase() if layer is None else layer.strip()


class TableSink:
    """Full refreshes of a layer's tables, each in a folder of its own below the layer's.

    ``store`` writes a version and touches nothing else, so a write that fails leaves the published
    table as it was. ``publish`` points the table to the version: one step in the catalog, before
    which readers see the old rows and after which they see the new ones. The version before stays
    until the next refresh, so that readers who began with it can finish. A journal tells the next
    refresh of the table what a stopped one left. One writer per table at a time.

    Where the columns change, the catalog needs two steps; a run stopped between them leaves no
    table until the next refresh or ``recover``.
    """

    def __init__(self, spark: SparkSession, layer: str | None = None, fmt: str = "parquet"):
        self.spark, self.fmt, self.files = spark, fmt, Files(spark)
        self.database = database_of(spark, layer)
        self._schemas: dict[str, T.StructType] = {}

    def store(self, df: DataFrame, name: str) -> str:
        """A version with the rows; returns its folder."""
        self.spark.sql("CREATE DATABASE IF NOT EXISTS IDENTIFIER(:db)", args={"db": self.database})
        self.recover(name)
        pending = self.files.absolute(f"{self._versions(name)}/{uuid.uuid4().hex}")
        self._journal(name).begin(path=pending)
        self._schemas[pending] = df.schema
        try:
            df.write.format(self.fmt).save(pending)
        except Exception:
            self.discard(pending)
            raise
        return pending

    def publish(self, pending: str, name: str) -> str:
        """The table, with the rows of the version; returns its name."""
        journal = self._journal(name)
        number = next(e.number for e in journal.entries() if e.facts.get("path") == pending)
        journal.switching(number, old=self._location(name))
        return self._point(name, pending)

    def recover(self, name: str) -> dict[str, str]:
        """Finish or undo what stopped refreshes left; returns what was done, by version.

        Without a stopped refresh this drops the version before the published one.
        """
        journal, done = self._journal(name), {}
        entries = journal.entries()
        current = self._location(name)
        for entry in entries:
            path = entry.facts["path"]
            if current is None and entry.mark == SWITCHING:
                self._point(name, path)
                current = path
            if path == current:
                self._retire(entry.facts.get("old"), current)
                done[path] = "finished"
            else:
                self.files.delete(path)
                done[path] = "undone"
            journal.close(entry.number)
        return done

    def discard(self, pending: str) -> None:
        self.files.delete(pending)
        journal = Journal(self.files, f"{pending.rpartition('/')[0]}/_journal")
        for entry in journal.entries():
            if entry.facts.get("path") == pending:
                journal.close(entry.number)

    def read(self, where: str) -> DataFrame:
        return self.spark.read.table(where)

    def _point(self, name: str, path: str) -> str:
        table = f"{self.database}.{name}"
        schema = self._schemas.get(path) or self.spark.read.format(self.fmt).load(path).schema
        if self.spark.catalog.tableExists(table):
            if _shape(self.spark.read.table(table).schema) == _shape(schema):
                self._set_location(table, path)
                self.spark.catalog.refreshTable(table)
                return table
            self._drop(table)
        self._create(table, path, schema, TABLE_COMMENTS.get(name))
        return table

    def _set_location(self, table: str, path: str) -> None:
        self.spark.sql(f"ALTER TABLE IDENTIFIER(:t) SET LOCATION {literal(path)}", args={"t": table})

    def _drop(self, table: str) -> None:
        self.spark.sql("DROP TABLE IDENTIFIER(:t)", args={"t": table})

    def _create(self, table: str, path: str, schema: T.StructType, comment: str | None) -> None:
        self.spark.catalog.createTable(table, path, self.fmt, schema, comment)

    def _location(self, name: str) -> str | None:
        """Where the published rows are."""
        table = f"{self.database}.{name}"
        if not self.spark.catalog.tableExists(table):
            return None
        rows = self.spark.sql("DESCRIBE EXTENDED IDENTIFIER(:t)", args={"t": table}).collect()
        details = [r.col_name for r in rows].index("# Detailed Table Information")
        return self.files.absolute(next(r.data_type for r in rows[details:] if r.col_name == "Location"))

    def _versions(self, name: str) -> str:
        rows = self.spark.sql("DESCRIBE DATABASE IDENTIFIER(:db)", args={"db": self.database}).collect()
        return f"{next(r.info_value for r in rows if r.info_name == 'Location')}/{name}__versions"

    def _journal(self, name: str) -> Journal:
        return Journal(self.files, f"{self._versions(name)}/_journal")

    def _retire(self, old: str | None, current: str) -> None:
        """Drop a version that the table no longer points to."""
        if old and old != current and not current.startswith(f"{old}/"):
            self.files.delete(old)


def _shape(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema]


class FileSink:
    """Full refreshes of folders below ``root``, where there is no catalog.

    A folder can not change in one step: it steps aside, and the pending one takes its place. A
    journal covers the instant between. Readers through ``read`` then get the new rows from where
    they are; readers of the plain path find no folder, never wrong rows, and the next refresh of
    the name (or ``recover``) finishes the switch. Names that begin with a dot are not read by
    Spark. On stores without a rename of folders use a catalog.
    """

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt, self.files = spark, root.rstrip("/"), fmt, Files(spark)

    def store(self, df: DataFrame, name: str) -> str:
        self.recover(name)
        pending = f"{self.root}/.{name}-pending-{uuid.uuid4().hex}"
        self._journal(name).begin(path=pending)
        try:
            df.write.format(self.fmt).save(pending)
        except Exception:
            self.discard(pending)
            raise
        return pending

    def publish(self, pending: str, name: str) -> str:
        path, journal = f"{self.root}/{name}", self._journal(name)
        entry = next(e for e in journal.entries() if e.facts.get("path") == pending)
        old = f"{self.root}/.{name}-old-{entry.number}"
        journal.switching(entry.number, old=old)
        replaces = self.files.exists(path)
        if replaces:
            self.files.rename(path, old)
        try:
            self.files.rename(pending, path)
        except Exception:
            if replaces:
                self.files.rename(old, path)
            raise
        self.files.delete(old)
        journal.close(entry.number)
        return path

    def recover(self, name: str) -> dict[str, str]:
        """Finish or undo what stopped refreshes left; returns what was done, by pending folder."""
        path, journal, done = f"{self.root}/{name}", self._journal(name), {}
        for entry in journal.entries():
            pending = entry.facts["path"]
            done[pending] = "undone"
            if entry.mark == SWITCHING:
                if not self.files.exists(path):
                    self.files.rename(pending, path)
                if not self.files.exists(pending):
                    done[pending] = "finished"
                self.files.delete(entry.facts["old"])
            self.files.delete(pending)
            journal.close(entry.number)
        return done

    def discard(self, pending: str) -> None:
        self.files.delete(pending)
        name = pending.rpartition("/.")[2].rpartition("-pending-")[0]
        journal = self._journal(name)
        for entry in journal.entries():
            if entry.facts.get("path") == pending:
                journal.close(entry.number)

    def read(self, where: str) -> DataFrame:
        if not self.files.exists(where):
            for entry in self._journal(where.rpartition("/")[2]).entries():
                if entry.mark == SWITCHING and self.files.exists(entry.facts["path"]):
                    where = entry.facts["path"]
        return self.spark.read.format(self.fmt).load(where)

    def _journal(self, name: str) -> Journal:
        return Journal(self.files, f"{self.root}/.{name}-journal")


Sink = TableSink | FileSink


def write_layer(df: DataFrame, name: str, layer: str | None = None, fmt: str = "parquet") -> str:
    """Full refresh of a layer's table; returns its qualified name. Column comments go along."""
    sink = TableSink(df.sparkSession, layer, fmt)
    return sink.publish(sink.store(df, name), name)


def write_files(df: DataFrame, name: str, root: str, fmt: str = "parquet") -> str:
    """Full refresh of a folder, where there is no catalog; returns its path."""
    sink = FileSink(df.sparkSession, root, fmt)
    return sink.publish(sink.store(df, name), name)


def store_staging_views(
    spark: SparkSession, raw_database: str, layer: str, views: dict[str, tuple[str, T.StructType]]
) -> list[str]:
    """Staging relations as stored views (name: raw table and contract); returns their names.

    Their SELECT follows from the contract: strict casts of the raw columns, in order. As stored
    objects they outlive the session.
    """
    database = database_of(spark, layer)
    spark.sql("CREATE DATABASE IF NOT EXISTS IDENTIFIER(:db)", args={"db": database})
    stored = []
    for name, (table, schema) in views.items():
        columns = ", ".join(
            f"`{f.name}`" if f.name in PASSTHROUGH else f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`"
            for f in schema
        )
        spark.sql(
            f"CREATE OR REPLACE VIEW IDENTIFIER(:v) AS SELECT {columns} FROM `{raw_database.strip()}`.`{table}`",
            args={"v": f"{database}.{name}"},
        )
        stored.append(f"{database}.{name}")
    return stored


def store_bucketed(
    df: DataFrame, table: str, column: str, buckets: int, partition: str = "date_id"
) -> str:
    """A raw table partitioned by file date and bucketed by ``column``; returns its name.

    Plans that group by the column take its partitioning over and shuffle no wide rows. A bucket
    is written and read by one task, so there are more than ``buckets`` where the table has more
    than ``BUCKET_ROWS`` rows for each; they are counted first. Rows are brought to their buckets
    first, so a delivery has one file for each.

    Wide rows in a shuffle take several times the room of the table itself. A large table is
    therefore written in passes over ``df``, ``PASSES`` at most, of a bucket for every core at least:
    each has a share of the buckets, whose rows are found by the hash that buckets are made by, and
    its shuffle is gone before the next. ``df`` must give the same rows every time. Nobody sees rows
    of the table before the last pass is through.
    """
    spark = df.sparkSession
    with shuffles_dropped(spark):
        full = max(1, math.ceil(df.count() / BUCKET_ROWS))
        buckets = max(buckets, full)
        cores = spark.sparkContext.defaultParallelism
        passes = math.ceil(full / (cores * math.ceil(full / (cores * PASSES))))
        share = math.ceil(buckets / passes)
        bucket = F.pmod(F.hash(column), F.lit(buckets))

        def writer(rows: DataFrame) -> DataFrameWriter:
            by_bucket = rows.repartitionById(share, bucket).write.option("compression", BUCKET_CODEC)
            return by_bucket.partitionBy(partition).bucketBy(buckets, column).sortBy(column)

        if passes == 1:
            writer(df).saveAsTable(table)
        else:
            of_pass = F.floor(bucket / share)
            _store_in_passes(table, writer, df, [of_pass == n for n in range(passes)])
    return table


def _store_in_passes(
    table: str, writer: Callable[[DataFrame], DataFrameWriter], df: DataFrame, passes: list[Column]
) -> None:
    """A partitioned table of the rows of each pass in turn.

    The table is created empty. Passes add files to its folder through a second catalog entry, so
    it has no partitions, and no rows, until those in the folder are made known to the catalog. If
    a pass fails, the table is dropped.
    """
    spark = df.sparkSession
    writer(df.limit(0)).saveAsTable(table)
    facts = spark.sql("DESCRIBE EXTENDED IDENTIFIER(:t)", args={"t": table}).collect()
    folder = {r.col_name: r.data_type for r in facts}["Location"]
    filled = f"{table}__{uuid.uuid4().hex}"
    try:
        for condition in passes:
            writer(df.where(condition)).mode("append").option("path", folder).saveAsTable(filled)
        spark.sql("MSCK REPAIR TABLE IDENTIFIER(:t)", args={"t": table})
    except Exception:
        spark.sql("DROP TABLE IDENTIFIER(:t)", args={"t": table})
        raise
    finally:
        # Not managed: its files stay.
        spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:t)", args={"t": filled})


def is_bucketed_by(spark: SparkSession, table: str, column: str) -> bool:
    """Whether a table is bucketed by just this column."""
    return [c.name for c in spark.catalog.listColumns(table) if c.isBucket] == [column]


def descriptions(spark: SparkSession, tables: list[str]) -> DataFrame:
    """``table_name, column_name, description`` as stored: a table's own has column name ''."""
    found = []
    for table in tables:
        rows = spark.sql("DESCRIBE EXTENDED IDENTIFIER(:t)", args={"t": table}).collect()
        end = next(i for i, r in enumerate(rows) if r.col_name.startswith("# Detailed") or not r.col_name)
        short = table.rpartition(".")[2]
        found += [(short, r.col_name, r.comment) for r in rows[:end] if r.comment]
        found += [(short, "", r.data_type) for r in rows[end:] if r.col_name == "Comment"]
    return spark.createDataFrame(found, "table_name string, column_name string, description string")


def newest_partition(spark: SparkSession, table: str, column: str = "date_id") -> dt.date | None:
    """The newest date of a table partitioned by it that has rows, from the catalog.

    Reads no data file but those of the newest partitions, until one has a row. None for a table
    that is partitioned otherwise or not at all.
    """
    if [c.name for c in spark.catalog.listColumns(table) if c.isPartition] != [column]:
        return None
    listed = spark.sql("SHOW PARTITIONS IDENTIFIER(:t)", args={"t": table}).collect()
    values = {row[0].split("=", 1)[1] for row in listed}
    for value in sorted((v for v in values if v != "__HIVE_DEFAULT_PARTITION__"), reverse=True):
        date = dt.date.fromisoformat(value)
        if not spark.read.table(table).where(F.col(column) == F.lit(date)).isEmpty():
            return date
    return None


def newest_from_statistics(spark: SparkSession, path: str, column: str = "date_id") -> dt.date | None:
    """The newest date of Parquet files, from the statistics in their footers.

    For tables that are not partitioned by it: Spark's reader answers the maximum itself, and no
    page of data is read. The caller's session keeps its settings. None where the column is no
    date or missing, where there are no rows, or where a block has no statistics of it, as one
    without any date; ``latest_snapshot`` then finds the maximum by a scan.
    """
    try:
        date = newest_in_footers(spark, path, column).first()[0]
    except (PySparkException, Py4JError):
        return None
    return date if isinstance(date, dt.date) and not isinstance(date, dt.datetime) else None


def newest_in_footers(spark: SparkSession, path: str, column: str = "date_id") -> DataFrame:
    """One row with the maximum, as a plan that pushes the aggregate to the Parquet reader."""
    session = spark.newSession()
    old = session.conf.get("spark.sql.sources.useV1SourceList").split(",")
    session.conf.set("spark.sql.sources.useV1SourceList", ",".join(f for f in old if f != "parquet"))
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session.read.parquet(path).agg(F.max(column))


def newest_delivery(spark: SparkSession, table: str, column: str = "date_id") -> dt.date | None:
    """The newest date of a table: from its partitions if it is partitioned by it, else from file
    statistics where it is stored as Parquet."""
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        return newest_partition(spark, table, column)
    rows = spark.sql("DESCRIBE EXTENDED IDENTIFIER(:t)", args={"t": table}).collect()
    facts = {r.col_name: r.data_type for r in rows}
    if (facts.get("Provider") or "").lower() != "parquet":
        return None
    return newest_from_statistics(spark, facts["Location"], column)


def literal(text: str) -> str:
    """A SQL string."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def register_views(relations: dict[str, DataFrame]) -> None:
    """Unmaterialized relations by name, for SQL users."""
    for name, df in relations.items():
        df.createOrReplaceTempView(name)
