"""Layered tables in the Spark catalog: create, append, replace, switch, list."""

from __future__ import annotations

import uuid
from datetime import datetime
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..schemas import TABLES, UNIQUE_KEYS, conform, required_columns_filled
from .history import History
from .storage import delete, subfolders

BATCH = "_last_updated_ts"
# Appended tables are laid out by batch so that one batch is one partition.
PARTITIONED = {t: (BATCH,) for t in ("raw_loan", "raw_payment", "lnd_err_loan")}
PARTITIONED |= {"lnd_err_payment": (BATCH, "_reject_kind"), "raw_audit": ("source_table", "batch_ts"),
                "lnd_dq_audit": ("table_name", "checked_at")}
STAMPS = (BATCH, "batch_ts", "checked_at")
# Tables kept as a history of segments behind a view.
HISTORIES = {"lnd_loan": "loan_id"}


class DuplicateKey(ValueError):
    """A table with a unique key was about to receive a key twice."""


class Release:
    """Full refreshes of several tables under one switch: write, audit, publish.

    `stage` writes a table beside the published one and gives it back for the tables that are
    derived from it. Until `publish` nobody sees any of it, so whatever fails before, a write, a
    check, a process, leaves all tables as they were. `publish` changes the tables' locations, one
    catalog call each, and then deletes all versions but the new one and the one before it, which
    may be being read.
    """

    def __init__(self, lake: Lake):
        self.lake, self.version, self.staged = lake, uuid.uuid4().hex, {}

    def stage(self, table: str, df: DataFrame) -> DataFrame:
        lake = self.lake
        folder = f"{lake.location(table)}/v={self.version}"
        lake._ready(table, df).write.parquet(folder)
        self.staged[table] = folder
        return lake.spark.read.schema(lake.schema(table)).parquet(folder)

    def publish(self) -> None:
        lake = self.lake
        before = {table: lake.version_of(table) for table in self.staged}
        for table, folder in self.staged.items():
            lake.spark.sql(f"ALTER TABLE {lake.name(table)} SET LOCATION '{folder}'")
            lake.spark.catalog.refreshTable(lake.name(table))
        for table, version in before.items():
            for old in subfolders(lake.spark, lake.location(table)):
                if old not in (version, f"v={self.version}"):
                    delete(lake.spark, f"{lake.location(table)}/{old}")


class Lake:
    """The tables of one environment: databases `<prefix>_<env>_<layer>` under `root`."""

    def __init__(self, spark: SparkSession, root: str, env: str = "dev", prefix: str = "lake"):
        self.spark, self.root, self.env, self.prefix = spark, root.rstrip("/"), env, prefix
        self.layer_of = {t: layer for layer, tables in TABLES.items() for t in tables}

    def namespace(self, layer: str) -> str:
        return f"{self.prefix}_{self.env}_{layer}"

    def name(self, table: str) -> str:
        return f"{self.namespace(self.layer_of[table])}.{table}"

    def location(self, table: str) -> str:
        return f"{self.root}/{self.namespace(self.layer_of[table])}/{table}"

    def schema(self, table: str):
        return TABLES[self.layer_of[table]][table]

    def create(self) -> None:
        """Create every missing database and table; existing ones are left alone."""
        for layer in TABLES:
            space = self.namespace(layer)
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {space} LOCATION '{self.root}/{space}'")
        for table in self.layer_of:
            self._create_table(table)

    def _create_table(self, table: str) -> None:
        if table in HISTORIES:
            self.history(table).create()
        if self.exists(table):
            return
        parts = PARTITIONED.get(table, ())
        fields = [f for f in self.schema(table).fields if f.name not in parts]
        fields += [self.schema(table)[p] for p in parts]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        by = f"PARTITIONED BY ({', '.join(parts)})" if parts else ""
        folder = self.location(table)
        if not parts:
            folder += "/v=0"  # refreshed by switching to another version
        self.spark.sql(f"CREATE TABLE {self.name(table)} ({columns}) USING parquet {by} "
                       f"LOCATION '{folder}'")
        if parts and self._has_files(folder):
            self.spark.sql(f"MSCK REPAIR TABLE {self.name(table)}")

    def _has_files(self, folder: str) -> bool:
        try:
            self.spark.read.schema("x int").parquet(folder)
        except AnalysisException:
            return False
        return True

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def read(self, table: str) -> DataFrame:
        """The table in its declared column order."""
        return self.spark.table(self.name(table)).select(*self.schema(table).names)

    def read_if_exists(self, table: str) -> DataFrame | None:
        return self.read(table) if self.exists(table) else None

    def read_or_empty(self, table: str) -> DataFrame:
        """The table, or no rows while it doesn't exist yet."""
        found = self.read_if_exists(table)
        return self.spark.createDataFrame([], self.schema(table)) if found is None else found

    def batches(self, table: str) -> list[datetime]:
        """Instants of the batches in a table laid out by batch, oldest first, batches without rows
        included. Partitions are listed in the catalog; no data file is read."""
        if not self.exists(table):
            return []
        column = next(c for c in PARTITIONED[table] if c in STAMPS)
        found = set()
        for row in self.spark.sql(f"SHOW PARTITIONS {self.name(table)}").collect():
            values = dict(part.split("=", 1) for part in row["partition"].split("/"))
            found.add(datetime.fromisoformat(unquote(values[column])))
        return sorted(found)

    def newest_batch(self, *tables: str) -> datetime | None:
        """The instant of the newest batch in any of the tables."""
        return max((b for t in tables for b in self.batches(t)[-1:]), default=None)

    def append(self, table: str, df: DataFrame) -> None:
        self._ready(table, df).write.mode("append").insertInto(self.name(table))

    def append_batch(self, table: str, df: DataFrame, batch_ts: datetime, part: str | None = None) -> None:
        """Append one batch to a table laid out by batch. Only the batch's own partition is
        written, and replaced if it is there: a retry after a failure leaves no copies. `part`
        is the partition's other value where a batch has several."""
        columns = PARTITIONED[table]
        ready = self._ready(table, df).drop(*columns)
        instant = f"TIMESTAMP '{batch_ts:%Y-%m-%d %H:%M:%S.%f}'"
        where = ", ".join(f"{c} = {instant if c in STAMPS else repr(part)}" for c in columns)
        view = f"batch_{uuid.uuid4().hex}"
        ready.createOrReplaceTempView(view)
        session = ready.sparkSession
        try:
            session.sql(f"INSERT OVERWRITE TABLE {self.name(table)} "
                        f"PARTITION ({where}) SELECT * FROM {view}")
        finally:
            session.catalog.dropTempView(view)

    def clear_batch(self, table: str, batch_ts: datetime, part: str | None = None) -> None:
        """Drop the rows of a batch that an earlier run of it left, if there are any."""
        if batch_ts in self.batches(table):
            self.append_batch(table, self.spark.createDataFrame([], self.schema(table)), batch_ts, part)

    def replace(self, table: str, df: DataFrame) -> None:
        """Full refresh of one table."""
        release = self.release()
        release.stage(table, df)
        release.publish()

    def release(self) -> Release:
        """A set of full refreshes that are published together."""
        return Release(self)

    def version_of(self, table: str) -> str:
        """The folder, below the table's own, that is published now."""
        facts = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(table)}").where("col_name = 'Location'")
        return facts.head()["data_type"].rstrip("/").rsplit("/", 1)[-1]

    def history(self, table: str) -> History:
        return History(self.spark, self.name(table), self.location(table), self.schema(table), HISTORIES[table])

    def inventory(self) -> DataFrame:
        """layer, namespace, table: what exists, in order."""
        found = [(layer, self.namespace(layer), t.name)
                 for layer in TABLES
                 if self.spark.catalog.databaseExists(self.namespace(layer))
                 for t in self.spark.catalog.listTables(self.namespace(layer))]
        schema = "layer string, namespace string, table_name string"
        return self.spark.createDataFrame(found, schema).orderBy("namespace", "table_name")

    def _ready(self, table: str, df: DataFrame) -> DataFrame:
        schema = self.schema(table)
        checked = required_columns_filled(conform(df, schema), schema)
        if table in UNIQUE_KEYS:
            keys = UNIQUE_KEYS[table]
            twice = checked.groupBy(*keys).count().where("count > 1")
            if not twice.isEmpty():
                raise DuplicateKey(f"{table}: {keys} is not unique")
        parts = PARTITIONED.get(table, ())
        return checked.select(*[c for c in schema.names if c not in parts], *parts)
