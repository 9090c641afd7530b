"""Type-2 history on disk: current rows in buckets of keys, closed rows apart, one pointer.

A history is a set of segments, each a Parquet folder that is written once and never changed:
current rows of one key bucket, or rows that a batch closed. Which segments make up the table is
written down in a manifest; the catalog holds a view over those segments and names their manifest.
Replacing the view is the only switch, so readers see the table before a batch or after it.

A batch reads the current segments of the buckets that hold its keys. It rewrites a bucket only
if one of its rows closes; new keys of other buckets are appended as a segment beside the old
ones, until there are `MOST_SEGMENTS` of them. Every other segment stays as it is. Closed rows are
appended, and merged by `compact`. `vacuum` deletes what none of the last manifests names.

One writer at a time: two batches at once would each publish without the other's rows.
"""

from __future__ import annotations

import uuid
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.scd2 import open_rows
from ..schemas import conform, required_columns_filled
from ..settings import DEFAULT_RULES, Rules
from .storage import delete, subfolders

BUCKETS, MOST_SEGMENTS, KEPT_MANIFESTS = 16, 8, 2
CLOSED = -1  # the bucket of closed segments
MANIFEST = "bucket int, segment string"


class Segment(NamedTuple):
    bucket: int
    path: str  # below the history's root


class History:
    """The history behind the view `name`, below the folder `root`."""

    def __init__(self, spark: SparkSession, name: str, root: str, schema: T.StructType,
                 key: str = "loan_id", buckets: int = BUCKETS):
        self.spark, self.name, self.root, self.schema = spark, name, root.rstrip("/"), schema
        self.key, self.buckets = key, buckets

    # --- pointer and manifest ---------------------------------------------------------------

    def create(self) -> None:
        """The view, over no segment yet, unless it exists."""
        if not self.spark.catalog.tableExists(self.name):
            self._publish([], [])

    def _properties(self) -> dict[str, str]:
        return {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()}

    def _manifests(self) -> list[str]:
        """Ids of the manifests still kept, newest first."""
        return [m for m in self._properties().get("manifests", "").split(",") if m]

    def segments(self, manifest: str | None = None) -> list[Segment]:
        """The segments of a manifest, by default the newest: buckets and batches, not rows."""
        manifest = manifest or self._manifests()[0]
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifests/{manifest}").collect()
        return sorted(Segment(r["bucket"], r["segment"]) for r in rows)

    def _publish(self, segments: list[Segment], earlier: list[str]) -> None:
        manifest = uuid.uuid4().hex
        (self.spark.createDataFrame([tuple(s) for s in segments], MANIFEST).coalesce(1)
         .write.parquet(f"{self.root}/manifests/{manifest}"))
        columns = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in self.schema)
        nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in self.schema)
        body = (f"SELECT {columns} FROM parquet.`{self._glob(segments)}`" if segments
                else f"SELECT {nothing} WHERE false")
        kept = ",".join([manifest, *earlier][:KEPT_MANIFESTS])
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name} TBLPROPERTIES ('manifests' = '{kept}') AS {body}")
        self.spark.catalog.refreshTable(self.name)

    def _glob(self, segments: list[Segment]) -> str:
        paths = [s.path for s in segments]
        return f"{self.root}/{paths[0]}" if len(paths) == 1 else f"{self.root}/{{{','.join(paths)}}}"

    # --- reading ----------------------------------------------------------------------------

    def bucket_of(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _read(self, segments: list[Segment]) -> DataFrame:
        paths = [f"{self.root}/{s.path}" for s in segments]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def current(self, of: DataFrame | None = None) -> DataFrame:
        """Current rows, or only those in the buckets that the keys of `of` fall in."""
        segments = [s for s in self.segments() if s.bucket != CLOSED]
        if of is not None:
            wanted = self._buckets(of)
            segments = [s for s in segments if s.bucket in wanted]
        return self._read(segments)

    def _buckets(self, df: DataFrame) -> set[int]:
        return {r[0] for r in df.select(self.bucket_of(F.col(self.key))).distinct().collect()}

    # --- writing ----------------------------------------------------------------------------

    def apply(self, changes: DataFrame, batch_ts: datetime, rules: Rules = DEFAULT_RULES) -> None:
        """Close and open rows as `_action` of `changes` (new, changed, unchanged) says.

        `changes` is a stored table with one row per key. Nothing is written if nothing changed.
        """
        moved = changes.where(F.col("_action") != "unchanged")
        facts = {r["_bucket"]: r["closes"] for r in moved.groupBy(self.bucket_of(F.col(self.key)).alias("_bucket")).agg(
            F.max(F.when(F.col("_action") == "changed", 1).otherwise(0)).alias("closes")).collect()}
        if not facts:
            return
        segments = self.segments()
        held: dict[int, list[Segment]] = {}
        for s in segments:
            held.setdefault(s.bucket, []).append(s)
        rewritten = {b for b, closes in facts.items() if closes or len(held.get(b, [])) >= MOST_SEGMENTS}
        old = self._read([s for b in sorted(rewritten) for s in held.get(b, [])])
        closing = changes.where(F.col("_action") == "changed").select(self.key)
        opened = open_rows(moved.drop("_action"), batch_ts, rules)
        version = f"{batch_ts:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}"
        kept = conform(old.join(closing, self.key, "left_anti"), self.schema)
        self._write(kept.unionByName(conform(opened, self.schema)), f"{version}/current")
        closed = conform(old.join(closing, self.key, "left_semi").withColumns(
            {"row_effective_to": F.lit(batch_ts.date()), "is_current_flag": F.lit(False)}), self.schema)
        new = [Segment(b, f"{version}/current/_bucket={b}") for b in sorted(facts)]
        if any(facts.values()):
            closed.write.parquet(f"{self.root}/{version}/closed")
            new.append(Segment(CLOSED, f"{version}/closed"))
        self._publish([s for s in segments if s.bucket not in rewritten] + new, self._manifests())

    def _write(self, rows: DataFrame, folder: str) -> None:
        """Current rows, one folder per bucket."""
        checked = required_columns_filled(rows, self.schema).withColumn("_bucket", self.bucket_of(F.col(self.key)))
        checked.repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.root}/{folder}")

    # --- maintenance ------------------------------------------------------------------------

    def compact(self) -> None:
        """Merge the closed segments into one; current segments stay as they are."""
        segments = self.segments()
        closed = [s for s in segments if s.bucket == CLOSED]
        if len(closed) < 2:
            return
        path = f"compact-{uuid.uuid4().hex[:12]}/closed"
        self._read(closed).write.parquet(f"{self.root}/{path}")
        self._publish([s for s in segments if s.bucket != CLOSED] + [Segment(CLOSED, path)], self._manifests())

    def vacuum(self) -> list[str]:
        """Delete the segments and manifests that none of the kept manifests names, also those that
        a failed batch left. Returns their paths. Not while a batch is being written."""
        manifests = self._manifests()
        named = {s.path for m in manifests for s in self.segments(m)}
        found = [f"manifests/{m}" for m in subfolders(self.spark, f"{self.root}/manifests")]
        for version in subfolders(self.spark, self.root):
            for part in subfolders(self.spark, f"{self.root}/{version}"):
                if part == "closed":
                    found.append(f"{version}/{part}")
                elif version != "manifests":
                    found += [f"{version}/{part}/{b}" for b in subfolders(self.spark, f"{self.root}/{version}/{part}")]
        keep = named | {f"manifests/{m}" for m in manifests}
        gone = [p for p in found if p not in keep]
        for p in gone:
            delete(self.spark, f"{self.root}/{p}")
        return gone
