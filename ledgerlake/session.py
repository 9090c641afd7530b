"""Session set-up: SQL settings the operators rely on, and the checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Adaptive execution re-sizes partitions from real shuffle sizes and splits hot ones.
# `forceOptimizeSkewedJoin` lets it split a hot join partition even when a later
# aggregation would have liked to reuse that partitioning.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


# Generated methods above this size are never compiled by the JVM, which the parsing of wide rows
# runs into; Spark then generates smaller ones. A task reads little of a file: its rows grow by the
# parsing and are sorted before they are shuffled, which should fit its memory, and cost so much
# time that many tasks are wanted.
PARSING_SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000", "spark.sql.files.maxPartitionBytes": "8m",
                    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings above to a running session."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


# Rows are sorted in memory behind a shuffle, so its partitions must stay small however large the
# batch: adaptive execution joins small ones, but cannot cut a large one that holds many keys. Up to
# 200 of them Spark also writes a shuffle straight to its files, without keeping rows in memory.
LEAST_INITIAL_PARTITIONS = 200


def configure_parsing(spark: SparkSession) -> SparkSession:
    """`configure`, and what the lending tables' wide expressions need."""
    for key, value in PARSING_SETTINGS.items():
        spark.conf.set(key, value)
    partitions = max(LEAST_INITIAL_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
    return configure(spark)


def local_session(app: str = "ledgerlake", cpus: int | str = "*", partitions: int = 8,
                  memory: str = "12g") -> SparkSession:
    """A session for a laptop, tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`.

    Only a local session, which has no other machine to lose, may fall back to a folder of
    its own.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a shared folder")
            folder = tempfile.mkdtemp(prefix="ledgerlake-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """`df` with its rows and partitions fixed in the checkpoint folder."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """`df` written as a parquet table in the checkpoint folder and read back.

    For results that several later steps read: they prune its columns and see its size.
    """
    spark = df.sparkSession
    folder = f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder, compression="zstd")
    return spark.read.schema(df.schema).parquet(folder)


def discard(*tables: DataFrame) -> None:
    """Delete what `materialise` has written of the given tables, which nothing may read any more."""
    for df in tables:
        spark = df.sparkSession
        parent = checkpoint_folder(spark).rstrip("/").rsplit("/", 1)[-1]
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if folder.split("/")[-2] == parent:
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise_columns(df: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """As `materialise`, but only `columns` are computed and written; the others read as NULL.

    A struct column may be cut down to a field, given as `column.field`.
    """
    wanted: dict[str, list[str]] = {}
    for column in columns:
        top, _, field = column.partition(".")
        wanted.setdefault(top, []).extend([field] if field else [])

    def cut(field: T.StructField) -> Column:
        inner = wanted.get(field.name)
        if inner is None:
            return F.lit(None).cast(field.dataType).alias(field.name)
        if not inner:
            return F.col(field.name)
        return F.struct(*[(F.col(f"{field.name}.{f.name}") if f.name in inner else F.lit(None).cast(f.dataType))
                          .alias(f.name) for f in field.dataType.fields]).alias(field.name)

    return materialise(df.select(*[cut(f) for f in df.schema.fields]), name)
