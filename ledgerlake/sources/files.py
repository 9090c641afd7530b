"""What both file readers share: lineage, ingest position, physical line numbers."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import POSITION


class SourceNotFound(FileNotFoundError):
    """The input path matches no file."""


def position() -> Column:
    """Where a row stood in its file. File, block start and the running id within the task
    order the rows of a file as they are stored, however the files were packed into tasks."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def with_lineage(df: DataFrame, batch_ts: datetime) -> DataFrame:
    """Add the file's base name, the batch instant and the ingest position."""
    return df.withColumns({
        "_source_file": F.col("_metadata.file_name"),
        "_last_updated_ts": F.lit(batch_ts).cast("timestamp"),
        POSITION: position(),
    })


def open_source(spark: SparkSession, path: str, read) -> DataFrame:
    """Run `read`, turning Spark's missing-path error into `SourceNotFound`."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise SourceNotFound(f"Source file not found: {path}") from error
        raise


def line_numbers(wanted: DataFrame, lines: DataFrame, name: str) -> DataFrame:
    """Physical line number of the `wanted` rows within their file, counting from 1.

    `lines` holds every line of the same read. Each file block contributes its first running
    id and its number of lines; the blocks before it in the file add up to its offset. Only
    the wanted rows and one row per block are joined.
    """
    where = F.col(POSITION)
    blocks = lines.groupBy(where["file"].alias("_file"), where["block"].alias("_block")).agg(
        F.min(where["row"]).alias("_first"), F.count("*").alias("_n"))
    before = (Window.partitionBy("_file").orderBy("_block")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = blocks.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    located = wanted.withColumns({"_file": where["file"], "_block": where["block"]})
    number = F.col("_off") + where["row"] - F.col("_first") + F.lit(1)
    return (located.join(offsets, ["_file", "_block"]).withColumn(name, number)
            .select(*wanted.columns, name))
