"""Incremental ingestion: new files become batches, landed by the same steps as a batch run."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans import pipeline
from ..settings import LOAN_FILE_COLUMNS
from ..sources.files import with_lineage
from ..sources.loans import loan_rows, text_lines
from ..sources.payments import route_lines
from ..sources.tables import Lake


def batch_instant(first: datetime, batch_id: int) -> datetime:
    """The instant of a micro-batch. It follows from the batch id, so a micro-batch that is
    retried writes over its own partition instead of adding a second copy."""
    return first + timedelta(seconds=batch_id)


def stream_loans(lake: Lake, folder: str, checkpoint: str, first: datetime,
                 as_of: date) -> StreamingQuery:
    """Land every loan file that has arrived in `folder` since the last run, then stop.

    The files must have the ten expected columns in order. They are read in byte ranges, also
    where quoted fields hold line breaks.
    """
    lines = text_lines(lake.spark.readStream).text(folder).select("value", "_metadata")

    def land(rows: DataFrame, batch_id: int) -> None:
        run = pipeline.Run(lake, batch_instant(first, batch_id), as_of)
        pipeline.ingest_loans(run, loan_rows(rows, run.batch_ts, list(LOAN_FILE_COLUMNS)), folder)
        pipeline.land_loans(run)

    return (lines.writeStream.option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).foreachBatch(land).start())


def stream_payments(lake: Lake, folder: str, checkpoint: str, first: datetime,
                    as_of: date) -> StreamingQuery:
    """Land every payment file that has arrived in `folder` since the last run, then stop."""
    lines = lake.spark.readStream.text(folder).select("value", "_metadata")

    def land(rows: DataFrame, batch_id: int) -> None:
        run = pipeline.Run(lake, batch_instant(first, batch_id), as_of)
        routed = route_lines(with_lineage(rows, run.batch_ts), run.batch_ts)
        pipeline.ingest_payments(run, routed, folder)
        pipeline.land_payments(run)

    return (lines.writeStream.option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).foreachBatch(land).start())
