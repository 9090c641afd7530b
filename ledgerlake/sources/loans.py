"""Loan CSV files into raw text rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_strings
from ..schemas import POSITION, RAW_LOAN, conform
from ..settings import LOAN_FILE_COLUMNS
from .files import open_source, with_lineage
from .records import whole_records

# How the files are written; doubled quotes stand for themselves.
CSV_FORMAT = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}


class MissingColumns(ValueError):
    """The header lacks columns the pipeline needs."""


def text_lines(reader) -> object:
    """A reader, batch or stream, set to give the lines of a CSV file."""
    return reader.option("lineSep", "\n")


def loan_rows(lines: DataFrame, batch_ts: datetime, columns: list[str]) -> DataFrame:
    """Lines of CSV files, with their `_metadata`, into raw loan rows.

    `columns` are those of the files, in order; the first line of every file must name them.
    """
    stamped = with_lineage(lines.select("value", "_metadata"), batch_ts).drop("_metadata")
    records = whole_records(stamped, POSITION)
    named = F.lower(F.regexp_replace("value", '[\\s"\\uFEFF]', ""))
    expected = ",".join(columns).lower().replace(" ", "").replace('"', "")
    fail = F.raise_error(F.concat(F.lit("the header of "), F.col("_source_file"), F.lit(" has other columns")))
    is_row = F.when(~F.col("_header"), True).when(named == expected, False).otherwise(fail.cast("boolean"))
    parsed = records.where(is_row).withColumn(
        "_csv", F.from_csv("value", ", ".join(f"`c{i}` string" for i in range(len(columns))), CSV_FORMAT))
    rows = parsed.select(*[F.col("_csv")[f"c{columns.index(c)}"].alias(c) for c in LOAN_FILE_COLUMNS], "_source_file", "_last_updated_ts", POSITION)
    return conform(clean_strings(rows, LOAN_FILE_COLUMNS), RAW_LOAN)


def read_loan_files(spark: SparkSession, path: str, batch_ts: datetime,
                    multi_line: bool = True) -> DataFrame:
    """Raw loan rows: text as in the file, trimmed, blank to NULL, with lineage.

    Extra columns are ignored and short rows filled with NULL. Files of any size are read in
    byte ranges, quoted line breaks included. Files known to hold none can turn `multi_line`
    off, which saves the step that looks for them. All files must have the same columns.
    """
    def header() -> DataFrame:
        return (spark.read.option("header", True).option("multiLine", multi_line)
                .options(**CSV_FORMAT).option("encoding", "UTF-8").csv(path))

    table = open_source(spark, path, header)
    missing = sorted(set(LOAN_FILE_COLUMNS) - set(table.columns))
    if missing:
        raise MissingColumns(f"loan file is missing columns: {missing}")
    if multi_line:
        return loan_rows(text_lines(spark.read).text(path), batch_ts, table.columns)
    rows = with_lineage(table.select(*LOAN_FILE_COLUMNS, "_metadata"), batch_ts)
    return conform(clean_strings(rows, LOAN_FILE_COLUMNS), RAW_LOAN)


def has_quoted_line_breaks(spark: SparkSession, path: str) -> bool:
    """Whether any physical line ends inside quotes: it then holds an odd number of them."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    return not spark.read.text(path).where(quotes % 2 == 1).isEmpty()
