"""Payment JSON lines into raw text rows, bad lines into reject rows."""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.stages import computed
from ..functions.text import clean_string, clean_strings, strip
from ..schemas import LND_ERR_PAYMENT, POSITION, RAW_PAYMENT, conform
from ..settings import PAYMENT_FILE_COLUMNS
from .files import line_numbers, open_source, with_lineage

# Raw column -> place in the JSON document.
PAYMENT_PATHS = {
    "payment_id": "$.payment_id",
    "loan_id": "$.loan_id",
    "amount": "$.amount",
    "payment_timestamp": "$.timestamp",
    "payment_method_type": "$.payment_method.type",
    "payment_method_last_four": "$.payment_method.details.last_four",
    "payment_method_bank": "$.payment_method.details.bank",
    "metadata_source": "$.metadata.source",
    "metadata_user_agent": "$.metadata.user_agent",
}
# Parents that must be objects, and the text of values that count as absent.
PARENTS = ("$.payment_method", "$.payment_method.details", "$.metadata")
ABSENT = ("", "0", "0.0", "false", "[]", "{}")


def _kind(document: Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(document, path, "variant"))


def line_problem(document: Column) -> Column:
    """Why a parsed line is unusable; NULL when it is fine. A missing, null or otherwise
    empty parent only leaves its children empty."""
    top = F.schema_of_variant(document)
    problem = (
        F.when(document.isNull(), "malformed JSON: no JSON text")
        .when(~top.startswith("OBJECT"), F.concat(F.lit("wrong parent: line is "), top))
    )
    for path in PARENTS:
        text = F.try_variant_get(document, path, "string")
        kind = _kind(document, path)
        misplaced = (kind.isNotNull() & (kind != "VOID") & ~kind.startswith("OBJECT")
                     & ~F.coalesce(text.isin(*ABSENT), F.lit(False)))
        problem = problem.when(misplaced, F.concat(F.lit(f"wrong parent: {path} is "), kind))
    return problem


# What a usable line holds, in the types of its JSON; the amount keeps its kind of number. The
# line is read as the one element of an array, so that text behind its end is an error too.
LINE_SCHEMA = (
    "line array<struct<payment_id: string, loan_id: string, amount: variant, timestamp: string, "
    "payment_method: struct<type: string, details: struct<last_four: string, bank: string>>, "
    "metadata: struct<source: string, user_agent: string>>>, _corrupt string"
)
STRICT_JSON = {"columnNameOfCorruptRecord": "_corrupt", "allowSingleQuotes": "false",
               "allowNonNumericNumbers": "false"}


def _amount_text(number: Column) -> Column:
    """A JSON decimal without a fraction loses its point; it is written back with one."""
    text = clean_string(F.try_variant_get(number, "$", "string"))
    whole = F.schema_of_variant(number).startswith("DECIMAL") & ~text.contains(".")
    return F.when(whole, F.concat(text, F.lit(".0"))).otherwise(text)


def flatten_lines(lines: DataFrame, text: str = "value") -> DataFrame:
    """Parse JSON lines: the nine raw text columns and `_problem`. Blank lines are dropped; of a
    key that is repeated the last value counts.

    Lines of the expected shape are read by their schema. Only the others, which are malformed or
    have a parent of another type, are parsed without one to find out what is wrong.

    `lines` keeps its other columns.
    """
    trimmed = lines.withColumn(text, strip(F.col(text))).where(F.length(text) > 0)
    read = computed(trimmed, {"_read": F.from_json(
        F.concat(F.lit('{"line": ['), F.col(text), F.lit("]}")), LINE_SCHEMA, STRICT_JSON)})
    usable = (F.col("_read._corrupt").isNull() & (F.size("_read.line") == 1) & F.get("_read.line", F.lit(0)).isNotNull()
              & F.col(text).startswith("{"))
    # Parsing alone would stop at the end of the first value, whatever follows it.
    values = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), F.col(text), F.lit("]"))), "$", "array<variant>")
    parsed = computed(read, {"_line": F.when(usable, F.get("_read.line", F.lit(0)))}, keep=[*lines.columns])
    parsed = computed(parsed, {"_values": F.when(F.col("_line").isNull(), values)}).withColumn(
        "_doc", F.when(F.size("_values") == 1, F.get("_values", F.lit(0))))
    fields = {}
    for name, path in PAYMENT_PATHS.items():
        known, other = F.col(f"_line{path[1:]}"), F.try_variant_get("_doc", path, "variant")
        if name == "amount":
            fields[name] = F.when(F.col("_line").isNotNull(), _amount_text(known)).otherwise(_amount_text(other))
        else:
            found = F.when(F.col("_line").isNotNull(), known).otherwise(F.try_variant_get("_doc", path, "string"))
            fields[name] = clean_string(found)
    problem = F.when(F.col("_line").isNull(), line_problem(F.col("_doc")))
    return computed(parsed, {**fields, "_problem": problem}, keep=lines.columns)


class PaymentLines(NamedTuple):
    good: DataFrame
    bad: DataFrame
    parsed: DataFrame


def route_lines(lines: DataFrame, batch_ts: datetime, text: str = "value") -> PaymentLines:
    """Split lines that carry lineage and position into raw rows and reject rows.

    A reject row has no payload and the reason `Line N: <error>`, N counting every physical
    line of the file, blank ones included.
    """
    parsed = flatten_lines(lines, text)
    good = conform(parsed.where(F.col("_problem").isNull()), RAW_PAYMENT)
    broken = parsed.where(F.col("_problem").isNotNull()).select(
        "_source_file", "_last_updated_ts", POSITION, "_problem")
    numbered = line_numbers(broken, lines, "_line")
    bad = numbered.select(
        "_source_file", "_last_updated_ts",
        F.concat(F.lit("Line "), F.col("_line").cast("string"), F.lit(": "), F.col("_problem"))
        .alias("_rejection_reason"),
        F.lit(batch_ts).cast("timestamp").alias("_rejected_at"),
    )
    return PaymentLines(good, conform(bad, LND_ERR_PAYMENT), parsed)


def read_payment_files(spark: SparkSession, path: str, batch_ts: datetime) -> PaymentLines:
    def read() -> DataFrame:
        return spark.read.text(path)

    text = open_source(spark, path, read)
    return route_lines(with_lineage(text.select("value", "_metadata"), batch_ts), batch_ts)


def raw_payment_rows(fields: DataFrame) -> DataFrame:
    """Untyped payment columns from elsewhere, trimmed like those read from lines."""
    return clean_strings(fields, PAYMENT_FILE_COLUMNS)
