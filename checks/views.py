"""Lending-shaped rows derived from the given tables.

Every order is one loan record and every line item one payment; the spelling of a value
follows from its keys, so that all notations, gaps and faults occur. Urgent orders are
delivered twice (the second copy later in the file), as are line items with the largest
discount. `checks/oracle.py` states the same derivation in SQL.
"""

from __future__ import annotations

from datetime import date, datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.cleaning import (
    accepted, classify_loans, classify_payments, rejected, with_loan_hash,
)
from ledgerlake.functions.stages import computed
from ledgerlake.functions.text import clean_strings
from ledgerlake.operators.dedup import first_per_key, last_per_key
from ledgerlake.operators.ledger import LEDGER_KEY, allocate, loan_standing
from ledgerlake.operators.scd2 import open_rows
from ledgerlake.session import materialise
from ledgerlake.schemas import LND_LOAN, LND_PAYMENT, conform
from ledgerlake.settings import LOAN_FILE_COLUMNS, PAYMENT_FILE_COLUMNS

AS_OF = date(2001, 11, 5)
BATCH_TS = datetime(2001, 11, 5, 6, 0, 0)
EARLIER_TS = datetime(2001, 1, 1, 6, 0, 0)

LOAN_ORDER = ["_k", "_copy"]
PAYMENT_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
                 "l_extendedprice", "l_linestatus", "_copy"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    path = f"{folder}/{name}.parquet"
    return spark.read.parquet(path)


def order_of(columns: list[str]) -> Column:
    return F.struct(*columns)


def _choose(number: Column, values: list[str]) -> Column:
    """The value at position `number`."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (number + 1).cast("int"))


def _padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def _money(value: Column) -> Column:
    return value.cast("decimal(18,2)").cast("string")


def loan_file(spark: SparkSession, folder: str) -> DataFrame:
    """Untrimmed loan text columns, `_k` and `_copy` giving the position in the file."""
    o = table(spark, folder, "orders")
    k, cust, prio = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderpriority")
    copies = F.when(prio == "1-URGENT", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    o = o.withColumn("_copy", F.explode(copies))
    again = F.col("_copy") == 1
    amount = _money(F.col("o_totalprice"))
    principal = (
        F.when(again & (k % 41 == 2), "N/A")
        .when(k % 97 == 3, "not_a_number").when(k % 89 == 4, "0.00").when(k % 83 == 7, "")
        .when(k % 53 == 6, F.concat(F.lit("-$"), amount))
        .when(k % 3 == 0, F.concat(F.lit("$"), amount))
        .when(k % 3 == 1, F.format_number("o_totalprice", 2))
        .otherwise(F.concat(F.lit(" "), amount)))
    rate = (
        F.when(k % 71 == 9, "n/a").when(k % 67 == 8, "")
        .otherwise(((k % 20) * 0.75).cast("decimal(8,2)").cast("string")))
    term = (
        F.when(k % 79 == 10, "12.0").when(k % 73 == 11, "")
        .otherwise(_choose(k % 6, ["12", "24", "36", "60", "120", "360"])))
    day = F.to_date("o_orderdate")
    originated = (
        F.when(k % 193 == 12, "someday").when(k % 199 == 14, "").when(k % 197 == 15, "2023-02-30")
        .when(k % 191 == 16, F.date_format(day, "MMMM d, yyyy"))
        .when(k % 181 == 17, F.date_format(day, "dd/MM/yyyy"))
        .when(k % 4 == 0, day.cast("string"))
        .when(k % 4 == 1, F.date_format(day, "dd-MMM-yyyy"))
        .when(k % 4 == 2, F.date_format(day, "MM/dd/yyyy"))
        .otherwise(F.replace(day.cast("string"), F.lit("-"), F.lit(""))))
    channel = (
        F.when(prio == "1-URGENT", "Online").when(prio == "2-HIGH", "BRANCH ")
        .when(prio == "3-MEDIUM", "partner").when(prio == "5-LOW", "fax").otherwise("\tMobile"))
    status = (
        F.when(k % 307 == 20, " ").when(again, "ACTIVE")
        .when(F.col("o_orderstatus") == "O", "Active").when(F.col("o_orderstatus") == "P", "active ")
        .when(k % 2 == 0, "CLOSED").otherwise(" Default"))
    product = _choose(k % 9, ["personal", "MORTGAGE ", "Student", " auto", "PERSONAL", "Mortgage",
                              "student", "Auto", "boat"])
    segment = _choose(cust % 4, ["Salaried", "self-employed", " RETIRED ", "unemployed"])
    score = (
        F.when(cust % 47 == 2, '"712"').when(cust % 59 == 4, '"high"')
        .otherwise((300 + cust % 551).cast("string")))
    years = F.when(cust % 53 == 3, "3.7").otherwise((cust % 40).cast("string"))
    income = _money(((cust % 1000) * 137 + 12000).cast("decimal(18,2)") / 4)
    job = (
        F.when(cust % 67 == 6, "").when(cust % 71 == 7, '"employment": null, ')
        .otherwise(F.concat(F.lit('"employment": "'), segment, F.lit('", '))))
    borrower = (
        F.when(cust % 41 == 0, '{"credit_score": ').when(cust % 43 == 1, "")
        .when(cust % 61 == 5, "[1, 2]")
        .otherwise(F.concat(F.lit('{"credit_score": '), score, F.lit(", "), job,
                            F.lit('"annual_income": '), income, F.lit(', "years_employed": '),
                            years, F.lit("}"))))
    return o.select(
        F.when(k % 211 == 5, "   ").otherwise(F.concat(F.lit("L"), _padded(k, 12))).alias("loan_id"),
        F.when(cust % 97 == 13, "").otherwise(
            F.concat(F.lit(" C"), _padded(cust, 9), F.lit(" "))).alias("customer_id"),
        F.when((k % 9 == 8) & (k % 5 == 0), "").otherwise(product).alias("product_type"),
        principal.alias("principal_amount"), rate.alias("interest_rate"),
        term.alias("term_months"), originated.alias("origination_date"),
        channel.alias("origination_channel"), status.alias("status"),
        borrower.alias("borrower_info"), k.alias("_k"), "_copy", day.alias("_day"))


def loans_raw(spark: SparkSession, folder: str) -> DataFrame:
    return clean_strings(loan_file(spark, folder), LOAN_FILE_COLUMNS)


def with_source(df: DataFrame, name: str, ts: datetime = BATCH_TS) -> DataFrame:
    return df.withColumns({"_source_file": F.lit(name),
                           "_last_updated_ts": F.lit(ts).cast("timestamp")})


def loans_classified(spark: SparkSession, folder: str) -> DataFrame:
    raw = with_source(loans_raw(spark, folder), "loans.csv")
    return classify_loans(last_per_key(raw, "loan_id", LOAN_ORDER))


def loans_clean(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned rows of the whole batch, one per loan id, hashed."""
    keep = ["_source_file", "_last_updated_ts", "_k", "_day"]
    return with_loan_hash(accepted(loans_classified(spark, folder), keep))


def loan_errors(spark: SparkSession, folder: str) -> DataFrame:
    return rejected(loans_classified(spark, folder),
                    [*LOAN_FILE_COLUMNS, "_source_file", "_last_updated_ts"],
                    F.lit(BATCH_TS).cast("timestamp"))


def lnd_loan(spark: SparkSession, folder: str) -> DataFrame:
    """The loan table after loading the whole batch into an empty one."""
    return conform(open_rows(loans_clean(spark, folder), BATCH_TS), LND_LOAN)


def earlier_history(spark: SparkSession, folder: str, clean: DataFrame | None = None) -> DataFrame:
    """The loan table as an earlier batch left it: loans originated before that day, every
    eleventh of them with another status and principal. Undated loans were not in it. `clean`
    may hold the cleaned loans with their `_k` and `_day`, where they are written down."""
    before = (loans_clean(spark, folder) if clean is None else clean).where(F.col("_day") < F.lit(EARLIER_TS.date()))
    differs = F.col("_k") % 11 == 0
    before = before.withColumns({
        "status": F.when(differs, F.lit("pending")).otherwise(F.col("status")),
        "principal_amount": F.when(differs, F.col("principal_amount") + 100)
        .otherwise(F.col("principal_amount")).cast("decimal(18,2)"),
    })
    return conform(open_rows(with_loan_hash(before), EARLIER_TS), LND_LOAN)


def payment_file(spark: SparkSession, folder: str) -> DataFrame:
    """Untrimmed payment text columns and the line-item columns that order them."""
    li = table(spark, folder, "lineitem")
    k, line = F.col("l_orderkey"), F.col("l_linenumber")
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    copies = F.when(F.col("l_discount") > 0.095, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0)))
    li = li.withColumn("_copy", F.explode(copies))
    again = F.col("_copy") == 1
    cents = F.floor(F.col("l_extendedprice") * 5).cast("decimal(18,2)")
    amount = (cents / 100).cast("decimal(18,2)").cast("string")
    amount = (
        F.when(part % 211 == 3, F.concat(F.lit("-"), amount)).when(part % 223 == 4, "abc")
        .when(part % 227 == 5, "").when(again & (supp % 2 == 0), F.concat(amount, F.lit("0")))
        .otherwise(amount))
    day = F.to_date("l_shipdate").cast("string")
    instant = (
        F.when(supp % 97 == 6, "yesterday").when(supp % 83 == 9, "")
        .when(line == 1, F.concat(day, F.when(again & (supp % 3 == 0), "T05:00:00-05:00")
                                  .otherwise("T10:00:00Z")))
        .when(line == 2, F.concat(day, F.lit("T22:30:00-05:00")))
        .when(line == 3, F.concat(day, F.lit("T01:15:00+08:00")))
        .when(line == 4, F.concat(day, F.lit("T08:05:09")))
        .when(line == 5, day)
        .when(line == 6, F.concat(day, F.lit("T12:00:00.250Z")))
        .otherwise(F.concat(F.replace(day, F.lit("-"), F.lit("")), F.lit("T101010Z"))))
    loan = (
        F.when(k % 103 == 8, F.lit(None).cast("string"))
        .when(k % 101 == 7, F.concat(F.lit("L"), _padded(k + 500_000_000_000, 12)))
        .otherwise(F.concat(F.lit("L"), _padded(k, 12))))
    method = _choose(line % 6, ["ACH", "card", "Check ", " WIRE", "cash", "crypto"])
    return li.select(
        F.when(supp % 89 == 1, "").otherwise(
            F.concat(F.lit("P"), _padded(k, 12), line.cast("string"))).alias("payment_id"),
        loan.alias("loan_id"), amount.alias("amount"), instant.alias("payment_timestamp"),
        method.alias("payment_method_type"),
        F.when(line % 6 == 1, _padded(part % 10000, 4)).alias("payment_method_last_four"),
        F.when(line % 6 != 1, F.concat(F.lit("Bank "), (supp % 7).cast("string"), F.lit(" ")))
        .alias("payment_method_bank"),
        F.when(F.col("l_linestatus") == "O", "web").otherwise("mobile_app")
        .alias("metadata_source"),
        F.when(F.col("l_linestatus") == "F", F.concat(F.lit("App/"), line.cast("string")))
        .alias("metadata_user_agent"),
        *PAYMENT_ORDER)


def payments_raw(spark: SparkSession, folder: str) -> DataFrame:
    return clean_strings(payment_file(spark, folder), PAYMENT_FILE_COLUMNS)


def payments_first(spark: SparkSession, folder: str, columns: tuple[str, ...] | None = None) -> DataFrame:
    """The raw batch without exact copies; with `columns` only those, the key and the columns that
    order the rows."""
    raw = with_source(payments_raw(spark, folder), "payments.jsonl")
    if columns is not None:
        raw = raw.select(*dict.fromkeys([*LEDGER_KEY, *PAYMENT_ORDER, *columns]))
    return first_per_key(raw, ["payment_id", "amount", "payment_timestamp"], PAYMENT_ORDER)


def payments_classified(spark: SparkSession, folder: str) -> DataFrame:
    return classify_payments(payments_first(spark, folder))


def payments_clean(spark: SparkSession, folder: str, columns: tuple[str, ...] | None = None) -> DataFrame:
    """Cleaned payments, one per typed composite key; with `columns` only those, the key and the
    columns that order the rows.

    Verdict and typed key follow from the raw key, so dropping exact copies first would change
    nothing and cost a shuffle of all rows. Cleaning trims by itself; trimming twice changes nothing.
    """
    raw = with_source(payment_file(spark, folder), "payments.jsonl")
    clean = accepted(classify_payments(raw), ["_source_file", "_last_updated_ts", *PAYMENT_ORDER])
    if columns is not None:
        clean = clean.select(*dict.fromkeys([*LEDGER_KEY, *PAYMENT_ORDER, *columns]))
    return first_per_key(clean, list(LEDGER_KEY), PAYMENT_ORDER)


def payment_errors(spark: SparkSession, folder: str) -> DataFrame:
    return rejected(payments_classified(spark, folder),
                    [*PAYMENT_FILE_COLUMNS, "_source_file", "_last_updated_ts"],
                    F.lit(BATCH_TS).cast("timestamp"))


class Landed:
    """The landed tables of one batch, each built once and written, as a batch run does it.

    Queries on top of several landed tables read these; nothing is kept between queries. A query
    that reads rejected loans says so, as raw columns are written for those only; so does one that
    reads the loans a single time, for which they are not written.
    """

    def __init__(self, spark: SparkSession, folder: str, with_loan_errors: bool = False,
                 loans_once: bool = False):
        self.spark, self.folder, self.with_loan_errors = spark, folder, with_loan_errors
        self.loans_once = loans_once

    @cached_property
    def raw_loans(self) -> DataFrame:
        return with_source(loans_raw(self.spark, self.folder), "loans.csv")

    @cached_property
    def raw_payments(self) -> DataFrame:
        return with_source(payments_raw(self.spark, self.folder), "payments.jsonl")

    @cached_property
    def _loans(self) -> DataFrame:
        return materialise(loans_classified(self.spark, self.folder), "loans")

    @cached_property
    def lnd_loan(self) -> DataFrame:
        lineage = ["_source_file", "_last_updated_ts"]
        if self.loans_once:
            return lnd_loan(self.spark, self.folder)
        if self.with_loan_errors:
            clean = accepted(self._loans, lineage)
        else:
            clean = materialise(accepted(loans_classified(self.spark, self.folder), lineage), "loans")
        return conform(open_rows(with_loan_hash(clean), BATCH_TS), LND_LOAN)

    @cached_property
    def loan_errors(self) -> DataFrame:
        return self._loans.where(F.col("_rejection_reason").isNotNull())

    @cached_property
    def payment_errors(self) -> DataFrame:
        """The verdict follows from the raw key, so only rejected rows are deduplicated."""
        judged = classify_payments(self.raw_payments)
        return first_per_key(judged.where(F.col("_rejection_reason").isNotNull()).drop("_clean"),
                             ["payment_id", "amount", "payment_timestamp"], PAYMENT_ORDER)

    def _booked(self, *columns: str) -> DataFrame:
        clean = payments_clean(self.spark, self.folder, ("loan_id", *columns))
        return allocate(clean, loan_standing(self.lnd_loan, self.raw_loans))

    @cached_property
    def ledger(self) -> DataFrame:
        return self.ledger_of(*[c for c in LND_PAYMENT.names if c not in (
            "lnd_payment_sk", "payment_allocation_status")])

    def ledger_of(self, *columns: str) -> DataFrame:
        """The ledger, written with its key, loan, allocation and the `columns` that a query reads;
        the others are NULL."""
        return materialise(conform(self._booked(*columns), LND_PAYMENT), "ledger")

    def ledger_once(self, *columns: str) -> DataFrame:
        """The `columns` of the ledger for a query that reads it a single time: not written down,
        so that the partitioning by loan serves the steps behind it too."""
        return self._booked(*[c for c in columns if c != "payment_allocation_status"]).select(*columns)


def payment_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The payments as JSON lines, with malformed, blank and misshapen lines among them."""
    p = payment_file(spark, folder)
    supp = F.col("l_suppkey")

    def text(name: str) -> Column:
        return F.coalesce(F.concat(F.lit('"'), F.col(name), F.lit('"')), F.lit("null"))

    plain = F.col("amount").rlike(r"^-?\d+\.\d+$")
    amount = F.when(plain, F.col("amount")).otherwise(text("amount"))
    method = (
        F.when(supp % 71 == 4, F.lit('"cash"')).when(supp % 61 == 5, F.lit('""'))
        .when(supp % 59 == 7, F.lit("null"))
        .otherwise(F.concat(F.lit('{"type": '), text("payment_method_type"),
                            F.lit(', "details": {"last_four": '),
                            text("payment_method_last_four"), F.lit(', "bank": '),
                            text("payment_method_bank"), F.lit("}}"))))
    meta = F.when(supp % 53 == 8, F.lit("")).otherwise(
        F.concat(F.lit(', "metadata": {"source": '), text("metadata_source"),
                 F.lit(', "user_agent": '), text("metadata_user_agent"), F.lit("}")))
    line = (
        F.when(supp % 79 == 2, "not valid json line").when(supp % 73 == 3, "   ")
        .when(supp % 67 == 11, "[1, 2]")
        .otherwise(F.concat(
            F.lit('{"payment_id": '), text("payment_id"), F.lit(', "loan_id": '), text("loan_id"),
            F.lit(', "amount": '), amount, F.lit(', "timestamp": '), text("payment_timestamp"),
            F.lit(', "payment_method": '), method, meta, F.lit("}"))))
    return computed(p, {"value": line}, keep=PAYMENT_ORDER)
