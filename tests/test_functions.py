"""Column expressions on single values."""

import re
from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import finance
from ledgerlake.functions.borrower import with_borrower
from ledgerlake.functions.cleaning import accepted, classify_payments
from ledgerlake.functions.dates import parse_date, parse_timestamp
from ledgerlake.functions.numbers import (
    money_digits, parse_decimal, parse_integer, parse_money, rounded,
)
from ledgerlake.functions.text import clean_string, normalise_category
from ledgerlake.settings import PAYMENT_FILE_COLUMNS

BAD = "bad"


def outcome(parsed):
    """The value as text, or `bad`."""
    return F.when(parsed.bad, F.lit(BAD)).otherwise(parsed.value.cast("string"))


def test_text(one):
    values = [None, "", "  ", "\t\n", " a  b ", " x　", "Mixed Case "]
    assert one(clean_string, *values) == [None, None, None, None, "a  b", "x", "Mixed Case"]
    assert one(normalise_category, " MORTGAGE ", "", None) == ["mortgage", None, None]


def test_money(one):
    values = {"$33,517.74": "33517.74", "33,517": "33517.00", "$50000": "50000.00",
              "-$1,250.00": "-1250.00", "$-849,596.78": "-849596.78", "0.00": "0.00", " 12 ": "12.00",
              "-": None, "$": None, "": None, None: None, "1_000": "1000.00", "1e3": "1000.00",
              "text": BAD, "1.2.3": BAD, "N/A": BAD, "NaN": BAD, "inf": BAD, "5d": BAD}
    got = one(lambda c: outcome(parse_money(money_digits(clean_string(c)))), *values)
    assert dict(zip(values, got)) == values


def test_numbers(one):
    assert one(lambda c: outcome(parse_integer(c)), "12", "12.0", "1_2", "x", None) == [
        "12", BAD, "12", BAD, None]
    assert one(lambda c: outcome(parse_decimal(c, "decimal(8,4)")), "5.25", ".5", "5.", "1e99") == [
        "5.2500", "0.5000", "5.0000", BAD]
    assert one(lambda c: rounded(c, 2), 2.675, 0.125, -0.125, dtype="double") == [2.68, 0.13, -0.13]


def test_dates(one):
    values = {"2023-05-03": "2023-05-03", "11-Dec-2020": "2020-12-11", "11-dec-2020": "2020-12-11",
              "08/19/2020": "2020-08-19", "19/08/2020": "2020-08-19", "01/05/2022": "2022-01-05",
              "20230503": "2023-05-03", "2023-5-3": "2023-05-03", "May 3, 2023": "2023-05-03",
              "March 7, 2021": "2021-03-07", "3 May 2023": "2023-05-03", "2023/05/03": "2023-05-03",
              "2023-05-03T10:00:00Z": "2023-05-03", "2023-13-01": BAD, "2023-02-30": BAD,
              "someday": BAD, "32/32/2020": BAD, None: None}
    got = one(lambda c: outcome(parse_date(c)), *values)
    assert dict(zip(values, got)) == values


def test_more_dates(one):
    values = {"3/7/21": "2021-03-07", "25/12/75": "2075-12-25", "1-2-76": "1976-01-02", "14-Feb-99": "1999-02-14",
              "29/02/96": "1996-02-29", "29/02/23": BAD, "Sept 3, 2021": "2021-09-03", "3 sept 2021": "2021-09-03",
              "3-Sept-2021": "2021-09-03", "September 3, 2021": "2021-09-03", "08/19/2020 7:05": "2020-08-19",
              "19/08/2020 23:59:59": "2020-08-19", "08/19/2020 24:00": BAD, "08/19/2020 x": BAD, "1/2/3": BAD}
    got = one(lambda c: outcome(parse_date(c)), *values)
    assert dict(zip(values, got)) == values


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_timestamps(spark, one, zone):
    at = "2024-06-30 11:58:00"
    values = {"2024-06-30T03:58:00-08:00": at, "2024-06-30T11:58:00Z": at,
              "2024-06-30T11:58:00+00:00": at, "2024-06-30T11:58:00": at, "2024-06-30 11:58": at,
              "20240630T115800Z": at, "20240630T035800-0800": at, "2024-06-30T03:58:00-0800": at,
              "2024-06-30T03:58-08": at, "2024-06-30": "2024-06-30 00:00:00",
              "2024-06": "2024-06-01 00:00:00", "10:00": BAD, "yesterday": BAD, "2024-02-30": BAD,
              "2024-06-30T25:00:00": BAD, None: None}
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = one(lambda c: F.when(parse_timestamp(c).bad, BAD).otherwise(F.date_format(
            F.to_utc_timestamp(parse_timestamp(c).value, F.current_timezone()),
            "yyyy-MM-dd HH:mm:ss")), *values)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert dict(zip(values, got)) == values


def test_instalments(spark):
    rows = [(D("10000"), D("10"), 12, D("879.16")), (D("200000"), D("4"), 360, D("954.83")),
            (D("38366.86"), D("5.8"), 120, D("422.11")), (D("24315.74"), D("17.82"), 60, D("615.08")),
            (D("32256.80"), D("10.12"), 12, D("2837.69")), (D("12000"), D("0"), 12, D("1000.00")),
            (D("10000"), None, 30, D("333.33")), (D("100"), D("5"), None, None),
            (None, D("5"), 12, None), (D("100"), D("0"), 0, None)]
    df = spark.createDataFrame(rows, "p decimal(18,2), r decimal(8,4), n int, e decimal(18,2)")
    terms = [F.col(c) for c in "prn"]
    got = df.select("e", finance.expected_emi(*terms).alias("g"),
                    finance.strict_emi(*terms).alias("s")).collect()
    assert [r["g"] for r in got] == [r["e"] for r in got]
    assert got[6]["s"] is None and got[0]["s"] == D("879.16")
    odd = spark.createDataFrame([(D("-1"), D("5"), 12), (D("1"), D("-5"), 12), (D("1"), D("5"), 0),
                                 (D("-1"), None, 12)], "p decimal(18,2), r decimal(8,4), n int")
    why = [r[0] for r in odd.select(finance.strict_emi_error(*terms)).collect()]
    assert [w.split(":")[0] if w else w for w in why] == [
        "principal is below zero", "rate is below zero",
        "term is not positive", None]


def test_anomaly(spark):
    rows = [(105.0, 100.0, False), (115.0, 100.0, True), (85.0, 100.0, True), (95.0, 100.0, False),
            (0.0, 100.0, True), (None, 100.0, False), (1.0, None, False), (1.0, 0.0, False),
            (1.0, -5.0, False), (110.0, 100.0, False)]
    df = spark.createDataFrame(rows, "a double, e double, want boolean")
    flag = finance.anomaly_flag(F.col("a"), F.col("e"), 0.10)
    assert df.where(flag != F.col("want")).isEmpty()
    three = finance.anomaly_flag_three_valued(F.col("a"), F.col("e"), 0.10)
    assert df.where(three.isNull()).count() == 2


def test_overdue(spark):
    today = date(2024, 6, 1)
    days = [(None, 20, 30, False), (None, 30, 30, False), (None, 31, 30, True), (None, 730, 30, True),
            (None, -10, 30, False), (None, 45, 60, False), (None, 65, 60, True), (None, 1, 0, True)]
    rows = [(p, date.fromordinal(today.toordinal() - d), g, w) for p, d, g, w in days]
    rows += [(date(2024, 4, 15), date(2024, 4, 1), 30, False),
             (date(2024, 3, 1), date(2024, 4, 1), 30, True)]
    df = spark.createDataFrame(rows, "paid date, due date, grace int, want boolean")
    flag = finance.overdue_flag(F.col("paid"), F.col("due"), F.lit(today), F.col("grace"))
    assert df.where(~flag.eqNullSafe(F.col("want"))).isEmpty()


def test_delinquency_and_balance(spark):
    d = date
    rows = [("closed", None, d(2020, 1, 1), False), ("active", None, d(2020, 1, 1), True),
            ("active", None, d(2024, 5, 20), False), ("active", d(2024, 5, 2), d(2020, 1, 1), False),
            ("active", d(2024, 5, 1), d(2020, 1, 1), True), (None, None, d(2020, 1, 1), True)]
    df = spark.createDataFrame(rows, "s string, paid date, o date, want boolean")
    flag = finance.delinquency_flag(F.col("s"), F.col("paid"), F.col("o"), F.lit(d(2024, 6, 1)), 30)
    assert df.where(~flag.eqNullSafe(F.col("want"))).isEmpty()
    money = spark.createDataFrame([(-1,), (0,), (1,), (None,)], "p int")
    assert [r[0] for r in money.select(finance.balance_type(F.col("p"))).collect()] == [
        "credit_balance", "zero_balance", "debit_balance", "debit_balance"]


def test_borrower(spark):
    rows = [('{"credit_score": 700, "employment": " Salaried ", "annual_income": 60000, '
             '"years_employed": 3.7}',), ('{"credit_score": "712", "years_employed": "3.7"}',),
            ('{"credit_score": "high", "annual_income": "12.5", "employment": ""}',),
            ("{broken",), ("[1]",), (" ",), (None,)]
    df = with_borrower(spark.createDataFrame(rows, "borrower_info string"))
    got = [tuple(r)[1:] for r in df.collect()]
    assert got == [(700, "salaried", D("60000.00"), 3, False), (712, None, None, None, False),
                   (None, None, D("12.50"), None, False), (None, None, None, None, True),
                   (None, None, None, None, True), (None, None, None, None, False),
                   (None, None, None, None, False)]


def test_row_hash(one):
    a, b, c, n = one(lambda v: finance.row_hash([v, F.lit("x")]), "a", "b", "a", None)
    assert a == c and len({a, b, n}) == 3 and len(a) == 32


def test_payment_rules(spark):
    names = ("payment_id, loan_id, amount, payment_timestamp, payment_method_type, "
             "payment_method_last_four, payment_method_bank, metadata_source, metadata_user_agent")
    rows = [("P1", None, "-5", "2020-01-01"), ("P2", "L1", "abc", "2020-01-01"),
            (" ", "L1", "1", "x"), ("P3", "L1", "1", "x"), ("P4", "L1", None, None)]
    df = spark.createDataFrame([r + (None,) * 5 for r in rows],
                               ", ".join(f"{n} string" for n in names.split(", ")))
    got = [r["_rejection_reason"] for r in classify_payments(df).collect()]
    assert got == ["payment_id=P1: amount is below zero: '-5'",
                   "payment_id=P2: amount is no number: 'abc'",
                   "payment_id is missing",
                   "payment_id=P3: payment_timestamp is no instant: 'x'", None]


def test_strip_at_both_ends(one):
    from ledgerlake.functions.text import WHITESPACE, strip

    texts = ["", "a", "!", "~", "\x7f", "a b", "é", "é ", " é", "a\u3000", *[w + "a" for w in WHITESPACE],
             *["a" + w for w in WHITESPACE], *[w + "a b" + w for w in WHITESPACE], *WHITESPACE]
    assert one(strip, *texts) == [t.strip(WHITESPACE) for t in texts]


def test_parsing_leaves_out_unread_columns(spark):
    """The texts of columns that nobody reads are not trimmed, and each text is parsed once."""
    from ledgerlake.functions.cleaning import accepted
    from ledgerlake.settings import PAYMENT_FILE_COLUMNS

    df = spark.createDataFrame([("P1", "L1", "1.50", "2020-01-01", *["x"] * 5)],
                               ", ".join(f"{n} string" for n in PAYMENT_FILE_COLUMNS))
    few = accepted(classify_payments(df), []).select("payment_id", "amount", "payment_timestamp")
    plan = few._jdf.queryExecution().optimizedPlan().toString()
    assert "AS _t_payment_id" in plan and "AS _t_metadata_user_agent" not in plan and "AS _t_loan_id" not in plan
    assert plan.count("AS _amount#") <= 2 and [r["payment_id"] for r in few.collect()] == ["P1"]


def test_unusual_notations_stay_out_of_generated_code(spark, one):
    """All notations give what they gave, but the code for most of them is not generated."""
    got = one(lambda c: parse_timestamp(c).value.cast("string"), "2024-02-03T04:05:06+01:00", "20240203T040506+0130",
              "2024-02-03 04:05", "2024-02-03T04:05:06,25Z", "2024", "2024-13", "soon", None)
    assert got == ["2024-02-03 03:05:06", "2024-02-03 02:35:06", "2024-02-03 04:05:00", "2024-02-03 04:05:06.25",
                   "2024-01-01 00:00:00", None, None, None]
    days = one(lambda c: parse_date(c).value.cast("string"), "03-Feb-2024", "Sept 3, 2024", "13.2.2024", "1/2/76",
               "2024-02-03T23:59:00-05:00", "30-2-2024", None)
    assert days == ["2024-02-03", "2024-09-03", "2024-02-13", "1976-01-02", "2024-02-03", None, None]
    raw = spark.range(3).select(F.col("id").alias("o"), *[F.concat(F.lit("x"), F.col("id").cast("string")).alias(c)
                                                          for c in PAYMENT_FILE_COLUMNS])
    typed = accepted(classify_payments(raw), ["o"])
    code = typed._sc._jvm.PythonSQLUtils.explainString(typed._jdf.queryExecution(), "codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000  # the JVM compiles no larger method
