"""Both files through every layer, twice, and as a stream."""

import uuid
from datetime import date, datetime, timedelta
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

import lending_files as files
from ledgerlake.operators.quality import DQGateError
from ledgerlake.plans import pipeline, star
from ledgerlake.settings import Rules
from ledgerlake.sources.loans import MissingColumns, has_quoted_line_breaks, read_loan_files
from ledgerlake.sources.files import SourceNotFound
from ledgerlake.sources.payments import read_payment_files
from ledgerlake.sources.tables import DuplicateKey, Lake

TS1 = datetime(2024, 3, 1, 2, 0, 0)
TS2 = TS1 + timedelta(days=1)
AS_OF = date(2024, 3, 1)


def new_lake(spark, tmp):
    return Lake(spark, str(tmp / "lake"), env=f"t{uuid.uuid4().hex[:8]}")


@pytest.fixture(scope="module")
def first_run(spark, tmp_path_factory):
    tmp = tmp_path_factory.mktemp("first")
    paths = files.write(tmp / "in")
    lake = new_lake(spark, tmp)
    run = pipeline.run_batch(lake, *paths, TS1, AS_OF, on_breach="record")
    return lake, run, paths


def rows(lake, table, *order):
    return lake.read(table).orderBy(*order).collect()


def test_row_counts_of_every_layer(first_run):
    lake, _, _ = first_run
    expected = {
        "raw_loan": 12, "raw_payment": 12, "raw_audit": 2, "lnd_loan": 6, "lnd_err_loan": 4,
        "lnd_payment": 10, "lnd_err_payment": 2, "stg_loan_payment": 8, "dim_customer": 5,
        "fct_loan": 6, "fct_payment": 7, "mart_delinquency": 3, "mart_payment_anomaly": 2,
        "mart_data_observability": 2,
    }
    assert {t: lake.read(t).count() for t in expected} == expected
    assert 29219 <= lake.read("dim_date").count() <= 29222


def test_counters(first_run):
    _, run, _ = first_run
    assert run.counters == {
        "loan.rows_in": 12, "loan.rows_deduplicated": 10, "loan.rows_rejected": 4,
        "loan.rows_new": 6, "loan.rows_changed": 0, "loan.rows_unchanged": 0,
        "payment.rows_in": 12, "payment.rows_deduplicated": 11, "payment.rows_rejected": 1,
        "payment.rows_clean": 10, "payment.rows_inserted": 10, "payment.rows_split_settlement": 1,
    }


def test_rejects_say_why(first_run):
    lake, _, _ = first_run
    reasons = [r["_rejection_reason"] for r in rows(lake, "lnd_err_loan", "_rejection_reason")]
    assert reasons == [
        "loan_id=LN-3005: term_months is no whole number: 'thirty-six'",
        "loan_id=LN-3006: origination_date is no date: '2022-02-30'",
        "loan_id=LN-3009: interest_rate is no decimal: '14.9x'",
        "loan_id=None: loan_id is missing",
    ]
    line, row = rows(lake, "lnd_err_payment", "_reject_kind")
    assert line["_rejection_reason"].startswith("Line 6: malformed JSON")
    assert line["payment_id"] is None and line["_source_file"] == "payments.jsonl"
    assert row["_rejection_reason"] == "payment_id=PX-9: amount is below zero: '-5.0'"


def test_audit_rows(first_run):
    lake, _, _ = first_run
    loan, pay = rows(lake, "raw_audit", "source_table")
    assert (loan["total_rows_in_file"], loan["distinct_keys"], loan["duplicate_key_count"],
            loan["true_duplicate_count"]) == (12, 9, 2, 2)
    assert (pay["total_rows_in_file"], pay["total_rows_inserted"], pay["distinct_keys"],
            pay["duplicate_key_count"], pay["true_duplicate_count"],
            pay["diff_amount_same_id_count"]) == (13, 12, 10, 2, 1, 1)


def test_gate_records_breaches(first_run, tmp_path):
    lake, run, paths = first_run
    assert len(run.breaches) == 2 and all(b.startswith("volume") for b in run.breaches)
    audit = lake.read("lnd_dq_audit")
    assert audit.where("check_result = 'FAIL'").count() == 2
    assert audit.count() == 13 + 9
    strict = new_lake(lake.spark, tmp_path)
    with pytest.raises(DQGateError, match="volume_acceptance_rate"):
        pipeline.run_batch(strict, *paths, TS1, AS_OF)
    assert strict.read("lnd_dq_audit").count() == 13
    assert strict.read("stg_loan_payment").count() == 0


def instalment(principal, percent, months):
    """Level payment of an annuity, summed period by period instead of in closed form."""
    rate = Fraction(percent) / 1200
    worth = sum(1 / (1 + rate) ** m for m in range(1, months + 1))
    cents = Fraction(principal) / worth * 100
    return Decimal(int(cents + Fraction(1, 2))) / 100


def test_instalments_and_anomalies(first_run):
    lake, _, _ = first_run
    emi = {r["loan_id"]: r["expected_emi"] for r in rows(lake, "fct_loan", "loan_id")}
    terms = {"LN-3001": ("18400", "6.9", 48), "LN-3002": ("7250.5", "3.2", 96), "LN-3003": ("312000", "4.25", 240),
             "LN-3004": ("3600", "0", 18), "LN-3007": ("5400", "2.75", 120), "LN-3008": ("98000.75", "5.1", 180)}
    assert emi == {k: instalment(*v) for k, v in terms.items()}
    odd = {r["payment_id"]: (r["anomaly_reason"], r["deviation_pct"]) for r in rows(lake, "mart_payment_anomaly", "payment_id")}

    def percent(paid, due):
        return round(abs(Decimal(paid) - due) / due * 100, 2)

    assert odd == {"PX-4": ("UNDERPAYMENT", percent("50", emi["LN-3008"])),
                   "PX-5": ("OVERPAYMENT", percent("12000", emi["LN-3003"]))}


def test_delinquency_mart(first_run):
    lake, _, _ = first_run
    got = {r["product_type"]: (r["total_active_loans"], r["delinquent_loans"],
                               r["delinquency_rate_pct"])
           for r in rows(lake, "mart_delinquency", "product_type")}
    assert got == {"auto": (1, 1, Decimal("100.00")), "mortgage": (1, 1, Decimal("100.00")),
                   "personal": (1, 0, Decimal("0.00"))}


def test_allocation_and_utc(first_run):
    lake, _, _ = first_run
    ledger = {r["payment_id"]: r for r in rows(lake, "lnd_payment", "lnd_payment_sk")}
    standing = {k: r["payment_allocation_status"] for k, r in ledger.items()}
    assert {k: v for k, v in standing.items() if v != "allocated"} == {
        "PX-6": "unallocated", "PX-7": "loan_rejected", "PX-8": "unidentified"}
    assert ledger["PX-2"]["payment_timestamp"] == datetime(2022, 4, 6, 6, 30)
    assert ledger["PX-3"]["payment_timestamp"] == datetime(2024, 2, 20, 6, 30)
    keys = [r["lnd_payment_sk"] for r in rows(lake, "lnd_payment", "lnd_payment_sk")]
    assert keys == list(range(1, 11))


def test_observability(first_run):
    lake, _, _ = first_run
    loan, pay = rows(lake, "mart_data_observability", "source_name")
    assert (loan["raw_rows_in_batch"], loan["lnd_rows_rejected"], loan["fct_rows"],
            loan["dq_checks_run"], loan["pipeline_status"]) == (12, 4, 6, 13, "FAIL")
    assert (pay["payments_allocated"], pay["payments_unallocated"], pay["payments_unidentified"],
            pay["dq_checks_run"], pay["freshness_hours"]) == (7, 1, 1, 9, Decimal("0.00"))
    assert loan["payments_allocated"] is None


def test_loan_facts_agree_with_staging(first_run):
    lake, _, _ = first_run
    via_stg = star.fct_loan_from_stg(lake.read("stg_loan_payment"), lake.read("dim_customer"),
                                     lake.read("dim_date"), AS_OF, F.lit(TS1).cast("timestamp"))
    direct = lake.read("fct_loan")
    assert via_stg.exceptAll(direct).isEmpty() and direct.exceptAll(via_stg).isEmpty()


LANDED = ("raw_loan", "raw_payment", "raw_audit", "lnd_loan", "lnd_payment", "lnd_err_loan", "lnd_err_payment",
          "lnd_dq_audit")


def test_batches_again_and_an_empty_one(spark, tmp_path):
    """Batches 1, 2, 1, 2 and an empty one leave what 1, 2 leave."""
    lake = new_lake(spark, tmp_path)
    one = files.write(tmp_path / "a")
    loans = [files.LOANS[0].replace("18400.00", "18900.00"), files.LOANS[2], files.LOANS[10], files.LOANS[5],
             files.LOANS[11].replace("14.9x", "14.9")]
    payments = files.PAYMENTS[:2] + [
        files.payment(11, 3006, "50", "2024-02-25"), '{"cut',
        # Booked before, spelled differently.
        files.payment(2, 3001, "440.100", "2022-04-06T06:30:00Z", "card")]
    two = files.write(tmp_path / "b", loans, payments)

    def run(paths, ts):
        return pipeline.run_batch(lake, *paths, ts, AS_OF, on_breach="record")

    def state():
        # A rerun checks the landed tables as they are by then.
        facts = {"lnd_dq_audit": ("run_id", "check_name")}
        kept = {t: sorted(map(repr, lake.read(t).select(*facts.get(t, "*")).collect())) for t in LANDED}
        health = lake.read("mart_data_observability").drop("_last_updated_ts").collect()
        return kept, sorted(map(repr, health))

    run(one, TS1)
    second = run(two, TS2)
    assert {k: v for k, v in second.counters.items() if k.startswith("loan.")} == {
        "loan.rows_in": 5, "loan.rows_deduplicated": 5, "loan.rows_rejected": 1,
        "loan.rows_new": 1, "loan.rows_changed": 1, "loan.rows_unchanged": 2}
    assert second.counters["payment.rows_inserted"] == 1
    old, new = [r for r in rows(lake, "lnd_loan", "loan_id", "row_effective_from") if r["loan_id"] == "LN-3001"]
    assert (old["is_current_flag"], old["row_effective_to"]) == (False, TS2.date())
    assert (new["is_current_flag"], new["row_effective_to"]) == (True, date(9999, 12, 31))
    assert new["principal_amount"] == Decimal("18900.00")
    want = state()
    counts = {t: len(v) for t, v in want[0].items()}
    assert counts == {"raw_loan": 17, "raw_payment": 16, "raw_audit": 4, "lnd_loan": 8, "lnd_payment": 11,
                      "lnd_err_loan": 5, "lnd_err_payment": 3, "lnd_dq_audit": 44}
    run(one, TS1)
    assert state()[0] == want[0]
    run(two, TS2)
    assert state() == want
    empty = run(files.write(tmp_path / "c", [], []), TS2 + timedelta(days=1))
    assert empty.counters == {"loan.rows_in": 0, "payment.rows_in": 0} and not empty.breaches
    now = state()[0]
    assert all(now[t] == want[0][t] for t in LANDED if t != "raw_audit") and len(now["raw_audit"]) == 6


def test_batches_are_known_from_the_catalog(spark, tmp_path):
    lake = new_lake(spark, tmp_path)
    with pytest.raises(ValueError, match="no batch"):
        pipeline.rebuild(lake, AS_OF)
    run = pipeline.run_batch(lake, *files.write(tmp_path / "a"), TS1, AS_OF, on_breach="record")
    assert lake.batches("raw_loan") == [TS1] == lake.batches("raw_audit") and lake.batches("lnd_dq_audit") == [TS1]
    assert lake.newest_batch("raw_loan", "raw_payment") == TS1 and lake.newest_batch("lnd_dq_audit") == TS1
    report = {r["source_name"]: (float(r["freshness_hours"]), r["is_stale"])
              for r in pipeline.freshness_report(lake, TS2, Rules(stale_after_hours=23.0)).collect()}
    assert report == {"loan": (24.0, True), "payment": (24.0, True)}
    assert not any(r["is_stale"] for r in pipeline.freshness_report(lake, TS2).collect())
    # Checks that were never made count as none.
    spark.sql(f"DROP TABLE {lake.name('lnd_dq_audit')}")
    assert lake.read_if_exists("lnd_dq_audit") is None and lake.read_or_empty("lnd_dq_audit").isEmpty()
    again = pipeline.rebuild(lake, AS_OF)
    assert again.batch_ts == run.batch_ts
    health = {r["source_name"]: (r["dq_checks_run"], r["raw_rows_in_batch"]) for r in rows(lake, "mart_data_observability", "source_name")}
    assert health == {"loan": (0, 12), "payment": (0, 12)}


def test_a_batch_that_comes_again_empty(spark, tmp_path):
    """What an earlier run of the batch rejected and checked goes with its rows."""
    lake = new_lake(spark, tmp_path)
    pipeline.run_batch(lake, *files.write(tmp_path / "a"), TS1, AS_OF, on_breach="record")
    assert lake.read("lnd_err_loan").count() == 4 and lake.read("lnd_err_payment").count() == 2
    pipeline.run_batch(lake, *files.write(tmp_path / "b", [], []), TS1, AS_OF, on_breach="record")
    for table in ("raw_loan", "raw_payment", "lnd_err_loan", "lnd_err_payment", "lnd_dq_audit"):
        assert lake.read(table).isEmpty(), table


def test_stream_equals_batch(spark, tmp_path):
    from ledgerlake.streaming.incremental import stream_loans, stream_payments

    batch = new_lake(spark, tmp_path / "b")
    pipeline.run_batch(batch, *files.write(tmp_path / "in"), TS1, AS_OF, on_breach="record")
    stream = new_lake(spark, tmp_path / "s")
    stream.create()
    (tmp_path / "loans").mkdir()
    (tmp_path / "pays").mkdir()
    loan_path, payment_path = files.write(tmp_path / "in2")
    (tmp_path / "loans" / "loans.csv").write_text(open(loan_path).read())
    (tmp_path / "pays" / "payments.jsonl").write_text(open(payment_path).read())
    stream_loans(stream, str(tmp_path / "loans"), str(tmp_path / "cl"), TS1, AS_OF).awaitTermination()
    stream_payments(stream, str(tmp_path / "pays"), str(tmp_path / "cp"), TS1, AS_OF).awaitTermination()
    for table in ("lnd_loan", "lnd_payment", "lnd_err_loan", "lnd_err_payment"):
        a, b = batch.read(table), stream.read(table)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), table


def test_missing_file_and_columns(spark, tmp_path):
    with pytest.raises(SourceNotFound):
        read_payment_files(spark, str(tmp_path / "absent.jsonl"), TS1)
    with pytest.raises(SourceNotFound):
        read_loan_files(spark, str(tmp_path / "absent.csv"), TS1)
    (tmp_path / "short.csv").write_text("loan_id,customer_id\nL1,C1\n")
    with pytest.raises(MissingColumns, match="principal_amount"):
        read_loan_files(spark, str(tmp_path / "short.csv"), TS1)


def test_csv_quirks(spark, tmp_path):
    path = tmp_path / "loans.csv"
    path.write_text("extra," + files.LOAN_HEADER +
                    'x, L1 ,C1,auto,1,2,12,2020-01-01,web,active,"{""a"":\n ""b""}"\n'
                    "x,L2,C2\n")
    got = {r["loan_id"]: r for r in read_loan_files(spark, str(path), TS1).collect()}
    assert got["L1"]["borrower_info"] == '{"a":\n "b"}'
    assert got["L2"]["status"] is None and set(got) == {"L1", "L2"}
    assert got["L1"]["_source_file"] == "loans.csv" and got["L1"]["_last_updated_ts"] == TS1
    assert has_quoted_line_breaks(spark, str(path))


def test_line_numbers_across_splits(spark, tmp_path):
    """Bad lines are numbered by physical line, with blanks counted and the file cut in blocks."""
    good = files.payment(1, 1, "5.0", "2020-01-01T00:00:00Z")
    lines, bad = [], []
    for i in range(1, 2001):
        if i % 97 == 0:
            lines.append(f"broken {i}")
            bad.append(i)
        else:
            lines.append("" if i % 13 == 0 else good)
    for name in ("a.jsonl", "b.jsonl"):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        out = read_payment_files(spark, str(tmp_path), TS1)
        reasons = out.bad.select("_source_file", "_rejection_reason").collect()
        assert out.good.count() == 2 * sum(1 for x in lines if x == good)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    for name in ("a.jsonl", "b.jsonl"):
        numbers = sorted(int(r["_rejection_reason"].split(":")[0][5:])
                         for r in reasons if r["_source_file"] == name)
        assert numbers == bad


def test_wrong_parents(spark, tmp_path):
    path = tmp_path / "p.jsonl"
    path.write_text("\n".join([
        '{"payment_id": "P1", "amount": 500.00, "payment_method": "", "metadata": 0}',
        '{"payment_id": "P2", "amount": 500, "payment_method": {"type": "ACH", "details": []}}',
        '{"payment_id": "P3", "payment_method": "cash"}',
        '{"payment_id": "P4", "payment_method": {"details": "x"}}',
        '{"payment_id": "P5", "metadata": [1]}',
        "123", "null", "[]", '{"payment_id": " "}']))
    out = read_payment_files(spark, str(path), TS1)
    good = {r["payment_id"]: r for r in out.good.collect()}
    assert set(good) == {"P1", "P2", None}
    assert good["P1"]["amount"] == "500.0" and good["P2"]["amount"] == "500"
    assert good["P1"]["payment_method_type"] is None
    assert out.bad.count() == 6


def test_lines_of_odd_json(spark, tmp_path):
    """The last of repeated keys counts; text behind an object, other quotes and NaN make no line."""
    path = tmp_path / "p.jsonl"
    path.write_text("\n".join([
        '{"payment_id": "P0", "payment_id": "P1", "amount": 1.50, "amount": 12345678901.25}',
        '{"payment_id": "P2", "metadata": {"source": "a"}, "metadata": {"user_agent": "b"}, "unknown": [{"x": {}}]}',
        '  {"payment_id": "P3", "loan_id": 77, "amount": "1e3", "payment_method": {"type": true, "details": null}}  ',
        '{"payment_id": "P4 }, {", "loan_id": "a\\"b\\u00e9"}',
        '{"payment_id": "X1"} trailing', '{"payment_id": "X2"} {"payment_id": "X3"}', '[{"payment_id": "X4"}]',
        "{'payment_id': 'X5'}", '{"payment_id": "X6", "amount": NaN}', '{"payment_id": "X7"', '"text"', '{"payment_id": "X8"}, {"payment_id": "X9"}']))
    out = read_payment_files(spark, str(path), TS1)
    good = {r["payment_id"]: r for r in out.good.collect()}
    assert set(good) == {"P1", "P2", "P3", "P4 }, {"}
    assert good["P1"]["amount"] == "12345678901.25"
    assert (good["P2"]["metadata_source"], good["P2"]["metadata_user_agent"]) == (None, "b")
    assert (good["P3"]["loan_id"], good["P3"]["amount"], good["P3"]["payment_method_type"]) == ("77", "1e3", "true")
    assert good["P4 }, {"]["loan_id"] == 'a"bé'
    reasons = sorted(r["_rejection_reason"] for r in out.bad.collect())
    assert [r.split(":")[0] for r in reasons] == sorted(f"Line {n}" for n in range(5, 13))


def test_table_rules(spark, tmp_path):
    lake = new_lake(spark, tmp_path)
    lake.create()
    lake.create()
    listed = [(r["layer"], r["table_name"]) for r in lake.inventory().collect()]
    assert len(listed) == 16 and ("mart", "mart_delinquency") in listed
    assert lake.exists("raw_loan") and lake.read("raw_loan").isEmpty()
    day = spark.createDataFrame([(20240101, date(2024, 1, 1))], "date_id int, full_date date")
    lake.replace("dim_date", day)
    with pytest.raises(DuplicateKey):
        lake.replace("dim_date", day.union(day))
    nameless = spark.createDataFrame([(None, 5)], "customer_id string, credit_score int")
    with pytest.raises(Exception, match="NULL in required column"):
        lake.replace("dim_customer", nameless)


def test_empty_source(spark, tmp_path):
    lake = new_lake(spark, tmp_path)
    run = pipeline.run_batch(lake, *files.write(tmp_path / "in", [], []), TS1, AS_OF,
                             on_breach="record")
    assert run.counters["loan.rows_in"] == 0 and lake.read("lnd_payment").isEmpty()
