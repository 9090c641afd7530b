"""The loan history on disk against a plain merge, and what a batch leaves untouched."""

import random
import uuid
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.scd2 import scd2_changes, scd2_merge
from ledgerlake.plans import pipeline, star
from ledgerlake.schemas import LND_LOAN, conform
from ledgerlake.session import materialise
from ledgerlake.sources.history import CLOSED, History
from ledgerlake.sources.tables import Lake

import lending_files as files

START = datetime(2024, 1, 1, 2)


def incoming(spark, rows):
    return conform(spark.createDataFrame(
        [(k, s, f"{k}-{s}") for k, s in rows], "loan_id string, status string, _row_hash string"), LND_LOAN).select(
        *[c for c in LND_LOAN.names if not c.startswith("row_effective") and c != "is_current_flag"])


@pytest.fixture
def history(spark, tmp_path):
    space = f"h{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {space} LOCATION '{tmp_path}/db'")
    made = History(spark, f"{space}.loans", str(tmp_path / "loans"), LND_LOAN, buckets=4)
    made.create()
    made.create()
    return made


def land(history, rows, at):
    new = incoming(history.spark, rows)
    changes = materialise(scd2_changes(history.current(new), new), "changes")
    history.apply(changes, at)


def table(df):
    return sorted(map(repr, df.select(*LND_LOAN.names).collect()))


def test_batches_equal_a_plain_merge(spark, history):
    rng = random.Random(2)
    plain = spark.createDataFrame([], LND_LOAN)
    for n in range(4):
        rows = {f"L{rng.randrange(60)}": rng.choice("ab") for _ in range(25)}.items()
        at = START + timedelta(days=n)
        land(history, rows, at)
        plain = materialise(scd2_merge(plain, incoming(spark, rows), at), "plain")
        assert table(spark.table(history.name)) == table(plain)
        assert table(history.current()) == table(plain.where("is_current_flag"))
    before = table(spark.table(history.name))
    assert sum(s.bucket == CLOSED for s in history.segments()) > 1
    history.compact()
    assert sum(s.bucket == CLOSED for s in history.segments()) == 1 and table(spark.table(history.name)) == before
    gone = history.vacuum()
    assert gone and not history.vacuum() and table(spark.table(history.name)) == before


def test_untouched_rows_keep_their_files(spark, history, tmp_path):
    keys = [f"L{i}" for i in range(40)]
    land(history, [(k, "a") for k in keys], START)
    files_of = {s: sorted(p.name for p in (tmp_path / "loans" / s.path).iterdir()) for s in history.segments()}
    assert len(files_of) == 4
    bucket = {r[0]: r[1] for r in history.current().select("loan_id", history.bucket_of(F.col("loan_id"))).collect()}
    land(history, [(keys[0], "b")], START + timedelta(days=1))
    now = history.segments()
    kept = [s for s in files_of if s in now]
    assert {s.bucket for s in kept} == {0, 1, 2, 3} - {bucket[keys[0]]}
    assert all(sorted(p.name for p in (tmp_path / "loans" / s.path).iterdir()) == files_of[s] for s in kept)
    # A new key is written beside its bucket's rows; an unchanged batch writes nothing.
    land(history, [("N1", "a")], START + timedelta(days=2))
    assert [s for s in now if s not in history.segments()] == []
    last = history.segments()
    land(history, [("N1", "a"), (keys[5], "a")], START + timedelta(days=3))
    assert history.segments() == last


def test_many_small_batches_are_drawn_together(history):
    for n in range(12):
        land(history, [(f"N{n}-{i}", "a") for i in range(6)], START + timedelta(days=n))
    per_bucket = {}
    for s in history.segments():
        per_bucket[s.bucket] = per_bucket.get(s.bucket, 0) + 1
    assert max(per_bucket.values()) <= 8 and history.current().count() == 72


def test_readers_see_a_batch_whole_or_not_at_all(spark, history, monkeypatch):
    land(history, [("A", "a"), ("B", "a")], START)
    before = table(spark.table(history.name))
    monkeypatch.setattr(History, "_publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        land(history, [("A", "b"), ("C", "a")], START + timedelta(days=1))
    monkeypatch.undo()
    assert table(spark.table(history.name)) == before
    assert history.vacuum()  # what the failed batch left
    land(history, [("A", "b"), ("C", "a")], START + timedelta(days=1))
    got = [(r["loan_id"], r["status"], r["is_current_flag"], r["row_effective_to"]) for r in
           spark.table(history.name).orderBy("loan_id", "row_effective_from").collect()]
    assert got == [("A", "a", False, date(2024, 1, 2)), ("A", "b", True, date(9999, 12, 31)),
                   ("B", "a", True, date(9999, 12, 31)), ("C", "a", True, date(9999, 12, 31))]


def test_star_is_published_together(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path / "lake"), env=f"t{uuid.uuid4().hex[:8]}")
    paths = files.write(tmp_path / "a")
    pipeline.run_batch(lake, *paths, START, date(2024, 1, 1), on_breach="record")
    tables = ("stg_loan_payment", "dim_customer", "fct_loan", "fct_payment", "mart_delinquency", "mart_data_observability")
    before = {t: sorted(map(repr, lake.read(t).collect())) for t in tables}
    assert all(before.values())
    monkeypatch.setattr(star, "fct_payment", lambda *a: (_ for _ in ()).throw(RuntimeError("second fact fails")))
    more = files.write(tmp_path / "b", [files.loan(3100, 90, "auto", "900", "5", 12, "2023-01-01", "web", "active")], [])
    with pytest.raises(RuntimeError, match="second fact"):
        pipeline.run_batch(lake, *more, START + timedelta(days=1), date(2024, 1, 2), on_breach="record")
    assert {t: sorted(map(repr, lake.read(t).collect())) for t in tables} == before
    monkeypatch.undo()
    run = pipeline.Run(lake, START + timedelta(days=1), date(2024, 1, 2))
    for _ in range(2):
        pipeline.publish(run)
    assert lake.read("fct_loan").where("loan_id = 'LN-3100'").count() == 1
    # The published version and the one before it stay; older and half-written ones are gone.
    assert len(list((tmp_path / "lake" / lake.namespace("fct") / "fct_loan").glob("v=*"))) == 2
