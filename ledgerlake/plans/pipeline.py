"""One batch from source files to marts: the ordered steps, each reading and writing tables."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.audit import audit_row, loan_duplicates, payment_duplicates
from ..operators.batches import with_age
from ..operators.ledger import loan_standing
from ..operators.scd2 import not_superseded, scd2_changes
from ..operators.quality import dq_loan, dq_payment, enforce
from ..session import configure_parsing, materialise
from ..settings import DEFAULT_RULES, Rules
from ..sources.calendar import date_bounds, dim_date
from ..sources.loans import read_loan_files
from ..sources.payments import PaymentLines, read_payment_files
from ..sources.tables import Lake, Release
from . import landing, marts, star

STAMP = "_last_updated_ts"
# Kinds of payment rejects: a line that gave no row, and a row that breaks a rule.
LINE, ROW = "line", "row"


@dataclass
class Run:
    """One batch: where it writes, its instant, the day it reports on, and what it counted."""

    lake: Lake
    batch_ts: datetime
    as_of: date
    rules: Rules = DEFAULT_RULES
    on_breach: str = "raise"
    scope: str = "batch"
    counters: dict[str, int] = field(default_factory=dict)
    breaches: list[str] = field(default_factory=list)
    _observations: list[tuple[str, Observation]] = field(default_factory=list)

    @property
    def now(self) -> Column:
        return F.lit(self.batch_ts).cast("timestamp")

    def scoped(self, df: DataFrame, ts: str = STAMP) -> DataFrame:
        """This batch's rows, or all batches' with `scope="all"`."""
        return df if self.scope == "all" else df.where(F.col(ts) == self.now)

    def observed(self, source: str, df: DataFrame, *counts: Column) -> DataFrame:
        """`df`, whose counts are taken over once an action has run over it."""
        observation = Observation()
        self._observations.append((source, observation))
        return df.observe(observation, *counts)

    def take_counts(self) -> None:
        """What the writes so far have counted along the way."""
        for source, observation in self._observations:
            self.counters |= {f"{source}.{name}": n for name, n in observation.get.items()}
        self._observations = []


def ingest_loans(run: Run, rows: DataFrame, source_file: str) -> None:
    """Raw loan rows into raw_loan, with their audit row."""
    lake = run.lake
    lake.append_batch("raw_loan", rows, run.batch_ts)
    batch = lake.read("raw_loan").where(F.col(STAMP) == run.now)
    table = lake.name("raw_loan")
    lake.append_batch("raw_audit", audit_row(loan_duplicates(batch), run.batch_ts, source_file, table),
                      run.batch_ts, table)


def ingest_payments(run: Run, lines: PaymentLines, source_file: str) -> None:
    """Raw payment rows into raw_payment and unusable lines into lnd_err_payment."""
    lake = run.lake
    lake.append_batch("raw_payment", lines.good, run.batch_ts)
    lake.append_batch("lnd_err_payment", lines.bad, run.batch_ts, LINE)
    batch = lake.read("raw_payment").where(F.col(STAMP) == run.now)
    bad = lake.read("lnd_err_payment").where((F.col(STAMP) == run.now) & (F.col("_reject_kind") == LINE))
    unusable = bad.agg(F.count("*")).scalar()
    in_file = F.coalesce(F.col("total_rows"), F.lit(0)) + unusable
    table = lake.name("raw_payment")
    lake.append_batch("raw_audit", audit_row(payment_duplicates(batch), run.batch_ts, source_file, table, in_file),
                      run.batch_ts, table)


def land_loans(run: Run) -> None:
    """The run's raw batch into lnd_loan, rejects into lnd_err_loan. An empty batch changes
    nothing; in an older batch, loans whose current row was opened later stay as they are."""
    lake = run.lake
    batch = lake.read("raw_loan").where(F.col(STAMP) == run.now)
    if batch.isEmpty():
        run.counters["loan.rows_in"] = 0
        lake.clear_batch("lnd_err_loan", run.batch_ts)
        return
    seen = run.observed("loan", batch, F.count(F.lit(1)).alias("rows_in"))
    cleaned = landing.clean_loan_batch(seen, run.batch_ts, keep=lambda df: materialise(
        run.observed("loan", df, *landing.judged_counts()), "loans"))
    history = lake.history("lnd_loan")
    current = history.current(cleaned.incoming)
    changes = scd2_changes(current, not_superseded(current, cleaned.incoming, run.batch_ts))
    changes = materialise(run.observed("loan", changes, *landing.fate_counts()), "loan-changes")
    run.take_counts()
    lake.append_batch("lnd_err_loan", cleaned.errors, run.batch_ts)
    history.apply(changes, run.batch_ts, run.rules)


def land_payments(run: Run) -> None:
    """The run's raw batch into the ledger, rejects beside the batch's unusable lines. An empty
    batch changes nothing."""
    lake = run.lake
    batch = lake.read("raw_payment").where(F.col(STAMP) == run.now)
    if batch.isEmpty():
        run.counters["payment.rows_in"] = 0
        lake.clear_batch("lnd_err_payment", run.batch_ts, ROW)
        return
    ledger = lake.read("lnd_payment")

    def kept(name: str, *counts: Column):
        return lambda df: materialise(run.observed("payment", df, *counts), name)

    seen = run.observed("payment", batch, F.count(F.lit(1)).alias("rows_in"))
    cleaned = landing.clean_payment_batch(
        seen, ledger, run.batch_ts, keep=kept("payments", *landing.judged_counts()),
        keep_clean=kept("clean-payments", F.count(F.lit(1)).alias("rows_clean")),
        keep_new=kept("new-payments", F.count(F.lit(1)).alias("rows_inserted")))
    run.take_counts()
    # Ids are counted apart: distinct ones need a shuffle of their own.
    run.counters["payment.rows_split_settlement"] = landing.split_settlement_count(cleaned.judged).head()[0]
    lake.append_batch("lnd_err_payment", cleaned.errors, run.batch_ts, ROW)
    ids = materialise(cleaned.new_rows.select("loan_id").distinct(), "batch-loans")
    standing = loan_standing(lake.read("lnd_loan").join(ids, "loan_id", "left_semi"),
                             lake.read("raw_loan").join(ids, "loan_id", "left_semi"))
    lake.append("lnd_payment", landing.book_payments(cleaned.new_rows, ledger, standing))


def check_loans(run: Run) -> None:
    """Write the loan checks, then stop the run on a breach. Nothing to check without rows."""
    lake, run_id = run.lake, f"dq_lnd_loan_{run.batch_ts:%Y-%m-%d}"
    if run.counters["loan.rows_in"] == 0:
        lake.clear_batch("lnd_dq_audit", run.batch_ts, lake.name("lnd_loan"))
        return
    audit = materialise(dq_loan(
        lake.read("lnd_loan"), run.scoped(lake.read_or_empty("lnd_err_loan")),
        run.scoped(lake.read("raw_loan")), run_id, lake.name("lnd_loan"), run.now, run.rules), "dq")
    lake.append_batch("lnd_dq_audit", audit, run.batch_ts, lake.name("lnd_loan"))
    run.breaches += enforce(audit, run.on_breach)


def check_payments(run: Run) -> None:
    """Write the payment checks, then stop the run on a breach. Nothing to check without lines."""
    lake, run_id = run.lake, f"dq_lnd_payment_{run.batch_ts:%Y-%m-%d}"
    if run.counters["payment.rows_in"] == 0 and lake.read("lnd_err_payment").where(F.col(STAMP) == run.now).isEmpty():
        lake.clear_batch("lnd_dq_audit", run.batch_ts, lake.name("lnd_payment"))
        return
    lines = run.scoped(lake.read("raw_audit"), "batch_ts").where(
        F.col("source_table") == lake.name("raw_payment"))
    audit = materialise(dq_payment(
        lake.read("lnd_payment"), run.scoped(lake.read_or_empty("lnd_err_payment")),
        lines.agg(F.coalesce(F.sum("total_rows_in_file"), F.lit(0))), run_id, lake.name("lnd_payment"), run.now,
        run.rules), "dq")
    lake.append_batch("lnd_dq_audit", audit, run.batch_ts, lake.name("lnd_payment"))
    run.breaches += enforce(audit, run.on_breach)


def build_star(run: Run, release: Release) -> dict[str, DataFrame]:
    """Staging, dimensions and facts, each a full refresh into `release`; what it staged."""
    lake = run.lake
    loans, payments = lake.read("lnd_loan"), lake.read("lnd_payment")
    made: dict[str, DataFrame] = {}

    def stage(table: str, df: DataFrame) -> None:
        made[table] = release.stage(table, df)

    stage("stg_loan_payment", star.stg_loan_payment(loans, payments, run.as_of, run.now, run.rules))
    stage("dim_customer", star.dim_customer(loans, run.now))
    stage("dim_date", dim_date(lake.spark, *date_bounds(run.as_of)))
    stage("fct_loan", star.fct_loan(loans, payments, made["dim_customer"], made["dim_date"], run.as_of, run.now, run.rules))
    stage("fct_payment", star.fct_payment(made["stg_loan_payment"], made["dim_date"], run.now))
    return made


def build_marts(run: Run, release: Release, facts: dict[str, DataFrame]) -> None:
    """The marts of `facts`, into the same release."""
    lake = run.lake
    release.stage("mart_delinquency", marts.mart_delinquency(facts["fct_loan"], run.as_of, run.now))
    release.stage("mart_payment_anomaly", marts.mart_payment_anomaly(facts["fct_payment"], run.now, run.rules))
    audit, checks = lake.read_or_empty("raw_audit"), run.scoped(lake.read_or_empty("lnd_dq_audit"), "checked_at")

    def health(name: str, ledger: DataFrame | None) -> marts.SourceHealth:
        raw, landed = f"raw_{name}", f"lnd_{name}"
        return marts.SourceHealth(
            name, run.scoped(lake.read(raw)), run.scoped(lake.read_or_empty(f"lnd_err_{name}")),
            facts[f"fct_{name}"], audit.where(F.col("source_table") == lake.name(raw)),
            checks.where(F.col("table_name") == lake.name(landed)), ledger)

    release.stage("mart_data_observability", marts.mart_observability(
        [health("loan", None), health("payment", lake.read("lnd_payment"))], run.as_of, run.now))


def publish(run: Run) -> None:
    """Star and marts are built beside the published ones and become visible together."""
    release = run.lake.release()
    build_marts(run, release, build_star(run, release))
    release.publish()


def rebuild(lake: Lake, as_of: date, rules: Rules = DEFAULT_RULES, scope: str = "batch") -> Run:
    """Star and marts anew from the landed tables, reporting on the newest batch. The catalog's
    partition list says which one that is; tables of a part that hasn't run yet count as empty."""
    configure_parsing(lake.spark)
    newest = lake.newest_batch("raw_loan", "raw_payment")
    if newest is None:
        raise ValueError("no batch has been ingested yet")
    run = Run(lake, newest, as_of, rules, scope=scope)
    publish(run)
    return run


def freshness_report(lake: Lake, at: datetime, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """source_name, latest_batch_ts, freshness_hours and is_stale per source at an instant, by the
    rules' limit. Batches are listed in the catalog; no data file is read."""
    rows = [(name, lake.newest_batch(f"raw_{name}")) for name in ("loan", "payment")]
    newest = lake.spark.createDataFrame(rows, "source_name string, latest_batch_ts timestamp")
    return with_age(newest, F.lit(at).cast("timestamp"), rules.stale_after_hours)


def run_batch(lake: Lake, loan_path: str, payment_path: str, batch_ts: datetime, as_of: date,
              rules: Rules = DEFAULT_RULES, on_breach: str = "raise", scope: str = "batch",
              multi_line: bool = True) -> Run:
    """All steps in order. A breached gate stops before staging unless `on_breach="record"`."""
    configure_parsing(lake.spark)
    run = Run(lake, batch_ts, as_of, rules, on_breach, scope)
    lake.create()
    ingest_loans(run, read_loan_files(lake.spark, loan_path, batch_ts, multi_line),
                 loan_path.rsplit("/", 1)[-1])
    ingest_payments(run, read_payment_files(lake.spark, payment_path, batch_ts),
                    payment_path.rsplit("/", 1)[-1])
    for step in (land_loans, land_payments, check_loans, check_payments, publish):
        step(run)
    return run
