"""Dataset operators against brute force, with hot keys, and the plans they give."""

import bisect
import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks.queries import REGISTRY
from ledgerlake.functions.cleaning import accepted, classify_payments
from ledgerlake.operators import batches, dedup, quality
from ledgerlake.operators.keys import dense_keys, highest_key
from ledgerlake.operators.ledger import allocate, first_not_yet_booked, loan_standing, not_yet_booked, within_reach
from ledgerlake.operators.neighbours import nearest_numbers
from ledgerlake.operators.scd2 import scd2_changes
from ledgerlake.plans import diagnose, landing
from ledgerlake.session import PARSING_SETTINGS, configure_parsing, materialise_columns


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


@pytest.fixture(scope="module")
def hot(spark):
    """3000 rows; one key holds a third, another third has none."""
    random.seed(7)
    rows = [(i, "hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{random.randrange(200)}")
            for i in range(3000)]
    return spark.createDataFrame(rows, "pos int, k string").repartition(6).cache()


def test_dedup_on_hot_keys(hot):
    rows = [(r["pos"], r["k"]) for r in hot.collect()]
    last = {k: p for p, k in sorted(rows) if k is not None}
    got = dedup.last_per_key(hot, "k", F.struct("pos")).collect()
    assert {r["k"]: r["pos"] for r in got if r["k"]} == last
    assert sum(r["k"] is None for r in got) == 1000
    first = {k: p for p, k in sorted(rows, reverse=True)}
    got = dedup.first_per_key(hot, ["k"], F.struct("pos")).collect()
    assert {r["k"]: r["pos"] for r in got} == first and len(got) == len(first)
    flags = dedup.mark_repeats(hot, "k", F.struct("pos"), "again").collect()
    assert len(flags) == 3000
    assert all(r["again"] == (r["k"] is not None and first[r["k"]] != r["pos"]) for r in flags)


def test_marking_repeats_shuffles_its_input_once(spark):
    """The input's own shuffle serves the first positions and the rows; odd keys and positions."""
    rows = [("a", 2, 0.0), ("a", 1, -0.0), ("a", 1, 0.0), ("b", 1, float("nan")), ("b", 1, float("nan")), ("b", 1, None),
            (None, 1, 0.0), (None, 2, 0.0), ("", 1, None), ("", 1, None), ("c", 5, 1.0)]
    df = spark.createDataFrame(rows, "k string, p int, x double").repartition(3, "p")
    marked = dedup.mark_repeats(df, "k", F.struct("p", "x"), "again")
    got = Counter((r["k"], r["p"], str(abs(r["x"]) if r["x"] is not None else None), r["again"]) for r in marked.collect())
    assert got == {("a", 2, "0.0", True): 1, ("a", 1, "0.0", False): 2, ("b", 1, "nan", True): 2, ("b", 1, "None", False): 1,
                   (None, 1, "0.0", False): 1, (None, 2, "0.0", False): 1, ("", 1, "None", False): 2, ("c", 5, "1.0", False): 1}
    df = spark.createDataFrame([("a", 3, 1.0), ("a", 1, 1.0), ("a", 2, 2.0), ("b", 1, 1.0)], "k string, p int, x double")
    once = dedup.first_per_key(df, ["k", "x"], ["p"])
    marked = dedup.mark_repeats(once, "k", F.struct("p"), "again")
    assert sorted((r["k"], r["p"]) for r in marked.collect() if r["again"]) == [("a", 2)]
    assert "ReusedExchange" in marked._jdf.queryExecution().executedPlan().toString()


def test_split_settlements_carry_only_what_they_return(spark, tmp_path):
    """Columns of a payment that the query does not return are not shuffled with it."""
    names = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, "
             "l_discount double, l_linestatus string, l_shipdate timestamp_ntz")
    rows = [(i // 3, i, i % 7, i % 3 + 1, 10.0 * i, 0.1 * (i % 2), "OF"[i % 2], datetime(2000, 1, 1 + i % 9)) for i in range(60)]
    spark.createDataFrame(rows, names).write.parquet(f"{tmp_path}/lineitem.parquet")
    found = REGISTRY["split_settlement_rows"](spark.newSession(), str(tmp_path))
    plan = plan_of(found)
    assert "payment_method" not in plan and "loan_id" not in plan
    assert found.count() > 60 and not found.where("is_split_settlement").isEmpty()


def test_dedup_shrinks_before_the_shuffle(hot):
    plan = plan_of(dedup.first_per_key(hot, ["k"], F.struct("pos")))
    assert "partial_min_by" in plan and "Window" not in plan


def test_dense_keys(spark):
    rows = [(i * 7919 % 5000, i) for i in range(5000)]
    df = spark.createDataFrame(rows, "o int, v int").repartition(5)
    start = highest_key(spark.createDataFrame([(41,), (7,)], "sk bigint"), "sk")
    numbered = dense_keys(df, ["o"], start, "sk")
    got = [r["sk"] for r in numbered.orderBy("o").collect()]
    assert got == list(range(42, 5042))
    empty = dense_keys(df.where("o < 0"), ["o"], highest_key(df.where("o < 0"), "o"), "sk")
    assert empty.count() == 0


def test_dense_keys_write_columns(spark):
    """The slices are a compressed table of columns, not rows as they lie in memory."""
    df = spark.createDataFrame([(i, None) for i in range(50)], "o int, v string")
    numbered = dense_keys(df, ["o"], highest_key(df, "o"), "sk")
    assert "Scan parquet" in plan_of(numbered)
    assert [r["sk"] for r in numbered.orderBy("o").collect()] == list(range(50, 100)) and numbered.columns == ["sk", "o", "v"]


def test_nearest_numbers(spark):
    random.seed(3)
    known = sorted(random.sample(range(10_000), 60)) + [40_000]
    probes = random.sample(range(50_000), 80) + known[:5]
    k = spark.createDataFrame([(n,) for n in known for _ in range(3)], "n bigint")
    p = spark.createDataFrame([(n,) for n in probes], "n bigint")
    for slices in (1, 7, 64, None):
        result = nearest_numbers(p, k, "n", slices)
        got = {r["n"]: (r["closest_below"], r["closest_above"]) for r in result.collect()}
        assert got == {n: (max((x for x in known if x < n), default=None),
                           min((x for x in known if x > n), default=None)) for n in probes}
    plan = plan_of(result)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_nearest_numbers_far_apart(spark):
    """Sparse 64-bit ids, slices without a known number, and numbers that only probes hold."""
    rng = random.Random(11)
    known = sorted({rng.randrange(-1 << 62, 1 << 62) for _ in range(3000)})
    probes = [rng.randrange(-1 << 62, 1 << 62) for _ in range(200)] + known[::500] + list(range(500)) + [
        -1 << 63, (1 << 63) - 1, known[0] - 1, known[-1] + 1]
    k = spark.createDataFrame([(n,) for n in known] + [(None,)], "n bigint").repartition(5)
    p = spark.createDataFrame([(n,) for n in probes] + [(None,)], "n bigint")
    result = nearest_numbers(p, k, "n", 40)
    got = {r["n"]: (r["closest_below"], r["closest_above"]) for r in result.collect()}
    at = {n: (bisect.bisect_left(known, n), bisect.bisect_right(known, n)) for n in probes}
    assert got == {n: (known[a - 1] if a else None, known[b] if b < len(known) else None) for n, (a, b) in at.items()}
    nothing = nearest_numbers(p, k.where("false"), "n").collect()
    assert {(r["closest_below"], r["closest_above"]) for r in nothing} == {(None, None)}
    assert nearest_numbers(p.where("false"), k, "n").collect() == []


def test_ledger_null_keys(spark):
    schema = "payment_id string, amount decimal(18,2), payment_timestamp timestamp"
    t = datetime(2024, 1, 1)
    booked = spark.createDataFrame([("P1", None, t), ("P2", None, None)], schema)
    new = spark.createDataFrame([("P1", None, t), ("P1", None, None), ("P2", None, None),
                                 ("P3", None, t)], schema)
    got = {(r[0], r[2]) for r in not_yet_booked(new, booked).collect()}
    assert got == {("P1", None), ("P3", t)}


def test_first_not_yet_booked(spark):
    """As deduplication and then the ledger's keys, with empty keys and repeats, in one shuffle."""
    random.seed(5)
    t = datetime(2024, 1, 1)

    def keys():
        return random.choice(["P1", "P2", "P3", None]), random.choice([1, 2, None]), random.choice([t, None])

    rows = spark.createDataFrame([(*keys(), i, f"v{i}") for i in range(60)] + [("P9", 5, t, 60, None)] * 2,
                                 "payment_id string, amount int, payment_timestamp timestamp, o int, v string")
    rows = rows.withColumn("amount", F.col("amount").cast("decimal(18,2)")).repartition(4)
    booked = spark.createDataFrame([keys() for _ in range(8)], "payment_id string, amount int, payment_timestamp timestamp")
    booked = booked.withColumns({"amount": F.col("amount").cast("decimal(18,2)"), "sk": F.lit(1)})
    got = first_not_yet_booked(rows, booked, ["o"])
    assert plan_of(got).count("Exchange hashpartitioning") == 1
    first = dedup.first_per_key(rows, ["payment_id", "amount", "payment_timestamp"], ["o"])
    wanted = not_yet_booked(first, booked)
    assert sorted(map(str, got.collect())) == sorted(map(str, wanted.collect())) and got.schema == wanted.schema
    assert first_not_yet_booked(rows.where("false"), booked, ["o"]).count() == 0


def test_batch_meets_the_ledger_where_it_is_deduplicated(spark):
    """With nothing written down, the batch is parsed and shuffled once for its new rows."""
    from ledgerlake.settings import PAYMENT_FILE_COLUMNS

    raw = spark.createDataFrame([(f"P{i}", "L1", "1.50", "2020-01-01", *["x"] * 5, "f", datetime(2024, 1, 1), i) for i in (1, 2, 2)],
                                ", ".join(f"{n} string" for n in [*PAYMENT_FILE_COLUMNS, "_source_file"]) + ", _last_updated_ts timestamp, o int")
    ledger = spark.createDataFrame([("P1", datetime(2020, 1, 1))], "payment_id string, payment_timestamp timestamp").withColumn(
        "amount", F.lit("1.50").cast("decimal(18,2)"))
    new = landing.clean_payment_batch(raw, ledger, datetime(2024, 1, 1), ["o"]).new_rows
    assert plan_of(new).count("Exchange hashpartitioning") == 1
    assert [r["payment_id"] for r in new.collect()] == ["P2"]


def test_ledger_within_reach(spark, tmp_path):
    """Row groups of other times are skipped; NULL instants and the edges stay."""
    schema = "payment_id string, amount decimal(18,2), payment_timestamp timestamp"
    rows = [(f"P{i}", None, datetime(2024, 1 + i // 28, 1 + i % 28)) for i in range(300)] + [("N", None, None)]
    spark.createDataFrame(rows, schema).coalesce(1).sortWithinPartitions("payment_timestamp").write.parquet(str(tmp_path / "ledger"))
    ledger = spark.read.parquet(str(tmp_path / "ledger"))
    new = spark.createDataFrame([("P5", None, rows[5][2]), ("P9", None, rows[8][2]), ("N", None, None), ("P4", None, rows[4][2])], schema)
    reached = within_reach(ledger, new)
    assert {r[0] for r in reached.collect()} == {"P4", "P5", "P6", "P7", "P8", "N"}
    assert {r[0] for r in not_yet_booked(new, reached).collect()} == {"P9"} == {r[0] for r in not_yet_booked(new, ledger).collect()}
    assert "PushedFilters" in plan_of(reached)
    assert [r[0] for r in within_reach(ledger, new.where("false")).collect()] == ["N"]


def test_allocation(spark):
    current = spark.createDataFrame([("L1", True), ("L2", False)], "loan_id string, is_current_flag boolean")
    raw = spark.createDataFrame([("L1",), ("L2",), ("L3",), (None,)], "loan_id string")
    pays = spark.createDataFrame([("L1",), ("L2",), ("L3",), ("L9",), (None,)], "loan_id string")
    got = {r[0]: r[1] for r in allocate(pays, loan_standing(current, raw)).collect()}
    assert got == {"L1": "allocated", "L2": "loan_rejected", "L3": "loan_rejected",
                   "L9": "unallocated", None: "unidentified"}


def test_scd2_with_duplicate_current_rows(spark):
    schema = "loan_id string, _row_hash string, is_current_flag boolean"
    history = spark.createDataFrame([("A", "1", True), ("A", "1", True), ("B", "2", True),
                                     ("C", "3", False)], schema)
    incoming = spark.createDataFrame([("A", "1"), ("B", "9"), ("C", "3")],
                                     "loan_id string, _row_hash string")
    got = {r["loan_id"]: r["_action"] for r in scd2_changes(history, incoming).collect()}
    assert got == {"A": "unchanged", "B": "changed", "C": "new"}


def test_latest_batch_and_freshness(spark):
    rows = [(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2)), (3, datetime(2024, 1, 2))]
    df = spark.createDataFrame(rows, "i int, _last_updated_ts timestamp")
    assert {r["i"] for r in batches.latest_batch(df).collect()} == {2, 3}
    assert batches.latest_batch(df.where("i > 9")).isEmpty()
    now = F.lit(datetime(2024, 1, 3, 6)).cast("timestamp")
    fresh = batches.freshness(df, now, "s").first()
    assert float(fresh["freshness_hours"]) == 30.0 and fresh["is_stale"]
    assert batches.freshness(df.where("i > 9"), now, "s").first()["freshness_hours"] is None


def test_gate_and_boundaries(spark):
    loans = spark.createDataFrame(
        [(f"L{i}", None if i == 0 else "C", "auto", 1, 1, 1, "d", "active", "web", True)
         for i in range(10)],
        "loan_id string, customer_id string, product_type string, principal_amount int, "
        "interest_rate int, term_months int, origination_date string, status string, "
        "origination_channel string, is_current_flag boolean")
    none = loans.where("loan_id is null")
    audit = quality.dq_loan(loans, none, loans, "r", "t", F.current_timestamp())
    got = {r["check_name"]: r for r in audit.collect()}
    assert got["completeness_customer_id"]["metric_value"] == 0.1
    assert not got["completeness_customer_id"]["breach_flag"]
    assert got["validity_origination_channel"]["check_result"] == "WARN"
    assert quality.enforce(audit) == []
    twice = quality.dq_loan(loans.union(loans), none, loans, "r", "t", F.current_timestamp())
    with pytest.raises(quality.DQGateError, match="loan_ids held twice: 10"):
        quality.enforce(twice)
    assert quality.enforce(twice, "record")
    empty = quality.dq_loan(none, none, none, "r", "t", F.current_timestamp())
    assert empty.count() == 5


def test_dedup_by_named_order_shuffles_nothing_twice(spark):
    random.seed(11)
    rows = [(i, random.choice(["a", "b", None]), float(random.choice(["-0.0", "1.5"])), random.choice([None, 1, 2]))
            for i in range(400)]
    df = spark.createDataFrame(rows, "pos int, k string, x double, m int").repartition(5)
    first, last = {}, {}
    for row in rows:
        first.setdefault((row[1], row[2], row[3]), row)
        last[row[1] if row[1] is not None else row[0]] = row
    got = dedup.first_per_key(df, ["k", "x", "m"], ["pos"])
    assert got.columns == df.columns and got.dtypes == df.dtypes
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, first.values()))
    assert sorted(map(str, map(tuple, dedup.last_per_key(df, "k", ["pos"]).collect()))) == sorted(map(str, last.values()))
    # The key columns are not part of the row that is kept beside them, the order not twice.
    struct = next(line for line in plan_of(dedup.first_per_key(df, ["k", "m"], ["pos"])).splitlines() if "partial_min" in line)
    assert struct.split("partial_min")[1].count("pos#") == 1 and "k#" not in struct.split("partial_min")[1]


def test_clean_payments_take_one_deduplication(spark):
    names = ["payment_id", "loan_id", "amount", "payment_timestamp", "payment_method_type", "payment_method_last_four",
             "payment_method_bank", "metadata_source", "metadata_user_agent"]
    keyed = [("P1", "1.5", "2024-01-01"), ("P1", "1.50", "2024-01-01T00:00:00Z"), ("P1", "1.5", "2024-01-01"),
             ("P2", "abc", "2024-01-01"), ("P2", "abc", "2024-01-01"), ("P3", None, None), (None, "1", "2024-01-01")]
    rows = [(p, f"L{i}", a, t, "ach", None, None, None, None, "f", datetime(2024, 1, 2), i)
            for i, (p, a, t) in reversed(list(enumerate(keyed)))]
    raw = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names)
                                + ", _source_file string, _last_updated_ts timestamp, _pos int")
    ledger = spark.createDataFrame([], "payment_id string, amount decimal(18,2), payment_timestamp timestamp")
    batch = landing.clean_payment_batch(raw, ledger, datetime(2024, 1, 2), ["_pos"])
    written = landing.clean_payment_batch(raw, ledger, datetime(2024, 1, 2), ["_pos"], lambda df: df.cache())
    assert sorted(r["loan_id"] for r in batch.clean.collect()) == ["L0", "L5"]
    assert sorted(r["loan_id"] for r in written.clean.collect()) == ["L0", "L5"]
    assert sorted(r["loan_id"] for r in batch.errors.collect()) == ["L3", "L6"]
    assert plan_of(batch.clean.select("*")).count("Exchange hashpartitioning") == 1


def test_nearest_ids_evaluates_payments_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def mark(text):
        seen.add(1)
        return text

    marked = F.udf(mark, "string").asNondeterministic()
    payments = spark.createDataFrame([(f"L{n}",) for n in (5, 5, 7, 20)], "loan_id string").select(
        marked("loan_id").alias("loan_id"))
    loans = spark.createDataFrame([("L3",), ("L7",), ("L9",)], "loan_id string")
    got = {r["orphan_id"]: (r["closest_below"], r["closest_above"]) for r in diagnose.nearest_ids(payments, loans).collect()}
    assert got == {"L5": (3, 7), "L20": (9, None)} and seen.value == 4


def _raw_payments(spark, rows):
    from ledgerlake.settings import PAYMENT_FILE_COLUMNS

    schema = ", ".join(f"{n} string" for n in [*PAYMENT_FILE_COLUMNS, "_source_file"]) + ", _last_updated_ts timestamp, o int"
    return spark.createDataFrame([(p, "L1", a, t, *["x"] * 5, "f", datetime(2024, 1, 1), i) for i, (p, a, t) in enumerate(rows)], schema)


def test_only_named_columns_are_written(spark):
    """A column that isn't named is not even computed."""
    df = spark.createDataFrame([(1, "p", "q")], "a int, p string, q string").select(
        "a", F.raise_error(F.lit("computed")).cast("int").alias("b"),
        F.struct("p", F.concat("q", F.raise_error(F.lit("computed")).cast("string")).alias("q")).alias("s"))
    got = materialise_columns(df, "cut", ["a", "s.p"])
    assert got.schema.simpleString() == df.schema.simpleString()
    assert [(r["a"], r["b"], tuple(r["s"])) for r in got.collect()] == [(1, None, ("p", None))]


def test_counters_of_narrow_judged_rows(spark):
    """The counters are the same when only what they read was written; then no row is carried through the
    first deduplication."""
    raw = _raw_payments(spark, [("P1", "1.5", "2024-01-01"), ("P1", "1.50", "2024-01-01T00:00:00Z"), ("P1", "1.5", "2024-01-01"),
                                ("P2", "abc", "2024-01-01"), ("P3", None, None), (None, "1", "2024-01-01"), ("P4", "2", "2024-01-02")])
    ledger = spark.createDataFrame([("P4", datetime(2024, 1, 2))], "payment_id string, payment_timestamp timestamp").withColumn(
        "amount", F.lit("2").cast("decimal(18,2)"))
    plans = []

    def keep(df):
        named = ["payment_id", "_rejection_reason", "_clean.payment_id", "_clean.amount", "_clean.payment_timestamp"]
        plans.append(plan_of(df.select("payment_id", "_rejection_reason", "_clean.payment_timestamp")))
        return materialise_columns(df, "judged", named)

    def counters(**kept):
        batch = landing.clean_payment_batch(raw, ledger, datetime(2024, 1, 2), ["o"], **kept)
        return {r["counter"]: r["n"] for r in landing.payment_counters(raw, batch).collect()}

    assert counters(keep=keep) == counters() == {
        "rows_in": 7, "rows_deduplicated": 6, "rows_rejected": 2, "rows_clean": 3, "rows_inserted": 2, "rows_split_settlement": 1}
    assert "min(" not in plans[0]


def test_payment_counts_read_what_a_family_needs(spark):
    ledger = spark.createDataFrame([("allocated",), ("allocated",), ("unidentified",)], "payment_allocation_status string")
    row = quality.payment_counts(ledger, ("allocation",)).first().asDict()
    assert row == {"all_rows": 3, "allocated": 2, "unallocated": 0, "loan_rejected": 0, "unidentified": 1}


def test_accepted_rows_need_no_message(spark):
    """Neither the messages nor the raw texts they show are made for rows that break no rule."""
    raw = _raw_payments(spark, [("P1", "1.5", "2024-01-01"), ("P2", "x", "2024-01-01"), (None, "1", None), ("P3", "-1", None)])
    judged = classify_payments(raw)
    assert [r["payment_id"] for r in accepted(judged, []).collect()] == ["P1"]
    assert "payment_id=" not in plan_of(accepted(judged, []))
    assert [r["_rejection_reason"] for r in judged.orderBy("o").collect()] == [
        None, "payment_id=P2: amount is no number: 'x'", "payment_id is missing", "payment_id=P3: amount is below zero: '-1'"]


def test_shuffles_begin_with_many_partitions(spark):
    """Few partitions asked for do not make large ones; more than that are left as they are."""
    changed = [*PARSING_SETTINGS, "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"]
    before = {k: spark.conf.get(k, None) for k in changed}
    try:
        for asked, given in (("4", "200"), ("500", "500")):
            spark.conf.set("spark.sql.shuffle.partitions", asked)
            configure_parsing(spark)
            assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == given
    finally:
        for k, value in before.items():
            spark.conf.unset(k) if value is None else spark.conf.set(k, value)
