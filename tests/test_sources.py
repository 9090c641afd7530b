"""Quoted records over byte ranges against Python's own CSV reader."""

import csv
import io
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import lending_files as files
from ledgerlake.schemas import POSITION
from ledgerlake.sources.files import with_lineage
from ledgerlake.sources.loans import loan_rows, read_loan_files, text_lines
from ledgerlake.sources.records import whole_records

TS = datetime(2024, 3, 1, 2)


@pytest.fixture
def small_ranges(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield to
    for key, value in old.items():
        spark.conf.set(key, value)


def field(rng):
    kind = rng.randrange(9)
    text = "".join(rng.choice(["a", "Ü", " ", "7", "{", ":"]) for _ in range(rng.randrange(8)))
    if kind == 0:
        return '"' + "".join(rng.choice(["\n", '""', ",", "x", "\n\n", '"",""', ',""b"":2']) for _ in range(rng.randrange(6))) + '"'
    if kind == 1:
        return '"' + text + '"'
    if kind == 2:
        return text.replace(" ", "") + 'x"' + text  # a quote that opens nothing
    if kind == 3:
        return rng.choice(['""', '""""', '"a""b"', '""""""'])
    return text


def records(spark, folder):
    lines = with_lineage(text_lines(spark.read).text(str(folder)).select("value", "_metadata"), TS).drop("_metadata")
    return whole_records(lines, POSITION), lines


@pytest.mark.parametrize("seed,size,end", [(1, 200, "\n"), (2, 64, "\n"), (3, 1 << 20, "\n"), (4, 120, "\r\n")])
def test_records_are_those_of_a_csv_reader(spark, tmp_path, small_ranges, seed, size, end):
    rng = random.Random(seed)
    want = {}
    for name in ("a.csv", "b.csv"):
        rows = [",".join(field(rng) for _ in range(rng.randint(2, 5))) for _ in range(150)]
        body = end.join(["h1,h2", *rows]) + (end if name == "a.csv" else "")
        (tmp_path / name).write_bytes(body.encode())
        want[name] = [r for r in csv.reader(io.StringIO(body.replace("\r\n", "\n"), newline="")) if r]
    small_ranges(size)
    found, lines = records(spark, tmp_path)
    got = {}
    for r in sorted(found.collect(), key=lambda r: (r["_source_file"], r[POSITION]["block"], r[POSITION]["row"])):
        got.setdefault(r["_source_file"], []).append(r)
    for name, rows in want.items():
        assert [next(csv.reader(io.StringIO(r["value"], newline=""))) for r in got[name]] == rows
        assert [r["_header"] for r in got[name]] == [True] + [False] * (len(rows) - 1)
    blocks = {(r["f"], r["b"]) for r in lines.select(F.col(POSITION)["file"].alias("f"), F.col(POSITION)["block"].alias("b")).distinct().collect()}
    assert (len(blocks) > 20) == (size < 1000)


def test_one_file_over_several_tasks(spark, tmp_path, small_ranges):
    rng = random.Random(6)
    rows = [files.loan(i, i, "auto", "100", "5", 12, "2022-02-03", "web", "active", note="\n".join("ab" for _ in range(rng.randrange(4))))
            for i in range(1, 401)]
    path = tmp_path / "loans.csv"
    path.write_text(files.LOAN_HEADER + "\n".join(rows) + "\n")
    whole = read_loan_files(spark, str(path), TS).drop(POSITION)
    want = sorted(map(tuple, whole.collect()))
    assert len(want) == 400 and any("\n" in r[9] for r in want)
    small_ranges(3000)
    split = read_loan_files(spark, str(path), TS)
    assert sorted(map(tuple, split.drop(POSITION).collect())) == want
    lines = text_lines(spark.read).text(str(path))
    assert lines.rdd.getNumPartitions() > 8
    order = [r["loan_id"] for r in split.orderBy(F.col(POSITION)["block"], F.col(POSITION)["row"]).collect()]
    assert order == [f"LN-{i}" for i in range(1, 401)]


def test_unclosed_quote_and_empty_files(spark, tmp_path, small_ranges):
    (tmp_path / "a.csv").write_text('h,i\n1,2\n\n3,"4\n5,6\n')
    (tmp_path / "b.csv").write_text("")
    (tmp_path / "c.csv").write_text("h,i")
    small_ranges(6)
    got = {(r["_source_file"], r["value"]) for r in records(spark, tmp_path)[0].collect()}
    assert got == {("a.csv", "h,i"), ("a.csv", "1,2"), ("a.csv", '3,"4\n5,6'), ("c.csv", "h,i")}


def test_other_header_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text(files.LOAN_HEADER + files.LOANS[0] + "\n")
    (tmp_path / "b.csv").write_text(files.LOAN_HEADER.replace("loan_id,customer_id", "customer_id,loan_id") + files.LOANS[0] + "\n")
    with pytest.raises(Exception, match="has other columns"):
        read_loan_files(spark, str(tmp_path), TS).collect()


def test_stream_of_lines(spark, tmp_path, small_ranges):
    """The same function on a stream's micro-batch."""
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text(files.LOAN_HEADER + "\n".join(files.LOANS).replace("690", "6\n90") + "\n")
    small_ranges(200)
    seen = []
    columns = files.LOAN_HEADER.strip().split(",")
    query = (text_lines(spark.readStream).text(str(folder)).select("value", "_metadata").writeStream
             .foreachBatch(lambda df, _: seen.extend(loan_rows(df, TS, columns).collect()))
             .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    query.awaitTermination()
    want = read_loan_files(spark, str(folder / "a.csv"), TS)
    assert sorted(map(repr, (r[:12] for r in map(tuple, seen)))) == sorted(map(repr, (tuple(r)[:12] for r in want.collect())))
    assert len(seen) == 12
