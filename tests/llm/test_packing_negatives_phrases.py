"""Packing, hard negatives and phrases: small tables with nulls, long texts, ties, repeated rows and
clashing columns, against plain versions, SQL and a fresh tokenizer."""

import random
import re
import uuid
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from ledgerlake.llm import hard_negatives, packing, phrases  # noqa: E402
from ledgerlake.llm.oracle import ORACLE  # noqa: E402
from ledgerlake.llm.queries import REGISTRY  # noqa: E402

CLASH = [f"'x' AS `{c}`" for c in ("id", "gram", "f", "kind", "row", "block", "group", "closed", "ids", "pieces", "at", "w", "rank")]


def folder_of(spark, tmp_path, **tables):
    folder = str(tmp_path / uuid.uuid4().hex)
    for name, df in tables.items():
        df.selectExpr("*", *CLASH).repartition(3).write.parquet(f"{folder}/{name}.parquet")
    return folder


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def against_sql(spark, folder, name, *tables):
    with duckdb.connect() as sql:
        for t in tables:
            sql.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
        found = sql.sql(ORACLE[name])
        columns, want = found.columns, found.fetchall()
    got = [tuple(r) for r in REGISTRY[name](spark, folder).select(*columns).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    return got


# --- packing -------------------------------------------------------------------------------------

def test_best_fit_takes_the_fullest_that_fits():
    rng = random.Random(5)
    held, plain = packing.OpenSequences(50, 4), []
    for n in range(2000):
        length = rng.choice([1, 2, 3, 10, 20, 30, 49, 50])
        closed = held.add(length, (length, n))
        fits = [s for s in plain if sum(x for x, _ in s) + length <= 50]
        want = None
        if fits:
            mine = max(fits, key=lambda s: sum(x for x, _ in s))
            mine = next(s for s in reversed(fits) if sum(x for x, _ in s) == sum(x for x, _ in mine))
        else:
            mine = []
            if len(plain) == 4 and length < 50:
                want = max(plain, key=lambda s: sum(x for x, _ in s))
        room = None if want is None else sum(x for x, _ in want)
        mine.append((length, n))
        if sum(x for x, _ in mine) == 50:
            want = mine
        assert (closed is None) == (want is None)
        if closed is not None:
            assert sum(x for x, _ in closed) == (room or 50)
            plain = [s for s in plain if s is not mine and s != closed]
        plain = [s for s in plain if s is not mine]
        if sum(x for x, _ in mine) < 50:
            plain.append(mine)
        assert held.held == len(plain) <= 4


@pytest.mark.parametrize("most_open,merged", [(packing.OPEN, packing.MERGED), (3, 2)])
def test_packing(spark, monkeypatch, most_open, merged):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "MERGED", merged)
    path, rng = public_tokenizers.path("byte_bpe_50k.json"), random.Random(1)
    fresh = Tokenizer.from_file(path)
    rows = [(i, " ".join(rng.choice(["the", "of", "Ünder", "zzqx", "12", "…", "\n\n"]) for _ in range(rng.choice([1, 5, 40, 90, 300]))))
            for i in range(120)]
    rows += [(200, None), (201, ""), (7, rows[7][1]), (7, "other text"), (None, "no id"), (None, None), (300, "long text " * 2000),
             (301, "a <|endoftext|> b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", *CLASH).repartition(7)
    sequences = packing.packed(docs, path, 2, size=128, most_open=most_open)
    assert all(len(r["ids"]) == 4 * r["n_tokens"] for r in sequences.collect())
    parts = packing.pieces(sequences).collect()
    want = Counter()
    for doc_id, text in rows:
        ids = [*fresh.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % 128 or 128
        cuts = [0, *range(first, len(ids) + 1, 128)]
        want.update((doc_id, n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
                    for n, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)))
    assert Counter((p["doc_id"], p["piece"], p["start"], p["length"], p["ids_crc32"]) for p in parts) == want
    placed = defaultdict(list)
    for p in parts:
        placed[p["sequence_id"]].append((p["offset"], p["length"]))
    total = 0
    for places in placed.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 128
        total += at
    assert len(placed) <= (1.04 if most_open > 3 else 1.35) * -(-total // 128) + 1
    text = {r["sequence_id"]: r["ids"] for r in sequences.collect()}
    for p in parts:
        cut = text[p["sequence_id"]][4 * p["offset"]:4 * (p["offset"] + p["length"])]
        assert zlib.crc32(cut) == p["ids_crc32"]


def test_packing_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    made = packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"), 2)
    assert packing.pieces(made).collect() == []


# --- hard negatives ------------------------------------------------------------------------------

def vectors(spark, n, seed=3, dims=8, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dims))
    rows = []
    for i in range(n):
        label = int(rng.integers(labels))
        v = centres[label] + rng.normal(size=dims) * 1.5
        rows.append((i, [float(x) for x in np.float32(v / np.linalg.norm(v))], label))
    return rows


def test_hard_negatives(spark, tmp_path, monkeypatch):
    rows = vectors(spark, 700)
    rows += [(1000, None, 1), (1100, [1.0] * 8, None), (1200, [1.0, None] + [0.0] * 6, 1), (1300, [float("nan")] * 8, 2),
             (1400, [1.0, 2.0], 1), (1401, [2.0, 1.0], 1), (1402, [1.0, 1.5], 2), (1500, [], 3), (1501, [], 3), (1600, [float("inf")] * 8, 0),
             (None, [0.1] * 8, 1), (1700, [0.0] * 8, 2)]
    rows += [(5000 + i, rows[3][1], rows[3][2]) for i in range(30)] + [rows[11], rows[11], rows[35]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS v", "2 AS dims", "'a' AS anchor")
    folder = folder_of(spark, tmp_path, embeddings=df)
    got = against_sql(spark, folder, "op12_hard_negatives", "embeddings")
    assert len(got) > 100
    # Many blocks and groups, and thresholds that begin too high.
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", 16384)
    monkeypatch.setattr(hard_negatives, "GROUP_BYTES", 256)
    monkeypatch.setattr(hard_negatives, "SAMPLE_BYTES", 1024)
    assert len(against_sql(spark, folder, "op12_hard_negatives", "embeddings")) == len(got)


def test_threshold_join():
    rng = np.random.default_rng(1)
    for dims, size in ((1, 100), (3, 10), (20, 40), (64, 300), (20, 1 << 40)):
        q, x = (rng.integers(-size, size + 1, (n, dims)).astype(float) * (rng.random((n, dims)) < 0.7) for n in (40, 500))
        whole = np.array([[sum(int(a) * int(b) for a, b in zip(u, v, strict=True)) for v in x] for u in q], dtype=object)
        whole = np.array([[max(-hard_negatives.LIMIT, min(hard_negatives.LIMIT, s)) for s in r] for r in whole], np.int64)
        for share in (0.5, 0.95, 0.999):
            least = np.sort(whole, axis=1)[:, int(share * 499)]
            i, j, s = hard_negatives.threshold_join(q, least, x)
            want = {(a, b, int(whole[a, b])) for a, b in zip(*np.nonzero(whole >= least[:, None]), strict=True)}
            assert set(zip(i.tolist(), j.tolist(), s.tolist(), strict=True)) == want and len(i) == len(want)


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.hard_negatives(df, "id % 100 = 0").collect() == []
    df = spark.createDataFrame([(100, [1.0], 1), (1, [1.0], 2)], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.hard_negatives(df, "id % 100 = 0").collect() == []


# --- phrases -------------------------------------------------------------------------------------

def corpus():
    rng = random.Random(9)
    words = ["the", "of", "New", "York", "city", "É", "😀", "ﬀ", "a b", "x-y", "\x00", "zz"]
    rows = []
    for i in range(260):
        text = "".join(rng.choice(words[:rng.choice([2, 12])]) + rng.choice([" ", " ", "  ", "\t", ", ", ". ", "\n", "\r\n", "\x0b"]) for _ in range(rng.randint(0, 30)))
        rows.append((i, text, rng.choice(["en", "de", None, "und"]), "s", 0))
    passage = " ".join(f"p{i}" for i in range(200))
    rows += [(300 + i, f"the {passage} end of it" if i % 2 else passage, "en", "s", 0) for i in range(12)]
    rows += [(400, None, "en", "s", 0), (401, "", None, None, None), (402, "word", "fr", None, None), (403, " ".join(["loop"] * 400), "fr", "", 0)]
    rows += [rows[5]] * 12 + [(404, "".join(f"w{i} " for i in range(4000)), "en", "s", 0)]
    return rows


def test_phrases(spark, tmp_path):
    folder = folder_of(spark, tmp_path, documents=documents(spark, corpus()))
    got = against_sql(spark, folder, "op13_phrases", "documents")
    assert {r[0] for r in got} >= {"en", "und", "fr"}


def test_counts_come_from_the_graph(spark):
    rows = corpus()
    g = phrases.graph(documents(spark, rows))
    f = Counter()
    for _, text, lang, *_ in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\f\r]", lowered):
            w = [x for x in re.split("[ \t]", piece) if x]
            f.update((lang or "und", " ".join(w[i:i + k])) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    for table, k in ((g.words, 1), (g.nodes, 2)):
        assert {(r["lang"], r["gram"]): r["f"] for r in table.collect()} == {
            x: n for x, n in f.items() if n >= 10 and x[1].count(" ") == k - 1}
    paths = g.paths.collect()
    edges = [(p["lang"], " ".join(p["words"][i:i + 3]), p["weight"]) for p in paths for i in range(len(p["words"]) - 2)]
    assert len(edges) == len(set(edges)) and {(a, b): n for a, b, n in edges} == {
        x: n for x, n in f.items() if n >= 10 and x[1].count(" ") == 2}
    # The passage is one path; only the pieces' begins and ends bound it.
    assert max(len(p["words"]) for p in paths) == 200


def test_no_phrases(spark):
    assert phrases.collocations(documents(spark, [])).collect() == []
