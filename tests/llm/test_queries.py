"""Every operator over small tables with nulls, empty and long texts, ties, repeated rows and
columns that clash with its own, against brute force or its SQL."""

import math
import os
import uuid
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from ledgerlake.llm import (common, components, decontaminate, jaccard_join, knn, language, licences, lm_score, mixing,  # noqa: E402
                            pages, repeats, tiling, token_files)
from ledgerlake.llm.oracle import ORACLE  # noqa: E402
from ledgerlake.llm.queries import REGISTRY  # noqa: E402

LONG = " ".join(f"w{i}" for i in range(3000))
BASE = [f"t{i}" for i in range(60)]
NEAR = " ".join([*BASE[:50], "x", *BASE[51:]])
TEXTS = [
    (0, " ".join(BASE)), (1, NEAR), (2, " ".join(BASE).upper()), (3, None), (4, ""), (5, " \n\t"), (6, "two words"),
    (7, "Two  words"), (8, LONG), (9, LONG + " more"), (10, "one"), (None, "no id here at all"), (12, "…!? 12"),
    (13, "two words"), (13, "two words"), (14, "bench " * 3 + " ".join(f"b{i}" for i in range(13)) + " end"),
    (15, "short item inside"), (16, " ".join(BASE[:30])), (17, "a line\nreleased under the mit licence\n\n(c) us")]


def documents(spark, rows=TEXTS):
    """With extra columns that are named like the operators' own."""
    made = [(i, t, None if n % 5 == 0 else ("en" if n % 2 else "de"), None if n == 3 else f"s{n % 3}", n)
            for n, (i, t) in enumerate(rows)]
    df = spark.createDataFrame(made, "doc_id long, text string, lang string, source string, n_chars long")
    extra = ("tkey", "class", "row", "key", "n", "id", "size", "score", "component", "h", "g", "own")
    return df.selectExpr("*", *[f"'x' AS `{c}`" for c in extra])


def table_folder(spark, tmp_path, rows=TEXTS):
    folder = str(tmp_path / uuid.uuid4().hex)
    documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
    items = [("i1", " ".join(f"B{i}" for i in range(13))), ("i2", "short item"), ("i3", None), ("i4", "... "), ("i2", "short item"),
             (None, " ".join(f"w{i}" for i in range(100, 120)))]
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    vectors = [(i, [float((i * 7 + j * 3) % 11) / 5 - 1 for j in range(4)]) for i in range(120)]
    vectors += [(200, None), (201, [1.0, None, 0.0, 0.0]), (202, [float("nan"), 0.0, 0.0, 0.0]), (250, [1.0, 2.0]),
                (300, [float("inf"), 0.0, 0.0, 0.0]), (350, [0.5, 0.5, 0.5, 0.5])]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").selectExpr("*", "1 AS id", "2 AS v").write.parquet(
        f"{folder}/embeddings.parquet")
    return folder


@pytest.mark.parametrize("name", ["op2_decontamination", "op6_source_mix", "op9_licence_scan", "op10_exact_top_k"])
def test_against_sql(spark, tmp_path, name):
    folder = table_folder(spark, tmp_path)
    with duckdb.connect() as sql:
        for t in ("documents", "benchmark", "embeddings"):
            sql.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
        query = ORACLE[name]
        want = sql.sql(query).fetchall()
        columns = sql.sql(query).columns
    got = REGISTRY[name](spark, folder).select(*columns).collect()

    def plain(rows):
        return sorted(repr([round(float(v), 6) if isinstance(v, float) else v for v in r]) for r in rows)

    assert plain(map(tuple, got)) == plain(want) and got


def test_windows_are_hashed_once(spark):
    """The k-word hashes must not be computed anew for every window."""
    plan = decontaminate.prepared(documents(spark).select("text"), ).select(decontaminate.windows(13))
    text = plan._jdf.queryExecution().executedPlan().toString()
    windows = next(line for line in text.splitlines() if "md5" in line)
    assert windows.count("xxhash64") == 0


def brute_components(rows):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return sets, root


@pytest.mark.parametrize("paired", [32, 1])
def test_jaccard_components(spark, monkeypatch, paired):
    monkeypatch.setattr(tiling, "PAIRED", paired)
    monkeypatch.setattr(tiling, "INSIDE", 150)
    monkeypatch.setattr(tiling, "OUTSIDE", 100)
    chain = [(100 + i, " ".join([*BASE[i:], *(f"c{j}" for j in range(i))])) for i in range(0, 12, 2)]
    mixed = [(200 + i, " ".join(BASE[:40] + [f"u{i}x{j}" for j in range(7 + i % 3)])) for i in range(12)]
    rows = TEXTS + chain + mixed
    got = jaccard_join.with_component(documents(spark, rows)).collect()
    sets, root = brute_components(rows)
    least = {}
    for (i, _), r in zip(rows, root, strict=True):
        least[r] = i if r not in least or least[r] is None else (least[r] if i is None else min(least[r], i))
    want = sorted((repr(i), len(s), repr(i if not s else least[r])) for (i, _), s, r in zip(rows, sets, root, strict=True))
    assert sorted((repr(r["id"]), r["n_shingles"], repr(r["component_id"])) for r in got) == want
    if paired == 1:
        return
    kept = jaccard_join.one_of_each(documents(spark, rows))
    assert kept.columns == documents(spark).columns
    empty = sum(1 for s in sets if not s)
    assert kept.count() == empty + len({r for r, s in zip(root, sets, strict=True) if s})


def test_near_copies_that_are_too_many_to_broadcast(spark, monkeypatch):
    """Texts that are like no other take no part in a shuffle, and only what the result reads stays."""
    monkeypatch.setattr(common, "BROADCAST_ROWS", 3)
    single = [(1000 + i, " ".join(f"z{i}x{j}" for j in range(30))) for i in range(300)]
    near = [(i % 40, " ".join([*(f"y{i % 20}x{j}" for j in range(39)), "end" if i < 60 else f"e{i}"])) for i in range(80)]
    rows = [*near, *single, (None, near[0][1]), (None, None), (5, None), (2000, "")]
    docs, made, store, split = documents(spark, rows), [], jaccard_join.store, jaccard_join.split_by_filter
    parts = []
    monkeypatch.setattr(jaccard_join, "store", lambda df, name: made.append(store(df, name)) or made[-1])
    monkeypatch.setattr(tiling, "store", lambda df, name: made.append(store(df, name)) or made[-1])
    monkeypatch.setattr(jaccard_join, "split_by_filter", lambda *a: parts.append(split(*a)) or parts[-1])
    got = jaccard_join.with_component(docs).collect()
    sets, root = brute_components(rows)
    least = {}
    for (i, _), r in zip(rows, root, strict=True):
        least[r] = i if r not in least or least[r] is None else (least[r] if i is None else min(least[r], i))
    want = sorted((repr(i), len(s), repr(i if not s else least[r])) for (i, _), s, r in zip(rows, sets, root, strict=True))
    assert sorted((repr(r["id"]), r["n_shingles"], repr(r["component_id"])) for r in got) == want
    left = {f.split("/")[-2].rsplit("-", 1)[0] for df in made for f in df.inputFiles() if os.path.exists(f.removeprefix("file:"))}
    assert left <= {"placed-rows", "first-components", "components"}
    kept = jaccard_join.one_of_each(docs)
    first = {r: min((i is not None, i or 0) for (i, _), q in zip(rows, root, strict=True) if q == r) for r in set(root)}
    keepers = {(repr(i), t) for (i, t), r in zip(rows, root, strict=True) if (i is not None, i or 0) == first[r]}
    found = sorted((repr(r["doc_id"]), r["text"]) for r in kept.select("doc_id", "text").collect() if (r["text"] or "").strip())
    assert len(found) == len({r for r, s in zip(root, sets, strict=True) if s}) and set(found) <= keepers
    assert kept.where("coalesce(trim(text), '') = ''").count() == 3
    assert len(parts) >= 2 and parts[-1][0].count() < 120


def test_filter_splits_rows_without_loss(spark):
    wanted = spark.range(0, 40_000, 2).selectExpr("if(id = 0, null, id) AS k")
    rows = spark.range(60_000).selectExpr("if(id = 0, null, id) AS v", "id")
    some, others = common.split_by_filter(rows, rows["v"], wanted, "k")
    assert some.columns == others.columns == ["v", "id"] and some.count() + others.count() == 60_000
    assert some.where("v IS NULL OR v % 2 = 0 AND v < 40000").count() == 20_000 and some.count() < 20_200


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(9)] + [(20, i) for i in range(21, 40)] + [(50, 50), (7, 3), (3, 7)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(links, "a long, b long"), "t").collect()}
    assert got == {**{i: 0 for i in range(10)}, **{i: 20 for i in range(20, 40)}}
    assert components.components(spark.createDataFrame([], "a long, b long"), "t").isEmpty()


def test_token_folder(spark, tmp_path):
    folder = str(tmp_path / "tokens")
    token_files.write_tokens(documents(spark), folder, public_tokenizers.path("byte_bpe_50k.json"), 2)
    encoder = token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json"), 2)
    start, want = 0, []
    for i, t in sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = sorted(map(tuple, token_files.token_digests(spark, folder).collect()), key=lambda r: r[1])
    assert got == want
    whole = {zlib.crc32(bytes(r["ids"])) for r in token_files.read_tokens(spark, folder).collect()}
    assert whole == {r[3] for r in want}
    one = token_files.read_documents(spark, folder, [9, 6]).collect()
    assert {r["doc_id"]: len(r["ids"]) for r in one} == {r[0]: r[2] for r in want if r[0] in (6, 9)}


def test_language(spark):
    german = ["das ist ein haus und der hund", "die katze und das haus", "wir sind nicht in der schule"]
    english = ["this is the house and the dog", "the cat and the house", "we are not in the school"]
    rows = [(i, t, x) for i, (t, x) in enumerate([(t, "de") for t in german * 4] + [(t, "en") for t in english * 4])]
    labelled = spark.createDataFrame([*rows, (90, None, "en"), (91, "text", None)], "doc_id long, text string, lang string")
    model = language.learn(labelled, public_tokenizers.path("piece_bpe_32k.model"))
    assert model.languages == ["de", "en"]
    asked = spark.createDataFrame([("der hund und die schule",), ("the dog and the school",), (None,), ("12 …",), ("",)], "text string")
    got = [r["_language"] for r in language.with_language(asked, model).collect()]
    assert [r["lang_pred"] for r in got] == ["de", "en", "und", "und", "und"]
    assert all(0 <= r["score"] <= 1 for r in got)
    nothing = language.learn(labelled.limit(0), public_tokenizers.path("piece_bpe_32k.model"))
    assert {r["_language"]["lang_pred"] for r in language.with_language(asked, nothing).collect()} == {"und"}


def test_language_counts_a_text_once(spark):
    german, english = [f"haus nummer {i} und hund" for i in range(4)], [f"house number {i} and dog" for i in range(4)]

    def learned(copies):
        rows = [(t, x) for texts, x in ((german, "de"), (english, "en")) for t in texts[:1] * copies + texts[1:]]
        return language.learn(spark.createDataFrame(rows, "text string, lang string"),
                              public_tokenizers.path("piece_bpe_32k.model"), rows_per_language=4)

    once, often = learned(1), learned(60)
    assert np.array_equal(once.probs, often.probs) and len(np.unique(once.probs)) > 2


def test_dictionary_sample_is_spread_over_texts(spark, tmp_path, monkeypatch):
    seen = []
    train = token_files.trained_dictionary
    monkeypatch.setattr(token_files, "trained_dictionary", lambda samples: seen.extend(samples) or train(samples))
    text = "head " * 900 + "tail " * 4000
    docs = spark.createDataFrame([(i, text) for i in range(20)], "doc_id long, text string")
    token_files.write_tokens(docs, str(tmp_path / "t"), public_tokenizers.path("byte_bpe_50k.json"), 2)
    assert len(set(seen)) > 1


@pytest.mark.parametrize("top", [0, 3, 1000])
def test_lm_scores(spark, monkeypatch, top):
    monkeypatch.setattr(lm_score.frequent, "__defaults__", (top,))
    rows = [(i, t) for i, t in TEXTS]
    train = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2 for i, _ in rows]
    docs = documents(spark).selectExpr("*", "crc32(cast(coalesce(cast(doc_id as string), '') as binary)) % 7 != 2 AS train")
    got = lm_score.scored(docs, public_tokenizers.path("piece_bpe_32k.model"), train="train").collect()
    tokens = [(t or "").encode().lower().split() + [None] for _, t in rows]
    c = Counter(w for ws, keep in zip(tokens, train, strict=True) if keep for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted((repr(i), len(ws), sum(c[w] > 0 for w in ws), round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6))
                  for (i, _), ws in zip(rows, tokens, strict=True))
    assert sorted((repr(r["id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got) == want
    assert {r["train_tokens"] for r in got} == {n} and all(r["score"] < 0 for r in got)


def test_repeated_passages(spark):
    passage = " ".join(f"p{i}" for i in range(55))
    rows = [(1, f"start one {passage} more text of one"), (2, f"other words\nhere is {passage}"), (3, " ".join(BASE)),
            (4, passage.upper()), (5, None), (6, ""), (7, " ".join(f"q{i}" for i in range(40))), (8, "again " + " ".join(f"q{i}" for i in range(40))),
            (9, " ".join(f"r{i}" for i in range(60)) + "\n" + " ".join(f"r{i}" for i in range(60)))]
    got = repeats.repeated_passages(documents(spark, rows)).collect()
    assert {r["id"] for r in got} == {1, 2, 4} and all(51 <= r["n_words"] <= 56 for r in got)
    assert {r["id"] for r in got if not r["removed"]} == {1}
    assert {tuple(r["kept_ids"]) for r in got} == {(1,)}


def test_repeated_passages_over_several_lines(spark):
    words = [f"m{i}" for i in range(60)]
    rows = [(1, "head of one\n" + "\n".join(" ".join(words[i:i + 7]) for i in range(0, 60, 7)) + "\ntail"),
            (2, "another " + " ".join(words)), (3, "\n\n".join(" ".join(words[i:i + 23]) for i in range(0, 60, 23))),
            (4, "\n".join(f"s{i} short" for i in range(40))), (5, "\n".join(f"s{i} short" for i in range(40)))]
    got = repeats.repeated_passages(documents(spark, rows)).collect()
    assert sorted((r["id"], r["removed"]) for r in got) == [(1, False), (2, True), (3, True), (4, False), (5, True)]
    assert all(r["n_words"] >= 51 and r["kept_ids"] == [1 if r["id"] < 4 else 4] for r in got)


def test_repeated_passages_beyond_the_first_occurrence(spark):
    """A passage of documents 2 and 3 whose beginning also stands in document 1."""
    rows, want = [], set()
    for trial in range(6):
        words = [f"v{trial}x{i}" for i in range(51 + 3 * trial)]
        other = [[f"o{trial}d{d}x{i}" for i in range(30)] for d in range(3)]
        rows += [(10 * trial + 1, " ".join(other[0] + words[:40] + other[0][::-1])),
                 (10 * trial + 2, " ".join(other[1] + words)), (10 * trial + 3, " ".join(words + other[2]))]
        want |= {(10 * trial + 2, 30, len(words), False), (10 * trial + 3, 0, len(words), True)}
    got = repeats.repeated_passages(documents(spark, rows)).collect()
    assert {(r["id"], r["first_word"], r["n_words"], r["removed"]) for r in got} == want
    assert all(10 * (r["id"] // 10) + 2 in r["kept_ids"] for r in got)


def test_every_word_of_a_shared_run_is_covered(spark):
    """Random texts that share passages of all lengths, whole, nested, adjoining and in copies."""
    rng = np.random.default_rng(8)
    pool = [[f"p{n}x{i}" for i in range(int(rng.integers(40, 140)))] for n in range(12)]
    rows = []
    for d in range(60):
        words = []
        for _ in range(int(rng.integers(1, 6))):
            own = [f"o{d}x{int(x)}" for x in rng.integers(0, 10 ** 6, int(rng.integers(0, 40)))]
            part = pool[int(rng.integers(len(pool)))]
            lo = int(rng.integers(0, 30))
            words += own + part[lo:lo + int(rng.integers(30, 150))]
        rows.append((d, " ".join(words)))
    texts = {d: t.split() for d, t in rows}
    holders = {}
    for d, w in texts.items():
        for i in range(len(w) - 50):
            holders.setdefault(tuple(w[i:i + 51]), set()).add(d)
    need = {(d, j) for d, w in texts.items() for i in range(len(w) - 50) if len(holders[tuple(w[i:i + 51])]) > 1
            for j in range(i, i + 51)}
    got = repeats.repeated_passages(documents(spark, rows)).collect()
    covered = {(r["id"], j) for r in got for j in range(r["first_word"], r["first_word"] + r["n_words"])}
    assert len(need) > 2000 and not need - covered


def test_sets_are_made_of_likely_pairs_and_dropped(spark, monkeypatch):
    """Texts that share a line of eight words here and there, and two near copies."""
    rng = np.random.default_rng(6)
    lines = [" ".join(f"c{n}x{i}" for i in range(8)) for n in range(30)]
    rows = [(d, " ".join(x for j in range(20) for x in (lines[int(rng.integers(30))], *(f"o{d}x{j}y{i}" for i in range(12))))) for d in range(40)]
    words = rows[0][1].split()
    rows.append((99, " ".join(w if i % 97 else "other" for i, w in enumerate(words))))
    made, kept, store = {}, [], repeats.store

    def seen(df, name):
        out = store(df, name)
        made[name] = made.get(name, 0) + out.count()
        kept.extend(out.inputFiles())
        return out

    monkeypatch.setattr(repeats, "store", seen)
    got = repeats.repeated_passages(documents(spark, rows)).collect()
    assert {r["id"] for r in got} == {0, 99}
    assert 0 < sum(n for name, n in made.items() if name.endswith("-sets")) < 700
    names = ("units-", "unit-classes-", "unit-pairs-", "pairs-sets-")
    folders = [f.removeprefix("file:") for f in kept if any(f"/{n}" in f for n in names)]
    assert folders and not any(os.path.exists(f) for f in folders)


def test_mix_reaches_targets(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 40)), f"s{i % 4}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [r["_mix"] | {"source": r["source"]} for r in map(lambda r: r.asDict(True), mixing.take(docs).collect())]
    for s in {r["source"] for r in got}:
        mine = [r for r in got if r["source"] == s]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 40
        assert all(r["taken"] <= 2 * r["size"] for r in mine)
    weighted = mixing.take(docs.withColumn("w", docs.doc_id % 3 + 1.0), weight_col="w").collect()
    assert abs(sum(r["_mix"]["taken"] for r in weighted) - 1.5 * sum(len(t.split()) for _, t, _ in rows)) <= 4 * 40
    mix = mixing.mixed(docs)
    assert mix.columns == docs.columns and mix.count() == sum(r["copies"] for r in got)


def test_pages(spark):
    good = "<html><body><div class='c{}'><p>{}</p></div><div class='x'><p>tail</p></div></body></html>"
    rows = [(i, f"http://h.example/{i}", good.format(i, "words of the text " * 5)) for i in range(4)]
    rows += [(8, "http://h.example/8", None), (9, None, ""), (10, "no url", "<p>alone</p>"), (10, "no url", "<p>alone</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS host", "'y' AS path")
    got = [(r["page_id"], r["_main"]) for r in pages.with_main_text(df).orderBy("page_id").collect()]
    text = " ".join(["words of the text"] * 5)
    assert got == [(0, text), (1, text), (2, text), (3, text), (8, ""), (9, ""), (10, "alone"), (10, "alone")]


def test_pages_with_text_in_sibling_containers(spark):
    page = ("<html><body><nav><a href='/'>Home</a></nav><div class='content'><div class='intro'><p>{0} opening words</p></div>"
            "<div class='text'><p>{0} long middle part of the text</p></div><section class='more'><p>{0} closing words</p>"
            "</section></div><footer>us</footer></body></html>")
    rows = [(i, f"http://split.example/{i}", page.format(i)) for i in range(3)]
    many = "".join(f"<div class='part{c}'><p>section {c}</p></div>" for c in "abcdefgh")
    rows += [(9, "http://many.example/", f"<html><body><div class='all'>{many}</div></body></html>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["_main"] for r in pages.with_main_text(df).collect()}
    want = {i: f"{i} opening words {i} long middle part of the text {i} closing words" for i in range(3)}
    assert got == want | {9: " ".join(f"section {c}" for c in "abcdefgh")}
    assert pages.main_text(rows[0][2], None) == want[0]


def test_licences(spark, tmp_path):
    mit, bsd = licences.KNOWN["MIT"][-1], licences.KNOWN["BSD-3-Clause"][-1]
    wrapped = mit.replace("AUTHORS OR COPYRIGHT HOLDERS", "AUTHORS OR\nCOPYRIGHT HOLDERS")
    commented = "\n".join("# " + line for line in ("Copyright 2020 Someone\n\n" + mit).split("\n"))
    want = {1: ("Copyright (c) 2020 Someone\n\n" + mit.upper(), "MIT", True),
            2: ("Text before.\nreleased under the mit licence\nafter", "MIT", False),
            7: ("some text\n\n" + mit + "\n\nmore text", "MIT", False),
            8: ("MIT License\n\nCopyright (c) 2021 A. N. Other\n\n" + mit, "MIT", False),
            9: (commented, "MIT", True), 10: ("head\n\n" + wrapped, "MIT", False),
            11: ("// (c) us\n\n" + mit.replace("\n\n", "\n"), "MIT", True),
            12: ("x\n\n" + bsd.replace(" 2. ", "\n\n2. ").replace("holder", "owner"), "BSD-3-Clause", False),
            13: ("Licensed under the MIT Licence.\n\n\n\nLicensed under the MIT License.", "MIT", False),
            16: ("long " * 20000 + "\n\n" + mit + "\n\n" + "text " * 20000, "MIT", False)}
    none = {3: None, 4: "", 5: "Released under the MIT License, or not.", 6: "(c) nobody", 14: mit.replace("free of charge", "for money"),
            15: mit[:-20]}
    rows = [(i, w[0]) for i, w in want.items()] + list(none.items())
    got = licences.scan(documents(spark, rows), licences.known_licences(spark)).collect()
    assert {(r["id"], r["licence_id"], r["whole"]) for r in got} == {(i, w[1], w[2]) for i, w in want.items()}
    assert {r["id"]: r["n_texts"] for r in got}[13] == 2
    folder = str(tmp_path / "sf")
    documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
    with duckdb.connect() as sql:
        sql.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
        rows = sql.sql(ORACLE["op9_licence_scan"]).fetchall()
    assert sorted(rows) == sorted((r["id"], r["licence_id"], r["whole"], r["n_texts"]) for r in got)


def test_spellings_of_neighbouring_words(spark):
    df = spark.createDataFrame([("Licence licence, per cent PER CENT",)], "t string")
    assert df.select(licences.canonical(licences.canonical_lines(df.t))).head()[0] == "license license percent percent"


def test_empty_tables(spark, tmp_path):
    none = documents(spark, TEXTS[:1]).limit(0)
    assert jaccard_join.with_component(none).isEmpty() and jaccard_join.one_of_each(none).isEmpty()
    assert repeats.repeated_passages(none).isEmpty() and mixing.mixed(none).isEmpty()
    assert licences.scan(none, licences.known_licences(spark)).isEmpty()
    items = spark.createDataFrame([], "item_id string, text string")
    assert decontaminate.contamination(none, items).isEmpty()
    assert decontaminate.clean_documents(documents(spark), items).count() == len(TEXTS)
    assert lm_score.scored(none, public_tokenizers.path("piece_bpe_32k.model")).isEmpty()
    assert knn.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), "id % 50 = 0").isEmpty()
    assert pages.with_main_text(spark.createDataFrame([], "url string, html string")).isEmpty()
    folder = str(tmp_path / "none")
    token_files.write_tokens(none, folder, public_tokenizers.path("byte_bpe_50k.json"), 2)
    assert token_files.token_digests(spark, folder).isEmpty()
