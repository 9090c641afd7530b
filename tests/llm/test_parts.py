"""Pieces of the operators that run inside tasks, against plain versions."""

import itertools
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

public_tokenizers = pytest.importorskip("public_tokenizers")

from ledgerlake.llm import jaccard_join, lattice, pages, repeats, shingles, tiling, token_files  # noqa: E402

MARKS = st.text(alphabet=list("ab Zé,.'’1\n\t\x1c\xa0 \x85漢🙂<|>"), max_size=30)


@pytest.fixture(scope="module")
def encoder():
    return token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json"), 2)


@settings(max_examples=300, deadline=None)
@given(text=MARKS)
def test_encoder_agrees_with_whole_texts(encoder, text):
    ids = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert encoder.encode(text) == encoder.packed([*ids, 2])


def test_encoder_agrees_with_the_plain_library(encoder):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert 50256 in plain.encode("a <|endoftext|> b", add_special_tokens=False).ids
    for text in ("a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y\nz", "a <|endoftext| > b", "<|ENDOFTEXT|>, no", "plain words,\nand more"):
        assert encoder.encode(text) == encoder.packed([*plain.encode(text, add_special_tokens=False).ids, 2])


def test_encoder_forgets_and_goes_on(encoder, monkeypatch):
    monkeypatch.setattr(token_files, "MEMO_BYTES", 500)
    texts = [f"word{i} other {i}, word{i % 3}" for i in range(60)]
    for text in texts + texts:
        assert encoder.encode(text) == encoder.packed([*encoder.tokenizer.encode(text, add_special_tokens=False).ids, 2])


def test_encoder_joins_runs_without_looking_at_each():
    class Unread(bytes):
        def __eq__(self, other):
            raise AssertionError("compared")

    encoder = token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json"), 2)
    text = "some plain words, and\nmore"
    want = encoder.encode(text)
    encoder.update({k: Unread(v) for k, v in encoder.items() if v is not None})
    assert encoder.encode(text) == want
    assert encoder.encode(text + "  x") == encoder.whole(text + "  x") + encoder.end  # a run without a value


def test_lattice_of_any_length_and_script():
    """Against sums of logarithms, for words far beyond the range of plain products."""
    vocabulary = lattice.Vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    probs = np.random.default_rng(2).random((vocabulary.size, 2)) ** 4
    probs /= probs.sum(axis=0)
    model = lattice.Lattice(vocabulary, probs)
    words = ["", "a", "ꙮ" * 40, "ꙮ" * 300, "abc" * 500, "x" * 5000, "日本語テキスト" * 30, "internationalisation" * 3, "\ud800x"]
    got = model.forward(words)
    for word, row in zip(words, got, strict=True):
        marked = lattice.MARK + word
        logs = np.full((len(marked) + 1, 2), -np.inf)
        logs[0] = 0
        for s in range(len(marked)):
            for e in range(s + 1, min(len(marked), s + model.longest) + 1):
                i = vocabulary.ids.get(marked[s:e])
                if i is not None:
                    logs[e] = np.logaddexp(logs[e], logs[s] + np.log(probs[i]))
                elif e == s + 1:
                    logs[e] = np.logaddexp(logs[e], logs[s] + np.log(model.spelling(ord(marked[s]))))
        assert np.isfinite(row).all() and np.allclose(row, logs[-1], rtol=1e-9), word[:9]


def test_lattice_sums_all_segmentations():
    vocabulary = lattice.Vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    rng = np.random.default_rng(3)
    probs = lattice.probabilities(rng.integers(0, 50, (vocabulary.size, 2)).astype(float))
    words = ["a", "the", "nation", "thnd,", "x漢y", "\U0001f642", "zzzzqq"]
    model = lattice.Lattice(vocabulary, probs)
    got = model.forward(words)
    for word, row in zip(words, got, strict=True):
        marked, total = lattice.MARK + word, np.zeros(2)
        for cuts in itertools.product([0, 1], repeat=len(marked) - 1):
            at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(marked)]
            p = np.ones(2)
            for a, b in itertools.pairwise(at):
                piece = marked[a:b]
                if piece in vocabulary.ids:
                    p = p * probs[vocabulary.ids[piece]]
                elif len(piece) == 1:
                    p = p * np.prod(probs[vocabulary.bytes[list(piece.encode())]], axis=0)
                else:
                    p = p * 0
            total += p
        assert np.allclose(row, np.log(total), rtol=1e-9), word
        assert np.allclose(model.forward([word])[0], row, rtol=1e-12), word


def test_shingle_sets():
    hashes = shingles.WordHashes()
    five = shingles.shingle_set(hashes.of([b"a", b"b", b"c", b"d", b"e", b"f"]), 5)
    assert len(five) == 2 and len(shingles.shingle_set(hashes.of([b"a", b"b"]), 5)) == 1
    assert len(shingles.shingle_set(hashes.of([]), 5)) == 0
    assert shingles.ascii_words("A\xa0b\x0bC") == [b"a\xc2\xa0b", b"c"] and shingles.ascii_words(None) == []
    for n in range(1, 200):
        assert shingles.least_overlap(n, 75) == math.ceil(0.75 * n - 1e-9)


def test_bounds_never_cut_and_blocks_find_every_link():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 400, dtype=np.uint64)
    sets = []
    for i in range(60):
        size = int(rng.integers(5, 300))
        keep = np.concatenate([base[:size], rng.integers(0, 2**63, int(rng.integers(0, 60)), dtype=np.uint64)])
        sets.append(np.unique(keep))
    for x, y in itertools.combinations(sets, 2):
        both = len(np.intersect1d(x, y))
        assert jaccard_join.overlap_bound(jaccard_join.bitmap(x), len(x), jaccard_join.bitmap(y), len(y)) >= both
    frame = pd.DataFrame({"class": range(60), "root": range(60), "set": [s.tobytes() for s in sets]})
    got = {tuple(sorted(p)) for p in tiling.solve_block(frame, frame, 75)}
    want = {(i, j) for i, j in itertools.combinations(range(60), 2)
            if 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))}
    assert got == want and want


def test_any_passage_of_51_words_gives_an_equal_unit():
    rng = np.random.default_rng(7)
    cutter = repeats.Cutter()
    for trial in range(40):
        passage = [f"p{trial}x{i}" for i in range(51)]
        texts = [" ".join([*(f"w{rng.integers(1e9)}" for _ in range(rng.integers(0, 70))), *passage,
                           *(f"w{rng.integers(1e9)}" for _ in range(rng.integers(0, 70)))]) for _ in range(2)]
        a, b = (set(cutter.units(t)[2].tolist()) for t in texts)
        assert a & b
        assert not set(cutter.units(texts[0].replace("p", "q"))[2].tolist()) & b
    assert all(len(x) == 0 for x in cutter.units(None)) and all(len(x) == 0 for x in cutter.units("few words"))


def test_unit_bounds_never_cut_and_meeting_finds_every_pair():
    rng = np.random.default_rng(9)
    cutter, rows, sets = repeats.Cutter(), [], {}
    base = [f"w{x}" for x in rng.integers(0, 25, 400)]
    for _ in range(60):
        text = " ".join(w if rng.random() < 0.99 else f"x{rng.integers(9)}" for w in base)
        starts, ns, classes, k1, k2, k3, sizes, bits = cutter.units(text)
        h = cutter.words(text)
        for i in range(len(starts)):
            members = shingles.shingle_set(h[starts[i]:starts[i] + ns[i]], 5)
            sets[int(classes[i])] = members
            assert sizes[i] == len(members)
            rows += [(int(k), int(classes[i]), int(sizes[i]), int(bits[i])) for k in (k1[i], k2[i], k3[i])]
    rows = sorted(set(rows))
    by_key = {k: [r[1] for r in g] for k, g in itertools.groupby(rows, lambda r: r[0])}
    want = {p for c in by_key.values() if len(c) <= tiling.PAIRED for p in itertools.combinations(c, 2)
            if 100 * len(np.intersect1d(sets[p[0]], sets[p[1]])) >= 75 * len(np.union1d(sets[p[0]], sets[p[1]]))}
    met = {p for c in by_key.values() for p in itertools.combinations(c, 2)}
    for size in (7, 50, 10 ** 6):
        parts = [rows[i:i + size] for i in range(0, len(rows), size)]
        batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*p, strict=True)], ["key", "class", "n", "bits"]) for p in parts]
        out = [r for b in repeats._meeting(iter(batches)) for r in b.to_pylist()]
        pairs = {(r["a"], r["b"]) for r in out if r["b"] is not None}
        assert want <= pairs <= met
        large = sorted((r["key"], r["a"]) for r in out if r["b"] is None)
        assert large == sorted((k, c) for k, cs in by_key.items() if len(cs) > tiling.PAIRED for c in cs)
    assert want and large


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
<nav><ul><li><a href="/">Home</a></ul></nav><div class="cookie-notice">We use cookies</div>
<div id="wrap"><article class="post-12"><h1>Head &amp; tail</h1><p>First <b>par</b>t,&nbsp;one.<br>Next<p>Unclosed
 <div class="advert">Buy</div><aside>See also</aside><form><p>Mail?</p></form>
<!-- <p>hidden</p> --><p>Last &lt;one&gt;</p><section class="comments"><p>Reader: me too, me too</p></section></article>
<div class="sidebar"><p>Popular stories of the week, read them all</p></div></div><footer>&copy; us</footer></body></html>"""


def test_page_text():
    assert pages.main_text(PAGE, "html>body>div>article.post-") == "Head & tail First part, one. Next Unclosed Last <one>"
    assert pages.main_text(PAGE, "no>such>path") == pages.main_text(PAGE, "html>body>div>article.post-")
    assert pages.best_paths(list(pages.blocks(PAGE)), 1)[0][0] == "html>body>div>article.post-"
    for broken in (None, "", "<", "<p", "<p class='", "&am", "<!--", "<script>x", "</div></p>", "<div" * 50):
        assert "<script" not in pages.main_text(broken, None)
    assert pages.main_text("<p>cut <b>off", None) == "cut off"
    assert pages.main_text("<a b='c>d", None) == ""
