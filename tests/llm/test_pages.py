"""Main text of generated pages: every word of the article, and none of what stands around it."""

import random
import time

import pytest

pytest.importorskip("public_tokenizers")

from ledgerlake.llm import pages  # noqa: E402

ASIDES = ["<nav><a href='/'>zzhome</a></nav>", "<div class='cookie-notice'>zzcookies</div>", "<footer>zzimprint</footer>",
          "<div id='sidebar-left'><p>zzside</p></div>", "<form><p>zzform</p></form>", "<div class='post-comments'><p>zzcomment</p></div>",
          "<script>zzscript</script>", "<!-- zzremark -->", "<section role='complementary'>zzmore</section>", "<div class='ad'>zzad</div>"]


def page(rng, host_style, number):
    """An article with a headline, an introduction and a closing remark in containers of their own."""
    def words(n):
        return " ".join(f"w{number}x{rng.randrange(10**6)}" for _ in range(n))

    parts = [words(rng.randint(1, 6)) for _ in range(4)] + [words(rng.randint(30, 90))]
    head, intro, more, close, body = parts
    middle = "".join(f"<p>{p} <span class='search-term'>{words(1)}</span></p>" for p in [body, words(20)])
    article = [f"<h1>{head}</h1>", f"<div class='intro{number}'><p>{intro}</p></div>", f"<div class='{host_style}'>{middle}</div>",
               f"<div class='notice-period'><p>{more}</p></div>", f"<div class='more'>{close}</div>"]
    noise = [a.format(number) for a in rng.sample(ASIDES, 5)]
    links = "<div class='row'><a href='/a'>zzlink zzlink</a> <a href='/b'>zzlink</a></div>"
    same = "<div class='col'><p>zzsame on all pages of the host</p></div>"
    text = " ".join("".join(article).replace("</p>", " </p>").replace("<", " <").split())
    plain = " ".join(w for w in pages.re.sub(r"<[^>]*>", " ", text).split())
    return f"<html><body>{noise[0]}{noise[1]}<div class='wrap'>{''.join(article)}</div>{noise[2]}{links}{same}{noise[3]}{noise[4]}</body></html>", plain


def test_generated_pages(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for host in range(5):
        for n in range(6):
            html, text = page(rng, f"body-{host}", 10 * host + n)
            rows.append((10 * host + n, f"https://h{host}.example/{n}", html))
            want[10 * host + n] = text
    rows += [(100, rows[0][1], rows[0][2]), (101, "https://empty.example", ""), (102, None, None)]
    want |= {100: want[0], 101: "", 102: ""}
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "'x' AS lead", "1 AS steps", "'h' AS host", "'p' AS path").repartition(4)
    got = {r["page_id"]: r["_main"] for r in pages.with_main_text(df).collect()}
    assert got == want


def test_copies_of_one_page_keep_their_headline(spark):
    html = "<html><body><h1>Headline here</h1><div class='t'><p>" + "long text " * 40 + "</p></div></body></html>"
    df = spark.createDataFrame([(i, "http://c.example/", html) for i in range(5)], "page_id long, url string, html string")
    assert {r["_main"] for r in pages.with_main_text(df).collect()} == {"Headline here " + " ".join(["long text"] * 40)}


def test_names():
    aside = pages._names_aside
    assert all(map(aside, ["notice", "cookie-notice", "site-header", "header-top", "searchBox", "sidebar-xyz", "ad-slot-1", "nav"]))
    assert not any(map(aside, ["notice-period", "search-term", "header-image-caption", "with-sidebar", "form-of-life", "padding"]))


@pytest.mark.parametrize("depth", [5000, 20000])
def test_deep_pages(depth):
    start = time.monotonic()
    html = "<html><body>" + "".join(f"<div class='c'>w{i} " for i in range(depth)) + "</body></html>"
    assert pages.main_text(html, None) == " ".join(f"w{i}" for i in range(depth))
    closed = "<div><p>x</p>" * depth + "</div>" * depth
    assert pages.main_text(closed, None) == " ".join(["x"] * depth)
    assert time.monotonic() - start < 20


def test_key_is_that_of_the_path():
    found = list(pages.blocks("<html><body><div class='a1 b'><section>x</section></div></body></html>"))
    assert found[0][1].path == "html>body>div.a>section" and found[0][1].key == pages.key_of(found[0][1].path)
