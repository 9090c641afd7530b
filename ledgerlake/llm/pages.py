"""Main text of web pages by consensus of host paths.

1. Every page scores its containers: characters of text blocks outside links and outside menus,
   headers, footers, sidebars, notices, adverts, forms and comments go to the innermost
   container, added up per generalised path (tags and first classes from the root, digits off).
2. Pages vote per host, each with the shares of all its paths; the path with the largest sum
   leads. The containers around it are looked at in a second reading: what each adds to the one
   inside it is text of the article if it is more than links and not the same on all pages of the
   host, as a notice would be. The host's winner is the outermost container that
   adds such text, or the leading path itself.
3. Every page is read again: the text of the containers on its host's winning path. Pages
   without such a container, or without text in it, use their own best path.

So headlines, introductions and closing remarks beside the text column stay, and what every page
of a host repeats around it goes. A path inside an article or main element stands for that
element; nothing around it is taken in. Copies of one page say nothing about what a host repeats.

Containers are known by a hash of their path, made step by step, and everything is added up along
the tree, so a page costs time in proportion to its length, however deep it nests. Null html gives
an empty text, as does a page without text; html of any length is read whole. Unclosed and
misplaced tags are tolerated; a tag cut off by the end of the page is left out. Null urls, and urls
without a host, share one host. Rows that repeat a page vote and are read as often as they occur.
Ties go to the smaller hash. Columns of the pages may have any names but _main, _host and _path.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import broadcast_if_small, store, text_batches

SHARE = 1 << 30  # a page's whole vote

RAW = "script|style|noscript|template|svg|iframe|textarea|select|object|title|math|canvas|audio|video"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|$)|<({RAW})\b[^>]*>.*?(?:</\1\s*>|$)"
    r"|<(/?)([a-z][a-z0-9:-]*+)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-z][a-z0-9:-]*+)([^>]*)>|<[!?][^>]*>|<[a-z/!?][^>]*$", re.S | re.I)
ATTRIBUTE = re.compile(r"([a-z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

# Tags whose start and end separate blocks; the first group may also hold main text.
CONTAINERS = {"html", "body", "main", "article", "section", "div", "table", "tbody", "tr", "td", "center"}
BLOCKS = CONTAINERS | {
    "p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd", "pre", "blockquote", "figure",
    "figcaption", "hr", "address", "details", "summary", "th", "thead", "tfoot", "caption", "hgroup"}
# Elements that are never main text.
ASIDE = {"nav", "header", "footer", "aside", "form", "head", "button", "menu", "dialog", "fieldset", "label", "search"}
ASIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "menubar", "form"}
# Words of class names and ids that name such parts.
ASIDE_WORDS = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adbox", "banner", "breadcrumb", "breadcrumbs",
    "comment", "comments", "commentlist", "consent", "cookie", "cookies", "disqus", "footer", "header", "masthead", "menu",
    "menus", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "notification", "alert", "pager",
    "pagination", "popup", "promo", "promotion", "recommended", "related", "replies", "reply", "respond", "share",
    "sharing", "sidebar", "sidenav", "signup", "login", "social", "sponsor", "sponsored", "subscribe", "toolbar",
    "topbar", "widget", "widgets", "form", "search", "skip", "gdpr", "topnav", "sidemenu"}
WITHOUT = {"with", "has", "no", "without", "not"}
# Those that also occur in names of other things count only in names that say nothing else, or
# that end in them.
AMBIGUOUS = {
    "ad", "alert", "banner", "comment", "consent", "form", "header", "login", "menu", "notice", "notices", "notification",
    "promotion", "related", "reply", "respond", "search", "share", "skip", "social", "widget"}
PLACES = {
    "area", "articles", "bar", "block", "body", "bottom", "box", "button", "buttons", "center", "container", "content", "inner",
    "item", "items", "left", "links", "list", "main", "outer", "page", "panel", "posts", "region", "right", "row", "section",
    "site", "slot", "sticky", "top", "unit", "wrap", "wrapper"}
# Words of class names that name a whole article.
ARTICLE_WORDS = {"article", "post", "entry", "story"}


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(text)} if "=" in text else {}


def _names_aside(name: str) -> bool:
    words = re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower())
    for before, word in zip(["", *words], words, strict=False):
        if word in ASIDE_WORDS and before not in WITHOUT:
            if word not in AMBIGUOUS or word == words[-1] or all(w in ASIDE_WORDS or w in PLACES for w in words):
                return True
    return False


def _set_aside(tag: str, attributes: dict[str, str], bare: str) -> bool:
    if tag in ASIDE:
        return True
    if tag in ("html", "body"):
        return False
    if attributes.get("role", "").lower() in ASIDE_ROLES or attributes.get("aria-hidden") == "true":
        return True
    if re.search(r"display\s*:\s*none", attributes.get("style", "")) or re.search(r"(^|\s)hidden(\s|=|/|$)", bare):
        return True
    # Names of inline elements mark words of the text, not parts of the page.
    return tag in BLOCKS and any(map(_names_aside, (attributes.get("class", "") + " " + attributes.get("id", "")).split()))


class Container:
    """An open container: its step, the hash of its path, and the article or main element that it
    stands for: the outermost article (by tag or class) around it, or else the innermost main."""

    __slots__ = ("parent", "step", "key", "article", "main")

    def __init__(self, parent: Container | None, step: str):
        self.parent, self.step = parent, step
        self.key = _next_key(parent.key if parent else 0, step)
        tag = step.split(".")[0]
        named = tag == "article" or bool(ARTICLE_WORDS & set(re.findall(r"[a-z]+", step.lower())))
        self.article = (parent.article if parent else None) or (self if named else None)
        self.main = self if tag == "main" else parent.main if parent else None

    @property
    def whole(self) -> Container:
        return self.article or self.main or self

    @property
    def named(self) -> bool:
        return self.article is not None or self.main is not None

    def around(self) -> list[Container]:
        """This container and those around it, from the outermost."""
        chain, at = [], self
        while at is not None:
            chain.append(at)
            at = at.parent
        return chain[::-1]

    @property
    def path(self) -> str:
        return ">".join(c.step for c in self.around())


def _next_key(key: int, step: str) -> int:
    """64 bits, signed, of a path and its next step; the page itself is 0."""
    data = key.to_bytes(8, "little", signed=True) + step.encode("utf-8", "surrogatepass")
    return (zlib.crc32(data) << 32 | zlib.crc32(data[::-1], 0x5EED)) - (1 << 63)


def key_of(path: str) -> int:
    key = 0
    for step in path.split(">") if path else []:
        key = _next_key(key, step)
    return key


def _step(tag: str, attributes: dict[str, str]) -> str:
    first = attributes.get("class", "").split()[:1]
    return f"{tag}.{re.sub(r'[0-9]+', '', first[0])}" if first else tag


def blocks(html: str) -> Iterator[tuple[str, Container | None, int, int]]:
    """(text, innermost open container, characters outside links, all characters) of every block
    that isn't set aside, in page order."""
    stack: list[tuple[str, bool, Container | None]] = []  # tag, set aside, container
    inside: list[Container] = []
    opened: Counter = Counter()  # tags on the stack
    hidden = links = at = 0
    parts: list[str] = []
    plain = 0

    def block():
        nonlocal parts, plain
        text = " ".join("".join(parts).split())
        made = (text, inside[-1] if inside else None, plain, len(text) - text.count(" ")) if text else None
        parts, plain = [], 0
        return made

    def pieces():
        nonlocal at
        for m in TOKEN.finditer(html):
            yield html[at:m.start()], m
            at = m.end()
        yield html[at:], None

    for text, m in pieces():
        if text and not hidden:
            text = unescape(text)
            parts.append(text)
            if not links:
                plain += len(text) - text.count(" ")
        if m is None:
            break
        close, tag, attributes = (m[2], m[3], m[4]) if m[3] else (m[5], m[6], m[7])
        if not tag:
            continue
        tag = tag.lower()
        if tag == "a":
            links = max(0, links + (-1 if close else 1))
        elif tag == "br":
            parts.append(" ")
        if tag not in BLOCKS and tag not in ASIDE and not (hidden and not close):
            named = not close and attributes and ("class" in attributes or "id" in attributes or "hidden" in attributes)
            if not named and not any(s[0] == tag for s in stack[-1:]):
                continue
        if tag in BLOCKS or tag in ASIDE:
            links = 0
            if (made := block()) is not None:
                yield made
        if close:
            if opened[tag]:
                while True:
                    top, aside, container = stack.pop()
                    opened[top] -= 1
                    hidden -= aside
                    if inside and container is inside[-1]:
                        inside.pop()
                    if top == tag:
                        break
            continue
        if tag == "body":  # ends a head that was left open
            while stack and stack[-1][0] != "html":
                top, aside, _ = stack.pop()
                opened[top] -= 1
                hidden -= aside
        if attributes.rstrip().endswith("/") or tag in ("hr", "br", "img", "input", "meta", "link", "col", "wbr", "source"):
            continue
        own = _attributes(attributes)
        aside = _set_aside(tag, own, attributes)
        if aside:
            stack.append((tag, True, None))
            opened[tag] += 1
            hidden += 1
        elif tag in CONTAINERS:
            stack.append((tag, False, None))
            opened[tag] += 1
            if not hidden:
                inside.append(Container(inside[-1] if inside else None, _step(tag, own)))
                stack[-1] = (tag, False, inside[-1])
    if (made := block()) is not None:
        yield made


def own_votes(found: list[tuple]) -> dict[int, int]:
    """Shares of the page's characters outside links by the path they count for."""
    scores: Counter = Counter()
    for _, container, plain, _ in found:
        scores[container.whole.key if container else 0] += plain
    total = sum(scores.values())
    return {key: SHARE * n // total for key, n in scores.items() if n}


def best_paths(found: list[tuple], most: int) -> list[tuple[str, int]]:
    """(path, its vote), best first."""
    paths = {c.whole.key: c.whole.path for _, c, _, _ in found if c}
    ranked = sorted(own_votes(found).items(), key=lambda x: (-x[1], x[0]))
    return [(paths.get(key, ""), n) for key, n in ranked[:most]]


def levels(found: list[tuple], lead: int) -> list[tuple[int, int, int]]:
    """(steps from the root, path, digest of its text) of the path `lead` and of each container
    around it that adds text to the one inside it, other than blocks of links. An article or main
    element has none around it; pages without the path have no levels."""
    first = next((c.whole for _, c, _, _ in found if c and c.whole.key == lead), None)
    if first is None and lead != 0:
        return []
    named = first is not None and first.named
    place = {} if named else {0: 0}
    place |= {c.key: n + 1 for n, c in enumerate([first] if named else first.around() if first else [])}
    at: dict[int, int | None] = {}
    digest: dict[int, int] = {}
    for text, container, plain, total in found:
        seen, c = [], container
        while c is not None and id(c) not in at and c.key not in place:
            seen.append(c)
            c = c.parent
        level = place.get(0) if c is None else place[c.key] if c.key in place else at[id(c)]
        at |= dict.fromkeys(map(id, seen), level)
        if level is not None and 2 * plain > total:
            digest[level] = zlib.crc32(text.encode("utf-8", "surrogatepass"), digest.get(level, 0))
    keys = {n: key for key, n in place.items()}
    return [(n, keys[n], digest[n]) for n in sorted(digest)]


def best_path(found: list[tuple]) -> int | None:
    """The leading path of a page by itself."""
    votes = own_votes(found)
    return min(votes, key=lambda key: (-votes[key], key)) if votes else None


def best_container(found: list[tuple]) -> int | None:
    """The winner of a page by itself."""
    lead = best_path(found)
    return None if lead is None else next((key for _, key, _ in levels(found, lead)), lead)


def _inside(found: list[tuple], key: int) -> list[bool]:
    """Which blocks stand in a container of that path."""
    known: dict[int, bool] = {}
    held = []
    for _, container, _, _ in found:
        seen, c = [], container
        while c is not None and c.key != key and id(c) not in known:
            seen.append(c)
            c = c.parent
        there = c is not None and known.get(id(c), True)
        known |= dict.fromkeys(map(id, seen), there)
        held.append(there or key == 0)
    return held


def main_text(html: str | None, winner: int | str | None) -> str:
    """The text in the containers on the winning path (a path or its hash), or in the page's own
    best ones. Blocks of links count only inside the page's leading path."""
    found = list(blocks(html)) if html else []
    winner = key_of(winner) if isinstance(winner, str) else winner
    held = _inside(found, winner) if winner is not None else []
    if not any(held):
        own = best_container(found)
        held = _inside(found, own) if own is not None else [False] * len(found)
    lead = best_path(found)
    beside = _inside(found, lead) if lead is not None else held
    return " ".join(text for (text, _, plain, total), here, near in zip(found, held, beside, strict=True)
                    if here and (near or 2 * plain > total))


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1), F.lit("")))


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Stored: host and the hash of its winning path."""
    text_batches(pages.sparkSession)
    rows = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html")).where("html is not null")

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own: Counter = Counter()
            for host, html in zip(batch["host"], batch["html"], strict=True):
                for key, n in own_votes(list(blocks(html))).items():
                    own[host, key] += n
            yield pd.DataFrame([(*k, n) for k, n in own.items()], columns=["host", "path", "own"])

    def look_around(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for host, html, lead in zip(batch["host"], batch["html"], batch["lead"], strict=True):
                page = zlib.crc32(html.encode("utf-8", "surrogatepass"))
                out += [(host, *level, page) for level in levels(list(blocks(html)), int(lead))]
            yield pd.DataFrame(out, columns=["host", "steps", "path", "digest", "page"])

    sums = rows.mapInPandas(vote, "host string, path long, own long").groupBy("host", "path").agg(F.sum("own").alias("own"))
    leads = store(sums.groupBy("host").agg(F.min(F.struct((-F.col("own")).alias("less"), "path"))["path"].alias("lead")), "leads")
    around = rows.join(broadcast_if_small(leads), "host").mapInPandas(
        look_around, "host string, steps int, path long, digest long, page long")
    # A level that several different pages have, with the same text on all, is a notice of the host.
    own = around.groupBy("host", "steps", "path").agg(
        F.min("digest").alias("d1"), F.max("digest").alias("d2"), F.min("page").alias("p1"), F.max("page").alias("p2"))
    winners = own.where((F.col("d1") != F.col("d2")) | (F.col("p1") == F.col("p2"))).groupBy("host").agg(
        F.min(F.struct("steps", "path"))["path"].alias("path"))
    return store(leads.join(winners, "host", "left").select("host", F.coalesce("path", "lead").alias("path")), "host-paths")


def with_main_text(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """`pages` (all columns) with _main: the main text."""
    winners = host_paths(pages, url_col, html_col).toDF("_host", "_path")

    @F.pandas_udf("string")
    def extract(html: pd.Series, path: pd.Series) -> pd.Series:
        return pd.Series([main_text(h, None if p is None or p != p else int(p)) for h, p in zip(html, path, strict=True)], dtype=object)

    own = [pages[c] for c in pages.columns]
    return pages.join(broadcast_if_small(winners), host_of(pages[url_col]) == winners["_host"], "left").select(
        *own, extract(pages[html_col], winners["_path"].cast("string")).alias("_main"))
