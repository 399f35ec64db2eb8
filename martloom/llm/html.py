"""Main text of web pages from flat text blocks.

A page is cut into text blocks at block-level tags. Each block has its word count and the share of its
words inside links, the same of the blocks before and after it, and whether it stands in an article
or in a container whose tag, class, id or role names something else. Such a container counts as the
article after all if it holds the page's title or most of its words. A decision tree fitted on the
blocks of the small labelled pages below says which blocks are main text.
"""

from __future__ import annotations

import functools
import html as entities
import random
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from martloom.llm import tree
from martloom.llm.runtime import map_batches

MARK = re.compile(r"<(?=[!?/a-zA-Z])")
NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
NAMED = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)(?=[\s/>])")
QUOTE_OR_END = re.compile(r"[\"'>]")
ATTRIBUTE = re.compile(r"([^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?")
#: What stands in the attributes of every hidden element, and of others too.
MAYBE_HIDDEN = re.compile(r"hidden|display", re.I)
DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*([a-z-]+)", re.I)

#: Elements whose content is not shown as text.
SKIPPED = {"script", "style", "noscript", "template", "iframe", "svg", "math", "object", "textarea", "select", "canvas", "audio", "video", "title"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead tr ul button label option".split()
)
#: Tags, and words in class, id and role, of what is not the article.
BOILER_TAGS = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "label", "head", "option"}
BOILER_WORDS = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices alert popup modal overlay sidebar aside side rail widget menu nav navbar navigation "
    "breadcrumb breadcrumbs toolbar tabs footer header masthead comment comments commentlist disqus reply replies "
    "respond discussion share sharing social related recommended recommendations subscribe subscription newsletter "
    "signup login search form copyright legal pagination pager complementary contentinfo dialog tags".split()
)
#: Words that may stand beside one of them in a name; a name with any other word says nothing ("has-sidebar", "related-work").
PLAIN_WORDS = set("area bar block body bottom box container content inner item items left links list main outer page post right section site the top wrap wrapper".split())
COMMENT_WORDS = {"comment", "comments", "commentlist", "disqus", "reply", "replies", "respond", "discussion"}
ARTICLE_TAGS = {"article", "main"}
#: Tags that are never the article, whatever they hold.
NEVER_TAGS = BOILER_TAGS - {"header", "form"}
#: Unlinked words that stand beside a page's first h1 in a container that holds the article.
BESIDE_TITLE = 20

FEATURES = (
    "words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after", "in_article",
    "in_boilerplate",
)


def attributes_of(raw: str) -> dict[str, str]:
    """Values by lower-case name, "" for an attribute without one; of a name that comes twice the first."""
    found: dict[str, str] = {}
    for a in ATTRIBUTE.finditer(raw):
        found.setdefault(a.group(1).lower(), a.group(2) or a.group(3) or a.group(4) or "")
    return found


def hidden(raw: str) -> bool:
    """Whether attributes hide their element: hidden, aria-hidden=true or a style whose last display is none."""
    if not MAYBE_HIDDEN.search(raw):
        return False
    found = attributes_of(raw)
    shown = DISPLAY.findall(found.get("style", ""))
    return "hidden" in found or found.get("aria-hidden", "").strip().lower() == "true" or bool(shown) and shown[-1].lower() == "none"


class Scanner:
    """Tags of a page, in time in proportion to its length whatever is left open in it."""

    def __init__(self, page: str):
        self.page = page
        self.last = page.rfind(">")
        self.lost: set[int] = set()  # quotes after which no tag ends
        self.ends: dict[int, int] | None = None
        self.never: set[str] = set()

    def tag_end(self, at: int) -> int:
        """The ``>`` that ends a tag, quoted ones apart; -1 if a quote stays open."""
        met = []
        while (found := QUOTE_OR_END.search(self.page, at)) is not None:
            i = found.start()
            if found.group() == ">":
                return i
            if i in self.lost:
                break
            met.append(i)
            j = self.page.find(found.group(), i + 1)
            if j < 0:
                break
            at = j + 1
        self.lost.update(met)
        return -1

    def next(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """Start, end, whether it closes, lower-case name and attributes of the next tag; other markup has no name."""
        found = MARK.search(self.page, at)
        if found is None:
            return None
        start = found.start()
        if start > self.last:  # only a comment may stay open
            start = self.page.find("<!--", start)
            if start < 0:
                return None
        if self.page.startswith("<!--", start):
            stop = self.page.find("-->", start + 4)
            return start, len(self.page) if stop < 0 else stop + 3, False, "", ""
        named = NAME.match(self.page, start)
        if named:
            stop = self.tag_end(named.end())
            if stop >= 0:
                return start, stop + 1, bool(named.group(1)), named.group(2).lower(), self.page[named.end() : stop]
        return start, self.page.find(">", start) + 1, False, "", ""

    def element_end(self, start: int) -> int | None:
        """Where the element that opens at ``start`` is closed: by as many of its kind as were opened."""
        if self.ends is None:
            self.ends, opened = {}, {}
            for tag in NAMED.finditer(self.page):
                stack = opened.setdefault(tag.group(2).lower(), [])
                if not tag.group(1):
                    stack.append(tag.start())
                elif stack:
                    self.ends[stack.pop()] = tag.start()
        return self.ends.get(start)

    def closed(self, name: str, at: int) -> int | None:
        """The next closing tag of a name."""
        if name in self.never:
            return None
        found = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(self.page, at)
        if found is None:
            self.never.add(name)
        return found and found.start()


def names_of(attributes: str) -> set[str]:
    """Words of the class names, id and role that consist of words for what is not the article, plain words and numbers."""
    named, found = attributes_of(attributes), set()
    for a in ("class", "id", "role"):
        for name in named.get(a, "").lower().split():
            words = {w for w in re.split(r"[^a-z]+", name) if w}
            if words & BOILER_WORDS and words <= BOILER_WORDS | PLAIN_WORDS:
                found |= words & BOILER_WORDS
    return found


class Containers:
    """Block elements of a page as a tree, and what each of them holds."""

    def __init__(self) -> None:
        # parent; article; boilerplate: 0 no, 1 unless it holds the article, 2 in any case; comments
        self.kinds: list[tuple[int, bool, int, bool]] = [(0, False, 0, False)]
        self.stack: list[tuple[str, int]] = [("", 0)]
        self.names: dict[str, int] = {}

    def push(self, name: str, article: bool, boiler: int, comments: bool) -> None:
        self.kinds.append((self.stack[-1][1], article, boiler, comments))
        self.stack.append((name, len(self.kinds) - 1))
        self.names[name] = self.names.get(name, 0) + 1

    def close(self, name: str) -> None:
        while self.names.get(name):
            closed = self.stack.pop()[0]
            self.names[closed] -= 1
            if closed == name:
                break

    def here(self) -> int:
        return self.stack[-1][1]

    def judge(self, where: list[int], unlinked: list[int], title: int | None) -> list[tuple[bool, bool]]:
        """For each container whether it is in an article, and in boilerplate.

        ``where`` has the container of each block, ``unlinked`` its words outside links, ``title`` is the
        block of the first h1. A container named as boilerplate is none if it holds the h1 with BESIDE_TITLE
        more words, or more than half of the words, and no article or main has words outside of it.
        """
        n = len(self.kinds)
        held, articles, titled = [0] * n, [0] * n, [False] * n
        inside = [False] * n
        commented = [False] * n
        for i in range(1, n):
            parent, article, _, comments = self.kinds[i]
            commented[i] = commented[parent] or comments
            inside[i] = inside[parent] or article
        for at, words in zip(where, unlinked):
            held[at] += words
            articles[at] += words if inside[at] and not commented[at] else 0
        if title is not None:
            titled[where[title]] = True
        for i in range(n - 1, 0, -1):
            parent = self.kinds[i][0]
            held[parent] += held[i]
            articles[parent] += articles[i]
            titled[parent] = titled[parent] or titled[i]
        beside = BESIDE_TITLE + (unlinked[title] if title is not None else 0)
        out, inner, outer = [(False, False)], [False] * n, [False] * n
        for i in range(1, n):
            parent, article, kind, _ = self.kinds[i]
            holds = articles[i] == articles[0] and (titled[i] and held[i] >= beside or 2 * held[i] > held[0])
            boiler = kind == 2 or kind == 1 and not holds
            inner[i] = boiler or inner[parent] and not article
            outer[i] = outer[parent] or boiler
            out.append((False, outer[i]) if commented[i] else (inside[i], inner[i]))
        return out


def blocks(page: str | None) -> list[tuple[str, int, float, bool, bool]]:
    """Text, word count, link density, in an article, in boilerplate: for each block that has text."""
    if not page:
        return []
    found: list[tuple[str, int, int]] = []
    where: list[int] = []
    title: int | None = None
    open_, tags = Containers(), Scanner(page)
    text: list[str] = []
    links = [0]
    in_link = False

    def flush() -> None:
        words = "".join(text).split()
        text.clear()
        if words:
            found.append((" ".join(words), len(words), min(links[0], len(words))))
            where.append(open_.here())
        links[0] = 0

    def say(piece: str) -> None:
        piece = entities.unescape(piece)
        text.append(piece)
        if in_link:
            links[0] += len(piece.split())

    at, end = 0, len(page)
    while at < end:
        token = tags.next(at)
        if token is None:
            say(page[at:])
            break
        start, stop, closing, name, attributes = token
        if start > at:
            say(page[at:start])
        at = stop
        if not name:
            continue
        if not closing and (name in SKIPPED or name not in VOID and hidden(attributes)):
            if name not in SKIPPED:  # a hidden element that is not closed hides nothing
                at = max(at, tags.element_end(start) or at)
            elif not attributes.endswith("/"):
                over = tags.closed(name, at)
                at = over if over is not None else (end if name in ("script", "style") else at)
            if name in BLOCK:
                flush()
            continue
        if name == "br":
            text.append(" ")
        if name == "a":
            in_link = not closing
        if name not in BLOCK:
            continue
        flush()
        in_link = False
        if name == "h1" and title is None and not closing:
            title = len(found)
        if closing:
            open_.close(name)
        elif name not in VOID and name != "p":
            words = names_of(attributes) if name not in ("body", "html") else set()
            comments = bool(words & COMMENT_WORDS)
            article = name in ARTICLE_TAGS and not comments
            never = comments or not article and name in NEVER_TAGS
            open_.push(name, article, 2 if never else int(not article and (name in BOILER_TAGS or bool(words))), comments)
    flush()
    judged = open_.judge(where, [n - linked for _, n, linked in found], title if title is not None and title < len(found) else None)
    return [(text, n, linked / n, *judged[at]) for (text, n, linked), at in zip(found, where)]


def features(found: list[tuple[str, int, float, bool, bool]]) -> np.ndarray:
    """A row of FEATURES for each block; beside the first and last block stand blocks without words."""
    rows = np.zeros((len(found), len(FEATURES)))
    for i, (_, words, density, inside, boiler) in enumerate(found):
        before, after = found[i - 1] if i else ("", 0, 0.0), found[i + 1] if i + 1 < len(found) else ("", 0, 0.0)
        rows[i] = (words, density, before[1], before[2], after[1], after[2], inside, boiler)
    return rows


#: Labelled pages made by rule that the tree is fitted on.
ARRANGED = 600

_LONG = "Some words about the matter of the day, which go on for a while so that the paragraph has a good length, as they do."
#: Labelled pages: the markup, with <k> around each block that is main text.
LABELLED = (
    f"<nav><ul><li><a>Home</a></li><li><a>News</a></li></ul></nav><div class=ad>Buy now.</div><article><h1><k>Title of it</h1><p><k>{_LONG}</p><p><k>Short.</p><p><k>{_LONG}</p></article><footer>Copyright us. All rights are kept by us.</footer>",
    f"<header><p>{_LONG}</p></header><article><h1><k>One</h1><p><k>Yes.<p><k>No word.</article><aside><p>{_LONG}</p></aside><footer>{_LONG}</footer>",
    f"<div class='cookie notice'>{_LONG}</div><main><h2><k>Head line</h2><p><k>{_LONG}</p><ul><li><k>First of all</li><li><k>Then that</li></ul><p><k><a>A link alone</a></p><form><p>Write to us {_LONG}</p></form></main>",
    f"<article><p><k>{_LONG}</p><div class=ad>{_LONG}</div><p><k>And so on.</p><section id=comments><p>{_LONG}</p><p>I agree.</p></section></article><div id=sidebar><p>{_LONG}</p><p>More</p></div>",
    f"<article><p><k><a>Two</a></p><p><k><a>link only {_LONG}</a></p><blockquote><k>Said so.</blockquote></article><nav><p>{_LONG}</p></nav><form><p>{_LONG}</p></form>",
    f"<div><a>Home</a></div><div><a>News of today</a></div><div><h1><k>A title here</h1><p><k>{_LONG}</p><p><k>{_LONG}</p></div><div><a>Next page</a> <a>Last</a></div>",
    f"<div><p><k>{_LONG}</p><p><k>{_LONG} {_LONG}</p><p><k>{_LONG}</p></div><div><a>{_LONG}</a></div><div><a>Imprint</a></div>",
    f"<ul><li><a>One</a></li><li><a>Two of them</a></li><li><a>Three</a></li></ul><p><k>{_LONG}</p><p><k>{_LONG}</p>",
    f"<section class=comments><article><p>{_LONG}</p></article><article><p>Me too.</p></article></section><footer><a>Us</a></footer><div class='ad banner'><p>{_LONG}</p></div>",
    f"<article><p><k>A.</p></article><article><p><k>{_LONG} <a>with a link</a></p></article><div class=promo>{_LONG}</div><div class=newsletter>Sign up.</div>",
)


def arranged(number: int) -> str:
    """A labelled page of a layout that ``number`` decides, many of them without an article element."""
    r = random.Random(number)
    vocabulary = _LONG.replace(",", "").replace(".", "").split()

    def say(least: int, most: int) -> str:
        return " ".join(r.choice(vocabulary) for _ in range(r.randint(least, most)))

    def linked(least: int, most: int) -> str:
        return f"<a href=/x>{say(least, most)}</a>"

    def listed() -> str:
        return "<ul>" + "".join(f"<li>{linked(1, 6)}</li>" for _ in range(r.randint(2, 9))) + "</ul>"

    def bar() -> str:
        return "<div>" + " | ".join(linked(1, 2) for _ in range(r.randint(2, 5))) + "</div>"

    def line() -> str:
        return f"<div>{say(1, 6)}</div>"

    def teaser() -> str:
        return f"<div>{linked(3, 9)}</div><div>{say(6, 14)}</div>" * r.randint(2, 4)

    def single() -> str:
        return f"<div>{linked(1, 6)}</div>" * r.randint(1, 3)

    around = [listed, bar, single, lambda: bar() + line() + listed(), lambda: line() + bar(), lambda: listed() + line() + bar(), teaser]

    def boiler() -> str:
        tag = r.choice(["footer", "header", "aside", "nav", "form", f"div class={r.choice(named)}"])
        inside = "".join(r.choice([lambda: f"<p>{say(1, 60)}</p>", lambda: say(1, 60), listed, bar, line])() for _ in range(r.randint(1, 3)))
        return f"<{tag}>{inside}</{tag.split()[0]}>"

    named = ["sidebar", "related", "share", "newsletter", "cookie-notice", "ad", "comments", "site-footer"]
    wrap = r.choice(["<article>%s</article>", "<div class='content has-sidebar'>%s</div>", "<main>%s</main>", "%s", "<div>%s</div>", "<section id=post>%s</section>"])
    marked = wrap.startswith(("<article", "<main"))  # then any block inside is text, short and linked ones too
    paragraphs = [f"<p><k>{linked(1, 20)}</p>" if r.random() < 0.2 else f"<p><k>{say(1, 30)}</p>" for _ in range(marked * r.randint(0, 6))]
    for _ in range(r.randint(3, 9)):
        kind = r.random()
        if kind < 0.6:
            paragraphs.append(f"<p><k>{say(18, 90)}</p>")
        elif kind < 0.75:
            paragraphs.append(f"<p><k>{say(15, 40)} {linked(1, 4)} {say(5, 30)}</p>")
        elif kind < 0.85:
            paragraphs.append(f"<h2><k>{say(2, 7)}</h2><p><k>{say(20, 60)}</p>")
        elif kind < 0.93:
            paragraphs.append(f"<p><k>{say(8, 16)}</p><pre><k>{say(3, 40)}</pre><p><k>{say(15, 50)}</p>")
        else:
            paragraphs.append(boiler())
    r.shuffle(paragraphs)
    if marked:
        text = f"<h1><k>{say(1, 9)}</h1>" + "".join(paragraphs)
    else:
        text = f"<h1><k>{say(2, 9)}</h1><p><k>{say(20, 60)}</p>" + "".join(paragraphs) + f"<p><k>{say(12, 50)}</p>"
    before, after = ([r.choice([boiler, r.choice(around)])() for _ in range(r.randint(0, 3))] for _ in range(2))
    page = "".join(before) + wrap.replace("%s", text) + "".join(after)
    return f"<form id=aspnet>{page}</form>" if r.random() < 0.2 else page


def labelled(pages: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of the blocks of labelled pages, and which are main text."""
    rows, kept = [], []
    for page in pages:
        found = blocks(page.replace("<k>", "\x02"))
        rows.append(features(found))
        kept += [t.startswith("\x02") for t, *_ in found]
    return np.vstack(rows), np.array(kept, float)


@functools.cache
def model() -> tree.Node:
    """The tree fitted on the pages above and ARRANGED pages by rule; always the same."""
    return tree.fit(*labelled([*LABELLED, *map(arranged, range(ARRANGED))]), depth=8, least=1)


def main_text(pages: list[str | None], node: tree.Node) -> list[str]:
    """Main text of each page, its blocks joined by line feeds."""
    found = [blocks(p) for p in pages]
    rows = [features(f) for f in found]
    keep = tree.predict(node, np.vstack(rows)) > 0.5 if any(map(len, rows)) else np.zeros(0, bool)
    out, at = [], 0
    for f in found:
        out.append("\n".join(b[0] for b, k in zip(f, keep[at : at + len(f)]) if k))
        at += len(f)
    return out


def extract(pages: DataFrame, id_column: str = "page_id", html_column: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """Main text of every page: the id, the columns of ``keep``, text and n_chars (code points).

    A null or empty page and a page without main text have the empty text. Repeated rows each give a
    row; columns not named do not matter.
    """
    node = model()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = main_text(batch.column(batch.num_columns - 1).to_pylist(), node)
        columns = [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "text", "n_chars"])

    kept = [F.col(c) for c in (id_column, *keep)]
    rows = pages.select(*kept, F.col(html_column).alias("__html"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return map_batches(rows, run, f"{schema}, text string, n_chars bigint")


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
