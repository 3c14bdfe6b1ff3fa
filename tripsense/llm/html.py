"""Main text of web pages: boosted trees judge the blocks of the page's tree, and a decoding makes the judgements agree.

Every block element gets features of its subtree (text, links, density), of its attribute tokens and those above it, of its
depth and of its siblings. Boosted trees turn them into log odds of being, or holding, main text. The decoding keeps the
set of blocks with the largest sum of log odds among those sets in which a kept block's parent is kept too.

No table says what the main text of a page is, so the trees are fitted on pages that are built for it: layouts in many
variants, filled with paragraphs of a bounded sample of the given pages, in which the right answer is known.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripsense.llm import boosting
from tripsense.llm.common import batch

# The layouts are filled from at most so many pages, those with the smallest hashes, and so much of each.
SAMPLE_PAGES = 200
SAMPLE_CHARS = 20_000
LAYOUTS = 500
SEED = 11
PAGES_AT_ONCE = 64

# Fixed values of the HTML language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset(
    "script style template noscript svg iframe head title select option optgroup textarea button datalist".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr br img input math object audio video canvas".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr "
    "main menu nav ol p pre section table ul".split()
)
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "body": ({"head"}, {"html"}),
}
# Words in ids, classes and roles that tell what a block is for.
ASIDE_WORDS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead footer sidebar side aside widget related recommended more "
    "ad ads advert advertisement adsense adslot banner promo promotion sponsor sponsored cookie cookies consent gdpr notice alert popup "
    "modal overlay newsletter subscribe signup login search form social share sharing comment comments commentlist disqus reply replies "
    "respond discussion pagination pager tags copyright legal toolbar skip complementary contentinfo search dialog".split()
)
MAIN_WORDS = frozenset("article articlebody content main maincontent post entry story body text prose hentry".split())
ASIDE_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HASHED_TOKENS = 16

_TOKEN = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Tree(HTMLParser):
    """Elements of a page with their texts; open elements close as HTML's optional end tags demand."""

    def __init__(self, page: str):
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.tokens, self.hidden, self.marks = ["#"], [-1], [()], [False], [None]
        # Element and text; None where the element begins, False where a block in it has ended.
        self.flow: list[tuple[int, str | bool | None]] = []
        self.open = [0]
        # How often each tag is open, so that no search starts that cannot end well.
        self.opened: Counter[str] = Counter()
        self.met: set[str] = set()
        self.feed(page)
        self.close()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("html", "body") and tag in self.met:
            return
        self.met.add(tag)
        if tag in CLOSES_P:
            self._close_up_to({"p"}, {"button", "caption", "object", "table", "td", "template", "th"})
        if tag in CLOSES:
            self._close_up_to(*CLOSES[tag])
        held = {k: v or "" for k, v in attrs}
        named = " ".join(held.get(k, "") for k in ("class", "id", "role", "itemprop"))
        self.tags.append(tag)
        self.parents.append(self.open[-1])
        self.tokens.append(tuple(_TOKEN.findall(_CAMEL.sub(" ", named).lower())))
        self.hidden.append("hidden" in held or held.get("aria-hidden") == "true" or "display:none" in held.get("style", "").replace(" ", ""))
        self.marks.append(held.get("data-y"))
        number = len(self.tags) - 1
        self.flow.append((number, None))
        if tag not in VOID:
            self.open.append(number)
            self.opened[tag] += 1

    def handle_endtag(self, tag: str) -> None:
        if not self.opened[tag]:
            return
        while self._close_last() != tag:
            pass
        if tag not in INLINE and tag not in DROPPED:
            self.flow.append((self.open[-1], False))

    def _close_last(self) -> str:
        tag = self.tags[self.open.pop()]
        self.opened[tag] -= 1
        return tag

    def handle_data(self, data: str) -> None:
        self.flow.append((self.open[-1], data))

    def _close_up_to(self, tags: set[str], stop: set[str]) -> None:
        if not any(self.opened[tag] for tag in tags):
            return
        for at in range(len(self.open) - 1, 0, -1):
            if self.tags[self.open[at]] in tags:
                while len(self.open) > at:
                    self._close_last()
                return
            if self.tags[self.open[at]] in stop:
                return


class Page:
    """A tree reduced to its blocks. Inline elements belong to the block around them; ``parent[b] < b``."""

    def __init__(self, page: str):
        tree = Tree(page)
        count = len(tree.tags)
        block, gone = [0] * count, [False] * count
        link = [False] * count
        self.parent, self.element = [-1], [0]
        for n in range(1, count):
            up = tree.parents[n]
            gone[n] = gone[up] or tree.tags[n] in DROPPED or tree.hidden[n]
            link[n] = link[up] or tree.tags[n] == "a"
            if tree.tags[n] in INLINE or gone[n]:
                block[n] = block[up]
            else:
                block[n] = len(self.parent)
                self.parent.append(block[up])
                self.element.append(n)
        self.tree = tree
        blocks = len(self.parent)
        self.own, self.linked, self.marks_in = [0] * blocks, [0] * blocks, [0] * blocks
        self.controls = [0] * blocks
        self.flow: list[tuple[int, str | None]] = []
        for n, text in tree.flow:
            if gone[n]:
                if tree.tags[n] in ("button", "select", "textarea"):
                    self.controls[block[n]] += text is None
                continue
            if text is None:
                if tree.tags[n] == "br":
                    self.flow.append((block[n], " "))
                elif tree.tags[n] == "input":
                    self.controls[block[n]] += 1
                elif tree.tags[n] not in INLINE:
                    self.flow.append((block[n], None))
                continue
            if text is False:
                self.flow.append((block[n], None))
                continue
            size = len(text) - text.count(" ")
            self.own[block[n]] += size
            self.linked[block[n]] += size * link[n]
            self.marks_in[block[n]] += sum(map(text.count, ".,;?!"))
            self.flow.append((block[n], text))

    def features(self) -> list[list[float]]:
        tree, blocks = self.tree, len(self.parent)
        chars, linked, marks, controls = list(self.own), list(self.linked), list(self.marks_in), list(self.controls)
        below, paragraphs, children = [1] * blocks, [0] * blocks, [0] * blocks
        same: dict[tuple[int, str], int] = {}
        order = [0] * blocks
        for b in range(1, blocks):
            up = self.parent[b]
            order[b] = children[up]
            children[up] += 1
            tag = tree.tags[self.element[b]]
            same[up, tag] = same.get((up, tag), 0) + 1
            paragraphs[up] += tag == "p"
        for b in range(blocks - 1, 0, -1):
            up = self.parent[b]
            for total in (chars, linked, marks, controls, below):
                total[up] += total[b]
        depth, aside_above, main_above = [0] * blocks, [0] * blocks, [0] * blocks
        rows = []
        for b in range(blocks):
            up, n = self.parent[b], self.element[b]
            tag, tokens = tree.tags[n], tree.tokens[n]
            aside = sum(t in ASIDE_WORDS for t in tokens) + (tag in ASIDE_TAGS)
            main = sum(t in MAIN_WORDS for t in tokens) + (tag in ("article", "main"))
            if b:
                depth[b] = depth[up] + 1
                aside_above[b], main_above[b] = aside_above[up], main_above[up]
            hashed = [0.0] * HASHED_TOKENS
            for token in tokens:
                hashed[zlib.crc32(token.encode()) % HASHED_TOKENS] = 1.0
            rows.append([
                depth[b], chars[b] ** 0.5, linked[b] / (chars[b] + 1), below[b] ** 0.5, (chars[b] / below[b]) ** 0.5,
                (self.own[b]) ** 0.5, marks[b] / (chars[b] + 1), paragraphs[b], children[b], controls[b],
                children[up] if b else 0, same.get((up, tag), 0), order[b] / max(1, children[up]) if b else 0,
                chars[b] / (chars[0] + 1), chars[up] / (chars[0] + 1) if b else 1, chars[b] / (chars[up] + 1) if b else 1,
                aside, main, aside_above[b], main_above[b], tag in ASIDE_TAGS, tag == "header", tag in HEADINGS, tag == "p",
                tag in ("ul", "ol", "li", "dl", "dt", "dd"), tag in ("div", "section"), tag in ("table", "tbody", "tr", "td", "th"),
                linked[up] / (chars[up] + 1) if b else 0, *hashed,
            ])
            aside_above[b] += aside
            main_above[b] += main
        return rows

    def decode(self, odds: np.ndarray) -> list[bool]:
        """The best set of blocks that holds the parents of all its blocks; the page itself is always in it."""
        best = odds.tolist()
        for b in range(len(best) - 1, 0, -1):
            if best[b] > 0:
                best[self.parent[b]] += best[b]
        kept = [True] * len(best)
        for b in range(1, len(best)):
            kept[b] = kept[self.parent[b]] and best[b] > 0
        return kept

    def text(self, kept: list[bool]) -> str:
        """Texts of kept blocks, white space as one space, a line each."""
        lines: list[str] = []
        held: list[str] = []
        last = 0

        def flush():
            line = " ".join("".join(held).split())
            if line:
                lines.append(line)
            held.clear()

        for b, text in self.flow:
            if b != last or text is None:
                flush()
                last = b
            if text is not None and kept[b]:
                held.append(text)
        flush()
        return "\n".join(lines)

    def text_of_all(self) -> str:
        return self.text([True] * len(self.parent))

    def labels(self) -> list[bool]:
        """For built pages: blocks under the mark for main text, and all above these."""
        blocks = len(self.parent)
        own: list[str] = ["0"] * blocks
        for b in range(1, blocks):
            own[b] = self.tree.marks[self.element[b]] or own[self.parent[b]]
        right = [o == "1" for o in own]
        for b in range(blocks - 1, 0, -1):
            right[self.parent[b]] |= right[b]
        return right


class Layouts:
    """Pages in many layouts around given paragraphs; ``data-y`` marks what is main text (1) and what is not (0)."""

    def __init__(self, paragraphs: list[str], seed: int = SEED):
        self.rng = random.Random(seed)
        self.paragraphs = paragraphs

    def words(self, least: int, most: int) -> str:
        many = self.rng.choice(self.paragraphs).split() or ["word"]
        start = self.rng.randrange(len(many))
        return _shown(" ".join(many[start : start + self.rng.randint(least, most)]))

    def paragraph(self) -> str:
        return _shown(self.rng.choice(self.paragraphs)) if self.rng.random() < 0.6 else self.words(2, 40)

    def links(self, least: int = 3, most: int = 9) -> str:
        items = [f'<li><a href="/x">{self.words(1, 3)}</a></li>' for _ in range(self.rng.randint(least, most))]
        return f"<ul>{''.join(items)}</ul>"

    def wrap(self, tags: list[str], names: list[str], inner: str, mark: int) -> str:
        """An element that says what it is by its tag, by a name, or by both."""
        tag = self.rng.choice(tags)
        named = tag in ("div", "section", "ol") or self.rng.random() < 0.5
        kind = self.rng.choice(["class", "class", "id"])
        extra = self.rng.choice(["", "", " box", " col-4", " wrap", " clearfix"]) if kind == "class" else ""
        attribute = f' {kind}="{self.rng.choice(names)}{extra}"' if named else ""
        return f'<{tag}{attribute} data-y="{mark}">{inner}</{tag}>'

    def aside(self, kind: str) -> str:
        r, wrap = self.rng, self.wrap
        some = lambda least, most: "".join(f"<p>{self.paragraph()}</p>" for _ in range(r.randint(least, most)))
        match kind:
            case "menu":
                return wrap(["nav", "nav", "div"], ["nav", "main-menu", "navigation", "navbar", "breadcrumb", "site-menu"], self.links(), 0)
            case "header":
                return wrap(["header", "div"], ["header", "site-header", "masthead", "top-header"], f"<p>{self.words(1, 4)}</p>" + (self.links() if r.random() < 0.6 else self.words(2, 8)), 0)
            case "footer":
                return wrap(["footer", "div"], ["footer", "site-footer", "page-footer", "copyright"], f"&copy; {self.words(2, 14)}" + (self.links() if r.random() < 0.4 else ""), 0)
            case "sidebar":
                return wrap(["aside", "div"], ["sidebar", "side", "right-sidebar", "widget", "related", "recommended"], f"<h3>{self.words(1, 3)}</h3>" + r.choice([self.links(), some(1, 3)]), 0)
            case "ad":
                return wrap(["div", "div", "aside"], ["ad", "ads", "advert", "ad-banner", "promo", "sponsored", "banner"], r.choice([self.words(3, 15), some(1, 2), f'<a href="/x">{self.words(2, 8)}</a>']), 0)
            case "notice":
                return wrap(["div", "div", "dialog"], ["cookie-notice", "cookie-banner", "consent", "notice", "alert", "popup"], r.choice([some(1, 2), self.words(4, 20)]) + r.choice(["", "<button>OK</button>"]), 0)
            case "form":
                return f'<form data-y="0"><label>{self.words(1, 5)}</label><p>{self.words(3, 12)}</p><input type="text"><button>{self.words(1, 2)}</button></form>'
            case "share":
                return wrap(["div"], ["share", "social", "sharing", "tags", "pagination"], self.links(2, 5), 0)
            case _:
                each = "".join(f'<{t}>{r.choice([self.paragraph(), some(1, 2)])}</{t}>' for t in [r.choice(["li", "div", "article"])] * r.randint(1, 6))
                return wrap(["section", "div", "div", "ol"], ["comments", "comment-list", "commentlist", "comment", "discussion", "replies"], r.choice(["", f"<h3>{self.words(1, 3)}</h3>"]) + each, 0)

    def main(self) -> str:
        r = self.rng
        title = self.words(2, 12)
        parts = [r.choice([f"<h1>{title}</h1>", f"<h1>{title}</h1>", f"<header><h1>{title}</h1></header>", f"<h2>{title}</h2>", ""])]
        for _ in range(r.choice([1, 2, 4, 8, 16])):
            inside = self.paragraph()
            parts.append(r.choice([
                f"<p>{inside}</p>", f"<p>{inside}</p>", f"<p>{inside}</p>", f"<p>{inside}</p>", f"<p><b>{inside}<br>", f"<div>{inside}</div>", f"<h2>{self.words(1, 8)}</h2>",
                f"<blockquote><p>{inside}</p></blockquote>", f"<ul><li>{self.words(2, 20)}</li><li>{self.words(2, 20)}</li></ul>",
                f"<p>{self.words(3, 20)} <a href='/x'>{self.words(1, 4)}</a> {self.words(3, 20)}</p>", f"<pre>{inside}</pre>",
                f"<table><tr><td>{self.words(1, 6)}</td><td>{self.words(1, 6)}</td></tr></table>",
                f"<section><h3>{self.words(1, 5)}</h3><p>{inside}</p></section>",
            ]))
            if r.random() < 0.06:
                parts.append(self.aside(r.choice(["ad", "share", "form", "sidebar", "notice"])))
        if r.random() < 0.2:
            parts.append(self.aside(r.choice(["comments", "share", "form"])))
        names = ["content", "post-content", "entry-content", "article-body", "main-content", "story", "post", "text"]
        held = self.wrap(["article", "article", "main", "div"], names, "".join(parts), 1)
        for _ in range(r.choice([0, 0, 1, 2])):
            held = f"<div{r.choice(['', ' class=wrap', ' class=container', ' id=page'])}>{held}</div>"
        return held

    def page(self) -> str:
        r = self.rng
        before = [k for k in ("notice", "header", "menu", "ad", "sidebar") if r.random() < 0.45]
        after = [k for k in ("share", "comments", "sidebar", "ad", "form", "menu", "footer", "notice") if r.random() < 0.4]
        around = [self.aside(k) for k in before], [self.aside(k) for k in after]
        body = "".join(around[0]) + self.main() + "".join(around[1])
        if r.random() < 0.3:
            body = f"<div>{body}</div>"
        return f"<!DOCTYPE html><html><head><title>{self.words(1, 8)}</title><style>p{{}}</style></head><body>{body}</body></html>"


def _shown(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;")


def train(paragraphs: list[str], *, layouts: int = LAYOUTS, seed: int = SEED) -> boosting.Boosted:
    """Trees fitted on built pages; the same paragraphs give the same trees."""
    built = Layouts(paragraphs or ["A short line of text.", "Some more words, and then a few others to fill a paragraph."], seed)
    rows: list[list[float]] = []
    labels: list[bool] = []
    for _ in range(layouts):
        page = Page(built.page())
        rows += page.features()
        labels += page.labels()
    return boosting.fit(np.array(rows, dtype=float), np.array(labels, dtype=float))


def sample_paragraphs(pages: DataFrame, *, id: str = "page_id", html: str = "html") -> list[str]:
    """Paragraphs of the sample of pages that fills the layouts: those with the smallest hashes, found by the hashes alone."""
    hashed = pages.filter(F.col(html).isNotNull()).select(
        F.xxhash64(F.col(id), F.col(html)).alias("hash"), F.substring(F.col(html).cast("string"), 1, SAMPLE_CHARS).alias("html")
    )
    lowest = [r["hash"] for r in hashed.select("hash").distinct().orderBy("hash").limit(SAMPLE_PAGES).collect()]
    chosen = hashed.filter(F.col("hash").isin(lowest)).groupBy("hash").agg(F.min("html").alias("html"))
    found: set[str] = set()
    for row in chosen.collect() if lowest else []:
        found.update(line for line in Page(row["html"]).text_of_all().split("\n") if len(line.split()) > 1)
    return sorted(found)


def main_text(pages: DataFrame, trees: boosting.Boosted, *, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``(id, url, text, n_chars)`` for every row; null and empty pages have an empty text, null ids and repeated rows stay.

    Other columns are not read. Pages are parsed whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for many in batches:
            for start in range(0, many.num_rows, PAGES_AT_ONCE):
                rows = many.slice(start, PAGES_AT_ONCE)
                parsed = [Page(h or "") for h in rows.column("html").to_pylist()]
                odds = trees.log_odds(np.array([f for p in parsed for f in p.features()], dtype=float))
                edges = np.cumsum([0, *(len(p.parent) for p in parsed)])
                texts = [p.text(p.decode(odds[a:b])) for p, a, b in zip(parsed, edges, edges[1:])]
                yield batch(
                    id=rows.column("id"), url=rows.column("url"), text=pa.array(texts, pa.string()),
                    n_chars=pa.array([len(t) for t in texts], pa.int64()),
                )

    source = pages.select(
        F.col(id).cast("long").alias("id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html")
    )
    return source.mapInArrow(run, "id long, url string, text string, n_chars long")
