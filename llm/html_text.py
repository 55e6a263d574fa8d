"""Main-text extraction from web pages by gradient-boosted trees over the nodes of the document tree.

Every element gets features of its subtree (text, link and tag density, punctuation, paragraphs, form fields), its attribute
tokens, depth, siblings and ancestors.  Boosted trees give the chance that the element belongs to the main text, and a
hierarchical decoding takes the likeliest labelling in which nothing below a dropped element is kept.

The trees are trained here, on pages that ``sample_page`` composes from a seed: articles in several markups among menus,
headers, footers, sidebars, notices, adverts, forms and reader comments.  No page of the input is used for training.

Text: character references are decoded, white space inside a block becomes one space, blocks are trimmed and joined in page
order by a line break; a line break element counts as white space.  Scripts, styles, comments and the head never count.

Defined results for odd input: a null or empty html gives an empty text, as does a page without main text; malformed markup
is read like a browser does it (implied and missing end tags, stray signs).  Pages are read whole, in time that grows with
their length however they are marked up; a very large page fills memory with a few hundred bytes an element.  Of labellings
equally likely the one that drops an element is taken.  Repeated rows give repeated results, an empty table an empty one.
Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from llm import trees
from llm.common import table

# Element names of the HTML standard by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
NEVER = frozenset("head script style title noscript template iframe textarea select option button svg math object canvas video audio xmp noembed noframes datalist".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul caption".split())
CLOSES_P = BLOCK - frozenset("body html td th tr tbody thead tfoot caption".split())
TAGS = ("html", "body", "div", "section", "article", "main", "nav", "header", "footer", "aside", "form", "p", "h1", "h2", "h3", "h4", "ul", "ol", "li", "a", "span", "b", "i", "em", "strong", "table", "tr", "td", "th", "blockquote", "pre", "code", "figure", "figcaption", "label", "input", "dl", "dt", "dd", "img")
#: A tag without a < inside; others take the long way of ``Tags``.
PLAIN = re.compile(r"<(/?)([a-zA-Z][^\s/><]*)((?:[^\"'<>]+|\"[^\"<]*\"|'[^'<]*')*+)>")
NAME_END, SIGN = re.compile(r"[\s/>]"), re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"\b(class|id|role|aria-label|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
SPACE = re.compile(r"[\x20\x09-\x0D\xa0]+")


class Tags:
    """The markup of a page in order, by one pass: what a failed search for a tag's end has seen is not searched again."""

    def __init__(self, source: str):
        self.source = source
        self.last = {c: source.rfind(c) for c in "\"'>"}
        self.dead: set[int] = set()  # quotes from which no > outside quotes is found
        self.name_end = 0

    def _end(self, at: int) -> int:
        """Place of the > that ends a tag, from ``at`` outside quotes; -1 if there is none.  A quote without a partner is a plain sign."""
        met = []
        while at <= self.last[">"]:
            q = SIGN.search(self.source, at).start()
            if self.source[q] == ">":
                return q
            if q in self.dead:
                break
            met.append(q)
            at = (self.source.index(self.source[q], q + 1) if q < self.last[self.source[q]] else q) + 1
        self.dead.update(met)
        return -1

    def next(self, at: int) -> tuple[int, int, str, str, str] | None:
        """Of the first markup from ``at`` on: start, end, slash, name and attributes; no name for comments and declarations."""
        source = self.source
        while (lt := source.find("<", at)) >= 0:
            if m := PLAIN.match(source, lt):
                return lt, m.end(), m[1], m[2].lower(), m[3]
            at = lt + 1
            if source.startswith("<!--", lt):
                end = source.find("-->", lt + 4)
                return lt, end + 3 if end >= 0 else len(source), "", "", ""
            if lt > self.last[">"]:
                continue
            if source[at : at + 1] in ("!", "?"):
                return lt, source.index(">", lt) + 1, "", "", ""
            slash = source[at : at + 1] == "/"
            first = source[at + slash : at + slash + 1]
            if not (first.isascii() and first.isalpha()):
                continue
            if self.name_end <= at + slash:
                self.name_end = NAME_END.search(source, at + slash).start()
            if (end := self._end(self.name_end)) >= 0:
                return lt, end + 1, "/" * slash, source[at + slash : self.name_end].lower(), source[self.name_end : end]
        return None


SCOPE = frozenset("table td th button body html article section div aside nav main blockquote".split())
#: What a start tag ends: names, and the elements that no search goes past.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    **dict.fromkeys(("dt", "dd"), (("dt", "dd"), ("dl",))),
    **dict.fromkeys(("td", "th"), (("td", "th"), ("tr", "table"))),
    "tr": (("tr",), ("table", "tbody", "thead", "tfoot")),
    **dict.fromkeys(("tbody", "thead", "tfoot"), (("tbody", "thead", "tfoot"), ("table",))),
    "option": (("option",), ("select",)),
}


class Page:
    """The elements of one page in order, and its text and block boundaries as events."""

    def __init__(self, source: str):
        self.tag: list[str] = []
        self.parent: list[int] = []
        self.depth: list[int] = []
        self.marks: list[tuple[str, ...]] = []
        self.events: list[tuple[int, str | None]] = []  # element and its text; None for a boundary
        self.stack: list[int] = []
        self.places: dict[str, list[int]] = {}  # of open elements in the stack, by name
        self._read(source)

    def _open(self, name: str, attributes: str) -> int:
        self.tag.append(name)
        self.parent.append(self.stack[-1] if self.stack else -1)
        self.depth.append(len(self.stack))
        self.marks.append(tuple(t for _, v in ATTRIBUTE.findall(attributes) for t in re.split(r"[^a-z]+", v.lower()) if t) if attributes else ())
        if name in BLOCK:
            self.events.append((len(self.tag) - 1, None))
        return len(self.tag) - 1

    def _push(self, node: int) -> None:
        self.places.setdefault(self.tag[node], []).append(len(self.stack))
        self.stack.append(node)

    def _last(self, names) -> int:
        """Place in the stack of the last open element of ``names``, the root apart; 0 if there is none."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=0)

    def _close(self, names, stop=()) -> None:
        """End the last open element of ``names`` and all in it, unless one of ``stop`` lies in between."""
        k = self._last(names)
        if not k or k < self._last(stop):
            return
        ended = self.stack[k:]
        if any(self.tag[e] in BLOCK for e in ended):
            self.events.append((self.stack[k], None))
        del self.stack[k:]
        for e in ended:
            self.places[self.tag[e]].pop()

    def _read(self, source: str) -> None:
        self._push(self._open("html", ""))
        tags, at = Tags(source), 0
        while True:
            m = tags.next(at)
            text = source[at : m[0] if m else len(source)]
            if text:
                self.events.append((self.stack[-1], text))
            if not m:
                return
            _, at, slash, name, attributes = m
            if not name:
                continue
            if slash:
                if name not in ("html", "body"):
                    self._close((name,))
                continue
            if name in ("html", "body"):
                if name == "body":
                    self._close(("head",))
                continue
            if name in CLOSES_P:
                self._close(("p",), SCOPE)
            if name in ENDS:
                self._close(*ENDS[name])
            if name == "br" or name == "wbr":
                self.events.append((self.stack[-1], " " if name == "br" else ""))
                continue
            node = self._open(name, attributes)
            if name in VOID or attributes.endswith("/") and name in ("path", "use", "circle", "rect"):
                continue
            if name in RAW:
                end = re.compile(f"</{name}[\\s/>]", re.I).search(source, at)
                at = source.find(">", end.start()) + 1 if end else len(source)
                at = at or len(source)
                continue
            self._push(node)

    def text(self, kept: np.ndarray) -> str:
        """The text of the kept elements, block by block."""
        blocks, part = [], []
        for node, text in self.events:
            if text is not None:
                if kept[node]:
                    part.append(text)
            elif part:
                blocks.append(SPACE.sub(" ", html.unescape("".join(part))).strip(" "))
                part = []
        blocks.append(SPACE.sub(" ", html.unescape("".join(part))).strip(" "))
        return "\n".join(b for b in blocks if b)


def _levels(depth: np.ndarray) -> list[np.ndarray]:
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)


class Nodes:
    """The elements of some pages as one table, with parents and levels, and their features."""

    def __init__(self, pages: list[Page]):
        sizes = [len(p.tag) for p in pages]
        self.start = np.r_[0, np.cumsum(sizes)]
        self.tag = [t for p in pages for t in p.tag]
        self.marks = [m for p in pages for m in p.marks]
        self.parent = np.concatenate([np.where(np.array(p.parent) < 0, -1, np.array(p.parent) + s) for p, s in zip(pages, self.start)]).astype(np.int64)
        self.depth = np.concatenate([np.array(p.depth) for p in pages]).astype(np.int64)
        self.levels = _levels(self.depth)
        self.never = np.array([t in NEVER for t in self.tag])
        for level in self.levels[1:]:
            self.never[level] |= self.never[self.parent[level]]
        n = len(self.tag)
        self.own = np.zeros((n, 4))  # characters, words, sentence signs, pieces
        self.before = np.zeros(n)
        for p, s in zip(pages, self.start):
            total = 0
            seen = -1
            for node, text in p.events:
                if text and not self.never[s + node]:
                    c = len(text)
                    self.own[s + node] += (c, text.count(" ") + 1, text.count(".") + text.count(",") + text.count("?") + text.count("!"), 1)
                    total += c
                while seen < node:
                    seen += 1
                    self.before[s + seen] = total
            self.before[s : s + len(p.tag)] /= max(1, total)

    def up(self, x: np.ndarray) -> np.ndarray:
        """Sums over subtrees."""
        x = x.copy()
        for level in self.levels[:0:-1]:
            np.add.at(x, self.parent[level], x[level])
        return x

    def _prepare(self, vocabulary: dict[str, int]) -> None:
        """What ``rows`` needs: numbers of each element, and what it lies in."""
        n, places = len(self.tag), {t: i for i, t in enumerate(TAGS)}
        tag = self.tags = np.array([places.get(t, len(TAGS)) for t in self.tag], dtype=np.int32)
        link = np.where((tag == places["a"])[:, None], self.up(self.own)[:, :1], 0)
        is_tag = lambda *names: np.isin(tag, [places[t] for t in names]).astype(float)[:, None]
        groups = (("a",), ("p",), ("li",), ("input", "label", "form"), ("h1", "h2", "h3", "h4"))
        sums = self.up(np.concatenate([self.own, link, np.ones((n, 1)), *[is_tag(*g) for g in groups]], 1))
        chars, size = np.maximum(sums[:, 0], 1), sums[:, 5]
        children = np.bincount(self.parent[self.parent >= 0], minlength=n)
        page = np.repeat(np.arange(len(self.start) - 1), np.diff(self.start))
        all_chars = np.maximum(sums[self.start[:-1], 0][page], 1)
        above = self.above = np.maximum(self.parent, 0)
        sibling, same = np.zeros(n), {}
        count: dict[int, int] = {}
        for i, (p, t) in enumerate(zip(self.parent.tolist(), tag.tolist())):
            sibling[i] = count[p] = count.get(p, -1) + 1
            same[p, t] = same.get((p, t), 0) + 1
        alike = np.array([same[k] for k in zip(self.parent.tolist(), tag.tolist())])
        own_chars, words, stops, pieces = self.own[:, 0], sums[:, 1], sums[:, 2], sums[:, 3]
        columns = [np.log1p(sums[:, 0]), np.log1p(own_chars), sums[:, 4] / chars, stops / np.maximum(words, 1), words / np.maximum(pieces, 1)]
        columns += [chars / size, np.log1p(size), *[sums[:, k] for k in range(6, 11)], sums[:, 0] / all_chars, self.before, self.depth, sibling]
        columns += [children[above], children, alike, sums[above, 0] / all_chars, sums[above, 4] / chars[above], np.log1p((sums[above, 0] - sums[:, 0]).clip(0))]
        self.numbers = np.stack([c.astype(np.float32) for c in columns], 1)
        roles = [places[t] for t in ("nav", "header", "footer", "aside", "form", "article", "main", "ul", "table")]
        inside = self.inside = np.zeros((n, len(roles) + len(vocabulary) + 1), dtype=bool)
        for k, t in enumerate(roles):
            inside[:, k] = tag == t
        for i, m in enumerate(self.marks):
            for t in m:
                inside[i, len(roles) + vocabulary.get(t, len(vocabulary))] = True
        for level in self.levels[1:]:
            inside[level] |= inside[self.parent[level]]

    def _rows(self, lo: int, hi: int, vocabulary: dict[str, int]) -> np.ndarray:
        tokens = np.zeros((hi - lo, len(vocabulary) + 1), dtype=np.float32)
        for i, m in enumerate(self.marks[lo:hi]):
            for t in m:
                tokens[i, vocabulary.get(t, len(vocabulary))] += 1
        one = np.eye(len(TAGS) + 1, dtype=np.float32)
        return np.concatenate([self.numbers[lo:hi], one[self.tags[lo:hi]], one[self.tags[self.above[lo:hi]]], tokens, self.inside[lo:hi]], 1)

    def slices(self, vocabulary: dict[str, int], step: int = 8192) -> Iterator[tuple[int, np.ndarray]]:
        """Features of the elements, ``step`` at a time, with the place of the first."""
        self._prepare(vocabulary)
        for lo in range(0, len(self.tag), step):
            yield lo, self._rows(lo, min(lo + step, len(self.tag)), vocabulary)

    def features(self, vocabulary: dict[str, int]) -> np.ndarray:
        return np.concatenate([x for _, x in self.slices(vocabulary)])

    def decode(self, chance: np.ndarray) -> np.ndarray:
        """The likeliest labels under which no element below a dropped one is kept; the root of a page always is."""
        p = np.clip(chance, 1e-4, 1 - 1e-4)
        keep, drop = np.where(self.never, -1e9, np.log(p)), self.up(np.where(self.never, 0.0, np.log(1 - p)))
        for level in self.levels[:0:-1]:
            np.add.at(keep, self.parent[level], np.maximum(keep[level], drop[level]))
        kept = keep > drop
        kept[self.start[:-1]] = True
        for level in self.levels[1:]:
            kept[level] &= kept[self.parent[level]]
        return kept


def sample_page(rng: random.Random) -> str:
    """A training page; an element whose text is not main text bears the attribute ``x``."""
    vowels, rest = "aeiouéüó", "bcdfghlmnprstvz"
    word = lambda: "".join(rng.choice(rest) + rng.choice(vowels) for _ in range(rng.randint(1, 4)))
    words = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b)))

    def sentences(a: int, b: int) -> str:
        return " ".join((words(2, 7) + rng.choice([", ", " "]) + words(1, 8)).capitalize() + rng.choice(". . . ! ?".split()) for _ in range(rng.randint(a, b)))

    def inline(s: str) -> str:
        p = s.split(" ")
        if len(p) > 4 and rng.random() < 0.4:
            k = rng.randrange(len(p) - 2)
            t = rng.choice(["b", "i", "em", "strong", 'a href="/q"', "span", "code"])
            p[k], p[k + 1] = f"<{t}>" + p[k], p[k + 1] + f"</{t.split()[0]}>" * (rng.random() < 0.8)
        if rng.random() < 0.15:
            p.insert(rng.randrange(len(p)), "<br>")
        return " ".join(p).replace(" a ", " &amp; ", 1)

    def named(tags: str, names: str, inner: str, mark: str = " x") -> str:
        tag, token = rng.choice(tags.split()), rng.choice(names.split())
        attr = rng.choice([f' class="{token}"', f' id="{token}"', f' class="{rng.choice(["box", "row", "inner", "col"])} {token}"', ""]) if tag in ("nav", "header", "footer", "aside", "form") else rng.choice([f' class="{token}"', f' id="{token}"', f' class="{token}-{rng.choice(["box", "wrap", "area"])}"'])
        return f"<{tag}{attr}{mark}>{inner}</{tag}>"

    links = lambda a, b: "<ul>" + "".join(f'<li><a href="/{word()}">{words(1, 3)}</a></li>' for _ in range(rng.randint(a, b))) + "</ul>"
    p = lambda a, b: f"<p>{inline(sentences(a, b))}" + "</p>" * (rng.random() < 0.85)
    nav = lambda: named("nav nav nav div ul", "nav menu navbar navigation breadcrumb topnav", rng.choice([links(2, 9), "".join(f'<a href="/{word()}">{word()}</a> ' for _ in range(rng.randint(2, 8)))]))
    header = lambda: named("header header div", "header masthead banner topbar site", f"<a href='/'>{words(1, 3)}</a>" + rng.choice(["", f"<p>{words(2, 7)}</p>", f"<h2>{words(1, 4)}</h2>"]) + rng.choice(["", nav()]))
    footer = lambda: named("footer footer div", "footer bottom copyright colophon", rng.choice([f"&copy; {word()} &middot; {sentences(1, 2)}", p(1, 1) + links(1, 5), links(2, 6), sentences(1, 2)]))
    advert = lambda: named("div div aside section", "ad ads advert advertisement sponsor sponsored promo banner", rng.choice([sentences(1, 3), p(1, 2), f'<a href="http://{word()}">{words(2, 6)}</a>', f"<h3>{words(1, 4)}</h3>" + p(1, 1)]))
    sidebar = lambda: named("aside aside div", "sidebar side related recommended widget trending", f"<h3>{words(1, 3)}</h3>" + rng.choice([links(2, 8), p(1, 3), p(1, 2) + links(1, 5)]))
    notice = lambda: named("div div section p", "notice cookie consent alert popup modal newsletter disclaimer gdpr message", rng.choice([sentences(1, 3), f"<p>{sentences(1, 2)}</p><button>{word()}</button>", p(1, 2)]))
    form = lambda: named("form form form div", "form search login signup subscribe contact", f"<label>{words(1, 3)}</label><input type=text name={word()}>" + rng.choice(["", f"<p>{words(3, 9)}</p>"]) + f"<button>{word()}</button>")
    remark = lambda: rng.choice(["<div class='comment'>{}</div>", "<li>{}</li>", "<article class='comment'>{}</article>", "<div class='reply'>{}</div>"]).format(f"<b>{word()}</b> " + rng.choice([p(1, 4), sentences(1, 3)]))
    comments = lambda: named("section div ol div", "comments comment responses discussion replies disqus feedback", f"<h3>{words(1, 2)}</h3>" * (rng.random() < 0.6) + "".join(remark() for _ in range(rng.randint(1, 6))))
    share = lambda: named("div div ul", "share social tags meta byline tools", "".join(f'<a href="#">{word()}</a> ' for _ in range(rng.randint(2, 6))))
    body = [f"<h1>{words(2, 9)}</h1>"] * (rng.random() < 0.8)
    for _ in range(rng.choice([1, 1, 2, 3, 4, 6, 9, 14])):
        body.append(rng.choices([p(1, 9), f"<h2>{words(1, 6)}</h2>" + p(1, 5), "<ul>" + "".join(f"<li>{inline(sentences(1, 2))}</li>" for _ in range(rng.randint(2, 6))) + "</ul>", f"<blockquote>{p(1, 3)}</blockquote>", "<table>" + "".join(f"<tr><td>{words(1, 3)}</td><td>{words(1, 4)}</td></tr>" for _ in range(rng.randint(2, 5))) + "</table>", f"<pre>{words(4, 20)}</pre>", f"<figure><img src='/{word()}.png'><figcaption>{words(3, 9)}</figcaption></figure>", f"<div>{inline(sentences(1, 4))}</div>"], [12, 2, 1.5, 1, 0.7, 0.4, 0.5, 1])[0])
    for make, chance in ((advert, 0.2), (share, 0.2), (notice, 0.08), (sidebar, 0.05), (form, 0.05)):
        if rng.random() < chance:
            body.insert(rng.randint(0, len(body)), make())
    main = named("article article article main section div", "article content post story entry main text body page", "".join(body), "")
    if rng.random() < 0.15:
        main = "<main>" + main + "</main>"
    parts = [main]
    for make, chance in ((comments, 0.35), (sidebar, 0.4), (form, 0.25), (notice, 0.25), (advert, 0.3)):
        if rng.random() < chance:
            parts.insert(rng.randint(0, len(parts)), make())
    if rng.random() < 0.25:
        parts = [named("div div main", "wrapper container layout row site page", "".join(parts), "")]
    for make, chance in ((advert, 0.35), (notice, 0.2), (form, 0.1), (nav, 0.85), (header, 0.5)):
        if rng.random() < chance:
            parts.insert(0, make())
    parts += [footer()] * (rng.random() < 0.85)
    return "<!DOCTYPE html><html><head><title>t</title></head><body>" + "".join(parts) + "</body></html>"


@lru_cache(maxsize=1)
def model(pages: int = 300, seed: int = 5) -> tuple[trees.Boosted, dict[str, int]]:
    """Trees and the attribute tokens they know, fitted to so many composed pages."""
    rng = random.Random(seed)
    sources = [sample_page(rng) for _ in range(pages)]
    read = [Page(re.sub(r"(<[a-z0-9]+[^>]*?) x>", r'\1 role="xoutx">', s)) for s in sources]
    nodes = Nodes(read)
    out = np.array(["xoutx" in m for m in nodes.marks])
    for level in nodes.levels[1:]:
        out[level] |= out[nodes.parent[level]]
    nodes.marks = [tuple(t for t in m if t != "xoutx") for m in nodes.marks]
    found: dict[str, int] = {}
    for m in nodes.marks:
        for t in set(m):
            found[t] = found.get(t, 0) + 1
    vocabulary = {t: i for i, t in enumerate(sorted(t for t, k in found.items() if k >= 5))}
    use = ~nodes.never
    return trees.fit(nodes.features(vocabulary)[use].astype(np.float64), (~out[use]).astype(float), rounds=30, bins=16), vocabulary


def extract(sources: list[str | None], fitted: tuple[trees.Boosted, dict[str, int]]) -> list[str]:
    """The main text of each page."""
    boosted, vocabulary = fitted
    pages = [Page(s or "") for s in sources]
    if not pages:
        return []
    nodes = Nodes(pages)
    chance = np.zeros(len(nodes.tag))
    for lo, x in nodes.slices(vocabulary):
        chance[lo : lo + len(x)] = boosted.chance(x)
    kept = nodes.decode(chance)
    return [p.text(kept[s:]) for p, s in zip(pages, nodes.start)]


def _texts(shared, many: int = 1 << 20):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lo = 0
            while lo < b.num_rows:
                sources, size, hi = [], 0, lo
                while hi < b.num_rows and size < many:
                    sources.append(b.column("html")[hi].as_py())
                    size += len(sources[-1] or "")
                    hi += 1
                text = extract(sources, shared.value)
                part = b.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], ["page_id", "url", "text", "n_chars"])
                lo = hi

    return of


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of each row of ``pages``."""
    shared = pages.sparkSession.sparkContext.broadcast(model())  # some tens of small trees
    of = _texts(shared)
    columns = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), pages["html"].cast("string").alias("html"))
    return columns.mapInArrow(of, "page_id long, url string, text string, n_chars long")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))
