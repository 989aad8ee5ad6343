"""Main text of web pages by consensus host paths.

A small tolerant reader turns a page into text blocks and containers. Each page scores its containers and
votes for the path of the best one, written as tags and classes without numbers. Spark counts the
votes per host; pages are then read again and give the text of the container on a path their host agrees on. Where the best
container is a part of an article, the article stands for it. A page is read in time in proportion to its length, however deep it is
nested and whatever is left open.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import by_batch, kept

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<rest>(?:[^>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+|[^>]*+)>",
    re.S,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][\w:.-]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
NAME_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe xmp svg".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINER = frozenset("article body div main section td".split())
#: Start tags that end an open element of these kinds, unless one of the second kinds is opened in between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
DROPPED_TAGS = RAW | frozenset("head nav aside footer form button select option dialog menu audio video canvas object template".split())
DROPPED_ROLES = frozenset("navigation banner complementary contentinfo search dialog alert alertdialog menu menubar form".split())
#: Words in a class or id that mark what is not the article.
DROPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored cookie cookies consent gdpr popup modal sidebar sidenav "
    "menu nav navbar navigation breadcrumb breadcrumbs masthead topbar footer comment comments disqus replies respond newsletter "
    "subscribe subscription pagination pager hidden".split()
)
#: Words that mark it outside an article; inside one, where prose may go by such names, the element's text decides.
DOUBTED_WORDS = frozenset(
    "promo promotion banner notice notification alert overlay share sharing social related recommended signup login search toolbar widget skip".split()
)
#: Classes that begin so say nothing of the kind.
IDLE_WORDS = frozenset("has with without no is overflow".split())
COMMENT_WORDS = frozenset({"comment", "comments"})
ARTICLE_WORDS = frozenset("article content entry post story text".split())

#: Characters of text from which a doubted element is prose, if no more than a third of them are in links.
PROSE = 200
#: An element's text without links over that of one in it, from which the rest counts as text of the article too.
MORE = 1.25


def attributes(rest: str) -> dict[str, str]:
    return {m[1].lower(): (m[2] or "").strip("\"'") for m in ATTRIBUTE.finditer(rest)} if rest.strip(" /\n\t\r") else {}


def words_of(attrs: dict[str, str]) -> set[str]:
    return {w.lower() for key in ("class", "id") if key in attrs for w in NAME_PART.findall(attrs[key])}


def boilerplate(tag: str, attrs: dict[str, str], in_article: bool) -> bool:
    """Whether an element is none of the article by its kind, or not shown."""
    if tag in DROPPED_TAGS or tag == "header" and not in_article:
        return True
    if not attrs or tag in ("html", "body"):
        return False
    style = attrs.get("style", "").replace(" ", "").lower()
    return "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in style or attrs.get("role", "").lower() in DROPPED_ROLES


def mark(tag: str, attrs: dict[str, str], in_article: bool) -> str:
    """Whether an element is none of the article by what it is called: "off", "doubted", or nothing of the kind."""
    if tag == "noscript":
        return "doubted"
    if not attrs or tag in ("html", "body"):
        return ""
    words: set[str] = set()
    for name in [*attrs.get("class", "").split(), attrs.get("id", "")]:
        parts = [w.lower() for w in NAME_PART.findall(name)]
        if parts and parts[0] not in IDLE_WORDS:
            words.update(parts)
    if tag in ("article", "main"):
        return "off" if words & COMMENT_WORDS else ""
    if words & DROPPED_WORDS or (not in_article and "header" in words):
        return "off"
    return ("doubted" if in_article else "off") if words & DOUBTED_WORDS else ""


def label(tag: str, attrs: dict[str, str]) -> str:
    """A tag with its classes in order, numbers in them made #."""
    classes = sorted(re.sub(r"[0-9]+", "#", c) for c in attrs.get("class", "").split())
    return ".".join([tag, *classes])


class Container:
    __slots__ = ("path", "tag", "above", "first", "last", "score", "whole", "bonus")

    def __init__(self, path: str, tag: str, above: Container | None, first: int, bonus: float):
        self.path, self.tag, self.above, self.first, self.last, self.bonus = path, tag, above, first, first, bonus
        self.score = self.whole = 0.0


class Doubt:
    """An element whose text decides whether it counts."""

    __slots__ = ("above", "length", "linked", "dropped")

    def __init__(self, above: Doubt | None):
        self.above, self.length, self.linked, self.dropped = above, 0, 0, False


class Element:
    __slots__ = ("tag", "container", "path", "off", "doubt")

    def __init__(self, tag: str, container: Container | None, path: str, off: int, doubt: Doubt | None):
        self.tag, self.container, self.path, self.off, self.doubt = tag, container, path, off, doubt


class Page:
    """The text blocks of a page in order, without boilerplate, and its containers with the blocks they span."""

    def __init__(self, text: str):
        self.blocks: list[str] = []
        self.containers: list[Container] = []
        self.open: list[Element] = []
        self.depths: defaultdict[str, list[int]] = defaultdict(list)  # where in ``open`` each tag is
        self.around: list[Container] = []  # the open containers
        self.off = 0  # how many open elements are marked off
        self.doubt: Doubt | None = None
        self.doubts: list[Doubt] = []
        self.pieces: list[tuple[str, bool, Doubt | None]] = []  # text, whether it is linked, the doubt it stands in
        self.read_blocks: list[tuple[list[tuple[str, bool, Doubt | None]], Container | None]] = []
        self.read(text)
        self.settle()

    def read(self, text: str) -> None:
        at, dropped, skip_to = 0, 0, 0
        last = text.rfind(">") + 1  # no tag ends after it
        for m in TOKEN.finditer(text, 0, last):
            if m.start() < skip_to:
                continue
            if not dropped and m.start() > at:
                self.add(text[at : m.start()])
            at = m.end()
            tag = m["tag"]
            if tag is None:
                if at == last and m[0].startswith("<!--") and not m[0].endswith("-->"):
                    at = len(text)  # a comment that never ends
                continue
            tag = tag.lower()
            if dropped:  # inside boilerplate only its own nesting counts
                if tag == self.open[-1].tag and tag not in VOID and not m["rest"].endswith("/"):
                    dropped += -1 if m["end"] else 1
                    if not dropped:
                        self.close_last()
                elif m["end"] and tag in BLOCK and self.depths[tag]:
                    dropped = 0  # never closed: it ends with what is around it
                    self.close_last()
                    self.end(tag)
                elif tag in RAW and not m["end"]:
                    at = skip_to = self.after(text, tag, m.end())
                continue
            if m["end"]:
                self.end(tag)
                continue
            attrs = attributes(m["rest"])
            self.imply(tag)
            if tag in RAW:
                at = skip_to = self.after(text, tag, m.end())
                continue
            if tag in VOID:
                if tag == "hr":
                    self.flush()
                elif tag == "br":
                    self.add(" ")
                continue
            if boilerplate(tag, attrs, bool(self.depths["article"] or self.depths["main"])):
                if tag in BLOCK or tag in DROPPED_TAGS:
                    self.flush()
                self.push(Element(tag, None, "", self.off, self.doubt))
                dropped = 1
                continue
            self.start(tag, attrs)
        if not dropped and at < len(text):
            self.add(text[at:].split("<!--", 1)[0])
        while self.open:
            self.close_last()
        self.flush()

    @staticmethod
    def after(text: str, tag: str, at: int) -> int:
        end = re.compile(rf"</{re.escape(tag)}[^>]*+>", re.I).search(text, at)
        return end.end() if end else len(text)

    def add(self, raw: str) -> None:
        """A text node. References are decoded here, as none spans a tag."""
        if not self.off:
            self.pieces.append((html.unescape(raw), bool(self.depths["a"]), self.doubt))

    def flush(self) -> None:
        """End the block at hand."""
        if self.pieces:
            self.read_blocks.append((self.pieces, self.around[-1] if self.around else None))
            self.pieces = []

    def push(self, element: Element) -> None:
        self.depths[element.tag].append(len(self.open))
        self.open.append(element)

    def start(self, tag: str, attrs: dict[str, str]) -> None:
        if tag in BLOCK:
            self.flush()
        in_article = bool(self.depths["article"] or self.depths["main"])
        off, doubt = self.off, self.doubt
        marked = mark(tag, attrs, in_article)
        if marked == "off":
            self.off += 1
        elif tag in ("article", "main") and not in_article:
            self.off = 0  # an article counts, whatever the element around it is called
        elif marked == "doubted" and not self.off:
            self.doubt = Doubt(self.doubt)
            self.doubts.append(self.doubt)
        path = self.open[-1].path if self.open else ""
        container = None
        if tag in BLOCK:
            path = f"{path}/{label(tag, attrs)}"
            if len(path) > 240:
                path = f"~{xxhash.xxh64_hexdigest(path)}"
        if tag in CONTAINER:
            bonus = 1.5 if tag in ("article", "main") else 1.25 if words_of(attrs) & ARTICLE_WORDS else 1.0
            container = Container(path, tag, self.around[-1] if self.around else None, len(self.read_blocks), bonus)
            self.containers.append(container)
            self.around.append(container)
        self.push(Element(tag, container, path, off, doubt))

    def close_last(self) -> None:
        element = self.open[-1]
        if element.tag in BLOCK:
            self.flush()
        self.open.pop()
        self.depths[element.tag].pop()
        self.off, self.doubt = element.off, element.doubt
        if element.container is not None:
            element.container.last = len(self.read_blocks)
            self.around.pop()

    def close_to(self, depth: int) -> None:
        while len(self.open) > depth:
            self.close_last()

    def end(self, tag: str) -> None:
        """An end tag closes everything in its element; one without an open element closes nothing."""
        if self.depths[tag]:
            self.close_to(self.depths[tag][-1])
        elif tag == "p":
            self.flush()

    def innermost(self, tags: set[str]) -> int:
        return max((self.depths[t][-1] for t in tags if self.depths[t]), default=-1)

    def imply(self, tag: str) -> None:
        """Close what a start tag closes by itself."""
        if tag in BLOCK and self.depths["p"] and self.innermost({"p"}) > self.innermost({"td", "th", "table"}):
            self.close_to(self.depths["p"][-1])
        kinds, fence = CLOSES.get(tag, (set(), set()))
        while kinds and (depth := self.innermost(kinds)) > self.innermost(fence):
            self.close_to(depth)
            if tag != "tr":
                return

    def settle(self) -> None:
        """Judge what is doubted, make the blocks of what is left, and credit them to the containers around, the farther the less."""
        for pieces, _ in self.read_blocks:
            for text, linked, doubt in pieces:
                if doubt is not None:
                    n = len(" ".join(text.split()))
                    doubt.length += n
                    doubt.linked += n if linked else 0
        for doubt in reversed(self.doubts):  # inner ones before those around them
            doubt.dropped = doubt.length < PROSE or 3 * doubt.linked > doubt.length
            if doubt.above is not None and not doubt.dropped:
                doubt.above.length += doubt.length
                doubt.above.linked += doubt.linked
        for doubt in self.doubts:
            doubt.dropped = doubt.dropped or doubt.above is not None and doubt.above.dropped
        blocks_before = [0]
        for pieces, container in self.read_blocks:
            left = [(text, linked) for text, linked, doubt in pieces if doubt is None or not doubt.dropped]
            block = " ".join("".join(text for text, _ in left).split())
            if block:
                self.blocks.append(block)
                if container is not None:
                    worth = max(0.0, len(block) - 2.0 * sum(len(text) for text, linked in left if linked))
                    container.score += worth
                    container.whole += worth
            blocks_before.append(len(self.blocks))
        for container in reversed(self.containers):
            container.first, container.last = blocks_before[container.first], blocks_before[container.last]
            if container.above is not None:
                container.above.score += container.score / 2
                container.above.whole += container.whole
        del self.read_blocks, self.doubts

    def best(self) -> Container | None:
        scored = [c for c in self.containers if c.score > 0]
        return self.entire(max(scored, key=lambda c: (c.score * c.bonus, -c.first))) if scored else None

    @staticmethod
    def entire(part: Container) -> Container:
        """The article or main around a container, if there is one; else the widest element around it, the body not among them, of
        which each step holds clearly more text than the one before."""
        around = part
        while around is not None:
            if around.tag in ("article", "main"):
                return around
            around = around.above
        found, around = part, part.above
        while around is not None and around.tag != "body":
            if around.whole >= MORE * found.whole:
                found = around
            around = around.above
        return found

    def text(self, paths: list[str]) -> str:
        """The text of the best container on the first of the paths that the page has; else of its own best one, else of all."""
        own = self.best()
        chosen = own if own is not None and own.path in paths else None
        for path in paths if chosen is None else ():
            found = [c for c in self.containers if c.path == path and c.last > c.first]
            if found:
                chosen = self.entire(max(found, key=lambda c: (c.score, -c.first)))
                break
        chosen = chosen or own
        return "\n\n".join(self.blocks[chosen.first : chosen.last] if chosen else self.blocks)


def host(url: str = "url"):
    """The host of an address in lower case, empty if it has none."""
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[^:/?#]*://([^/?#]*)", 1))


def votes(pages: DataFrame) -> DataFrame:
    """The path each page votes for, counted per host and batch: host, path, votes, score."""

    def task():
        def rows(batch: pa.RecordBatch) -> dict:
            counted: defaultdict[tuple[str, str], list[float]] = defaultdict(lambda: [0, 0.0])
            for name, text in zip(batch.column("host"), batch.column("html"), strict=True):
                best = Page(text.as_py()).best()
                if best is not None:
                    tally = counted[name.as_py(), best.path]
                    tally[0] += 1
                    tally[1] += best.score
            keys = list(counted)
            return {
                "host": [h for h, _ in keys],
                "path": [p for _, p in keys],
                "votes": [counted[k][0] for k in keys],
                "score": [counted[k][1] for k in keys],
            }

        return rows

    return by_batch(pages.select("host", "html"), task, "host string, path string, votes long, score double")


def winners(counted: DataFrame, least_share: float) -> DataFrame:
    """Per host the paths with at least ``least_share`` of its votes, most votes first: host, paths."""
    by_path = counted.groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.sum("score").alias("score"))
    total = by_path.groupBy("host").agg(F.sum("votes").alias("all"))
    strong = by_path.join(total, "host").where(F.col("votes") >= F.col("all") * least_share)
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("v"), (-F.round("score", 3)).alias("s"), "path")))
    return strong.groupBy("host").agg(F.transform(ranked, lambda r: r["path"]).alias("paths"))


def extract(pages: DataFrame, least_share: float = 0.2) -> DataFrame:
    """The main text of every row of ``pages`` (page_id, url, html): page_id, url, text, n_chars.

    A null or empty page, or one without text, has an empty text. Pages without a host vote as one host. Null ids and urls stay
    null, repeated rows are kept, pages are read whole; other columns are not read. The winners are a
    small table beside the pages; where it is not, Spark joins by host and splits a hot one.
    """
    read = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"), host().alias("host"))
    # The votes are written: their two uses would else read every page twice.
    agreed = kept(winners(kept(votes(read), "votes"), least_share), "host_paths")
    joined = read.join(agreed, "host", "left").select("page_id", "url", "html", F.coalesce("paths", F.array().cast("array<string>")).alias("paths"))

    def task():
        def rows(batch: pa.RecordBatch) -> dict:
            texts = [Page(t.as_py()).text(p.as_py()) for t, p in zip(batch.column("html"), batch.column("paths"), strict=True)]
            return {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": texts, "n_chars": [len(t) for t in texts]}

        return rows

    return by_batch(joined, task, "page_id long, url string, text string, n_chars long")
