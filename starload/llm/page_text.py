"""Main text of web pages by equivalence-class template deduction over the pages of a host.

A page is a sequence of tokens: the opening of an element at its path (names and classes of the
open elements) and the text of a block at its path. Tokens of a host that occur equally
often on every page share an occurrence vector and form an equivalence class; vectors are compared
by their support, their sum and two random projections, which Spark adds up per host and token. Pages of a
host with the same content (the blocks that could be the article) are copies and count as one page. A class is
valid if it has enough support (at least ``MIN_PAGES`` contents and ``SHARE`` of the host's) and at least
``MIN_CLASS`` tokens. Valid classes nest into the host's template by their paths, whatever else the elements
around them hold and however often. What the template does not hold fills its slots.

From the slots the article is taken: the deepest element of the template in whose slots lies nearly all of the text
that varies over the host's pages, with the page's own headings before it; on pages with an ``article`` or ``main``
element, that one. What lies in elements for menus, headers, footers, side bars, notices, adverts, forms or reader
comments is no part of it. Texts of the template are left out, within ``article`` and ``main`` too, but for two kinds: a
heading under which a slot follows, and an article that the host itself repeats with small changes, known by a
headline of the template over a text of which the template holds more than the slots.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.frames import cut, written

MIN_PAGES = 3
SHARE = 0.5
MIN_CLASS = 2
#: Share of the host's varying text that the article's slot holds at least.
SLOT_SHARE = 0.8
#: Parts in which a host's pages are joined with its template.
SALTS = 32

# Fixed values of HTML: elements by their role in the text.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "xmp", "noembed"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
          "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
          "img", "wbr", "br", "ruby", "rt", "rp"}
CLOSES_P = {"address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figcaption", "figure", "footer",
            "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section",
            "table", "ul", "li", "dd", "dt"}
ASIDE = {"nav", "header", "footer", "aside", "form", "button", "select", "dialog", "menu", "head", "object", "audio", "video",
         "canvas", "fieldset"}
ARTICLE = {"article", "main"}
#: Elements that a name does not take out of the article: a page's states stand there.
FRAME = {"html", "body", "article", "main"}
#: Names in class, id or role that mark an element as no part of the article, alone or joined (ad-banner, social_share_links).
ASIDE_WORDS = set("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent
gdpr notice notices alert newsletter subscribe subscription signup paywall sidebar side aside nav navbar navigation menu
breadcrumb breadcrumbs comment comments reply replies respond disqus discussion related recommended share sharing social
footer header masthead topbar popup modal overlay toolbar widget pagination pager search login skip complementary
contentinfo""".split())
#: Those that take out a paragraph, heading or inline element, too; other names tell there what the text is about.
ADVERT_WORDS = set("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies".split())
TEXT = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "dt", "dd", "figcaption"}
HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Words that such names hold besides; others (no-sidebar, comments-open) tell a state of what is in the element.
PLAIN_WORDS = set("area bar block box button buttons container form item items link links list section slot unit wrap wrapper".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                   r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)|[^<]+|<", re.S)
MARKS = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
WORD = re.compile(r"[a-z]+")
#: Names with a digit (post-17) tell pages apart, not places.
NUMBERED = re.compile(r"\S*\d\S*")


def digest(*parts: str) -> int:
    """A 63-bit hash of some strings."""
    return int.from_bytes(hashlib.blake2b("\x00".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big") >> 1


def listed(name: str, marks: str) -> bool:
    """Whether a whole name in class, id or role says that the element is no part of the article."""
    telling = ADVERT_WORDS if name in TEXT or name in INLINE else ASIDE_WORDS
    for mark in marks.split():
        words = set(WORD.findall(mark))
        if words & telling and words <= telling | PLAIN_WORDS:
            return True
    return False


class Element:
    __slots__ = ("name", "token", "path", "closed", "listed", "aside", "article")

    def __init__(self, name: str, marks: str, around: Element | None):
        path = around.path if around else ""
        self.name = name
        self.path = digest(str(path), name, NUMBERED.sub("", marks)) if around else 0
        self.token = self.path
        self.closed = name in ASIDE or "!hidden" in marks
        self.listed = name not in FRAME and listed(name, marks)
        self.aside = bool(around and around.aside) or self.closed or self.listed
        self.article = bool(around and around.article) or name in ARTICLE


def parse(page: str) -> Iterator[tuple[str, object]]:
    """Tokens of a page in order: ``("open", elements)`` and ``("text", (elements, text))`` of a block.

    Elements are the open ones, outermost first. Unclosed paragraphs and list items end where the
    next block begins; an end tag without its start is skipped; markup that breaks off ends with the page. The text
    of a hidden inline element or inline advert is left out of its block, which goes on after it.
    """
    stack = [Element("", "", None)]
    words: list[str] = []
    place: list[Element] = list(stack)
    mute: list[str] = []  # the open inline elements from the first left-out one on
    at = 0

    def block():
        text = " ".join("".join(words).split())
        words.clear()
        return ("text", (place, text)) if text else None

    while at < len(page):
        m = TOKEN.match(page, at)
        at = m.end()
        name = m["name"]
        if name is None:
            piece = m[0]
            if not (mute or piece.startswith("<!") or piece.startswith("<?")):
                if not words:
                    place = list(stack)
                words.append(html.unescape(piece))
            continue
        name = name.lower()
        if name == "br":
            words.append(" ")
            continue
        if name in INLINE and name not in ("img", "wbr"):
            if m["end"]:
                if name in mute:
                    del mute[len(mute) - 1 - mute[::-1].index(name):]
            elif mute or listed(name, marks := " ".join(_marks(m["rest"]))) or "!hidden" in marks:
                mute.append(name)
            continue
        if name in ("img", "wbr"):
            continue
        mute.clear()
        if (done := block()) is not None:
            yield done
        if m["end"]:
            if any(e.name == name for e in stack[1:]):
                while stack.pop().name != name:
                    pass
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
            if end is None and name not in ("script", "style"):
                continue  # never closed: read on as markup
            at = page.find(">", end.end()) + 1 if end else len(page)
            at = at or len(page)
            continue
        if name in VOID:
            continue
        if name in CLOSES_P and stack[-1].name == "p":
            stack.pop()
        if name in ("li", "dt", "dd", "tr", "td", "th", "option") and stack[-1].name in (name, *{"dt": ("dd",), "dd": ("dt",)}.get(name, ())):
            stack.pop()
        if name == "body" and stack[-1].name == "head":
            stack.pop()
        stack.append(Element(name, " ".join(_marks(m["rest"])), stack[-1]))
        if m["rest"].endswith("/") and name not in CLOSES_P:
            stack.pop()
            continue
        yield "open", list(stack)
    if (done := block()) is not None:
        yield done


def _marks(rest: str) -> list[str]:
    out = []
    for key, value in MARKS.findall(rest):
        value = value.strip("\"'").lower()
        if key.lower() == "hidden" or (key.lower() == "aria-hidden" and value == "true"):
            out.append("!hidden")
        elif key.lower() != "aria-hidden":
            out.append(value)
    return out


def read(page: str) -> list[tuple[str, object]]:
    """The tokens of a page. If names take every article element out, those around the longest one do not count."""
    tokens = list(parse(page))
    if any(kind == "open" and v[-1].article and not v[-1].aside for kind, v in tokens):
        return tokens
    sizes: Counter = Counter()
    around: dict[Element, list[Element]] = {}
    for kind, v in tokens:
        if kind == "text" and not any(e.closed for e in v[0]):
            at = next((k for k, e in enumerate(v[0]) if e.name in ARTICLE), None)
            if at is not None:
                sizes[v[0][at]] += len(v[1])
                around.setdefault(v[0][at], v[0][:at])
    if sizes:
        for e in around[max(sizes, key=sizes.get)]:
            e.listed = False
        for kind, v in tokens:
            if kind == "open":
                v[-1].aside = v[-2].aside or v[-1].closed or v[-1].listed
    return tokens


#: What a page tells about a token: how often it occurs; for elements that may hold an article, also the characters
#: and a hash of the texts in them, and their depth.
FACTS = np.dtype([("token", "<i8"), ("n", "<i4"), ("chars", "<i4"), ("text", "<i4"), ("depth", "<i4")])


def facts(tokens: list[tuple[str, object]]) -> np.ndarray:
    """The facts of each of a page's tokens."""
    counts = Counter(v[-1].token if kind == "open" else text_token(*v) for kind, v in tokens)
    held: dict[int, list] = {}
    for kind, v in tokens:
        if kind == "text" and not v[0][-1].aside:
            for depth, e in enumerate(v[0][1:], 1):
                if e.name not in TEXT:
                    row = held.setdefault(e.token, [0, [], depth])
                    row[0] += len(v[1])
                    row[1].append(v[1])
    none = (0, (), 0)
    return np.array([(token, n, min(chars, 2 ** 31 - 1), digest(*texts) & 0x3FFFFFFF, depth) for token, n in counts.items()
                     for chars, texts, depth in (held.get(token, none),)], dtype=FACTS)


def text_token(elements: list[Element], text: str) -> int:
    return digest(str(elements[-1].path), "text", text)


def host_of(url):
    """The host of a url in lower case ('' if there is none)."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def candidates(tokens: list[tuple[str, object]]) -> tuple[bool, list[tuple[list[Element], str]]]:
    """Whether the page has an article element, and the blocks that could be the article (elements and text)."""
    framed = any(kind == "open" and v[-1].article and not v[-1].aside for kind, v in tokens)
    return framed, [v for kind, v in tokens if kind == "text" and not v[0][-1].aside and (v[0][-1].article or not framed)]


def _page_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each page's content as a hash, and its tokens with their counts."""
    for batch in batches:
        rows = []
        for host, page in zip(*(c.to_pylist() for c in batch.columns)):
            tokens = read(page or "")
            rows.append((host, digest(*(text for _, text in candidates(tokens)[1])), digest(page or ""), facts(tokens).tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.binary()))],
                                         ["host", "content", "page", "tokens"])


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Support, sum and projections of the tokens' occurrence vectors over this batch's contents of each host; the
    characters in an element, the least and greatest hash of its texts, and its depth."""
    for batch in batches:
        found: dict[tuple[str, int], list[int]] = {}
        for host, content, packed in zip(*(c.to_pylist() for c in batch.columns)):
            for token, n, chars, text, depth in np.frombuffer(packed, FACTS).tolist():
                random = digest(str(content), str(n))
                row = found.setdefault((host, token), [0, 0, 0, 0, 0, text, text, depth])
                row[0] += 1
                row[1] += n
                row[2] += random & 0x3FFFFFFF
                row[3] += random >> 30 & 0x3FFFFFFF
                row[4] += chars
                row[5], row[6] = min(row[5], text), max(row[6], text)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.int64()),
             *[pa.array([v[i] for v in found.values()], pa.int64()) for i in range(8)]], ["host", "token", *COUNTED])


COUNTED = ("pages", "total", "x", "y", "chars", "low", "high", "depth")


def templates(pages: DataFrame) -> DataFrame:
    """``host, template, slot``: the tokens of the host's valid equivalence classes and the element of its article's
    slot (null if no element's text varies); ``pages`` holds ``host, html``.

    Of the pages with one content, the one with the smallest hash stands for all. A template has at
    most ``1 / SHARE`` times the tokens of a page of the host.
    """
    contents = cut(pages.select("host", "html").mapInArrow(_page_tokens, "host string, content long, page long, tokens binary")
                   .groupBy("host", "content").agg(F.min_by("tokens", "page").alias("tokens")))
    tokens = (contents
              .mapInArrow(_count_tokens, "host string, token long, " + ", ".join(f"{c} long" for c in COUNTED))
              .groupBy("host", "token").agg(*[F.sum(c).alias(c) for c in COUNTED[:5]], F.min("low").alias("low"),
                                            F.max("high").alias("high"), F.max("depth").alias("depth"))
              .where(F.col("pages") >= MIN_PAGES))
    sizes = contents.groupBy("host").agg(F.count(F.lit(1)).alias("of")).where(F.col("of") >= MIN_PAGES)
    classes = (tokens.join(sizes, "host").where(F.col("pages") >= F.lit(SHARE) * F.col("of"))
               .groupBy("host", "pages", "total", "x", "y").agg(F.collect_list(
                   F.struct((F.col("low") < F.col("high")).alias("varies"), "chars", "depth", "token")).alias("class")))
    valid = classes.where(F.size("class") >= MIN_CLASS).groupBy("host").agg(F.flatten(F.collect_list("class")).alias("all"))
    varying = F.filter("all", lambda t: t["varies"] & (t["chars"] > 0))
    most = F.array_max(F.transform(varying, lambda t: t["chars"]))
    # of the elements that hold nearly all that varies, the one with the least text, the deepest of equals
    slot = F.array_min(F.transform(F.filter(varying, lambda t: t["chars"] >= F.lit(SLOT_SHARE) * most),
                                   lambda t: F.struct(t["chars"], -t["depth"], t["token"].alias("token"))))
    return valid.select("host", F.transform("all", lambda t: t["token"]).alias("template"), slot["token"].alias("slot"))


def article_text(page: str, template: frozenset[int], slot: int | None = None) -> str:
    """The blocks of a page that fill the article's slots of the host's template, with the headings over slots.

    Without an article element these are the blocks in the element ``slot`` and the page's own headings before it, on a
    page that has that element; else those of the body.
    An article that the host repeats with small changes is whole, from its headline on: the template holds the
    headline (the first heading; in an article element without one, the first block) and more text than it leaves.
    """
    framed, blocks = candidates(read(page))
    own = [text_token(elements, text) not in template for elements, text in blocks]
    if not framed and slot is not None:
        inside = [any(e.token == slot for e in elements) for elements, _ in blocks]
        if True in inside:
            start = inside.index(True)
            use = [k for k, (elements, _) in enumerate(blocks) if inside[k] or k < start and own[k] and elements[-1].name in HEADING]
            blocks, own = [blocks[k] for k in use], [own[k] for k in use]
    level = [int(elements[-1].name[1]) if elements[-1].name in HEADING else 7 for elements, _ in blocks]
    left, whole = (sum(len(text) for keep, (_, text) in zip(which, blocks) if keep) for which in (own, [True] * len(blocks)))
    headline = next((k for k, n in enumerate(level) if n < 7), 0 if framed and blocks else None)
    if headline is not None and not own[headline] and 2 * left < whole:
        keep = [own[k] or k >= headline for k in range(len(blocks))]
        return "\n".join(text for kept, (_, text) in zip(keep, blocks) if kept)
    keep = list(own)
    slot = [False] * 8  # slot[n]: one follows before the next heading of level n or above
    for k in range(len(blocks) - 1, -1, -1):
        n = level[k]
        keep[k] = own[k] or n < 7 and slot[n]
        slot = [slot[m] or own[k] if m < n or n == 7 else False for m in range(8)]
    return "\n".join(text for kept, (_, text) in zip(keep, blocks) if kept)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, frozenset[int]] = {}
    for batch in batches:
        out = []
        for host, page, template, slot in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "template", "slot"))):
            if host not in held:
                if len(held) > 1000:
                    held.clear()
                held[host] = frozenset(template or ())
            out.append(article_text(page or "", held[host], slot))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()),
                                          pa.array([len(t) for t in out], pa.int64())], ["page_id", "url", "text", "n_chars"])


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every page.

    Character references are decoded, white space within a block becomes one space, blocks are trimmed and
    joined by one LF in page order; nothing else is dropped. A null or empty page gives an empty
    text; pages without a host (a null url included) share a template; repeated rows give a row each. An
    empty table gives no rows; further columns are not read.
    """
    id_type = pages.schema[page_id].dataType.simpleString()
    rows = pages.select(pages[page_id].alias("page_id"), pages[url].alias("url"), pages[page].alias("html")).withColumn("host", host_of("url"))
    # one bounded set of tokens per host, met by a host's pages in SALTS parts: no host's pages meet in one task
    known = written(templates(rows), "templates").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("html"), F.lit(SALTS)).cast("int"))
    return (salted.join(known, ["host", "salt"], "left")
            .mapInArrow(_extract, f"page_id {id_type}, url string, text string, n_chars long"))
