"""Main text of web pages by template deduction from equivalence classes of tokens.

A page's tokens are its elements, told apart by their path of names and classes. Tokens with
the same occurrence vector over a host's pages, that is as often as each other in every single
page, form an equivalence class; classes found in at least half of the pages, as often in
each, make the host's template, nested by their paths. Occurrence vectors are compared by a
hash that Spark sums up, so no host's pages ever meet in one task. The template's elements
delimit its slots; the main slot is the container with the most text of its own, where an
article or main element counts with all that it encloses. What the slot holds is extracted block
by block, without the blocks that are constant over the host's pages.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm.frames import arrow_map, pick, stored, table

TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:-->|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
#: Elements whose content is text of their own kind, up to the closing tag.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "svg", "iframe"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
    "ins", "kbd", "mark", "q", "ruby", "rb", "rp", "rt", "s", "samp", "small", "span", "strike", "strong",
    "sub", "sup", "time", "tt", "u", "var",
}
#: Elements that end where the next of their kind starts.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
DROPPED = {"nav", "header", "footer", "aside", "form", "button", "select", "menu", "dialog", "head"}
#: Words in a class, id or role that name what is not the article.
BOILERPLATE = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "banner", "sponsor", "sponsored", "promo", "menu",
    "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "header", "footer", "sidebar", "aside", "cookie",
    "cookies", "consent", "notice", "notices", "popup", "modal", "overlay", "comment", "comments", "reply",
    "replies", "disqus", "share", "sharing", "social", "related", "newsletter", "subscribe", "subscription",
    "widget", "complementary", "contentinfo", "alert",
}
#: Elements that hold a block of text or a list of them; what encloses them is a container.
BLOCKS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd", "pre", "blockquote", "figure",
          "figcaption", "caption", "address"} | INLINE
MAIN = {"article", "main"}
MAIN_WORDS = {"main", "article", "articlebody"}
SHARE_OF_PAGES = 0.5
#: Fewer pages with a block in common may as well be near copies of one page.
LEAST_PAGES = 3
#: A marked element with this share of the largest container's text is the main slot.
MARKED_SHARE = 0.2
#: Blocks that pages share are the page's own where taking them out would leave less than this
#: share of the main part: of one that is marked, and of any other.
LEFT_OF_MARKED, LEFT_OF_ANY = 0.5, 0.25
#: Elements that a path names; what is nested deeper belongs to the last of them.
DEEPEST = 200


def named(tag: str, attributes: str) -> tuple[str, bool, bool, bool]:
    """(label of the element in a path, is it boilerplate by its tag, by a name, does it mark the main text)."""
    words: list[str] = []
    marks: set[str] = set()
    if "=" in attributes:
        for name, *values in ATTRIBUTE.findall(attributes):
            name = name.lower()
            if name in ("class", "id", "role", "itemprop"):
                value = "".join(values).lower()
                if name == "class":
                    words += value.split()
                marks.update(w for w in re.split(r"[^a-z]+", value) if w)
    label = ".".join([tag, *sorted(words)])
    off = bool(marks & BOILERPLATE and tag not in ("html", "body"))
    return label, tag in DROPPED or tag in RAW, off, tag in MAIN or bool(marks & MAIN_WORDS and tag not in ("html", "body"))


class Element(NamedTuple):
    """An element of a page: place of the one around it (-1: none), and what `named` says."""

    parent: int
    label: str
    dropped: bool
    named_off: bool
    main: bool


def parsed(page: str) -> list[tuple[tuple[str, ...], bool, int, str | None]]:
    """Elements and blocks in page order: (path, off, depth of the main mark or -1, text).

    A text of None announces an element, other texts are the blocks directly in the path.
    """
    elements: list[Element] = []
    events = list(scanned(page, elements))
    trusted = not_wrapping(elements, events)
    states: list[tuple[tuple[str, ...], bool, int]] = []
    outside = ((), False, -1)
    for e, off_by_name in zip(elements, trusted):
        path, off, main = outside if e.parent < 0 else states[e.parent]
        if main < 0 and e.main and not off:
            main = len(path)
        path = (*path, e.label) if len(path) < DEEPEST else path
        states.append((path, off or e.dropped or off_by_name, main))
    return [(*(outside if at < 0 else states[at]), text) for at, text in events]


def not_wrapping(elements: list[Element], events: list[tuple[int, str | None]]) -> list[bool]:
    """Which elements are boilerplate by name and do not wrap the main text.

    A name is not believed of an element with most of the page's text, unless elements that mark
    the main text elsewhere hold a quarter as much; nor, where all such marks are in elements
    with such names, of those around a `main` or the only mark.
    """
    if not any(e.named_off for e in elements):
        return [False] * len(elements)
    dropped, named_off, in_main = [], [], []
    for e in elements:
        up = e.parent
        dropped.append(e.dropped or (up >= 0 and dropped[up]))
        named_off.append(e.named_off or (up >= 0 and named_off[up]))
        in_main.append(e.main or (up >= 0 and in_main[up]))
    size = [0] * len(elements)
    total = 0
    for at, text in events:
        if text is not None and (at < 0 or not dropped[at]):
            total += len(text)
            if at >= 0:
                size[at] += len(text)
    for at in range(len(elements) - 1, -1, -1):
        if elements[at].parent >= 0:
            size[elements[at].parent] += size[at]
    marks = [at for at, e in enumerate(elements)
             if e.main and size[at] and not dropped[at] and (e.parent < 0 or not in_main[e.parent])]
    clear = sum(size[at] for at in marks if not named_off[at])
    wraps = set()
    for mark in marks if not clear else []:
        if len(marks) == 1 or elements[mark].label.split(".")[0] != "article":
            while mark >= 0:
                wraps.add(mark)
                mark = elements[mark].parent
    return [e.named_off and at not in wraps and not (2 * size[at] > total and 4 * clear < size[at])
            for at, e in enumerate(elements)]


def scanned(page: str, elements: list[Element]) -> Iterator[tuple[int, str | None]]:
    """(place of the element or -1, block, or None where the element starts); fills `elements`."""
    stack: list[tuple[str, int]] = []
    held: list[str] = []
    at = 0

    def inner() -> int:
        return stack[-1][1] if stack else -1

    def block() -> Iterator[tuple[int, str]]:
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            yield inner(), text

    while at < len(page):
        found = TOKEN.search(page, at)
        if not found:
            held.append(page[at:])
            break
        held.append(page[at : found.start()])
        at = found.end()
        tag = (found.group(2) or "").lower()
        if not tag:
            continue
        label, dropped, off, main = named(tag, found.group(3) or "")
        if tag == "br":
            held.append(" ")
            continue
        if tag in RAW and not found.group(1):
            end = re.compile(rf"</{re.escape(tag)}\s*(?:>|\Z)", re.I).search(page, at)
            if found.group(3).rstrip().endswith("/"):
                continue
            at = end.end() if end else len(page)
            continue
        if tag in INLINE and not off and not dropped and not found.group(1):
            continue
        if found.group(1):
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), -1)
            if tag in INLINE and depth < 0:
                continue
            yield from block()
            if depth >= 0:
                del stack[depth:]
            continue
        yield from block()
        if tag in VOID:
            continue
        if tag not in INLINE and stack and stack[-1][0] == "p":
            stack.pop()
        closes = CLOSES.get(tag)
        while closes and stack and stack[-1][0] in closes:
            stack.pop()
        elements.append(Element(inner(), label, dropped, off, main))
        stack.append((tag, len(elements) - 1))
        yield inner(), None
    yield from block()


def hosted(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    rows = pick(pages, page_id=id_col, url=url_col, html=html_col)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][-+.A-Za-z0-9]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return rows.withColumn("host", host)


def templates(pages: DataFrame) -> DataFrame:
    """(host, classes, slot, constant) from rows of (host, html): each class with its paths, nested.

    A class has `paths` (same occurrence vector), `repeat` (occurrences per page), `pages`,
    `texts` (for each path the characters of all blocks that it encloses, over all pages),
    `mains` (whether the element marks the main text by name), and `parent`, the place in the
    list of the class around it, -1 for the outermost. `slot` is the path of the main slot,
    `constant` the keys of blocks that half of the pages, and LEAST_PAGES, have in common.
    """

    names = ("page", "host", "path", "block", "n", "size", "main")

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out: dict[str, list] = defaultdict(list)
        for number, host, page in zip(*(batch.column(c).to_pylist() for c in ("page", "host", "html"))):
            seen: dict[tuple, list[int]] = {(): [1, 0, 0]}
            blocks: set[int] = set()
            for path, off, main, text in parsed(page or ""):
                own = seen.setdefault(path, [0, 0, 0])
                if text is None:
                    own[0] += 1
                    own[2] |= main == len(path) - 1 and not off
                elif not off:
                    blocks.add(block_key(path, text))
                    for depth in range(1, len(path) + 1):
                        seen.setdefault(path[:depth], [0, 0, 0])[1] += len(text)
            rows = [(number, host, "/".join(path), 0, *found) for path, found in seen.items()]
            rows += [(number, host, None, block, 1, 0, 0) for block in blocks]
            for name, values in zip(names, zip(*rows)):
                out[name] += values
        yield pa.RecordBatch.from_pydict(
            dict(out), schema=pa.schema([("page", pa.int64()), ("host", pa.string()), ("path", pa.string()),
                                         ("block", pa.int64()), ("n", pa.int64()), ("size", pa.int64()),
                                         ("main", pa.int64())])
        )

    # Copies of a page are one page: they say nothing of what pages share. Only copies are shuffled.
    numbered = pages.select(F.xxhash64("host", "html").alias("page"), "host", "html")
    copied = stored(numbered.groupBy("page").count().filter("count > 1").select("page"), "copied")
    different = numbered.join(copied, "page", "left_anti").unionByName(
        numbered.join(copied, "page", "left_semi").dropDuplicates(["page"])
    )
    tokens = arrow_map(
        different, count,
        "page bigint, host string, path string, block bigint, n bigint, size bigint, main bigint",
    )
    vectors = tokens.groupBy("host", "path", "block").agg(
        F.count("*").alias("pages"), F.min("n").alias("least"), F.max("n").alias("most"), F.max("main").alias("main"),
        F.sum("size").alias("size"), F.bit_xor(F.xxhash64("page", "n")).alias("vector"),
    )
    vectors = stored(vectors.filter(F.col("path").isNotNull() | (F.col("pages") >= LEAST_PAGES)), "vectors")
    total = vectors.filter("path = ''").select("host", F.col("pages").alias("all_pages"))
    common = vectors.join(total, "host").filter(F.col("pages") >= F.col("all_pages") * SHARE_OF_PAGES)
    valid = common.filter((F.col("path") != "") & (F.col("least") == F.col("most")) & (F.col("pages") > 1))
    # A class is one vector; half of the pages bounds the classes of a host by a page's size.
    classes = valid.groupBy("host", "vector", "pages", F.col("least").alias("repeat")).agg(
        F.sort_array(F.collect_list(F.struct("path", "size", "main"))).alias("found")
    ).select("host", "vector", "pages", "repeat", *(F.col(f"found.{c}").alias(f"{c}s") for c in ("path", "size", "main")))
    ordered = classes.groupBy("host").agg(
        F.sort_array(F.collect_list(F.struct("paths", "repeat", "pages", F.col("sizes").alias("texts"), "mains"))).alias("classes")
    )
    # The same bound holds for the blocks.
    constant = common.filter("path IS NULL").groupBy("host").agg(F.sort_array(F.collect_list("block")).alias("constant"))
    ordered = ordered.join(constant, "host", "full")

    def nest(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = []
        for host, found, constant in zip(*(batch.column(c).to_pylist() for c in ("host", "classes", "constant"))):
            found = found or []
            owner = {path: at for at, c in enumerate(found) for path in c["paths"]}
            for at, c in enumerate(found):
                above = c["paths"][0].split("/")[:-1]
                while above and owner.get("/".join(above), at) == at:
                    above.pop()
                c["parent"] = owner.get("/".join(above), -1) if above else -1
            rows.append({"host": host, "classes": found, "slot": main_slot(found), "constant": constant})
        yield pa.RecordBatch.from_pylist(rows, schema=NESTED)

    return arrow_map(
        ordered, nest,
        "host string, classes array<struct<paths:array<string>,`repeat`:bigint,pages:bigint,texts:array<bigint>,"
        "mains:array<bigint>,parent:bigint>>, slot string, constant array<bigint>",
    )


NESTED = pa.schema([
    ("host", pa.string()),
    ("classes", pa.list_(pa.struct([("paths", pa.list_(pa.string())), ("repeat", pa.int64()), ("pages", pa.int64()),
                                    ("texts", pa.list_(pa.int64())), ("mains", pa.list_(pa.int64())),
                                    ("parent", pa.int64())]))),
    ("slot", pa.string()),
    ("constant", pa.list_(pa.int64())),
])


def block_key(path: tuple[str, ...], text: str) -> int:
    """A block's text and the element it is directly in, as 64 bits."""
    raw = f"{path[-1] if path else ''} {text}".encode(errors="surrogatepass")
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)


def main_slot(classes: list[dict] | None) -> str | None:
    """The template's container with the most text of its own.

    Containers are elements found once a page. The text of every other element, repeated and
    optional ones included, belongs to the nearest container around it. A container that marks
    the main text by name is given all that it encloses, and goes before larger ones that do not
    (reader comments outgrow many an article) unless it holds next to nothing.
    """
    marked = {path for c in classes or [] for path, main in zip(c["paths"], c["mains"]) if main}
    inside = {
        path: size for c in classes or [] if c["repeat"] == 1 for path, size in zip(c["paths"], c["texts"])
        if path.split("/")[-1].split(".")[0] not in BLOCKS
    }
    own = dict(inside)
    for path, size in inside.items():
        above = path.split("/")[:-1]
        while above and "/".join(above) not in own:
            above.pop()
        if above:
            own["/".join(above)] -= size
    own |= {path: size for path, size in inside.items() if path in marked}
    best = max(own, key=lambda path: (own[path], path), default=None)
    named_best = max(marked & own.keys(), key=lambda path: (own[path], path), default=None)
    if named_best is not None and own[named_best] >= MARKED_SHARE * own[best]:
        best = named_best
    return best if best is not None and own[best] > 0 else None


def main_text(page: str, slot: str | None, constant: frozenset[int] = frozenset()) -> str:
    """Blocks of the page's main part without the host's constant ones, joined by an empty line.

    The main part is the slot, or the elements in it that mark the main text, if those have at
    least half of its text. A page that has nothing in the slot gives its marked elements, or
    all. Where the constant blocks are most of the main part, near copies share the article
    itself, and all of it stays.
    """
    found = []
    for path, off, main, text in parsed(page):
        if text is not None and not off:
            found.append((slot is not None and ("/".join(path) + "/").startswith(slot + "/"), main >= 0, text,
                          bool(constant) and block_key(path, text) in constant))
    part = [b for b in found if b[0]]
    if part:
        marked = [b for b in part if b[1]]
        if 2 * characters(marked) >= characters(part):
            part = marked
    part = part or [b for b in found if b[1]] or found
    left = [b for b in part if not b[3]]
    least = LEFT_OF_MARKED if all(b[1] for b in part) else LEFT_OF_ANY
    return "\n\n".join(b[2] for b in (left if characters(left) >= least * characters(part) else part))


def characters(blocks: list[tuple]) -> int:
    return sum(len(b[2]) for b in blocks)


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(page_id, url, text, n_chars) of every row.

    A null page is empty and gives the empty text; a null url belongs to the host ''. Repeated
    rows each get their result. A page gives its host's main slot without the constant blocks;
    without a template, its article or main element, or all that is not boilerplate by name.
    """
    rows = hosted(pages, id_col, url_col, html_col)
    found = stored(templates(rows.select("host", "html")).select("host", "slot", "constant"), "templates")
    joined = rows.join(found, "host", "left").select("page_id", "url", "html", "slot", "constant")
    kind = rows.schema["page_id"].dataType.simpleString()

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = []
        for page, slot, constant in zip(*(batch.column(c).to_pylist() for c in ("html", "slot", "constant"))):
            texts.append(main_text(page or "", slot, frozenset(constant or ())))
        yield pa.record_batch(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )

    return arrow_map(joined, of, f"page_id {kind}, url string, text string, n_chars bigint")


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
