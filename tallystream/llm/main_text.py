"""HTML extraction by the maximum-scoring subsequence.

A page is a sequence of words and tags. Words score above zero and tags below;
the stretch with the greatest sum is the content. The weights come from labelled
pages: those with exactly one ``article`` or ``main`` element, whose inside is the
content. They are counted over all such pages of the table. Elements that hold no
article text (menus, headers and footers of the page, sidebars, notices, adverts,
forms, scripts, styles, reader comments) are no words and are left out of the
stretch as well.

White space is what ``str.isspace`` takes for it. Null and empty pages, and pages
without words, have an empty text. A tag that the page's end cuts off is no text.
Repeated pages each get a row. Without labelled pages fixed weights are used. Of two
stretches with the same sum the first is taken. Very long pages are read whole, one at a
time. An empty table gives no rows. Only page_id, url and html are read; other columns
may have any name.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystream.llm.texts import slices

# Elements by their role in HTML.
RAW = ("script", "style", "textarea", "title", "xmp", "noembed", "noframes")
DROPPED = set(
    "head nav aside form noscript template iframe svg math canvas select button dialog menu "
    "object audio video map datalist".split()
)
PAGE_FRAME = {"header", "footer"}  # a header inside the article is the article's
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CONTENT = {"article", "main"}
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark "
    "math q rp rt ruby s samp small span strike strong sub sup svg time tt u var wbr".split()
)
BLOCKS = set(
    "address article aside blockquote body caption center colgroup dd details dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup html "
    "legend li main nav ol optgroup option p pre search section summary table tbody td tfoot th "
    "thead tr ul".split()
)
KNOWN = BLOCKS | INLINE | VOID | DROPPED | set(RAW)  # other tags are weighted together
# A class or id names what an element is not for the article if one of its parts is in the
# first set and all are in one of both: main-menu, but neither has-sidebar nor related-work.
NOT_ARTICLE = set(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promos "
    "promotion cookie cookies consent notice popup modal newsletter subscribe sidebar menu nav "
    "navbar navigation breadcrumb breadcrumbs footer masthead comment comments commentlist disqus "
    "respond replies share sharing social related widget widgets login search pagination pager "
    "toolbar topbar".split()
)
BESIDE = set(
    "main site page global top bottom left right primary secondary header bar box list item "
    "links link block area section container wrapper wrap inner outer form buttons button icons "
    "panel slot unit overlay posts post articles article text message reply module region".split()
)
HEADERS = {"site-header", "page-header", "main-header", "top-header", "global-header"}
COMMENTS = set("comment comments commentlist disqus respond replies".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)"
    r"(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?P<end>>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
# Names and values in turn, so that nothing within a value is taken for a name.
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?|["'][^"']*["']?""")
_PARTS = re.compile(r"[-_]+|(?<=[a-z])(?=[A-Z])")
FIXED_WORD, FIXED_TAG = 1.0, -1.5


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """("text", text, ""), ("open", tag, attributes), ("close", tag, "") in page order."""
    at = 0
    while at < len(page):
        start = page.find("<", at)
        if start < 0:
            yield "text", page[at:], ""
            return
        if start > at:
            yield "text", page[at:start], ""
        found = _TOKEN.match(page, start)
        if not found:
            # A lone "<" is text; a tag with an unclosed quote ends at its first ">".
            end = page.find(">", start)
            name = re.match(r"</?([A-Za-z][^\s/>]*)", page[start : start + 64])
            if not name:
                yield "text", "<", ""
                at = start + 1
                continue
            close = page[start + 1 : start + 2] == "/"
            at = len(page) if end < 0 else end + 1
            if end >= 0:
                yield "close" if close else "open", name[1].lower(), ""
            continue
        at = found.end()
        name = (found["name"] or "").lower()
        if not name or found["end"] == "":
            continue
        if found["close"]:
            yield "close", name, ""
            continue
        yield "open", name, found["attributes"]
        if name in RAW and not found["attributes"].endswith("/"):
            end = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = end.start() if end else len(page)


def attributes_of(text: str) -> dict[str, str]:
    """The attributes in a tag by lower-case name, the first of a name; "" without a value."""
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(text):
        if name:
            found.setdefault(name.lower(), "".join(values))
    return found


def names_other(names: str) -> set[str]:
    """Parts of the classes or ids that say the element is not for the article."""
    found: set[str] = set()
    for name in names.split():
        if name.lower() in HEADERS:
            return {name.lower()}
        parts = {p.lower() for p in _PARTS.split(name) if p}
        if parts & NOT_ARTICLE and parts <= NOT_ARTICLE | BESIDE:
            found |= parts & NOT_ARTICLE
    return found


def dropped_for(name: str, attributes: str, inside: bool) -> str:
    """Why an element holds no article text: "tag", "comments", "name", or "" if it may.

    Inside content, headings, sections and paragraphs stay, and ids mean nothing: they are
    often made from headings.
    """
    if name in RAW or name in DROPPED or name == "footer" or (name in PAGE_FRAME and not inside):
        return "tag"
    if not attributes or name in ("html", "body"):
        return ""
    found = attributes_of(attributes)
    if "hidden" in found or found.get("aria-hidden", "").strip().lower() == "true":
        return "tag"
    if found.get("role", "").strip().lower() in ROLES:
        return "name"
    if inside and (name in HEADINGS or name in ("section", "p")):
        return ""
    other = names_other(f"{found.get('class', '')} {'' if inside else found.get('id', '')}")
    if other & COMMENTS:
        return "comments"
    # Content may be of class post or banner, but not of reader comments.
    return "name" if other and name not in CONTENT else ""


def sequence(page: str) -> list[tuple[str, str, bool]]:
    """(kind, value, inside content): what is left of a page without dropped elements.

    Dropped elements leave their tags. One that is never closed ends where an
    element around it does, and a menu or page frame also where content begins. Content
    within other dropped elements (a form around the page, a div named so) is kept, but
    for content in reader comments, templates and the like.
    """
    out: list[tuple[str, str, bool]] = []
    stack: list[tuple[str, str, int]] = []  # name, why dropped, drops around it
    dropped = inside = 0

    def leave(depth: int) -> None:
        nonlocal dropped, inside
        if depth < len(stack):
            dropped = stack[depth][2]
        inside -= sum(name in CONTENT for name, _, _ in stack[depth:])
        del stack[depth:]

    for kind, value, attributes in tokens(page):
        if kind == "text":
            if not dropped:
                out.append(("text", value, inside > 0))
        elif kind == "open":
            if value in CONTENT and dropped:
                frame = next((d for d, (_, why, _) in enumerate(stack) if why), None)
                if frame is not None and stack[frame][0] in PAGE_FRAME | {"nav", "head"}:
                    leave(frame)
            out.append(("open", value, inside > 0))
            if value in VOID or attributes.rstrip().endswith("/"):
                continue
            if value in ("p", "li", "dt", "dd", "option") and stack and stack[-1][0] == value:
                leave(len(stack) - 1)
            why = dropped_for(value, attributes, inside > 0)
            around = dropped
            if value in CONTENT and all(w in ("", "name") or n == "form" for n, w, _ in stack):
                dropped = 0
            stack.append((value, why, around))
            dropped += bool(why)
            inside += value in CONTENT
        else:
            depth = next((d for d in range(len(stack) - 1, -1, -1) if stack[d][0] == value), None)
            if depth is not None:
                leave(depth)
            out.append(("close", value, inside > 0))
    return out


def _kind(tag: str) -> str:
    return tag if tag in KNOWN else "?"


def tag_counts(pages: DataFrame) -> dict[str, tuple[int, int]]:
    """How often words and each tag stand inside and outside content, over labelled pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inner, outer = Counter(), Counter()
        for batch in batches:
            for part in slices(batch, "html"):
                for page in part.column("html").to_pylist():
                    if not page or len(re.findall(r"<(?:article|main)[\s>]", page, re.I)) != 1:
                        continue
                    for kind, value, inside in sequence(page):
                        counts = inner if inside else outer
                        if kind == "text":
                            counts[""] += len(value.split())
                        elif value not in CONTENT:
                            counts[_kind(value)] += 1
        names = list({*inner, *outer})
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.string()),
                pa.array([inner[n] for n in names], pa.int64()),
                pa.array([outer[n] for n in names], pa.int64()),
            ],
            ["tag", "inner", "outer"],
        )

    counted = pages.select(F.coalesce("html", F.lit("")).alias("html")).mapInArrow(
        run, "tag string, inner long, outer long"
    )
    total = counted.groupBy("tag").agg(F.sum("inner").alias("inner"), F.sum("outer").alias("outer"))
    return {r.tag: (r.inner, r.outer) for r in total.collect()}  # at most one row a known tag


def weights(pages: DataFrame) -> dict[str, float]:
    """Scores of a word ("") and of tags: log odds of standing inside, with fixed signs."""
    counts = tag_counts(pages)
    words = counts.pop("", (0, 0))
    if not words[0]:
        return {"": FIXED_WORD}
    odds = lambda inner, outer: math.log((inner + 0.5) / (outer + 0.5))
    # Within bounds that carry over to pages of another layout than the labelled ones.
    found = {tag: max(-2.0, min(-0.05, odds(*c))) for tag, c in counts.items()}
    found[""] = max(0.5, min(2.0, odds(*words)))
    return found


def best_stretch(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous stretch with the greatest sum; empty if none is above 0."""
    best, span, total, start = 0.0, (0, 0), 0.0, 0
    for at, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, at
        total += score
        if total > best:
            best, span = total, (start, at + 1)
    return span


def extract(page: str | None, score: dict[str, float]) -> str:
    """The main text of a page: its blocks, with single spaces, joined by an empty line."""
    if not page:
        return ""
    parts = sequence(page)
    values = [
        len(value.split()) * score[""] if kind == "text" else score.get(_kind(value), FIXED_TAG)
        for kind, value, _ in parts
    ]
    # Content elements are where labels come from: the weakest of tags, so that none is learnt.
    values = [-0.05 if k != "text" and v in CONTENT else x for (k, v, _), x in zip(parts, values)]
    start, end = best_stretch(values)
    blocks, block = [], []
    for kind, value, _ in parts[start:end]:
        if kind == "text":
            block.append(value)
        elif value == "br":
            block.append(" ")
        elif value not in INLINE:
            blocks.append("".join(block))
            block = []
    blocks.append("".join(block))
    texts = (" ".join(html.unescape(b).split()) for b in blocks)
    return "\n\n".join(t for t in texts if t)


def main_texts(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    score = weights(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                texts = [extract(p, score) for p in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("page_id"),
                        part.column("url"),
                        pa.array(texts, pa.string()),
                        pa.array(map(len, texts), pa.int64()),
                    ],
                    ["page_id", "url", "text", "n_chars"],
                )

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long"
    )
