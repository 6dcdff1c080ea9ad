"""Main text of web pages by deduction of their site's template.

Pages of a host share a template: its tags and fixed texts surround slots that hold what differs. Each
page is read as a row of tokens: opening and closing tags of structural elements, told apart by their
path, and texts. The occurrence vector of a token says how often it stands in each of the pages, and
tokens with equal vectors form an equivalence class. Pages without tokens are left out, and a class needs
half of the others, so that stubs and pages of another layout take nothing from the template. A class is
valid if its tokens stand in one order in all of its pages. The frame is the class with the most tokens
among those that occur once in each of their pages; tokens of other classes are nested into a slot of the
frame, if all their occurrences lie there. The gaps between the frame's tokens, with the nested classes,
are the slots to extract. A text that is not on all pages, in varying numbers, goes only where it is the
whole of its block, since it may as well be a part of a sentence.

A slot is boilerplate if the elements around it say so: navigation, header, footer, aside, forms, scripts
and the like by name, or menus, sidebars, notices, adverts and comments by their class, id or role. Texts
that belong to the template's valid classes are not main text. An `article` or `main` element is a hint on
slots: within it, a template's text goes only if its path holds nothing but template texts on all pages
of the group, since a path that also holds own texts is a slot, and a paragraph may well recur in it; a
heading stays if the text it heads does. Names count within it only if all their parts are of that kind. If
slots of such elements hold text, that is the main text; otherwise it is that of all other slots.

Each host's pages are dealt into groups of about `group_pages` by a hash of their id, URL and text, so that
the groups depend neither on partitions nor on other hosts. A host of any size is thus many tasks' work:
those with at least one in `1 / heavy_share` pages, of which there are at most `1 / heavy_share`, are
spread over tasks by groups, with their numbers of groups broadcast; the pages of others, at most
`heavy_share` of all, meet in one task, which counts and then groups them likewise. Equal pages of a group
count as one when classes are formed.

Defined results: a null page is an empty one, and an empty page has the text ''. Broken mark-up is read
as it comes: elements end with their parent, an unclosed comment or script ends the page. Pages without
a host form a host of their own. Null and repeated ids are carried along, one row each. An empty table
gives no rows. Other columns are not read.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hackney.llm.common import pick
from hackney.llm.url_rules import host_and_path

GROUP_PAGES = 64
HEAVY_SHARE = 1e-5

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?>=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)>|[^<]+|<",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_NAME_PARTS = re.compile(r"[^a-z0-9]+")

RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math"}
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
    "track", "wbr",
}
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font",
    "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span",
    "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
#: An opening tag that ends an open element of the named kinds.
ENDS = {
    "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"},
}
SCOPES = {"ul", "ol", "dl", "table", "article", "main", "section", "div", "body", "nav", "aside"}
BOILERPLATE_TAGS = {
    "head", "nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "object",
    "fieldset", "canvas", "audio", "video", "map",
} | RAW
BOILERPLATE_ROLES = {
    "navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert",
    "menu", "menubar", "toolbar",
}
BOILERPLATE_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "sponsor",
    "sponsored", "promo", "promotion", "sidebar", "sidebars", "side", "rail", "menu", "menus", "nav",
    "navbar", "navigation", "breadcrumb", "breadcrumbs", "topbar", "masthead", "footer", "cookie",
    "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup", "modal", "overlay",
    "newsletter", "subscribe", "subscription", "signup", "login", "search", "share", "sharing",
    "social", "related", "recommended", "comment", "comments", "discussion", "replies", "disqus",
    "widget", "widgets", "toolbar", "pagination", "pager", "skip",
}
#: Parts of names that say nothing of the content.
PLAIN_NAMES = {
    "area", "bar", "block", "box", "button", "buttons", "container", "content", "form", "group", "inner", "item",
    "items", "link", "links", "list", "outer", "panel", "post", "posts", "section", "slot", "thread", "title", "top",
    "bottom", "left", "right", "unit", "wrap", "wrapper",
}
LANDMARKS = {"article", "main"}
_HEADING = re.compile(r"/h[1-6](?:\.[^/]*)?$")


@dataclass
class Element:
    tag: str
    path: str
    boilerplate: bool
    landmark: bool


@dataclass
class Page:
    """Tokens in order; `texts` has (position, block, path, inside a landmark, text) of main text."""

    tokens: list[tuple[str, str, str]] = field(default_factory=list)
    texts: list[tuple[int, int, str, bool, str]] = field(default_factory=list)


def _says_boilerplate(tag: str, attributes: str, in_landmark: bool) -> tuple[bool, str]:
    """Whether an element holds no main text, and what tells it from others of its tag."""
    if tag in BOILERPLATE_TAGS or (tag == "header" and not in_landmark):
        return True, tag
    names = []
    found = False
    for name, value in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name not in ("class", "id", "role"):
            continue
        value = value.strip("\"'").lower()
        names.append(value)
        if name == "role":
            found = found or value in BOILERPLATE_ROLES
        elif tag not in ("html", "body"):
            found = found or any(_named(word, in_landmark) for word in value.split())
    if not in_landmark and any("header" in _NAME_PARTS.split(n) for n in names):
        found = found or tag not in ("html", "body", "article", "main", "h1")
    return found, ".".join([tag, *names])


def _named(word: str, in_landmark: bool) -> bool:
    """Whether a class or id names boilerplate; within a landmark all of its parts have to agree."""
    parts = {part for part in _NAME_PARTS.split(word) if part}
    if not in_landmark:
        return not BOILERPLATE_NAMES.isdisjoint(parts)
    return not BOILERPLATE_NAMES.isdisjoint(parts) and parts <= BOILERPLATE_NAMES | PLAIN_NAMES


def read_page(text: str) -> Page:
    page = Page()
    stack = [Element("", "", False, False)]
    block = 0
    position, end = 0, len(text)
    while position < end:
        match = _TOKEN.match(text, position)
        if match is None:  # a tag that never ends
            break
        position = match.end()
        tag = match[2]
        if tag is None:
            part = match[0]
            if part.startswith(("<!", "<?")):
                continue
            top = stack[-1]
            if not top.boilerplate:
                page.texts.append((len(page.tokens), block, top.path, top.landmark, part))
            if part.strip():
                page.tokens.append(("text", top.path, part.strip()))
            continue
        tag = tag.lower()
        if match[1]:
            if tag not in INLINE:
                block += 1
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    if tag not in INLINE:
                        page.tokens.append(("end", stack[depth].path, tag))
                    del stack[depth:]
                    break
            continue
        if tag == "br":
            top = stack[-1]
            if not top.boilerplate:
                page.texts.append((len(page.tokens), block, top.path, top.landmark, " "))
            continue
        if tag not in INLINE:
            block += 1
            # A paragraph ends where another block begins; list and table parts end their like.
            ended = ENDS.get(tag, {"p"})
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in ended:
                    del stack[depth:]
                elif stack[depth].tag in SCOPES:
                    break
        if tag in VOID:
            continue
        top = stack[-1]
        boilerplate, name = _says_boilerplate(tag, match[3] or "", top.landmark)
        path = top.path if tag in INLINE and not boilerplate else f"{top.path}/{name}"
        element = Element(
            tag,
            path,
            top.boilerplate or boilerplate,
            top.landmark or (tag in LANDMARKS and not boilerplate),
        )
        if tag not in INLINE:
            page.tokens.append(("begin", path, tag))
        if (match[3] or "").endswith("/") and tag in ("svg", "math"):
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.IGNORECASE).search(text, position)
            position = close.end() if close else end
            continue
        stack.append(element)
    return page


@dataclass
class Template:
    """The frame's tokens in order, the texts that belong to valid classes, and the paths of other texts.

    `loose` has the texts that are not on all pages, in varying numbers.
    """

    frame: list[tuple[str, str, str]]
    nested: dict[tuple[str, str, str], int]
    texts: set[tuple[str, str, str]]
    slots: set[str]
    loose: set[tuple[str, str, str]]

    def holds(self, path: str, text: str, inside: bool) -> bool:
        """Whether the template holds a text, rather than one of its slots."""
        return ("text", path, text.strip()) in self.texts and not (inside and path in self.slots)


def deduce_template(pages: list[Page]) -> Template:
    """The template of several distinct pages; nothing can be told from one page."""
    pages = [page for page in pages if page.tokens]
    if len(pages) < 2:
        return Template([], {}, set(), set(), set())
    vectors: dict[tuple[str, str, str], dict[int, int]] = defaultdict(dict)
    for number, page in enumerate(pages):
        for token, times in Counter(page.tokens).items():
            vectors[token][number] = times
    classes = defaultdict(list)
    for token, vector in vectors.items():
        if len(vector) > 1 and 2 * len(vector) >= len(pages):
            classes[tuple(sorted(vector.items()))].append(token)
    once = [v for v in classes if all(times == 1 for _, times in v)]
    base = max(once, key=lambda v: (len(classes[v]), len(v), v), default=())
    frame = _in_order(classes.pop(base, []), pages, [n for n, _ in base])
    members = set(frame)
    inner = {token for tokens in classes.values() for token in tokens}
    framed = dict(base)
    slots: dict[tuple[str, str, str], set[int]] = defaultdict(set)
    for number, page in enumerate(pages):
        if frame and number not in framed:
            continue
        place = [at for at, token in enumerate(page.tokens) if token in members]
        for at, token in enumerate(page.tokens):
            if token in inner:
                slots[token].add(bisect_right(place, at))
    nested = {}
    for vector, tokens in classes.items():
        by_slot = defaultdict(list)
        for token in tokens:
            if len(slots[token]) <= 1:  # none: on pages without the frame only
                by_slot[next(iter(slots[token]), -1)].append(token)
        for slot, some in by_slot.items():
            for token in _in_order(some, pages, [n for n, _ in vector]):
                nested[token] = slot
    texts = {t for t in [*frame, *nested] if t[0] == "text"}
    paths = {path for kind, path, _ in vectors.keys() - texts if kind == "text"}
    loose = {
        t for t in texts if len(vectors[t]) < len(pages) and len(set(vectors[t].values())) > 1
    }
    return Template(frame, nested, texts, paths, loose)


def _in_order(tokens: list, pages: list[Page], numbers) -> list:
    """The class's tokens by their place, without those whose order differs between pages."""
    order = None
    for number in numbers:
        first = {}
        for at, token in enumerate(pages[number].tokens):
            first.setdefault(token, at)
        here = sorted(tokens, key=first.__getitem__)
        if order is None:
            order = here
        elif order != here:
            rank = {token: k for k, token in enumerate(here)}
            kept, last = [], -1
            for token in order:
                if rank[token] > last:
                    kept.append(token)
                    last = rank[token]
            order = tokens = kept
    return order or []


def main_text(page: Page, template: Template) -> str:
    """The texts of the page's slots, block by block."""
    held = [template.holds(path, text, inside) for _, _, path, inside, text in page.texts]
    slots = {t[1] for t, fixed in zip(page.texts, held, strict=True) if not fixed and t[4].strip()}
    own = [
        t
        for t, fixed in zip(page.texts, held, strict=True)
        if not fixed or (t[1] in slots and ("text", t[2], t[4].strip()) in template.loose)
    ]
    # A heading goes with what it heads: the article's own text, or more of the template.
    after = False
    for t, fixed in zip(reversed(page.texts), reversed(held)):
        if not t[4].strip() or not t[3]:
            continue
        if not _HEADING.search(t[2]):
            after = not fixed
        elif fixed and after:
            own.append(t)
    own.sort(key=lambda t: t[0])
    landmarks = any(inside and text.strip() for _, _, _, inside, text in own)
    blocks: dict[int, list[str]] = {}
    for _, block, _, inside, text in own:
        if inside or not landmarks:
            blocks.setdefault(block, []).append(html.unescape(text))
    lines = (" ".join("".join(parts).split()) for _, parts in sorted(blocks.items()))
    return "\n".join(line for line in lines if line)


def extract_group(pages: list[str]) -> list[str]:
    """Main texts of pages of one host."""
    read = {}
    for text in pages:
        if text not in read:
            read[text] = read_page(text)
    template = deduce_template(list(read.values()))
    done = {text: main_text(page, template) for text, page in read.items()}
    return [done[text] for text in pages]


def extract(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    group_pages: int = GROUP_PAGES,
    heavy_share: float = HEAVY_SHARE,
) -> DataFrame:
    """`page_id, url, text` of every page."""
    host, _ = host_and_path(F.col("url"))
    rows = pick(pages, page_id=id_col, url=url_col, html=html_col).select(
        F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host")
    )
    counts = rows.groupBy("host").agg(F.count("*").alias("n"))
    total = rows.count()
    heavy = counts.where(F.col("n") >= max(group_pages, heavy_share * total)).select(
        "host", F.ceil(F.col("n") / group_pages).alias("groups")
    )
    # At most 1 / heavy_share hosts.
    dealt = rows.withColumn("dealt", F.xxhash64("page_id", "url", "html")).join(
        F.broadcast(heavy), "host", "left"
    )
    place = F.xxhash64("dealt")
    part = F.pmod(place, F.coalesce("groups", F.lit(1).cast("long")))
    in_part = Window.partitionBy("host", "part")
    groups = F.ceil(F.count("*").over(in_part) / group_pages)

    def run(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Copies of one page may make a group large; what is left at the end is no less than the others.
        held, size = [], 0
        for batch in group:
            for lo in range(0, batch.num_rows, group_pages):
                held.append(batch.slice(lo, group_pages))
                size += held[-1].num_rows
                if size >= 4 * group_pages:
                    yield extracted(held[: len(held) // 2])
                    held = held[len(held) // 2 :]
                    size = sum(b.num_rows for b in held)
        if size:
            yield extracted(held)

    def extracted(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        both = pa.Table.from_batches(batches).combine_chunks()
        texts = extract_group(both.column("html").to_pylist())
        return pa.RecordBatch.from_arrays(
            [
                both.column("page_id").combine_chunks(),
                both.column("url").combine_chunks(),
                pa.array(texts, pa.string()),
            ],
            names=["page_id", "url", "text"],
        )

    return (
        dealt.select("host", part.alias("part"), "groups", "dealt", "page_id", "url", "html")
        .repartition("host", "part")
        .withColumn("group", F.when(F.col("groups").isNull(), F.pmod(place, groups)))
        .drop("groups")
        .sortWithinPartitions("host", "part", "group", "dealt")
        .groupBy("host", "part", "group")
        .applyInArrow(run, "page_id long, url string, text string")
    )
