"""Main text of web pages by wrappers inferred from pages of the same host.

Layouts. A page's layout is the set of its containers near the root. Pages of a host are put together by
layout, whatever their number, and each layout that more than one page has gets a wrapper of its own; a
host has one from all its pages besides, for pages whose layout is theirs alone.

Wrapper. A page is a stream of block tags and texts; inline tags are part of their text. Within a stream,
neighbouring repeats of a group of tokens become one repeated group ``( )+``. Two streams are then
aligned: tokens that both have stay, a text that differs becomes a slot, and what only one has
becomes an optional group ``( )?``; where such groups come again and again, they are one repeated group of
optional ones, so that an expression grows with what is different in its pages and not with their number. Aligning
all pages gives a regular expression without unions, the wrapper.

Region. Slots hold what varies from page to page, other texts are the template. The main region is the
element path of an article or main element that holds text, else the deepest path with
most of the slots' text; menus, adverts, forms, comments and the like never count. Every page
of the layout is read through that region; a page that has no such element is its own wrapper.

Text. Blocks are runs of text between block tags; white space in a block is one blank (``br`` is white
space), blocks are joined by line feeds in page order; character references are decoded. Inside the
region the parts named above are left out, and so are the template's texts: a block that stands at the same path
with the same text on ``TEMPLATE`` of the layout's pages, three at least, is no part of any article. Where such
blocks would be half of a page's text or more, the pages are copies of each other and all stays.

No page is left out: pages are dealt into parts by their content, equal ones into one, and those of a part are aligned
one after another; a slot holds the size of its texts by path, and the text as long as all are equal. Then ``FAN``
expressions at a time are aligned, in rounds, until a layout has one. A host's wrapper is aligned from those of its
layouts. Template texts are counted over all pages. Extraction runs over all pages as they lie. Wrappers
(a path and a few hashes for each layout) are written first, so that Spark knows their size when it
joins them to the pages.

Defined cases: null or empty html gives an empty text; pages without host (null or broken url) share the
empty host; repeated rows give a row each; broken markup is read as far as it goes; an empty table
gives an empty result.
"""

from __future__ import annotations

import html as html_module
import pickle
import re
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Collection, Iterable, Iterator
from hashlib import blake2b
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .common import Store, table

#: Pages, or expressions of parts of them, that one part holds, about.
FAN = 64
#: Pages to a task that aligns.
TASK = 4096
#: Longest group of tokens that is looked for as a repeat.
LONGEST_GROUP = 16
#: Share of a layout's pages that have a text of the template.
TEMPLATE = 2 / 3
#: Tokens in a row that may anchor an alignment.
RUNS = (1, 2, 4, 8)
#: Depth to which containers make a layout.
DEPTH = 4

#: Elements that make blocks, that have no end tag, whose content is not markup.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math object canvas audio video head select button".split())
#: Elements, roles and names (words of class or id) of what is not article.
ASIDE_TAGS = frozenset("nav footer aside form dialog menu fieldset header".split()) | (RAW - {"head"})
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
ASIDE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox adslot sponsor sponsored sponsors promo promos promotion banner "
    "comment comments commentlist respond reply replies disqus discussion sidebar sidebars aside widget widgets menu menus nav navbar "
    "navigation breadcrumb breadcrumbs footer header masthead topbar notice notices cookie cookies consent gdpr alert popup modal overlay "
    "newsletter subscribe subscription signup share sharing social related recommended recommendations pagination pager toolbar login "
    "search form hidden skip".split())
#: Names that also describe articles (long-form, alert-story, discussion of results). They tell what is not
#: article only as the last word of a name, which may be followed by words that tell nothing.
WEAK_NAMES = frozenset("alert discussion form hidden notice notices search skip".split())
PLAIN_NAMES = frozenset(
    "area bar block bottom box button buttons container content control danger dismissible field group holder info inline inner input item "
    "items label left link links list message outer panel right row section success text title to top unit warning wrap wrapper".split())
SHAPES = frozenset("long short free".split())
KEEP_TAGS = frozenset("html body article main h1".split())
CONTAINERS = frozenset("html body div section article main table tbody tr td center blockquote".split())
#: Tags that a start of the key tag ends, besides ``p``, which every block ends.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "option": {"option"}}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)", re.S)
_STOP = re.compile(r"[<>]|=\s*+([\"'])")
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?")
_NAME = re.compile(r"[a-z]+")


def aside_names(names: str) -> set[str]:
    """The words of class and id that tell what is not article."""
    found: set[str] = set()
    for name in names.split():
        words = _NAME.findall(name)
        found.update(w for w in words if w in ASIDE_NAMES and w not in WEAK_NAMES)
        while len(words) > 1 and words[-1] in PLAIN_NAMES:
            words.pop()
        if words and words[-1] in WEAK_NAMES and not (words[-1] == "form" and SHAPES.intersection(words)):
            found.add(words[-1])
    return found


class Element:
    __slots__ = ("tag", "sign", "path", "aside", "uid")

    def __init__(self, tag: str, attributes: str, above: "Element | None", uid: int):
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)} if attributes.strip() else {}
        names = f"{found.get('class', '')} {found.get('id', '')}".lower()
        self.tag, self.uid = tag, uid
        self.sign = tag + "".join(f".{re.sub(r'[0-9]+', '0', n)}" for n in sorted(set(names.split())))
        self.path = f"{above.path}>{self.sign}" if above else self.sign
        inside = above is not None and above.aside
        within = above is not None and re.search(r">(article|main)\b", f">{above.path}") is not None
        words = aside_names(names)
        if within:  # an article's own heading
            words.discard("header")
        own = tag in ASIDE_TAGS and not (tag == "header" and within)
        if tag not in KEEP_TAGS:
            own = own or found.get("role", "").lower() in ASIDE_ROLES or bool(words) or (
                "hidden" in found or found.get("aria-hidden", "").lower() == "true"
                or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I) is not None)
        elif tag in ("article", "main"):
            own = not {"comment", "comments", "reply", "ad", "advert", "sponsored"}.isdisjoint(words)
        self.aside = inside or bool(own)


def _tag_end(html: str, at: int, open_quotes: set[str]) -> int:
    """Place of the ``>`` of a tag whose attributes start at ``at``; -1 if it is no tag. A quoted value ends at
    its closing quote alone; a quote that is never closed (kept in ``open_quotes``, so that the rest is
    searched once) is like any other character."""
    while (m := _STOP.search(html, at)) is not None:
        if m[1] is None:
            return m.start() if m[0] == ">" else -1
        at = m.end()
        if m[1] not in open_quotes:
            closed = html.find(m[1], at)
            if closed >= 0:
                at = closed + 1
                continue
            open_quotes.add(m[1])
        return html.find(">", at)
    return -1


def events(html: str) -> Iterator[tuple[str, Element | None, str]]:
    """("start", element, ""), ("end", element, "") of block elements and ("text", innermost
    element, text) of blocks, with ends that the page leaves out."""
    stack: list[Element] = []
    held: list[str] = []
    uid = 0
    root = Element("#", "", None, 0)

    def text() -> Iterator[tuple[str, Element, str]]:
        words = " ".join("".join(held).split())
        held.clear()
        if words:
            yield "text", stack[-1] if stack else root, words

    def close(down_to: int) -> Iterator[tuple[str, Element, str]]:
        while len(stack) > down_to:
            yield "end", stack.pop(), ""

    at, size, last = 0, len(html), html.rfind(">")
    open_quotes: set[str] = set()
    while at < size:
        m = _TOKEN.search(html, at)
        if m is None:
            held.append(html_module.unescape(html[at:]))
            break
        if m.start() > at:
            held.append(html_module.unescape(html[at: m.start()]))
        at = m.end()
        if m[2] is None:
            continue
        if m.start() > last:
            held.append(html_module.unescape(html[m.start():]))
            break
        end = _tag_end(html, at, open_quotes)
        if end < 0:
            held.append("<")
            at = m.start() + 1
            continue
        attributes, at = html[at:end], end + 1
        tag = m[2].lower()
        if m[1]:
            places = [i for i, e in enumerate(stack) if e.tag == tag]
            if places:
                yield from text()
                yield from close(places[-1])
            elif tag in ("td", "th"):
                held.append(" ")
            continue
        if tag in RAW:
            if attributes.endswith("/") or tag == "head":
                continue
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*+>?", re.I).search(html, at)
            if end or tag != "title":
                at = end.end() if end else size
            continue
        block = tag in BLOCKS
        if block:
            yield from text()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag == "p" or stack[i].tag in ENDS.get(tag, ()):
                    yield from close(i)
                    break
                if stack[i].tag in ("ul", "ol", "dl", "table", "div", "section", "article", "td", "blockquote"):
                    break
        elif tag in ("br", "td", "th", "img", "input"):
            held.append(" ")
        inline_aside = not block and tag not in VOID and attributes and Element(tag, attributes, None, 0).aside
        if (block and tag not in VOID) or inline_aside:
            if inline_aside:
                yield from text()
            uid += 1
            stack.append(Element(tag, attributes, stack[-1] if stack else None, uid))
            yield "start", stack[-1], ""
    yield from text()
    yield from close(0)


# --- wrappers --------------------------------------------------------------------------------
# A node is (kind, key, content): ("tag", sign, None), ("text", "#", slot), ("plus", keys of its content, nodes),
# ("opt", key of its content, [node]), ("mix", "*", optional nodes that come in any order, repeatedly). A slot is a
# list: number of texts, the text if all are equal, size of the texts by path but for those that are no article anyway.


def _counts(element: Element | None) -> bool:
    return element is not None and not element.aside and element.tag != "#"


def stream(found: Iterable[tuple[str, Element | None, str]]) -> list[tuple]:
    """The nodes of the ``events`` of a page."""
    nodes = []
    for kind, element, text in found:
        if kind == "start":
            nodes.append(("tag", f"<{element.sign}>", None))
        elif kind == "end":
            nodes.append(("tag", f"</{element.tag}>", None))
        else:
            nodes.append(("text", "#", [1, text, {element.path: len(text)} if _counts(element) else {}]))
    return nodes


def merge(a: tuple, b: tuple) -> tuple:
    """One node for two that match; takes over the slots of ``a``."""
    if a[0] == "opt" or b[0] == "opt":
        one = merge(*(x[2][0] if x[0] == "opt" else x for x in (a, b)))
        return "opt", f"({one[1]})?", [one]
    if a[0] == "text":
        held, more = a[2], b[2]
        held[0] += more[0]
        held[1] = held[1] if held[1] == more[1] else None
        for path, size in more[2].items():
            held[2][path] = held[2].get(path, 0) + size
    elif a[0] == "plus":
        return "plus", a[1], align(a[2], b[2])
    elif a[0] == "mix":
        return optional([a, b])[0]
    return a


def optional(nodes: list[tuple]) -> list[tuple]:
    """Optional groups for nodes in a row; where one comes twice, a repeated group of them all."""
    found: dict[str, tuple] = {}
    again = False
    for node in nodes:
        again = again or node[0] == "mix"
        for one in node[2] if node[0] == "mix" else [node]:
            key = _bare(one)
            again = again or key in found
            found[key] = merge(found[key], one) if key in found else one
    groups = [x if x[0] == "opt" else ("opt", f"({x[1]})?", [x]) for x in found.values()]
    return [("mix", "*", groups)] if again else groups


def fold(nodes: list[tuple]) -> list[tuple]:
    """Neighbouring repeats of a group become one repeated group, short groups first."""
    for size in range(1, LONGEST_GROUP + 1):
        out, i = [], 0
        keys = [n[1] for n in nodes]
        while i < len(nodes):
            j = i + size
            if j < len(keys) and keys[i] == keys[j] and keys[i:j] == keys[j: j + size] and _balanced(keys[i:j]):
                group = nodes[i:j]
                while keys[i:i + size] == keys[j: j + size]:
                    group = [merge(x, y) for x, y in zip(group, nodes[j: j + size])]
                    j += size
                out.append(("plus", f"({''.join(n[1] for n in group)})+", group))
                i = j
            else:
                out.append(nodes[i])
                i += 1
        nodes = out
    return nodes


def _balanced(keys: list[str]) -> bool:
    """Whether a group holds whole elements or text."""
    depth = 0
    for key in keys:
        if key.startswith("</"):
            depth -= 1
        elif key.startswith("<"):
            depth += 1
        if depth < 0:
            return False
    return depth == 0 and bool(keys)


def _bare(node: tuple) -> str:
    if node[0] == "opt":
        return _bare(node[2][0])
    return node[1].removesuffix("+") if node[0] == "plus" else node[1]


def anchors(left: list, right: list) -> list[tuple[int, int]]:
    """Places of what both sides have once, as many as come in the same order."""
    here, there = Counter(left), Counter(right)
    place = {token: k for k, token in enumerate(right) if there[token] == 1}
    pairs = [(i, place[token]) for i, token in enumerate(left) if here[token] == 1 and token in place]
    # Longest increasing run of places: for each length the pair with the smallest end.
    ends: list[int] = []
    last: list[int] = []
    before = [-1] * len(pairs)
    for n, (_, k) in enumerate(pairs):
        at = bisect_left(ends, k)
        before[n] = last[at - 1] if at else -1
        ends[at:at + 1], last[at:at + 1] = [k], [n]
    chain, n = [], last[-1] if last else -1
    while n >= 0:
        chain.append(pairs[n])
        n = before[n]
    return chain[::-1]


def matched(left: list[str], right: list[str]) -> Iterator[tuple[bool, int, int, int, int]]:
    """Stretches of both sides in order: whether they are equal, and their bounds. What both begin and end
    with is equal; between, the sides are cut at the tokens, else at the runs of ``RUNS`` tokens, that both have
    once, and so on; what has no such run is not matched. Time is in proportion to length, but for sorting."""
    def between(i: int, j: int, k: int, m: int) -> Iterator[tuple[bool, int, int, int, int]]:
        head, tail = i, 0
        while i < j and k < m and left[i] == right[k]:
            i, k = i + 1, k + 1
        while j - tail > i and m - tail > k and left[j - 1 - tail] == right[m - 1 - tail]:
            tail += 1
        if i > head:
            yield True, head, i, k - (i - head), k
        end, last = j - tail, m - tail
        if i < end and k < last:
            for size in RUNS:
                cuts = anchors(*([tuple(x[at:at + size]) for at in range(a, b - size + 1)] for x, a, b in ((left, i, end), (right, k, last))))
                if cuts:
                    break
            points = [(i, k), *((i + a, k + b) for a, b in cuts), (end, last)]
            if cuts:
                for (a, c), (b, d) in zip(points, points[1:]):
                    yield from between(a, b, c, d)
            else:
                yield False, i, end, k, last
        elif i < end or k < last:
            yield False, i, end, k, last
        if tail:
            yield True, end, j, last, m

    return between(0, len(left), 0, len(right))


def align(a: list[tuple], b: list[tuple]) -> list[tuple]:
    """One expression for two: matches merge, the rest becomes optional."""
    out: list[tuple] = []
    for same, i, j, k, m in matched([_bare(x) for x in a], [_bare(x) for x in b]):
        if same:
            out.extend(merge(x, y) for x, y in zip(a[i:j], b[k:m]))
        else:
            out.extend(optional(a[i:j] + b[k:m]))
    return out


def wrapper(pages: list[str]) -> list[tuple]:
    """The expression of some pages."""
    nodes: list[tuple] = []
    for i, page in enumerate(pages):
        own = fold(stream(events(page)))
        nodes = align(nodes, own) if i else own
    return nodes


def expression(nodes: list[tuple]) -> str:
    """A wrapper as text: slots are ``#``, template texts stand as they are."""
    def one(n: tuple) -> str:
        if n[0] == "text":
            return n[2][1] if n[2][0] > 1 and n[2][1] is not None else "#"
        return n[1] if n[0] == "tag" else f"({expression(n[2])}){'?' if n[0] == 'opt' else '+'}"
    return "".join(one(n) for n in nodes)


def slots(nodes: list[tuple]) -> Iterator[list]:
    """The slots of an expression."""
    for kind, _, content in nodes:
        if kind == "text":
            yield content
        elif content:
            yield from slots(content)


def block_id(path: str, text: str) -> int:
    return int.from_bytes(blake2b(f"{path}\n{text}".encode(), digest_size=8).digest(), "big", signed=True)


def blocks_of(found: Iterable[tuple[str, Element | None, str]]) -> set[int]:
    """The different blocks of a page outside of what is no article anyway."""
    return {block_id(e.path, text) for kind, e, text in found if kind == "text" and _counts(e)}


def region(nodes: list[tuple], pages: int) -> str:
    """Path of the element that holds the main text; empty if there is none."""
    own: dict[str, int] = defaultdict(int)
    for number, text, sizes in slots(nodes):
        if not (pages > 2 and number > 1 and text is not None):
            for path, size in sizes.items():
                own[path] += size
    if not own:
        return ""
    mass: dict[str, int] = defaultdict(int)
    for path, size in own.items():
        while path:
            mass[path] += size
            path = path.rpartition(">")[0]
    total = max(mass.values())

    def named(test) -> str:
        good = [p for p in mass if test(p.rpartition(">")[2]) and mass[p] > 0.25 * total]
        return max(good, key=lambda p: (mass[p], -p.count(">"), p), default="")

    found = named(lambda s: re.match(r"article\b", s)) or named(lambda s: re.match(r"main\b", s))
    if found:
        return found
    containers = {p: m for p, m in mass.items() if re.match(r"(div|section|td|table|tbody|body|html|center)\b", p.rpartition(">")[2])}
    good = [p for p in containers if containers[p] >= 0.6 * total]
    return max(good, key=lambda p: (p.count(">"), containers[p], p), default=max(mass, key=lambda p: (mass[p], -len(p), p)))


def layout(html: str | None) -> str:
    """The containers of a page near its root that are article or may hold one, as a hash; empty for an empty page."""
    return layout_of(events(html)) if html else ""


def layout_of(found: Iterable[tuple[str, Element | None, str]]) -> str:
    paths = {e.path for kind, e, _ in found if kind == "start" and e.tag in CONTAINERS and not e.aside and e.path.count(">") < DEPTH}
    return blake2b("\n".join(sorted(paths)).encode(), digest_size=12).hexdigest()


def _inside(found: list[tuple], path: str) -> list[tuple[str, str]]:
    """Path and text of the blocks in the elements at ``path``."""
    out: list[tuple[str, str]] = []
    inside: list[int] = []
    for kind, element, text in found:
        if kind == "start" and element.path == path and not element.aside:
            inside.append(element.uid)
        elif kind == "end" and inside and element.uid == inside[-1]:
            inside.pop()
        elif kind == "text" and inside and not element.aside:
            out.append((element.path, text))
    return out


def main_text(html: str | None, path: str | None, same: Collection[int] = ()) -> str:
    """The text of a page's region ``path``, or of its own region if it hasn't that, without the texts ``same`` of the
    template; without any region (None), all that isn't named as something else."""
    if not html:
        return ""
    found = list(events(html))
    blocks = _inside(found, path) if path else []
    if not blocks and path is not None:
        own = region(stream(found), 1)
        if own and own == path:
            return ""
        blocks = _inside(found, own) if own else []
        if own and not blocks:
            return ""
    if not blocks:
        blocks = [(e.path, t) for kind, e, t in found if kind == "text" and not e.aside]
    if same:
        kept = [b for b in blocks if block_id(*b) not in same]
        if 2 * sum(len(t) for _, t in kept) > sum(len(t) for _, t in blocks):
            blocks = kept
    return "\n".join(t for _, t in blocks)


def host(url):
    """The host of a column of urls in small letters; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def with_host(pages: DataFrame) -> DataFrame:
    """page_id, url, html and host of each row of ``pages``."""
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host(F.col("url")).alias("host"))


def with_layout(rows: DataFrame) -> DataFrame:
    """The rows of ``with_host`` and their layouts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([layout(h.as_py()) for h in batch.column("html")], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "layout"])

    return rows.mapInArrow(run, T.StructType([*rows.schema, T.StructField("layout", T.StringType())]))


#: An expression of some pages: those of a layout whose content falls into ``part``, in order of ``rank``, which equal pages
#: share; ``blocks`` holds the different blocks of ``pages`` pages, ``on`` on how many each is.
STATE = pa.schema([
    ("host", pa.string()), ("layout", pa.string()), ("part", pa.int64()), ("rank", pa.string()), ("pages", pa.int64()),
    ("nodes", pa.binary()), ("blocks", pa.list_(pa.int64())), ("on", pa.list_(pa.int64()))])
STATE_TYPE = "host string, layout string, part long, rank string, pages long, nodes binary, blocks array<long>, on array<long>"
#: Rows to a batch of expressions.
BATCH = 256


def _states(rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), STATE)], schema=STATE)

    for row in rows:
        held.append(row)
        if len(held) == BATCH:
            yield batch()
            held.clear()
    if held:
        yield batch()


def _pack(nodes: list[tuple]) -> bytes:
    return zlib.compress(pickle.dumps(nodes, pickle.HIGHEST_PROTOCOL), 1)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for values in zip(*batch.columns):
            yield tuple(v.as_py() for v in values)


def parse_pages(rows: DataFrame, parts: int) -> DataFrame:
    """``STATE`` of each page of ``rows`` that isn't empty; of equal ones a task passes on one."""
    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        seen: set[tuple[str, str]] = set()
        for at, html in _rows(batches):
            rank = blake2b(html.encode(), digest_size=16).hexdigest()
            if (at, rank) in seen:
                continue
            seen.add((at, rank))
            found = list(events(html))
            blocks = sorted(blocks_of(found))
            yield at, layout_of(found), int(rank[:15], 16) % parts, rank, 1, _pack(fold(stream(found))), blocks, [1] * len(blocks)

    return rows.where("length(html) > 0").select("host", "html").mapInArrow(lambda batches: _states(states(batches)), STATE_TYPE)


def align_parts(states: DataFrame, tasks: int) -> DataFrame:
    """One ``STATE`` for each part of a layout; what has one rank counts once."""
    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (at, part, like), group in groupby(_rows(batches), lambda r: (r[0], r[2], r[1])):
            nodes, total, last = [], 0, None
            on: Counter = Counter()
            for *_, rank, pages, packed, blocks, times in group:
                if rank != last:
                    own = pickle.loads(zlib.decompress(packed))
                    nodes, last, total = align(nodes, own) if total else own, rank, total + pages
                    for block, n in zip(blocks, times):
                        on[block] += n
            yield at, like, part, str(part), total, _pack(nodes), list(on), list(on.values())

    sorted_rows = states.repartition(tasks, "host", "part", "layout").sortWithinPartitions("host", "part", "layout", "rank")
    return sorted_rows.mapInArrow(lambda batches: _states(aligned(batches)), STATE_TYPE)


def align_rounds(states: DataFrame, parts: int, tasks: int) -> DataFrame:
    """One ``STATE`` for each layout from those of its ``parts``, ``FAN`` at a time; without blocks."""
    none = F.array().cast("array<bigint>")
    states = states.withColumns({"blocks": none, "on": none})
    while parts > 1:
        parts = -(-parts // FAN)
        states = align_parts(states.withColumn("part", F.pmod("part", F.lit(parts))), tasks)
    return states


def infer_wrappers(rows: DataFrame, store: Store) -> DataFrame:
    """A wrapper for each layout of a host of ``rows`` (see ``with_host``) that several different pages have, and one
    for each host under the layout ``""``."""
    count, most = rows.groupBy("host").count().agg(F.sum("count"), F.max("count")).first()
    parts, tasks = -(-(most or 1) // FAN), max(rows.sparkSession.sparkContext.defaultParallelism, -(-(count or 0) // TASK))
    first = store.put(align_parts(parse_pages(rows, parts), tasks), "parts")
    layouts = store.put(align_rounds(first, parts, tasks), "layouts")
    most = layouts.groupBy("host").count().agg(F.max("count")).first()[0] or 1
    parts = -(-most // FAN)
    of_host = layouts.withColumns({"part": F.pmod(F.xxhash64("layout"), F.lit(parts)), "rank": F.col("layout"), "layout": F.lit("")})
    whole = store.put(align_rounds(align_parts(of_host, tasks), parts, tasks), "hosts")
    both = layouts.where("pages > 1").unionByName(whole).select("host", "layout", "pages", "nodes")
    blocks = first.select("host", "layout", F.explode(F.arrays_zip("blocks", "on")).alias("b")).select("host", "layout", "b.blocks", "b.on")
    times = blocks.unionByName(blocks.withColumn("layout", F.lit(""))).groupBy("host", "layout", "blocks").agg(F.sum("on").alias("on")).where("on >= 3")
    often = times.join(both.select("host", "layout", "pages"), ["host", "layout"]).where(F.col("on") >= F.ceil(F.lit(TEMPLATE) * F.col("pages")))
    template = often.groupBy("host", "layout").agg(F.sort_array(F.collect_list("blocks")).alias("template"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for pages, packed in zip(batch.column("pages").to_pylist(), batch.column("nodes").to_pylist()):
                nodes = pickle.loads(zlib.decompress(packed))
                found.append((region(nodes, pages), expression(nodes)))
            paths, texts = (pa.array([x[i] for x in found], pa.string()) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("layout"), batch.column("pages"), paths, texts], ["host", "layout", "pages", "region", "wrapper"])

    found = both.mapInArrow(run, "host string, layout string, pages long, region string, wrapper string")
    return found.join(template, ["host", "layout"], "left").withColumn("template", F.coalesce("template", F.array().cast("array<bigint>")))


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for html, path, same in zip(*(batch.column(c) for c in ("html", "region", "template"))):
                texts.append(main_text(html.as_py(), path.as_py(), frozenset(same.as_py() or ())))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    rows, store = with_host(pages), Store(pages.sparkSession, "html")
    wrappers = store.put(infer_wrappers(rows, store).select("host", "layout", "region", "template"), "wrappers")
    store.drop("parts", "layouts", "hosts")
    rows = with_layout(rows)
    own = wrappers.where("layout <> ''").select(F.col("host").alias("of"), F.col("layout").alias("like"), F.struct("region", "template").alias("own"))
    whole = wrappers.where("layout = ''").select(F.col("host").alias("at"), F.struct("region", "template").alias("whole"))
    joined = rows.join(own, (F.col("host") == F.col("of")) & (F.col("layout") == F.col("like")), "left").join(whole, F.col("host") == F.col("at"), "left")
    chosen = F.coalesce("own", "whole")
    joined = joined.select("page_id", "url", "html", F.coalesce(chosen["region"], F.lit("")).alias("region"), chosen["template"].alias("template"))
    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
