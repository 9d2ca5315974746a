"""Main text of web pages, by wrappers inferred from the pages of the same host.

A page is read into a stream of its containers: tags of elements that hold blocks, and between them text
slots, each with a checksum of its text and its number of characters out of links. A wrapper is a
union-free regular expression over such streams: tags, slots, and groups that may be absent or repeated.
A page's stream is folded first, so that tandem repeats are repeated groups; then streams are aligned one
after another with the host's wrapper so far: different texts at one place leave a slot without text,
tokens that only one side has become an optional group, and a group meets its repeated self. A slot counts
the pages that agree on its text, and adds up the characters of all. Tasks infer wrappers of their own
pages, whose number per host is that of the tasks at most; equal ones fall together and the rest are
aligned in two rounds, so that a host with a third of all pages is no single task.

The wrapper decides what the article is: the element around most of the text that differs from page to
page. A page is aligned with its host's wrapper, and the blocks between the places where that element
begins and ends are its text, but for menus, forms, notices and the like inside. Hosts with too few
different pages, and pages that don't match, go by their own elements and names instead. Pages are never
cut. Null and empty pages have no text; a null url is host ''.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..session import Workspace
from .common import strings

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""([^\s=/"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"']+))?""")

# Kinds of elements of HTML, and names by which pages call what is no article.
RAW = frozenset("script style noscript textarea title iframe".split())
MARKUP = frozenset("template object svg math canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr img picture".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
NO_TEXT = frozenset("head nav footer aside form button select dialog menu".split())
NO_TEXT_NAMES = frozenset(
    "ad ads adbox advert adverts advertisement advertising banner promo promotion sponsor sponsored sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
    "subscribe subscription share sharing social related recommended recommendations comment comments disqus respond replies "
    "footer masthead widget widgets toolbar pagination pager login signup search copyright hidden".split()
)
NEUTRAL_NAMES = frozenset(
    "site page box bar block list wrap wrapper container area section top bottom left right item items link links inner "
    "outer global main".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
PARAGRAPHS = frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre".split())
TEXT_BLOCKS = PARAGRAPHS | frozenset("li td th dd dt figcaption".split())

#: Most tokens in a repeated group that folding looks for, and items of two wrappers that are compared all
#: with all; longer ones are cut at tokens that both have once.
GROUP, LONGEST = 12, 400
#: Different pages that must agree for a text to be the template's, or that a wrapper needs to decide.
AGREE = 3
#: Shares, in per cent: of an element's varying text that an inner one must hold to be the article in its
#: place, and that the rest may hold at most.
INNER, OUTER = 60, 15
#: Page shapes whose place in a wrapper a task remembers.
SHAPES = 10_000
#: Wrappers of a host are aligned in this many shares first.
SHARES = 32


def attributes(text: str) -> dict[str, str]:
    return {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(text)} if text.strip("/ \n\t") else {}


def label_of(tag: str, own: dict[str, str]) -> str:
    """Tag with what names it: roles, ids and classes without their digits."""
    names = re.sub(r"\d+", "0", " ".join((own.get("id", ""), own.get("class", ""))).lower()).split()
    return ".".join([tag, *(f"role={own['role']}" for _ in [0] if "role" in own), *names])


def names_other(name: str) -> bool:
    """Whether a whole class or id means no article text: all of its parts must, or be neutral."""
    parts = set(re.split("[-_]+", name)) - {""}
    return not NO_TEXT_NAMES.isdisjoint(parts) and parts <= NO_TEXT_NAMES | NEUTRAL_NAMES


def is_other(tag: str, own: dict[str, str], in_article: bool) -> bool:
    """Whether an element holds no article text: by its tag, its role, or a whole name that it has."""
    if tag in NO_TEXT or tag == "header" and not in_article:
        return True
    if not own:
        return False
    names = f"{own.get('id', '')} {own.get('class', '')}".lower().split()
    hidden = "hidden" in own or own.get("aria-hidden") == "true" or "display:none" in own.get("style", "").replace(" ", "")
    other = tag not in ("html", "body", "article", "main") and any(map(names_other, names))
    return other or own.get("role") in ROLES or hidden


class Page:
    """A page's blocks and its stream of tokens.

    ``blocks``: (text, path, innermost block, where the innermost element around it that holds no article
    text begins, or -1, characters in links, token).
    ``stream``: '<label' and '>label' of containers, and text slots.
    """

    def __init__(self, source: str):
        self.blocks: list[tuple[str, str, str, int, int, int]] = []
        self.stream: list[str] = []
        self.slot: list[int] | None = None  # checksum and characters of the slot at the stream's end
        self.open: list[tuple[str, str, int]] = []  # tag, label, its place if it holds no article text
        self.kind = "t"
        self.text: list[str] = []
        self.linked = self.links = 0
        at, size = 0, len(source)
        while at < size:
            found = TOKEN.search(source, at)
            self.add(source[at : found.start() if found else size])
            if not found:
                break
            at = found.end()
            tag = (found[2] or "").lower()
            if not tag:
                continue
            closed = found[3].rstrip().endswith("/")
            if tag in RAW and not found[1]:
                # without an end tag the rest is the element's, as in HTML
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.IGNORECASE).search(source, at)
                at = end.end() if end else size
            elif tag in MARKUP:
                # markup of another kind is left out up to its own end; one that is never closed is passed over
                if not found[1] and not closed and (end := skipped(source, at, tag)):
                    at = end
            elif found[1]:
                self.close(tag)
            else:
                self.start(tag, attributes(found[3]))
        self.flush()
        while self.open:
            self.pop()

    def add(self, text: str) -> None:
        if text:
            self.text.append(text)
            self.linked += len(text.strip()) if self.links else 0

    def flush(self) -> None:
        text = " ".join(html.unescape("".join(self.text)).split())
        if text:
            if self.slot is None:
                self.slot = [0, 0]
                self.kind = "t"
                self.stream.append("")
            path = "/".join(label for _, label, _ in self.open)
            tag = self.open[-1][0] if self.open else ""
            self.slot[0] = zlib.crc32(text.encode("utf-8", "replace"), self.slot[0])
            self.slot[1] += max(0, len(text) - 2 * self.linked)
            if tag in PARAGRAPHS:
                self.kind = "p"
            elif tag in TEXT_BLOCKS and self.kind == "t":
                self.kind = "l"
            self.stream[-1] = slot_of(self.kind, f"{self.slot[0]:08x}", 1, self.slot[1])
            other = max((x[2] for x in self.open), default=-1)
            self.blocks.append((text, path, tag, other, self.linked, len(self.stream) - 1))
        self.text, self.linked = [], 0

    def start(self, tag: str, own: dict[str, str]) -> None:
        if tag == "br":
            self.text.append(" ")
            return
        if tag in INLINE:
            self.links += tag == "a"
            return
        self.flush()
        if tag in VOID:
            return
        if tag in CLOSES_P and self.open and self.open[-1][0] == "p":
            self.pop()
        if tag in SELF_CLOSING and self.open and self.open[-1][0] in SELF_CLOSING[tag]:
            self.pop()
        label = label_of(tag, own)
        article = any(x[0] in ("article", "main") for x in self.open)
        self.open.append((tag, label, len(self.stream) if is_other(tag, own, article) else -1))
        if tag not in TEXT_BLOCKS:
            self.stream.append(f"<{label}")
            self.slot = None

    def pop(self) -> None:
        tag, label, _ = self.open.pop()
        if tag not in TEXT_BLOCKS:
            self.stream.append(f">{label}")
            self.slot = None

    def close(self, tag: str) -> None:
        if tag in INLINE:
            self.links = max(0, self.links - (tag == "a"))
            return
        self.flush()
        if tag not in VOID and any(x[0] == tag for x in self.open):
            while self.open[-1][0] != tag:
                self.pop()
            self.pop()


def skipped(source: str, at: int, tag: str) -> int:
    """Where an element that began before ``at`` ends, inner ones of its kind counted; 0 if nowhere."""
    depth = 1
    for found in re.compile(rf"<(/?){re.escape(tag)}\b((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>", re.IGNORECASE).finditer(source, at):
        if found[1]:
            depth -= 1
        elif not found[2].rstrip().endswith("/"):
            depth += 1
        if not depth:
            return found.end()
    return 0


# A wrapper is a list of tokens and of groups (least, most, items): least 0 if it may be absent, most 2
# if it may be repeated. A text slot is '#kind checksum*pages~characters', without a checksum if texts differ;
# pages are those that agree on the text. Kinds: p for paragraphs and headings, l for items and cells alone, t for
# text right in the container.


def slot_of(kind: str, checksum: str, pages: int, size: int) -> str:
    return f"#{kind}{checksum}*{pages}~{size}"


def slot_parts(slot: str) -> tuple[str, int, int]:
    checksum, _, rest = slot[2:].partition("*")
    pages, _, size = rest.partition("~")
    return checksum, int(pages), int(size)


def scaled(items, times: int) -> list:
    """A wrapper that stands for ``times`` equal ones."""
    if times == 1:
        return list(items)

    def one(x):
        if not isinstance(x, str):
            return x[0], x[1], tuple(scaled(x[2], times))
        if x[0] != "#":
            return x
        checksum, pages, size = slot_parts(x)
        return slot_of(x[1], checksum, pages * times, size * times)

    return list(map(one, items))


def same(a, b) -> bool:
    """Equal but for the texts of slots."""
    if isinstance(a, str) or isinstance(b, str):
        return a == b or isinstance(a, str) and isinstance(b, str) and a[0] == "#" and a[:2] == b[:2]
    return len(a[2]) == len(b[2]) and all(map(same, a[2], b[2]))


def joined(a, b):
    """One item for two that are the same."""
    if isinstance(a, str):
        if a[0] != "#":
            return a
        (one, own, size), (other, more, added) = slot_parts(a), slot_parts(b)
        agree = one and one == other
        return slot_of(a[1], one if agree else "", own + more if agree else 0, size + added)
    return min(a[0], b[0]), max(a[1], b[1]), tuple(map(joined, a[2], b[2]))


def balanced(items) -> bool:
    """Whether all elements that begin among the items end there, and no others do."""
    depth = 0
    for x in items:
        if isinstance(x, str) and x[0] in "<>":
            depth += 1 if x[0] == "<" else -1
            if depth < 0:
                return False
    return depth == 0


def fold(items: list, spans: list[tuple[int, int]] | None = None) -> list:
    """Tandem repeats as repeated groups, the shortest first. ``spans`` of the items, if given, are joined
    as they are."""
    items = list(items)
    for size in range(1, GROUP + 1):
        at = 0
        while at + size < len(items):
            group = items[at]
            if not isinstance(group, str) and group[1] == 2 and len(group[2]) == size:
                unit, after = group[2], at + 1  # a group and one more of its kind
            else:
                unit, after = tuple(items[at : at + size]), at + size
            more = items[after : after + size]
            if len(more) == size and all(map(same, unit, more)) and balanced(unit) and not (size == 1 and unit[0][0] == "#"):
                least = group[0] if after == at + 1 and not isinstance(group, str) else 1
                items[at : after + size] = [(least, 2, tuple(map(joined, unit, more)))]
                if spans is not None:
                    spans[at : after + size] = [(spans[at][0], spans[after + size - 1][1])]
            else:
                at += 1
    return items


#: What it costs to leave a slot unmatched; a tag costs 1. Paragraphs are what pages of a host share most surely.
SLOT_WEIGHTS = {"p": 6, "l": 2, "t": 2}


def weight(item) -> int:
    if not isinstance(item, str):
        return sum(map(weight, item[2]))
    return SLOT_WEIGHTS[item[1]] if item[0] == "#" else 1


def anchors(a: list, b: list) -> list[tuple[int, int]]:
    """Places of tokens that both sides have once, as many as stand in the same order."""

    def once(items: list) -> dict[str, int]:
        places = {x.partition("*")[0]: i for i, x in enumerate(items) if isinstance(x, str)}
        counts = Counter(x.partition("*")[0] for x in items if isinstance(x, str))
        return {k: places[k] for k, n in counts.items() if n == 1 and (k[0] != "#" or len(k) > 2)}

    left, right = once(a), once(b)
    pairs = sorted((i, right[k]) for k, i in left.items() if k in right)
    ends: list[int] = []  # least last place of a chain of each length
    last: list[int] = []
    before = []
    for at, (_, j) in enumerate(pairs):
        size = bisect_left(ends, j)
        ends[size : size + 1], last[size : size + 1] = [j], [at]
        before.append(last[size - 1] if size else -1)
    chain, at = [], last[-1] if last else -1
    while at >= 0:
        chain.append(pairs[at])
        at = before[at]
    return chain[::-1]


def path_of(a: list, b: list) -> list[tuple[int, int]]:
    """Steps (items of a, items of b) that match two wrappers; (1, 0) and (0, 1) match nothing."""
    if not a or not b:
        return [(1, 0)] * len(a) + [(0, 1)] * len(b)
    if max(len(a), len(b)) <= LONGEST:
        return shortest(a, b)
    out: list[tuple[int, int]] = []
    i = j = 0
    if found := anchors(a, b):
        for x, y in found:
            out += [*path_of(a[i:x], b[j:y]), (1, 1)]
            i, j = x + 1, y + 1
        return out + path_of(a[i:], b[j:])
    parts = -(-max(len(a), len(b)) // LONGEST)  # nothing to cut at: equal shares of both
    for k in range(1, parts + 1):
        x, y = len(a) * k // parts, len(b) * k // parts
        out += path_of(a[i:x], b[j:y])
        i, j = x, y
    return out


def shortest(a: list, b: list) -> list[tuple[int, int]]:
    """Steps that leave the least weight unmatched."""
    n, m = len(a), len(b)
    cost = [[0] * (m + 1) for _ in range(n + 1)]
    step = [[(0, 0)] * (m + 1) for _ in range(n + 1)]
    for i in range(n, -1, -1):
        for j in range(m, -1, -1):
            if i == n and j == m:
                continue
            options = []
            if i < n and j < m and same(a[i], b[j]):
                options.append((cost[i + 1][j + 1], (1, 1)))
            if i < n and not isinstance(a[i], str) and j + (k := len(a[i][2])) <= m and all(map(same, a[i][2], b[j : j + k])):
                options.append((cost[i + 1][j + k], (1, k)))
            if j < m and not isinstance(b[j], str) and i + (k := len(b[j][2])) <= n and all(map(same, b[j][2], a[i : i + k])):
                options.append((cost[i + k][j + 1], (k, 1)))
            if i < n:
                options.append((cost[i + 1][j] + weight(a[i]), (1, 0)))
            if j < m:
                options.append((cost[i][j + 1] + weight(b[j]), (0, 1)))
            cost[i][j], step[i][j] = min(options)
    out = []
    i = j = 0
    while i < n or j < m:
        out.append(step[i][j])
        i, j = i + out[-1][0], j + out[-1][1]
    return out


def align(a: list, b: list) -> list:
    """A wrapper for all that two wrappers match."""
    if len(a) == len(b) and all(map(same, a, b)):
        return list(map(joined, a, b))
    out: list = []
    i = j = at = 0
    path = path_of(a, b)
    while at < len(path):
        x, y = d = path[at]
        if x and y:
            if x == y == 1 and same(a[i], b[j]):
                out.append(joined(a[i], b[j]))
            elif x == 1 and not isinstance(a[i], str):
                out.append((a[i][0], a[i][1], tuple(map(joined, a[i][2], b[j : j + y]))))
            else:
                out.append((b[j][0], b[j][1], tuple(map(joined, b[j][2], a[i : i + x]))))
            i, j, at = i + x, j + y, at + 1
            continue
        run = []
        while at < len(path) and path[at] == d:
            run.append(a[i] if x else b[j])
            at, i, j = at + 1, i + x, j + y
        single = len(run) == 1 and not isinstance(run[0], str)
        out.append((0, run[0][1], run[0][2]) if single else (0, 1, tuple(run)))
    return fold(out)


def frozen(items) -> list:
    """Wrapper items read from JSON."""
    return [x if isinstance(x, str) else (x[0], x[1], tuple(frozen(x[2]))) for x in items]


def flat(items) -> list:
    """A wrapper's items with groups that are not repeated opened: each of their tokens may be absent."""
    out = []
    for x in items:
        out += [x] if isinstance(x, str) or x[1] == 2 else flat(x[2])
    return out


def varying(item, pages: int) -> int:
    """Characters of an item's slots that differ between pages."""
    if not isinstance(item, str):
        return sum(varying(x, pages) for x in item[2])
    if item[0] != "#":
        return 0
    checksum, agreed, size = slot_parts(item)
    return 0 if checksum and agreed >= min(AGREE, pages) else size


def elements(items: list) -> dict[int, int]:
    """Where the elements that begin among a flat wrapper's items end."""
    ends, begun = {}, []
    for i, x in enumerate(items):
        if isinstance(x, str) and x[0] == "<":
            begun.append(i)
        elif isinstance(x, str) and x[0] == ">":
            at = next((k for k in reversed(begun) if items[k][1:] == x[1:]), None)
            if at is not None:
                while begun.pop() != at:
                    pass
                ends[at] = i
    return ends


class Wrapper:
    """A host's wrapper with the place of its article, and the template's texts."""

    def __init__(self, pages: int, items: list):
        self.items, self.shapes = flat(items), {}
        self.fixed = {
            slot_parts(x)[0] for x in self.items if isinstance(x, str) and x[0] == "#" and slot_parts(x)[0] and not varying(x, pages)
        } if pages >= AGREE else set()
        self.article = self.find(pages) if pages >= AGREE else None

    def find(self, pages: int) -> tuple[int, int] | None:
        """The items between which the article is: from the outermost element inwards, as long as an inner
        one holds most of the varying text and the rest is little."""
        sizes = [varying(x, pages) for x in self.items]
        ends = elements(self.items)
        other = [i for i in ends if self.items[i][1:].split(".")[0] in NO_TEXT]
        for i in other:
            sizes[i : ends[i]] = [0] * (ends[i] - i)
        if not sum(sizes):
            return None
        start, end = -1, len(self.items)
        while True:
            inside = sum(sizes[start + 1 : end])
            inner = [i for i in ends if start < i and ends[i] < end]
            outer = [i for i in inner if not any(k < i and ends[i] < ends[k] for k in inner)]
            best = max(outer, key=lambda i: sum(sizes[i : ends[i]]), default=None)
            if best is None:
                break
            own = sum(sizes[best : ends[best]])
            rest = max([0, *(sum(sizes[i : ends[i]]) for i in outer if i != best)])
            direct = inside - sum(sum(sizes[i : ends[i]]) for i in outer)
            tag = self.items[start][1:].split(".")[0] if start >= 0 else ""
            if tag in ("article", "main") or 100 * own < INNER * inside or 100 * max(rest, direct) > OUTER * inside and tag not in ("", "html", "body"):
                break
            start, end = best, ends[best]
        return (start, end) if start >= 0 else None

    def place(self, stream: list[str]) -> tuple[int, int] | None:
        """The tokens of a page's stream between which its article is."""
        if self.article is None:
            return None
        shape = tuple(x if x[0] != "#" else x[:2] for x in stream)
        if shape not in self.shapes:
            if len(self.shapes) >= SHAPES:
                self.shapes.clear()
            self.shapes[shape] = self.aligned(stream)
        return self.shapes[shape]

    def aligned(self, stream: list[str]) -> tuple[int, int] | None:
        """The page's innermost element of the article's label around all slots that the alignment puts into
        the article: which of several equal tags begins it, the alignment alone leaves open."""
        spans = [(i, i + 1) for i in range(len(stream))]
        items = fold(stream, spans)
        start, end = self.article
        i = j = 0
        found = []
        for x, y in path_of(self.items, items):
            if x and y and start < i and i + x <= end:
                found += [k for k in range(spans[j][0], spans[j + y - 1][1]) if stream[k][0] == "#"]
            i, j = i + x, j + y
        if not found:
            return None
        ends = elements(stream)
        around = [k for k in ends if stream[k] == self.items[start] and k < found[0] and ends[k] > found[-1]]
        return (max(around), ends[max(around)]) if around else None


def main_text(source: str, wrapper: Wrapper | None) -> str:
    """The article's blocks, one to a line."""
    page = Page(source)
    place = wrapper.place(page.stream) if wrapper else None
    if place:  # what is around the article says nothing about it
        inside = [x for x in page.blocks if place[0] <= x[5] < place[1] and x[3] <= place[0]]
    else:
        inside = by_names([x for x in page.blocks if x[3] < 0])
    fixed = wrapper.fixed if wrapper else set()
    return "\n".join(x[0] for x in inside if x[2] in TEXT_BLOCKS or slot_parts(page.stream[x[5]])[0] not in fixed)


def by_names(blocks: list[tuple]) -> list[tuple]:
    """Blocks of the page's own article or main element, else of the container that holds most text."""
    tags = {part.split(".")[0] for x in blocks for part in x[1].split("/")}
    main = next((t for t in ("article", "main") if t in tags), "")
    if main:
        return [x for x in blocks if any(p.split(".")[0] == main for p in x[1].split("/"))]
    mass: dict[str, int] = {}
    for text, path, tag, _, linked, _ in blocks:
        parts = path.split("/")
        top = "/".join(parts[:-1] if tag in TEXT_BLOCKS else parts)
        mass[top] = mass.get(top, 0) + max(0, len(text) - 2 * linked)
    top = max(mass, key=lambda p: mass[p], default="")
    return [x for x in blocks if x[1] == top or x[1].startswith(f"{top}/") or not top]


def streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, hash of the stream, folded stream) of pages; copies within a batch once."""
    for batch in batches:
        found: dict[tuple[str, bytes], str] = {}
        for host, source in zip(strings(batch.column(0)), strings(batch.column(1)), strict=True):
            stream = Page(source).stream
            key = host, hashlib.blake2b(json.dumps(stream).encode(), digest_size=16).digest()
            if key not in found:
                found[key] = json.dumps(fold(stream))
        columns = [pa.array([h for h, _ in found], pa.string()), pa.array([k for _, k in found], pa.binary()), pa.array(found.values(), pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["host", "key", "stream"])


def infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A wrapper (host, pages, wrapper) of each host's different streams in a task."""
    found: dict[str, tuple[int, list]] = {}
    for batch in batches:
        for host, stream in zip(strings(batch.column(0)), strings(batch.column(1)), strict=True):
            folded = frozen(json.loads(stream))
            pages, wrapper = found.get(host, (0, folded))
            found[host] = pages + 1, align(wrapper, folded) if pages else folded
    rows = [(host, pages, json.dumps(wrapper)) for host, (pages, wrapper) in found.items()]
    yield pa.RecordBatch.from_pylist(
        [{"host": h, "pages": n, "wrapper": w} for h, n, w in rows],
        pa.schema([("host", pa.string()), ("pages", pa.int64()), ("wrapper", pa.string())]),
    )


@F.arrow_udf(StructType([StructField("pages", LongType()), StructField("wrapper", StringType())]))
def together(groups: pa.Array) -> pa.Array:
    """Wrappers of a host aligned one after another."""
    rows = []
    for group in groups.to_pylist():
        pages, wrapper = 0, None
        for part in sorted(group, key=lambda x: x["wrapper"]):
            items = scaled(frozen(json.loads(part["wrapper"])), part["times"])
            wrapper = items if wrapper is None else align(wrapper, items)
            pages += part["pages"]
        rows.append({"pages": pages, "wrapper": json.dumps(wrapper)})
    return pa.array(rows, pa.struct([("pages", pa.int64()), ("wrapper", pa.string())]))


def wrappers(pages: DataFrame, workspace: Workspace) -> DataFrame:
    """(host, pages, wrapper): the wrapper of each host; ``pages`` has columns host and html."""
    each = pages.select("host", "html").mapInArrow(streams, "host string, key binary, stream string")
    # copies of a page count once, wherever they lie
    each = each.groupBy("host", "key").agg(F.first("stream").alias("stream"))
    # in one order, so that a task's wrapper depends on its pages alone
    each = each.sortWithinPartitions("host", "key")
    own = each.select("host", "stream").mapInArrow(infer, "host string, pages long, wrapper string")
    own = own.groupBy("host", "wrapper").agg(F.sum("pages").alias("pages"), F.count("*").alias("times"))
    share = F.pmod(F.xxhash64("wrapper"), F.lit(SHARES))
    for keys in (["host", share.alias("share")], ["host"]):
        grouped = own.groupBy(*keys).agg(F.collect_list(F.struct("pages", "wrapper", "times")).alias("parts"))
        own = grouped.select("host", together("parts").alias("one"))
        own = own.select("host", "one.pages", "one.wrapper", F.lit(1).alias("times"))
        own = workspace.keep(own, "wrappers")
    return own.drop("times")


@F.arrow_udf(StringType())
def extracted(sources: pa.Array, pages: pa.Array, found: pa.Array) -> pa.Array:
    out = [main_text(*x) for x in zip(strings(sources), map(wrapper_of, pages.to_pylist(), found.to_pylist()), strict=True)]
    return pa.array(out, pa.string())


@lru_cache(256)
def wrapper_of(pages: int | None, wrapper: str | None) -> Wrapper | None:
    return Wrapper(pages or 0, frozen(json.loads(wrapper))) if wrapper else None


def host_of(url: str) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]*)", 1))


def extract(pages: DataFrame, workspace: Workspace, url: str = "url", source: str = "html", out: str = "text") -> DataFrame:
    """All rows and columns, and the main text of each page in a column ``out``."""
    row = F.struct(*(F.col(f"`{c}`") for c in pages.columns if c != out)).alias("row")
    keyed = pages.select(row, host_of(url).alias("host"), F.col(source).alias("html"))
    known = wrappers(keyed, workspace)
    joined_ = keyed.join(known, "host", "left")
    return joined_.select("row", extracted.asNondeterministic()("html", "pages", "wrapper").alias("text_")).select(
        "row.*", F.col("text_").alias(out)
    )
