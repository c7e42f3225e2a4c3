"""Main text of web pages by wrappers: union-free regular expressions over token streams, inferred for each host.

A page is a stream of tags, template texts and text slots. The pages of a host are aligned one after another. Within
a page, adjacent equal groups of tokens fold into a repeated group. Between the wrapper so far and the next page, what only
one of them has becomes optional; optional nodes that repeat a node more than ``REPEATS`` times become a loop over these nodes, so that
a wrapper doesn't grow with the number of pages. Each node of the wrapper says of its texts whether they belong to the article.
Every page is matched against its host's wrapper, and its texts take the verdict of the node that they fall to; texts that
the wrapper has no node for are judged by what encloses them.

A wrapper is fitted on all pages of a host. Folded streams with their texts' marks are its shapes; equal ones are aligned once, and the number of
distinct pages of each is counted. Shapes are merged into partial wrappers, ``FAN`` or so in a task, and these likewise until each host has one, so
that no task holds a host's pages. Tokens that a single page of the host has are left out: no other page can meet them. A page
counts for the nodes that its shape falls to in the finished wrapper. Whether a text is template is
counted over all contents of the host, pages with the same texts being one: the whole text of a block is, where more than
``TEMPLATE_SHARE`` of the contents with its path have it, and ``LEAST`` at least; within an article ``LEAST_INSIDE``, so that
an advert or a sign-up box that stands on every page of a host goes whatever its element is called. Headings and cells of
tables are no template there; and a page whose article would lose more than half of its blocks is a near copy of others,
and loses none. Every page is extracted whole. Null or empty html: empty text. Rows that repeat are extracted one by one. A null URL has the empty
host, whose pages share a wrapper.

The article is what ``article``, else ``main``, encloses without navigation, page headers, footers, asides, forms,
scripts, adverts, notices, comments and template texts. Where a page has neither, it is the body without those.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterable
from functools import lru_cache
from itertools import groupby

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import documents, dropped, per_slice, written

PERIOD = 8
#: Times that a node may recur among optional ones that follow each other, and wrappers (or shapes of pages) that a task merges.
REPEATS, FAN = 4, 32
#: A text is template on more than this share of those contents of a host that have its path, and on so many contents.
TEMPLATE_SHARE, LEAST, LEAST_INSIDE = 0.5, 2, 4
#: Bytes of wrappers, and of what is known of hosts before, that are sent to every executor, once; more of them are joined by a shuffle.
MOST_BYTES = 16_000_000

#: Each form ends at the end of the page at the latest and never gives back what it took, so a page is read in linear time.
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z))?+)*+)(?:>|\Z)""", re.DOTALL)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*+=\s*+(?:"([^"]*+)(?:"|\Z)|'([^']*+)(?:'|\Z)|([^\s>"']++))""", re.IGNORECASE)
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "object", "xmp"}
RAW_END = {x: re.compile(rf"</{x}\s*>", re.IGNORECASE) for x in RAW}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
DROPPED = {"head", "nav", "footer", "aside", "form", "button", "select", "dialog", "menu"}
BLOCK = {
    "address", "article", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption", "figure", "h1", "h2", "h3", "h4", "h5",
    "h6", "header", "hgroup", "hr", "html", "li", "main", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
#: Words that mark what isn't the article, as the name of a class, an id or a role.
MARK = re.compile(r"ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notices?|popup|modal|comments?|respond|replies|disqus|sidebar|nav\w*|menu|breadcrumbs?|footer|related|share|sharing|social|newsletter|subscribe|pagination|pager|widget|toolbar|search|login|signup|complementary|contentinfo|alertdialog|masthead", re.IGNORECASE)
#: What may stand behind such a word in a name, and what may not stand before it.
PLAIN = {"area", "bar", "block", "bottom", "box", "buttons", "container", "form", "header", "icons", "inner", "items", "left", "links", "list", "main", "outer", "panel", "posts", "primary", "right", "section", "slot", "text", "top", "unit", "wrap", "wrapper"}
ABOUT = {"has", "hide", "is", "no", "show", "with", "without"}
#: An open element of the first kind ends where one of the second begins.
CLOSES = {"p": BLOCK, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
CLOSERS = set().union(*CLOSES.values())
#: Elements whose texts recur within articles without being template.
SOLID = {"h1", "h2", "h3", "h4", "h5", "h6", "table", "dt"}


@lru_cache(10_000)
def is_mark(said: str) -> bool:
    """Whether a value of class, id or role has a name whose last word that says anything marks what isn't the article."""
    for name in said.lower().split():
        words = [x for x in re.split(r"[_-]+|(?<=[a-z])(?=[0-9])", name) if x]
        while len(words) > 1 and (words[-1] in PLAIN or words[-1].isdigit()):
            words.pop()
        if words and words[0] not in ABOUT and MARK.fullmatch(words[-1]):
            return True
    return False


def step_of(above: int, step: str) -> int:
    """64 bits that stand for the path to an element, from those of the path above it; 0 is the path of the page."""
    return xxhash.xxh3_64_intdigest(step.encode("utf-8", "replace"), seed=above)


def parse(page: str) -> tuple[list[str], list[tuple[int, int, str, bool, int, str]], set[int]]:
    """Keys of the token stream, its texts as (place in the stream, path, region, dropped, block, text), and the blocks that
    are in headings or tables.

    The region is ``article``, ``main`` or empty.
    """
    keys: list[str] = []
    texts: list[tuple[int, int, str, bool, int, str]] = []
    stack: list[tuple[str, int, str, bool]] = []  # name, path, region, dropped
    opened: Counter[str] = Counter()
    solid: set[int] = set()
    block, at, n = 0, 0, len(page)

    def text(raw: str) -> None:
        if raw.strip():
            _, path, region, dropped = stack[-1] if stack else ("", 0, "", False)
            texts.append((len(keys), path, region, dropped, block, html.unescape(raw)))
            keys.append("#")
            if any(opened[x] > 0 for x in SOLID):
                solid.add(block)
        elif raw and texts and texts[-1][4] == block:
            texts.append((-1, *texts[-1][1:4], block, " "))

    def close(i: int) -> None:
        opened.subtract(x[0] for x in stack[i:])
        del stack[i:]

    while at < n:
        m = TOKEN.search(page, at)
        if not m:
            text(page[at:])
            break
        if m.start() > at:
            text(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if name in RAW:
            if not m[1] and not m[3].endswith("/"):
                end = RAW_END[name].search(page, at)
                at = end.end() if end else n
            continue
        if name in BLOCK:
            block += 1
        if name == "br":
            text(" ")
            continue
        if m[1]:
            if opened[name] > 0:
                keys.append(f"</{name}>")
                close(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name))
            continue
        if name in VOID:
            continue
        if name in CLOSERS:
            for i in range(len(stack) - 1, -1, -1):
                if name in CLOSES.get(stack[i][0], ()):
                    close(i)
                    break
                if stack[i][0] in BLOCK:
                    break
        said = " ".join(a or b or c for _, a, b, c in ATTRIBUTE.findall(m[3])) if m[3] else ""
        _, path, region, dropped = stack[-1] if stack else ("", 0, "", False)
        step = f"{name}.{said}" if said else name
        if name in ("article", "main") and not dropped and region != "article":
            region = name
        dropped = dropped or name in DROPPED or (name == "header" and not region) or bool(said and name not in ("html", "body", "article", "main") and is_mark(said))
        stack.append((name, step_of(path, step), region, dropped))
        opened[name] += 1
        keys.append(f"<{step}>")
    return keys, texts, solid


def fold(keys: list) -> tuple[list, list[int]]:
    """Nodes, where equal adjacent groups of up to ``PERIOD`` nodes are one repeated group, and where each begins in ``keys``."""
    out: list = []
    starts: list[int] = []
    for at, key in enumerate(keys):
        out.append(key)
        starts.append(at)
        again = True
        while again:
            again = False
            for p in range(1, min(PERIOD, len(out) - 1) + 1):
                before = out[-p - 1]
                if isinstance(before, tuple) and before[1] == tuple(out[-p:]):
                    n = p
                elif before == out[-1] and len(out) >= 2 * p and out[-2 * p : -p] == out[-p:] and any(isinstance(x, tuple) or x[0] == "<" for x in out[-p:]):
                    n, out[-2 * p] = 2 * p - 1, ("+", tuple(out[-p:]))
                else:
                    continue
                del out[-n:], starts[-n:]
                again = True
                break
    return out, starts


def by_first(nodes: Iterable) -> dict:
    """The groups that are repeated among the nodes, by the first node of each; the longest first."""
    found: dict = {}
    for group in sorted({x[1] for x in nodes if isinstance(x, tuple) and x[0] == "+"}, key=lambda x: (-len(x), str(x))):
        found.setdefault(group[0], []).append(group)
    return found


def lifted(nodes: list, starts: list[int], groups: dict) -> tuple[list, list[int]]:
    """The same, where a group that is repeated on another page is a repeated group of one turn."""
    out, begins, at = [], [], 0
    while at < len(nodes):
        group = next((x for x in groups.get(nodes[at], ()) if tuple(nodes[at : at + len(x)]) == x), None)
        out.append(("+", group) if group else nodes[at])
        begins.append(starts[at])
        at += len(group) if group else 1
    return out, begins


def rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest subsequence of pairs, which are in order of the first, that is in order of the second too."""
    ends: list[int] = []
    last: list[int] = []
    before: list[int] = []
    for i, (_, y) in enumerate(pairs):
        k = bisect_left(ends, y)
        before.append(last[k - 1] if k else -1)
        ends[k : k + 1], last[k : k + 1] = [y], [i]
    out, i = [], last[-1] if last else -1
    while i >= 0:
        out.append(pairs[i])
        i = before[i]
    return out[::-1]


def runs(a: list, b: list) -> list[tuple[int, int, int]]:
    """Matching runs ``(a, b, length)`` in order: the common start, the common end, and between them what lies about anchors.

    Anchors are the nodes that both have once, as many as are in the same order; where there are none, the common node that
    both have equally often, else rarely, its first with the first and so on. Between anchors the same is done again.
    """
    found = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, l = todo.pop()
        n, most = 0, min(j - i, l - k)
        while n < most and a[i + n] == b[k + n]:
            n += 1
        m = 0
        while m < most - n and a[j - m - 1] == b[l - m - 1]:
            m += 1
        found += [(i, k, n), (j - m, l - m, m)]
        i, j, k, l = i + n, j - m, k + n, l - m
        if i == j or k == l:
            continue
        at: dict = {}
        for y in range(k, l):
            at.setdefault(b[y], ([], []))[1].append(y)
        for x in range(i, j):
            if a[x] in at:
                at[a[x]][0].append(x)
        common = [x for x in at.values() if x[0]]
        anchors = rising(sorted((x[0][0], x[1][0]) for x in common if len(x[0]) == len(x[1]) == 1))
        if not anchors and common:
            anchors = list(zip(*min(common, key=lambda x: (len(x[0]) != len(x[1]), max(len(x[0]), len(x[1])), x[0][0])), strict=False))
        if anchors:
            ends = [(i, k), *anchors, (j, l)]
            todo += [(x, x2, y, y2) for (x, y), (x2, y2) in zip(ends, ends[1:], strict=False)]
    return sorted(x for x in found if x[2])


def align(wrapper: list, other: list) -> list:
    """The wrapper made to fit what another one fits; both are nodes with whether they are optional."""
    out: list = []
    at = there = 0
    for a, b, n in [*runs([x for x, _ in wrapper], [x for x, _ in other]), (len(wrapper), len(other), 0)]:
        out += [(x, True) for x, _ in wrapper[at:a] + other[there:b]]
        out += [(x, one or two) for (x, one), (_, two) in zip(wrapper[a : a + n], other[b : b + n], strict=True)]
        at, there = a + n, b + n
    return looped(out)


def looped(wrapper: list) -> list:
    """The wrapper, where optional nodes that follow each other are one loop if a node recurs too often among them, or one is a loop already."""
    out: list = []
    for optional, some in groupby(wrapper, key=lambda x: x[1]):
        some = list(some)
        if optional and (any(x[0] == "*" for x, _ in some) or max(Counter(x for x, _ in some).values()) > REPEATS):
            nodes = {y for x, _ in some for y in (x[1] if x[0] == "*" else (x,))}
            some = [(("*", tuple(sorted(nodes, key=str))), True)]
        out += some
    return out


def frozen(node):
    """A node as read from JSON."""
    return node if isinstance(node, str) else (node[0], tuple(map(frozen, node[1])))


def merged(operands: list[list]) -> list:
    """One wrapper that fits what each of several fits."""
    groups = by_first(y for nodes in operands for x, _ in nodes for y in (x[1] if x[0] == "*" else (x,)))
    out: list = []
    for i, nodes in enumerate(operands):
        found, begins = lifted([x for x, _ in nodes], list(range(len(nodes))), groups)
        ends = [*begins, len(nodes)][1:]
        lift = [(x, any(o for _, o in nodes[a:b])) for x, a, b in zip(found, begins, ends, strict=True)]
        out = align(out, lift) if i else looped(lift)
    return out


def shown(wrapper: list) -> str:
    """The wrapper as a regular expression."""
    one = lambda x: x if isinstance(x, str) else f"( {' '.join(f'( {one(y)} )?' if x[0] == '*' else one(y) for y in x[1])} )+"
    return " ".join(f"( {one(x)} )?" if optional else one(x) for x, optional in wrapper)


def region_of(texts: list) -> str:
    """The region that holds the page's article; empty where it has neither ``article`` nor ``main``."""
    regions = {r for _, _, r, dropped, _, _ in texts if r and not dropped}
    return "article" if "article" in regions else "main" if "main" in regions else ""


def mark(path: int, text: str = "") -> int:
    """64 bits that stand for a block's path and whole text, or for a path."""
    return int.from_bytes(xxhash.xxh3_64_digest(text.encode("utf-8", "replace"), seed=path), "big", signed=True)


def marked(texts: list) -> dict[int, tuple[int, int]]:
    """Of each block with text that isn't dropped: the marks of its path and of its path and whole text."""
    blocks: dict[int, tuple[int, list[str]]] = {}
    for at, path, _, dropped, block, text in texts:
        if not dropped and (at >= 0 or block in blocks):
            blocks.setdefault(block, (path, []))[1].append(text)
    return {block: (mark(path), mark(path, said)) for block, (path, pieces) in blocks.items() if (said := " ".join("".join(pieces).split()))}


def article_blocks(texts: list, region: str) -> set[int]:
    """The blocks with text that the page's region encloses."""
    return {block for at, _, where, dropped, block, _ in texts if at >= 0 and not dropped and region and where == region}


def template_blocks(said: dict[int, int], inside: set[int], solid: set[int], templates: set[int]) -> dict[int, int]:
    """Of the blocks with their marks those that are template on a page."""
    found = {b: x for b, x in said.items() if x in templates}
    kept = inside if 2 * len((found.keys() & inside) - solid) > len(inside) else solid & inside
    return {b: x for b, x in found.items() if b not in kept}


def template_key(said: int) -> str:
    return f"={said & (1 << 64) - 1:x}"


def tokens(page: str, templates: set[int]) -> tuple[list[str], list, set[int]]:
    """The token stream with a slot or a template text at each text, the texts, and the blocks that are template."""
    keys, texts, solid = parse(page)
    said = {}
    if templates:
        said = template_blocks({b: x for b, (_, x) in marked(texts).items()}, article_blocks(texts, region_of(texts)), solid, templates)
    for at, path, _, dropped, block, _ in texts:
        if at >= 0:
            keys[at] = template_key(said[block]) if block in said and not dropped else f"#{path:x}"
    return keys, texts, set(said)


def is_own(region: str, dropped: bool, wanted: str) -> bool:
    """Whether what encloses a text takes it for the article, on a page whose article is in the region ``wanted``."""
    return not dropped and (region == wanted or not wanted)


class Wrapper:
    """Nodes that pages of a host are matched against, and the verdicts of their slots."""

    def __init__(self, nodes: list, templates: Iterable[int] = (), verdicts: dict[str, bool] | None = None) -> None:
        self.nodes, self.templates, self.verdicts = nodes, set(templates), verdicts or {}
        self.loops = [(i, set(x[1])) for i, x in enumerate(nodes) if x[0] == "*"]
        single = [y for x in nodes for y in (x[1] if x[0] == "*" else (x,))]
        self.groups, self.keys = by_first(single), set()
        while single:
            x = single.pop()
            if isinstance(x, str):
                self.keys.add(x)
            else:
                single += x[1]
        self._places: dict[tuple, list[int]] = {}

    @classmethod
    def read(cls, said: str) -> Wrapper:
        x = json.loads(said)
        return cls(list(map(frozen, x["fit"]["nodes"])), x.get("templates", ()), x.get("verdicts"))

    def places(self, nodes: tuple) -> list[int]:
        """The wrapper's node of each node of a folded and lifted stream; between nodes that match, loops take what they hold."""
        found = self._places.get(nodes)
        if found is None:
            found, at, there = [-1] * len(nodes), 0, 0
            for a, b, n in [*runs(list(nodes), self.nodes), (len(nodes), len(self.nodes), 0)]:
                loops = [x for x in self.loops if there <= x[0] < b] if at < a else ()
                for i in range(at, a) if loops else ():
                    found[i] = next((j for j, held in loops if nodes[i] in held), -1)
                found[a : a + n] = range(b, b + n)
                at, there = a + n, b + n
            if len(self._places) >= 32:
                self._places.clear()
            self._places[nodes] = found
        return found

    def spread(self, nodes: list, starts: list[int], n: int) -> list[int]:
        """The wrapper's node of each of the ``n`` tokens of a folded stream."""
        nodes, starts = lifted(nodes, starts, self.groups)
        ends = [*starts, n][1:]
        return [j for j, a, b in zip(self.places(tuple(nodes)), starts, ends, strict=True) for _ in range(a, b)]

    def match(self, keys: list[str]) -> list[int]:
        """The node that each token of a page falls to, -1 where the wrapper has none."""
        held = [i for i, key in enumerate(keys) if key in self.keys]
        found = [-1] * len(keys)
        for i, j in zip(held, self.spread(*fold([keys[i] for i in held]), len(held)), strict=True):
            found[i] = j
        return found


def infer(pages: list[str], templates: Iterable[int] = ()) -> dict:
    """``{"expression", "nodes"}`` of pages at hand; ``wrappers`` makes the same of tables, with the verdicts of the nodes."""
    folded = [fold(tokens(page, set(templates))[0])[0] for page in pages]
    wrapper = merged([[(x, False) for x in nodes] for nodes in folded])
    return {"expression": shown(wrapper), "nodes": [x for x, _ in wrapper]}


def extract(page: str, wrapper: Wrapper | None) -> str:
    """The article's text: blocks in order, joined by an empty line.

    Texts take the verdict of the node that they fall to. Where there is none, they are judged by what encloses them; a template text is then
    body only if the page has it at a node of the wrapper too.
    """
    keys, texts, template = tokens(page, wrapper.templates if wrapper else set())
    wanted = region_of(texts)
    node = wrapper.match(keys) if wrapper and texts else [-1] * len(keys)
    said = {keys[at] for at, *_ in texts if at >= 0 and node[at] >= 0} if template else set()
    blocks: dict[int, list[str]] = {}
    for at, _, region, dropped, block, text in texts:
        keep = wrapper.verdicts.get(f"{node[at]} {keys[at]} {wanted}") if at >= 0 and node[at] >= 0 else None
        if keep is None:
            keep = is_own(region, dropped, wanted) and (block not in template or at < 0 or keys[at] in said and node[at] < 0)
        if keep:
            blocks.setdefault(block, []).append(text)
    joined = (" ".join("".join(x).split()) for x in blocks.values())
    return "\n\n".join(x for x in joined if x)


def host_of(url) -> F.Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^:/?#]*://([^/?#]*)", 1))


SLOT = {"at": pa.int32(), "block": pa.int32(), "path": pa.int64(), "said": pa.int64(), "inside": pa.bool_(), "solid": pa.bool_(), "own": pa.bool_()}


def parsed(pages: DataFrame) -> DataFrame:
    """Every page ``(host, html)`` parsed: its content (what its article says) and digest, the region of its article, the keys
    of its token stream, and of each text its place there, block, marks (null where dropped), and whether it is in the article,
    in a heading or table, and the article's own by what encloses it."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            contents, digests, regions, streams, ends = [], [], [], [], [0]
            slots: dict[str, list] = {x: [] for x in SLOT}
            for page in batch.column("html").to_pylist():
                keys, texts, solid = parse(page or "")
                found, wanted = marked(texts), region_of(texts)
                inside = article_blocks(texts, wanted)
                # pages with the same article have the same content, whatever is about it
                said = [x for b, (_, x) in sorted(found.items()) if b in inside or not inside]
                contents.append(hashlib.blake2b(repr(said).encode(), digest_size=16).digest())
                digests.append(hashlib.blake2b((page or "").encode("utf-8", "replace"), digest_size=16).digest())
                for at, path, region, dropped, block, _ in texts:
                    if at >= 0:
                        keys[at] = f"#{path:x}"
                        own = found.get(block, (None, None)) if not dropped else (None, None)
                        for x, value in zip(slots.values(), (at, block, *own, block in inside, block in solid, is_own(region, dropped, wanted)), strict=True):
                            x.append(value)
                regions.append(wanted)
                streams.append(keys)
                ends.append(len(slots["at"]))
            flat = pa.StructArray.from_arrays([pa.array(slots[x], t) for x, t in SLOT.items()], list(SLOT))
            columns = [batch.column("host"), pa.array(contents, pa.binary()), pa.array(digests, pa.binary()), pa.array(regions, pa.string()), pa.array(streams, pa.list_(pa.string())), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)]
            return pa.RecordBatch.from_arrays(columns, ["host", "content", "digest", "wanted", "keys", "slots"])

        return work

    return per_slice(pages.select("host", "html"), make, "host string, content binary, digest binary, wanted string, keys array<string>, slots array<struct<at:int,block:int,path:bigint,said:bigint,inside:boolean,solid:boolean,own:boolean>>")


def template_texts(seen: DataFrame) -> DataFrame:
    """``(host, templates array<bigint>)`` from all contents of parsed pages.

    A path has at most twice as many template texts as a page has blocks there, however many pages a host has.
    """
    own = F.filter("slots", lambda x: x["said"].isNotNull())
    block = lambda said: F.transform(own, lambda x: F.struct(x["path"].alias("path"), said(x).alias("said"), x["inside"].alias("inside")))
    blocks = F.array_distinct(F.concat(block(lambda x: x["said"]), block(lambda x: F.lit(0).cast("long"))))
    distinct = seen.select("host", "content", "digest", blocks.alias("blocks")).groupBy("host", "content").agg(F.min_by("blocks", "digest").alias("blocks"))
    counted = distinct.select("host", F.explode("blocks").alias("x")).groupBy("host", "x.path", "x.inside", "x.said").agg(F.count("*").alias("n")).where("n > 1")
    counted = written(counted, "block_counts")
    whole = counted.where("said = 0").select("host", "path", "inside", F.col("n").alias("of"))
    enough = (F.col("n") > F.col("of") * TEMPLATE_SHARE) & (F.col("n") >= F.when(F.col("inside"), LEAST_INSIDE).otherwise(LEAST))
    often = counted.where("said <> 0").join(whole, ["host", "path", "inside"]).where(enough)
    return often.groupBy("host").agg(F.array_sort(F.collect_set("said")).alias("templates"))


def beside(rows: DataFrame, known: DataFrame, column: str) -> tuple[DataFrame, Callable[[pa.RecordBatch], list]]:
    """The rows with what is known of their hosts ``(host, column string)``, and how a task reads it: sent once where it is little, else joined."""
    size = known.agg(F.sum(F.length(column)).alias("n")).first().n or 0
    if size > MOST_BYTES:
        return rows.join(known.select("host", column), "host", "left"), lambda batch: batch.column(column).to_pylist()
    sent = rows.sparkSession.sparkContext.broadcast({r.host: r[column] for r in known.select("host", column).collect()})
    return rows, lambda batch: [sent.value.get(x) for x in batch.column("host").to_pylist()]


def remembered(read: Callable, most: int = 500) -> Callable:
    """``read`` of strings, where the last are kept; None stays None."""
    found: dict = {}

    def one(said: str | None):
        if said is None:
            return None
        if said not in found:
            if len(found) >= most:
                found.clear()
            found[said] = read(said)
        return found[said]

    return one


def shapes(seen: DataFrame, about: DataFrame) -> DataFrame:
    """``(host, shape, body, n)``: each shape of a host's pages and how many distinct pages have it, all pages counted.

    A shape is the folded stream, the region of the article, and of each text the node, key and whether it is the article's own, as JSON.
    """
    rows, read = beside(seen.select("host", "digest", "wanted", "keys", "slots"), about, "about")

    def make():
        def sets(said: str) -> tuple[set, set]:
            x = json.loads(said)
            return set(x["keys"]), set(x.get("templates", ()))

        known, told = remembered(sets), set()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            flat = batch.column("slots").flatten()
            fields = [flat.field(x).to_pylist() for x in SLOT]
            ids, bodies, end = [], [], 0
            for host, wanted, keys, n, said in zip(*[batch.column(x).to_pylist() for x in ("host", "wanted", "keys")], batch.column("slots").value_lengths().to_pylist(), read(batch), strict=True):
                kept, templates = known(said) or ((), ())
                at, block, _, marks, inside, solid, own = (x[end : end + n] for x in fields)
                end += n
                template = {}
                if templates:
                    blocks = lambda flags: {b for b, x in zip(block, flags, strict=True) if x}  # noqa: B023, E731
                    template = template_blocks({b: x for b, x in zip(block, marks, strict=True) if x is not None}, blocks(inside), blocks(solid), templates)
                texts = {}
                for i, b, x, o in zip(at, block, marks, own, strict=True):
                    if b in template and x is not None:
                        keys[i] = template_key(template[b])
                    texts[i] = o
                held = [i for i, key in enumerate(keys) if key in kept or key[0] == "="]
                nodes, starts = fold([keys[i] for i in held])
                node = [j for j, (a, b) in enumerate(zip(starts, [*starts, len(held)][1:], strict=True)) for _ in range(a, b)]
                body = json.dumps({"wanted": wanted, "nodes": nodes, "texts": sorted({(j, keys[i], texts[i]) for i, j in zip(held, node, strict=True) if i in texts})})
                ids.append(hashlib.blake2b(body.encode("utf-8", "replace"), digest_size=16).digest())
                bodies.append(None if (host, ids[-1]) in told else body)
                if len(told) > 10_000:
                    told.clear()
                told.add((host, ids[-1]))
            return pa.RecordBatch.from_arrays([batch.column("host"), batch.column("digest"), pa.array(ids, pa.binary()), pa.array(bodies, pa.string())], ["host", "digest", "shape", "body"])

        return work

    found = per_slice(rows, make, "host string, digest binary, shape binary, body string")
    return found.groupBy("host", "shape", "digest").agg(F.max("body").alias("body")).groupBy("host", "shape").agg(F.max("body").alias("body"), F.count("*").alias("n"))


def fitted(found: DataFrame) -> DataFrame:
    """``(host, n, expression, body)``: the wrapper of each host, merged from shapes in rounds."""

    def merge(key: tuple, some: pd.DataFrame) -> pd.DataFrame:
        read = [json.loads(x) for x in some.sort_values(["n", "body"], ascending=[False, True])["body"]]
        out = merged([list(zip(map(frozen, x["nodes"]), map(bool, x.get("optional", [0] * len(x["nodes"]))), strict=True)) for x in read])
        body = json.dumps({"nodes": [x for x, _ in out], "optional": [int(x) for _, x in out]})
        return pd.DataFrame({"host": [key[0]], "id": [key[1]], "n": [int(some["n"].sum())], "expression": [shown(out)], "body": [body]})

    parts, before = found.select("host", F.xxhash64("shape").alias("id"), "n", "body"), None
    while True:
        sizes = parts.groupBy("host").agg(F.count("*").alias("parts"))
        parts = parts.join(sizes, "host").withColumn("part", F.pmod("id", F.ceil(F.col("parts") / FAN)))
        parts = written(parts.groupBy("host", "part").applyInPandas(merge, "host string, id bigint, n bigint, expression string, body string"), "partial_wrappers")
        if before is not None:
            dropped(before)
        if parts.groupBy("host").count().where("count > 1").isEmpty():
            return parts
        before = parts


def verdicts_of(found: DataFrame, fits: DataFrame) -> DataFrame:
    """``(host, verdicts string)``: what each node says of its texts, from all pages of all shapes.

    A verdict belongs to a node, a text's key in it, and the region that holds the page's article. That of a slot is what
    most of its pages enclose it by. A template text is body only at a node that fewer pages have than another node of the
    same text.
    """
    rows, read = beside(found.select("host", F.col("body").alias("shape"), "n"), fits.select("host", F.concat(F.lit('{"fit":'), "body", F.lit("}")).alias("fit")), "fit")

    def make():
        wrapper_of = remembered(Wrapper.read)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for host, shape, n, fit in zip(*[batch.column(x).to_pylist() for x in ("host", "shape", "n")], read(batch), strict=True):
                x = json.loads(shape)
                nodes = list(map(frozen, x["nodes"]))
                node = wrapper_of(fit).spread(nodes, list(range(len(nodes))), len(nodes))
                out += [(host, j, key, x["wanted"], own, n) for j, key, own in {(node[i], key, own) for i, key, own in x["texts"]} if j >= 0]
            types = {"host": pa.string(), "node": pa.int32(), "key": pa.string(), "wanted": pa.string(), "own": pa.bool_(), "n": pa.int64()}
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(types.values())], list(types))

        return work

    votes = per_slice(rows, make, "host string, node int, key string, wanted string, own boolean, n bigint")
    votes = votes.groupBy("host", "node", "key", "wanted").agg(F.sum(F.when(F.col("own"), F.col("n")).otherwise(0)).alias("yes"), F.sum("n").alias("of"))
    votes = votes.withColumn("pages", F.sum("of").over(Window.partitionBy("host", "key", "node"))).withColumn("most", F.max("pages").over(Window.partitionBy("host", "key")))
    said = (F.col("yes") * 2 > F.col("of")) & (F.col("key").startswith("#") | (F.col("pages") < F.col("most")))
    entry = F.struct(F.concat_ws(" ", F.col("node").cast("string"), "key", "wanted").alias("key"), said.alias("value"))
    return votes.groupBy("host").agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("verdicts"))


def wrappers(pages: DataFrame) -> DataFrame:
    """``(host, expression, wrapper)``, the wrapper as JSON, written; pages are ``(host, html)``, and all of them count."""
    seen = written(parsed(pages), "parsed")
    # tokens that more than one page has; no other page can meet those of a single one
    common = seen.select("host", F.explode(F.array_distinct("keys")).alias("key")).groupBy("host", "key").agg(F.count("*").alias("n")).where("n > 1")
    common = common.groupBy("host").agg(F.collect_list("key").alias("keys"))
    about = written(common.join(template_texts(seen), "host", "left").select("host", F.to_json(F.struct("keys", "templates")).alias("about"), F.to_json("templates").alias("templates")), "hosts")
    found = written(shapes(seen, about), "shapes")
    dropped(seen)
    fits = fitted(found)
    all_of = fits.join(about, "host", "left").join(verdicts_of(found, fits), "host", "left")
    said = F.concat(F.lit('{"fit":'), "body", F.lit(',"templates":'), F.coalesce("templates", F.lit("[]")), F.lit(',"verdicts":'), F.coalesce("verdicts", F.lit("{}")), F.lit("}"))
    out = written(all_of.select("host", "expression", said.alias("wrapper")), "wrappers")
    dropped(about, found, fits)
    return out


def texts(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text)`` of every row."""
    rows = documents(pages, "page_id", "url", "html").withColumn("host", host_of(F.col("url")))
    key = pages.schema["page_id"].dataType.simpleString()
    joined, read = beside(rows.select("page_id", "url", "host", "html"), wrappers(rows.select("host", "html")), "wrapper")

    def make():
        wrapper_of = remembered(Wrapper.read)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [extract(page or "", wrapper_of(x)) for page, x in zip(batch.column("html").to_pylist(), read(batch), strict=True)]
            return pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(found, pa.string())], ["page_id", "url", "text"])

        return work

    return per_slice(joined, make, f"page_id {key}, url string, text string")


def extracted(pages: DataFrame) -> DataFrame:
    """The query's columns."""
    return texts(pages).withColumn("n_chars", F.length("text").cast("long"))
