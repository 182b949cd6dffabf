"""HTML extraction with wrappers: union-free regular expressions inferred for each host.

A page is read into a tree of block elements and text runs; inline markup leaves no trace, scripts,
styles and comments in the markup go, and unclosed elements end where their parents do. A host's
wrapper starts as one of its pages. Neighbouring siblings of one kind fold into a repeated
group; each further page is aligned with the wrapper, child list by child list: elements that both
have are merged, those that one lacks become optional groups, texts that differ become slots.

From the wrapper come the host's main regions and its template texts:
- the paths to the deepest elements that hold most of the text that varies from page to page and
  isn't links; there are several if elements take each other's place (layouts), and a page is read by
  the first it has. Article and main elements are hints: a path ends at one, and within it the host's
  articles (or main elements) count if they hold most of that text;
- texts of at least TEMPLATE_PAGES different pages that are the same wherever the wrapper has them, or
  that TEMPLATE_SHARE of the host's pages have; within articles too.

A page's text is that of its nodes on a main path, without template texts and without menus, footers,
sidebars, notices, adverts, forms and reader comments (by element, role, or words of class and id).
Pages that don't fit a main path, and those of hosts with fewer than TEMPLATE_PAGES different pages,
are read from their own article or main elements, or else whole.

Scale: all pages are learned from. A task folds its pages into one wrapper for each host, and a host's
wrappers of all tasks are merged, so a hot host brings as many as there are tasks. Texts are counted
as 64-bit digests with the digest of their page, equal pages once. What extraction gets of a wrapper is
paths and digests, so the table of wrappers grows with the number of hosts; Spark broadcasts it only
under its size threshold, else pages meet wrappers in a join that splits hot hosts. A wrapper depends
on the order of alignment, so odd hosts may be read otherwise if the input is split otherwise.
Long child lists are aligned in about linear time.

Defined cases: null or empty html is an empty text; so is html without a body text. A null url, or
one without a host, is the host ''. Repeated rows and equal pages are ordinary rows. A null page_id
is kept. An empty table gives no rows. Extra columns are left out.
"""

from __future__ import annotations

import html as entities
import json
import re
import sys
from bisect import bisect_left
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestack.session import materialize

TEMPLATE_PAGES = 3
#: Share of a host's pages that have a template text which isn't the same on all.
TEMPLATE_SHARE = 0.375
#: Share of the varying text that the main region must hold.
MAIN_SHARE = 0.7
#: A longer text is a template text only if TEMPLATE_SHARE of the host's pages have it: copied articles aren't.
LONG_TEXT = 300
#: Elements nested deeper are read as parts of the one at this depth.
DEEPEST = 150
#: Child lists whose lengths multiply to more are aligned by the order of their kinds.
EXACT = 1 << 14
#: Words that name sections of an article in an anchor.
_TOPICS = frozenset("discussion related recommended recommendations notice notices alert share sharing replies respond promotion disclaimer consent menu navigation signup subscription".split())
_ANCHORED = frozenset("section p h1 h2 h3 h4 h5 h6 li dl dt dd table blockquote figure".split())

_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q s samp small span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_DROPPED = frozenset("nav footer aside form head select button dialog menu iframe object canvas audio video svg map template noscript".split())
_BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs sidebar "
    "aside footer cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription signup login comment comments commentlist "
    "disqus reply replies respond discussion share sharing social related recommended recommendations widget widgets pagination pager toolbar masthead alert disclaimer".split()
)
_HEADS = frozenset("header topbar".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
_ENDS_P = frozenset("address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|textarea|title|xmp|noframes)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>"
    r"|</?([a-zA-Z][a-zA-Z0-9:-]*)[^>]*>"
    r"|<[!?][^>]*>"
    r"|<[/a-zA-Z!?][^>]*\Z",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Node:
    """A block element: its tag, its kind (tag and classes, which alignment goes by), whether it is boilerplate, its children."""

    __slots__ = ("tag", "kind", "dropped", "main", "kids")

    def __init__(self, tag: str, kind: str, dropped: bool, main: bool) -> None:
        self.tag, self.kind, self.dropped, self.main = tag, kind, dropped, main
        self.kids: list[Node | Text] = []


class Text:
    """A run of text between block tags, and how many of its characters are links."""

    __slots__ = ("value", "linked")

    def __init__(self, value: str, linked: int) -> None:
        self.value, self.linked = value, linked


@lru_cache(maxsize=4096)
def _element(tag: str, attributes: str) -> tuple[str, bool, bool]:
    """kind, dropped, main."""
    names, anchors, role, hidden = [], [], "", False
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), next((x for x in m.groups()[1:] if x is not None), "")
        if key in ("class", "id"):
            names.append(value)
            if key == "id" and tag in _ANCHORED:
                anchors.append(value)
        elif key == "role":
            role = value.lower()
        elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            hidden = True
        elif key == "style":
            hidden |= re.sub(r"\s", "", value.lower()).find("display:none") >= 0
    words = {w.lower() for n in names if n not in anchors for w in _NAME_WORD.findall(n)}
    words |= {w.lower() for n in anchors for w in _NAME_WORD.findall(n)} - _TOPICS
    main = tag in ("article", "main") or role in ("main", "article")
    whole = tag in ("html", "body", "main")
    dropped = tag in _DROPPED or role in _ROLES or hidden or (not whole and bool(words & _BOILERPLATE))
    if not main and (tag == "header" or words & _HEADS) and not whole:
        tag_kind = "header"
    else:
        tag_kind = tag
    classes = ".".join(sorted({re.sub(r"\d+", "0", c) for n in names for c in n.split()}))
    return f"{tag_kind}.{classes}" if classes else tag_kind, dropped, main and not dropped


def parse(html: str) -> Node:
    """The page's tree."""
    root = Node("#page", "#page", False, False)
    stack = [root]
    run: list[str] = []
    links = linked = at = 0
    skip: list[str] = []  # open elements of one tag, within a dropped inline element
    deeper: list[str] = []  # open elements under the deepest

    def flush() -> None:
        nonlocal linked
        if run:
            value = " ".join(entities.unescape("".join(run)).split())
            if value:
                stack[-1].kids.append(Text(value, min(linked, len(value))))
            run.clear()
            linked = 0

    def text(raw: str) -> None:
        nonlocal linked
        if raw and not skip:
            run.append(raw)
            if links:
                linked += len(raw)

    for m in _TOKEN.finditer(html):
        text(html[at : m.start()])
        at = m.end()
        tag = (m[3] or m[5] or "").lower()
        if not tag:
            continue
        closing = m[2] == "/" if m[3] else m[0][1] == "/"
        if skip:
            if tag == skip[0]:
                skip.pop() if closing else skip.append(tag)
            continue
        if tag in _INLINE:
            if tag == "a":
                links = max(0, links - 1) if closing else links + 1
            elif not closing and tag != "wbr" and m[4] and _element(tag, m[4])[1]:
                skip.append(tag)
            continue
        flush()
        if len(stack) >= DEEPEST and tag not in _VOID:
            if closing and tag in deeper[-DEEPEST:]:
                while deeper.pop() != tag:
                    pass
                continue
            if not closing and not (m[4] or "").endswith("/"):
                skip.append(tag) if _element(tag, m[4] or "")[1] else deeper.append(tag)
                continue
        if closing:
            deeper.clear()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    links = 0
                    break
        elif tag not in _VOID:
            if tag in _ENDS_P and stack[-1].tag == "p":
                stack.pop()
            if tag in ("li", "tr", "td", "th", "dt", "dd", "option") and stack[-1].tag == tag:
                stack.pop()
            node = Node(tag, *_element(tag, m[4] or ""))
            stack[-1].kids.append(node)
            if not (m[4] or "").endswith("/"):
                stack.append(node)
    text(html[at:])
    flush()
    return root


# Wrappers: {"kind", "tag", "dropped", "main", "pages", "plus", "opt", "kids"} for elements, and for texts
# {"value" (None: a slot), "pages", "chars", "linked", "opt"}.


def _fold(kids: list[dict]) -> list[dict]:
    """Neighbouring siblings of one kind become a repeated group."""
    out: list[dict] = []
    for kid in kids:
        if out and "kind" in kid and out[-1].get("kind") == kid["kind"]:
            out[-1] = _merged(out[-1], kid, False) | {"plus": True}
        else:
            out.append(kid)
    return out


def as_wrapper(node: Node | Text) -> dict:
    if isinstance(node, Text):
        return {"value": node.value, "pages": 1, "chars": len(node.value), "linked": node.linked, "opt": False}
    return {"kind": node.kind, "tag": node.tag, "dropped": node.dropped, "main": node.main, "pages": 1, "plus": False, "opt": False, "kids": _fold([as_wrapper(k) for k in node.kids])}


def _merged(a: dict, b: dict, other_page: bool) -> dict:
    pages = a["pages"] + b["pages"] if other_page else max(a["pages"], b["pages"])
    if "kind" not in a:
        return {
            "value": a["value"] if a["value"] == b["value"] else None,
            "pages": pages,
            "chars": a["chars"] + b["chars"],
            "linked": a["linked"] + b["linked"],
            "opt": a["opt"] or b["opt"],
        }
    return a | {"plus": a["plus"] or b["plus"], "opt": a["opt"] or b["opt"], "main": a["main"] and b["main"], "pages": pages, "kids": _aligned(a["kids"], b["kids"], other_page)}


def _pairs(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Positions of a common subsequence: a longest one, or for long lists one of elements that are each their kind's k-th in both."""
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    high = 0
    while high < min(len(a), len(b)) - low and a[-1 - high] == b[-1 - high]:
        high += 1
    ends = [(len(a) - high + k, len(b) - high + k) for k in range(high)]
    m, n = len(a) - high - low, len(b) - high - low
    out = [(k, k) for k in range(low)]
    if m * n <= EXACT:
        best = [[0] * (n + 1) for _ in range(m + 1)]
        for i in range(m - 1, -1, -1):
            for j in range(n - 1, -1, -1):
                best[i][j] = best[i + 1][j + 1] + 1 if a[low + i] == b[low + j] else max(best[i + 1][j], best[i][j + 1])
        i = j = 0
        while i < m and j < n:
            if a[low + i] == b[low + j]:
                out.append((low + i, low + j))
                i, j = i + 1, j + 1
            elif best[i + 1][j] >= best[i][j + 1]:
                i += 1
            else:
                j += 1
        return out + ends
    places: dict[str, list[int]] = {}
    for j in range(len(b) - high - 1, low - 1, -1):
        places.setdefault(b[j], []).append(j)
    met = [(i, places[a[i]].pop()) for i in range(low, len(a) - high) if places.get(a[i])]
    tails: list[int] = []  # least last position in b of increasing runs of each length
    ranks = []
    for _, j in met:
        at = bisect_left(tails, j)
        tails[at : at + 1] = [j]
        ranks.append(at)
    want, middle = len(tails) - 1, []
    for (i, j), rank in zip(reversed(met), reversed(ranks), strict=True):
        if rank == want and (not middle or j < middle[-1][1]):
            middle.append((i, j))
            want -= 1
    return out + middle[::-1] + ends


def _aligned(a: list[dict], b: list[dict], other_page: bool) -> list[dict]:
    """A common subsequence of two child lists is merged; the rest is optional."""
    out, i, j = [], 0, 0
    for p, q in [*_pairs([x.get("kind", "") for x in a], [x.get("kind", "") for x in b]), (len(a), len(b))]:
        out.extend(x | {"opt": True} for x in [*a[i:p], *b[j:q]])
        if p < len(a):
            out.append(_merged(a[p], b[q], other_page))
        i, j = p + 1, q + 1
    return _fold(out)


def infer(pages: list[str]) -> dict:
    """The wrapper of pages of one host."""
    wrapper = as_wrapper(parse(pages[0]))
    for page in pages[1:]:
        wrapper = _merged(wrapper, as_wrapper(parse(page)), True)
    return wrapper


def expression(wrapper: dict) -> str:
    """The wrapper as a union-free regular expression: # is a slot, ( )? an optional group, ( )+ a repeated one."""
    if "kind" not in wrapper:
        own = "#" if wrapper["value"] is None else wrapper["value"]
        return f"({own})?" if wrapper["opt"] else own
    own = "".join(expression(k) for k in wrapper["kids"])
    own = own if wrapper["kind"] == "#page" else f"<{wrapper['kind']}>{own}</{wrapper['tag']}>"
    if wrapper["plus"] or wrapper["opt"]:
        return f"({own}){'*' if wrapper['plus'] and wrapper['opt'] else '+' if wrapper['plus'] else '?'}"
    return own


def _varying(wrapper: dict) -> float:
    """Characters of slots that aren't links, outside boilerplate."""
    if "kind" not in wrapper:
        return 0.0 if wrapper["value"] is not None and wrapper["pages"] >= TEMPLATE_PAGES else float(wrapper["chars"] - wrapper["linked"])
    return 0.0 if wrapper["dropped"] else sum(map(_varying, wrapper["kids"]))


def _held(node: dict, articles: bool) -> float:
    """What _varying() finds in the outermost article elements, or in main elements."""
    if "kind" not in node or node["dropped"]:
        return 0.0
    if node["main"] and (node["tag"] == "article" or not articles):
        return _varying(node)
    return sum(_held(k, articles) for k in node["kids"])


def _regions(node: dict, path: list[str], whole: float) -> list[list[str]]:
    """The paths to the main regions within an element; whole: the varying text that they stand for."""
    chosen, pages = [], 0
    if not node.get("main"):
        for kid in sorted((k for k in node["kids"] if "kind" in k and not k["dropped"] and (k["main"] or not k["plus"]) and k["tag"] != "p"), key=_varying, reverse=True):
            # One beside another that the same pages have isn't in its place.
            if _varying(kid) and pages + kid["pages"] <= node["pages"]:
                chosen.append((kid, _varying(kid)))
                pages += kid["pages"]
    held = sum(v for _, v in chosen)
    if not chosen or held < MAIN_SHARE * whole:
        return [path]
    return [p for kid, v in chosen for p in _regions(kid, [*path, kid["kind"]], whole * v / held)]


def digest(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def summary(wrapper: dict, pages: int) -> str:
    """What extraction needs of a wrapper, as JSON: the main paths, if they are decided, which marked elements count within them, and the template texts' digests."""
    total = _varying(wrapper) if pages >= TEMPLATE_PAGES else 0.0
    main = _regions(wrapper, [], total) if total else []
    hint = next((h for h in ("article", "main") if total and _held(wrapper, h == "article") >= MAIN_SHARE * total), "")
    template: list[int] = []

    def gather(node: dict) -> None:
        for kid in node["kids"]:
            if "kind" in kid:
                if not kid["dropped"]:
                    gather(kid)
            elif kid["value"] is not None and kid["pages"] >= (TEMPLATE_PAGES if len(kid["value"]) <= LONG_TEXT else max(TEMPLATE_PAGES, TEMPLATE_SHARE * pages)):
                template.append(digest(kid["value"]))

    gather(wrapper)
    return json.dumps({"main": main, "decided": total > 0, "hint": hint, "template": sorted(set(template))})


@lru_cache(maxsize=1024)
def _loaded(raw: str) -> tuple[tuple[tuple[str, ...], ...], bool, str, frozenset[int]]:
    own = json.loads(raw)
    return tuple(map(tuple, own["main"])), own["decided"], own["hint"], frozenset(own["template"])


def _at_path(node: Node, path: tuple[str, ...]) -> list[Node]:
    found = [node]
    for kind in path:
        found = [k for n in found for k in n.kids if isinstance(k, Node) and k.kind == kind and not k.dropped]
    return found


def _outermost(node: Node, articles: bool) -> list[Node]:
    out = []
    for k in node.kids:
        if isinstance(k, Node) and not k.dropped:
            if k.main and (k.tag == "article") == articles:
                out.append(k)
            else:
                out.extend(_outermost(k, articles))
    return out


def _marked(node: Node) -> list[Node]:
    """The outermost article elements, or else main elements."""
    return _outermost(node, True) or _outermost(node, False)


def _texts(node: Node, inside: bool, template: frozenset[int], out: list[str]) -> None:
    for k in node.kids:
        if isinstance(k, Text):
            if (inside or 2 * k.linked <= len(k.value)) and not (template and digest(k.value) in template):
                out.append(k.value)
        elif not k.dropped and (inside or not k.kind.startswith("header")):
            _texts(k, inside or k.main, template, out)


def main_text(html: str | None, wrapper: str | None = None) -> str:
    """The main text of a page, by its host's wrapper if it fits."""
    if not html:
        return ""
    page = parse(html)
    paths, decided, hint, template = _loaded(wrapper) if wrapper else ((), False, "", frozenset())
    nodes = next((found for p in paths if (found := _at_path(page, p))), []) if decided else []
    if not nodes:
        nodes = _marked(page)
    elif hint:
        nodes = [x for n in nodes for x in ([n] if n.main and (n.tag == "article") == (hint == "article") else _outermost(n, hint == "article") or [n])]
    out: list[str] = []
    for node in nodes or [page]:
        _texts(node, node.main, template, out)
    return " ".join(out)


def host_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1), F.lit(""))


def _packed(wrapper: dict) -> str:
    """A wrapper as a flat JSON list in document order; nested JSON has a greatest depth."""
    out, left = [], [(0, wrapper)]
    while left:
        depth, node = left.pop()
        out.append([depth, {k: v for k, v in node.items() if k != "kids"}])
        left.extend((depth + 1, kid) for kid in reversed(node.get("kids", ())))
    return json.dumps(out)


def _unpacked(raw: str) -> dict:
    path: list[dict] = []
    for depth, node in json.loads(raw):
        del path[depth:]
        if "kind" in node:
            node["kids"] = []
        if path:
            path[-1]["kids"].append(node)
        path.append(node)
    return path[0]


def _values(node: Node, out: set[int]) -> set[int]:
    """Digests of the texts that may be template texts."""
    for k in node.kids:
        if isinstance(k, Node):
            if not k.dropped:
                _values(k, out)
        else:
            out.add(digest(k.value))
    return out


def wrappers(pages: DataFrame) -> DataFrame:
    """host and wrapper (its summary) of each host with at least TEMPLATE_PAGES different pages."""

    def read(batches):
        sys.setrecursionlimit(max(10_000, sys.getrecursionlimit()))
        folded: dict[str, dict] = {}
        seen: set[tuple[str, int]] = set()
        for batch in batches:
            hosts, texts, of = [], [], []
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = html.as_py()
                page = digest(raw)
                if (host, page) in seen:
                    continue
                seen.add((host, page))
                tree = parse(raw)
                own = as_wrapper(tree)
                folded[host] = _merged(folded[host], own, True) if host in folded else own
                found = [None, *_values(tree, set())]
                hosts.extend([host] * len(found))
                texts.extend(found)
                of.extend([page] * len(found))
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(texts, pa.int64()), pa.array(of, pa.int64()), pa.nulls(len(hosts), pa.string())], names=["host", "text", "page", "part"])
        for host, own in folded.items():
            yield pa.RecordBatch.from_arrays([pa.array([host]), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([_packed(own)])], names=["host", "text", "page", "part"])

    def merge(table: pa.Table) -> pa.Table:
        sys.setrecursionlimit(max(10_000, sys.getrecursionlimit()))
        whole = None
        for raw in sorted(table.column("part").to_pylist()):
            own = _unpacked(raw)
            whole = _merged(whole, own, True) if whole else own
        return pa.table({"host": [table.column("host")[0].as_py()], "wrapper": [summary(whole, whole["pages"])]}, schema=pa.schema([("host", pa.string()), ("wrapper", pa.string())]))

    some = pages.select(host_of(F.col("url")).alias("host"), "html").where(F.length("html") > 0)
    rows = materialize(some.mapInArrow(read, "host string, text long, page long, part string"), "layouts")
    kind = "main array<array<string>>, decided boolean, hint string, template array<long>"
    merged = rows.where("part IS NOT NULL").select("host", "part").groupBy("host").applyInArrow(merge, "host string, wrapper string").select("host", F.from_json("wrapper", kind).alias("w"))
    merged = materialize(merged, "merged")
    counts = rows.where("page IS NOT NULL").select("host", "text", "page").distinct().groupBy("host", "text").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= TEMPLATE_PAGES)
    counts = materialize(counts, "counts")
    totals = counts.where("text IS NULL").select("host", F.col("n").alias("total"))
    same = merged.select("host", F.explode("w.template").alias("text"), F.lit(True).alias("same"))
    template = counts.where("text IS NOT NULL").join(totals, "host").join(same, ["host", "text"], "left").where(F.col("same") | (F.col("n") >= TEMPLATE_SHARE * F.col("total")))
    listed = template.groupBy("host").agg(F.sort_array(F.collect_list("text")).alias("template"))
    whole = F.struct("w.main", "w.decided", "w.hint", F.coalesce("template", F.array().cast("array<long>")).alias("template"))
    return merged.join(totals, "host", "left_semi").join(listed, "host", "left").select("host", F.to_json(whole).alias("wrapper"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""
    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    learned = materialize(wrappers(plain), "wrappers")
    met = plain.withColumn("host", host_of(F.col("url"))).join(learned, "host", "left").select("page_id", "url", "html", "wrapper")

    def rows(batches):
        for batch in batches:
            for at in range(0, len(batch), 512):
                some = batch.slice(at, 512)
                texts = [main_text(h.as_py(), w.as_py()) for h, w in zip(some.column(2), some.column(3), strict=True)]
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return met.mapInArrow(rows, "page_id long, url string, text string, n_chars long")
