"""HTML extraction by wrappers: union-free regular expressions per host (operator 10).

A page is a stream of block tags and text slots; runs that repeat are folded into
repeated groups. The pages of a host are aligned one distinct stream after the
other: what matches stays, what doesn't becomes optional, what repeats becomes
a group, and text that differs is a slot. The wrapper that results says which
slots the host's template has. Each page is then matched against its host's
wrapper. A text that stands at one place of the wrapper on every page that has
the place is the template's own and no slot's value; it takes ``support``
different pages to tell, and copies of one page prove nothing.

The main text is read from the slots of the template's main region: its article,
else its main part, else the container named as content, else the body. What
varies from page to page is told apart by names alone: menus, headers, footers,
sidebars, notices, adverts, forms and comments are never part of it. A page all
of whose text is the template's keeps it.

Distinct streams are counted before they are shuffled, and a host's streams are
aligned in salted groups first, so that no task gets all pages of a host.

Defined cases: null or empty html gives an empty text, a page without a URL has
the empty host. Unclosed and stray tags are closed where HTML implies it; an
unclosed comment reaches to the end. Rows that repeat, null ids and further
columns change nothing: one row comes out for each row in. An empty table gives
no rows.
"""

from __future__ import annotations

import hashlib
import html as _html
import json
import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orilla.llm import workspace

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[A-Za-z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)",
    re.DOTALL,
)
ATTR = re.compile(r"([A-Za-z_:][\w:.-]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
# fixed values: element kinds
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes plaintext".split())
BLOCK = frozenset("address article aside blockquote body br button caption center dd details dialog div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav noscript object ol optgroup option p pre section select summary svg table tbody td template tfoot th thead tr ul".split())
NEVER = frozenset("nav footer aside form script style noscript template button select textarea svg iframe menu dialog object head title fieldset label canvas audio video map datalist".split())
ENDS_P = frozenset("address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SIBLING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "thead": ("tr", "td", "th", "thead", "tbody"), "tbody": ("tr", "td", "th", "thead", "tbody")}
SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "option": ("select",), "thead": ("table",), "tbody": ("table",)}
ASIDE_NAMES = frozenset("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar aside nav navbar navigation menu breadcrumb breadcrumbs footer comment comments disqus reply replies respond cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations widget pagination pager toolbar copyright legal disclaimer masthead topbar bottombar".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
CONTENT_NAMES = frozenset("content main post entry article story articlebody maincontent postbody text".split())
REGIONS = ("article", "main", "named", "body")
SPLIT = re.compile(r"[^a-z0-9]+")


class Element:
    """An open element: its name, sign, and what it says about the text in it."""

    __slots__ = ("name", "sign", "out", "article", "main", "named", "link")

    def __init__(self, name: str, attrs: str, up: Element | None) -> None:
        self.name = name
        names: set[str] = set()
        hidden = False
        role = ""
        if attrs and "=" in attrs or "hidden" in attrs:
            for k, a, b, c in ATTR.findall(attrs):
                k, v = k.lower(), (a or b or c).lower()
                if k in ("class", "id"):
                    names.update(x for x in SPLIT.split(v) if x)
                elif k == "role":
                    role = v.strip()
                elif k == "hidden" or (k == "aria-hidden" and v == "true") or (k == "style" and "display:none" in v.replace(" ", "")):
                    hidden = True
        self.sign = name + "".join("." + x for x in sorted(names)) if name in BLOCK else ""
        inside = up is not None and (up.article or up.main)
        aside = name in NEVER or hidden or role in ASIDE_ROLES or (name == "header" and not inside) or bool(names & ASIDE_NAMES and name not in ("html", "body", "article", "main")) or ("header" in names and not inside and name not in ("html", "body")) or (name == "article" and bool(names & {"comment", "comments", "reply"}))
        self.out = aside or (up is not None and up.out)
        self.article = name == "article" or role == "article" or (up is not None and up.article)
        self.main = name == "main" or role == "main" or (up is not None and up.main)
        self.named = bool(names & CONTENT_NAMES) or (up is not None and up.named)
        self.link = name == "a" or (up is not None and up.link)


def blocks(page: str) -> Iterator[tuple[str, str, Element]]:
    """The page's stream: ("open" or "close", sign, element) of block tags and ("text", text, element)."""
    stack = [Element("", "", None)]
    held: list[str] = []
    at, end = 0, len(page)

    def flush() -> Iterator[tuple[str, str, Element]]:
        if held:
            text = " ".join(_html.unescape("".join(held)).split())
            held.clear()
            told[0] = False
            if text:
                yield "text", text, owner[0]

    owner = [stack[-1]]
    told = [False]

    def add(text: str) -> None:
        if text and not stack[-1].out:
            # blank pieces own nothing; a text belongs to a link only if all of its pieces stand in links
            if not told[0] or (owner[0].link and not stack[-1].link):
                if not told[0]:
                    owner[0] = stack[-1]
                if _html.unescape(text).strip():
                    owner[0], told[0] = stack[-1], True
            held.append(text)

    def pop(to: int) -> Iterator[tuple[str, str, Element]]:
        while len(stack) > to:
            e = stack.pop()
            if e.sign:
                yield from flush()
                yield "close", e.sign, e

    while at < end:
        m = TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        if m["end"] or m["end2"]:
            k = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name), 0)
            if k:
                yield from pop(k)
            elif name in BLOCK:
                yield from flush()
            continue
        attrs = m["attrs"] if m["attrs"] is not None else (m["attrs2"] or "")
        if name in ENDS_P:
            k = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name == "p"), 0)
            if k and not any(e.name in ("button", "table", "td", "object") for e in stack[k:]):
                yield from pop(k)
        if name in SIBLING:
            k = 0
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name in SCOPE[name]:
                    break
                if stack[i].name in SIBLING[name]:
                    k = i
            if k:
                yield from pop(k)
        if name in VOID:
            if name in ("br", "hr"):
                yield from flush()
            continue
        if name in RAW:
            low = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.IGNORECASE).search(page, at)
            at = low.end() if low else end
            continue
        e = Element(name, attrs, stack[-1])
        if e.sign:
            yield from flush()
        if attrs.endswith("/") and name not in BLOCK:
            continue
        stack.append(e)
        if e.sign:
            yield "open", e.sign, e
    yield from flush()
    yield from pop(1)


class Slot(str):
    """A text slot of one page: equal to any other, and the places of its texts on the page."""

    __slots__ = ("at",)

    def __new__(cls, at: tuple[int, ...]) -> Slot:
        self = super().__new__(cls, "#")
        self.at = at
        return self


def _both(a, b):  # noqa: ANN001, ANN202
    """Two equal tokens as one that has the places of both."""
    if isinstance(a, list):
        return [_both(x, y) for x, y in zip(a, b)]
    return Slot(a.at + b.at) if isinstance(a, Slot) and isinstance(b, Slot) else a


def fold(tokens: list) -> list:
    """Neighbouring equal runs become repeated groups: ["+", ...]."""
    out: list = []
    for t in tokens:
        out.append(t)
        changed = True
        while changed:
            changed = False
            for w in range(1, min(12, len(out)) + 1):
                tail = out[-w:]
                before = out[-2 * w : -w] if len(out) >= 2 * w else None
                if before == tail and not (w == 1 and tail[0] == "#"):
                    one = [_both(x, y) for x, y in zip(before, tail)]
                    out[-2 * w :] = [one[0] if w == 1 and isinstance(one[0], list) else ["+", *one]]
                    changed = True
                    break
                group = out[-w - 1] if len(out) > w else None
                if isinstance(group, list) and group[0] == "+" and group[1:] == tail:
                    out[-w - 1 :] = [_both(group, ["+", *tail])]
                    changed = True
                    break
                if w == 1 and tail[0] == "#" and len(out) > 1 and out[-2] == "#":
                    out[-2:] = [_both(out[-2], out[-1])]
                    changed = True
                    break
    return out


def skeleton(page: str) -> list:
    """The page's folded stream of block tags and text slots."""
    return fold([f"<{x}>" if kind == "open" else f"</{x}>" if kind == "close" else "#" for kind, x, _ in blocks(page)])


def marked(page: str) -> tuple[list, list[tuple[str, Element]]]:
    """The same stream, its slots with the places of their texts; and the texts."""
    tokens: list = []
    texts: list[tuple[str, Element]] = []
    for kind, x, e in blocks(page):
        if kind == "text":
            tokens.append(Slot((len(texts),)))
            texts.append((x, e))
        else:
            tokens.append(f"<{x}>" if kind == "open" else f"</{x}>")
    return fold(tokens), texts


def _key(token) -> str:  # noqa: ANN001
    return token if isinstance(token, str) else json.dumps(token)


def _bare(token):  # noqa: ANN001, ANN202
    """A group without its mark of being optional."""
    return token[1] if isinstance(token, list) and token[0] == "?" and len(token) == 2 else token


def align(wrapper: list, stream: list) -> list:
    """The wrapper that covers both: mismatches become optional groups."""
    a, b = [_key(_bare(t)) for t in wrapper], [_key(_bare(t)) for t in stream]
    out: list = []
    for op, i0, i1, j0, j1 in SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
        if op == "equal":
            out += [w if _key(w) == _key(s) or _key(w).startswith('["?"') else s for w, s in zip(wrapper[i0:i1], stream[j0:j1])]
            continue
        for part in (wrapper[i0:i1], stream[j0:j1]):
            out += [t if isinstance(t, list) and t[0] == "?" else ["?", t] for t in part]
    return fold(out)


def infer(streams: list[list]) -> list:
    """One wrapper for all streams, shortest first."""
    order = sorted((json.dumps(s) for s in streams), key=lambda s: (len(s), s))
    wrapper: list = json.loads(order[0]) if order else []
    for s in order[1:]:
        wrapper = align(wrapper, json.loads(s))
    return wrapper


def match(wrapper: list, stream: list) -> list[tuple[int, int]]:
    """(number of the wrapper's slot, number of the stream's slot) of those that match, both in the order of the page."""

    def slots(token) -> int:  # noqa: ANN001
        return sum(map(slots, token)) if isinstance(token, list) else int(token == "#")

    w_at, s_at = [0], [0]
    for at, items in ((w_at, wrapper), (s_at, stream)):
        for t in items:
            at.append(at[-1] + slots(t))
    a, b = [_key(_bare(t)) for t in wrapper], [_key(_bare(t)) for t in stream]
    out = []
    for i, j, n in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks():
        out += zip(range(w_at[i], w_at[i + n]), range(s_at[j], s_at[j + n]))
    return out


def _places(stream: list) -> list[tuple[int, ...]]:
    """The places of the texts of each slot of a marked stream."""
    return [x for t in stream for x in (_places(t) if isinstance(t, list) else [t.at] if isinstance(t, Slot) else [])]


def region(wrapper: list) -> str:
    """The template's main region: the first kind under which the wrapper has a text slot outside asides."""
    found: set[str] = set()
    open_: list[Element] = [Element("", "", None)]

    def visit(items: list) -> None:
        for t in items:
            if isinstance(t, list):
                visit(t[1:])
            elif t == "#":
                e = open_[-1]
                if not e.out:
                    found.update(r for r, yes in zip(REGIONS, (e.article, e.main, e.named, True)) if yes)
            elif t.startswith("</"):
                k = next((i for i in range(len(open_) - 1, 0, -1) if open_[i].sign == t[2:-1]), 0)
                if k:
                    del open_[k:]
            else:
                name, _, names = t[1:-1].partition(".")
                open_.append(Element(name, f'class="{names.replace(".", " ")}"' if names else "", open_[-1]))

    visit(wrapper)
    return next((r for r in REGIONS if r in found), "body")


def within(texts: list[tuple[str, Element]], where: str) -> list[int]:
    """The numbers of the region's texts; a page without that region falls back to the next one."""
    for r in REGIONS[REGIONS.index(where) :]:
        own = [i for i, (_, e) in enumerate(texts) if not e.out and {"article": e.article, "main": e.main, "named": e.named, "body": not e.link}[r]]
        if own:
            return own
    return []


def main_text(page: str | None, where: str) -> str:
    """The text of the region's slots in page order."""
    texts = [(x, e) for kind, x, e in blocks(page or "") if kind == "text"]
    return " ".join(texts[i][0] for i in within(texts, where))


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def host(url):  # noqa: ANN001, ANN201
    """The host part of a URL column."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        seen: Counter[tuple[str, str]] = Counter()
        for h, page in zip(b.column("host").to_pylist(), b.column("html").to_pylist()):
            if page:
                seen[h, json.dumps(skeleton(page))] += 1
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.string()), pa.array(list(seen.values()), pa.int64())], ["host", "stream", "n"])


def _infer(group: pd.DataFrame) -> pd.DataFrame:
    w = infer([json.loads(s) for s in group["stream"]])
    return pd.DataFrame({"host": [group["host"].iloc[0]], "stream": [json.dumps(w)], "n": [int(group["n"].sum())]})


def wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html", salts: int = 64) -> DataFrame:
    """host, wrapper (JSON) and n_pages of every host."""
    own = pages.select(host(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    streams = own.mapInArrow(_streams, "host string, stream string, n long").groupBy("host", "stream").agg(F.sum("n").alias("n"))
    parts = streams.withColumn("salt", F.pmod(F.xxhash64("stream"), F.lit(salts))).groupBy("host", "salt").applyInPandas(_infer, "host string, stream string, n long")
    return parts.groupBy("host").applyInPandas(_infer, "host string, stream string, n long").select("host", F.col("stream").alias("wrapper"), F.col("n").alias("n_pages"))


PARTS = "array<struct<slot:int,digest:long,text:string>>"


def matched(pages: DataFrame, found: DataFrame, id_col: str, url_col: str, html_col: str, broadcast_bytes: int) -> DataFrame:
    """id, url, host, page (a digest of its text) and parts: the region's texts, each with the wrapper's slot or -1."""
    size = found.agg(F.sum(F.length("wrapper"))).first()[0] or 0
    own = pages.select(F.col(id_col), F.col(url_col), host(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    known = found.select("host", "wrapper")
    told = own.join(F.broadcast(known) if size <= broadcast_bytes else known, "host", "left").select(id_col, url_col, "host", "html", "wrapper")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of: dict[str, tuple[list, str]] = {}
        pairs: dict[tuple[str, str], list[tuple[int, int]]] = {}
        for b in batches:
            keys, parts = [], []
            for page, w in zip(b.column("html").to_pylist(), b.column("wrapper").to_pylist()):
                stream, texts = marked(page or "")
                if w is None:
                    w = "[]"
                if w not in of:
                    if len(of) >= 2000:  # what is kept is only a matter of cost
                        of.clear()
                    of[w] = json.loads(w), region(json.loads(w))
                wrapper, where = of[w]
                key = w, json.dumps(stream)
                if key not in pairs:
                    if len(pairs) >= 2000:
                        pairs.clear()
                    pairs[key] = match(wrapper, stream)
                places = _places(stream)
                slot = {i: s for s, k in pairs[key] for i in places[k]}
                got = [(slot.get(i, -1), texts[i][0]) for i in within(texts, where)]
                parts.append([{"slot": s, "digest": _digest(x), "text": x} for s, x in got])
                keys.append(_digest("\0".join(x for _, x in got)))
            kind = pa.list_(pa.struct([("slot", pa.int32()), ("digest", pa.int64()), ("text", pa.string())]))
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(keys, pa.int64()), pa.array(parts, kind)], [id_col, url_col, "host", "page", "parts"])

    kind, link = (pages.schema[c].dataType.simpleString() for c in (id_col, url_col))
    return told.mapInArrow(run, f"`{id_col}` {kind}, `{url_col}` {link}, host string, page long, parts {PARTS}")


def constants(rows: DataFrame, support: int) -> DataFrame:
    """host and own: the (slot, digest) of the texts that all pages of the host have in their slot.

    Pages count once for each different main text.
    """
    pages = rows.select("host", "page", F.array_distinct(F.transform(F.filter("parts", lambda x: x["slot"] >= 0), lambda x: F.struct(x["slot"].alias("slot"), x["digest"].alias("digest")))).alias("own"))
    pages = pages.where(F.size("own") > 0).groupBy("host", "page").agg(F.first("own").alias("own"))
    n_text = pages.select("host", F.explode("own").alias("o")).groupBy("host", "o.slot", "o.digest").agg(F.count("*").alias("n")).where(F.col("n") >= support)
    n_slot = pages.select("host", F.explode(F.array_distinct("own.slot")).alias("slot")).groupBy("host", "slot").agg(F.count("*").alias("n"))
    return n_text.join(n_slot, ["host", "slot", "n"]).groupBy("host").agg(F.collect_list(F.struct("slot", "digest")).alias("own"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", support: int = 3, broadcast_bytes: int = 16_000_000, broadcast_rows: int = 50_000) -> DataFrame:
    """id, url, text, n_chars of every page."""
    found = workspace.materialize(wrappers(pages, url_col, html_col), "wrappers")
    rows = workspace.materialize(matched(pages, found, id_col, url_col, html_col, broadcast_bytes), "matched")
    own = workspace.materialize(constants(rows, support), "constants")
    # hosts without a constant need no row; the others are sent to all executors only if they are few
    few = (own.agg(F.sum(F.size("own"))).first()[0] or 0) <= broadcast_rows
    told = rows.join(F.broadcast(own) if few else own, "host", "left")
    varying = F.when(F.col("own").isNull(), F.col("parts")).otherwise(F.filter("parts", lambda x: ~F.array_contains("own", F.struct(x["slot"].alias("slot"), x["digest"].alias("digest")))))
    left = F.when(F.size(varying) > 0, varying).otherwise(F.col("parts"))
    out = told.select(F.col(id_col), F.col(url_col), F.array_join(F.transform(left, lambda x: x["text"]), " ").alias("text"))
    return out.select(id_col, url_col, "text", F.length("text").cast("long").alias("n_chars"))
