"""Main text of web pages by wrappers inferred from pages of the same host.

A page is a stream of tokens: tags of block elements and texts. A wrapper is such a stream too, a regular expression without
unions whose elements and groups may be optional or repeated. Streams of one host are aligned token by token. Where two texts differ,
a slot is made. Where tags don't match, what stands there is tried as one more repetition of what was passed last; if it is none, the
element that the other stream has further on shows what is optional. Pages are aligned in the task that reads
them, then wrappers with wrappers in two levels, so a host's number of pages never meets in one task.
Every page goes through its host's wrapper: constants go, and the article is the article element if it holds at least half of what
is left, else the innermost container of all slot text.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from bisect import bisect_left
from html import unescape

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terminus.llm.common import batch, materialize, sliced

#: Hosts that a task merges at a time; wrappers that one task of the first level gets of a host, on average.
HOSTS, SALTS = 2000, 16
#: Levels of a wrapper; text that stands deeper belongs to the last level.
LEVELS = 60
#: Elements that open a block of their own.
BLOCKS = frozenset("html head body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption address hr details summary fieldset legend nav header footer aside form menu dialog center noscript template iframe svg math canvas object video audio select textarea button".split())
#: Elements whose content is never part of an article.
DROPPED = frozenset("head nav footer aside form menu dialog noscript template iframe svg math canvas object video audio select textarea button script style title".split())
RAW = frozenset("script style title textarea noscript iframe xmp template svg".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
ROOTS = ("article", "main")
#: Words of class, id or role that mark what is not the article.
MARKS = frozenset("ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs sidebar complementary contentinfo cookie cookies consent gdpr notice alert popup modal overlay dialog newsletter subscribe subscription signup share sharing social related recommended recommendations comment comments commentlist disqus respond replies footer header masthead toolbar widget form search login pagination pager hidden".split())
#: Siblings that end an open element of their kind.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 header".split())

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)|[^<]++|<""", re.S)
#: The end tag of an element with raw content, or what is there of it; of those in `CUT` only the tag goes if there is none.
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*+(?:>|\Z)", re.I) for name in RAW}
CUT = frozenset("svg noscript iframe template".split())
ATTRIBUTE = re.compile(r"""([^\s"'>/=][^\s>/=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
#: Words that don't change what a mark beside them in a name says: comment-list is marked, has-sidebar and related-work are not.
PLAIN = frozenset("area bar block bottom box button buttons container inner item items left links list outer page panel post posts right section site top wrap wrapper".split())
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def marks(name: str) -> bool:
    """Whether a class, id or role is a mark, alone or only beside plain words."""
    words = [w.lower() for w in WORD.findall(name)]
    return any(w in MARKS for w in words) and all(w in MARKS or w in PLAIN or len(w) == 1 for w in words)


class Element:
    __slots__ = ("tag", "label", "parent", "kids", "drop", "marked", "inline", "rooted")

    def __init__(self, tag, label, parent, marked=False, inline=False):
        self.tag, self.label, self.parent, self.kids, self.marked, self.inline, self.rooted = tag, label, parent, [], marked, inline, False
        self.drop = tag in DROPPED

    def away(self) -> bool:
        """Whether it, or what it stands in, is not the article."""
        e, root = self, self.root()
        while e is not None:
            if e.drop or e.marked and not e.rooted and not (root and e.tag in HEADINGS):
                return True
            if e.tag == "header" and not root:
                return True
            e = e.parent
        return False

    def root(self) -> bool:
        e = self
        while e is not None and e.tag not in ROOTS:
            e = e.parent
        return e is not None

    def path(self) -> list[str]:
        out, e = [], self
        while e is not None:
            if not e.inline:
                out.append(e.label)
            e = e.parent
        return out[::-1]


def parse(html: str) -> list[tuple[Element, str]]:
    """Text blocks of a page in order, each with the element it stands in; the first element is the page."""
    top = now = Element("", "", None)
    blocks: list[tuple[Element, str]] = []
    text: list[str] = []
    owner = top

    def flush():
        if text:
            line = " ".join(unescape("".join(text)).split())
            text.clear()
            if line:
                blocks.append((owner, line))
                owner.kids.append(line)

    def block(e: Element) -> Element:
        while e.inline and e.parent is not None and not e.marked and not e.drop:
            e = e.parent
        return e

    at, size, absent = 0, len(html), set()
    while at < size:
        m = TOKEN.match(html, at)
        token, at = m[0], m.end()
        if token[0] != "<" or token == "<":
            if (e := block(now)) is not owner:
                flush()
                owner = e
            text.append(token)
            continue
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if m[1] or m[4]:
            e = now
            while e is not None and e.tag != name:
                e = e.parent
            if e is not None and e is not top:
                if not e.inline or e.drop or e.marked:
                    flush()
                now = e.parent
            elif name in BLOCKS:
                flush()
            continue
        if name == "br":
            text.append(" ")
            continue
        if name in RAW and name in DROPPED or name == "xmp":
            if name in BLOCKS:
                flush()
            if name not in absent and not (name == "svg" and token.endswith("/>")):
                if end := RAW_END[name].search(html, at):
                    at = end.end()
                else:
                    absent.add(name)
                    if name not in CUT:
                        at = size
            continue
        if name in VOID:
            if name in BLOCKS:
                flush()
            continue
        rest = m[3] if m[2] else m[6] or ""
        marked, label = False, name
        if rest:
            for a in ATTRIBUTE.finditer(rest):
                key, value = a[1].lower(), a[2] or a[3] or a[4] or ""
                if key == "hidden" or key == "aria-hidden" and value == "true":
                    marked = True
                elif key in ("class", "id", "role"):
                    marked |= any(marks(n) for n in value.split())
                    if key == "class" and value:
                        label = f"{name}.{value.split()[0]}" if value.split() else name
        if name in BLOCKS:
            flush()
            e = now
            while e.inline and e.parent is not None:
                e = e.parent
            if e.tag == "p":
                now = e.parent
            elif name in ENDS:
                hop = e
                while hop is not None and hop.tag not in ENDS[name] and hop.tag not in ("ul", "ol", "dl", "table"):
                    hop = hop.parent
                if hop is not None and hop.tag in ENDS[name]:
                    now = hop.parent
            own = Element(name, label, now, marked and name not in (*ROOTS, "body", "html"))
            now.kids.append(own)
            now = own
            if name in ROOTS:
                while own is not None:
                    own.rooted = True
                    own = own.parent
        elif marked or name in DROPPED:
            flush()
            now = Element(name, label, now, marked, inline=True)
    flush()
    return blocks


# Tokens of a stream: ["<", optional, repeated, label] and [">"] around what an element or a group (label "()") holds; texts are ["#", optional, repeated,
# lowest, highest, characters, lowest and highest page], texts and pages by their hashes: equal bounds are one text, or one page.


def below(e: Element):
    """All text under an element, in order."""
    todo = [e]
    while todo:
        k = todo.pop()
        if isinstance(k, str):
            yield k
        else:
            todo += reversed(k.kids)


def stream(e: Element, level: int = 0, page: int = 0) -> list:
    """The tokens of an element."""
    parts = []
    for k in e.kids if level < LEVELS else below(e):
        if isinstance(k, str):
            h = zlib.crc32(k.encode("utf-8", "surrogatepass"))
            parts.append([["#", 0, 0, h, h, len(k), page, page]])
        else:
            parts.append(stream(k, level + 1, page))
    return around(["<", 0, 0, e.label], fold(parts))


def around(opened: list, parts: list[list]) -> list:
    return [opened, *[t for p in parts for t in p], [">"]]


def inside(tokens: list) -> list[list]:
    """The streams of the texts and elements that stand directly in an element."""
    out, depth, start = [], 0, 1
    for at in range(1, len(tokens) - 1):
        depth += {"<": 1, ">": -1, "#": 0}[tokens[at][0]]
        if not depth:
            out.append(tokens[start : at + 1])
            start = at + 1
    return out


def kind(tokens: list):
    """What must be the same for two streams to be aligned: the label; of a group the kinds of what it repeats."""
    first = tokens[0]
    if first[0] == "#":
        return "#"
    return (first[3], *map(kind, inside(tokens))) if first[3] == "()" else "<" + first[3]


def merge(a: list, b: list, repeated: int = 0) -> list:
    """Two streams of one kind as one."""
    x, y = a[0], b[0]
    flags = [x[1] | y[1], x[2] | y[2] | repeated]
    if x[0] == "#":
        return [["#", *flags, min(x[3], y[3]), max(x[4], y[4]), x[5] + y[5], min(x[6], y[6]), max(x[7], y[7])]]
    return around(["<", *flags, x[3]], fold(align(inside(a), inside(b))))


def optional(tokens: list) -> list:
    return [[tokens[0][0], 1, *tokens[0][2:]], *tokens[1:]]


def align(a: list[list], b: list[list]) -> list[list]:
    """What stands in two elements, aligned from the left; a mismatch is resolved where it occurs, so the work grows with the tokens alone."""
    kinds = [kind(x) for x in a], [kind(x) for x in b]
    places: tuple[dict, dict] = ({}, {})
    for own, found in zip(kinds, places):
        for at, k in enumerate(own):
            found.setdefault(k, []).append(at)

    def ahead(side: int, k, at: int) -> float:
        """How far on a stream has the kind."""
        own = places[side].get(k, ())
        n = bisect_left(own, at)
        return own[n] - at if n < len(own) else math.inf

    out, i, j, last = [], 0, 0, None
    while i < len(a) or j < len(b):
        x, y = kinds[0][i] if i < len(a) else None, kinds[1][j] if j < len(b) else None
        if x == y:
            out.append(merge(a[i], b[j]))
            i, j, last = i + 1, j + 1, x
        elif x is not None and x == last:  # one more repetition
            out[-1] = merge(out[-1], a[i], 1)
            i += 1
        elif y is not None and y == last:
            out[-1] = merge(out[-1], b[j], 1)
            j += 1
        elif y is None or x is not None and ahead(0, y, i) <= ahead(1, x, j):  # what the other stream has further on comes after this
            out.append(optional(a[i]))
            i, last = i + 1, x
        else:
            out.append(optional(b[j]))
            j, last = j + 1, y
    return out


def fold(parts: list[list]) -> list[list]:
    """Repeated neighbours, and repeated runs of two to four, as one repeated element or group."""
    out: list = []
    kinds: list = []
    for p in parts:
        if kinds and kinds[-1] == (k := kind(p)):
            out[-1] = merge(out[-1], p, 1)
        else:
            out.append(p)
            kinds.append(kind(p))
    for size in (2, 3, 4):
        i = 0
        while i + 2 * size <= len(out):
            if kinds[i : i + size] == kinds[i + size : i + 2 * size]:
                run, j = out[i : i + size], i + size
                while kinds[j : j + size] == kinds[i : i + size]:
                    run = [merge(x, y) for x, y in zip(run, out[j : j + size])]
                    j += size
                out[i:j] = [around(["<", 0, 1, "()"], run)]
                kinds[i:j] = [kind(out[i])]
            i += 1
    return out


def outline(tokens: list) -> list[tuple]:
    """(label, optional, repeated) of what stands directly in an element."""
    return [(x[0][3] if x[0][0] == "<" else "#", x[0][1], x[0][2]) for x in inside(tokens)]


def rules(wrapper: list) -> dict:
    """What an extraction needs: the innermost container of all slot text, and the paths of constants, which two distinct pages hold at least."""
    container: tuple | None = None
    constant: dict[tuple, bool] = {}
    path: list[str] = []
    for t in wrapper:
        if t[0] == "<":
            path.append(t[3])
        elif t[0] == ">":
            path.pop()
        else:
            own = tuple(p for p in path if p != "()")
            fixed = t[3] == t[4] and t[6] != t[7]
            constant[own] = constant.get(own, True) and fixed
            if not fixed:
                box = own[:-1] if len(own) > 1 else own
                same = [x == y for x, y in zip(container, box)] if container is not None else []
                container = box if container is None else box[: [*same, False].index(False)]
    return {"container": container, "constant": [list(p) for p, c in constant.items() if c]}


def content_stream(html: str) -> list:
    """The tokens of a page without what is marked as no article."""
    blocks = parse(html)
    top = blocks[0][0] if blocks else None
    while top is not None and top.parent is not None:
        top = top.parent

    if top is None:
        return around(["<", 0, 0, ""], [])
    todo = [top]
    while todo:
        e = todo.pop()
        e.kids = [k for k in e.kids if isinstance(k, str) or not k.away()]
        todo += [k for k in e.kids if not isinstance(k, str)]
    return stream(top, page=zlib.crc32("\0".join(t for _, t in blocks).encode("utf-8", "surrogatepass")))


def main_text(html: str | None, rule: dict | None = None) -> str:
    """The article of a page as one line; empty if there is none.

    Constants of the host's wrapper go first, unless the page has nothing else. Of what is left the article elements are the article if they hold half of
    the characters or more, else its container is; teasers beside a longer text don't replace it."""
    blocks = [(e, t) for e, t in parse(html or "") if not e.away()]
    if rule:
        fixed = {tuple(p) for p in rule["constant"]}
        blocks = [(e, t) for e, t in blocks if tuple(e.path()) not in fixed] or blocks
    marked = [t for e, t in blocks if e.root()]
    if marked and 2 * sum(map(len, marked)) >= sum(len(t) for _, t in blocks):
        return " ".join(marked)
    box = list(rule["container"] or ()) if rule else []
    return " ".join([t for e, t in blocks if e.path()[: len(box)] == box] or [t for _, t in blocks])


def _merged(pairs):
    """(host, wrapper) pairs to one wrapper a host, handed on when there are many hosts."""
    schema = pa.schema([("host", pa.string()), ("part", pa.int32()), ("wrapper", pa.string())])
    held: dict[str, list] = {}
    part = TaskContext.get().partitionId()

    def out():
        return batch({"host": list(held), "part": [part] * len(held), "wrapper": [json.dumps(w, separators=(",", ":")) for w in held.values()]}, schema)

    for host, w in pairs:
        if host not in held and len(held) >= HOSTS:  # where rows come by host, all of a host's are together
            yield out()
            held.clear()
        held[host] = merge(held[host], w) if host in held else w
    if held:
        yield out()


def _infer(batches):
    yield from _merged((h, content_stream(t)) for x in sliced(batches) for h, t in zip(x.column(0).to_pylist(), x.column(1).to_pylist()) if t)


def _join(batches):
    yield from _merged((h, json.loads(w)) for x in sliced(batches) for h, w in zip(x.column(0).to_pylist(), x.column(1).to_pylist()))


def _extract(batches):
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])
    known: dict[str, dict] = {}
    for x in sliced(batches):
        out = []
        for html, w in zip(x.column(2).to_pylist(), x.column(3).to_pylist()):
            if w and w not in known:
                if len(known) > HOSTS:
                    known.clear()
                known[w] = rules(json.loads(w))
            out.append(main_text(html, known.get(w)))
        yield batch({"page_id": x.column(0), "url": x.column(1), "text": out, "n_chars": list(map(len, out))}, schema)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    Null and empty html has empty text. Pages without url form a host of their own. A repeated page is extracted each
    time; markup cut off in a tag, comment or script loses only that. Pages of a host that marks no article and has one
    page give all that isn't marked as something else. An empty table gives an empty result; other columns are
    not read. Wrappers go to the pages by a join that adaptive execution can split on a frequent host.
    """
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))
    own = own.withColumn("host", host)
    kind = "host string, part int, wrapper string"
    first = own.select("host", "html").mapInArrow(_infer, kind).withColumn("salt", F.pmod("part", F.lit(SALTS)))
    second = first.repartition("host", "salt").sortWithinPartitions("host", "part", "wrapper").select("host", "wrapper").mapInArrow(_join, kind)
    third = second.repartition("host").sortWithinPartitions("host", "wrapper").select("host", "wrapper").mapInArrow(_join, kind)
    wrappers = materialize(third.select("host", "wrapper"), "wrappers").dropDuplicates(["host"])
    wrappers = materialize(wrappers, "hosts")
    return own.join(wrappers, "host", "left").select("page_id", "url", "html", "wrapper").mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
