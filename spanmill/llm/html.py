"""Main text of web pages by inferred wrappers: union-free regular expressions over token streams.

A page is a balanced stream of block tags (with class and id) and texts. Within a page, adjacent
equal groups fold into a repeated group. Streams of one host are then aligned one after another:
what both have stays, what one lacks becomes optional, a group that repeats in one becomes a repeated
group, and texts that differ become slots. The wrapper tells which slots, by their path, hold the
article; each page is read through the wrapper of its host.

Alignment starts in the task that reads the pages, which keeps one wrapper per host for up to HOSTS
hosts at a time, and goes on in rounds that merge up to GROUP of a host's wrappers in one task, until
each host has one: a host with a third of all pages sends a row per task, and no task gets more than
GROUP of them. Wrappers are broadcast only if their summed size is below BROADCAST_BYTES, else pages
are joined by host with salt.

Two limits bear on which repetitions a wrapper shows, never on which text is read: a repeated group has
at most FOLD_ITEMS items a time and FOLD_ELEMENTS elements. Texts count as a site's own from FEW pages
on, and a host of fewer pages is read by elements and names.

Cases: null html is empty and gives an empty text; a null or odd URL counts as a host without a
name; unclosed and truncated markup is closed where its parent ends; repeated rows give repeated
results; an empty table gives an empty result; extra columns are ignored; long pages are kept whole.
A <br> is white space in its block.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from html import unescape
from operator import add
from zlib import crc32

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, read

BROADCAST_BYTES = 32 << 20
SALTS = 64
HOSTS, GROUP = 1000, 64
FOLD_ITEMS, FOLD_ELEMENTS, FEW = 48, 3, 3
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>script|style|noscript|template|svg|iframe|object|textarea|select|button|title|canvas|math|video|audio)\b(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>(?:(?<=/>)|.*?(?:</(?P=raw)\s*>|\Z))"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_ATTR = re.compile(r"\b(class|id|role|itemprop|hidden|style|aria-hidden)\b\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.IGNORECASE)
_SPACE = re.compile(r"\s+")
#: Elements that begin and end a block. Others are inline, and void ones have no end.
BLOCKS = frozenset(
    "html head body main article section header footer nav aside div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption "
    "blockquote pre figure figcaption form fieldset legend address details summary dialog menu hgroup center label option".split()
)
VOID = frozenset("br hr img input meta link area base col embed source track wbr".split())
_CLOSED_BY_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Signs of what is not the article: elements, and words of class, id and role.
NOT_MAIN = frozenset("head nav aside footer form fieldset dialog menu label option".split())
_NOT_MAIN_WORDS = re.compile(
    r"^(?:nav|navbar|navigation|menu|menubar|header|masthead|topbar|banner|footer|bottom|sidebar|side|aside|complementary|contentinfo|rail|ads?|advert\w*|adsense|promo\w*|sponsor\w*|"
    r"cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|subscri\w*|signup|login|search|share|sharing|social|related|recommend\w*|trending|"
    r"breadcrumbs?|pagination|pager|comments?|commentlist|disqus|replies|reply|respond|responses|discussion|widget\w*|toolbar|toc|hidden|copyright|legal|disclaimer)$"
)
_MAIN_WORDS = re.compile(r"^(?:article|articlebody|main|content|post|entry|story|body|text|maincontent|postcontent|entrycontent)$")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@lru_cache(maxsize=10_000)
def _symbol(name: str, attrs: str) -> tuple[str, bool]:
    """A tag's symbol, and whether it is hidden. attrs is its raw text."""
    found = {a.lower(): (b or c or d or "") for a, b, c, d in _ATTR.findall(attrs)} if attrs.strip(" /") else {}
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
    words = " ".join(found[k] for k in ("class", "id", "role", "itemprop") if found.get(k))
    return name + (f".{'.'.join(words.split())}" if words else ""), hidden


def stream(html: str) -> list[tuple[str, str]]:
    """Tokens: ("<sym>", ""), ("</", "") and ("#", text), balanced. Texts are decoded, white space is one space."""
    out: list[tuple[str, str]] = []
    stack: list[str] = []
    skipped = [0]  # depth at which a hidden element began, 0 if none
    held: list[str] = []
    at = 0

    def flush() -> None:
        text = _SPACE.sub(" ", unescape("".join(held))).strip()
        held.clear()
        if text and not skipped[0]:
            out.append(("#", text))

    def pop() -> None:
        flush()
        if not skipped[0]:
            out.append(("</", ""))
        if skipped[0] == len(stack):
            skipped[0] = 0
        stack.pop()

    for m in _TAG.finditer(html):
        if m.start() > at:
            held.append(html[at : m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            if m["cdata"]:
                held.append(m["cdata"])
            continue
        name = name.lower()
        if name in VOID or name not in BLOCKS:
            if name in ("br", "hr", "img"):
                held.append(" ")
            continue
        if m["close"]:
            if name in stack:
                while stack[-1] != name:
                    pop()
                pop()
            continue
        ends = _CLOSED_BY_SAME.get(name)
        if stack and stack[-1] == "p":
            pop()
        elif ends and stack and stack[-1] in ends:
            pop()
            if name == "tr" and stack and stack[-1] == "tr":
                pop()
        flush()
        symbol, hidden = _symbol(name, m["attrs"])
        stack.append(name)
        if not skipped[0]:
            if hidden:
                skipped[0] = len(stack)
                out.append(("<" + name + ".hidden>", ""))
                out.append(("</", ""))
            else:
                out.append((f"<{symbol}>", ""))
    if at < len(html):
        held.append(html[at:])
    while stack:
        if skipped[0] == len(stack):
            flush()
            skipped[0] = 0
            stack.pop()
        else:
            pop()
    flush()
    return out


# A wrapper is a list of items [key, optional, body]: a tag's key is its symbol; a text's is "#" with body [path, literal or None, characters, pages],
# where pages, on which it stands, is a lower bound once a group repeats within a page;
# a repeated group's is "+" with the key of its first item, and its body is a list of items.


def items_of(tokens: list[tuple[str, str]]) -> list:
    """A page's own wrapper: every text a literal, adjacent equal groups folded."""
    path: list[str] = []
    out: list = []
    for kind, text in tokens:
        if kind == "#":
            out.append(["#", False, ["/".join(path), crc32(text.encode()), len(text), 1]])
        elif kind == "</":
            path.pop()
            out.append([kind, False, None])
        else:
            path.append(kind[1:-1])
            out.append([kind, False, None])
        _fold_end(out)
    return out


def _keys(items: list) -> list[str]:
    return [i[0] for i in items if i[0] != "#"]


def _fold_end(out: list, longest: int = FOLD_ITEMS) -> None:
    """Fold the end of out if it repeats what stands before it, either a repeated group or its equal."""
    if out[-1][0] != "</":
        return
    depth, k = 0, len(out) - 1  # the element that ends here, and up to FOLD_ELEMENTS together
    for _ in range(FOLD_ELEMENTS):
        while k >= 0:
            key = out[k][0]
            depth += (key == "</") - (key[0] == "<" and key != "</")
            if depth == 0 and key != "#":
                break
            k -= 1
        if k <= 0 or len(out) - k > longest or out[k][0] in ("</", "#"):
            return
        body, first = out[k:], out[k][0]
        before = out[k - 1]
        if before[0] == "+" + first and _keys(before[2]) == _keys(body):
            before[2] = merge(before[2], body, max)
            del out[k:]
            return
        n = len(body)
        if k >= n and out[k - n][0] == first and _keys(out[k - n : k]) == _keys(body):
            group = ["+" + first, False, merge(out[k - n : k], body, max)]
            del out[k - n :]
            out.append(group)
            return
        k -= 1
        if k < 0 or out[k][0] != "</":
            return


def _same(a: list, b: list) -> bool:
    """Whether two items align: equal keys, and for texts equal paths."""
    return a[0] == b[0] and (a[0] != "#" or a[2][0] == b[2][0])


def _merge_item(a: list, b: list, pages: Callable[[int, int], int]) -> list:
    optional = a[1] or b[1]
    if a[0] == "#":
        p, q = a[2], b[2]
        return ["#", optional, [p[0], p[1] if p[1] == q[1] else None, p[2] + q[2], pages(p[3], q[3])]]
    return [a[0], optional, merge(a[2], b[2], pages) if a[0][0] == "+" else None]


def _lifted(items: list, other: list) -> list:
    """items with each occurrence of a group that repeats in other made a repeated group."""
    out = items
    for group in (i for i in other if i[0][0] == "+"):
        keys, first = _keys(group[2]), group[0][1:]
        k, new = 0, []
        while k < len(out):
            end, found = k, []
            while out[k][0] == first and end < len(out) and len(found) < len(keys):
                if out[end][0] != "#":
                    found.append(out[end][0])
                end += 1
            if found == keys:
                if new and new[-1][0] == group[0]:
                    new[-1] = [group[0], new[-1][1], merge(new[-1][2], out[k:end], max)]
                else:
                    new.append([group[0], False, out[k:end]])
                k = end
            else:
                new.append(out[k])
                k += 1
        out = new
    return out


def merge(a: list, b: list, pages: Callable[[int, int], int] = add) -> list:
    """The union-free expression that covers both: a longest common subsequence, the rest optional.

    pages: add for streams of different pages, max for parts of the same ones.
    """
    if len(a) == len(b) and all(map(_same, a, b)):
        return [_merge_item(x, y, pages) for x, y in zip(a, b)]
    a, b = _lifted(a, b), _lifted(b, a)
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        row, below, item = best[i], best[i + 1], a[i]
        for j in range(m - 1, -1, -1):
            row[j] = below[j + 1] + 1 if _same(item, b[j]) else max(below[j], row[j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and _same(a[i], b[j]):
            out.append(_merge_item(a[i], b[j], pages))
            i, j = i + 1, j + 1
        elif j >= m or i < n and best[i + 1][j] >= best[i][j + 1]:
            out.append([a[i][0], True, a[i][2]])
            i += 1
        else:
            out.append([b[j][0], True, b[j][2]])
            j += 1
    return out


def expression(items: list) -> str:
    """The wrapper as text: (...)+ repeats, (...)? is optional, #PCDATA is a slot, #TEXT a fixed text."""
    out, k = [], 0
    while k < len(items):
        e = k
        while e < len(items) and items[e][1] == items[k][1]:
            e += 1
        part = "".join((f"({expression(i[2])})+" if i[0][0] == "+" else "#PCDATA" if i[0] == "#" and i[2][1] is None else "#TEXT" if i[0] == "#" else i[0]) for i in items[k:e])
        out.append(f"({part})?" if items[k][1] else part)
        k = e
    return "".join(out)


def _texts(items: list, repeated: bool = False) -> Iterator[tuple[list, bool]]:
    """The texts, and whether they stand in a repeated group of containers or list items."""
    for i in items:
        if i[0] == "#":
            yield i[2], repeated
        elif i[0][0] == "+":
            yield from _texts(i[2], repeated or i[0][2:-1].partition(".")[0] in _CONTAINERS)


#: Elements that may hold an article among others, or stand beside one.
_CONTAINERS = frozenset("article section div center ul ol li dl dt dd td address details".split())


#: Elements that are never the article, whatever they hold.
_BESIDE = frozenset("head nav aside footer dialog menu label option".split())


@lru_cache(maxsize=50_000)
def _role(path: str, lifted: frozenset[str] = frozenset()) -> int:
    """-1: beside the article; 4: in an article element; 3: in main; 2: in something named like content; 1: in an article or main that a name puts beside; 0: unknown.

    lifted: paths of elements whose names don't count as a sign against them.
    """
    role, at, inner, beside = 0, "", False, False
    for step in path.split("/"):
        at = f"{at}/{step}" if at else step
        name, *words = step.split(".")
        words = [w.lower() for x in words for w in _WORDS.findall(x)]
        comment = "comment" in " ".join(words)
        main = any(_MAIN_WORDS.match(w) for w in words)
        if name in _BESIDE or name == "header" and role < 2:
            return -1
        if at not in lifted and (name in NOT_MAIN or (name not in ("html", "body", "article", "main") or comment) and any(_NOT_MAIN_WORDS.match(w) for w in words)):
            beside = True
        elif beside and name in ("article", "main") and not comment:
            beside, inner = False, True
        role = max(role, 4 if name == "article" else 3 if name == "main" or main and "main" in words else 2 if main and name != "body" else 0)
    return -1 if beside else 1 if inner else role


@lru_cache(maxsize=50_000)
def _named_beside(path: str, lifted: frozenset[str]) -> str | None:
    """The outermost element whose name puts path beside the article; none if an element like nav does."""
    steps = path.split("/")
    found = ["/".join(steps[: k + 1]) for k in range(len(steps))]
    if _role(path, lifted) >= 0 or _role(path, frozenset(found)) == -1:
        return None
    return next((x for x in found if x not in lifted and _role(x, lifted) == -1), None)


def lifted_names(own: dict[str, int], lifted: frozenset[str] = frozenset()) -> frozenset[str]:
    """Elements named like something beside the article that hold most of the text there is; own: characters by path.

    A name counts only if enough text stands elsewhere: a fiftieth in an article or main element, or a
    tenth. Comments keep their place while anything else is there.
    """
    while True:
        roles = {p: _role(p, lifted) for p in own}
        clean, least = sum(n for p, n in own.items() if roles[p] >= 0), 0.02 if max(roles.values(), default=0) >= 3 else 0.1
        if clean >= least * sum(own.values()):
            return lifted
        held: dict[str, int] = {}
        for p, n in own.items():
            if n and (x := _named_beside(p, lifted)):
                held[x] = held.get(x, 0) + n
        if clean >= least * (clean + sum(held.values())):
            return lifted
        if clean:
            held = {x: n for x, n in held.items() if "comment" not in x.rpartition("/")[2].lower()}
        largest = max(held, key=lambda x: (held[x], x), default="")
        if not held or held[largest] <= clean:
            return lifted
        lifted |= {largest}


def _region(texts: list[list], repeated: dict[str, int], pages: int) -> list[str]:
    """Paths of the region that holds most varying text, without what the wrapper shows to stand beside it.

    From the root down goes the container with most text on all pages, as long as it holds half of it.
    Of the others on the way go those that stand on at least three pages and have no h1, where they
    hold less than half of it and are on fewer than nine of ten pages or consist of repeated containers,
    or hold short texts that are together below a fifth of all.
    """
    held: dict[str, list] = {}  # of a container: characters, occurrences, of repeated containers, most pages, has an h1
    for path, _, n, there in texts:
        at = ""
        for step in path.split("/"):
            at = f"{at}/{step}" if at else step
            x = held.setdefault(at, [0, 0, 0, 0, False])
            x[0], x[1], x[3], x[4] = x[0] + n, x[1] + there, max(x[3], there), x[4] or "/h1" in path
    for path, n in repeated.items():
        at = ""
        for step in path.split("/"):
            at = f"{at}/{step}" if at else step
            if at in held:
                held[at][2] += n
    inside: dict[str, list[str]] = {}
    for at in held:
        inside.setdefault(at.rpartition("/")[0], []).append(at)
    name = lambda at: at.rpartition("/")[2].partition(".")[0]
    beside: set[str] = set()
    at, total = "", sum(t[2] for t in texts)
    while True:
        below = [x for x in inside.get(at, []) if name(x) in _CONTAINERS or name(x) in ("html", "body", "main")]
        weight = {x: held[x][0] * min(1.0, held[x][3] / pages) for x in below}
        best = max(below, key=lambda x: (weight[x], x), default="")
        if not best or name(best) in ("ul", "ol", "dl", "li", "dt", "dd") or 2 * weight[best] < sum(weight.values()) or best not in inside:
            break
        for x in below:
            n, times, again, there, headline = held[x]
            if x != best and there >= FEW and not headline and (2 * n < held[best][0] and (there < 0.9 * pages or 2 * again > n) or 5 * n < total and n < 60 * times):
                beside.add(x)
        at = best
    return sorted({t[0] for t in texts if not any(t[0] == x or t[0].startswith(x + "/") for x in beside)}) if beside else []


#: The share of a page's text that a region of each role must hold to be the article; else the next one is read.
_LEAST = {4: 0.02, 3: 0.02, 2: 0.25, 1: 0.25, 0: 0.0}


def content_of(items: list, pages: int) -> tuple[list[tuple[float, list[str]]], list[tuple[str, int]], list[str]]:
    """Paths whose texts are the article, best-marked regions first, fixed texts that are not, and elements whose names don't count.

    Where no element or name marks a region, the wrapper's structure tells it (see _region). Elements and
    names come first, since who wrote the page set them; structure decides which names count.

    A page's article stands in the first of these regions that holds enough text there. Only where no
    element or name marks a region do fixed texts count as the site's own: those equal on nine of ten
    pages, three at least, given as [path, checksum].
    """
    texts, repeated = [], {}
    for t, again in _texts(items):
        texts.append(t)
        repeated[t[0]] = repeated.get(t[0], 0) + (t[2] if again else 0)
    least = max(FEW, 0.9 * pages)
    own: dict[str, int] = {}
    for t in texts:
        own[t[0]] = own.get(t[0], 0) + (t[2] if t[1] is None or t[3] < least else 0)
    lifted = lifted_names(own)
    roles = {p: _role(p, lifted) for p in own}
    levels = [(_LEAST[r], sorted(p for p, role in roles.items() if role >= r)) for r in (4, 3, 2, 1, 0) if r in roles.values()]
    if pages >= FEW and levels and levels[-1][0] == _LEAST[0]:
        unmarked = [t for t in texts if roles[t[0]] >= 0 and not (t[1] is not None and t[3] >= least)]
        levels[-1:-1] = [(_LEAST[2], region)] if (region := _region(unmarked, repeated, pages)) else []
    plain = [t for t in texts if roles[t[0]] <= 0]
    fixed = sorted({(t[0], t[1]) for t in plain if t[1] is not None and t[3] >= least}) if any(t[1] is None for t in plain) else []
    return levels, fixed, sorted(lifted)


def _host(url) -> str:
    m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


_PARTS = "host string, wrapper string, pages long"


def _rows(own: dict[str, list]) -> pd.DataFrame:
    return pd.DataFrame([(h, json.dumps(w), n) for h, (w, n) in own.items()], columns=["host", "wrapper", "pages"])


def _infer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    own: dict[str, list] = {}
    for frame in batches:
        for url, html in zip(frame["url"].array, frame["html"].array):
            host, items = _host(url), items_of(stream(html or ""))
            if host not in own and len(own) >= HOSTS:
                yield _rows(own)
                own = {}
            own[host] = [merge(own[host][0], items), own[host][1] + 1] if host in own else [items, 1]
    if own:
        yield _rows(own)


def _merged(frame: pd.DataFrame) -> tuple[list, int]:
    wrapper, pages = None, 0
    for text, n in sorted(zip(frame["wrapper"], frame["pages"])):
        items = json.loads(text)
        wrapper, pages = items if wrapper is None else merge(wrapper, items), pages + int(n)
    return wrapper, pages


def _joined(frame: pd.DataFrame) -> pd.DataFrame:
    return _rows({frame["host"].iloc[0]: list(_merged(frame))})


def _combine(frame: pd.DataFrame) -> pd.DataFrame:
    wrapper, pages = _merged(frame)
    return pd.DataFrame([(frame["host"].iloc[0], expression(wrapper), pages, json.dumps(content_of(wrapper, pages)))], columns=["host", "wrapper", "pages", "content"])


def infer_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """host, wrapper (as an expression), pages, content: one row per host."""
    parts = materialize(pages.select(F.col(url_col).alias("url"), F.col(html_col).alias("html")).mapInPandas(_infer, _PARTS), "wrapper-parts")
    while True:
        per = parts.groupBy("host").agg(F.count("*").alias("_n"))
        if (per.agg(F.max("_n")).first()[0] or 0) <= GROUP:
            break
        numbered = parts.withColumn("_id", F.monotonically_increasing_id())  # of stored rows, so equal ones part too
        dealt = numbered.join(per, "host").withColumn("_salt", F.pmod(F.xxhash64("_id"), F.ceil(2 * F.col("_n") / GROUP))).drop("_id")
        parts = materialize(dealt.groupBy("host", "_salt").applyInPandas(_joined, _PARTS), "wrapper-parts")
    return parts.groupBy("host").applyInPandas(_combine, "host string, wrapper string, pages long, content string")


@lru_cache(maxsize=20_000)
def _loaded(content: str) -> tuple[list[tuple[float, frozenset]], frozenset, frozenset]:
    levels, fixed, lifted = json.loads(content)
    return [(least, frozenset(paths)) for least, paths in levels], frozenset(map(tuple, fixed)), frozenset(lifted)


def main_text(html: str, content: str) -> str:
    levels, fixed, lifted = _loaded(content)
    path: list[str] = []
    found = []
    for kind, text in stream(html):
        if kind == "#":
            at = "/".join(path)
            if not (fixed and (at, crc32(text.encode())) in fixed):
                found.append((at, text))
        elif kind == "</":
            path.pop()
        else:
            path.append(kind[1:-1])
    own: dict[str, int] = {}
    for p, t in found:
        own[p] = own.get(p, 0) + len(t)
    if more := lifted_names(own, lifted) - lifted:  # a layout of its own
        lifted |= more
        roles = {p: _role(p, lifted) for p in own}
        levels = [(_LEAST[r], frozenset(p for p in own if roles[p] >= r)) for r in (4, 3, 2, 1, 0) if r in roles.values()]
    whole = sum(n for p, n in own.items() if _role(p, lifted) >= 0)
    for least, paths in levels:
        out = [t for p, t in found if p in paths]
        if out and sum(map(len, out)) >= least * whole:
            return "\n".join(out)
    return ""


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in batches:
        texts = [main_text(h or "", c) if h and c else "" for h, c in zip(frame["html"].array, frame["content"].array)]
        out = frame[["url"]].copy()
        out.insert(0, "page_id", frame["page_id"].astype("Int64").array)
        out["text"], out["n_chars"] = texts, [len(t) for t in texts]
        yield out


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars."""
    own = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    wrappers = materialize(infer_wrappers(own), "wrappers").select("host", "pages", "content")
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    hosted = own.withColumn("host", host)
    bytes_there = wrappers.agg(F.coalesce(F.sum(F.length("host") + F.length("content") + 64), F.lit(0))).first()[0]
    if bytes_there <= BROADCAST_BYTES:
        joined = hosted.join(F.broadcast(wrappers), "host", "left")
    else:
        salted = wrappers.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = hosted.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")).join(salted, ["host", "salt"], "left")
    return joined.select("page_id", "url", "html", "content").mapInPandas(_extract, "page_id long, url string, text string, n_chars long")


def op3_inferred_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))
