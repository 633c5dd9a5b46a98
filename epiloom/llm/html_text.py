"""Main text of web pages by composite text density.

A page becomes a DOM. Every node gets its composite density: characters per tag, adjusted by the share of linked
characters and linked tags against the page's own; a node's density sum is that of its children. The subtree with
the largest density sum is the main content. The smallest density on the path from it to the body is the threshold:
other subtrees whose density reaches it also give their largest-sum subtree. A chosen node inside an article or main
element stands for the whole element, so short paragraphs and headings in it stay.

Elements that never hold main text (scripts, forms, navigation, ...) and hidden ones are left out before densities are
computed, and so are elements named as boilerplate by class, id or role, unless they may be a wrapper: one that contains an
article or main element (itself not so named) stays in the DOM, and on pages where no such element has text of its own, one that
contains most of the unlinked characters (elsewhere a long advert or comment list beside a short article would). A
wrapper is left out only inside chosen content, and only if no chosen subtree lies in it.

Time and memory follow the length of a page, also of malformed ones: tags are found with one cursor, and open elements are
looked up by name. A very long page is one row of one task.

Defined results: a NULL or empty page and a page without text have the empty text, an empty table has no rows; malformed
markup never raises: a stray end tag is ignored, open elements close with their parent, numeric references past the last
code point are U+FFFD; of equal density sums the first node in page order wins; repeated pages have equal texts; clashing
input columns are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("body html caption legend option optgroup tbody td tfoot th thead tr summary li dd dt".split())
SIBLINGS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"),
}
LIMITS = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "option": ("select", "datalist")}
#: Elements without main text.
DROPPED = frozenset(
    "script style noscript template iframe object embed applet svg math canvas audio video map nav aside footer form button input select textarea "
    "datalist dialog menu head title link meta noembed noframes xmp".split()
)
#: Words of class, id or role that name boilerplate, and beginnings of such words.
BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement alert banner breadcrumb breadcrumbs byline comment comments commentlist complementary contentinfo cookie cookies copyright "
    "disqus footer form header masthead menu menubar meta modal nav navbar navigation newsletter notice notices overlay pager pagination popup promo promoted related "
    "replies respond search share sharing sidebar sidebars signup skip social sponsor sponsored subscribe tags toolbar tooltip topbar widget widgets".split()
)
STARTS = ("advert", "breadcrumb", "comment", "cookie", "navigation", "newsletter", "sidebar", "sponsor", "subscri")
KEPT = frozenset("html body article main".split())

AFTER_NAME = re.compile(r"[\s/>]")
ENDS_TAG = re.compile("""[>"']""")
ZEROS = re.compile("&#0+(?=[0-9])")
BEYOND = re.compile("&#[0-9]{8,};?")  # numbers past the last code point
NAMED = re.compile(r"""(?:^|[\s"'])(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
WORD = re.compile(r"[a-z0-9]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Ahead:
    """The next place of a pattern, for places asked in rising order; no stretch is searched twice."""

    def __init__(self, pattern: re.Pattern[str], text: str) -> None:
        self.pattern, self.text = pattern, text
        self.since, self.place = 0, -1

    def __call__(self, at: int) -> int:
        """The place at or after ``at``, or the length of the text."""
        if not self.since <= at <= self.place:
            found = self.pattern.search(self.text, at)
            self.since, self.place = at, found.start() if found else len(self.text)
        return self.place


def tokens(html: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """(start, end, is an end tag, name, attributes) of tags; the name of comments and declarations is empty.

    A ``<`` that no ``>`` outside quotes follows is text. The way from a quote or ``>`` to a tag's end depends on that
    place alone, so places from which no end was found are remembered and all scanning is linear in the page. The consumer
    may send the place to go on from."""
    after_name, ends = Ahead(AFTER_NAME, html), Ahead(ENDS_TAG, html)
    endless: set[int] = set()
    last = html.rfind(">")
    at = html.find("<")
    while at >= 0:
        stop = name = at
        sign = html[at + 1 : at + 2]
        if html.startswith("<!--", at):
            stop = html.find("-->", at + 4)
            stop = len(html) if stop < 0 else stop + 3
            name = stop
        elif sign in ("!", "?"):
            if last > at:
                stop = name = html.find(">", at + 2) + 1
        else:
            first = at + 2 if sign == "/" else at + 1
            letter = html[first : first + 1]
            if last > at and letter.isascii() and letter.isalpha():
                name = after_name(first + 1)
                place = ends(name)
                seen = []
                while place <= last and html[place] != ">" and place not in endless:
                    seen.append(place)
                    close = html.find(html[place], place + 1)
                    found = ENDS_TAG.search(html, max(close, place) + 1)
                    place = found.start() if found else len(html)
                if place <= last and html[place] == ">":
                    stop = place + 1
                else:
                    endless.update(seen)
        if stop == at:
            at = html.find("<", at + 1)
            continue
        if name == stop:
            went = yield at, stop, False, "", ""
        else:
            went = yield at, stop, sign == "/", html[first:name].lower(), html[name : stop - 1]
        at = html.find("<", stop if went is None else went)


class Dom:
    """Nodes in page order as parallel lists; text sits between nodes in ``flow``."""

    def __init__(self) -> None:
        self.tag: list[str] = ["#root"]
        self.parent: list[int] = [-1]
        self.last: list[int] = [0]  # last node of the subtree
        self.named: set[int] = set()  # named as boilerplate
        self.flow: list[tuple[int, str]] = []  # (node, text), or (node, "") where a block starts or ends

    def kids(self) -> list[list[int]]:
        out: list[list[int]] = [[] for _ in self.tag]
        for i in range(1, len(self.tag)):
            out[self.parent[i]].append(i)
        return out


def is_boilerplate(tag: str, attributes: str) -> tuple[bool, bool]:
    """(never holds main text or is hidden, is only named as boilerplate)."""
    if tag in DROPPED:
        return True, False
    if not attributes or tag in KEPT and "comment" not in attributes.lower():
        return False, False
    named = False
    for name, a, b, c in NAMED.findall(attributes):
        value = a or b or c
        if name.lower() == "hidden" or name.lower() == "aria-hidden" and value.lower() == "true":
            return True, False
        named = named or any(word in BOILERPLATE or word.startswith(STARTS) for word in WORD.findall(CAMEL.sub(" ", value).lower()))
    return False, named


def parse(html: str) -> Dom:
    """The DOM without boilerplate elements; named wrappers stay, marked."""
    return _without_named(_parsed(html))


def _without_named(dom: Dom) -> Dom:
    """Drops the named elements that are no wrapper of main text."""
    if not dom.named:
        return dom
    n = len(dom.tag)
    in_link, plain, main = [False] * n, [0] * n, [False] * n
    for i in range(1, n):
        in_link[i] = in_link[dom.parent[i]] or dom.tag[i] == "a"
        main[i] = dom.tag[i] in ("article", "main") and i not in dom.named
    for node, text in dom.flow:
        if text and not in_link[node]:
            plain[node] += len("".join(text.split()))
    free = plain[:]  # characters outside named elements below
    for i in range(n - 1, 0, -1):
        plain[dom.parent[i]] += plain[i]
        free[dom.parent[i]] += 0 if i in dom.named else free[i]
        main[dom.parent[i]] |= main[i]
    marked = any(dom.tag[i] in ("article", "main") and i not in dom.named and free[i] for i in range(1, n))
    out = Dom()
    new = [0] * n  # number in the new DOM, or -1
    for i in range(1, n):
        p = dom.parent[i]
        if new[p] < 0 or i in dom.named and not main[i] and (marked or 2 * plain[i] <= plain[0]):
            new[i] = -1
            continue
        new[i] = len(out.tag)
        out.tag.append(dom.tag[i])
        out.parent.append(new[p])
        out.last.append(new[i])
        if i in dom.named:
            out.named.add(new[i])
    for i in range(len(out.tag) - 1, 0, -1):
        out.last[out.parent[i]] = max(out.last[out.parent[i]], out.last[i])
    for node, text in dom.flow:
        if new[node] >= 0:
            out.flow.append((new[node], text))
        elif not text and dom.tag[node] in BLOCK and new[dom.parent[node]] >= 0:  # a dropped block still parts its neighbours
            out.flow.append((new[dom.parent[node]], ""))
    return out


def _parsed(html: str) -> Dom:
    dom = Dom()
    open_: list[int] = [0]
    names_of: list[str] = ["#root"]  # of open_
    depths: dict[str, list[int]] = {}  # of the open elements of each name
    dropping = 0  # depth of open_ from which all is dropped
    at, end = 0, len(html)

    def close_to(depth: int) -> None:
        nonlocal dropping
        while len(open_) > depth:
            node, name = open_.pop(), names_of.pop()
            depths[name].pop()
            gone = bool(dropping)
            if dropping and len(open_) <= dropping:
                dropping = 0
            if not dropping and name in BLOCK:
                dom.flow.append((open_[-1] if gone else node, ""))
            if not gone:
                dom.last[node] = len(dom.tag) - 1

    def deepest(names: tuple[str, ...]) -> int:
        return max((depths[name][-1] for name in names if depths.get(name)), default=0)

    def innermost(names: tuple[str, ...], limits: tuple[str, ...]) -> int:
        depth = deepest(names)
        return depth if depth > deepest(limits) else 0

    def opened(tag: str, attributes: str) -> None:
        nonlocal dropping
        if tag in CLOSES_P:
            depth = innermost(("p",), ("table", "td", "th", "button", "article", "section", "div", "li", "body", "main"))
            if depth:
                close_to(depth)
        if tag in SIBLINGS:
            while depth := innermost(SIBLINGS[tag], LIMITS.get(tag, ("table",))):
                close_to(depth)
        if tag in VOID:
            if not dropping and tag in ("br", "wbr", "hr"):
                dom.flow.append((open_[-1], "" if tag == "hr" else " " if tag == "br" else ""))
            return
        if not dropping:
            never, named = is_boilerplate(tag, attributes)
            if never or (tag == "header" and not deepest(("article", "main"))):
                dropping = len(open_)
                if tag in BLOCK:
                    dom.flow.append((open_[-1], ""))
                node = open_[-1]
            else:
                node = len(dom.tag)
                dom.tag.append(tag)
                dom.parent.append(open_[-1])
                dom.last.append(node)
                if named:
                    dom.named.add(node)
                if tag in BLOCK:
                    dom.flow.append((node, ""))
        else:
            node = open_[-1]
        depths.setdefault(tag, []).append(len(open_))
        open_.append(node)
        names_of.append(tag)

    scan = tokens(html)
    token = next(scan, None)
    while token:
        start, stop, is_end, tag, attributes = token
        if start > at and not dropping:
            dom.flow.append((open_[-1], html[at:start]))
        at = stop
        if tag and is_end:
            depth = deepest((tag,))
            if depth:
                close_to(depth)
        elif tag:
            opened(tag, attributes)
            if tag in RAW and tag not in VOID:
                found = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(html, at)
                at = html.find(">", found.end()) + 1 if found else 0
                at = at or end
                close_to(len(open_) - 1)
        try:
            token = scan.send(at)
        except StopIteration:
            token = None
    if at < end and not dropping:
        dom.flow.append((open_[-1], html[at:]))
    close_to(1)
    dom.last[0] = len(dom.tag) - 1
    return dom


def densities(dom: Dom) -> tuple[list[float], list[float], list[int]]:
    """(composite density, density sum, characters) of every node."""
    n = len(dom.tag)
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    in_link = [False] * n
    for i in range(1, n):
        in_link[i] = in_link[dom.parent[i]] or dom.tag[i] == "a"
    for node, text in dom.flow:
        size = len("".join(text.split()))
        chars[node] += size
        if in_link[node]:
            link_chars[node] += size
    for i in range(n - 1, 0, -1):
        p = dom.parent[i]
        chars[p] += chars[i]
        link_chars[p] += link_chars[i]
        tags[p] += tags[i] + 1
        link_tags[p] += link_tags[i] + (dom.tag[i] == "a")
    body_chars, body_links = max(chars[0], 1), link_chars[0]
    density = [0.0] * n
    for i in range(n):
        c, t, lc, lt = chars[i], max(tags[i], 1), link_chars[i], link_tags[i]
        if c:
            plain = max(c - lc, 1)
            base = log(c / plain * lc + body_links / body_chars * c + e)
            ratio = c / max(lc, 1) * t / max(lt, 1)
            density[i] = max(c / t * log(max(ratio, 1.0000001)) / log(base) if base > 1.0000001 else c / t, 0.0)
    total = [0.0] * n
    for i in range(1, n):
        total[dom.parent[i]] += density[i]
    for i in range(n):
        if total[i] == 0:
            total[i] = density[i]  # a leaf stands for itself
    return density, total, chars


def chosen(dom: Dom) -> tuple[list[int], list[int]]:
    """(content nodes in page order, none inside another; the subtrees they stand for)."""
    density, total, chars = densities(dom)
    n = len(dom.tag)
    if not chars[0]:
        return [], []
    best = max(range(n), key=lambda i: (total[i], -i))
    threshold, node = density[best], best
    while node >= 0:
        threshold = min(threshold, density[node])
        node = dom.parent[node]
    cores, i = [best], 1
    while i < n:  # subtrees off the path that are as dense as the path
        if density[i] >= threshold and not (i <= best <= dom.last[i]):
            cores.append(max(range(i, dom.last[i] + 1), key=lambda j: (total[j], -j)))
            i = dom.last[i] + 1
        else:
            i += 1
    whole = _whole(dom)
    out: list[int] = []
    for i in sorted({whole[c] for c in cores}):
        if not out or i > dom.last[out[-1]]:
            out.append(i)
    return out, cores


def _whole(dom: Dom) -> list[int]:
    """For every node the outermost article or main element around it, else the node."""
    out = [0] * len(dom.tag)
    for i in range(1, len(dom.tag)):
        above = out[dom.parent[i]]
        out[i] = above if dom.tag[above] in ("article", "main") else i
    return out


def main_text(html: str | None) -> str:
    """Blocks in page order, one per line."""
    if not html:
        return ""
    dom = parse(html)
    of = [-1] * len(dom.tag)  # the chosen node around each node
    nodes, cores = chosen(dom)
    for i in nodes:
        of[i : dom.last[i] + 1] = [i] * (dom.last[i] + 1 - i)
    if dom.named:
        around = [False] * len(dom.tag)  # has a chosen subtree
        for i in cores:
            while i >= 0 and not around[i]:
                around[i] = True
                i = dom.parent[i]
        for i in range(1, len(dom.tag)):
            if of[i] >= 0 and of[i] != i and (of[dom.parent[i]] < 0 or i in dom.named and not around[i]):
                of[i] = -1
    blocks: list[str] = []
    own: list[str] = []
    current = -1
    for node, text in dom.flow:
        if own and (not text or of[node] != current):
            blocks.append("".join(own))
            own = []
        current = of[node]
        if text and current >= 0:
            own.append(text)
    if own:
        blocks.append("".join(own))
    clean = (" ".join(_decoded(b).split()) for b in blocks)
    return "\n".join(b for b in clean if b)


def _decoded(text: str) -> str:
    """Character references decoded, with numbers of any length."""
    return unescape(BEYOND.sub("\ufffd", ZEROS.sub("&#", text)))


def extract(pages: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """Adds ``text`` and ``n_chars``; ``keep`` lists the columns to return. One narrow pass."""
    added = [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    kept = [f for f in pages.schema.fields if f.name not in ("text", "n_chars") and (keep is None or f.name in keep)]
    schema = T.StructType(kept + added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts = [main_text(v.as_py()) for v in part.column(part.num_columns - 1)]
                texts = [t.encode("utf-8", "replace").decode() for t in texts]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=schema.names)

    return pages.select(*[f"`{f.name}`" for f in kept], F.col(f"`{html}`").cast("string").alias("__html")).mapInArrow(run, schema)
