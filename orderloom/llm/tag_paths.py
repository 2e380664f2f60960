"""Main text of web pages by tag-path ratios.

Every text node has a path of block tags from the root. Per path, text length and
punctuation are summed and set against the number of its nodes; both ratios are smoothed
over the order of first appearance, fused, and paths at or above a threshold give the
content nodes. The blocks of the part of the page that holds most of them are given out,
but for what the page itself marks as something else (menus, forms, adverts and so on).
A form, or a class or id, may wrap the article itself: where most content has such a mark
around it, the mark is lifted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from orderloom.llm.common import with_columns

# Elements of HTML by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike"
    " strong sub sup time tt u var wbr br label nobr".split()
)
HIDDEN = frozenset(
    "script style noscript template iframe object svg math canvas audio video select option optgroup button textarea input"
    " head title meta link datalist map dialog".split()
)
APART = frozenset("nav footer aside form menu fieldset".split())
WRAPS = frozenset("form fieldset".split())  # of those, what may stand around a whole page
MAIN = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search form menu menubar alert alertdialog dialog status note toolbar".split()
)
#: Words of a class or an id that name a part which is not the article.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox adslot banner sponsor sponsored sponsors promo promos"
    " promoted promotion nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars side rail header masthead"
    " topbar footer foot bottombar comment comments commentlist disqus reply replies respond response responses reader readers"
    " discussion cookie cookies consent gdpr notice notices alert alerts newsletter subscribe subscription signup login"
    " share sharing social related recommended recommendations widget widgets popup modal overlay search form toolbar"
    " pagination pager disclaimer copyright paywall tracking outbrain taboola".split()
)
#: Of these, words that name such a part only where nothing but a word for a part of a page follows: side-bar, not side-effects.
VAGUE = frozenset(
    "side rail response responses respond search social alert alerts notice notices form discussion reader readers related"
    " recommended copyright tracking popup head header foot top".split()
)
PARTS = frozenset(
    "area articles aside bar block bottom box button buttons card cards col column container content dialog feed field grid group"
    " heading icon icons inner input inside item items left line link links list main media message module news outer page pages"
    " panel part policy post posts reading region right row section slot stories story strip text thread title top unit view"
    " wrap wrapper zone".split()
)
DIGITS = "0123456789"
# An open element of these ends where one of those begins.
CLOSES = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]), "tbody": frozenset(["thead", "tbody", "tr", "td", "th"]), "body": frozenset(["head"]),
}
HOLDERS = frozenset("ul ol dl table tbody thead tfoot tr select".split())
ENDS_P = frozenset(
    "address article aside blockquote center details dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hr li main menu nav ol p pre section table td th tr ul".split()
)
SPACE = re.compile(r"\s+")
WORDS = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")
PUNCTUATION = re.compile(r"[.,;:!?…、。，！？؟،]")
SMOOTH = np.array([0.25, 0.5, 0.25])
DEPTH = 400  # deeper elements join their ancestor at this depth


class Node:
    __slots__ = ("tag", "parent", "depth", "apart", "names", "holds_main", "main")

    def __init__(self, tag: str, parent: Node | None, marked: int, names: tuple[str, ...] = ()) -> None:
        self.tag, self.parent, self.names = tag, parent, names
        self.depth = parent.depth + 1 if parent else 0
        self.apart, self.holds_main = marked, False
        self.main = tag in MAIN


NAMED, SURE = 1, 2  # marks that may be lifted, and those that stay


def named(value: str) -> bool:
    """Whether one of the names in a class or id is that of a part which is not the article."""
    for name in value.split():
        words = [w.lower() for w in WORDS.split(name) if w]
        for k, word in enumerate(words):
            if word in NAMES and (word not in VAGUE or all(w in NAMES or w.rstrip(DIGITS) in PARTS or w.isdigit() for w in words[k + 1 :])):
                return True
    return False


def marked(tag: str, attrs: list[tuple[str, str | None]]) -> int:
    """Whether an element says of itself that it is not part of the article: 0, NAMED or SURE."""
    if tag in HIDDEN or tag in APART and tag not in WRAPS:
        return SURE
    found = NAMED if tag in WRAPS else 0
    for name, value in attrs:
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return SURE
        if not value:
            continue
        if name == "role" and value.strip().lower() in ROLES:
            if tag not in WRAPS or value.strip().lower() != "form":
                return SURE
        if name in ("class", "id") and tag not in ("html", "body") and named(value):
            found = NAMED
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return SURE
    return found


class Reader(HTMLParser):
    """Collects blocks: (element, tag path, text), in page order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.top = Node("", None, 0)
        self.open = [self.top]
        self.blocks: list[tuple[Node, list[str]]] = []
        self.fresh = True

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag in VOID:
            if tag == "br":
                self.text(" ")
            elif tag not in INLINE:
                self.fresh = True
            return
        inline = tag in INLINE
        if not inline:
            self.fresh = True
            if tag in ENDS_P:
                self.end("p", ENDS_P - {"p"})
            if tag in CLOSES:
                for other in CLOSES[tag]:
                    self.end(other, HOLDERS - CLOSES[tag])
        is_marked = marked(tag, attrs)
        if inline and not is_marked or len(self.open) > DEPTH:
            return
        node = Node(tag, self.open[-1], is_marked, tuple(v for a, v in attrs if a == "class" and v) if is_marked else ())
        self.open.append(node)
        if node.main:
            up = node.parent
            while up and not up.holds_main:
                up.holds_main = True
                up = up.parent

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """A declaration that the parser gives up on ends at the next bracket, as browsers have it; the page goes on."""
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:
            return self.rawdata.find(">", i) + 1 or -1

    def end(self, tag: str, until: frozenset[str]) -> None:
        """Close the nearest open `tag`, if none of `until` stands between."""
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                return
            if self.open[k].tag in until:
                return

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            return
        if tag not in INLINE:
            self.fresh = True
        self.end(tag, frozenset(["td", "th", "table"]) - {tag} if tag in ("p", "li", "div", "span") else frozenset())

    def text(self, data: str) -> None:
        node = self.open[-1]
        if self.fresh or not self.blocks or self.blocks[-1][0] is not node:
            self.blocks.append((node, []))
            self.fresh = False
        self.blocks[-1][1].append(data)

    def handle_data(self, data: str) -> None:
        self.text(data)


def ancestors(node: Node | None) -> Iterator[Node]:
    while node:
        yield node
        node = node.parent


def in_header(node: Node) -> bool:
    """In a header: of the page, or of an article and not a heading."""
    chain = list(ancestors(node))
    for k, x in enumerate(chain):
        if x.tag == "header":
            return not any(y.main for y in chain[k + 1 :]) or not any(y.tag in HEADINGS for y in chain[:k])
    return False


def outside(node: Node) -> bool:
    """Marked as something else, by itself or by what holds it; what holds an article isn't."""
    return any(x.apart and not x.holds_main and not x.main for x in ancestors(node)) or in_header(node)


def lift(blocks: list[tuple[Node, str]]) -> None:
    """Take the mark from what wraps the article: the most content, by tag paths, has it as its innermost mark.

    It must hold more than half of what would be left with it, and the first content from the
    headline on, as comments don't; or nine tenths. Alike marked elements beside it go with it.
    """
    def mark(node: Node) -> Node | None:
        return next((x for x in ancestors(node) if x.apart and not x.holds_main and not x.main), None)

    kept = [
        (n, t) for n, t in blocks
        if not in_header(n) and not any(x.apart == SURE and not x.holds_main and not x.main for x in ancestors(n))
    ]
    marks = [mark(n) for n, _ in kept]
    if not any(marks):
        return
    by_id = {id(m): m for m in marks if m}
    groups: dict[int, list[int]] = {}
    for k, m in enumerate(marks):
        groups.setdefault(id(m) if m else 0, []).append(k)
    content: list[int] = []
    held: dict[int, int] = {}
    for name, group in groups.items():  # each by its own ratios, or long comments would hide a short article
        chosen = content_paths([kept[k] for k in group])
        own = [k for k in group if kept[k][0].tag not in HEADINGS and path(kept[k][0]) in chosen]
        held[name] = sum(len(kept[k][1]) for k in own)
        content += own
    free = held.pop(0, 0)
    in_main = any(any(x.main for x in ancestors(kept[k][0])) for k in content if not marks[k])
    most = max(held, key=held.__getitem__)
    wrap, size = by_id[most], held[most]
    if in_main and not any(x.main for x in ancestors(wrap)):
        return
    headline = next((k for k, (n, _) in enumerate(kept) if any(x.tag == "h1" for x in ancestors(n))), None)
    first = headline is not None and next((marks[k] is wrap for k in sorted(content) if k > headline), False)
    if size > 9 * free or first and size > free:
        alike = [x for x in by_id.values() if x.parent is wrap.parent and x.tag == wrap.tag and x.names == wrap.names]
        for x in [*ancestors(wrap), *alike]:
            if x.apart == NAMED:
                x.apart = 0


def smooth(x: np.ndarray) -> np.ndarray:
    if len(x) < 3:
        return x
    return np.convolve(np.concatenate([x[:1], x, x[-1:]]), SMOOTH, "valid")


def path(node: Node) -> tuple[str, ...]:
    return tuple(x.tag for x in ancestors(node))


def content_paths(blocks: list[tuple[Node, str]]) -> set[tuple[str, ...]]:
    """Paths whose fused ratio reaches the threshold: the mean less half a deviation, of all text."""
    paths: dict[tuple[str, ...], list[float]] = {}
    for node, text in blocks:
        sums = paths.setdefault(path(node), [0.0, 0.0, 0.0])
        sums[0] += len(text)
        sums[1] += len(PUNCTUATION.findall(text))
        sums[2] += 1
    if not paths:
        return set()
    length, points, nodes = np.array(list(paths.values())).T
    ratio = smooth(length / nodes), smooth(points / nodes)
    fused = np.sqrt(ratio[0] * (1 + ratio[1]))
    weight = length / length.sum()
    mean = float((weight * fused).sum())
    spread = float(np.sqrt((weight * (fused - mean) ** 2).sum()))
    return {p for p, f in zip(paths, fused, strict=True) if f >= mean - 0.5 * spread - 1e-9}


def whole_markup(html: str) -> str:
    """A page without the comment or tag that its end cuts off."""
    start = html.rfind("<!--")
    if start >= 0 and html.find("-->", start) < 0:
        html = html[:start]
    while (start := html.rfind("<")) >= 0 and html.find(">", start) < 0 and re.match(r"[A-Za-z/!?]", html[start + 1 : start + 2]):
        html = html[:start]
    return html


def extract(html: str | None) -> str:
    """The main text of one page; empty where there is none."""
    if not html:
        return ""
    reader = Reader()
    try:
        reader.feed(whole_markup(html))
        reader.close()
    except (AssertionError, RecursionError):  # what was read so far counts
        pass
    blocks = [(n, SPACE.sub(" ", "".join(t)).strip()) for n, t in reader.blocks]
    blocks = [(n, t) for n, t in blocks if t]
    lift(blocks)
    blocks = [(n, t) for n, t in blocks if not outside(n)]
    chosen = content_paths(blocks)
    content = [n for n, t in blocks if path(n) in chosen]
    if not content:
        return ""
    root = content_root(content, [len(t) for n, t in blocks if path(n) in chosen])
    inside = [(n, t) for n, t in blocks if any(x is root for x in ancestors(n))]
    if root.tag in ("", "html", "body"):  # no element holds the article alone: it goes from its first content to its last
        at = [k for k, (n, _) in enumerate(inside) if path(n) in chosen]
        inside = [(n, t) for k, (n, t) in enumerate(inside) if at[0] <= k <= at[-1] or n.tag in HEADINGS]
    return "\n".join(t for _, t in inside)


def content_root(nodes: list[Node], sizes: list[int]) -> Node:
    """The deepest element with nine tenths of the content; an article or main around it, if any."""
    held: dict[int, int] = {}
    by_id: dict[int, Node] = {}
    for node, size in zip(nodes, sizes, strict=True):
        for x in ancestors(node):
            held[id(x)] = held.get(id(x), 0) + size
            by_id[id(x)] = x
    enough = [by_id[k] for k, n in held.items() if 10 * n >= 9 * sum(sizes)]
    root = max(enough, key=lambda x: x.depth)
    while root.parent and (root.tag in ("p", "li", "ul", "ol", "blockquote", "pre", "td", "tr", "tbody", "table") or root.tag in HEADINGS):
        root = root.parent
    return next((x for x in ancestors(root) if x.main), root)


def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [extract(h) for h in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page, from the whole html; no shuffle.

    White space in a block, line breaks of markup included, becomes one space; blocks are
    joined by a line feed. A null, empty or text-free page has the empty text, an empty table
    gives no rows, rows that repeat are pages of their own. Broken markup is read as far as a
    browser would guess; elements deeper than 400 count as their ancestor there, and a page of any
    length is read as a whole.
    """
    rows = pages.select("page_id", "url", "html")
    return rows.mapInArrow(task, with_columns(rows.drop("html"), "text string, n_chars long"))
