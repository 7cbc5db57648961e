"""Main text of web pages from flat text blocks.

A page becomes a flat list of text blocks. Each has its words and link density, those of the blocks beside it, and whether
an element around it is an article or a part such as a menu. A decision tree, trained on a small table of labelled
blocks, keeps the blocks of the article.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import arrow_map, read_table

# Names of the HTML standard, and words that pages use in class, id and role.
RAW = frozenset("script style template noscript textarea select svg math iframe object head title canvas audio video button".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
OUTSIDE = frozenset("nav aside footer form menu dialog search".split())
MAIN = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
OUTSIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promoted promotion banner banners cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup signin login register share sharing social related recommended recommendations recirculation sidebar sidebars aside menu menus nav navbar navigation breadcrumb breadcrumbs footer masthead comment comments commentlist disqus reply replies respond widget widgets toolbar pagination pager copyright legal disclaimer search skip hidden paywall".split()
)
HEADER_WORDS = frozenset("header topbar".split())
MAIN_WORDS = frozenset("article post entry content story main body".split())
#: Words that end a name of a part's piece (comment-list, footer-links), and words that begin a name of what a post is filed under.
PIECE_WORDS = frozenset("area aside bar block body bottom box button buttons card cards column container content form group header icons inner items left links list modal outer panel posts region right row section stories text title top unit wrap wrapper".split())
FILED_WORDS = frozenset("tag category cat type format status topic author".split())
#: A name with one of these says what a page or its article has, not what the element is (has-sidebar, share-enabled).
STATE_WORDS = frozenset("has no with without show hide enabled disabled".split())

_START = re.compile(r"<(?:!--|!\[CDATA\[|[!?]|/?[a-zA-Z])")
_COMMENT_END = re.compile(r"--!?>")
_TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_EDGE = re.compile(r"[>\"']")
_ATTR = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)
_SPLIT = re.compile(r"[^a-z]+")
_HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_CLOSERS = {t: re.compile(rf"</{t}\s*>|</{t}(?=[\s/>])[^>]*(?:>|\Z)|\Z", re.I) for t in RAW}
#: An opening tag of the key ends open elements of the value that lie above the next container.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


@dataclass
class Block:
    text: str
    words: int
    linked: int
    heading: bool
    main: bool
    outside: bool

    @property
    def density(self) -> float:
        return self.linked / self.words if self.words else 0.0


def _names(words: list[str], places: frozenset[str]) -> bool:
    """Whether a name, by its words, is that of a place: it is or ends with one (site-footer), or begins with one and ends with a piece of
    it (comment-list). Names of states (has-sidebar) and of what a post is filed under (tag-search) are none, nor is what only
    begins with a place (comments-open, hidden-gems)."""
    if not words or STATE_WORDS & set(words) or (len(words) > 1 and words[0] in FILED_WORDS):
        return False
    return words[-1] in places or (words[-1] in PIECE_WORDS and bool(places & set(words[:-1])))


def _place(tag: str, attrs: str, in_main: bool) -> tuple[bool, bool]:
    """Whether an element is a part besides the article, and whether it is an article."""
    outside, main = tag in OUTSIDE, tag in MAIN
    if tag == "header" and not in_main:
        outside = True
    if attrs and ("=" in attrs or "hidden" in attrs):
        for name, a, b, c in _ATTR.findall(attrs):
            name, value = name.lower(), a or b or c
            if name in ("class", "id"):
                for words in (_SPLIT.split(n.replace("_", "-")) for n in unescape(value).lower().split()):
                    words = [w for w in words if w]
                    if tag in MAIN and len(words) > 1:  # only a name that is one word tells what an article is
                        continue
                    outside |= _names(words, OUTSIDE_WORDS) or (not in_main and not MAIN_WORDS & set(words) and _names(words, HEADER_WORDS))
            elif name == "role":
                outside |= value.strip().lower() in OUTSIDE_ROLES
                main |= value.strip().lower() in ("main", "article")
            elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and _HIDDEN_STYLE.search(value)):
                outside = True
    if tag in ("html", "body"):
        outside = False
    return outside, main and not outside


def blocks(html: str | None) -> list[Block]:
    """The text blocks of a page in order; a block ends where a block-level element begins or ends."""
    html = html or ""
    out: list[Block] = []
    stack: list[tuple[str, bool, bool]] = []  # tag, outside and main counted from the root
    opened: Counter[str] = Counter()
    outside = main = heading = False
    links = 0
    text: list[str] = []
    link_text: list[str] = []

    def close() -> None:
        if text:
            words = "".join(text).split()
            if words:
                out.append(Block(" ".join(words), len(words), min(len(words), len("".join(link_text).split())), heading, main, outside))
            text.clear()
        link_text.clear()

    def see() -> None:
        nonlocal outside, main, heading
        outside, main = (stack[-1][1], stack[-1][2]) if stack else (False, False)
        heading = any(t in HEADINGS for t, _, _ in stack[-4:])

    def leave(i: int) -> None:
        opened.subtract(t for t, _, _ in stack[i:])
        del stack[i:]
        see()

    def say(s: str) -> None:
        s = unescape(s) if "&" in s else s
        text.append(s)
        if links:
            link_text.append(s)

    at, end = 0, len(html)
    quoted = True  # until quotes turn out not to be closed; each character is looked at a bounded number of times

    def tag_end(k: int) -> int:
        """The place of the > that ends a tag, outside quotes, or -1."""
        nonlocal quoted
        if not quoted:
            return html.find(">", k)
        while True:
            m = _EDGE.search(html, k)
            if m and m[0] == ">":
                return m.start()
            k = html.find(m[0], m.end()) + 1 if m else 0
            if not k:
                quoted = False
                return -1

    while at < end:
        m = _START.search(html, at)
        if not m:
            say(html[at:])
            break
        k = m.start()
        if k > at:
            say(html[at:k])
        if m[0] == "<!--":
            stop = _COMMENT_END.search(html, k + 4)
            at = stop.end() if stop else end
            continue
        if m[0] == "<![CDATA[":
            stop = html.find("]]>", m.end())
            text.append(html[m.end() : end if stop < 0 else stop])
            at = end if stop < 0 else stop + 3
            continue
        stop = html.find(">", k) if m[0] in ("<!", "<?") else tag_end(m.end())
        if stop < 0:  # no tag
            say("<")
            at = k + 1
            if html.find(">", at) < 0:
                say(html[at:])
                break
            continue
        at = stop + 1
        if m[0] in ("<!", "<?"):
            continue
        ends = m[0][1] == "/"
        m = _TAG_NAME.match(html, k + 1 + ends)
        tag, attrs = m[0].lower(), html[m.end() : stop]
        if ends:
            if tag == "a":
                links = max(0, links - 1)
                link_text.append(" ")
            if tag in BLOCK or opened[tag]:
                inside = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None) if opened[tag] else None
                if tag in BLOCK or (inside is not None and (stack[inside][1] != outside or stack[inside][2] != main)):
                    close()
                if inside is not None and (tag in BLOCK or not any(t in BLOCK for t, _, _ in stack[inside + 1 :])):
                    leave(inside)
            continue
        if tag in RAW:
            if not attrs.endswith("/"):
                if tag in ("title", "head"):
                    # a head without an end tag runs to the body
                    stop = re.compile(r"</head\s*>|<body\b|\Z", re.I).search(html, at) if tag == "head" else _CLOSERS[tag].search(html, at)
                    at = stop.start() if stop[0].lower().startswith("<body") else stop.end()
                else:
                    at = _CLOSERS[tag].search(html, at).end()
            continue
        if tag in VOID:
            if tag == "br" or tag == "hr":
                text.append(" ")
                link_text.append(" ")
                if tag == "hr":
                    close()
            continue
        if tag == "a":
            links += 1
        if tag in BLOCK:
            close()
            for i in range(len(stack) - 1, -1, -1):  # end tags that pages leave out
                t = stack[i][0]
                if t == "p" or t in _ENDS.get(tag, ()):
                    leave(i)
                elif t in BLOCK:
                    break
        if attrs.endswith("/") and tag not in BLOCK:
            if tag == "a":
                links -= 1
            continue
        o, x = _place(tag, attrs, main)
        if tag in BLOCK or o:
            if tag not in BLOCK:
                close()
            stack.append((tag, outside or o, main or x))
            opened[tag] += 1
            see()
    close()
    return out


FEATURES = ("words", "density", "words before", "density before", "words after", "density after", "in article", "in another part", "page has article", "heading")

# Blocks labelled by hand. The columns of FEATURES, then 1 for text of the article.
LABELLED = """
12 0 40 0 60 0 1 0 1 1 1
8 0 0 0 45 0 1 0 1 1 1
45 0 8 0 30 0 1 0 1 0 1
30 0.1 45 0 1 0 1 0 1 0 1
1 0 30 0 60 0 1 0 1 0 1
2 0 1 0 1 0 1 0 1 0 1
60 0.3 20 0 5 0 1 0 1 0 1
5 0 60 0 0 0 1 0 1 0 1
4 1 50 0 40 0 1 0 1 0 1
100 0 4 0 8 1 1 0 1 0 1
7 0.9 80 0 80 0 1 0 1 0 1
3 0 90 0 6 1 1 0 1 0 1
1 1 0 0 1 1 0 1 1 0 0
1 1 1 1 1 1 0 1 1 0 0
2 1 1 1 9 0 0 1 1 0 0
9 0 1 1 8 0 0 1 1 0 0
20 0 6 1 8 0 0 1 1 0 0
60 0 30 0 40 0 1 1 1 0 0
15 0.2 80 0 20 0 1 1 1 0 0
3 1 60 0 50 0 1 1 1 0 0
7 0 50 0 0 0 0 1 1 0 0
40 0 70 0 30 0 0 1 1 0 0
5 0 40 0 20 0 0 1 1 1 0
6 0 50 0 45 0 1 1 1 1 0
25 0 0 0 3 1 0 0 1 0 0
4 0 0 0 1 1 0 0 1 1 0
50 0 6 0 20 0 0 0 1 0 0
12 0.5 30 0 0 0 0 0 1 0 0
3 0 90 0 2 1 0 0 1 0 0
70 0 60 0 5 0 0 0 1 0 0
6 1 5 1 10 0 0 0 1 0 0
60 0 10 0 70 0 0 0 0 0 1
35 0 70 0 60 0 0 0 0 0 1
25 0.1 60 0 40 0 0 0 0 0 1
16 0 30 0 50 0 0 0 0 0 1
120 0.2 5 0 6 0 0 0 0 0 1
40 0 2 1 30 0 0 0 0 0 1
8 0 50 0 40 0 0 0 0 0 1
5 0 40 0 60 0 0 0 0 0 1
3 0 45 0 35 0 0 0 0 0 1
2 0 20 0 30 0 0 0 0 0 1
10 0 0 0 50 0 0 0 0 1 1
7 0 4 1 60 0 0 0 0 1 1
12 0 5 1 40 0 0 0 0 1 1
1 0 30 0 25 0 0 0 0 0 1
6 0 70 0 2 0 0 0 0 0 1
2 1 2 1 3 1 0 0 0 0 0
3 1 4 1 50 0 0 0 0 0 0
5 1 60 0 4 1 0 0 0 0 0
1 1 0 0 2 1 0 0 0 0 0
20 0.9 8 1 6 1 0 0 0 0 0
12 0.8 10 0.8 9 1 0 0 0 0 0
4 0 3 1 5 1 0 0 0 0 0
6 0.7 40 0 50 0 0 0 0 0 0
5 0 5 1 4 0 0 0 0 0 0
3 0 4 0 3 1 0 0 0 0 0
8 0 3 1 2 1 0 0 0 0 0
4 0 6 0.9 0 0 0 0 0 0 0
5 0 0 0 3 1 0 0 0 1 0
60 0 60 0 20 0 0 1 0 0 0
80 0 60 0 3 1 0 0 0 0 1
45 0.05 50 0 6 0.9 0 0 0 0 1
30 0 40 0 1 1 0 0 0 0 1
22 0 70 0 12 1 0 0 0 0 1
55 0.1 3 1 2 1 0 0 0 0 1
18 0.2 30 0 4 1 0 0 0 0 1
9 0 3 0 50 0 0 1 0 0 0
2 1 2 1 2 1 0 1 0 0 0
20 0 50 0 0 0 0 1 0 0 0
"""


def labelled() -> tuple[np.ndarray, np.ndarray]:
    """The labelled blocks, and by rule blocks of all lengths beside all kinds of neighbours whose place alone settles the label."""
    rows = [[float(v) for v in line.split()] for line in LABELLED.strip().splitlines()]
    for words in (1, 3, 8, 20, 50, 120):
        for density in (0, 0.2, 1):
            for before, after in (((0, 0), (0, 0)), ((40, 0), (40, 0)), ((1, 1), (1, 1)), ((6, 0), (90, 0)), ((90, 0), (6, 0))):
                around = [words, density, *before, *after]
                rows.append([*around, 1, 0, 1, int(words < 20 and before[0] == 0), 1])  # in the article
                rows.append([*around, 1, 1, 1, 0, 0])  # in another part of the article
                rows.append([*around, 0, 1, int(words % 2), 0, 0])  # in another part of the page
                if words < 50 or density == 1:
                    rows.append([*around, 0, 0, 1, 0, 0])  # beside the article
    table = np.array(rows, float)
    return table[:, :-1], table[:, -1].astype(int)


class DecisionTree:
    """Binary splits that lower the Gini impurity most; ties take the first feature and the lowest limit."""

    def __init__(self, depth: int = 7) -> None:
        self.depth = depth
        self.root: tuple | int = 0

    def fit(self, x: np.ndarray, y: np.ndarray) -> DecisionTree:
        self.root = self._grow(x, y, self.depth)
        return self

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int):
        ones = int(y.sum())
        if not depth or ones in (0, len(y)):
            return int(2 * ones >= len(y))
        best = None
        for j in range(x.shape[1]):
            order = np.argsort(x[:, j], kind="stable")
            v, t = x[order, j], y[order]
            for i in np.flatnonzero(v[1:] > v[:-1]) + 1:
                a, b = t[:i].mean(), t[i:].mean()
                cost = i * a * (1 - a) + (len(t) - i) * b * (1 - b)
                if best is None or cost < best[0] - 1e-12:
                    best = (cost, j, (v[i] + v[i - 1]) / 2)
        if best is None:
            return int(2 * ones >= len(y))
        _, j, limit = best
        low = x[:, j] <= limit
        return j, limit, self._grow(x[low], y[low], depth - 1), self._grow(x[~low], y[~low], depth - 1)

    def __call__(self, row) -> int:
        node = self.root
        while not isinstance(node, int):
            node = node[2] if row[node[0]] <= node[1] else node[3]
        return node


def features(page: list[Block]) -> list[tuple]:
    """Rows of FEATURES, one for each block; the neighbours of a block are those next to it on the page."""
    any_main = any(b.main and not b.outside for b in page)
    out = []
    for i, b in enumerate(page):
        p = page[i - 1] if i else None
        n = page[i + 1] if i + 1 < len(page) else None
        out.append((b.words, b.density, p.words if p else 0, p.density if p else 0.0, n.words if n else 0, n.density if n else 0.0, int(b.main), int(b.outside), int(any_main), int(b.heading)))
    return out


def train_tree() -> DecisionTree:
    return DecisionTree().fit(*labelled())


def main_text(html: str | None, tree: DecisionTree) -> str:
    page = blocks(html)
    return " ".join(b.text for b, row in zip(page, features(page), strict=True) if tree(row))


def extract_pages(pages: DataFrame, tree: DecisionTree | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every row, from the whole html.

    Null, empty and textless pages have an empty text. Repeated rows are extracted each; other columns aren't read.
    """
    tree = tree or train_tree()

    def run(batches):
        for b in batches:
            made = [main_text(h.as_py(), tree) for h in b.column("html")]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(made, pa.string()), pa.array([len(t) for t in made], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    return arrow_map(pages.select("page_id", "url", "html"), run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(read_table(spark, sf_dir, "pages"))
