"""Main text of web pages, from flat text blocks and a decision tree.

A page is read once as a flat row of blocks: runs of text between block-level tags. A block has its words,
the share of them inside links, the same of its neighbours, whether it is a heading, what kind of container is
nearest around it, by element name or by a word of its class, id or role, the share of the page's words that
the innermost boilerplate container around it holds, and whether content or reader comments are anywhere
around it. A decision tree, grown on the blocks of a few labelled example pages, says which blocks are main
text: so a form around a whole page does not outweigh its article, nor an article within comments the comments.

Defined results: a null or empty page has an empty text; markup cut off at the end of a page is markup; a closing
tag without its opening one is ignored, and an element that is never closed ends with its container; rows
that repeat give equal rows; no rows in, none out.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names and naming habits of the web.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
CONTAINERS = frozenset("article aside body details dialog div dl fieldset figure footer form head header html main menu nav ol section select table ul button label".split())
SILENT = frozenset("script style noscript template textarea svg iframe object math canvas audio video title".split())
#: Silent elements whose content is not markup.
RAW = frozenset("script style textarea title iframe".split())
#: Elements that '/>' closes, as it does whatever is within them.
FOREIGN = frozenset("svg math".split())
BOILERPLATE_TAGS = frozenset("aside dialog footer form head header menu nav fieldset select button label".split())
CONTENT_TAGS = frozenset("article main".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads adbox advert adverts advertisement advertising alert author banner breadcrumb breadcrumbs byline comment comments commentlist complementary contentinfo "
    "consent cookie cookies copyright disclaimer discussion disqus footer form gdpr header login masthead menu meta modal nav navbar navigation "
    "newsletter notice notices notification pager pagination popup promo promoted promotion recommended related replies reply respond responses search share sharing "
    "sidebar sidenav signup social sponsor sponsored subscribe subscription tags teaser toc toolbar topbar warning widget widgets".split()
)
#: What readers write, however it is marked within.
COMMENT_NAMES = frozenset("comment comments commentlist discussion disqus replies reply respond responses".split())
#: Parts of tables and lists that are containers only if they are marked, and what closes them besides their own end.
CELLS = {"td": ("td", "th", "tr"), "th": ("td", "th", "tr"), "li": ("li",)}
CONTENT_NAMES = frozenset("article articlebody content entry main maintext post story text".split())

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    # A quote counts only behind an equals sign; elsewhere it is a character like others.
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>=]++|=(?!\s*[\"']))*+)(?:>|\Z)"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)",
    re.DOTALL,
)
NAMING = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
NAME = re.compile(r"[a-z0-9]+")
SPLIT_NAME = re.compile(r"(?<=[a-z])(?=[A-Z])")

FEATURES = ["words", "density", "words_before", "density_before", "words_after", "density_after", "container", "heading", "share", "content", "comments"]


@dataclass
class Block:
    text: str
    words: int
    linked: int
    #: 1 within main content, -1 within boilerplate, 0 if nothing says so.
    container: int
    heading: bool
    #: Number of the innermost boilerplate container, 0 if there is none, and its share of the page's words.
    within: int = 0
    share: float = 0.0
    #: Whether content, or reader comments, are around it.
    content: bool = False
    comments: bool = False


@dataclass(frozen=True)
class Place:
    """An open container, and what it and those around it say."""

    name: str = ""
    container: int = 0
    within: int = 0
    content: bool = False
    comments: bool = False


def kind_of(name: str, rest: str) -> tuple[int | None, bool]:
    """What an element says of its content, None if nothing, and whether it holds reader comments."""
    parts = set()
    if "=" in rest and name not in ("html", "body"):
        found = " ".join(next(filter(None, m), "") for m in NAMING.findall(rest))
        parts = set(NAME.findall(SPLIT_NAME.sub(" ", found).lower()))
    comments = bool(parts & COMMENT_NAMES)
    if name in BOILERPLATE_TAGS or parts & BOILERPLATE_NAMES:
        return -1, comments
    return (1 if name in CONTENT_TAGS or parts & CONTENT_NAMES else None), comments


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order."""
    found: list[Block] = []
    stack: list[Place] = []
    #: For each boilerplate container the one around it; 0 is none.
    outer = [0]
    pieces: list[tuple[str, bool]] = []
    heading = False
    links = 0
    hidden = False
    nowhere = Place()

    def add(text: str, linked: int, at: Place, heading: bool) -> None:
        if text:
            found.append(Block(text, text.count(" ") + 1, linked, at.container, heading, at.within, 0.0, at.content, at.comments))

    def close() -> None:
        nonlocal pieces
        linked = sum(len(t.split()) for t, in_link in pieces if in_link)
        add(" ".join("".join(t for t, _ in pieces).split()), linked, stack[-1] if stack else nowhere, heading)
        pieces = []

    def opened(name: str, rest: str) -> Place:
        around = stack[-1] if stack else nowhere
        kind, comments = kind_of(name, rest)
        within = around.within
        if kind == -1:
            outer.append(within)
            within = len(outer) - 1
        return Place(name, around.container if kind is None else kind, within, around.content or kind == 1, around.comments or comments)

    def leave(name: str) -> None:
        """Closes the innermost container of a name, and what is open in it."""
        if any(p.name == name for p in stack):
            while stack.pop().name != name:
                pass

    def leave_cell(names: tuple[str, ...]) -> None:
        """Closes a marked cell of the innermost table or list."""
        for p in reversed(stack):
            if p.name in names:
                return leave(p.name)
            if p.name in ("table", "ul", "ol"):
                return None

    at, end = 0, len(page)
    while at < end:
        m = MARKUP.search(page, at)
        stop = m.start() if m else end
        if stop > at and not hidden:
            text = page[at:stop]
            pieces.append((html.unescape(text) if "&" in text else text, links > 0))
        if not m:
            break
        at = m.end()
        name = m["name"] or m["name2"]
        if not name:
            continue
        name = name.lower()
        closing = bool(m["end"] or m["end2"])
        empty = (m["rest"] or "").endswith("/")
        if name in SILENT and not closing and empty and (name in FOREIGN or any(p.name in FOREIGN for p in stack)):
            continue
        if name in SILENT and name not in RAW or hidden and name in CONTAINERS:
            # A silent container and what is in it, up to its end or that of a container around it.
            if not closing and not (empty and name in CONTAINERS):
                if not hidden:
                    close()
                stack.append(Place(name))
                hidden = True
            elif closing and any(p.name == name for p in stack):
                leave(name)
                if hidden and not (hidden := any(p.name in SILENT for p in stack)) and name in CONTAINERS:
                    links, heading = 0, False
            continue
        if hidden and not (name in RAW and not closing):
            continue
        if name == "a":
            links = max(0, links - 1) if closing else 1
            continue
        if name in SILENT and not closing:
            over = re.compile(rf"</{re.escape(name)}\s*(?:>|\Z)", re.IGNORECASE).search(page, at)
            if not hidden:
                close()
            at = over.end() if over else end
            continue
        if name in BLOCK_TAGS or name in CONTAINERS:
            close()
            links = 0
            if len(name) == 2 and name[0] == "h" and name[1].isdigit():
                heading = not closing
            elif name != "br":
                heading = False
        rest = m["rest"] or ""
        if name in CONTAINERS:
            if closing:
                leave(name)
            elif not empty:
                stack.append(opened(name, rest))
        elif name in CELLS or name == "tr":
            leave_cell(CELLS.get(name, CELLS["td"]) if not closing else (name,) if name in CELLS else ("td", "th"))
            if not closing and rest and kind_of(name, rest)[0] == -1:
                stack.append(opened(name, rest))
        elif not closing and name in ("p", "h1", "h2", "h3", "h4", "h5", "h6") and rest and kind_of(name, rest)[0] == -1:
            # A marked block: boilerplate until it closes, or the next one opens.
            over = re.compile(rf"</?{name}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            stop = over.start() if over else end
            add(" ".join(html.unescape(MARKUP.sub(" ", page[at:stop])).split()), 0, opened(name, rest), False)
            at = stop
    close()
    held = [0] * len(outer)
    for b in found:
        held[b.within] += b.words
    total = max(1, sum(held))
    for k in range(len(outer) - 1, 0, -1):
        held[outer[k]] += held[k] if outer[k] else 0
    for b in found:
        b.share = held[b.within] / total if b.within else 0.0
    return found


def features(page: list[Block]) -> np.ndarray:
    """A row of FEATURES for each block."""
    words = np.array([b.words for b in page], float)
    density = np.array([b.linked / b.words for b in page], float)
    table = np.zeros((len(page), len(FEATURES)))
    table[:, 0], table[:, 1] = words, density
    table[1:, 2], table[1:, 3] = words[:-1], density[:-1]
    table[:-1, 4], table[:-1, 5] = words[1:], density[1:]
    table[:, 6] = [b.container for b in page]
    table[:, 7] = [b.heading for b in page]
    table[:, 8] = [b.share for b in page]
    table[:, 9], table[:, 10] = [b.content for b in page], [b.comments for b in page]
    return table


@dataclass
class Tree:
    """Splits: feature, limit and the two children; leaves: feature -1 and the answer in `limit`."""

    feature: list[int] = field(default_factory=list)
    limit: list[float] = field(default_factory=list)
    below: list[int] = field(default_factory=list)
    above: list[int] = field(default_factory=list)

    def answers(self, table: np.ndarray) -> np.ndarray:
        feature, limit = np.array(self.feature), np.array(self.limit)
        below, above = np.array(self.below), np.array(self.above)
        at = np.zeros(len(table), int)
        while (inner := feature[at] >= 0).any():
            rows, nodes = np.flatnonzero(inner), at[inner]
            low = table[rows, feature[nodes]] <= limit[nodes]
            at[rows] = np.where(low, below[nodes], above[nodes])
        return limit[at] >= 0.5


def grow(table: np.ndarray, label: np.ndarray, depth: int = 8) -> Tree:
    """A decision tree by least Gini impurity."""
    tree = Tree()

    def node(rows: np.ndarray, left: int) -> int:
        at = len(tree.feature)
        for part, value in ((tree.feature, -1), (tree.limit, float(label[rows].mean())), (tree.below, -1), (tree.above, -1)):
            part.append(value)
        best = None
        if left and 0 < label[rows].mean() < 1:
            for f in range(table.shape[1]):
                order = rows[np.argsort(table[rows, f], kind="stable")]
                x, y = table[order, f], label[order].astype(float)
                cut = np.flatnonzero(x[1:] > x[:-1]) + 1
                if not len(cut):
                    continue
                ones, n = np.cumsum(y)[cut - 1], len(y)
                p, q = ones / cut, (y.sum() - ones) / (n - cut)
                gini = cut * p * (1 - p) + (n - cut) * q * (1 - q)
                k = gini.argmin()
                if best is None or gini[k] < best[0] - 1e-12:
                    best = (gini[k], f, float(x[cut[k] - 1] + x[cut[k]]) / 2)
        if best:
            _, f, limit = best
            low = table[rows, f] <= limit
            tree.feature[at], tree.limit[at] = f, limit
            tree.below[at] = node(rows[low], left - 1)
            tree.above[at] = node(rows[~low], left - 1)
        return at

    node(np.arange(len(table)), depth)
    return tree


def _prose(words: int) -> str:
    return " ".join(["word"] * words)


#: Labelled example pages: (kept, markup around a block, words, of them in a link), a list per page.
EXAMPLES: list[list[tuple[bool, str, int, int]]] = [
    # A page with sectioning elements.
    [
        (False, "<header>{}</header>", 3, 0), (False, "<header><p>{}</p></header>", 12, 0), (False, "<nav><ul><li>{}</li></ul></nav>", 1, 1), (False, "<nav><ul><li>{}</li></ul></nav>", 2, 2), (False, "<nav>{}</nav>", 9, 0),
        (False, "<div class='ad'>{}</div>", 8, 0), (True, "<article><h1>{}</h1></article>", 7, 0), (True, "<article><p>{}</p></article>", 40, 0), (True, "<article><p>{}</p></article>", 1, 0), (True, "<article><p>{}</p></article>", 90, 3),
        (True, "<article><p>{}</p></article>", 5, 0), (True, "<article><p>{}</p></article>", 4, 4), (False, "<article><div class='ad'>{}</div></article>", 30, 0), (True, "<article><ul><li>{}</li></ul></article>", 6, 0), (True, "<article><ul><li>{}</li></ul></article>", 2, 1), (False, "<article><aside>{}</aside></article>", 25, 0),
        (True, "<article><p>{}</p></article>", 200, 0), (False, "<section class='comments'><p>{}</p></section>", 50, 0), (False, "<section class='comments'><p>{}</p></section>", 3, 0),
        (False, "<section class='comments'><article class='entry'><p>{}</p></article></section>", 40, 0), (False, "<div class='sidebar'><div class='post'>{}</div></div>", 15, 0), (False, "<form>{}</form>", 4, 0), (False, "<footer>{}</footer>", 20, 0), (False, "<footer>{}</footer>", 3, 3),
    ],
    # A page whose containers are only named.
    [
        (False, "<div class='cookie-notice'>{}</div>", 30, 2), (False, "<div id='menu'>{}</div>", 5, 5), (False, "<div class='sidebar'>{}</div>", 60, 0), (True, "<div class='post'><h2>{}</h2></div>", 4, 0), (True, "<div class='post'>{}</div>", 12, 0),
        (True, "<div class='post'><p>{}</p></div>", 70, 12), (True, "<div class='post'><p>{}</p></div>", 3, 0), (False, "<div class='post'><div class='share'>{}</div></div>", 6, 3), (False, "<div id='comments'><p>{}</p></div>", 80, 0), (False, "<div id='comments'><div class='text'>{}</div></div>", 60, 0),
        (False, "<div class='footer'>{}</div>", 15, 1), (False, "<div class='footer'><div class='text'>{}</div></div>", 15, 0),
    ],
    # A page that says nothing of its parts.
    [
        (False, "<div>{}</div>", 1, 1), (False, "<div>{}</div>", 2, 2), (False, "<ul><li>{}</li></ul>", 1, 1), (False, "<ul><li>{}</li></ul>", 3, 3), (True, "<h1>{}</h1>", 6, 0), (True, "<p>{}</p>", 45, 0), (True, "<p>{}</p>", 30, 2), (True, "<p>{}</p>", 4, 0),
        (True, "<p>{}</p>", 60, 5), (True, "<p>{}</p>", 16, 0), (False, "<div>{}</div>", 4, 4), (False, "<div>{}</div>", 12, 12), (False, "<div>{}</div>", 2, 2), (False, "<div>{}</div>", 4, 0),
    ],
    [
        (False, "<td>{}</td>", 2, 2), (False, "<td>{}</td>", 2, 2), (True, "<div>{}</div>", 25, 0), (True, "<div>{}</div>", 120, 0), (True, "<div>{}</div>", 3, 0), (True, "<div>{}</div>", 80, 10), (False, "<div>{}</div>", 20, 16), (False, "<div>{}</div>", 6, 6), (False, "<div>{}</div>", 7, 0),
    ],
]


#: The first pages' parts say what they are wherever they stand, so they are also shuffled and resized.
NAMED_PAGES, VARIANTS = 2, 60
#: Containers that may stand around most of such a page, whatever they are called.
WRAPPERS = ["<form>{}</form>", "<div class='header-and-body'>{}</div>", "<div class='meta-content search'>{}</div>", "<section class='related'>{}</section>"]


def _rendered(parts: list[tuple[bool, str, int, int]], wrapper: str = "{}", outside: int = 0) -> str:
    """The page's markup; its last parts may stand `outside` the wrapper."""
    found = []
    for _, around, words, linked in parts:
        link = f"<a href='/x'>{_prose(linked)}</a> " if linked else ""
        found.append(around.format(link + _prose(words - linked)))
    inside = len(found) - outside
    return "<html><body>" + wrapper.format("".join(found[:inside])) + "".join(found[inside:]) + "</body></html>"


def labelled() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the example pages' blocks."""
    rng = np.random.default_rng(3)
    pages = [(page, _rendered(page)) for page in EXAMPLES]
    for page in EXAMPLES[:NAMED_PAGES]:
        for k in range(VARIANTS):
            parts = [page[i] for i in rng.permutation(len(page))]
            scale = np.exp(rng.uniform(-2, 2, len(parts)))
            parts = [(k, a, max(1, round(n * x)), min(max(1, round(n * x)), round(m * x))) for (k, a, n, m), x in zip(parts, scale, strict=True)]
            wrapper = WRAPPERS[k // 2 % len(WRAPPERS)] if k % 2 else "{}"
            # What stands outside is none of the page's text.
            parts.sort(key=lambda p: not p[0] and p[2] < 10)
            small = sum(not p[0] and p[2] < 10 for p in parts)
            pages.append((parts, _rendered(parts, wrapper, int(rng.integers(0, small + 1)) if k % 2 else 0)))
    tables = [features(blocks(markup)) for _, markup in pages]
    return np.concatenate(tables), np.array([kept for p, _ in pages for kept, *_ in p])


def trained() -> Tree:
    return grow(*labelled())


def main_texts(pages: list[str], tree: Tree) -> list[str]:
    """Main text of every page: its blocks of main text, one space apart."""
    flat = [blocks(p) for p in pages]
    tables = [features(b) for b in flat]
    kept = tree.answers(np.concatenate(tables)) if tables else np.zeros(0, bool)
    texts, at = [], 0
    for own in flat:
        texts.append(" ".join(b.text for b, keep in zip(own, kept[at : at + len(own)], strict=True) if keep))
        at += len(own)
    return texts


def _extracted(batches, tree: Tree):
    for batch in batches:
        pages = [p or "" for p in batch.column("html").to_pylist()]
        texts = [t for i in range(0, len(pages), 500) for t in main_texts(pages[i : i + 500], tree)]
        arrays = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, ["page_id", "url", "text", "n_chars"])


def extracted(pages: DataFrame, tree: Tree | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(partial(_extracted, tree=tree or trained()), "page_id long, url string, text string, n_chars long")


def html_text(spark, sf_dir: str) -> DataFrame:
    """Query: the main text of every page."""
    return extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))
