"""Main text of web pages by removal of site templates.

Tasks parse each page into a tree and hash the subtrees of its containers in two ways: with their
text, and as a frame of tags and classes alone (equal neighbours count once). Spark counts on how many
pages of a host each hash occurs. A container, or a paragraph or list item outside the main text, goes if its text
recurs; a container outside the main text goes if its frame does
and it is mostly links, or has less than ``ASIDE`` of the text of the article that holds the main text. Recurring means on ``LEAST`` pages of the host that are not copies of one
another, whatever its size. A page learns which of its own elements recur, so no task holds a list of a host, and pages of a hot host are salted. The
element with the most text of its own and its ancestors stay. An ``article`` or ``main`` and what is in it goes only by recurring text, its
paragraphs and headings never alone.

What HTML or common class names mark as menus, headers, footers, adverts, notices, forms or comments goes on every page, however
rare, but a name or a form alone does not remove the only article, nor what holds most of the page's text.

A NULL html is an empty one and gives an empty text; a NULL url is a host of its own. Unclosed, crossing
and unknown tags are tolerated. Repeated rows are pages of their own, an empty table gives no rows. All
columns stay but ``text``, which is replaced.
"""

from __future__ import annotations

import hashlib
import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.llm.shared import small, written

LEAST, ASIDE = 3, 0.1
PAGES_PER_SALT = 4096

# What elements and names of HTML mean.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol optgroup option p pre section summary table tbody td tfoot "
    "th thead tr ul".split()
)
CONTAINERS = frozenset("aside center details div dl fieldset figure footer form header menu nav ol section table ul".split())
HINTS = frozenset("article main".split())
RAW = frozenset("script style noscript iframe template textarea title xmp svg math object select canvas video audio".split())
#: Of these, what holds no elements: its first end tag ends it, and what has none goes on to the end of the page.
UNPARSED = frozenset("script style".split())
FOREIGN = frozenset("svg math".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NO_TEXT = frozenset("head nav footer aside form button dialog menu label input datalist".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pagination "
    "pager popup promo promotion recommended related reply replies respond responses share sharing sidebar signup social sponsor "
    "sponsored subscribe subscription toolbar topbar widget widgets".split()
)
COMMENTS = frozenset("comment comments disqus reply replies respond responses".split())
HEADS_OF_TEXT = frozenset("article content entry post story".split())
ROLES = frozenset("alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
CLOSED_BY = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
SCOPES = frozenset("article aside body div dl fieldset footer form header html main nav ol section table td th ul".split())

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>?|<[!?][^>]*>?", re.DOTALL
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_SPACE = re.compile(r"\s+")
_HUMP = re.compile(r"([a-z])([A-Z])")


@dataclass
class Node:
    """An element: its children are nodes and texts in page order."""

    tag: str
    parent: Node | None
    names: tuple[str, ...] = ()
    named: bool = False
    only_named: bool = False
    children: list = field(default_factory=list)
    own: int = 0


def _attributes(rest: str) -> dict[str, str]:
    return {k.lower(): html.unescape(v.strip("\"'")) for k, v in _ATTRIBUTE.findall(rest)}


def _node(tag: str, rest: str, parent: Node) -> Node:
    found = _attributes(rest) if rest.strip(" /\n\t") else {}
    labels = _HUMP.sub(r"\1-\2", f"{found.get('class', '')} {found.get('id', '')}").lower()
    words = tuple(re.split(r"[\s_\-]+", labels.strip()))
    sure = (
        (tag in NO_TEXT and tag != "form")
        or found.get("role", "").lower() in ROLES
        or "hidden" in found
        or found.get("aria-hidden", "").lower() == "true"
    )
    named = sure or tag == "form" or not NAMES.isdisjoint(words)
    if tag == "header" or ("header" in words and HEADS_OF_TEXT.isdisjoint(words)):
        above = parent
        while above is not None and above.tag not in ("article", "main"):
            above = above.parent
        named = named or above is None
    return Node(tag, parent, words, named and tag not in ("html", "body", "main"), not sure and tag != "header")


def parsed(page: str) -> Node:
    """The root of the page's tree, without marks that a name alone gives to what holds the page's text."""
    root = _tree(page)
    _unmark(root)
    return root


def _unmark(root: Node) -> None:
    """Take the marks by name (or form) off the elements around the main text.

    These are the ancestors of the longest ``article`` or ``main`` if all of these are in marked elements, and elements
    with most of the page's text, unless an unmarked ``article`` or ``main`` outside has a quarter as much (any, for comments).
    """
    nodes = _below(root)
    if not any(n.named and n.only_named for n in nodes):
        return
    long: dict[int, int] = {}
    for node in nodes:
        sure = node.named and not node.only_named
        long[id(node)] = 0 if sure else sum(len(c.strip()) if isinstance(c, str) else long[id(c)] for c in node.children)
    every = sum(len(c.strip()) for n in nodes for c in n.children if isinstance(c, str))
    heads = [n for n in nodes if n.tag in ("article", "main") and not n.named and long[id(n)]]

    def marked(node: Node | None) -> list[Node]:
        out = []
        while node is not None:
            if node.named:
                out.append(node)
            node = node.parent
        return out

    if heads and all(marked(n) for n in heads):
        around = {id(n): marked(n) for n in heads}
        inside = [n for n in heads if all(m.only_named for m in around[id(n)])]
        for node in around[id(max(inside, key=lambda n: long[id(n)]))] if inside else []:
            node.named = False
    for node in reversed(nodes):
        if node.named and node.only_named and 2 * long[id(node)] > every:
            within = {id(n) for n in _below(node)}
            least = 1 if not COMMENTS.isdisjoint(node.names) else long[id(node)] / 4
            if sum(long[id(n)] for n in heads if id(n) not in within and not marked(n)) < least:
                node.named = False


def _tree(page: str) -> Node:
    root = Node("#root", None)
    top, at = root, 0

    def text(piece: str) -> None:
        if piece:
            top.children.append(html.unescape(piece))

    while at < len(page):
        found = _TOKEN.search(page, at)
        if found is None:
            break
        text(page[at : found.start()])
        at = found.end()
        tag = (found["tag"] or "").lower()
        if not tag:
            continue
        if found["end"]:
            node = top
            while node is not None and node.tag != tag and not (node.tag in SCOPES and tag not in SCOPES):
                node = node.parent
            if node is not None and node.tag == tag:
                top = node.parent
            continue
        if tag in RAW:
            at = _skipped(page, at, tag, found["rest"].endswith("/"))
            continue
        if tag in BLOCKS or tag in CLOSED_BY:
            ends = {"p"} | CLOSED_BY.get(tag, set())
            node = top
            while node.tag not in ends and node.tag not in SCOPES and node.parent is not None:
                node = node.parent
            if node.tag in ends:
                top = node.parent
                if tag == "tr" and top.tag == "tr":
                    top = top.parent
        if tag in VOID:
            top.children.append(Node(tag, top))
            continue
        node = _node(tag, found["rest"], top)
        top.children.append(node)
        if not found["rest"].endswith("/"):
            top = node
    else:
        return root
    text(page[at:])
    return root


def _skipped(page: str, at: int, tag: str, closed: bool) -> int:
    """Where an element without text of the page ends, whose start tag ends at ``at``.

    Elements of the same name may lie in it. One that is closed in its start tag or never ends holds nothing.
    """
    if closed and tag in FOREIGN:
        return at
    edge = re.compile(rf"<(/?){re.escape(tag)}(?=[\s/>])((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>?", re.IGNORECASE)
    if tag in UNPARSED:
        edge = re.compile(rf"<(/){re.escape(tag)}\b[^>]*()>?", re.IGNORECASE)
    depth = 1
    for found in edge.finditer(page, at):
        if found[1]:
            depth -= 1
        elif not (tag in FOREIGN and found[2].endswith("/")):
            depth += 1
        if not depth:
            return found.end()
    if tag in UNPARSED:
        return len(page)
    # an inner element lacks its end: then the first end tag there is will do
    return next((found.end() for found in edge.finditer(page, at) if found[1]), at)


def _below(root: Node) -> list[Node]:
    """All elements, children before their parents."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(c for c in node.children if isinstance(c, Node))
    return out[::-1]


def _hash(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\x1f".join(parts).encode(errors="surrogatepass"), digest_size=8).digest(), "big", signed=True)


def hashes(root: Node) -> dict[int, tuple[int, int]]:
    """For every element (by ``id``) the hash of its subtree with text, and of its frame."""
    out: dict[int, tuple[int, int]] = {}
    for node in _below(root):
        whole, frame = [node.tag, *node.names], [node.tag, *node.names]
        for child in node.children:
            if isinstance(child, Node):
                a, b = out[id(child)]
                whole.append(f"{a:x}")
                if frame[-1] != f"{b:x}":
                    frame.append(f"{b:x}")
            else:
                squeezed = _SPACE.sub(" ", child).strip()
                if squeezed:
                    whole.append(squeezed)
                    if frame[-1] != "#":
                        frame.append("#")
        out[id(node)] = _hash("t", *whole), _hash("f", *frame)
    return out


def main_element(root: Node) -> Node:
    """The unmarked element with the most text of its own."""
    todo, best, most = [root], root, -1
    while todo:
        node = todo.pop()
        if node.named:
            continue
        own = sum(
            len(c.strip()) if isinstance(c, str) else sum(len(x.strip()) for x in c.children if isinstance(x, str))
            for c in node.children
            if isinstance(c, str) or (c.tag not in CONTAINERS and c.tag not in HINTS and not c.named)
        )
        if own > most and (node.tag in CONTAINERS or node.tag in HINTS or node.tag in ("body", "#root", "td")):
            best, most = node, own
        todo.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return best


def _lengths(node: Node) -> tuple[int, int]:
    """The length of the text below, and of its part in links."""
    linked = every = 0
    todo = [(node, False)]
    while todo:
        node, link = todo.pop()
        link = link or node.tag == "a"
        for child in node.children:
            if isinstance(child, Node):
                todo.append((child, link))
            else:
                every += len(child.strip())
                linked += len(child.strip()) if link else 0
    return every, linked


def _tests(root: Node) -> dict[int, tuple[int, ...]]:
    """For every element (by ``id``) that may be template the hashes by which it is, if they recur."""
    found = None
    best = main_element(root)
    kept, inside, hinted = set(), {id(n) for n in _below(best)}, set()
    node, article = best, None
    while node is not None:
        kept.add(id(node))
        article = node if node.tag in HINTS else article
        node = node.parent
    least = _lengths(article)[0] * ASIDE if article is not None else 0
    out: dict[int, tuple[int, ...]] = {}
    todo = [(root, False)]
    while todo:
        node, article = todo.pop()
        if node.named:
            continue
        if node.tag in HINTS:
            article = True
            above = node
            while above is not None and id(above) not in hinted:
                hinted.add(id(above))
                above = above.parent
        elif article:
            hinted.add(id(node))
        if id(node) not in kept:
            if node.tag in CONTAINERS or node.tag in HINTS:
                out[id(node)] = ()
            elif node.tag in ("p", "li") and id(node) not in inside and not article:
                out[id(node)] = ()
        todo.extend((c, article) for c in node.children if isinstance(c, Node))
    if out:
        found = hashes(root)
        for node in _below(root):
            if id(node) in out:
                whole, frame = found[id(node)]
                out[id(node)] = (whole,)
                if node.tag in CONTAINERS and id(node) not in inside and id(node) not in hinted:
                    every, linked = _lengths(node)
                    if 2 * linked >= every or every < least:
                        out[id(node)] = whole, frame
    return out


def candidates(page: str) -> tuple[int, list[int]]:
    """What the page is about, and the distinct hashes by which an element of it may turn out to be template."""
    root = parsed(page)
    return _subject(root), sorted({h for tests in _tests(root).values() for h in tests})


def _subject(root: Node) -> int:
    """A hash of the main text, the longest article and the first headings: copies of a page share it, other pages do not."""
    nodes = _below(root)
    articles = [n for n in nodes if n.tag in HINTS and not n.named]
    heads = [main_element(root), *sorted(articles, key=lambda n: -_lengths(n)[0])[:1], *(n for n in nodes if n.tag in ("h1", "h2"))]
    return _hash(*(_SPACE.sub("", _all_text(n)) for n in heads))


def _all_text(node: Node) -> str:
    out, todo = [], [node]
    while todo:
        node = todo.pop()
        if isinstance(node, str):
            out.append(node)
        elif not node.named:
            todo.extend(reversed(node.children))
    return "".join(out)


def extracted(page: str, template: frozenset[int]) -> str:
    """The blocks of the main text, one per line."""
    root = parsed(page)
    tests = _tests(root) if template else {}
    lines: list[str] = []
    block: list[str] = []

    def close() -> None:
        line = _SPACE.sub(" ", "".join(block)).strip()
        block.clear()
        if line:
            lines.append(line)

    todo: list = [root]
    while todo:
        node = todo.pop()
        if node is None:
            close()
        elif isinstance(node, str):
            block.append(node)
        elif node.tag in ("br", "wbr", "img", "input"):
            block.append(" " if node.tag == "br" else "")
        else:
            if node.named or not template.isdisjoint(tests.get(id(node), ())):
                continue
            if node.tag in BLOCKS:
                close()
                todo.append(None)
            todo.extend(reversed(node.children))
    close()
    return "\n".join(lines)


def _host(url: str):
    found = F.regexp_extract(F.lower(F.col(url)), r"^[a-z][a-z0-9+.\-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)
    return F.coalesce(found, F.lit(""))


def main_text(pages: DataFrame, url: str = "url", body: str = "html") -> DataFrame:
    """Add ``text``: the main text of every page's whole html."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            owner, out, about = [], [], []
            for i, page in enumerate(batch.column(3).to_pylist()):
                subject, found = candidates(page or "")
                owner.extend([i] * len(found))
                out.extend(found)
                about.extend([subject] * len(found))
            at = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i).take(at) for i in range(3)), pa.array(out, pa.int64()), pa.array(about, pa.int64())],
                ["host", "x", "y", "hash", "subject"],
            )

    # equal pages of a url have the same elements, so they may share x and y
    marks = {"_x": F.xxhash64(url, body), "_y": F.xxhash64(F.lit(1), url, body)}
    known = pages.select(_host(url).alias("host"), marks["_x"].alias("x"), marks["_y"].alias("y"), body)
    found = written(known.mapInArrow(hashed, "host string, x long, y long, hash long, subject long"))
    # hot hosts: the pages of an element are dealt over salts, and each salt learns whether the element recurs;
    # copies of a page (mirrors, print views, sessions) share a salt and count once
    salts = max(64, math.ceil(found.count() / PAGES_PER_SALT))
    found = found.withColumn("salt", F.pmod("subject", F.lit(salts)))
    parts = written(found.groupBy("host", "hash", "salt").agg(F.count_distinct("subject").alias("n")))
    recurring = parts.groupBy("host", "hash").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST).select("host", "hash")
    where = parts.select("host", "hash", "salt").join(recurring, ["host", "hash"], "left_semi")
    hits = found.join(where, ["host", "hash", "salt"], "left_semi")
    templates = written(hits.groupBy(F.col("x").alias("_of_x"), F.col("y").alias("_of_y")).agg(F.collect_set("hash").alias("_template")))
    kept = [c for c in pages.columns if c != "text"]

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            columns = [batch.column(i) for i in range(len(kept))]
            bodies, lists = (batch.column(len(kept) + i).to_pylist() for i in range(2))
            texts = [extracted(page or "", frozenset(template or ())) for page, template in zip(bodies, lists, strict=True)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], [*kept, "text"])

    joined = pages.withColumns(marks).join(templates, (F.col("_x") == F.col("_of_x")) & (F.col("_y") == F.col("_of_y")), "left")
    chosen = joined.select(*kept, F.col(body).alias("_body"), "_template")
    schema = T.StructType([*chosen.schema.fields[: len(kept)], T.StructField("text", T.StringType())])
    return chosen.mapInArrow(cleaned, schema)
