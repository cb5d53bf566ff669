"""Main text of web pages by wrapper induction.

Trees. A page is parsed into a tree of elements; brothers with the same tag and role
that follow each other are one repeated node, so a tree is small however long its
page. The skeleton of a page is this tree without texts.

Template. A layout is the pages of a host with the same structural elements (``FRAME``) in the same order of first
appearance. Its most frequent skeleton is its reference tree. The skeletons of the
layout's other pages are aligned with it by simple tree matching (the largest number of node
pairs that keeps parents and order), which gives each text a slot: the reference node it
stands in, or a node of its own. A text that fills a slot on most of the layout's pages that fill it at all
is constant: it belongs to the template. Texts that vary are content. Most means that the lower end of the 95 % (Wilson)
interval of its share is above one half, which is one rule for hosts of any size: all of four pages, seven of eight,
just over half of very many. Pages with the same title and first heading (without one, content)
are versions of one page and have one vote, so that copies and edited copies of a page stay whole.

Content is read from the article (or main) elements, else from the body, without
elements of other roles: menus, headers, footers, sidebars, notices, adverts, forms,
comments, scripts and styles, told by tag, role, whole class or id, since such parts may vary from page to page too.
A class, an id or a form never hides the page's main element, nor its articles if none stands elsewhere and they
hold more text than the rest of the page.

Character references are decoded; white space inside a block is one space; blocks follow in page
order, joined by one space. Null, empty and broken html give what can be read, at worst an
empty text. The host is the part of the url between // and the next /, ? or #, without user and port; null urls share a host.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections import Counter, deque
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panewise.llm.common import kept_schema, map_arrow, ship, written

#: Squared normal quantile of the 95 % interval; fewer votes than LEAST_VOTES cannot put its lower end above one half.
Z2, LEAST_VOTES = 3.84, 4
#: Elements whose order of first appearance tells the layouts of a host apart.
FRAME = r"(?i)<(nav|header|main|article|section|aside|form|footer)\b"
#: Reference trees and template texts are broadcast up to this many bytes, else joined by host.
BROADCAST_BYTES = 16 << 20

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SAME_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "thead": ("tbody", "thead"), "tbody": ("tbody", "thead", "tr", "td", "th")}
SCOPES = frozenset("ul ol dl table select article section div body".split())
# Parts of a page that are not its article.
DROP_TAGS = frozenset("head script style noscript template iframe object svg canvas nav footer aside button select textarea dialog menu input".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
DROP_WORDS = frozenset("ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices notification pagination pager popup promo promoted promotion recommended related replies share sharing sidebar site-header skip social sponsor sponsored subscribe toolbar widget".split())
# Known compounds, with hyphens; of other compounds no part counts (has-sidebar, ad-free, social-science).
DROP_COMPOUNDS = frozenset("ad-banner ad-box ad-container ad-slot ad-unit ad-wrapper banner-ad comment-body comment-form comment-list comments-area comments-list comments-section cookie-banner cookie-bar cookie-consent cookie-notice cookie-popup disqus-thread left-sidebar main-menu main-nav main-navigation nav-bar nav-menu newsletter-form newsletter-signup page-footer page-navigation post-navigation post-pagination related-articles related-links related-posts right-sidebar share-bar share-buttons share-links sidebar-left sidebar-right site-footer site-nav site-navigation skip-link skip-to-content social-icons social-links social-media social-share top-nav".split())
DROP_ARTICLES = frozenset("ad advert comment comment-body comments related related-article related-post".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_NUMBER = re.compile(r"-?[0-9]+$")


@lru_cache(20_000)
def role(tag: str, attributes: str) -> str:
    """'-' for a part that is not content, '~' for one by name only (see ``parse``), '*' for the main element, '+' for an article, '' else."""
    words: set[str] = set()
    for name, *values in _ATTRIBUTE.findall(attributes):
        value, name = "".join(values).lower(), name.lower()
        if name == "role":
            if value in DROP_ROLES:
                return "-"
            if value in ("main", "article"):
                return "*" if value == "main" else "+"
        elif name == "hidden" or name == "aria-hidden":
            if name == "hidden" and value in ("", "hidden") or value == "true":
                return "-"
        else:
            for one in value.split():
                words.add(_NUMBER.sub("", one.replace("_", "-")))
    if tag in DROP_TAGS:
        return "-"
    if tag == "main":
        return "*"
    if tag == "article":
        return "-" if words & DROP_ARTICLES else "+"
    if tag in ("html", "body"):
        return ""
    return "~" if tag == "form" or words & DROP_WORDS or words & DROP_COMPOUNDS else ""


class Node:
    __slots__ = ("tag", "role", "children")

    def __init__(self, tag: str, role_: str):
        self.tag, self.role, self.children = tag, role_, []  # children: nodes and strings


def parse(html: str) -> Node:
    """Element tree of a page; unclosed elements end where HTML ends them, unknown end tags are skipped. Roles '~' and '*' are settled."""
    root = Node("#", "")
    stack = [root]
    named: list[Node] = []
    main: list[Node] = []
    holders: dict[int, list[Node]] = {}  # of a named part: the main elements and articles in it
    free = False  # whether one stands outside
    at, size = 0, len(html)
    for_match = _TOKEN.search
    while at < size:
        m = for_match(html, at)
        if m is None:
            _text(stack[-1], html[at:])
            break
        if m.start() > at:
            _text(stack[-1], html[at : m.start()])
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == name:
                    del stack[i:]
                    break
            continue
        if name in CLOSES_P:
            _close(stack, ("p",))
        if name in SAME_CLOSES:
            _close(stack, SAME_CLOSES[name])
        attributes = m[3]
        node = Node(name, role(name, attributes if "=" in attributes or "hidden" in attributes else ""))
        stack[-1].children.append(node)
        if node.role == "~":
            named.append(node)
        elif node.role in ("*", "+"):
            if node.role == "*":
                main.append(node)
            above = [n for n in stack if n.role in ("-", "~")]
            free = free or not above
            if all(n.role == "~" for n in above):
                for n in above:
                    holders.setdefault(id(n), []).append(node)
        if name in VOID or attributes.endswith("/") and name not in INLINE and name not in CLOSES_P:
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\s*>", re.I).search(html, at)
            if name in ("title", "textarea"):
                _text(node, html[at : end.start() if end else size])
            at = end.end() if end else size
            continue
        stack.append(node)
    _settle(root, named, holders, free)
    for node in main:
        node.role = "+"
    return root


def _settle(root: Node, named: list[Node], holders: dict[int, list[Node]], free: bool) -> None:
    """Decide about the parts that only a name marks: '-' unless they hold the main element or the page's articles."""
    mains = {k for k, held in holders.items() if any(n.role == "*" for n in held)}
    if holders and not mains and not free:
        inside = {id(n): n for held in holders.values() for n in held}
        if _text_size(root, ("-",), inside, True) > _text_size(root, ("-", "~"), inside, False):
            mains = set(holders)
    for n in named:
        n.role = "" if id(n) in mains else "-"


def _text_size(root: Node, skipped: tuple[str, ...], articles: dict[int, Node], in_articles: bool) -> int:
    """Letters of the text in the ``articles``, or outside of them, without elements of the roles ``skipped``."""
    size, todo = 0, [(root, False)]
    while todo:
        node, within = todo.pop()
        for c in node.children:
            if isinstance(c, str):
                size += sum(map(len, c.split())) if within == in_articles else 0
            elif c.role not in skipped and c.tag != "title":
                todo.append((c, within or id(c) in articles))
    return size


def _text(node: Node, raw: str) -> None:
    node.children.append(unescape(raw) if "&" in raw else raw)


def _close(stack: list[Node], tags: tuple[str, ...]) -> None:
    """End an open element of ``tags`` unless a containing element stands between."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in tags:
            del stack[i:]
            return
        if stack[i].tag in SCOPES or stack[i].tag not in INLINE:
            return


class Slot:
    """A node of a skeleton: ``label`` and child slots, found by their label."""

    __slots__ = ("label", "children", "at", "no")

    def __init__(self, label: str):
        self.label, self.children, self.at, self.no = label, [], {}, 0

    def fit(self, labels: list[str]) -> list["Slot"]:
        """A child slot for each label, in order; where none is left, one is put in, so the child slots of brothers unite."""
        k, spots = -1, []
        for one in labels:
            at = self.at.get(one, ())
            i = bisect_right(at, k)
            if i == len(at):
                break
            k = at[i]
            spots.append(self.children[k])
        else:
            return spots
        k, out, united = 0, [], []
        for one in labels:
            at = self.at.get(one, ())
            i = bisect_left(at, k)
            if i < len(at):
                united += self.children[k : at[i] + 1]
                k = at[i] + 1
            else:
                united.append(Slot(one))
            out.append(united[-1])
        self.children = united + self.children[k:]
        self.at = {}
        for i, c in enumerate(self.children):
            self.at.setdefault(c.label, []).append(i)
        return out


def elements(node: Node) -> Iterator[Node]:
    """Child elements, through inline ones."""
    todo = [iter(node.children)]
    while todo:
        for c in todo[-1]:
            if isinstance(c, str) or c.tag in VOID:
                continue
            if c.tag in INLINE and not c.role:
                todo.append(iter(c.children))
                break
            yield c
        else:
            todo.pop()


def layout(root: Node) -> tuple[str, dict[int, int]]:
    """The tree without texts, ``tag(role)[children]``, and for each element (by ``id``) the number of its node in it, from 0 in page order.

    Inline elements are left out. Brothers in a row with the same tag and role are one node; its children
    unite theirs, so that the children of each brother have places in order.
    """
    top = Slot(_label(root))
    place, todo = {id(root): top}, deque([root])
    while todo:
        node = todo.popleft()
        runs: list[tuple[str, list[Node]]] = []
        for c in elements(node):
            label = _label(c)
            if not runs or runs[-1][0] != label:
                runs.append((label, []))
            runs[-1][1].append(c)
        for (_, brothers), slot in zip(runs, place[id(node)].fit([label for label, _ in runs]), strict=True):
            for c in brothers:
                place[id(c)] = slot
                if c.role != "-":
                    todo.append(c)

    text: list[str] = []
    left: list[Slot | str] = [top]
    no = 0
    while left:
        one = left.pop()
        if isinstance(one, str):
            text.append(one)
            continue
        one.no, no = no, no + 1
        text.append(one.label + "[")
        left.append("]")
        for i in range(len(one.children) - 1, -1, -1):
            left.append(one.children[i])
            if i:
                left.append(" ")
    return "".join(text), {k: slot.no for k, slot in place.items()}


def _label(node: Node) -> str:
    tag = node.tag
    return (tag.replace("[", "(").replace("]", ")") if "[" in tag or "]" in tag else tag) + node.role


def skeleton(node: Node) -> str:
    return layout(node)[0]


class Tree:
    """A node of a skeleton that was read: ``no`` is its number in it, from 0 in page order."""

    __slots__ = ("label", "children", "no")

    def __init__(self, label: str, no: int):
        self.label, self.no = label, no
        self.children: list[Tree] = []


_OPEN = re.compile(r"([^\[\] ]*)\[|\]")


def read_skeleton(text: str) -> Tree:
    top = Tree("", -1)
    stack, no = [top], 0
    for m in _OPEN.finditer(text):
        if m[1] is None:
            stack.pop()
        else:
            node = Tree(m[1], no)
            no += 1
            stack[-1].children.append(node)
            stack.append(node)
    return top.children[0]


def _matches(a: Tree, b: Tree) -> dict[tuple[int, int], tuple[int, tuple]]:
    """By the numbers of each pair of nodes that simple tree matching compares: the number of matched nodes, and the matched child pairs."""
    found: dict[tuple[int, int], tuple[int, tuple]] = {}
    todo = [(a, b, False)] if a.label == b.label else []
    while todo:
        x, y, ready = todo.pop()
        if not ready:
            todo.append((x, y, True))
            todo += [(c, d, False) for c in x.children for d in y.children if c.label == d.label]
            continue
        m, n = len(x.children), len(y.children)
        best = [[0] * (n + 1) for _ in range(m + 1)]
        for i, c in enumerate(x.children):
            row, above = best[i + 1], best[i]
            for j, d in enumerate(y.children):
                gain = found[c.no, d.no][0] if c.label == d.label else 0
                row[j + 1] = max(above[j + 1], row[j], above[j] + gain)
        pairs, i, j = [], m, n
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((i, j))
        found[x.no, y.no] = best[m][n] + 1, tuple(reversed(pairs))
    return found


def tree_match(a: Tree, b: Tree) -> tuple[int, tuple]:
    """Simple tree matching: the number of matched nodes, and for each matched child pair (i, j)."""
    return _matches(a, b).get((a.no, b.no), (0, ()))


@lru_cache(5_000)
def slots(page: str, reference: str) -> tuple[int | str, ...]:
    """For each node of the page's skeleton the number of the reference node aligned with it, else a digest of its place below the next one that is."""
    p, r = read_skeleton(page), read_skeleton(reference)
    found = _matches(p, r)
    out: dict[int, int | str] = {}
    todo: list[tuple[Tree, Tree | None, int | str]] = [(p, r if found else None, "")]
    while todo:
        x, y, place = todo.pop()
        out[x.no] = place if y is None else y.no
        pair = dict(found[x.no, y.no][1]) if y else {}
        seen: Counter = Counter()
        for i, c in enumerate(x.children):
            if i in pair:
                todo.append((c, y.children[pair[i]], ""))
            else:
                todo.append((c, None, hashlib.blake2b(f"{out[x.no]}/{c.label}/{seen[c.label]}".encode(), digest_size=8).hexdigest()))
                seen[c.label] += 1
    return tuple(out[i] for i in range(len(out)))


def blocks(root: Node, place: dict[int, int]) -> list[tuple[int, str]]:
    """(number, text) of the content blocks in page order; the number is that of the block's node in the skeleton."""
    articles: list[Node] = []
    body: list[Node] = []
    todo = [elements(root)]
    while todo:
        child = next(todo[-1], None)
        if child is None:
            todo.pop()
        elif child.role == "+":
            articles.append(child)
        elif child.role != "-":
            if child.tag == "body":
                body.append(child)
            todo.append(elements(child))
    out: list[tuple[int, str]] = []
    for node in articles or body or [root]:
        _collect(node, place, out, bool(articles))
    return out


def _collect(top: Node, place: dict[int, int], out: list[tuple[int, str]], in_article: bool) -> None:
    run: list[str] = []

    def flush(at: int) -> None:
        text = " ".join("".join(run).split())
        if text:
            out.append((at, text))
        run.clear()

    todo = [(iter(top.children), place[id(top)], True)]
    while todo:
        children, at, block = todo[-1]
        for c in children:
            if isinstance(c, str):
                run.append(c)
            elif c.tag in VOID:
                if c.tag in ("br", "hr"):
                    run.append(" ")
            elif c.role == "-" or c.tag == "title" or c.tag == "header" and not in_article:
                flush(at)
            elif c.tag in INLINE and not c.role:
                todo.append((iter(c.children), at, False))
                break
            else:
                flush(at)
                todo.append((iter(c.children), place[id(c)], True))
                break
        else:
            if block:
                flush(at)
            todo.pop()


def key_of(slot: int | str, text: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{slot}\0{text}".encode(), digest_size=8).digest(), "little", signed=True)


def _slotted(root: Node, reference: str | None) -> list[tuple[int | str, str]]:
    """(slot, text) of the content blocks."""
    shape, place = layout(root)
    found = blocks(root, place)
    slot = slots(shape, reference) if reference else None
    return [(slot[no] if slot else f"own {no}", t) for no, t in found]


def keyed_blocks(html: str | None, reference: str | None) -> tuple[list[str], list[int]]:
    """Texts of the content blocks of a page and the keys of (slot, text)."""
    found = _slotted(parse(html), reference) if html else []
    return [t for _, t in found], [key_of(slot, t) for slot, t in found]


def heading(root: Node) -> tuple[str, str]:
    """The texts of the page's title and of its first h1, empty if none."""
    seen: dict[str, str] = {}
    todo = [root]
    while todo and len(seen) < 2:
        node = todo.pop()
        if node.tag in ("title", "h1") and node.tag not in seen:
            seen[node.tag] = " ".join("".join(_strings(node)).split())
        todo += [c for c in reversed(node.children) if not isinstance(c, str)]
    return seen.get("title", ""), seen.get("h1", "")


def _strings(node: Node) -> Iterator[str]:
    todo: list[Node | str] = [node]
    while todo:
        one = todo.pop()
        if isinstance(one, str):
            yield one
        else:
            todo += reversed(one.children)


def votes(html: str, reference: str) -> set[tuple[int, int | None, int]]:
    """(slot, key of slot and text, page) of a page's content blocks, and (slot, null, page) of the slots it fills; all hashed."""
    root = parse(html)
    found = _slotted(root, reference)
    if not found:
        return set()
    title, first = heading(root)
    page = key_of(title, first or "\0".join(text for _, text in found))
    out: set[tuple[int, int | None, int]] = set()
    for slot, text in found:
        place = key_of(slot, "")
        out.add((place, None, page))
        out.add((place, key_of(slot, text), page))
    return out


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars, n_template) for every row: the main text, its code points and how many template blocks were left out."""
    spark = df.sparkSession
    ship(spark)
    host = F.coalesce(F.regexp_extract(F.col(url_col).cast("string"), r"//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))
    frame = F.coalesce(F.array_join(F.array_distinct(F.transform(F.regexp_extract_all(F.col(html_col).cast("string"), F.lit(FRAME)), F.lower)), " "), F.lit(""))
    pages = df.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"), F.concat_ws("\n", host, frame).alias("host"))  # a layout: host and frame

    def shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter = Counter()
        for batch in batches:
            for h, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if html:
                    count[h, skeleton(parse(html))] += 1
            if len(count) > 20_000:
                yield _counted(count)
                count.clear()
        yield _counted(count)

    def _counted(count: Counter) -> pa.RecordBatch:
        return pa.record_batch({"host": pa.array([h for h, _ in count], pa.string()), "shape": pa.array([s for _, s in count], pa.string()), "n": pa.array(list(count.values()), pa.int64())})

    shape = map_arrow(pages.select("host", "html"), shapes, "host string, shape string, n long").groupBy("host", "shape").agg(F.sum("n").alias("n"))
    reference = written(shape.groupBy("host").agg(F.max_by("shape", F.struct("n", "shape")).alias("shape"), F.sum("n").alias("pages")).filter(F.col("pages") >= LEAST_VOTES), "references")

    def fills(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for batch in batches:
            for h, html, shape_ in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if shape_ is not None and html:
                    seen.update((h, *vote) for vote in votes(html, shape_))
                if len(seen) > 200_000:
                    yield _filled(seen)
                    seen.clear()
        yield _filled(seen)

    def _filled(seen: set[tuple]) -> pa.RecordBatch:
        h, slot, key, page = zip(*seen, strict=True) if seen else ((), (), (), ())
        return pa.record_batch({"host": pa.array(h, pa.string()), "slot": pa.array(slot, pa.int64()), "key": pa.array(key, pa.int64()), "page": pa.array(page, pa.int64())})

    filled = map_arrow(_beside(pages.select("host", "html"), reference.select("host", "shape")), fills, "host string, slot long, key long, page long")
    filled = written(filled.distinct().groupBy("host", "slot", "key").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_VOTES), "fills")
    slot = filled.filter("key IS NULL").select("host", "slot", F.col("n").alias("of"))
    constant = filled.filter("key IS NOT NULL").join(slot, ["host", "slot"]).filter(_mostly(F.col("n"), F.col("of")))
    # a page has few constant keys: each fills its slot on more than half of the pages that fill it
    template = written(reference.join(constant.groupBy("host").agg(F.collect_set("key").alias("keys")), "host").select("host", F.struct("shape", "keys").alias("shape")), "templates")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, left = [], []
            for html, own in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                texts, keys = keyed_blocks(html, own["shape"] if own else None)
                known = set(own["keys"]) if own else ()
                kept = [t for t, k in zip(texts, keys, strict=True) if k not in known]
                out.append(" ".join(kept))
                left.append(len(texts) - len(kept))
            yield pa.record_batch({"id": batch.column(0), "url": batch.column(1), "text": pa.array(out, pa.string()), "n_chars": pa.array([len(t) for t in out], pa.int64()), "n_template": pa.array(left, pa.int64())})

    joined = _beside(pages, template).select("id", "url", "html", "shape")
    return map_arrow(joined, read, kept_schema(joined, 2, "text string, n_chars long, n_template long")).withColumnRenamed("id", id_col)


def _mostly(n: Column, of: Column) -> Column:
    """Whether the lower end of the Wilson interval of the share n / of is above one half."""
    p = n / of
    return (p + Z2 / (2 * of) - F.sqrt(Z2 * (p * (1 - p) / of + Z2 / (4 * of * of)))) / (1 + Z2 / of) > 0.5


def _beside(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """``pages`` with the host's row: a broadcast join below ``BROADCAST_BYTES``, else a join by host that splits hot hosts (AQE)."""
    size = hosts.select(F.sum(F.length(F.to_json(F.struct("host", "shape"))))).first()[0] or 0
    return pages.join(F.broadcast(hosts) if size <= BROADCAST_BYTES else hosts, "host", "left")
