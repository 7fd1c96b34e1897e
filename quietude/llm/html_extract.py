"""Main text of web pages by wrapper induction.

Pages of one host are worked in groups. Each page becomes a DOM tree. Pages whose
sets of tag paths are alike (``ALIKE`` percent of the paths of both) form a cluster;
its trees are aligned with up to ``PIVOTS`` of them by simple tree matching (the largest
order-preserving mapping between nodes of the same tag whose parents map). A
block of text that ``AGREE`` percent of the nodes aligned with a pivot's node have,
in at least ``MIN_PAGES`` pages, is template; what varies is content. Names that HTML itself gives to furniture (nav,
aside, form, ...) and the usual class names for it mark what varies from page
to page without being content, such as adverts and comments. A class or id names
furniture only as a whole (``sidebar``, ``site-footer``, but not ``has-sidebar`` or
``search-results-page``, which the alignment judges). Even then a ``main`` below it
is content; on a page without an article elsewhere so are an article below it
(but for comments) and the element itself if it has more than half of the text
(but for comments, adverts and the like). Inside article elements
the alignment decides as well, and blocks outside them count like others. Copies
of a page are one witness, however many they are: pages whose blocks are the
same, or share ``COPY_SHARE`` percent of their characters and ``COPY_CHARS`` at least.

A host with more than ``SPLIT_PAGES`` pages is dealt into groups of about
``GROUP_PAGES`` by a hash of the page, so a host with a third of all pages is many
groups in many tasks. Groups of a host with long pages are smaller, of about
``GROUP_BYTES``, but not below ``LEAST_PAGES`` pages on average. A page's group
follows from the host's pages alone, not from settings or other hosts. The list of
the split hosts is broadcast: at most one row for ``LEAST_PAGES`` pages. Every page is
extracted with its own group's template.

Blocks are the text between block-level tags, with character references
decoded and white space turned into single blanks; a line break is white space.

Defined cases: a NULL or empty page, and one without a block outside the
furniture, gives an empty text. A NULL url belongs to the empty host. NULL
ids and repeated rows are pages like others. Elements nested deeper than
``MAX_DEPTH`` count as children of the deepest level. An empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietude.llm.common import LOWER, UPPER, quoted

GROUP_PAGES = 32
SPLIT_PAGES = 48
GROUP_BYTES = 32 << 20
LEAST_PAGES = 12
PIVOTS = 4
ALIKE = 50
AGREE = 60
MIN_PAGES = 3
COPY_SHARE = 90
COPY_CHARS = 500
MAX_DEPTH = 200

# Names of HTML elements, roles and common class names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rp rt s "
                   "samp small span strike strong sub sup time tt u var wbr".split())
FURNITURE = frozenset("head title script style noscript template nav footer aside form button select option textarea input "
                      "iframe object canvas svg math dialog menu".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu "
                            "menubar toolbar".split())
FURNITURE_NAMES = frozenset("ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner "
                            "cookie cookies consent gdpr notice notices notification popup modal overlay newsletter "
                            "subscribe subscription signup login sidebar menu nav navbar navigation breadcrumb "
                            "breadcrumbs footer comment comments disqus reply replies respond share sharing social "
                            "related recommended recommendations widget widgets pagination pager masthead topbar "
                            "toolbar copyright skip search form".split())
#: Parts that may stand beside these in a name that is furniture as a whole.
PLACE_NAMES = frozenset("site page main left right top bottom primary secondary global list item items box block area section "
                        "link links bar button buttons user post posts articles stories wrapper container".split())
COMMENT_NAMES = frozenset("comment comments disqus reply replies respond".split())
COMMENT_PLACES = frozenset("body content text author meta thread count title".split()) | PLACE_NAMES
#: Names that no share of a page's text rules out.
SURE_NAMES = frozenset("ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion cookie cookies "
                       "consent gdpr newsletter share sharing breadcrumb breadcrumbs pagination pager".split())
#: Names that make the whole an element of another kind if they stand at its end.
CONTENT_HEADS = frozenset("page main post".split())
ARTICLE_TAGS = frozenset(("article", "main"))
KEEP_TAGS = frozenset(("html", "body", "article", "main"))
#: Start tags that end an open element of the same kind, up to the given parents.
CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th")}
SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr")}
ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p "
                   "pre section table ul".split())


class Node:
    __slots__ = ("tag", "kids", "blocks", "shape")

    def __init__(self, tag: str) -> None:
        self.tag, self.kids, self.blocks, self.shape = tag, [], [], 0


class Named:
    """An element that its name makes furniture, and the one around it."""

    __slots__ = ("kind", "outer")

    def __init__(self, kind: str, outer: Named | None) -> None:
        self.kind, self.outer = kind, outer


class Page(HTMLParser):
    """The tree of a page outside its furniture, and its blocks of text in page
    order as (node, index in the node). ``seen`` also has the blocks below names
    of furniture, which ``judge`` takes into ``order`` or leaves."""

    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("")
        self.order: list[tuple[Node, int]] = []
        self.seen: list[tuple[Node, int, Named | None, bool]] = []
        self.article = False  # an article outside named furniture
        self.buffer: list[str] = []
        # Open elements: tag, node that gets blocks (None in furniture), inside an article, named furniture around.
        self.open: list[tuple[str, Node | None, bool, Named | None]] = [("", self.root, False, None)]
        self.feed(html)
        self.close()
        self.flush()
        self.judge()
        self.shapes()

    def flush(self) -> None:
        text = " ".join("".join(self.buffer).split())
        self.buffer.clear()
        if text:
            at = next(i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] not in INLINE)
            node = self.open[at][1]
            if node is not None:
                node.blocks.append(text)
                self.seen.append((node, len(node.blocks) - 1, self.open[at][3], self.open[at][2]))

    def judge(self) -> None:
        """The blocks in ``order``: those outside named furniture, and below it what its names can't rule out."""
        total = sum(len(n.blocks[i]) for n, i, _, _ in self.seen)
        share: dict[Named, int] = {}
        for node, index, named, _ in self.seen:
            while named is not None:
                share[named] = share.get(named, 0) + len(node.blocks[index])
                named = named.outer

        def content(named: Named | None, inside: bool) -> bool:
            while named is not None:
                if self.article or named.kind == "comment" or \
                        not inside and (named.kind == "sure" or 2 * share[named] <= total):
                    return False
                named = named.outer
            return True

        for node, index, named, inside in self.seen:
            if content(named, inside):
                self.order.append((node, index))
        if len(self.order) < len(self.seen):
            held: dict[int, list[str]] = {}
            for k, (node, index) in enumerate(self.order):
                kept = held.setdefault(id(node), [])
                kept.append(node.blocks[index])
                self.order[k] = (node, len(kept) - 1)
            for node in {id(n): n for n, *_ in self.seen}.values():
                node.blocks = held.get(id(node), [])

    def handle_data(self, data: str) -> None:
        if self.open[-1][1] is not None:
            self.buffer.append(data)

    def pop_to(self, at: int) -> None:
        if any(tag not in INLINE for tag, *_ in self.open[at:]):
            self.flush()
        del self.open[at:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.handle_data("\n")
            return
        if tag in ENDS_P:
            self.close_open(("p",), ("button", "td", "th", "table"))
        if tag in CLOSES and tag != "p":
            self.close_open(CLOSES[tag], SCOPES.get(tag, ()))
        if tag not in INLINE:
            self.flush()
        if tag in VOID:
            return
        _, node, inside, named = self.open[-1]
        if node is not None:
            main = tag == "main" or ("role", "main") in attrs
            if not main and self.is_furniture(tag, attrs, inside):
                node = None
            elif tag not in INLINE and len(self.open) < MAX_DEPTH:
                node.kids.append(kid := Node(tag))
                node = kid
            if main:
                named = None
            elif node is not None and (kind := self.furniture_name(tag, attrs, inside)):
                # An article counts again below this name.
                named, inside = Named(kind, named), False
            inside = inside or main or tag in ARTICLE_TAGS or ("itemprop", "articleBody") in attrs
            self.article = self.article or inside and node is not None and named is None
        self.open.append((tag, node, inside, named))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag != "br" and self.open[-1][0] == tag:
            pass  # HTML ignores the slash of an element that isn't void

    def close_open(self, tags: Sequence[str], stops: Sequence[str]) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.open[i][0]
            if tag in tags:
                self.pop_to(i)
                return
            if tag in stops:
                return

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == tag:
                self.pop_to(i)
                return

    @staticmethod
    def is_furniture(tag: str, attrs: list[tuple[str, str | None]], inside: bool) -> bool:
        if tag in KEEP_TAGS:
            return False
        if tag in FURNITURE and tag != "form" or tag == "header" and not inside:
            return True
        return any(name == "role" and (value or "").lower() in FURNITURE_ROLES - {"form"} or name == "hidden" or
                   name == "aria-hidden" and value == "true" or
                   name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value or "")
                   for name, value in attrs)

    @staticmethod
    def furniture_name(tag: str, attrs: list[tuple[str, str | None]], inside: bool) -> str:
        """``comment``, ``sure`` or ``other`` if class, id or kind of the element name furniture, else empty."""
        kind = "other" if tag == "form" or ("role", "form") in attrs else ""
        for name, value in attrs:
            for token in (value or "").split() if name in ("class", "id") else ():
                parts = set(own := _name_parts(token))
                if parts & COMMENT_NAMES and parts <= FURNITURE_NAMES | COMMENT_PLACES and \
                        own[-1] not in CONTENT_HEADS and (tag not in KEEP_TAGS or inside):
                    return "comment"
                if tag not in KEEP_TAGS and (parts & FURNITURE_NAMES or "header" in parts and not inside) and \
                        parts <= FURNITURE_NAMES | PLACE_NAMES | {"header"} and own[-1] not in CONTENT_HEADS:
                    kind = "sure" if kind == "sure" or parts & SURE_NAMES else "other"
        return kind

    def shapes(self) -> None:
        """A hash of each subtree's tags, children before parents, and the tag paths from the root."""
        order, todo = [], [(self.root, 0)]
        paths = set()
        while todo:
            node, above = todo.pop()
            order.append(node)
            paths.add(path := hash((above, node.tag)))
            todo += [(k, path) for k in node.kids]
        self.paths = frozenset(paths)
        for node in reversed(order):
            node.shape = hash((node.tag, *[k.shape for k in node.kids]))


def _name_parts(value: str | None) -> list[str]:
    return re.findall(r"[a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value or "").lower())


def match(a: Node, b: Node, pairs: list[tuple[Node, Node]] | None = None) -> int:
    """Simple tree matching: the number of node pairs in the largest mapping of
    ``a`` onto ``b``; the pairs themselves go to ``pairs``."""
    if a.tag != b.tag:
        return 0
    if pairs is not None:
        pairs.append((a, b))
    if a.shape == b.shape and pairs is None:
        return _size(a)
    lo, la, lb = 0, len(a.kids), len(b.kids)
    total = 1
    # Equal subtrees at both ends always map to each other in some best mapping.
    while lo < min(la, lb) and a.kids[lo].shape == b.kids[lo].shape:
        total += match(a.kids[lo], b.kids[lo], pairs)
        lo += 1
    while la > lo and lb > lo and a.kids[la - 1].shape == b.kids[lb - 1].shape:
        la, lb = la - 1, lb - 1
        total += match(a.kids[la], b.kids[lb], pairs)
    left, right = a.kids[lo:la], b.kids[lo:lb]
    if not left or not right:
        return total
    weight = [[match(x, y) for y in right] for x in left]
    best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
    for i in range(len(left)):
        for j in range(len(right)):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + weight[i][j])
    if pairs is not None:
        i, j = len(left), len(right)
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                match(left[i], right[j], pairs)
    return total + best[-1][-1]


def _size(node: Node) -> int:
    count, todo = 0, [node]
    while todo:
        top = todo.pop()
        count += 1
        todo += top.kids
    return count


def contents(trees: Sequence[Page]) -> list[int]:
    """A number for each page's content, the same for copies of a page."""
    firsts: list[tuple[Counter, int]] = []
    out = []
    for page in trees:
        own = Counter(n.blocks[i] for n, i in page.order)
        size = sum(len(t) * k for t, k in own.items())
        for number, (other, length) in enumerate(firsts):
            if own == other:
                break
            if 100 * min(size, length) >= COPY_SHARE * max(size, length) and min(size, length) >= COPY_CHARS:
                common = sum(len(t) * min(k, other[t]) for t, k in own.items() if t in other)
                if common >= COPY_CHARS and 100 * common >= COPY_SHARE * max(size, length):
                    break
        else:
            number = len(firsts)
            firsts.append((own, size))
        out.append(number)
    return out


def clusters(trees: Sequence[Page]) -> list[list[int]]:
    """Indices of pages with like tag paths, each with the cluster of the first page most like it."""
    firsts: list[frozenset] = []
    out: list[list[int]] = []
    for at, page in enumerate(trees):
        own = page.paths
        like = [100 * len(own & other) / len(own | other) for other in firsts]
        best = max(range(len(like)), key=lambda k: (like[k], -k), default=None)
        if best is None or like[best] < ALIKE:
            best = len(firsts)
            firsts.append(own)
            out.append([])
        out[best].append(at)
    return out


def constants(trees: Sequence[Page], number: Sequence[int], min_pages: int) -> set[tuple[int, str]]:
    """(identity of a node, text) of the blocks of a cluster that are template."""
    found: set[tuple[int, str]] = set()
    aligned: set[int] = set()
    left = set(range(len(trees)))
    for _ in range(min(PIVOTS, len(trees))):
        # The next pivot has most blocks that no alignment has reached.
        fresh = {k: sum(id(n) not in aligned for n, _ in trees[k].order) for k in left}
        pivot = max(sorted(left), key=lambda k: fresh[k])
        left.discard(pivot)
        if not fresh[pivot]:
            break
        partners: dict[int, list[tuple[int, Node]]] = {id(n): [(number[pivot], n)] for n, _ in trees[pivot].order}
        for k, other in enumerate(trees):
            if k != pivot:
                pairs: list[tuple[Node, Node]] = []
                match(trees[pivot].root, other.root, pairs)
                for x, y in pairs:
                    if id(x) in partners and y.blocks:
                        partners[id(x)].append((number[k], y))
        for same in partners.values():
            everyone = len({at for at, _ in same})
            if everyone < min_pages:
                continue
            aligned.update(id(y) for _, y in same)
            votes: dict[str, set[int]] = {}
            for at, y in same:
                for text in y.blocks:
                    votes.setdefault(text, set()).add(at)
            for text, voters in votes.items():
                if len(voters) >= min_pages and 100 * len(voters) >= AGREE * everyone:
                    found.update((id(y), text) for _, y in same)
    return found


def extract_group(htmls: Sequence[str], min_pages: int = MIN_PAGES) -> list[str]:
    """The texts of pages of one host."""
    pages = {h: Page(h) for h in dict.fromkeys(htmls)}
    trees = list(pages.values())
    number = contents(trees)
    template: set[tuple[int, str]] = set()
    if len(set(number)) >= min_pages:
        for of in clusters(trees):
            if len({number[k] for k in of}) >= min_pages:
                template |= constants([trees[k] for k in of], [number[k] for k in of], min_pages)
    texts = {}
    for html, page in pages.items():
        blocks = [(n.blocks[i], (id(n), n.blocks[i]) in template) for n, i in page.order]
        texts[html] = "\n".join([t for t, constant in blocks if not constant] or [t for t, _ in blocks])
    return [texts[h] for h in htmls]


def groups(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, html, host, place (a hash of the page) and deal (the host's group) of every page."""
    host = F.translate(F.regexp_extract(F.coalesce(quoted(url_col), F.lit("")), "://([^/?#]*)", 1), UPPER, LOWER)
    rows = pages.select(quoted(id_col).alias("id"), quoted(url_col).cast("string").alias("url"),
                        quoted(html_col).cast("string").alias("html"), host.alias("host"),
                        F.xxhash64(quoted(id_col), quoted(url_col), quoted(html_col)).alias("place"))
    deals = f"least(n div {LEAST_PAGES}, greatest(CAST(round(n / {GROUP_PAGES}) AS BIGINT), size div {GROUP_BYTES} + 1))"
    split = (rows.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.octet_length("html")).cast("long").alias("size"))
             .where(f"n > {SPLIT_PAGES} OR size > {GROUP_BYTES}").selectExpr("host", f"greatest(1, {deals}) AS deals").where("deals > 1"))
    return (rows.join(F.broadcast(split), "host", "left")
            .withColumn("deal", F.expr("pmod(place, coalesce(deals, 1))")).drop("deals")
            .select("id", "url", "html", "host", "place", "deal"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url and text of every page."""
    rows = groups(pages, id_col, url_col, html_col)
    # Small tables need few tasks. A group is in one task, however many there are.
    parts = max(1, min(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), pages.count() // (32 * GROUP_PAGES)))
    rows = rows.repartitionByRange(parts, "host", "deal").sortWithinPartitions("host", "deal", "place", "html")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, urls, htmls, at = [], [], [], None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.concat_arrays(ids), pa.array(urls, pa.string()),
                                               pa.array(extract_group(htmls), pa.string())], names=["id", "url", "text"])

        for batch in batches:
            for n, (url, html, *name) in enumerate(zip(*(batch.column(c).to_pylist() for c in (1, 2, 3, 5)))):
                if ids and name != at:
                    yield done()
                    ids, urls, htmls = [], [], []
                at = name
                ids.append(batch.column(0).slice(n, 1))
                urls.append(url)
                # A page that comes again is the same string (they are sorted).
                htmls.append(htmls[-1] if htmls and htmls[-1] == (html or "") else html or "")
        if ids:
            yield done()

    kind = rows.schema["id"].dataType.simpleString()
    return (rows.mapInArrow(work, f"id {kind}, url string, text string")
            .select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text"))
