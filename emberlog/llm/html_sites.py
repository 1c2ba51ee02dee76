"""Main text of web pages by site style trees.

The element trees of one host's pages are merged by path: a node is a path of tags with
their classes and ids.  Over the host's pages a node has a presentation importance (entropy
of its child sequences: a fixed layout has none) and, where it holds text, a content
importance (how seldom its texts recur on other pages, as one less their entropy).  A branch
combines both, the content of all text below it weighing more the fewer children it has.
Branches of low importance on enough pages, with nothing important below them, are template
and are removed from every page.

What a page's own mark-up says comes after the tree: scripts, styles, menus, page headers, footers,
side bars, forms, notices, adverts and comments go by tag, role, class or id; where a page
has an article (or main) element, its text is the article's.  Inside an article the tree
decides too: branches that recur go, and a branch that only its name speaks against stays if
its texts are the pages' own and it holds a fair share of the article.  Names of comments,
adverts and links to other pages always count, as their texts differ from page to page
without being main text.

Pages with equal main text are one page to the tree, however many copies a host serves: an
article page goes by the longest block of its largest part, another page by all its text.
Articles, what is around them and branches that hold half of their text or more are never
template, and a page whose branches are all alike on its host keeps its unmarked text.

Pages are keyed by host and text, and counts, combined in each task before the shuffle, by
host, node and text, so one host with a third of all pages is spread over all tasks.

Defined results: null and empty pages give an empty text; a page without text likewise; a
null url is a host of its own; unclosed elements end where HTML ends them, and a tag cut off
by the end of the page is dropped; repeated rows are extracted row by row.  Only page_id, url
and html are read.
"""

from __future__ import annotations

import hashlib
import html as references
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.common import batch_of, map_arrow, pieces_of, table

# Element kinds of HTML, and names that mark what is not main text.
BLOCKS = frozenset((
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul").split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
JUNK_TAGS = frozenset((
    "aside button canvas dialog footer form head iframe menu nav noscript object option search select svg template").split())
JUNK_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
JUNK_NAMES = frozenset((
    "ad ads adbox adslot advert advertisement advertising adverts sponsor sponsored promo promotion promoted banner "
    "sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar cookie cookies consent gdpr "
    "notice notices popup modal overlay newsletter subscribe subscription signup share sharing social related "
    "recommended recommendations comment comments disqus replies respond pagination pager search login skip "
    "copyright disclaimer toolbar widget widgets").split())
# Of these, names of what differs from page to page without being main text.
FOREIGN_NAMES = frozenset((
    "ad ads adbox adslot advert advertisement advertising adverts sponsor sponsored promo promotion promoted related "
    "recommended recommendations comment comments disqus replies respond pagination pager search login").split())
HEADER_NAMES = frozenset(("header", "pageheader", "siteheader"))
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
}
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|</(?=[^a-zA-Z])[^>]*+(?:>|\Z)|"
    r"<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)|"
    r"<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)(?:>|\Z)", re.DOTALL)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
NAME_PARTS = re.compile(r"[a-z]+")
HOST = re.compile(r"^(?:[a-zA-Z][-+.\w]*:)?//(?:[^/?#@]*@)?([^/?#:]*)")


def host_of(url: str | None) -> str:
    found = HOST.match(url or "")
    return found[1].lower() if found else ""


def node_id(parent: int, label: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{parent} {label}".encode(), digest_size=8).digest(), "little", signed=True)


class Page:
    """Text blocks of a page in order, each with its path of nodes."""

    __slots__ = ("blocks", "children", "named", "stack", "words", "memo")

    def __init__(self, source: str, memo: dict):
        self.memo = memo
        self.blocks: list[tuple[str, tuple[int, ...], bool, bool]] = []  # text, path, junk, article
        self.named: set[int] = set()  # nodes in an article that only their name speaks against
        self.children: dict[int, list] = {}  # node -> [labels of children in order, protected]
        # Open elements: tag, path, junk, article, and the words that an inline advert interrupts.
        self.stack: list[tuple[str, tuple[int, ...], bool, bool, list | None]] = [("", (0,), False, False, None)]
        self.words: list[str] = []
        self.read(source)
        self.pop_to(1)
        self.flush()

    def flush(self) -> None:
        if self.words:
            text = " ".join("".join(self.words).split())
            self.words = []
            if text:
                _, path, junk, article, _ = self.stack[-1]
                self.blocks.append((text, path, junk, article))

    def pop_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            self.flush()
            held = self.stack.pop()[4]
            if held is not None:
                self.words = held

    def start(self, tag: str, rest: str) -> None:
        block = tag in BLOCKS
        if block:
            self.flush()
            # A block ends an open paragraph, and list items and cells end their like.
            if tag in CLOSED_BY:
                ends, limits = CLOSED_BY[tag]
                for i in range(len(self.stack) - 1, 0, -1):
                    if self.stack[i][0] in limits:
                        break
                    if self.stack[i][0] in ends:
                        self.pop_to(i)
            for i in range(len(self.stack) - 1, 0, -1):
                if self.stack[i][0] == "p":
                    self.pop_to(i)
                    break
        if tag in VOID:
            if tag in ("br", "hr", "wbr"):
                self.words.append("" if tag == "wbr" else " ")
            return
        named = dict((k.lower(), v.strip("\"'")) for k, v in ATTRIBUTE.findall(rest)) if rest and not rest.isspace() else {}
        if not block and not named and tag not in JUNK_TAGS:
            return  # plain inline mark-up
        _, path, junk, article, _ = self.stack[-1]
        names = f"{named.get('class', '')} {named.get('id', '')}".lower()
        label = f"{tag} {' '.join(sorted(set(re.sub(r'[0-9]{3,}', '0', names).split())))}"
        opens = tag in ("article", "main") or named.get("role", "") in ("main", "article")
        article = article or opens
        was_junk = junk
        mark = marked_junk(tag, named, names, article)
        by_name = mark == BY_NAME and article and block
        junk = junk or (mark != NOT_JUNK and not by_name)
        held = None
        if junk and not was_junk and not block:
            held, self.words = self.words, []
        key = (path[-1], label)
        own = self.memo.get(key)
        if own is None:
            if len(self.memo) > 200_000:
                self.memo.clear()
            own = self.memo[key] = node_id(*key)
        seen = self.children.setdefault(path[-1], [[], False])
        seen[0].append(label)
        if by_name:
            self.named.add(own)
        if opens:
            # Neither an article nor what is around it is template.
            for n in (*path, own):
                self.children.setdefault(n, [[], False])[1] = True
        else:
            self.children.setdefault(own, [[], False])
        self.stack.append((tag, (*path, own), junk, article, held))

    def end(self, tag: str) -> None:
        if tag in ("br", "p") and not any(s[0] == tag for s in self.stack):
            self.flush() if tag == "p" else self.words.append(" ")
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] == tag:
                if tag in BLOCKS or any(s[4] is not None for s in self.stack[i:]):
                    self.pop_to(i)
                    if tag in BLOCKS:
                        self.flush()
                else:
                    del self.stack[i:]
                return
            if tag not in BLOCKS and self.stack[i][0] in BLOCKS:
                return  # an inline end does not leave its block

    def read(self, source: str) -> None:
        at = 0
        while True:
            found = MARKUP.search(source, at)
            if not found:
                self.words.append(references.unescape(source[at:]))
                return
            if found.start() > at:
                self.words.append(references.unescape(source[at:found.start()]))
            at = found.end()
            tag = (found["tag"] or found["tag2"] or "").lower()
            if not tag:
                continue
            if found["end"] or found["end2"]:
                self.end(tag)
            elif tag in RAW:
                close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.IGNORECASE).search(source, at)
                at = close.end() if close else len(source)
            else:
                self.start(tag, found["rest"] or found["rest2"] or "")


NOT_JUNK, BY_NAME, JUNK = 0, 1, 2


def marked_junk(tag: str, named: dict[str, str], names: str, article: bool) -> int:
    """Whether an element says itself that it is not main text, and if only its name says so."""
    if tag in JUNK_TAGS or (tag == "header" and not article):
        return JUNK
    if tag in ("html", "body", "main", "article"):
        return NOT_JUNK
    if (named.get("role", "").lower() in JUNK_ROLES or "hidden" in named or named.get("aria-hidden", "").lower() == "true"
            or "display:none" in named.get("style", "").replace(" ", "").lower()):
        return JUNK
    if not names.strip():
        return NOT_JUNK
    parts = set(NAME_PARTS.findall(names))
    if parts & FOREIGN_NAMES:
        return JUNK
    return BY_NAME if parts & JUNK_NAMES or (not article and parts & HEADER_NAMES) else NOT_JUNK


def main_parts(page: Page) -> tuple[int, dict[int, float]]:
    """What a page goes by, and each node's share of its article's text (none without an article)."""
    blocks = [(text, path) for text, path, junk, article in page.blocks if article and not junk]
    if not blocks:
        return node_id(3, "\n".join(text for text, _, _, _ in page.blocks)), {}
    leaves: dict[int, int] = {}
    share: dict[int, float] = {}
    total = sum(len(text) for text, _ in blocks)
    for text, path in blocks:
        leaves[path[-1]] = leaves.get(path[-1], 0) + len(text)
        for n in set(path):
            share[n] = share.get(n, 0.0) + len(text) / total
    largest = max(leaves, key=lambda n: (leaves[n], n))
    return node_id(3, max((text for text, path in blocks if path[-1] == largest), key=lambda t: (len(t), t))), share


NODE = pa.struct([("node", pa.int64()), ("kind", pa.int32()), ("key", pa.int64()), ("width", pa.int32()),
                  ("protected", pa.int32()), ("named", pa.int32()), ("share", pa.float32())])
STATS = pa.schema([("host", pa.string()), ("page", pa.int64()), ("nodes", pa.list_(NODE))])
STATS_SQL = ("host string, page long, nodes array<struct<node:bigint,kind:int,key:bigint,width:int,"
             "protected:int,named:int,share:float>>")


def _stats(batches):
    """Per page the rows of its nodes: child sequence (0), texts (1), and the text nodes below (2)."""
    memo: dict = {}
    for batch in batches:
        for part in pieces_of(batch, "html"):
            rows: list[tuple] = []
            for url, source in zip(part["url"].to_pylist(), part["html"].to_pylist(), strict=True):
                page, host = Page(source or "", memo), host_of(url)
                ident, share = main_parts(page)
                nodes = [(node, 0, node_id(0, "\n".join(labels)), len(labels), int(protected), int(node in page.named),
                          share.get(node, 0.0)) for node, (labels, protected) in page.children.items()]
                texts = {(path[-1], text): path for text, path, _, _ in page.blocks}
                nodes += [(node, 1, node_id(1, text), 0, 0, 0, 0.0) for node, text in texts]
                nodes += [(above, 2, path[-1], 0, 0, 0, 0.0) for path, above in {(p, a) for p in texts.values() for a in p}]
                rows.append((host, ident, sorted(nodes)))
            sizes = np.cumsum([0, *(len(nodes) for _, _, nodes in rows)])
            columns = zip(*(n for _, _, nodes in rows for n in nodes), strict=True) if sizes[-1] else [()] * NODE.num_fields
            flat = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, NODE, strict=True)], fields=list(NODE))
            yield pa.RecordBatch.from_arrays([
                pa.array([host for host, _, _ in rows], pa.string()), pa.array([ident for _, ident, _ in rows], pa.int64()),
                pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), flat)], schema=STATS)


def style_tree(pages: DataFrame, decay: float = 0.9) -> DataFrame:
    """(host, node, pages, importance, content, best, protected, named, share) of every node of every host's tree.

    ``best`` is the highest content importance of the text at or below the node, ``content``
    their mean; ``share`` the mean share of an article's text; ``pages`` counts distinct ones.
    """
    rows = map_arrow(pages.select("url", "html"), _stats, STATS_SQL)
    # Copies count once: of pages that go by one text, the one with the least rows.
    rows = rows.groupBy("host", "page").agg(F.min("nodes").alias("nodes")).select("host", F.inline("nodes"))
    counts = table(rows.groupBy("host", "node", "kind", "key").agg(
        F.count(F.lit(1)).alias("c"), F.max("width").alias("width"), F.max("protected").alias("protected"),
        F.max("named").alias("named"), F.sum(F.col("share").cast("decimal(10,6)")).alias("share")), "styles")
    c = F.col("c").cast("double")
    looks = counts.where("kind = 0").groupBy("host", "node").agg(
        F.sum("c").alias("pages"), F.sum(c * F.log(c)).alias("_x"), F.sum(c * F.col("width")).alias("_w"),
        F.max("protected").alias("protected"), F.max("named").alias("named"), F.sum("share").cast("double").alias("_s"))
    spread = F.log(F.col("pages").cast("double"))
    # H = log m - sum(c log c) / m, in units of log m; one page tells nothing and counts whole.
    looks = looks.withColumns({
        "look": F.when(F.col("pages") > 1, 1 - F.col("_x") / (F.col("pages") * spread)).otherwise(1.0),
        "children": F.col("_w") / F.col("pages"), "share": F.col("_s") / F.col("pages")})
    texts = counts.where("kind = 1").groupBy("host", "node").agg(F.sum("c").alias("_n"), F.sum(c * F.log(c)).alias("_x"))
    leaves = texts.join(looks.select("host", "node", "pages"), ["host", "node"]).select(
        "host", F.col("node").alias("leaf"),
        F.when(F.col("pages") > 1, F.greatest(1 - F.col("_x") / (F.col("_n") * spread), F.lit(0.0))).otherwise(1.0).alias("own"))
    below = counts.where("kind = 2").select("host", "node", F.col("key").alias("leaf"), "c")
    content = below.join(leaves, ["host", "leaf"]).groupBy("host", "node").agg(
        (F.sum(F.col("own") * c) / F.sum(c)).alias("content"), F.max("own").alias("best"))
    share = F.pow(F.lit(decay), F.col("children"))
    return looks.join(content, ["host", "node"], "left").select(
        "host", "node", "pages", ((1 - share) * F.col("look") + share * F.coalesce("content", F.lit(0.0))).alias("importance"),
        F.coalesce("content", F.lit(0.0)).alias("content"), F.coalesce("best", F.lit(0.0)).alias("best"),
        ((F.col("protected") == 1) | (F.col("share") >= 0.5)).alias("protected"), (F.col("named") == 1).alias("named"), "share")


def read_by_tree(page: Page, template: frozenset[int], own: frozenset[int] = frozenset()) -> tuple[str, int]:
    """The page's text and how many of its blocks the tree removed.

    The tree is asked first, for every block of the page; marks and the article rule see what
    it left.  Where nothing would be left, the tree's say is set aside.  ``own``: nodes that
    stay though their name speaks against them.
    """
    bad = page.named - own
    blocks = [(text, path, junk or not bad.isdisjoint(path), a) for text, path, junk, a in page.blocks]
    important = [block for block in blocks if template.isdisjoint(block[1])]
    article = any(a and not junk for _, _, junk, a in blocks)
    for left in (important, blocks):
        kept = [text for text, _, junk, a in left if not junk and (a or not article)]
        if kept:
            return "\n".join(kept), len(blocks) - len(left)
    return "", len(blocks) - len(important)


def main_text(page: Page, template: frozenset[int], own: frozenset[int] = frozenset()) -> str:
    """The text alone of :func:`read_by_tree`."""
    return read_by_tree(page, template, own)[0]


def extract(pages: DataFrame, *, least: float = 0.3, min_pages: int = 8, max_broadcast: int = 100_000,
            most: float = 0.7, fair: float = 0.1) -> DataFrame:
    """(page_id, url, text, n_chars, n_template_blocks) of every page.

    ``n_template_blocks`` counts the page's text blocks that the tree removed.  A branch goes if it and all below it are less important than ``least`` over at least
    ``min_pages`` distinct pages.  A branch of an article that only its name speaks against
    stays if its content importance is ``most`` and its share of the text ``fair`` at least.
    """
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                          F.col("html").cast("string").alias("html"))
    tree = style_tree(source).where(F.col("pages") >= min_pages)
    low = (F.col("importance") < least) & (F.col("best") < least) & ~F.col("protected")
    own = F.col("named") & (F.col("content") >= most) & (F.col("share") >= fair)
    # A host's own template; how many nodes it can have depends on its layouts, not its pages.
    per_host = table(tree.where(low | own).groupBy("host").agg(
        F.sort_array(F.collect_set(F.when(low, F.col("node")))).alias("template"),
        F.sort_array(F.collect_set(F.when(own, F.col("node")))).alias("own")), "templates")
    size = per_host.agg(F.coalesce(F.sum(F.size("template") + F.size("own") + 1), F.lit(0))).first()[0]
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[a-zA-Z][-+.\w]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    joined = source.withColumn("host", host).join(
        F.broadcast(per_host) if size <= max_broadcast else per_host, "host", "left").select("page_id", "url", "html", "template", "own")
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64()),
                        ("n_template_blocks", pa.int64())])

    def run(batches):
        memo: dict = {}
        for batch in batches:
            for part in pieces_of(batch, "html"):
                read = [read_by_tree(Page(html or "", memo), frozenset(template or ()), frozenset(own or ())) for html, template, own in zip(
                    *(part[c].to_pylist() for c in ("html", "template", "own")), strict=True)]
                texts = [text for text, _ in read]
                yield batch_of({"page_id": part["page_id"], "url": part["url"], "text": texts,
                                "n_chars": np.fromiter(map(len, texts), np.int64, len(texts)),
                                "n_template_blocks": [removed for _, removed in read]}, schema)

    return map_arrow(joined, run, "page_id long, url string, text string, n_chars long, n_template_blocks long")
