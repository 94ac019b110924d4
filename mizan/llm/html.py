"""Main text of web pages by consensus of their host.

Each page's containers are scored; the pages of a host vote on the generalised tag-class path
of their best one; then every page is extracted again from what the winning paths lead to.
They also vote on the paths of elements that look like menus, notices and the like, whether these
hold what is read there or not: what most pages of a host say goes before what one page looks like.
"""

from __future__ import annotations

import re
from collections import defaultdict
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, carried, discard, schema_with, staged, table

#: A path wins with this share of its host's votes, at least; so a host has ten winning paths at most.
SHARE = 0.1
#: A host's pages decide on the looks of a path that this share of them has, at least; on others each page does.
SETTLED = 0.01
#: A host with more than one in HOT pages is hot, so there are HOT hot hosts at most.
HOT = 1000

_OPEN = re.compile(r"<(?:!--|(/?)([a-zA-Z][^\s/>]*)|[!?])")
_REST = re.compile(r"""(?:[^'">]|"[^"]*"|'[^']*')*>""")
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"']+))""")
_BARE = re.compile(r"""(?:^|\s)hidden(?=[\s/>]|$)""")
_WORD = re.compile(r"[a-z]+")
_NUMBER = re.compile(r"\d+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math xmp noembed noframes object canvas video audio".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul button head caption".split())
#: Blocks that hold text rather than blocks; a container is any other block.
LEAF = frozenset("p h1 h2 h3 h4 h5 h6 pre dt dd li figcaption legend summary caption address".split())
#: What an opening tag closes, and what stops the search for it.
CLOSES = {"li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table tbody thead tfoot"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
CLOSES = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in CLOSES.items()}
#: Elements that are no part of an article; a header within an article is.
OUTSIDE = frozenset("nav footer aside form menu select button fieldset dialog search head".split())
#: Words of class, id and role that tell the same.
OUTSIDE_WORDS = frozenset(
    "ad ads advert advertisement adverts advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay "
    "menu nav navbar navigation navigational breadcrumb breadcrumbs sidebar aside footer masthead topbar toolbar comment comments respond replies disqus discussion "
    "share sharing social related recommended recommendations newsletter subscribe subscription signup login search searchbox widget widgets pagination pager paging "
    "complementary contentinfo dialog hidden form".split()
)
INSIDE_WORDS = frozenset("article content entry post story main text".split())
#: Words after which ``header`` is the page's own.
HEADER_WORDS = frozenset("header".split())
COMMENT_WORDS = frozenset("comment comments reply".split())
#: How sure it is that an element is outside: by a word that is part of a class name, by a whole one or the tag, for certain.
PARTLY, WHOLLY, CERTAIN = 1, 2, 3
#: Tags that never hold an article; what is hidden does neither.
NEVER = frozenset("nav footer menu select button search head".split())


class Node:
    __slots__ = ("tag", "path", "cut", "looks", "article", "score", "inside")

    def __init__(self, tag: str, path: str, cut: int, article: bool, inside: bool):
        self.tag, self.path, self.cut, self.article, self.inside, self.score = tag, path, cut, article, inside, 0.0


def parse(html: str | None, inside: frozenset[str] = frozenset(), outside: frozenset[str] = frozenset()) -> tuple[list[tuple[str, float, list[Node]]], list[Node]]:
    """Text blocks outside menus and the like, in page order: (text, share of link text, open elements); and all containers.

    ``inside`` and ``outside``: paths whose looks a host's pages have decided on."""
    html = html or ""
    root = Node("html", "", 0, False, False)
    stack, blocks, nodes = [root], [], [root]
    text: list[str] = []
    linked = links = 0
    at, n, quotes = 0, len(html), True

    def flush() -> None:
        nonlocal linked
        if text:
            s = " ".join(unescape("".join(text)).split())
            if s:
                blocks.append((s, min(1.0, linked / len(s)), stack[:]))
            text.clear()
        linked = 0

    def close(tags: frozenset, stops: frozenset) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in tags:
                del stack[k:]
                return
            if stack[k].tag in stops:
                return

    while at < n:
        m = _OPEN.search(html, at)
        end = m.start() if m else n
        if end > at:
            piece = html[at:end]
            if not m and (cut := piece.rfind("<")) >= 0 and re.match(r"</?$", piece[cut:]):
                piece = piece[:cut]
            text.append(piece)
            if links:
                linked += len(piece)
        if not m:
            break
        if m[0] == "<!--":
            k = html.find("-->", m.end())
            at = n if k < 0 else k + 3
            continue
        tail = _REST.match(html, m.end()) if quotes and m[2] else None
        if tail is None:
            if m[2] and quotes and html.find(">", m.end()) >= 0:
                quotes = False  # a quote stays open: from here on, tags end at the next bracket
            k = html.find(">", m.end())
            if k < 0:
                break  # a tag that the page's end cuts off
            at = k + 1
        else:
            at = tail.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "a":
                links = max(0, links - 1)
            elif tag in BLOCK:
                flush()
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag:
                        del stack[k:]
                        break
            continue
        if tag in RAW:
            if html[at - 2] != "/":
                k = _end_of(tag).search(html, at)
                at = n if k is None else k.end()
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag == "a":
            links += 1
            continue
        if tag not in BLOCK:
            if tag in ("img", "wbr", "input"):
                text.append("" if tag == "wbr" else " ")
            continue
        flush()
        links = 0
        if tag in VOID:
            continue
        if tag in CLOSES:
            close(*CLOSES[tag])
        close(_P, _NOT_P)
        if tag in ("html", "body") and any(x.tag == tag and x is not root for x in stack):
            continue
        parent = stack[-1]
        name, cut, like = _names(tag, html[m.end() : at - 1], parent.article)
        node = Node(tag, f"{parent.path}/{name}", cut, parent.article or tag in ("article", "main"), like)
        stack.append(node)
        nodes.append(node)
    flush()
    for node in nodes:
        node.looks = node.cut
        if node.cut < CERTAIN and node.path in inside:
            node.cut = 0
    return _uncut(blocks, nodes, outside), nodes


_P, _NOT_P = frozenset(["p"]), BLOCK - {"p"}
_ENDS: dict[str, re.Pattern] = {}


def _end_of(tag: str) -> re.Pattern:
    if tag not in _ENDS:
        _ENDS[tag] = re.compile(rf"</{tag}[^>]*>", re.IGNORECASE)
    return _ENDS[tag]


def _worth(block: tuple) -> float:
    return len(block[0]) * (1 - block[1])


def _uncut(blocks: list, nodes: list[Node], outside: frozenset[str]) -> list:
    """The blocks in no cut element. An element cut by its looks stays if it has an article or main, or (with words that
    are only parts of class names) text of its own, with more text than all that no cut touches, and its path is not
    known to be ``outside``; else, if nothing is left, all does that is not cut for certain."""
    if not any(x.cut for x in nodes):
        return blocks
    cuts = [[x for x in b[2] if x.cut] for b in blocks]

    def left() -> list:
        return [b for b, c in zip(blocks, cuts) if not any(x.cut for x in c)]

    for node in [x for x in dict.fromkeys(x for c in cuts for x in c) if x.cut < CERTAIN and x.path not in outside]:
        around = next(b[2] for b in blocks if node in b[2])
        if any(x.cut for x in around[: around.index(node)]):
            continue
        held = sum(map(_worth, left()))
        most: dict[Node | None, float] = defaultdict(float)
        for b, c in zip(blocks, cuts):
            if node in c:
                inner = b[2][b[2].index(node) + 1 :]
                # Of the text in elements that are cut by a whole word, the outer element makes nothing.
                if any(x.cut > PARTLY for x in inner):
                    continue
                most[None] += _worth(b) if node.cut == PARTLY else 0.0
                for x in inner:
                    if x.tag in ("article", "main"):
                        most[x] += _worth(b)
        if max(most.values(), default=0.0) > held:
            node.cut = 0
    return left() or [b for b, c in zip(blocks, cuts) if not any(x.cut == CERTAIN for x in c)]


def _names(tag: str, rest: str, in_article: bool) -> tuple[str, int, bool]:
    """The generalised tag-class name of an element; whether it is cut, and whether inside of an article, by its looks."""
    cut = CERTAIN if tag in NEVER else WHOLLY if tag in OUTSIDE or tag == "header" and not in_article else 0
    outside = tag in OUTSIDE or tag == "header" and not in_article
    if "=" not in rest:
        return tag, CERTAIN if rest and _BARE.search(rest) else cut, False
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(rest)}
    kind = found.get("class", "").lower()
    tokens = f"{kind} {found.get('id', '')} {found.get('role', '')}".lower()
    words = set(_WORD.findall(tokens))
    telling = frozenset() if tag in ("html", "body", "main") else COMMENT_WORDS if tag == "article" else OUTSIDE_WORDS if in_article else OUTSIDE_WORDS | HEADER_WORDS
    if not words.isdisjoint(telling):
        # A word that is only part of a class name tells of containers, not of an article's paragraphs.
        cut = max(cut, WHOLLY if not telling.isdisjoint(tokens.split()) else 0 if tag in LEAF else PARTLY)
    if found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "") or _BARE.search(rest):
        cut = CERTAIN
    name = ".".join([tag, *sorted({_NUMBER.sub("#", c) for c in kind.split()})])
    return name, cut, not words.isdisjoint(INSIDE_WORDS)


def best(blocks: list, nodes: list[Node]) -> str | None:
    """The path of what holds the container with the most text: blocks count for what holds them, and half for the next.

    That is the outermost article or main around it; without one, the outermost element named like one; without that,
    the smallest element around it that has most of the text, or the one around that which has text of its own beside it."""
    direct: dict[Node, float] = defaultdict(float)
    for text, share, open_ in blocks:
        worth = len(text) * (1 - share)
        inner = [x for x in open_ if x.tag not in LEAF]
        if inner:
            direct[inner[-1]] += worth
        for k, node in enumerate(reversed(inner[-2:])):
            node.score += worth / (1 + k) * (1.25 if node.article or node.inside else 1.0)
    top = max(nodes, key=lambda x: x.score, default=None)
    if top is None or top.score <= 0:
        return None
    line = next(b[2] for b in blocks if top in b[2])
    around = [x for x in line[1 : line.index(top) + 1] if x.tag not in ("html", "body")]
    named = [x for x in around if x.tag in ("article", "main")] or [x for x in around if x.inside]
    if named:
        return named[0].path
    total = sum(map(_worth, blocks))
    held: dict[Node, float] = defaultdict(float)
    for b in blocks:
        for x in b[2]:
            held[x] += _worth(b)
    at = next((k for k in range(len(around) - 1, -1, -1) if 2 * held[around[k]] > total), len(around) - 1)
    while at > 0 and direct[around[at - 1]] > 0:
        at -= 1
    return around[at].path if around else top.path


def best_path(html: str | None) -> str | None:
    return best(*parse(html))


def said(html: str | None) -> list[tuple[str, str | None]]:
    """A page's votes: (MAIN, its best path, if it has any), and for each path that looks like none of the article
    whether it is part of it all the same (IN) or not (OUT)."""
    blocks, nodes = parse(html)
    looks: dict[str, bool] = {}
    for node in nodes:
        if 0 < node.looks < CERTAIN:
            looks[node.path] = looks.get(node.path, False) or not node.cut
    return [(MAIN, best(blocks, nodes)), *((IN if x else OUT, path) for path, x in looks.items())]


MAIN, IN, OUT = "main", "in", "out"


def extract(html: str | None, paths: list[str] | None, inside=(), outside=()) -> str:
    """Blocks of what the first of the winning paths leads to that has text on this page, else of the page's best element, also if the path is a part of that."""
    blocks, nodes = parse(html, frozenset(inside or ()), frozenset(outside or ()))
    if not blocks:
        return ""
    by_path = defaultdict(list)
    for text, _, open_ in blocks:
        for path in {x.path for x in open_}:
            by_path[path].append(text)
    path = next((p for p in paths or () if p in by_path), None)
    own = best(blocks, nodes)
    if path is None or own is not None and path.startswith(f"{own}/") and own.rsplit("/", 1)[-1].split(".")[0] not in ("", "html", "body"):
        path = own  # a winning path that is only a part of the page's best element does not win over it, unless that is the whole page
    return "\n\n".join(by_path.get(path) or [b[0] for b in blocks])


def host_of(url):
    """The host of a url column, lower case, without port; empty if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def winners(pages: DataFrame, share: float = SHARE) -> DataFrame:
    """(host, paths, inside, outside, n): each host's winning paths, most votes first, what its pages say of the looks of others, and its number of pages.

    Votes are summed before they are shuffled, and again by host: no task sees a host's pages."""

    def vote(batch: pa.RecordBatch) -> pa.RecordBatch:
        votes = [said(h) for h in batch.column("html").to_pylist()]
        rows = pa.array([k for k, v in enumerate(votes) for _ in v], pa.int64())
        return pa.record_batch({"host": batch.column("host").take(rows), "kind": pa.array([x for v in votes for x, _ in v], pa.string()), "path": pa.array([x for v in votes for _, x in v], pa.string())})

    # One row a host and path; several aggregates read them, and pages are parsed but once for them.
    votes = arrow_map(pages.select("host", "html"), vote, "host string, kind string, path string")
    votes = staged(votes.groupBy("host", "kind", "path").agg(F.count("*").alias("votes")), "html-votes")
    main = F.col("kind") == MAIN
    by_host = votes.where(main).groupBy("host").agg(F.sum("votes").alias("n"), F.sum(F.when(F.col("path").isNotNull(), F.col("votes"))).alias("voted"))
    wins = votes.where(main & F.col("path").isNotNull()).groupBy("host", "path").agg(F.sum("votes").alias("won"))
    yes = F.sum(F.when(F.col("kind") == IN, F.col("votes")).otherwise(0))
    looks = votes.where(~main).groupBy("host", "path").agg(yes.alias("yes"), F.sum("votes").alias("all"))
    none = F.lit(None)
    each = wins.select("host", "path", "won", none.cast("bigint").alias("yes"), none.cast("bigint").alias("all")).unionByName(looks.select("host", "path", none.cast("bigint").alias("won"), "yes", "all"))
    each = each.join(by_host, "host").where((F.col("won") >= share * F.col("voted")) | (F.col("all") >= SETTLED * F.col("n")))
    listed = lambda c: F.collect_list(F.when(c, F.col("path")))
    paths = F.sort_array(F.collect_list(F.when(F.col("won").isNotNull(), F.struct((-F.col("won")).alias("o"), "path")))).alias("p")
    inside, outside = listed(2 * F.col("yes") > F.col("all")).alias("inside"), listed(2 * F.col("yes") <= F.col("all")).alias("outside")
    won = staged(each.groupBy("host", "n").agg(paths, inside, outside).select("host", "n", F.col("p.path").alias("paths"), "inside", "outside"), "html-winners")
    discard(votes)
    return won


def extracted(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The ``keep`` columns of pages (with url and html) and their main text; a kept column named ``text`` is an error.

    Hot hosts' paths are broadcast (HOT rows at most), so only pages of other hosts are ever moved to meet them.
    """
    pages = carried(pages, keep, ("text",), host_of(F.col("url")).alias("host"), "html")
    won = winners(pages)
    total = won.agg(F.sum("n")).first()[0] or 0
    hot, rest = F.col("n") * HOT > total, ("html", "paths", "inside", "outside")
    rare = pages.join(F.broadcast(won.where(hot).select("host")), "host", "left_anti").join(won.where(~hot).drop("n"), "host", "left")
    common = pages.join(F.broadcast(won.where(hot).drop("n")), "host")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        text = [extract(*r) for r in zip(*(batch.column(c).to_pylist() for c in rest))]
        return pa.record_batch([batch.column("row"), pa.array(text, pa.string())], names=["row", "text"])

    rows = common.select("row", *rest).unionByName(rare.select("row", *rest))
    return arrow_map(rows, run, schema_with(pages, ("row",), "text string")).select("row.*", "text")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Null, empty and text-free html gives an empty text; pages without a host vote together as one host;
    repeated pages stay, and vote each; of paths with as many votes the first in the alphabet goes before.
    """
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    return extracted(pages).select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


QUERIES = {"op3_html_extraction": op3_html_extraction}
ORACLES: dict[str, str] = {}
