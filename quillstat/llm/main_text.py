"""Main text of web pages by wrappers inferred per host.

Pages of one host are aligned one after another into a union-free expression with optional
and repeated groups and text slots (``page_trees``). A page is then read along its host's
wrapper, its siblings aligned in order with the wrapper's. Its article is the ``article``, ``main`` or named content element, or the body. From
it go elements that are page furniture by their element name or by a whole name (or one of a
closed list of compounds) of their class, id or role, inside an article by few such names only; texts that the wrapper shows to be the same on ``EVIDENCE`` or more distinct pages of
the host, where other texts differ; and lists that are nothing but links.

Wrappers are made like sums: each task aligns the pages it reads, host by host, and hands on
what it has when it holds many hosts; partial wrappers are merged in two steps, so a host with
a third of all pages never meets in one task. They are broadcast if their measured size is at
most ``BROADCAST_BYTES``, and joined by host beyond that.

Defined cases: markup may nest to any depth; null html is empty and gives an empty text; a null or odd url has host "" and
its pages share one wrapper; cut-off and unbalanced markup is read as far as it goes; pages
that repeat count once as evidence and give repeated rows; an empty table gives an empty
result; other columns play no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstat.llm.common import cut, small_batches, text_or_empty
from quillstat.llm.page_trees import EVIDENCE, GROUP_LENGTHS, as_wrapper, from_json, merge, page_mark, page_tree, to_json

HOSTS_HELD = 500
PARTS = 64
BROADCAST_BYTES = 32 << 20
LINK_SHARE = 0.8

# Elements that hold no article text, and words of class, id and role that say so.
FURNITURE = frozenset("nav footer aside form menu button dialog fieldset head header figcaption audio video map datalist".split())
FURNITURE_WORDS = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising advertorial sponsor sponsored promo promotion banner "
    "banners nav navbar navigation navi menu menus menubar breadcrumb breadcrumbs crumbs footer foot header masthead "
    "topbar toolbar sidebar sidebars side rail aside widget widgets cookie cookies consent gdpr notice notices notification "
    "alert popup modal overlay newsletter subscribe subscription signup login signin search share sharing social follow "
    "related recommended recommendations more-articles trending popular pagination pager paging comment comments commentlist "
    "reply replies respond disqus discussion reviews tags taglist byline metadata copyright legal disclaimer complementary "
    "contentinfo skip skiplink".split())
#: Compounds that say the same; any other compound (has-sidebar, share-price) says nothing.
FURNITURE_COMPOUNDS = frozenset(
    [f"{a}-{b}" for a in "main site page top bottom left right primary secondary global mobile header footer side".split()
     for b in "nav navbar navigation menu menubar sidebar footer banner toolbar breadcrumb breadcrumbs rail".split()]
    + [f"{a}-{b}" for a in "ad ads advert advertisement sponsor sponsored promo".split()
       for b in "slot unit box container banner block wrapper label content area".split()]
    + [f"{a}-{b}" for a in "cookie cookies consent gdpr".split() for b in "notice banner bar popup consent message overlay".split()]
    + [f"{a}-{b}" for a in "share sharing social follow".split() for b in "bar buttons icons links media tools widget".split()]
    + [f"{a}-{b}" for a in "related recommended popular trending".split() for b in "posts articles stories links content".split()]
    + ("site-header page-footer nav-bar nav-menu nav-links footer-links newsletter-signup newsletter-form subscribe-form login-form "
       "signup-form search-form search-box search-bar skip-link skip-links skip-to-content comment-list comment-form comments-area "
       "comments-section comments-list side-bar tag-list social-share").split())
OUTER_WORDS = FURNITURE_WORDS | FURNITURE_COMPOUNDS
#: Inside an article only these names, of elements that hold others, say so; for the rest the wrapper decides.
INNER_WORDS = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising sponsored nav navbar navigation menu breadcrumb breadcrumbs sidebar "
    "sidebars cookie cookies newsletter pagination comment comments commentlist disqus skiplink".split()) | FURNITURE_COMPOUNDS
HOLDERS = frozenset("div section ul ol table".split())
CONTENT_WORDS = frozenset("article content main post entry story body text page-content main-content post-content "
                          "entry-content article-body story-body post-body".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
WORDS = re.compile(r"[a-z0-9]+(?:-[a-z0-9]+)*")
NUMBERED = re.compile(r"-?9+$")


def _named(label: str, words: frozenset) -> bool:
    names = label.split(" ", 1)[1] if " " in label else ""
    for whole in WORDS.findall(names.replace("_", "-")):
        if whole in words or any(part in words for part in whole.split("-")):
            return True
    return False


def _called(label: str, words: frozenset) -> bool:
    """One of the whole names of class, id and role, without a number at its end, is among the words."""
    names = label.split(" ", 1)[1] if " " in label else ""
    return any(NUMBERED.sub("", whole) in words for whole in WORDS.findall(names.replace("_", "-")))


@lru_cache(maxsize=4096)
def _is_furniture(label: str, in_article: bool) -> bool:
    name = label.split(" ", 1)[0]
    if name in FURNITURE and not (in_article and name in ("header", "figcaption")):
        return True
    if name == "article":
        return _called(label, frozenset(("comment", "comments", "reply", "related", "promo", "ad", "sponsored")))
    if in_article:
        return name in HOLDERS and _called(label, INNER_WORDS)
    return name not in ("main", "body", "html", "") and _called(label, OUTER_WORDS)


def _lengths(tree: list) -> dict[int, tuple[int, int]]:
    """(characters, characters in links) of every subtree, by its id."""
    order, stack = [], [tree]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += node[5]
    sizes: dict[int, tuple[int, int]] = {}
    for node in reversed(order):
        if node[0] == "#text":
            sizes[id(node)] = len(node[3]), min(node[4][0], len(node[3]))
        else:
            sizes[id(node)] = sum(sizes[id(k)][0] for k in node[5]), sum(sizes[id(k)][1] for k in node[5])
    return sizes


def _roots(tree: list) -> tuple[list[list], set[int]]:
    """The elements that hold the article, in page order, and the ids of the elements around them.

    Of elements named as content those inside another one are a part of it, all others count.
    Those inside page furniture count only where there are none outside of it.
    """
    found: dict[tuple[bool, str], list[list]] = {}
    parent: dict[int, int] = {}
    stack = [(kid, False, frozenset(), id(tree)) for kid in reversed(tree[5])]
    while stack:
        kid, hidden, inside, above = stack.pop()
        name = kid[0].split(" ", 1)[0]
        within = hidden or _is_furniture(kid[0], False)
        parent[id(kid)] = above
        if name == "article":
            if not _is_furniture(kid[0], False):
                found.setdefault((within, "article"), []).append(kid)
            continue
        kinds = inside
        if name == "main" or _called(kid[0], frozenset(("main",))):
            kinds |= {(within, "main")}
        if name in ("main", "div", "section", "td") and _named(kid[0], CONTENT_WORDS) or _named(kid[0], frozenset(("main",))):
            kinds |= {(within, "named")}
        for kind in kinds - inside:
            found.setdefault(kind, []).append(kid)
        stack += [(k, within, kinds, id(kid)) for k in reversed(kid[5])]

    for hidden, kind in ((False, "article"), (False, "main"), (False, "named"), (True, "article"), (True, "main")):
        if (hidden, kind) in found:
            outer: set[int] = set()
            for root in found[hidden, kind]:
                above = parent[id(root)]
                while above in parent and above not in outer:
                    outer.add(above)
                    above = parent[above]
            return found[hidden, kind], outer
    return [tree], set()


def _own_text(node: list) -> str | None:
    """The text of a text node, or of an element that holds nothing else."""
    while node[0] != "#text" and len(node[5]) == 1:
        node = node[5][0]
    return node[3] if node[0] == "#text" else None


def _runs(kids: list[list]) -> list[tuple]:
    """A page's siblings collapsed as ``collapse`` does it: (label, elements, parts of a group)."""
    out: list[tuple] = []
    for kid in kids:
        if out and out[-1][0] == kid[0]:
            out[-1][1].append(kid)
        else:
            out.append((kid[0], [kid], []))
    for n in GROUP_LENGTHS:
        k = 0
        while k + 2 * n <= len(out):
            names = [x[0] for x in out[k:k + n]]
            times = 1
            while [x[0] for x in out[k + times * n:k + (times + 1) * n]] == names:
                times += 1
            if times > 1 and len(set(names)) > 1:
                rows = [out[k + t * n:k + (t + 1) * n] for t in range(times)]
                parts = [(x[0][0], [e for y in x for e in y[1]], [p for y in x for p in y[2]]) for x in zip(*rows)]
                out[k:k + times * n] = [("*" + "|".join(names), [], parts)]
            k += 1
    return out


def _grouped_runs(runs: list[tuple], wrapper: list[list]) -> list[tuple]:
    """Single occurrences of the wrapper's groups wrapped, as ``align`` does it."""
    for group in [w[0] for w in wrapper if w[0][:1] == "*"]:
        names = group[1:].split("|")
        k = 0
        while k + len(names) <= len(runs):
            if [x[0] for x in runs[k:k + len(names)]] == names:
                runs = [*runs[:k], (group, [], runs[k:k + len(names)]), *runs[k + len(names):]]
            k += 1
    return runs


def _flat(nodes: list) -> list:
    return [k for n in nodes for k in (_flat(n[5]) if n[0][:1] == "*" else [n])]


def _placed(kids: list[list], wrapper: list | None) -> dict[int, list]:
    """The wrapper's node of each child of a page's element, by the child's id.

    Both lists of siblings are aligned in order, with a page's runs and groups collapsed as
    when the wrapper was built. Of equally long alignments one with more equal texts is taken.
    A child that has no partner may still equal one that stands between its neighbours' partners.
    """
    found: dict[int, list] = {}
    if wrapper is None or not wrapper[5] or not kids:
        return found

    def put(run: tuple, node: list) -> None:
        for kid in run[1]:
            found[id(kid)] = node
        for part, own in zip(run[2], node[5]):
            if part[0] == own[0]:
                put(part, own)

    nodes = wrapper[5]
    runs = _runs(kids)
    if [r[0] for r in runs] == [w[0] for w in nodes]:
        for run, node in zip(runs, nodes):
            put(run, node)
        return found
    runs = _grouped_runs(runs, nodes)
    n, m = len(runs), len(nodes)
    texts = [{t for t in map(_own_text, r[1]) if t is not None} for r in runs]
    fixed = [_own_text(w) for w in nodes]
    best = [[(0, 0)] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            score = max(best[i + 1][j], best[i][j + 1])
            if runs[i][0] == nodes[j][0]:
                long, equal = best[i + 1][j + 1]
                score = max(score, (long + 1, equal + (fixed[j] in texts[i])))
            best[i][j] = score
    i = j = 0
    last, loose = 0, []

    def put_loose(upto: int) -> None:
        between = _flat(nodes[last:upto])
        for kid in (k for r in loose for k in _elements(r)):
            for node in between:
                if node[0] == kid[0] and _own_text(kid) is not None and _own_text(kid) == _own_text(node):
                    found[id(kid)] = node
                    break
        loose.clear()

    while i < n:
        equal = j < m and runs[i][0] == nodes[j][0]
        if equal and best[i][j] == (best[i + 1][j + 1][0] + 1, best[i + 1][j + 1][1] + (fixed[j] in texts[i])):
            put_loose(j)
            put(runs[i], nodes[j])
            i, j = i + 1, j + 1
            last = j
        elif j < m and best[i][j] == best[i][j + 1]:
            j += 1
        else:
            loose.append(runs[i])
            i += 1
    put_loose(m)
    return found


def _elements(run: tuple) -> list[list]:
    return run[1] + [k for part in run[2] for k in _elements(part)]


def _varies(wrapper: list) -> bool:
    stack = [wrapper]
    while stack:
        node = stack.pop()
        if node[0] == "#text" and node[3] is None:
            return True
        stack += node[5]
    return False


def _repeated(text: str, node: list | None) -> bool:
    """This text stands on enough distinct pages at its place to be the host's and not the article's."""
    return node is not None and node[3] == text and len(node[4]) >= EVIDENCE


def main_text(page: str, wrapper: list | None) -> str:
    tree = page_tree(page)
    held, outer = _roots(tree)
    roots = {id(r) for r in held}
    shared = wrapper if wrapper is not None and _varies(wrapper) else None
    lengths: dict[int, tuple[int, int]] = {}
    blocks: list[str] = []
    stack = [(iter(tree[5]), _placed(tree[5], wrapper), id(tree) in roots, False)]
    while stack:
        kids, placed, inside, title_only = stack[-1]
        kid = next(kids, None)
        if kid is None:
            stack.pop()
            continue
        label = kid[0]
        name = label.split(" ", 1)[0]
        own = placed.get(id(kid))
        within = inside or id(kid) in roots
        if label == "#text":
            if inside and not title_only and not (shared is not None and _repeated(kid[3], own)):
                blocks.append(kid[3])
            continue
        if id(kid) not in outer and id(kid) not in roots and _is_furniture(label, within):
            continue
        if within and name in ("ul", "ol"):
            lengths = lengths or _lengths(tree)
            total, linked = lengths[id(kid)]
            if total and linked >= LINK_SHARE * total and len(kid[5]) > 1:
                continue
        only = title_only and name not in HEADINGS or within and name == "header"
        stack.append((iter(kid[5]), _placed(kid[5], own), within, only))
    return "\n".join(blocks)


def host_wrappers(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """host, wrapper (JSON): one row per host."""
    small_batches(pages.sparkSession)

    def infer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list] = {}
        marks: dict[str, set[int]] = {}
        for batch in batches:
            for host, page in zip(batch["host"], batch["html"]):
                mark = page_mark(page)
                seen = marks.setdefault(host, set())
                if mark in seen:
                    continue
                if len(seen) < 10_000:
                    seen.add(mark)
                own = as_wrapper(page_tree(page), mark)
                held[host] = merge(held[host], own) if host in held else own
            if len(held) >= HOSTS_HELD:
                yield _frame(held)
                held, marks = {}, {}
        if held:
            yield _frame(held)

    def combine(keys: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        whole = None
        for body in sorted(rows["wrapper"]):
            whole = from_json(body) if whole is None else merge(whole, from_json(body))
        return pd.DataFrame({"host": [keys[0]], "wrapper": [to_json(whole)]})

    schema = "host string, wrapper string"
    parts = _by_host(pages, url, html).mapInPandas(infer, schema)
    some = parts.groupBy("host", F.pmod(F.xxhash64("wrapper"), F.lit(PARTS)).alias("_part")).applyInPandas(combine, schema)
    return cut(some.groupBy("host").applyInPandas(combine, schema))


def _frame(held: dict[str, list]) -> pd.DataFrame:
    return pd.DataFrame({"host": list(held), "wrapper": [to_json(w) for w in held.values()]})


def _by_host(pages: DataFrame, url: str, html: str, *others: str) -> DataFrame:
    host = F.lower(F.regexp_extract(text_or_empty(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)", 1))
    return pages.select(*others, host.alias("host"), text_or_empty(html).alias("html"))


def extract_main_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """key, url, text, n_chars of every row of ``pages``."""
    wrappers = host_wrappers(pages, url, html)
    size = wrappers.agg(F.coalesce(F.sum(F.octet_length("wrapper")), F.lit(0))).first()[0]
    rows = _by_host(pages.select(F.col(key).cast("long").alias(key), F.col(url).alias(url), F.col(html).alias("_html")), url, "_html", key, url)
    joined = rows.join(F.broadcast(wrappers) if size <= BROADCAST_BYTES else wrappers, "host", "left")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, list] = {}
        for batch in batches:
            texts = []
            for host, body, page in zip(batch["host"], batch["wrapper"], batch["html"]):
                if host not in known:
                    if len(known) >= HOSTS_HELD:
                        known.clear()
                    known[host] = from_json(body) if isinstance(body, str) else None
                texts.append(main_text(page, known[host]))
            yield pd.DataFrame({key: batch[key].astype("Int64"), url: batch[url], "text": texts, "n_chars": [len(t) for t in texts]})

    return joined.select(key, url, "host", "wrapper", "html").mapInPandas(
        read, f"`{key}` long, `{url}` string, text string, n_chars long")
