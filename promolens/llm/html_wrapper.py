"""HTML extraction by wrapper inference: one union-free regular expression per host.

A page becomes a stream of block tags and text slots (inline tags are transparent). A wrapper is such a stream
in nested form, where equal neighbours are folded into a repeated group. Aligning a page with the wrapper so far
keeps what matches, makes what only one of them has an optional group, folds what now repeats, and turns
text that differs into a slot; text that agrees stays a constant of the template. Slots gather the characters and link
characters that they held. Pages are folded into wrappers inside each task, wrappers of a host are then
merged in two rounds, so a host with a third of all pages meets in no single task as more than a few wrappers.

From a host's wrapper follow the groups to read. A page is read by those that it has itself: its articles (else its main
part, else groups named as content, else the body without link lists and constants; a kind without text does not count). A text is a constant or in a link list by its
place in the wrapper; a constant is left out if it stands on three pages or more that differ, and only where a page has that very text. Menus, headers outside an article, footers, sidebars, notices, adverts,
forms, scripts and comments are closed by tag or by name. Pages are read by the wrapper of their host.

Text: references are decoded, white space in a block becomes one space, blocks are joined by a line feed in page
order. Nulls: a null html gives an empty text; pages without a host share one wrapper. Whatever does not parse as a tag is
text. A wrapper's size follows the host's templates. Repeated rows are extracted each, an empty table
gives no rows, other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.llm.ids import as_long, as_text
from promolens.session import Workspace

TOKEN = re.compile(r"<!--.*?(?:-->|$)|<(script|style|noscript|template|textarea|svg|iframe)\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</\1\s*>|$)"
                   r"|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>", re.S | re.I)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
# How HTML nests, and names in use for parts of a page.
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img picture source input".split())
VOID = set("area base col embed hr input link meta param source track wbr br img".split())
ENDS_P = set("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
WALLS = {"ul", "ol", "dl", "table", "select", "article", "section", "div", "main", "body", "aside", "nav"}
CLOSED_TAGS = set("head nav footer aside form button select dialog menu object video audio canvas map".split())
CLOSED_NAMES = set("ad ads advert adverts advertisement advertising sponsored sponsor promo banner popup modal overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs footer notice cookie cookies consent alert newsletter subscribe signup comments comment respond disqus related recommended share sharing social widget pagination pager toolbar complementary contentinfo search login".split())
CONTENT_NAMES = set("content article post entry story text main body".split())
HEADERS = {"header", "masthead", "topbar"}
# Tags that no name closes, first words that turn a name round, and what makes a "related" name a list of links.
NEVER_CLOSED = {"html", "body", "main", "article"}
TURNED = {"no", "not", "without", "has", "with", "hide", "hidden"}
RELATED_LISTS = {"related", "posts", "post", "articles", "article", "links", "content", "stories", "story", "news", "reading", "items", "list", "box", "topics"}
# Groups nested deeper than this lie flat in the one at this depth, closed ones apart.
DEEP = 100
TEXT = "#"


def _names(attributes: str) -> list[str]:
    names = " ".join(a or b or c for a, b, c in NAMED.findall(attributes)).lower().split()
    words = ("-".join(w for w in re.split(r"[^a-z0-9]+", n) if w and not w.isdigit()) for n in names)
    return sorted({n for n in words if n})


def parse(page: str) -> list:
    """Nested [label, children]; a child is a node or a text with its number of link characters."""
    root = ["", []]
    stack, texts, links, in_link = [root], [], 0, False
    sealed = 0  # depth at which a closed group began among the deep ones, 0 for none

    def flush() -> None:
        nonlocal texts, links
        text = " ".join("".join(texts).split())
        if text:
            stack[-1][1].append((text, min(links, len(text))))
        texts, links = [], 0

    def add(text: str) -> None:
        nonlocal links
        text = html.unescape(text)  # a reference ends with its run of text
        texts.append(text)
        links += len(text.strip()) * in_link

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            add(page[at : m.start()])
        at, tag = m.end(), (m[3] or "").lower()
        if not tag:
            continue
        if tag in INLINE:
            in_link = not m[2] if tag == "a" else in_link
            if tag in ("br", "img"):
                texts.append(" ")
            continue
        flush()
        in_link = False
        ends = {tag} if m[2] else SAME.get(tag, set())
        for i in range(len(stack) - 1, 0, -1):
            open_tag = stack[i][0].split(".", 1)[0]
            if open_tag in ends or (not m[2] and open_tag == "p" and tag in ENDS_P):
                del stack[i:]
                sealed = sealed if sealed <= i else 0
                break
            if not m[2] and open_tag in WALLS:
                break
        if not m[2]:
            names = _names(m[4]) if "=" in m[4] else []
            node = [".".join([tag, *names]), []]
            if len(stack) <= DEEP:
                stack[-1][1].append(node)
            elif not sealed and closed(node[0], False):
                stack[-1][1].append(node)
                sealed = len(stack)
            else:
                node[1] = stack[-1][1]
            if tag not in VOID and not m[4].endswith("/"):
                stack.append(node)
    if at < len(page):
        add(page[at:])
    flush()
    return root


# A wrapper node: [label, optional, repeated, children]; a slot: [TEXT, optional, constant or None, characters, link characters, pages],
# where pages has the digests of up to ENOUGH pages that differ, so neither repeated rows nor repeats in a page count.
ENOUGH = 3


def constant(text: str) -> str:
    """A text as the wrapper keeps it: a long one by its start and digest."""
    return text if len(text) <= 80 else f"{text[:40]} {hashlib.md5(text.encode('utf-8', 'replace')).hexdigest()}"


def digest(node: list) -> str:
    """Of the texts outside closed groups, in order: pages of one digest are copies of each other."""
    md5 = hashlib.md5()

    def walk(node: list) -> None:
        for k in node[1]:
            if isinstance(k, tuple):
                md5.update(k[0].encode("utf-8", "replace") + b"\n")
            elif not closed(k[0], False):
                walk(k)

    walk(node)
    return md5.hexdigest()[:16]


def wrapper_of(node: list, page: str | None = None) -> list:
    page = digest(node) if page is None else page
    kids = [[TEXT, 0, constant(c[0]), len(c[0]), c[1], [page]] if isinstance(c, tuple) else wrapper_of(c, page) for c in node[1]]
    return [node[0], 0, 0, fold(kids)]


def fold(kids: list) -> list:
    """Equal neighbours become one repeated group."""
    out: list = []
    for k in kids:
        if out and out[-1][0] == k[0]:
            out[-1] = merge(out[-1], k)
            if k[0] != TEXT:
                out[-1][2] = 1
        else:
            out.append(k)
    return out


def merge(a: list, b: list) -> list:
    """Two nodes of one label in one."""
    optional = a[1] | b[1]
    if a[0] == TEXT:
        return [TEXT, optional, a[2] if a[2] == b[2] else None, a[3] + b[3], a[4] + b[4], sorted({*a[5], *b[5]})[:ENOUGH]]
    return [a[0], optional, a[2] | b[2], fold(align(a[3], b[3]))]


def common_runs(a: list, b: list) -> list[list[int]]:
    """Length of the longest common run of labels from each place of a and of b."""
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i][0] == b[j][0] else max(best[i + 1][j], best[i][j + 1])
    return best


def align(a: list, b: list) -> list:
    """Children in a common order: the longest common run of labels matches, the rest is optional."""
    if [x[0] for x in a] == [x[0] for x in b]:
        return [merge(x, y) for x, y in zip(a, b)]
    n, m, best = len(a), len(b), common_runs(a, b)
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and a[i][0] == b[j][0]:
            out.append(merge(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            out.append([a[i][0], 1, *a[i][2:]])
            i += 1
        else:
            out.append([b[j][0], 1, *b[j][2:]])
            j += 1
    return out


def as_expression(wrapper: list) -> str:
    """The wrapper as a regular expression over tags, for people."""
    if wrapper[0] == TEXT:
        return (wrapper[2] if wrapper[2] is not None else "#TEXT") + "?" * wrapper[1]
    inner = f"<{wrapper[0]}>" + "".join(as_expression(k) for k in wrapper[3]) + f"</{wrapper[0].split('.')[0]}>"
    return f"({inner})" + ("*" if wrapper[1] and wrapper[2] else "+" if wrapper[2] else "?") if wrapper[1] or wrapper[2] else inner


@cache
def closed(label: str, inside: bool) -> bool:
    """A group without main text: by its tag, or by a word of a whole class, id or role that says so."""
    tag, *names = label.split(".")
    if tag in CLOSED_TAGS:
        return True
    if tag in NEVER_CLOSED:
        return False
    for words in (n.split("-") for n in names):
        if words[0] not in TURNED and not CLOSED_NAMES.isdisjoint(words) and (words[0] != "related" or RELATED_LISTS.issuperset(words) or not CLOSED_NAMES.isdisjoint(words[1:])):
            return True
    return not inside and (tag == "header" or any(not HEADERS.isdisjoint(n.split("-")) for n in names))


def template_texts(node: list) -> list:
    """The wrapper less what a page is never compared with: [label, children], a slot as [TEXT, constant or None, link list or not]."""
    kids = []
    for k in node[3]:
        if k[0] == TEXT:
            kids.append([TEXT, k[2] if len(k[5]) >= ENOUGH else None, 2 * k[4] > k[3]])
        else:
            kids.append([k[0], []] if closed(k[0], False) or k[0].split(".")[0] == "article" else template_texts(k))
    some = any(k[1] is not None or k[2] if k[0] == TEXT else k[1] for k in kids)
    return [node[0], kids if some else []]


def groups_to_read(wrapper: list) -> list[str]:
    """Each kind of group with a label path that may hold the main text, and '-' before the template as JSON, for its texts to leave out."""
    found: set[str] = set()

    def walk(node: list, path: str) -> None:
        for k in node[3]:
            if k[0] == TEXT or closed(k[0], False):
                continue
            tag, *names = k[0].replace("-", ".").split(".")
            kind = "article" if tag == "article" else "main" if tag == "main" or "main" in names else "named" if not CONTENT_NAMES.isdisjoint(names) else None
            below = f"{path}/{k[0]}"
            if kind:
                found.add(f"{kind} {below}")
            walk(k, below)

    walk(wrapper, "")
    template = template_texts(wrapper)
    return sorted(found) + ([f"-{json.dumps(template, ensure_ascii=False)}"] if template[1] else [])


def at_place(kids: list, places: list) -> list:
    """For each child of a page's node its place in the template, None where it has none."""
    runs: list = []
    for c in kids:
        label = TEXT if isinstance(c, tuple) else c[0]
        if runs and runs[-1][0] == label:
            runs[-1][1] += 1
        else:
            runs.append([label, 1])
    found: list = [None] * len(runs)
    if [r[0] for r in runs] == [p[0] for p in places]:
        found = places
    elif places:
        best, i, j = common_runs(runs, places), 0, 0
        while i < len(runs) and j < len(places):
            if runs[i][0] == places[j][0]:
                found[i] = places[j]
                i, j = i + 1, j + 1
            elif best[i + 1][j] >= best[i][j + 1]:
                i += 1
            else:
                j += 1
    return [p for p, (_, n) in zip(found, runs) for _ in range(n)]


def read_page(page: str, groups: list[str]) -> str:
    """The text of the page's articles, else of its main part, else of its named groups, else the rest: the first that has any."""
    tree = parse(page)
    out: list[str] = []

    def walk(node: list, path: str, reading: bool, roots: set[str]) -> None:
        reading = reading or path in roots
        for k in node[1]:
            if isinstance(k, tuple):
                if reading:
                    out.append(k[0])
            elif not closed(k[0], reading):
                walk(k, f"{path}/{k[0]}", reading, roots)

    def walk_rest(node: list, places: list) -> None:
        for k, place in zip(node[1], at_place(node[1], places)):
            if isinstance(k, tuple):
                fixed = place is not None and place[1] == constant(k[0])
                links = place is not None and place[2] and 2 * k[1] > len(k[0])
                if not fixed and not links:
                    out.append(k[0])
            elif not closed(k[0], False):
                walk_rest(k, place[1] if place else [])

    for kind in ("article", "main", "named"):
        roots = {g.split(" ", 1)[1] for g in groups if g.startswith(f"{kind} ")}
        if roots:
            walk(tree, "", False, roots)
        if out:
            return "\n".join(out)
    walk_rest(tree, next((json.loads(g[1:])[1] for g in groups if g.startswith("-")), []))
    return "\n".join(out)


def _merged(jsons) -> str | None:
    total = None
    for j in jsons:
        w = json.loads(j)
        total = w if total is None else merge(total, w)
    return json.dumps(total, ensure_ascii=False)


def infer_wrappers(pages: DataFrame, rounds: int = 2, fan: int = 64) -> DataFrame:
    """(host, wrapper) from all pages (host, html)."""

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list] = {}
        for pdf in batches:
            for host, page in zip(pdf["host"], pdf["html"]):
                w = wrapper_of(parse(page or ""))
                held[host] = merge(held[host], w) if host in held else w
        part = TaskContext.get().partitionId()
        if held:
            yield pd.DataFrame({"host": list(held), "part": part, "wrapper": [json.dumps(w, ensure_ascii=False) for w in held.values()]})

    found = pages.mapInPandas(local, "host string, part int, wrapper string")
    for left in range(rounds - 1, -1, -1):
        part = F.floor(F.col("part") / fan).cast("int") if left else F.lit(0)
        found = found.withColumn("part", part).groupBy("host", "part").applyInPandas(
            lambda key, pdf: pd.DataFrame([(key[0], key[1], _merged(pdf["wrapper"]))], columns=["host", "part", "wrapper"]), "host string, part int, wrapper string")
    return found.select("host", "wrapper")


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    work = Workspace(pages.sparkSession)
    at = F.instr("url", "://")
    host = F.when(at > 0, F.lower(F.regexp_extract(F.expr("substring(url, instr(url, '://') + 3)"), r"^[^/?#]*", 0))).otherwise("")
    rows = pages.select("page_id", "url", "html", F.coalesce(host, F.lit("")).alias("host"))

    def chosen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"host": pdf["host"].tolist(), "groups": [groups_to_read(json.loads(w)) for w in pdf["wrapper"]]})

    groups = work.keep(infer_wrappers(rows.select("host", "html")).mapInPandas(chosen, "host string, groups array<string>"), "groups")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = [read_page(page or "", list(g)) for page, g in zip(pdf["html"], pdf["groups"])]
            yield pd.DataFrame({"page_id": pdf["page_id"].tolist(), "url": pdf["url"].tolist(), "text": texts, "n_chars": [len(t) for t in texts]})

    held = as_text(rows.join(groups, "host").select("page_id", "url", "html", "groups"), "page_id")
    return as_long(held.mapInPandas(read, "page_id string, url string, text string, n_chars long"), "page_id")
