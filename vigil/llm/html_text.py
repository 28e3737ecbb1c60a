"""Main text of web pages by composite text density.

A page is parsed into a tree (optional end tags and unclosed inline tags as browsers
treat them).  Elements that are never part of an article (menus, footers, forms,
adverts, comments, ...: by tag, role, class or id) are cut off.  For every remaining node the
composite text density weighs its characters per tag by its links:

    C / T * log_base(C / LC * T / LT),   base = ln(C / (C - LC) * LC + LCb / Cb * C + e), e at least

with ``LC``/``LT`` link characters and tags and ``LCb``/``Cb`` those of the body.  The
node with the largest sum of child densities is the core of the article; the least density on the
path from it to the body is the threshold that a neighbouring node needs to
belong to the article too.  That selects the subtree on every page; an article element only settles
ties, for what stands beside the core inside it: parts below the threshold stay unless they are lists of links.

Pages are independent: the work is one map over the table, without a shuffle.
"""
from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Element names by how a browser treats them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike "
                   "strong sub sup time tt u var wbr br img".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                     "header hgroup hr main menu nav ol p pre search section summary table ul".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
            "option": ("option",), "thead": ("thead", "tbody", "tfoot", "tr", "td", "th"), "tbody": ("thead", "tbody", "tfoot", "tr", "td", "th"),
            "tfoot": ("thead", "tbody", "tfoot", "tr", "td", "th")}
SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",),
          "thead": ("table",), "tbody": ("table",), "tfoot": ("table",)}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_PARTS = INLINE | HEADINGS | frozenset("p li ul ol dl dt dd blockquote pre tr thead tbody tfoot".split())  # never an article by themselves

# What is not part of an article, by element, role, and word of class or id.
CUT_TAGS = frozenset("head title script style noscript template svg canvas iframe object embed audio video map nav footer aside menu dialog "
                     "button select textarea input option datalist".split())
CUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
CUT_WORDS = frozenset("nav navbar navigation menu menubar submenu breadcrumb breadcrumbs masthead footer sidebar sidenav aside ad ads adv advert adverts "
                      "advertisement advertising adsense sponsor sponsored sponsors promo promotion cookie cookies consent gdpr popup modal overlay "
                      "newsletter subscribe signup login share sharing social related recommended recommendations pagination pager toolbar copyright".split())
CUT_TALK = frozenset("comment comments commentlist disqus replies respond discussion".split())
CUT_MAYBE = frozenset("header banner notice notices alert warning search widget widgets disclaimer announcement".split())
CONTENT_WORDS = frozenset("article post entry content story main body text page".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+>?""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"?|'([^']*+)'?|([^\s>]++)))?""")
_READ = frozenset("class id role style hidden aria-hidden".split())
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"(?i)display\s*:\s*none|visibility\s*:\s*hidden")


class Page:
    """A parsed page: nodes in document order (node 0 is the root), each with its
    parent, tag, attributes and the items (texts and child numbers) inside."""

    def __init__(self, source: str):
        self.tag, self.parent, self.attrs, self.items = ["#root"], [-1], [""], [[]]
        stack, at = [0], 0
        for m in _TOKEN.finditer(source):
            if m.start() < at:
                continue  # inside a raw element
            if m.start() > at:
                self._text(stack[-1], source[at:m.start()])
            at = m.end()
            name = (m.group(2) or m.group(5) or "").lower()
            if not name:
                continue
            if m.group(1) or m.group(4):
                self._end(stack, name)
                continue
            attrs = m.group(3) if m.group(2) else m.group(6)
            self._implied_end(stack, name)
            node = len(self.tag)
            self.tag.append(name)
            self.parent.append(stack[-1])
            self.attrs.append(attrs)
            self.items.append([])
            self.items[stack[-1]].append(node)
            if name in RAW:
                end = re.compile(rf"(?i)</{re.escape(name)}(?=[\s/>])").search(source, at)
                at = end.start() if end else len(source)
            elif name not in VOID and not (attrs.endswith("/") and name in ("svg", "path", "use", "circle", "rect")):
                stack.append(node)
                continue
            if name in RAW:
                stack.append(node)
        if at < len(source):
            self._text(stack[-1], source[at:])

    def _text(self, node: int, raw: str) -> None:
        self.items[node].append(html.unescape(raw) if "&" in raw else raw)

    def _implied_end(self, stack: list[int], name: str) -> None:
        if name in CLOSES_P:
            for k in range(len(stack) - 1, 0, -1):
                tag = self.tag[stack[k]]
                if tag == "p":
                    del stack[k:]
                    break
                if tag not in INLINE and tag not in HEADINGS:
                    break
        if name in HEADINGS and self.tag[stack[-1]] in HEADINGS:
            stack.pop()
        if name in SIBLINGS:
            for k in range(len(stack) - 1, 0, -1):
                tag = self.tag[stack[k]]
                if tag in SCOPES[name]:
                    break
                if tag in SIBLINGS[name]:
                    del stack[k:]
                    if name not in ("tr", "thead", "tbody", "tfoot"):
                        break
                    return self._implied_end(stack, name)

    def _end(self, stack: list[int], name: str) -> None:
        for k in range(len(stack) - 1, 0, -1):
            tag = self.tag[stack[k]]
            if tag == name:
                del stack[k:]
                return
            if name in INLINE and tag not in INLINE:
                return  # an inline end tag doesn't close blocks
            if tag in ("table", "td", "th") and name not in ("table", "tr", "tbody", "thead", "tfoot", "html", "body", "div", "section", "article", "main"):
                return


def _attributes(raw: str) -> dict[str, str]:
    if not raw or raw.isspace():
        return {}
    out: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(raw):  # each consumed whole, so nothing inside a value is taken for an attribute
        if (name := name.lower()) in _READ:
            out.setdefault(name, "".join(values))  # of repeated ones the first counts
    return out


def _why_cut(tag: str, raw: str) -> str | None:
    """None, or why an element is cut off: "sure", "words", "talk" or "maybe"."""
    if tag in CUT_TAGS:
        return "sure"
    if tag == "form":
        return "words"
    a = _attributes(raw)
    if not a:
        return None
    if "hidden" in a or a.get("aria-hidden") == "true" or _HIDDEN.search(a.get("style", "")):
        return "sure"
    if tag in ("html", "body", "main") or tag in HEADINGS:
        return None
    if a.get("role", "").lower() in CUT_ROLES:
        return "words"
    words = {w.lower() for w in _WORDS.findall(a.get("class", "") + " " + a.get("id", ""))}
    if words & CUT_TALK:
        return "talk"
    if tag != "article" and words & CUT_WORDS:
        return "words"
    if tag != "article" and words & CUT_MAYBE and not words & CONTENT_WORDS:
        return "maybe"
    return None


def _prune(page: Page) -> list[bool]:
    """Whether each node is left. A node cut for its words stays if it holds the page's
    title or article, or, on a page with neither, most of the text (unless it is reader comments)."""
    n = len(page.tag)
    why = [_why_cut(t, a) for t, a in zip(page.tag, page.attrs, strict=True)]
    in_article = [False] * n
    for i in range(1, n):
        in_article[i] = in_article[page.parent[i]] or page.tag[page.parent[i]] in ("article", "main")
        if page.tag[i] == "header" and why[i] is None and not in_article[i]:
            why[i] = "maybe"
        elif page.tag[i] == "header" and why[i] == "maybe" and in_article[i]:
            why[i] = None
    surely = [False] * n
    chars, core = [0] * n, [False] * n
    for i in range(1, n):
        surely[i] = surely[page.parent[i]] or why[i] == "sure"
    for i in range(n - 1, -1, -1):
        if surely[i]:
            continue
        chars[i] += sum(len("".join(x.split())) for x in page.items[i] if isinstance(x, str))
        if page.tag[i] in ("h1", "main") or page.tag[i] == "article" and why[i] is None:
            core[i] = True
        if i:
            chars[page.parent[i]] += chars[i]
            core[page.parent[i]] |= core[i] and why[i] != "talk"
    left = [True] * n
    for i in range(1, n):
        cut = why[i] == "sure" or why[i] == "talk" and not core[i] or why[i] in ("words", "maybe") and not core[i] and (
            core[0] or 3 * chars[i] <= 2 * chars[0])
        left[i] = left[page.parent[i]] and not cut
    return left


def _densities(page: Page, left: list[bool], body: int) -> tuple[list[float], list[float], list[int], list[int], list[int]]:
    """Of every node: composite text density, the sum of its children's, characters, characters in links, links."""
    n = len(page.tag)
    c, t, lc, lt = [0] * n, [0] * n, [0] * n, [0] * n
    linked = [False] * n
    for i in range(1, n):
        linked[i] = linked[page.parent[i]] or page.tag[i] == "a"
    for i in range(n - 1, -1, -1):
        if not left[i]:
            continue
        c[i] += sum(len("".join(x.split())) for x in page.items[i] if isinstance(x, str))
        if linked[i]:
            lc[i] = c[i]
        if i:
            p = page.parent[i]
            c[p] += c[i]
            t[p] += t[i] + 1
            lc[p] += lc[i] if not linked[p] else 0
            lt[p] += lt[i] + (page.tag[i] == "a")
    share = lc[body] / max(1, c[body])
    density, total = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        if left[i] and c[i]:
            base = max(math.e, math.log(c[i] / max(1, c[i] - lc[i]) * lc[i] + share * c[i] + math.e))
            value = max(1.0, c[i] / max(1, lc[i]) * max(1, t[i]) / max(1, lt[i]))
            density[i] = c[i] / max(1, t[i]) * math.log(value) / math.log(base)
        if i:
            total[page.parent[i]] += density[i]
    return density, total, c, lc, lt


def _chosen(page: Page, left: list[bool]) -> list[int]:
    """Nodes whose whole (pruned) subtrees are the article, in page order."""
    n = len(page.tag)
    body = next((i for i in range(n) if page.tag[i] == "body"), 0)
    density, total, chars, links, anchors = _densities(page, left, body)
    depth = [0] * n
    inside = [body == 0] * n
    for i in range(1, n):
        depth[i] = depth[page.parent[i]] + 1
        inside[i] = i == body or inside[page.parent[i]] or body == 0
    core = max((i for i in range(n) if left[i] and inside[i] and total[i] > 0), key=lambda i: (total[i], depth[i]), default=None)
    if core is None:
        return [body]
    path = [core]
    while path[-1] > 0 and path[-1] != body:
        path.append(page.parent[path[-1]])
    threshold = min(density[i] for i in path)
    own = next((f for f in ([i for i in path if page.tag[i] == tag] for tag in ("article", "main")) if f), [])
    article = own[-1] if own else None
    top = core
    while page.tag[top] in _PARTS and top not in (0, body):
        top = page.parent[top]
    # what stands beside the core or one of its wrappers belongs to it if it is dense enough, and a title before it always does;
    # a wrapper that has such parts and no menu of links is the article itself
    out, node = [top], top
    while node not in (0, body):
        up, before, more, menu = page.parent[node], True, [], False
        for x in page.items[up]:
            if x == node:
                before = False
            elif isinstance(x, int) and left[x]:
                listed = 2 * links[x] > chars[x]
                if article is not None and depth[up] >= depth[article]:   # inside the article element
                    listed &= density[x] < threshold and anchors[x] > 1
                    if not listed:
                        more.append(x)
                elif page.tag[x] in HEADINGS and before or density[x] >= max(threshold, 0.5 * density[core]):
                    more.append(x)
                menu |= listed
        if more or up == article and not menu and len(out) == 1 and out[0] == node:
            out = [up] if not menu and up not in (0, body) and len(out) == 1 and out[0] == node else out + more
        node = up
    return sorted(out)


def extract(source: str | None) -> str:
    """The main text of a page: its blocks, white space collapsed, joined by line breaks."""
    if not source:
        return ""
    page = Page(source)
    left = _prune(page)
    blocks: list[str] = []
    run: list[str] = []

    def flush() -> None:
        text = " ".join("".join(run).split())
        if text:
            blocks.append(text)
        run.clear()

    for root in _chosen(page, left):
        flush()
        todo: list[object] = [root]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                run.append(x)
            elif x is None:
                flush()
            elif left[x] or x == root:
                if page.tag[x] == "br":
                    run.append(" ")
                elif page.tag[x] not in INLINE:
                    flush()
                    todo.append(None)
                todo.extend(reversed(page.items[x]))
    flush()
    return "\n".join(blocks)


def text_column(source: Column) -> Column:
    """Main text of a column of pages; null pages give the empty string."""
    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:
            yield pa.array([extract(x.as_py()) for x in b], pa.string())

    return run(source.cast("string"))


def extract_pages(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row, also repeated ones and null ids;
    null, empty and textless pages have an empty text; other columns are not returned."""
    return (df.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), text_column(F.col(html_col)).alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
