"""Page extraction: the article element of the synthetic pages, and hand-written pages of other builds."""
import html
import re

import pytest

from vigil.llm import html_text, queries

SF = "/root/testdata/sf0.01"
P = "<p>This is a sentence of the article which is long enough to count, isn't it? Yes it is indeed.</p>"
TEXT = "This is a sentence of the article which is long enough to count, isn't it? Yes it is indeed."


def article(source):
    inner = source[source.index("<article>") + 9:source.index("</article>")]
    blocks = [" ".join(html.unescape(b.replace("<br>", " ").replace("<b>", "")).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(b for b in blocks if b)


def test_query_equals_article(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = queries.op7_html_text(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == article(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


PAGES = {
    "divs": (f"<body><div id=top><ul><li><a href=x>Home</a><li><a href=y>News</a></ul></div><div class=wrap><div class=left><a href=1>One</a></div>"
             f"<div class=c><h1>My Title</h1>{P * 3}<div><p>deep &amp; wide&nbsp;text</p></div></div><div class=sidebar><p>Sidebar text, not linked at all.</p></div></div>"
             "<div id=footer>Copyright 2020</div>", f"My Title\n{TEXT}\n{TEXT}\n{TEXT}\ndeep & wide text"),
    "comments": (f"<body><header><h2>Site</h2><a href=/>x</a></header><main><h1>T</h1>{P}<form><label>Name</label><input name=q>Send</form>"
                 f"<section id=comments><article class=comment><p>{'great post ' * 99}</p></article></section></main>", f"T\n{TEXT}"),
    "table": (f"<body><table><tr><td><a href=a>menu</a><td><h2>Head</h2>{P * 2}<ul><li>one<li>two</ul><td>side</table>", f"Head\n{TEXT}\n{TEXT}\none\ntwo"),
    "notice": (f"<body><div class='cookie-notice'>We use cookies {'bla ' * 100}</div><div class=post-content><h1>T</h1>{P}<blockquote>quote</blockquote>"
               "<pre>a  b\n c</pre></div><div class=related><a href=q>Other</a></div>", f"T\n{TEXT}\nquote\na b c"),
    "split": (f"<body><div id=a><h1>Title here</h1><div>{P}</div><figure><img src=x><figcaption>Cap tion</figcaption></figure><div>{P * 2}</div></div><nav>n</nav>",
              f"Title here\n{TEXT}\nCap tion\n{TEXT}\n{TEXT}"),
    "raw": ("<div><p>one<p>two <b>three<script>var x='<p>no</p>';</script> four <!-- <p>c</p> --> five<style>p{}</style>", "one\ntwo three four five"),
    "hidden": (f"<article><div style='display: none'>x</div><p hidden>y</p>{P}<aside>z</aside></article>", TEXT),
    "plain": ("just text &lt;b&gt; &eacute;&#8212;&#x41; here", "just text <b> é—A here"),
    "aspnet": (f"<body><form action=/><div><p>Intro words here.</p>{P}{P}</div></form>", f"Intro words here.\n{TEXT}\n{TEXT}"),
    "inline": (f"<article><p>a<b>b</b> <i>c</i>d<br>e</p>{P}</article>", f"ab cd e\n{TEXT}"),
    "advert": ("<body><div class=ad>Buy this now, it is much longer than the article, by far.</div><article><h1>A b.</h1><p>A b.</p></article><footer>f</footer>", "A b.\nA b."),
    "values": (f"<article><h1>T</h1><p>See <a href='/hidden/path'>this text</a> and <a title=\"Hidden Figures review\">that one</a>.</p><p data-hidden='false'>a</p>"
               f"<p alt='x' title='role=search hidden' >b</p>{P}</article>", f"T\nSee this text and that one.\na\nb\n{TEXT}"),
    "names": (f"<body><div><h1>T</h1>{P}<p data-id='ad-7'>a</p><section data-role='search'><p>b</p></section><p itemid=nav data-class='sidebar'>c</p>{P}</div>",
              f"T\n{TEXT}\na\nb\nc\n{TEXT}"),
    "cut": (f"<article><p title='a' HIDDEN>x</p><p hidden=''>x</p><p hidden/>x</p><div Role = search>x</div><p data-id=b id = 'ad-7'>x</p><p aria-hidden=true>x</p>"
            f"<p class=sidebar class=c>x</p><p class=c class=sidebar>y</p>{P}</article>", f"y\n{TEXT}"),
    "empty": ("<html><head><title>t</title></head><body></body></html>", ""), "nothing": ("", ""), "odd": ("<", "<"), "quote": ('<p title="a>b">x</p><p class="un>y</p>', None),
}


@pytest.mark.parametrize("name", PAGES)
def test_pages(name):
    source, want = PAGES[name]
    got = html_text.extract(source)
    assert want is None or got == want


def plain_densities(page, left, body):
    """Composite text density of every node from its own subtree, node by node."""
    import math

    def walk(i, linked):
        """(characters, tags, characters in links, links) below a node."""
        c = t = lc = lt = 0
        for x in page.items[i]:
            if isinstance(x, str):
                c += len("".join(x.split()))
                lc += len("".join(x.split())) if linked else 0
            elif left[x]:
                a = page.tag[x] == "a"
                c2, t2, lc2, lt2 = walk(x, linked or a)
                c, t, lc, lt = c + c2, t + t2 + 1, lc + lc2, lt + lt2 + a
        return c, t, lc, lt

    def linked(i):
        return i > 0 and (page.tag[i] == "a" or linked(page.parent[i]))
    cb, _, lcb, _ = walk(body, linked(body))
    out = []
    for i in range(len(page.tag)):
        c, t, lc, lt = walk(i, linked(i)) if left[i] else (0, 0, 0, 0)
        out.append(0.0 if not c else c / max(1, t) * math.log(max(1.0, c / max(1, lc) * max(1, t) / max(1, lt)))
                   / math.log(max(math.e, math.log(c / max(1, c - lc) * lc + lcb / max(1, cb) * c + math.e))))
    return out


@pytest.mark.parametrize("name", PAGES)
def test_densities_against_a_plain_version(name):
    page = html_text.Page(PAGES[name][0])
    left = html_text._prune(page)
    body = next((i for i, t in enumerate(page.tag) if t == "body"), 0)
    got, total, *_ = html_text._densities(page, left, body)
    want = plain_densities(page, left, body)
    assert got == pytest.approx(want)
    assert total == pytest.approx([sum(want[x] for x in items if isinstance(x, int)) for items in page.items])


def _constant(densities):
    def run(page, left, body):
        _, _, chars, links, anchors = densities(page, left, body)
        one = [1.0 if left[i] and chars[i] else 0.0 for i in range(len(left))]
        return one, [sum(one[x] for x in items if isinstance(x, int)) for items in page.items], chars, links, anchors
    return run


NEUTRAL = {
    "links": (f"<body><div class=x1>{'<div><a href=q>One more link</a></div>' * 30}</div><div class=x2><div>My Title</div><div>{TEXT}</div><div>{TEXT}</div><div>{TEXT}</div></div>"
              f"<div class=x3>{'<span><a href=z>far</a></span>' * 20}</div></body>", f"My Title\n{TEXT}\n{TEXT}\n{TEXT}"),
    "crumbs": (f"<body><div>{'<i><a href=q>x</a></i>' * 9}</div><section><div><div>{TEXT}</div><div>{TEXT}</div></div></section><div>{'<div>a b</div>' * 12}</div></body>", f"{TEXT}\n{TEXT}"),
}


@pytest.mark.parametrize("name", NEUTRAL)
def test_density_alone_finds_the_article(monkeypatch, name):
    """No article element, no telling names: the density decides, and constant densities pick something else."""
    source, want = NEUTRAL[name]
    assert html_text.extract(source) == want
    monkeypatch.setattr(html_text, "_densities", _constant(html_text._densities))
    assert html_text.extract(source) != want


def test_densities_matter_on_the_given_pages(spark, monkeypatch):
    """Without the lists and the article element the density still finds most articles; constant ones find none."""
    pages = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    want = [article(p) for p in pages]
    bare = [re.sub("(</?)article>", r"\1div>", p) for p in pages]
    for words in ("CUT_WORDS", "CUT_ROLES", "CUT_TALK", "CUT_MAYBE"):
        monkeypatch.setattr(html_text, words, frozenset())
    monkeypatch.setattr(html_text, "CUT_TAGS", frozenset("head script style title".split()))
    assert sum(html_text.extract(p) == w for p, w in zip(bare, want)) > 0.8 * len(pages)
    monkeypatch.setattr(html_text, "_densities", _constant(html_text._densities))
    assert sum(html_text.extract(p) == w for p, w in zip(bare, want)) < 0.1 * len(pages)


def test_deep_and_long_pages():
    deep = "<div>" * 5000 + P * 2 + "</div>" * 5000
    assert html_text.extract(deep) == f"{TEXT}\n{TEXT}"
    assert html_text.extract("<article>" + P * 20000 + "</article>").count("\n") == 19999
    assert html_text.extract("<p>" + "<b>x " * 3000) == " ".join(["x"] * 3000)


def test_edge_rows(spark):
    rows = [(1, "u", None), (1, "u", ""), (None, None, f"<article>{P}</article>"), (2, "v", P), (2, "v", P)]
    df = spark.createDataFrame([(*r, 3) for r in rows], "page_id long, url string, html string, text int")
    got = sorted((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in html_text.extract_pages(df).collect())
    assert got == sorted((i or 0, u or "", TEXT if h else "", len(TEXT) if h else 0) for i, u, h in rows)
    assert html_text.extract_pages(df.limit(0)).count() == 0
