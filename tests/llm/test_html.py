"""Wrappers inferred from pages of one host, and the main text read through them."""

import random

import pytest

from spanmill.llm import html

ARTICLE = "<h1>Title of it</h1><p>First <b>bold</b>  para&amp;graph.\n</p><p>Second<br>one.</p><ul><li>item</li></ul>"
TEXT = "Title of it\nFirst bold para&graph.\nSecond one.\nitem"
LAYOUTS = {
    "article": f"<header>Site</header><nav><ul><li>Home</li></ul></nav><article>{ARTICLE}</article><aside>More</aside><footer>&copy; us</footer>",
    "main": f"<div class='top-bar header'>Site</div><main>{ARTICLE}<form><p>Mail me</p><input></form></main><div id=footer>end</div>",
    "content class": f"<div class='nav'>menu</div><div class='post-content'>{ARTICLE}<div class='ad'>Buy</div></div><div class='sidebar'>links</div>",
    "comments": f"<article>{ARTICLE}<section class='comments'><article class='comment'><p>Nice!</p></article></section></article><div class='cookie-notice'>We use cookies</div>",
    "hidden": f"<article>{ARTICLE}<div style='display: none'>secret <p>deep</p></div><p hidden>gone</p></article>",
    "scripts": f"<script>var a='<p>no</p>';</script><style>p{{}}</style><article><!-- x <p>y</p> -->{ARTICLE}<noscript>no js</noscript></article>",
    "truncated": f"<nav>menu</nav><article>{ARTICLE}",
}


def read_alone(page):
    items = html.items_of(html.stream(page))
    import json

    return html.main_text(page, json.dumps(html.content_of(items, 1)))


@pytest.mark.parametrize("name", sorted(LAYOUTS))
def test_layouts(name):
    assert read_alone(f"<!DOCTYPE html><html><head><title>t</title></head><body>{LAYOUTS[name]}</body></html>") == TEXT


NAMED = {
    "form": f"<form id='aspnetForm'><div class='sidebar'>links</div><div class='x'>{ARTICLE}</div></form>",
    "nested": f"<form><div class='with-sidebar'>{ARTICLE}<div class='comments'>Nice!</div></div></form>",
    "layout": f"<div class='layout with-sidebar'><article>{ARTICLE}</article><div class='sidebar'>links</div></div>",
    "layout, neutral": f"<div class='layout with-sidebar'><div class='y'>{ARTICLE}</div><div class='sidebar'>links</div></div>",
    "content": f"<nav>menu</nav><div id='content' class='has-sidebar'>{ARTICLE}</div>",
    "story": f"<div class='social-story post'>{ARTICLE}</div><footer>end</footer>",
    "headline": f"<header>Site</header><div class='post'>{ARTICLE.replace('<h1>', '<header><h1>').replace('</h1>', '</h1></header>')}</div>",
}


@pytest.mark.parametrize("name", sorted(NAMED))
def test_a_name_alone_deletes_no_article(name):
    assert read_alone(f"<html><body>{NAMED[name]}</body></html>") == TEXT


def test_names_of_one_layout_among_others(spark):
    rows = [(k, "http://g.example/", f"<html><body>{LAYOUTS['article'].replace('item', f'item {k}')}</body></html>") for k in range(12)]
    rows += [(20 + k, "http://g.example/", f"<html><body>{NAMED[name]}</body></html>") for k, name in enumerate(sorted(NAMED))]
    got = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {t for k, t in got.items() if k >= 20} == {TEXT} and all(got[k] == TEXT.replace("item", f"item {k}") for k in range(12))


def page(rng, n):
    paragraphs = "".join(f"<p>text {rng.random()}</p>" for _ in range(n))
    extra = f"<div class=box>note {rng.random()}</div>" if rng.random() < 0.5 else ""
    return f"<html><body><div class=x>Same words</div>{extra}<div class=y><h1>head {rng.random()}</h1>{paragraphs}</div><div class=z>Always here</div></body></html>"


def test_wrapper_of_pages():
    rng = random.Random(1)
    pages = [page(rng, n) for n in (3, 1, 5, 2, 4, 7)]
    wrapper = html.items_of(html.stream(pages[0]))
    for p in pages[1:]:
        wrapper = html.merge(wrapper, html.items_of(html.stream(p)))
    text = html.expression(wrapper)
    assert "(<p>#PCDATA</)+" in text and "(<div.box>#PCDATA</)?" in text and "<div.x>#TEXT</" in text and "<h1>#PCDATA</" in text
    halves = [html.items_of(html.stream(p)) for p in pages]
    left, right = html.merge(html.merge(halves[0], halves[1]), halves[2]), html.merge(html.merge(halves[3], halves[4]), halves[5])
    assert html.expression(html.merge(left, right)) == text


def test_fixed_texts_are_not_the_article(spark):
    rng = random.Random(2)
    rows = [(k, f"http://a.example/{k}", page(rng, rng.randint(1, 6))) for k in range(12)]
    out = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(out) == 12
    for r in out:
        assert "Same words" not in r["text"] and "Always here" not in r["text"] and "head 0." in r["text"] and r["n_chars"] == len(r["text"])


def test_what_one_page_alone_has_is_kept(spark):
    rng = random.Random(3)
    own = "<table><tr><td>cell</td></tr></table><h2>sub</h2><blockquote>quoted</blockquote><pre>code</pre>"
    pages = [page(rng, 3) for _ in range(10)]
    pages[4] = pages[4].replace("</div><div class=z>", own + "</div><div class=z>")
    pages.append("<html><body><div class=x>Same words</div><center><h2>other layout</h2><dl><dt>term<dd>meaning</dl></center></body></html>")
    rows = [(k, f"http://f.example/{k}", p) for k, p in enumerate(pages)]
    got = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[4].endswith("cell\nsub\nquoted\ncode") and got[10] == "other layout\nterm\nmeaning"
    assert not any("Same words" in t for t in got.values())


def test_structure_tells_the_article_without_names(spark):
    rng = random.Random(4)
    words = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    rows, wanted = [], []
    for k in range(12):
        menu, ad = "".join(f"<li>menu{rng.randrange(10**6)}</li>" for _ in range(4)), f"<div class=q2>advert{rng.randrange(10**6)}</div>"
        remarks = "".join(f"<div class=k><p>remark {words(40)}</p></div>" for _ in range(rng.randrange(4)))
        own = [f"head {words(4)}", *(words(60) for _ in range(rng.randint(2, 5))), *(["cell"] if k == 5 else [])]
        body = f"<h1>{own[0]}</h1>" + "".join("<table><tr><td>cell</table>" if t == "cell" else f"<p>{t}</p>" for t in own[1:])
        lead = words(30)
        rows.append((k, f"http://n.example/{k}", f"<body><div class=q1><ul>{menu}</ul></div>{ad}<div class=q6>{lead}</div><div class=q3>{body}</div>{f'<div class=q4>{remarks}</div>' if remarks else ''}<div class=q5><ul>{menu}</ul></div></body>"))
        wanted.append("\n".join([lead, *own]))
    rows.append((12, "http://n.example/12", f"<body><div class=q1><ul><li>menu1</li></ul></div><center><p>{words(50)}</p></center></body>"))
    got = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[k] for k in range(12)] == wanted and len(got[12].split()) >= 50


def test_merging_in_rounds_reads_alike(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(k, f"http://{'ab'[k % 5 == 0]}.example/{k}", page(rng, rng.randint(1, 6))) for k in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(30)
    read = lambda: {r["page_id"]: r["text"] for r in html.extract(pages).collect()}
    whole = read()
    monkeypatch.setattr(html, "GROUP", 4)
    assert read() == whole and html.infer_wrappers(pages).groupBy("host").count().where("count > 1").isEmpty()


def test_each_page_alone_reads_differently(spark):
    """Without the host's wrapper the texts that all its pages share stay, and boxes beside the article too."""
    rng = random.Random(6)
    rows = [(k, f"http://a.example/{k}", page(rng, 4)) for k in range(12)]
    together = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all("Same words" in read_alone(p) and "Same words" not in together[k] for k, _, p in rows)


def test_pages_of_repeated_texts():
    pages = ["<body><ul><li>Go</li><li>Go</li><li>Go</li></ul><p>1</p></body>", *(f"<body><p>{k}</p></body>" for k in "234")]
    wrapper = html.items_of(html.stream(pages[0]))
    for p in pages[1:]:
        wrapper = html.merge(wrapper, html.items_of(html.stream(p)))
    assert html.content_of(wrapper, 4)[1] == []  # three times, but on one page


def test_copies_of_one_page_keep_their_text(spark):
    own = f"<html><body>{LAYOUTS['article']}</body></html>"
    out = html.extract(spark.createDataFrame([(k, "http://b.example/", own) for k in range(5)], "page_id long, url string, html string"))
    assert {r["text"] for r in out.collect()} == {TEXT}


def test_layouts_of_one_host(spark):
    rows = [(k, "http://e.example/", f"<html><body>{LAYOUTS[name]}</body></html>") for k, name in enumerate(sorted(LAYOUTS))]
    out = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(out) == len(LAYOUTS) and {r["text"] for r in out} == {TEXT}


def test_nulls_and_odd_markup(spark):
    rows = [(1, None, None), (2, "x", ""), (None, "http://c.example/a", "plain text & more"), (3, "http://c.example/b", "<p>a<p>b</div></p><b>c"), (4, "http://c.example/c", "<<>><p a='>'>q</p>"), (5, "http://d.example", "<article>" + "<p>w</p>" * 3000)]
    got = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1] == "" and got[2] == "" and "plain text & more" in got[None] and got[3].startswith("a\nb") and got[5] == "\n".join(["w"] * 3000)
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_large_wrapper_tables_join_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(html, "BROADCAST_BYTES", 0)
    own = f"<html><body>{LAYOUTS['main']}</body></html>"
    out = html.extract(spark.createDataFrame([(k, f"http://h{k % 3}.example/", own) for k in range(30)], "page_id long, url string, html string")).collect()
    assert len(out) == 30 and {r["text"] for r in out} == {TEXT}
