import re
from html import unescape

import pyarrow.parquet as pq

from millrace.llm import html_text as ht


def text(html, templates=()):
    root = ht.parse(html)
    ht.subtree_hashes(root)
    return ht.main_text(root, set(templates))


def plain(html):
    """Of the test pages, whose articles hold paragraphs only."""
    m = re.search(r"<article>(.*?)(?:</article>|$)", html, re.S)
    blocks = re.split(r"</?(?:h1|p)>", m[1]) if m else []
    return "\n\n".join(t for b in blocks if (t := re.sub(r"\s+", " ", unescape(re.sub(r"<br>", " ", re.sub(r"<[^>]*>?", lambda x: " " if x[0] == "<br>" else "", b)))).strip()))


def test_equals_plain_version(spark, sf):
    pages = {r["page_id"]: r["html"] for r in pq.read_table(f"{sf}/pages.parquet").to_pylist()}
    rows = ht.op7_html_text(spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == plain(pages[r.page_id]), r.page_id
        assert r.n_chars == len(r.text)


def test_structure():
    assert text("<body><nav><ul><li>Menu</ul></nav><header>Top</header><main><p>One &amp; two<p>Three<br>four&nbsp;five</main><footer>x</footer>") == "One & two\n\nThree four five"
    assert text("<div>a<div class='cookie-banner'>no</div>b</div><aside>c</aside>") == "a\n\nb"
    assert text("<article><h1>T</h1><div id=comments><p>me too</div><p>x<script>var a='</p>'</script>y</p><form>f</form></article>rest") == "T\n\nxy"
    assert text("<ul><li>a<ul><li>b</ul><li>c</ul><table><tr><td>1<td>2<tr><td>3</table>") == "a\n\nb\n\nc\n\n1\n\n2\n\n3"
    assert text("a < b <3 &lt;p&gt; <!-- no --> <![CDATA[x & y]]>") == "a < b <3 <p> x & y"
    assert text("<p>cut off &am") == "cut off &am" and text("<p>ok</p><di") == "ok" and text('<p title="a>b">t</p>') == "t"
    assert text("<div>" * 30000 + "deep") == "deep" and text(None) == "" and text("<script>x") == ""


def test_comments_are_no_articles():
    assert text('<article><p>one</p></article><article class="comment"><p>reader</p></article>') == "one"
    assert text('<article><p>one</p><article class="comment-body depth-1" id=comment-7><h2>Re</h2><p>reader</p></article><p>two</p></article>') == "one\n\ntwo"
    assert text('<article><p>one</p><div itemscope itemtype="https://schema.org/Comment"><p>reader</p></div><p class="reply">so am I</p></article>') == "one"
    assert text('<main><p>one</p></main><article id="comment-3"><p>reader</p></article>') == "one"
    for own in ("has-comments", "post comments-open", "no-comments", "commentary", "with_comments", "sidebar-left", "share"):
        assert text(f'<article class="{own}"><p>one</p></article>') == "one", own
    assert text('<article><article class="part"><p>one</p></article><article class="part"><p>two</p></article></article>') == "one\n\ntwo"


def test_headings_and_paragraphs_of_an_article_are_text():
    page = '<article><header class="entry-header" role=banner><h1>Title</h1></header><h2 class="section-header">Part</h2><p class="related">near</p><p class="alert">mind</p><div class="header"><h3 id=notice>Sub</h3></div><blockquote class="promo">said</blockquote>{}</article>'
    want = "Title\n\nPart\n\nnear\n\nmind\n\nSub\n\nsaid"
    assert text(page.format("")) == want
    assert text(page.format('<div class="related"><p>see</p></div><p class="ad">buy</p><p role=alert>cookie</p><div class="share">s</div><footer>f</footer><nav>n</nav>')) == want
    assert text('<header class="entry-header"><h1>Site</h1></header><p class="alert">We use cookies</p><p>text</p>') == "text"


def test_formulas_and_stand_ins_are_text():
    assert text("<article><p>so <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> holds</p></article>") == "so x=2 holds"
    assert text('<article><object data="a.svg"><p>A chart of rain</p></object><map name=m><p>Areas: <a>north</a></p></map><svg><text>no</text></svg></article>') == "A chart of rain\n\nAreas: north"


def test_templates(spark):
    rows = [(i, f"http://H.example:80/{i}", f"<body><div>We sell stamps</div><div>{i}</div><article><p>Shared passage</p><p>own {i}</p><section>Read more</section></article></body>") for i in range(30)]
    rows += [(100 + i, f"https://u@o.example?{i}", f"<body><div>We sell stamps</div><p>solo {i}</p></body>") for i in range(3)]
    rows += [(200, None, None), (201, "x", ""), (201, "x", ""), (None, "", "<p>n")] + [(300 + i, "http://same.example/a", "<div>whole page</div>") for i in range(40)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, host string")
    got = {}
    for r in ht.extract(df).collect():
        got.setdefault(r.page_id, []).append(r.text)
    assert got[3] == ["Shared passage\n\nown 3"] and got[100] == ["We sell stamps\n\nsolo 0"]
    assert got[200] == [""] and got[201] == ["", ""] and got[None] == ["n"] and got[300] == ["whole page"]
    assert ht.extract(df.limit(0)).count() == 0


def test_templates_of_large_hosts(spark, monkeypatch):
    rows = [(i, f"http://big.example/{i}", f"<body>{'<div>We sell stamps</div>' if i < 9 else '<div>Seven</div>' if i < 16 else ''}<p>own {i}</p></body>") for i in range(100)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = {i: f"Seven\n\nown {i}" if 9 <= i < 16 else f"own {i}" for i in range(100)}
    assert {r.page_id: r.text for r in ht.extract(df).collect()} == want
    monkeypatch.setattr(ht, "HOST_TEMPLATES", 0)
    assert {r.page_id: r.text for r in ht.extract(df).collect()} == want


def test_templates_decide_where_no_rule_does(spark):
    """Pages without an article whose menus, notices and adverts bear neutral names: counting alone can tell."""
    def page(i):
        menu = "<div class=x1><ul><li><a>Home</a><li><a>Archive</a><li><a>Imprint</a></ul></div>"
        return f"<body>{menu}<div class=x2><p>We value what you value.</p></div><div class=x3><h1>Title {i}</h1><p>First of {i}.</p><p>Second of {i}.</p></div><div class=x4><p>Call now, save ten.</p></div></body>"

    rows = [(i, f"https://a.example/{i}", page(i)) for i in range(20)] + [(100, "https://b.example/1", page(100))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in ht.extract(df).collect()}
    want = {i: f"Title {i}\n\nFirst of {i}.\n\nSecond of {i}." for i in range(20)}
    assert {i: got[i] for i in want} == want
    assert got[100].startswith("Home") and got[100].endswith("save ten.")  # one page of its host: nothing recurs
    off = {r.page_id: r.text for r in ht.extract(df, least_pages=10**9).collect()}
    assert all(off[i] != want[i] for i in want)


def test_templates_go_before_rules():
    html = "<body><nav>Menu of all</nav><nav>Only here</nav><div>Slogan</div><p>text</p></body>"
    root = ht.parse(html)
    ht.subtree_hashes(root)
    known = {x.hash for x, done in ht._walk(root) if done and isinstance(x, ht.Node) and x.tag in ("nav", "div")} - {0}
    first = [x.hash for x, done in ht._walk(root) if done and isinstance(x, ht.Node) and x.tag == "nav"][1]
    assert ht.delete(root, known - {first}) == (2, 1)
    assert text(html) == "Slogan\n\ntext"
