"""Operators on pages, components, and the pipeline."""

import html as markup
import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from oracle import connect, difference
from tablewright.llm import catalog, decontamination, html, lines, pieces, quality, simhash, urls
from tablewright.llm.components import connected_components

SF_PAGES = "/root/testdata/sf0.01"


@pytest.mark.parametrize("kind", ["long", "string"])
def test_components(spark, kind):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(1000, 1040)]  # a chain
    edges += [(0, i) for i in range(1, 200)]  # a hub
    edges += [(rng.randrange(300, 600), rng.randrange(300, 600)) for _ in range(150)] + [(7, 7), (None, 5), (5, None)]
    as_kind = lambda x: x if x is None or kind == "long" else f"{x:05d}"
    df = spark.createDataFrame([(as_kind(a), as_kind(b)) for a, b in edges], f"a {kind}, b {kind}")
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    want = {as_kind(x): as_kind(find(x)) for x in list(root)}
    assert {r.node: r.root for r in connected_components(df, kind=kind).collect()} == want
    assert connected_components(df.limit(0), kind=kind).count() == 0


def test_urls(spark):
    rules = catalog.RULES
    link = '<link rel="canonical" href="{}">'
    pages = [
        (1, "https://a.example.org/x", link.format("https://bad.net/y?a=1&amp;b=2")),  # reaches a blocked URL
        (2, "https://b.example.org/z", '<meta content="0; url=https://A.example.org/x#top" HTTP-EQUIV=refresh>'),
        (3, "https://www.example.net/en/q", link.format("https://bad.net/y?a=1&amp;b=2")),  # allowed by its own rule
        (4, "https://c.example.org/z", link.format("https://shop.org/fr/1")),  # only an allowed alias
        (5, "https://d.example.org/z", link.format("//bad.net/other")),
        (6, "https://d.example.org/w", link.format("/z")),
        (7, "HTTP://X.Example.COM:80/de/1?q#f", None),
        (8, None, "x"), (9, "no scheme", ""), (10, "http://x.net", ""), (10, "http://notnet/", ""),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict, r.via) for r in urls.filter_urls(df, rules).collect()), key=repr)
    want = [
        # 1, 2 and 3 share a component that holds an explicit allow
        (1, "a.example.org", "/x", None, "allow", "alias"),
        (2, "b.example.org", "/z", None, "allow", "alias"),
        (3, "www.example.net", "/en/q", "example.net/en/", "allow", "rule"),
        (4, "c.example.org", "/z", None, "allow", "alias"),
        (5, "d.example.org", "/z", None, "block", "alias"),
        (6, "d.example.org", "/w", None, "block", "alias"),
        (7, "x.example.com:80", "/de/1", None, "allow", "default"),
        (8, "", "", None, "allow", "default"),
        (9, "", "", None, "allow", "default"),
        (10, "x.net", "", None, "allow", "default"),
        (10, "notnet", "/", None, "allow", "default"),
    ]
    assert got == sorted(want, key=repr)
    assert urls.filter_urls(df.limit(0), rules).count() == 0


@pytest.mark.parametrize(
    "url, node",
    [
        ("https://h.org", "https://h.org/"),
        ("HTTPS://H.org:443/a/./b/../c?x=/../y#f", "https://h.org/a/c?x=/../y"),
        ("http://h.org:80?q", "http://h.org/?q"),
        ("http://h.org:8080/..", "http://h.org:8080/"),
        ("http://h.org/a/..", "http://h.org/"),
        ("http://h.org/a/b/..", "http://h.org/a/"),
        ("http://h.org/a/.", "http://h.org/a/"),
        ("http://h.org/../../x//y/", "http://h.org/x//y/"),
        ("http://h.org/a..b/.c", "http://h.org/a..b/.c"),
        ("no scheme/./x", "no scheme/./x"),
    ],
)
def test_url_nodes(spark, url, node):
    df = spark.createDataFrame([(url,)], "url string")
    assert df.select(urls.node_of(F.col("url"))).first()[0] == node


def test_references_in_links(spark):
    cases = ["a&amp;b&#38;c&#x26;d", "&#47;x&sol;y", "&#128512;&#xe9;", "&unknown; & &amp", "&#0;&#xD800;&#9999999;", "", "plain"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, t string")
    got = [r[0] for r in df.select(urls.referenced(F.col("t"))).collect()]
    assert got == ["a&b&c&d", "/x/y", "😀é", "&unknown; & &amp", "&#0;&#xD800;&#9999999;", "", "plain"]


def nodes_by_definition(pages):
    """Verdicts over links of all spellings, by plain search from page to page."""
    from urllib.parse import urljoin, urlsplit

    def node(url):
        parts = urlsplit(urljoin(url, url))
        path = urlsplit(urljoin(url, parts.path or "/")).path or "/"
        return f"{parts.scheme}://{parts.netloc.lower()}{path}" + (f"?{parts.query}" if parts.query else "")

    near = {}
    for _, url, page in pages:
        a = node(url)
        near.setdefault(a, set())
        for link in re.findall(r"<link[^>]*rel=[\"'][^\"']*canonical[^>]*href='([^']*)'", re.sub("(?s)<!--.*?-->", "", page)):
            b = node(urljoin(url, markup.unescape(link)))
            near[a].add(b)
            near.setdefault(b, set()).add(a)
    out = {}
    for i, url, _ in pages:
        seen, todo = set(), [node(url)]
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += near[x]
        out[i] = any("//bad.net/" in x for x in seen)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_links_of_all_spellings(spark, seed):
    rng = random.Random(seed)
    hosts = ["a.org", "b.org", "c.org"]
    pages = []
    for i in range(60):
        host, name = rng.choice(hosts), rng.randrange(12)
        url = rng.choice([f"https://{host}/d/{name}", f"https://{host.upper()}/d/./{name}", f"https://{host}/d/e/../{name}#x"])
        to = rng.randrange(12)
        other = rng.choice(hosts)
        link = rng.choice(
            [f"https://{other}/d/{to}", f"//{other}/d/{to}", f"/d/{to}", f"{to}", f"./{to}", f"../d/{to}", f"&#47;d&sol;{to}", f"https://{other}"]
        )
        if rng.random() < 0.06:
            link = f"https://bad.net/{to}?a=1&amp;b=2"
        rel = rng.choice(["canonical", "alternate canonical", "canonical x"])
        tag = f"<link rel='{rel}' href='{link}'>"
        pages.append((i, url, rng.choice([tag, tag, f"<!-- {tag} -->", f"<!-- x -->{tag}", f"<link rel='noncanonical' title=x href='{link}'>".replace("noncanonical", "next")])))
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.verdict == "block" for r in urls.filter_urls(df, [("block", "bad.net", "/")]).collect()}
    assert got == nodes_by_definition(pages)


def article_by_definition(page):
    found = re.search(r"<article>(.*?)(?:</article>|$)", page or "", re.S)
    blocks = re.split(r"</?(?:p|h1|br)>", found[1]) if found else []
    bare = (" ".join(markup.unescape(re.sub(r"<[^>]*(>|$)", "", b)).split()) for b in blocks)
    return "\n".join(b for b in bare if b)


def test_html_on_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in html.extract_pages(pages).collect()}
    for row in pages.collect():
        r = got[row.page_id]
        assert r.text == article_by_definition(row.html) and r.n_chars == len(r.text) and r.url == row.url


def test_html_consensus(spark):
    """A page whose comments are longer than its article follows its host."""
    page = '<body><nav><a href=x>Menu</a></nav><div class="post-{}"><h2>T</h2><p>{}</p></div><div class=story-more>{}</div></body>'
    rows = [(i, "http://h/x", page.format(i, "body text " * 30, "more")) for i in range(5)]
    rows += [(9, "http://h/y", page.format(9, "short", "<p>" + "other text " * 80 + "</p>"))]
    rows += [(20, None, None), (21, "http://other/", ""), (22, "u", "bare &lt;text&gt;\n here &copy 2020")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for limit in (100, 0):
        got = {r.page_id: r.text for r in html.extract_pages(df, max_broadcast=limit).collect()}
        assert got[9] == "T\nshort" and got[0] == "T\n" + ("body text " * 30).strip()
        assert (got[20], got[21], got[22]) == ("", "", "bare <text> here © 2020")


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article><header><h1>T</h1></header><p>a<b>b</b> c<br>d<form>f</form><div class='ad box'>x</div></article>", "T\nab c\nd"),
        ("<main><p>one<p>two <i>x<p>three</main><footer>f</footer>", "one\ntwo x\nthree"),
        ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table><pre> e  f </pre></article>", "a\nb\nc\nd\ne f"),
        ("<article><p>x &lt;b&gt; &#233;&amp;amp;</p><script>if (a < b) '</p>'</script><style>p{}</style><!-- > -->y</article>", "x <b> é&amp;\ny"),
        ("<div id=comments><p>c</p></div><article><p>5 < 6 and 7 > 3</p><aside>s</aside><div role=navigation>n</div></article>", "5 < 6 and 7 > 3"),
        ('<article><p title="a>b">q</p><p hidden>h</p><p class="c', "q"),
        ("<article></article>", ""),
    ],
)
def test_html_markup(page, text):
    assert html.extracted(page, [">article", ">main"]) == text


@pytest.mark.parametrize(
    ("page", "path"),
    [
        ("<article><section id=a><p>{a}{a}{a}</p></section><section id=b><p>{a}</p></section></article>", ">body>article"),
        ("<article><h1>T</h1><p>{a}</p>" + "<section><p>{a}b</p></section>" * 5 + "</article>", ">body>article"),
        ("<div class=post><h1>T</h1><div class=text><p>{a}</p></div></div><div class=x><p>{b}</p></div>", ">body>div.post"),
        ("<div class=post><p>{b}</p><blockquote><p>{a}{a}</p></blockquote></div>", ">body>div.post"),
        ("<div class=post><p>{b}</p><table>" + "<tr><td>{b}<td>{b}" * 5 + "</table></div>", ">body>div.post"),
        ("<table><tr><td class=l><a href=x>{b}</a><td class=m><p>{a}</p><td class=r>{b}</table>", ">body>table>tr>td.m"),
        ("<div class=post><div id=a><p>{a}</p></div><div id=b><p>{b}{b}</p></div></div><div><a href=x>{a}</a></div>", ">body>div.post"),
        ("<div class=post><p>{a}</p></div><div class=more><p>{b}</p></div>", ">body>div.post"),
    ],
)
def test_html_whole_article(page, path):
    """The vote goes to the container of the whole article, not to its longest part."""
    page = "<body>" + page.format(a="long text " * 40, b="some more " * 10) + "</body>"
    assert html.scored(page)[0][0] == path


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<div id=content-sidebar-wrap><article><p>{a}</p></article><div class=sidebar>{b}</div></div>", "{a}"),
        ("<div class=has-sidebar><main><p>{a}</p></main></div><div class=x>{b}{b}</div>", "{a}"),
        ("<div class='layout no-sidebar'><div class=post><p>{a}</p></div><div class=widget>{b}</div></div><p>{b}</p>", "{a}"),
        ("<form action=x><div class=with-rail><div class=post><p>{a}</p></div></div></form>", "{a}"),
        ("<div class=has-sidebar><article>{a}</article></div><article>x</article>", "{a}"),
        ("<div class=ad>{a}</div>", "{a}"),
        ("<article><p>{b}</p></article><form>{a}</form><div class=ad>{a}</div>", "{b}"),
        ("<div class=post><p>{b}</p></div><div class=comments><article>{a}</article></div>", "{b}"),
        ("<div class=has-sidebar hidden><article>{a}</article></div><p>{b}</p>", "{b}"),
    ],
)
def test_html_names_spare_the_article(page, text):
    a, b = ("long text " * 40).strip(), ("some more " * 10).strip()
    assert html.extracted("<body>" + page.format(a=a, b=b) + "</body>", []) == text.format(a=a, b=b)


WORDS = "the article speaks of many things and goes on for a while so that it has some length"


def article_of(inside):
    return html.extracted(f"<body><article><p>{WORDS}</p>{inside}<p>{WORDS} end</p></article></body>", [])


@pytest.mark.parametrize(
    "inside, text",
    [
        ("<p title='Bob's day'>one two</p><p>don't stop</p><p>three</p>", "one two\ndon't stop\nthree"),
        ("<p title=it's>one</p><p>two</p>", "one\ntwo"),
        ("<img alt='Bob's cat'>after<p>it's</p>", "after\nit's"),
        ('<p title="a > b" data-x = \'c > d\'>one</p>', "one"),
        ('<p title="hidden" alt="role" data-id="nav" data-class="ad">one</p>', "one"),
        ("<h2 id='related-work'>Related work</h2>", "Related work"),
        ("<section id='legal-basis'><p>The basis</p></section>", "The basis"),
        ("<div class='side-by-side'><p>left</p><p>right</p></div>", "left\nright"),
        ("<h2 id='search'>Search</h2>", "Search"),
        ("<h2 id='social-impact'>Impact</h2>", "Impact"),
        ("<p id='notice-period'>Three months</p>", "Three months"),
        ("<h3 class='share-price'>Price</h3>", "Price"),
        ("<ul class='menu-items'><li>soup</li><li>fish</li></ul>", "soup\nfish"),
        ("<div id='comment-on-method'><p>We remark</p></div>", "We remark"),
    ],
)
def test_html_keeps_what_the_article_says(inside, text):
    assert article_of(inside) == f"{WORDS}\n{text}\n{WORDS} end"


@pytest.mark.parametrize(
    "inside",
    [
        "<div class='ad'>Buy this</div>",
        "<p class='advert'>Buy this</p>",
        "<div class='ad-slot-3'>Buy this</div>",
        "<section class='comments'><p>First!</p><p>I do not agree at all</p></section>",
        "<div id='comments'><p>First!</p></div>",
        "<ol class='comment-list'><li><a href='/u'>Ann says hello there</a></li></ol>",
        "<div class='cookie-banner'>We use cookies</div>",
        "<div class='related-reading-now'><a href='/x'>Read this too</a></div>",
        "<div class='newsletter-today'>Stay in touch <input name=mail> <button>Go</button></div>",
        "<ul class='share-buttons'><li><a href='/s'>Send</a></li></ul>",
        "<aside>By the way</aside><nav>Home</nav><form>Name <input></form>",
        "<div role='complementary'>More</div><div hidden>x</div><div style='display: none'>y</div>",
    ],
)
def test_html_drops_what_surrounds_it(inside):
    assert article_of(inside) == f"{WORDS}\n{WORDS} end"


@pytest.mark.parametrize("limit", [100_000, 0])
def test_html_hosts_without_article_elements(spark, limit):
    """Three hosts with layouts of their own; boilerplate outweighs some articles."""
    rng = random.Random(4)
    layouts = {
        "a.org": "<div class='page'><div class='sidebar'>{menu}</div><div class='story-text'>{body}</div></div>",
        "b.org": "<table><tr><td class='nav'>{menu}</td><td class='txt'>{body}</td></tr></table>",
        "c.org": "<div id='top'>{menu}</div><div id='content-{n}'><div class='inner'>{body}</div></div><div class='footer'>{menu}</div>",
    }
    rows, want = [], {}
    for n in range(60):
        host = rng.choice(list(layouts))
        blocks = [" ".join(rng.choice("alpha beta gamma delta eps".split()) for _ in range(rng.randrange(8, 60))) for _ in range(rng.randrange(1, 6))]
        menu = "".join(f"<a href='/{i}'>entry number {i}</a> " for i in range(rng.randrange(3, 30)))
        body = "".join(f"<p>{b}</p>" for b in blocks)
        rows.append((n, f"https://{host}/{n}", layouts[host].format(menu=menu, body=body, n=n), "x"))
        want[n] = "\n".join(blocks)
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = {r.page_id: r.text for r in html.extract_pages(df, max_broadcast=limit).collect()}
    assert got == want


def test_html_both_ways_agree(spark):
    df = spark.read.parquet(f"{SF_PAGES}/pages.parquet").limit(200)
    df = df.unionAll(df.limit(5)).unionAll(df.limit(3).selectExpr("page_id", "NULL", "html")).unionAll(df.limit(3).selectExpr("page_id", "url", "NULL"))
    few, many = (sorted(map(tuple, html.extract_pages(df, max_broadcast=n).collect()), key=repr) for n in (100_000, 0))
    assert few == many and len(few) == df.count()


def test_html_of_a_very_long_page():
    page = "<article>" + "<p title='it's' class=x>word &amp; word</p>" * 50_000 + "<div class='" + "a" * 1_000_000
    assert html.extracted(page, []).count("\n") == 49_999


def test_html_layouts_of_one_host(spark):
    """A teaser on one layout's path does not replace the article of another, however rare."""
    a, b = ("long text " * 40).strip(), "only five words of teaser"
    rows = [(i, "http://h/x", f"<body><div class=content><p>{a}</p></div></body>") for i in range(12)]
    for n, tag in enumerate(["main", "div class=p", "div class=q", "div class=r", "div class=s"]):
        page = f"<body><div class=content>{b}</div><{tag}><p>{a} {n}</p></{tag.split()[0]}></body>"
        rows += [(100 + 10 * n + i, "http://h/y", page) for i in range(6 - n)]
        rows += [(200 + n, None, page)]
    rows += [(300 + i, None, f"<body><div class=content>{a}</div></body>") for i in range(9)]
    got = {r.page_id: r.text for r in html.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    want = {i: f"{a} {(i % 100) // 10}" if 100 <= i < 200 else f"{a} {i - 200}" if 200 <= i < 300 else a for i, _, _ in rows}
    assert got == want


@pytest.mark.parametrize(
    ("inside", "text"),
    [
        ("<p>a</p><svg/><p>b</p>", "a\nb"),
        ("<svg class='icon' /><p>b</p><svg><text>x</text></svg>c", "b\nc"),
        ("a<svg><svg viewBox=0><path/></svg><svg/><text>x</text></svg>b", "ab"),
        ("a<template><p>x</p><template>y</template>z</template>b", "ab"),
        ("a<script><script>x</script>b<svg><p>never closed</p>", "ab\nnever closed"),
        ("a<svg><svg>x</svg>b<p>c</p>", "ab\nc"),
    ],
)
def test_html_text_behind_drawings(inside, text):
    assert html.extracted(f"<article>{inside}</article>", [">article"]) == text


def pipeline_by_definition(spark, sf_dir):
    """The stages with their tested parts, one document at a time."""
    from test_documents import components_by_definition, contaminated_by_definition, dedup_by_definition, simhash_by_definition

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    trees = quality.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept = []
    for doc, text in rows:
        stats = quality.text_stats(text)
        n, repeats = stats[0], stats[4]
        score = trees.score(quality.np.array([stats[5:]], float))[0]
        if n >= 50 and 100 * repeats <= 50 * n and score >= 0.5:
            kept.append((doc, text))
    left = sorted(dedup_by_definition(kept, 50, shortest=True).items())
    roots = components_by_definition([simhash_by_definition(t) for _, t in left])
    least = {}
    for (doc, _), root in zip(left, roots):
        least[root] = min(doc, least.get(root, doc))
    left = [(d, t) for d, t in left if d in set(least.values())]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    bad = {r[0] for r in contaminated_by_definition(left, items) if r[5]}
    coder = pieces.Coder(pieces.read_model(corpus_pipeline.MODEL_PATH))
    return {d: coder.encode(t) for d, t in left if d not in bad}


def test_pipeline(spark, sf_dir):
    got = {r.doc_id: list(r.token_ids) for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert got == pipeline_by_definition(spark, sf_dir) and len(got) > 50


def test_pipeline_stages_keep_columns(spark, sf_dir, make):
    docs = make(["word " * 60, None, ""], [1, 2, 2])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns, name


def test_pipeline_stages_tell_rows_of_one_id_apart(spark, sf_dir, make):
    """Near-dedup and decontamination go by row, also where an id repeats or is missing."""
    rng = random.Random(5)
    one, two, three, four = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(80)) for _ in range(4))
    docs = make([one, one, two, three, four, four, three, None, None], [3, 5, 5, None, None, 7, None, None, None])
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    rows = sorted(((r.doc_id, r.text) for r in got.collect()), key=repr)
    assert rows == sorted([(3, one), (5, two), (7, four), (None, three), (None, None)], key=repr)
    item = max((r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()), key=len)
    docs = make([one, item, two, item, item, None], [5, 5, None, None, 6, 6])
    got = corpus_pipeline.benchmark(spark, docs, sf_dir)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted([(5, one), (None, two), (6, None)], key=repr)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_oracles(spark, sf_dir, name):
    assert difference(entry.queries()[name](spark, sf_dir), connect(sf_dir), entry.oracle_sql()[name]) is None


def test_native_operators_run_no_python(spark, sf_dir):
    for name in ("op2_sharding", "op3_pseudonyms", "op6_decontamination", "op7_secret_scans", "op8_url_filters"):
        plan = entry.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoopJoin", plan), name
