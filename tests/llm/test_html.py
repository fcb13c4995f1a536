import math
from collections import Counter

import pytest
from conftest import SF_TINY
from daybook.llm import html as H

CASES = [
    (None, ""), ("", ""), ("  \n ", ""), ("plain &amp; text", "plain & text"),
    ("<p>a&nbsp;b<b>c</b>d</p><script>x<p></script>e", "a bcd e"),
    ("<article><h1>T</h1><p>x &lt;i&gt;\n  y<p>z<br>w</article><footer>f</footer>", "T x <i> y z w"),
    ("<nav><ul><li>m</ul></nav><main><header><h1>T</h1></header><p>x<aside>s</aside><form>q</form></main>", "T x"),
    ("<header>site</header><div class='content'><p>q</p></div><div class=\"footer\">f</div>", "q"),
    ("<article><p>one</p><section id=comments><article><p>no</p></article></section></article>", "one"),
    ("<article><p>one<div class='ad-box'>buy</div><div class='cookie-notice'>ok</div><p hidden>h</p></article>", "one"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article", "a b c d"),
    ("<article><p>cut off <a href=\"x", "cut off"),
    ("<title>t</title><style>p{}</style><!-- <p>c</p> --><p>k</p>", "k"),
    ("<article><p>loaded advice, headers and commentary</p></article>", "loaded advice, headers and commentary"),
    ("<div class='leaderboard-header-wide'>x</div><p>y", "y"),
    ("<div class='post'><div class='post-header'><h1>T</h1></div><div class='post-content'><p>x</p></div></div><div class='post-footer'>f</div>", "T x"),
    ("<SCRIPT>İİİİ</SCRIPT>after<p>b", "after b"),
    ("<div class='side-rail'>s</div><div role=main>m<ol><li>1<li>2<ul><li>3</ul><li>4</ol></div>", "m 1 2 3 4"),
]


@pytest.mark.parametrize("source,want", CASES)
def test_main_text(source, want):
    assert H.main_text(source) == want


ARTICLE = "<article><h1>T</h1><p>the story itself</p></article>"
WRAPPED = [
    ("<body class='single has-sidebar'><nav>m</nav>" + ARTICLE + "<div class=sidebar>s</div></body>", "T the story itself"),
    ("<html class=no-overlay><body><div class='site widget-area'>" + ARTICLE + "<div class=widget>w</div></div>", "T the story itself"),
    ("<article class='post comments-open'><p>the story itself</p><div class=comments><p>a reply that is longer than the story itself</p></div></article>", "the story itself"),
    ("<div id=page class=no-sidebar><div class='widget post'><p>the story itself</p></div><div class=ads>a</div></div>", "the story itself"),
    ("<form action=x><div class=menu>m</div><p>the story itself</p><input></form>", "the story itself"),
    ("<div class=header-fixed><p>the story itself</p><div class=footer>f</div></div>", "the story itself"),
    ("<div class=text><p>the story itself, at some length</p></div><div id=comments><article>a reply</article></div>", "the story itself, at some length"),
]


@pytest.mark.parametrize("source, want", [
    ("<p>short story</p><div class=ad>an advert that is by far the longest text of this page, and goes on</div>", "short story"),
    ("<p>short story</p><div class=ad><p>an advert that is by far the longest</p><p>text of this page</p></div>", "short story"),
    ("<div class=text><p>short</p></div><div class=comments><p>first reply, longer than the post</p><p>second reply</p></div>", "short"),
    ("<div class=text><p>short</p></div><div class=comments-list><article>a reply longer than the post</article></div>", "short"),
    ("<p>short story</p><div class='cookie-banner'>we use cookies and say so at such length that nothing else counts</div>", "short story"),
    ("<div class='has-cookie-banner'><article>the story of this page</article></div><p>by the way</p>", "the story of this page"),
])
def test_adverts_notices_and_discussions_are_no_wrappers(source, want):
    assert H.main_text(source) == want


@pytest.mark.parametrize("source,want", WRAPPED)
def test_a_name_alone_does_not_remove_a_wrapper(source, want):
    assert H.main_text(source) == want


def test_named_wrapper_is_judged_by_the_tree(spark):
    body = "<div class=promo-box>The same long words on each page of this site, again and again</div><p>own {i}</p>"
    assert {r["text"] for r in extract(spark, site(20, body=body)).collect()} == {"own " + f"page{i}" * 3 for i in range(20)}


def test_deep_and_broken_pages_take_linear_time():
    import time

    began = time.time()
    for page in ("<div>" * 100_000 + "x", "<p><b>" * 50_000 + "x", "<li><ul>" * 50_000 + "x" + "</p>" * 50_000, "<a b='" * 50_000, "</x>" * 100_000, "<" * 200_000,
                 "<td><li>" * 30_000, "&" * 200_000):
        H.main_text(page)
    assert time.time() - began < 30


def site(n, host="h.example", body="<div class='claim'>Same words on each page</div><div class='text'><p>{i} own text</p><p>more {i}</p></div>"):
    return [(i, f"https://{host}/{i}", body.format(i=f"page{i}" * 3)) for i in range(n)]


def extract(spark, rows, **kw):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return H.extract(df, **kw)


def test_template_without_names_is_found_by_entropy(spark):
    rows = site(30) + [(100 + i, "https://few.example/", "<div class='claim'>Same words on each page</div>") for i in range(3)]
    got = {r["page_id"]: r["text"] for r in extract(spark, rows).collect()}
    assert got[4] == "page4page4page4 own text more page4page4page4"
    # Pages that vary nowhere: the text stays.
    assert got[100] == "Same words on each page"


def test_both_ways_to_send_the_branches(spark, monkeypatch):
    rows = site(30) + site(20, "other.example")
    want = sorted((r["page_id"], r["text"]) for r in extract(spark, rows).collect())
    monkeypatch.setattr(H, "BRANCHES", 0)
    assert sorted((r["page_id"], r["text"]) for r in extract(spark, rows).collect()) == want


def test_importance_by_hand(spark):
    rows = [(i, "https://h.example/", "<body><div class=a>same</div><div class=b>own %d</div>%s</body>" % (i, "<i>t</i>" * (i % 2))) for i in range(8)]
    tree = {r["path"]: r for r in H.style_tree(spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("'h' AS host", "html")).collect()}
    assert tree["body>div|c=a"]["content"] == pytest.approx(0) and tree["body>div|c=b"]["content"] == pytest.approx(1)
    # Two sequences of children, four pages each, over eight pages: one bit of three.
    assert tree["body"]["presentation"] == pytest.approx(1 / 3) and tree["body"]["n_pages"] == 8


def test_repeated_article_stays(spark):
    """A whole article that many pages of a site share is no template; its heading neither."""
    page = "<nav>m</nav><article><h1>Shared</h1><p>copy of one text</p></article>"
    rows = [(i, "https://h.example/", page) for i in range(20)]
    assert {r["text"] for r in extract(spark, rows).collect()} == {"Shared copy of one text"}


def test_repeated_branch_in_varying_articles_goes(spark):
    page = "<article><h2>Same heading</h2><p>own {0} text</p><p class=legal>Same legal line</p></article>"
    got = extract(spark, [(i, "https://h.example/", page.format("x%d" % i)) for i in range(20)]).collect()
    assert {r["text"] for r in got} == {"Same heading own x%d text" % i for i in range(20)}


def test_odd_rows(spark):
    rows = [(1, None, None), (1, None, None), (None, "no host", "<p>a"), (2, "https://h.example", "<p>" + "word " * 200_000), (3, "https://h.example", "<div>" * 3000 + "deep")]
    out = extract(spark, rows).collect()
    assert len(out) == 5
    text = {r["page_id"]: r["text"] for r in out}
    assert text[1] == "" and text[None] == "a" and len(text[2]) == 999_999 and text[3] == "deep"
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS host", "3 AS path", "4 AS __x")
    assert H.extract(df).where("page_id = 2").first()["text"].startswith("word")
    assert extract(spark, []).count() == 0


def brute_tree(pages):
    """importance by (host, path), from each host's pages one by one."""
    hosts = {}
    for host, source in pages:
        hosts.setdefault(host, []).append(H.parse(source))
    out = {}
    for host, parsed in hosts.items():
        paths = {b.path for p in parsed for b in p.blocks} | {x for p in parsed for x in p.styles}
        settled = {x for x in paths if all(x in p.settled for p in parsed if x in p.styles or any(b.path == x for b in p.blocks))}
        for path in paths - {""}:
            on = [p for p in parsed if path in p.styles or any(b.path == path for b in p.blocks)]
            kinds = Counter(" ".join(p.styles.get(path, [])) for p in on)
            texts = Counter((b[0], b[1]) for p in parsed for b in {(b.path, b.text) for b in p.blocks} if (b[0] + ">").startswith(path + ">"))
            if path not in settled:
                texts = Counter({k: n for k, n in texts.items() if k[0] not in settled})
            had = {x: sum(1 for p in parsed if x in p.styles or any(b.path == x for b in p.blocks)) for x, _ in texts}
            if not texts:
                continue
            n, styles = len(on), sum(1 for k in kinds if k)
            base = math.log(max(n, 2))
            presentation = -sum(k / n * math.log(k / n) for k in kinds.values()) / base if n > 1 else 1.0
            content = 1 - sum(math.log(k) / math.log(max(had[x], 2)) for (x, _), k in texts.items()) / len(texts)
            left = H.DECAY ** min(styles, 10)
            out[host, path] = content if not styles else (1 - left) * presentation + left * content
    return out


def test_importance_by_brute_force(spark):
    pages = spark.read.parquet(f"{SF_TINY}/pages.parquet").select(H.host_of("url").alias("host"), "html") \
        .union(spark.createDataFrame([("h", r[2]) for r in template_site(9)], "host string, html string"))
    want = brute_tree([(r["host"], r["html"]) for r in pages.collect()])
    got = {(r["host"], r["path"]): r["importance"] for r in H.style_tree(pages).collect() if r["importance"] is not None}
    assert got.keys() == want.keys() and len(got) > 100
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


MENU = "".join(f"<li><a href=/{i}>Section {i}</a></li>" for i in range(40))


def template_site(n, host="t.example"):
    """Pages whose parts have no telling names: a menu, a claim and a closing line around two paragraphs of their own."""
    return [(i, f"https://{host}/{i}", f"<html><body><div class=alpha><ul>{MENU}</ul></div><div class=beta><p>only here {i}</p><p>and more of {i}</p>"
             "</div><div class=gamma><p>Words that close each page</p></div></body></html>") for i in range(n)]


@pytest.mark.parametrize("n", [3, 4, 8, 60])
def test_the_tree_alone_removes_what_repeats_around_short_texts(spark, n):
    got = {r["page_id"]: r["text"] for r in extract(spark, template_site(n)).collect()}
    assert got == {i: f"only here {i} and more of {i}" for i in range(n)}


def test_two_pages_or_copies_lose_nothing(spark):
    copies = [(i, "https://c.example/", "<body><div class=a><p>one text</p></div><div class=ad>advert %d</div></body>" % i) for i in range(30)]
    got = extract(spark, template_site(2) + copies).collect()
    assert {r["text"] for r in got if r["url"].startswith("https://c.")} == {"one text"}
    assert all(r["text"].startswith("Section 0") and r["text"].endswith("close each page") for r in got if r["url"].startswith("https://t."))


def test_columns_of_any_name_stay_in_both_ways(spark, monkeypatch):
    df = spark.createDataFrame(site(30), "page_id long, url string, html string") \
        .selectExpr("*", "1 AS host", "2 AS low", "3 AS text", "4 AS page", "5 AS __of", "6 AS __host", "7 AS __low")
    want = sorted(map(tuple, H.extract(df).collect()))
    monkeypatch.setattr(H, "BRANCHES", 0)
    out = H.extract(df)
    assert out.columns == df.columns and sorted(map(tuple, out.collect())) == want
