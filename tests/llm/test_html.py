import random
import re
from html import unescape

import pytest
from pyspark.sql import types as T

from channelmart.llm import html_extract
from channelmart.llm.queries import op5_html_extraction

SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()),
                       T.StructField("host", T.StringType()), T.StructField("path", T.StringType())])


def table(spark, rows):
    return spark.createDataFrame([(*r, "h", "p") for r in rows], SCHEMA).repartition(3)


def got(spark, rows):
    out = html_extract.extract(table(spark, rows)).collect()
    assert all(r["n_chars"] == len(r["text"]) for r in out)
    return {r["page_id"]: r["text"] for r in out}


def common(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@pytest.mark.parametrize("small", [1 << 25, 20])
def test_common_subsequence_is_longest(monkeypatch, small):
    monkeypatch.setattr(html_extract, "SMALL_BITS", small)
    rng = random.Random(2)
    for _ in range(800):
        a, b = ([rng.randint(0, 6) for _ in range(rng.randint(0, 14))] for _ in range(2))
        found = html_extract.common_lines(a, b)
        assert found == sorted(set(found)) and len(found) == common(a, b)
        rest = iter(b)
        assert all(any(x == y for y in rest) for x in [a[k] for k in found])


def test_articles_of_the_given_pages(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = {r["page_id"]: r for r in op5_html_extraction(spark, sf_dir).collect()}
    assert got.keys() == rows.keys()
    for k, html in rows.items():
        body = re.search("<article>(.*?)(?:</article>|$)", html, re.S)[1]
        blocks = [" ".join(unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1|br)>", body)]
        assert got[k]["text"] == "\n".join(b for b in blocks if b)


PAGE = """<html><head><title>T</title><style>p {{}}</style></head><body><div class="top">Site of things</div><div>Home | News</div>
<p>{0}</p><div>Read more in our archive</div><script>var x = "<p>no</p>";</script><div>{1}</div></body></html>"""


def test_lines_shared_with_the_nearest_page_go(spark):
    rows = [(k, f"http://h.example.org/{s}/{k}", PAGE.format(f"text {k} of this page", f"foot of {s}")) for k, s in enumerate("aabbb")]
    assert got(spark, rows) == {k: f"text {k} of this page" for k in range(5)}
    alone = got(spark, rows[:1])
    assert alone == {0: "Site of things\nHome | News\ntext 0 of this page\nRead more in our archive\nfoot of a"}


def test_the_nearest_page_by_path_is_taken(spark):
    a, b = "<p>line of a</p><p>one {}</p>", "<p>line of b</p><p>two {}</p>"
    rows = [(1, "http://x/a/1", a.format(1)), (2, "http://x/a/2", a.format(2)), (3, "http://x/b/1", b.format(3)), (4, "http://x/b/2", b.format(4)), (5, "http://y/b/3", b.format(5))]
    assert got(spark, rows) == {1: "one 1", 2: "one 2", 3: "two 3", 4: "two 4", 5: "line of b\ntwo 5"}


def test_pages_are_paired_the_same_over_any_number_of_tasks(spark):
    rows = [(k, f"http://x/s/{k:03}", f"<p>menu {k // 10}</p><p>text {k}</p>") for k in range(60)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = got(spark, rows)
        spark.conf.set("spark.sql.shuffle.partitions", "17")
        assert got(spark, rows) == one
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_markup_that_varies_and_quotes_in_articles(spark):
    page = """<body><header><h2>Head {0}</h2></header><nav><a>Menu {0}</a></nav><aside>Side {0}</aside><div class="cookie-notice">Cookies {0}</div>
    <div class="ad">Buy {0}<div>now {0}</div></div><form><label>Mail {0}</label></form><main><h1>Title&nbsp;{0} &amp; more</h1><p>Quoted by both.</p>
    <p>Own <b>bold</b>
    text {0}<br>next &lt;x&gt;</p><ul><li>item {0}</li></ul><div id="comments"><p>Reader {0}</p></div><!-- none --></main><footer>Foot {0}</footer></body>"""
    rows = [(k, f"http://x/{k}", page.format(k)) for k in range(3)]
    assert got(spark, rows) == {k: f"Title {k} & more\nQuoted by both.\nOwn bold text {k} next <x>\nitem {k}" for k in range(3)}


def test_the_difference_decides_on_pages_with_an_article(spark):
    page = """<body><main><p>Home of things</p><h1>Title {0}</h1><p>Both quote this.</p><p>Text {0} of the article, which is long.</p><div>Share this</div></main>
    <div>Plain text {0} beside it</div><div>Read more in our archive</div><div class="related"><article>Teaser {0}</article></div></body>"""
    rows = [(k, f"http://x/{k}", page.format(k)) for k in range(3)]
    assert got(spark, rows) == {k: f"Title {k}\nBoth quote this.\nText {k} of the article, which is long.\nPlain text {k} beside it" for k in range(3)}


def test_plain_text_stays_beside_a_teaser_and_copies_keep_their_article(spark):
    plain = '<div>Menu of all</div><p>Own text {0}</p><div class="related"><article>Teaser {0}</article></div>'
    copy = "<div>Site</div><article><h1>A title</h1><p>" + "The body of a copied page. " * 20 + "</p><p>seen {0}</p></article>"
    rows = [(k, f"http://x/{k}", plain.format(k)) for k in range(2)] + [(k, f"http://y/a?utm={k}", copy.format(k)) for k in range(2, 4)]
    found = got(spark, rows)
    assert [found[k] for k in range(2)] == ["Own text 0", "Own text 1"]
    assert all(found[k] == "A title\n" + ("The body of a copied page. " * 20).strip() + f"\nseen {k}" for k in (2, 3))


def test_cases(spark):
    rows = [(1, None, "<p>a</p>"), (2, "http://x/1", None), (3, "http://x/2", ""), (None, "http://x/3", "<p>b"), (4, "::", "no tags &amp; &#233;"), (5, "http://x/9", "<div class=ad>x<article>kept</article>"),
            (6, "http://z/1", "<p>" + "w " * 200_000), (7, "http://z/2", "<b>" * 3000 + "deep")]
    rows += [(8, "http://w/1", "<p>same</p>")] * 2
    out = html_extract.extract(table(spark, rows)).collect()
    assert len(out) == len(rows)
    texts = {r["page_id"]: r["text"] for r in out}
    assert texts[1] == "a" and texts[2] == texts[3] == "" and texts[None] == "b" and texts[4] == "no tags & é" and texts[5] == "kept"
    assert len(texts[6]) == 399_999 and texts[7] == "deep" and texts[8] == "same"
    assert html_extract.extract(table(spark, [])).count() == 0
