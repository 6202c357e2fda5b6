"""Main text of pages: the article alone, templates by host."""

import html
import re
from itertools import permutations

from pyspark.sql import functions as F

from conftest import SF_SMALL
from shiftline.llm import pages, queries

SCHEMA = "page_id long, url string, html string"


def _texts(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("host", "row", "texts", "gone", "n")})
    return {r.page_id: r.text for r in pages.extract(df, **options).collect()}


def _article(source):
    inner = re.search(r"<article>(.*)</article>", source, re.S).group(1)
    found = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split())
             for b in re.split(r"</?(?:p|h1)>", inner)]
    return "\n\n".join(b for b in found if b)


def test_query_gives_the_articles(spark):
    source = {r.page_id: r.html for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    rows = queries.op9_html(spark, SF_SMALL).collect()
    assert len(rows) == len(source)
    for r in rows:
        assert r.text == _article(source[r.page_id]) and r.n_chars == len(r.text)


def test_subtrees_that_recur_on_a_host_go(spark):
    def page(k, host, own):
        return (k, f"https://{host}/{k}?q#f", f"<html><body><div class=box><p>Read our terms</p><ul><li>One<li>Two</ul></div>"
                f"<div><h1>Title {k}</h1><p>{own}</p></div><p>See you</p></body></html>")
    rows = [page(k, "a.example", f"Text {k}") for k in range(8)] + [page(100, "b.example", "Alone")]
    got = _texts(spark, rows)
    assert got[3] == "Title 3\n\nText 3"                               # box and greeting recur on a.example
    assert got[100] == "Read our terms\n\nOne\n\nTwo\n\nTitle 100\n\nAlone\n\nSee you"
    assert _texts(spark, rows, min_pages=9)[3].startswith("Read our terms")


def test_article_paragraphs_stay_and_its_side_boxes_go(spark):
    def page(k):
        return (k, "http://c.example/", "<article><h1>Same title</h1><p>Same long paragraph of the article here</p>"
                f"<div class=x><p>Join us</p></div><p>Own {k} and more words</p></article><div>Beside</div>")
    assert _texts(spark, [page(k) for k in range(6)])[2] == \
        "Same title\n\nSame long paragraph of the article here\n\nOwn 2 and more words"


def test_counts_come_before_the_choice_of_article_or_main(spark):
    def page(k):
        return (k, "http://d.example/", "<main><p>Welcome to our site</p></main><div><p>Own text "
                f"{k}</p></div><p>Copyright</p>")
    got = _texts(spark, [page(k) for k in range(6)] + [(9, "http://e.example/", page(9)[2])])
    assert got[2] == "Own text 2"                                       # the main element holds a template only
    assert got[9] == "Welcome to our site"

    def boxes(k):
        own = "".join(f"<div><p>{t} us now</p></div>" for t in list(permutations(("Join", "Call", "Help")))[k])
        return (k, "http://f.example/", f"<article>{own}</article><div><p>Own text {k}</p></div>")
    assert _texts(spark, [boxes(k) for k in range(6)])[2] == "Own text 2"


def test_copies_count_once_and_large_hosts_keep_no_more(spark):
    body = "<h1>Title</h1><p>First part</p><p>Second part</p>"
    copies = [(k, "http://g.example/", f"{body}<div class='ad-box'>Advert {k}</div>") for k in range(8)]
    quoted = [(20 + k, "http://h.example/", "<article><h1>Title</h1><p>Some words of the article</p><div><p>Quote"
               f"</p></div></article><div><p>Visit {k}</p></div>") for k in range(8)]
    large = [(100 + k, "http://i.example/", ("<div><p>Section menu</p></div>" if k < 6 else "") + f"<p>Own text {k}</p>")
             for k in range(80)]
    got = _texts(spark, copies + quoted + large)
    assert got[3] == "Title\n\nFirst part\n\nSecond part"
    assert got[23] == "Title\n\nSome words of the article\n\nQuote"
    assert got[103] == "Own text 3" and got[150] == "Own text 50"         # the menu is on 7.5 % of the host's pages


def test_marked_parts_references_and_broken_markup(spark):
    def one(body):
        return _texts(spark, [(1, "http://x/", body)])[1]
    assert one("<nav>a</nav><header>b</header><article><header><h1>T</h1></header><p>x &amp; y&nbsp;&lt;z&gt; &#233;</p>"
               "<aside>c</aside><form>d</form><div id='comments'><p>e</p></div><div class='ad-slot'>f</div>"
               "<script>if(a<b)'</p>'</script><style>p{}</style><!-- <p>g</p> --><footer>h</footer></article>"
               "<div class='cookie-notice'>i</div><footer>j</footer>") == "T\n\nx & y <z> é"
    assert one("<p>one<p>two<b>bold<br>line</p>a < b<div>c</div") == "one\n\ntwobold line\n\na < b\n\nc"
    assert one("<table><tr><td>a<td>b<tr><td>c</table><ul><li>d<ul><li>e</ul><li>f</ul>") == "a\n\nb\n\nc\n\nd\n\ne\n\nf"
    assert one("<p title='a>b'>t</p><!-- open") == "t"
    assert one("x<script>never closed <p>y") == "x"


def test_awkward_rows(spark):
    long = "<article>" + "".join(f"<p>p {k}</p>" for k in range(30_000)) + "</article>"
    rows = [(1, None, None), (2, None, ""), (3, "not a url", "<p>a</p>"), (3, "not a url", "<p>a</p>"),
            (None, "http://h/", "<p>b"), (4, "http://h/", long), (5, "http://h/", "<div>" * 3000 + "deep" + "</div>" * 3000),
            (6, "http://h/", "<" * 20_000), (7, "http://h/", "&" * 5000 + "&amp")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = pages.main_texts(df).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    assert by[1].text == by[2].text == "" and by[3].text == "a" and by[None].text == "b" and by[5].text == "deep"
    assert by[4].text.count("\n\n") == 29_999 and by[1].n_chars == 0
    assert pages.main_texts(df.limit(0)).collect() == []


def test_article_sections_and_headings_stay_whatever_their_ids(spark):
    body = ("<article><h1 class=banner>Title</h1><section id='related-work'><h2 id=search>Search</h2><p>One</p></section>"
            "<section id=discussion><p>Two</p></section><div id=comments><p>Reader</p></div><div class=share><p>Share</p></div>"
            "</article><div id=related-posts><p>Posts</p></div>")
    assert _texts(spark, [(1, "http://x/", body)])[1] == "Title\n\nSearch\n\nOne\n\nTwo"


def test_deep_pages_stay_linear(spark):
    source = "".join(f"<div>x{k}" for k in range(120_000))               # about 1 MB of divs that are never closed
    assert len(source) > 1_000_000
    made = pages.page(1, "http://deep/", source)
    assert len(made[3]) == len(made[6]) == len(made[7]) == 120_000
    nested = [(k, "http://deep/", "<div>" * 2000 + "menu" + "</div>" * 2000 + f"<p>Own {k}</p>") for k in range(6)]
    assert _texts(spark, nested)[4] == "Own 4"


def test_headings_and_quoted_passages_are_no_templates_on_a_bare_count(spark):
    def page(k):
        quote = "<p>One shared sentence</p>" if k < 6 else ""
        return (k, "http://j.example/", f"<div class=menu2><p>Go</p></div><h1>Introduction</h1>{quote}<p>Own {k}</p><p>See you</p>")
    got = _texts(spark, [page(k) for k in range(12)])
    assert got[2] == "Introduction\n\nOne shared sentence\n\nOwn 2" and got[9] == "Introduction\n\nOwn 9"


def test_counts_decide_what_the_query_gives(spark):
    """Without the counts a page that no rule speaks of keeps its host's box."""
    rows = [(k, "http://k.example/", f"<div><p>Our box</p></div><div><p>Own {k}</p></div>") for k in range(6)]
    df = spark.createDataFrame(rows, SCHEMA)
    text = lambda **o: {r.page_id: r.text for r in pages.extract(df, **o).collect()}
    assert {r.page_id: r.text for r in pages.main_texts(df).collect()} == text() == {k: f"Own {k}" for k in range(6)}
    assert text(min_pages=7)[3] == "Our box\n\nOwn 3"
