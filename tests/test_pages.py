"""Page extraction (C1, C2, C3, C8, C11) on hand-made messy HTML."""

from tidewatch.sources import pages

MESSY = ('<html><head><title>T &amp; x</title><script>var t="</p>";</script>'
         '<style>p{}</style></head><body><nav><a href="/a">A</a><a href="http://b/c">B</a></nav>'
         '<div class="ad box">Buy <div>nested</div> now</div>'
         '<article><h1>Head <b>line</b></h1><p><b>First  para<br><p> Second &lt;x&gt; </p>'
         '<div class="ad">skip me</div><p>  </p><p>Third</article><p>outside</p></body></html>')


def test_parse_page_messy():
    title, heading, body, n = pages.parse_page(MESSY)
    assert title == "T & x"
    assert heading == "Head line"
    assert body == "First  para Second <x> Third"
    assert n == 4


def test_parse_page_garbage():
    assert pages.parse_page(None) == (None, None, None, 0)
    assert pages.parse_page("no tags at all")[2] == ""


def test_extract_records_matches_direct_parse(spark):
    df = spark.createDataFrame([(1, "u1", MESSY), (2, "u2", "<p>x</p>")],
                               "page_id long, url string, html string")
    got = {r.link: r for r in pages.extract_records(df, "site", "2024-01-01 00:00:00").collect()}
    assert got["u1"].title == "Head line" and got["u1"].content == "First para Second <x> Third"
    assert got["u2"].title == "Untitled" and got["u2"].content == " "
    assert got["u1"].view_count == 0 and str(got["u1"].post_time) == "2024-01-01 00:00:00"


def test_extract_pages_table_brute_force(spark):
    """Every page of the sf0.001 table: Spark result == direct parse, and the
    dropped ad block never leaks into the body."""
    import pyarrow.parquet as pq
    from tidewatch.sources.standins import table
    sf = "/root/testdata/sf0.001"
    got = {r.page_id: r for r in pages.extract_pages(table(spark, sf, "pages")).collect()}
    t = pq.read_table(f"{sf}/pages.parquet").to_pylist()
    assert len(got) == len(t)
    for row in t:
        title, heading, body, n = pages.parse_page(row["html"])
        g = got[row["page_id"]]
        assert (g.title, g.heading, g.body, g.n_paragraphs) == (title, heading, body, n)
        ad = row["html"].split('<div class="ad">', 1)[1].split("</div>", 1)[0]
        assert ad not in (g.body or "")


def test_extract_links(spark):
    df = spark.createDataFrame([(1, MESSY)], "page_id long, html string")
    links = [r.link for r in pages.extract_links(df, base="https://h").orderBy("pos").collect()]
    assert links == ["https://h/a", "http://b/c"]


def test_extract_records_time_and_counts(spark):
    html = ('<article><h1>H</h1><p>b</p></article><span class="date">2024.02.03. 오후 01:05.'
            '</span><b class="views">1,234</b>')
    df = spark.createDataFrame([(1, "u", html), (2, "v", "<p>x</p>")],
                               "page_id long, url string, html string")
    rules = {"time_regex": r'<span class="date">([^<]*)</span>',
             "views_regex": r'<b class="views">([^<]*)</b>', "likes_regex": r'<i>([^<]*)</i>'}
    got = {r.link: r for r in pages.extract_records(df, "s", "2024-01-01 00:00:00", rules)
           .collect()}
    assert str(got["u"].post_time) == "2024-02-03 13:05:00" and got["u"].view_count == 1234
    assert got["u"].like_count == 0 and str(got["v"].post_time) == "2024-01-01 00:00:00"
