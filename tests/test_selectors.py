"""Selectors, fields and spans: sites' own selectors, brute force on random pages."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewatch.sources import pages
from tidewatch.sources.selectors import (VOID, Automaton, Field, chains, cut, element_spans, read_fields, read_rows)

# fixed values: the structure and selectors of a news site and of a community site
NEWS = """<html><body><div id="czone"><div class="news_title_wrap inner"><h2><span> Fire &amp; smoke </span></h2>
<div><div class="date">2024.02.03. 오후 01:05.</div></div><div class="date">other</div></div>
<div class="news_title_wrap"><h2><span>not inner</span></h2></div></div>
<div id="CmAdContent">
 First line<br>second <b>bold</b><script>var x = "<p>";</script><!-- gone --> end.
</div></body></html>"""
NEWS_RULES = {
    "time": Field("#czone > div.news_title_wrap.inner > div > div.date", strip=True),
    "title": Field("#czone > div.news_title_wrap.inner > h2 > span", strip=True),
    "content": Field("#CmAdContent", strip=True),
}
POST = """<div class="fl"><span class="nick">me</span><span class="gall_date">2024.02.03 13:05:59</span></div>
<h3 class="title ub-word"><span class="title_headtext">[x]</span><span class="title_subject">Subject</span></h3>
<div class="fr">first</div><div class="fr">조회 1,234 추천 56 댓글 7</div>
<div class="up_num_box"><p class="up_num">1,056</p></div><div class="down_num_box"><p class="down_num">x</p></div>
<div class="write_div">loose text<p>para <i>one</i><div class="imgwrap"><img src="a"><div>caption</div></div></p>
<div class="og-div"><p>preview</div><p>unclosed<div>in a div</div> - dc official App</div>"""
POST_RULES = {
    "time": Field("div.fl span.gall_date"),
    "title": Field("h3.title.ub-word span.title_subject"),
    "views": Field("div.fr", index=1, words=(6, 1)),
    "body": Field("div.write_div", drop=(".imgwrap", ".og-div"), sep="\n"),
    "likes": Field("div.up_num_box p.up_num"),
}


def fields(html, rules):
    return dict(zip(rules, read_fields(html, rules), strict=True))


def test_news_site_fields():
    assert fields(NEWS, NEWS_RULES) == {"time": "2024.02.03. 오후 01:05.", "title": "Fire & smoke",
                                        "content": "First linesecond bold end."}


def test_post_site_fields():
    assert fields(POST, POST_RULES) == {
        "time": "2024.02.03 13:05:59", "title": "Subject", "views": "1,234", "likes": "1,056",
        "body": "loose text\npara\none\nunclosed\nin a div\n- dc official App"}


def test_paragraphs_attributes_and_lists():
    html = ('<span class=update-time data-published-time="2024-01-02 03:04">x</span>'
            '<article class="story-news article"><p> one </p><p class="ad">no</p><div><p>deep</p></div><p>two</article>'
            '<ul class=list><li><a class=x href="/a">A</a><i>1</i><li><a href="/b">B</a></ul>')
    rules = {"time": Field(".update-time", attr="data-published-time"),
             "body": Field("article.story-news.article > p:not([class])", index=None, strip=True),
             "n": Field("article p, li", count=True), "none": Field("article p", attr="title")}
    assert fields(html, rules) == {"time": "2024-01-02 03:04", "body": "one two", "n": "6", "none": None}
    # a list item that is not closed holds the next one; its fields go to the inner row
    assert read_rows(html, "ul.list li", {"link": Field("a", attr="href"), "n": Field("i")}) == [
        ["/a", "1"], ["/b", None]]


def test_pages_that_cannot_be_read():
    assert read_fields(None, NEWS_RULES) is None and element_spans(None, Automaton(["a"])) is None
    assert read_fields("", NEWS_RULES) == [None] * 3 and read_rows(None, "a", NEWS_RULES) == []
    for bad in ("", "a >", "a:hover", "> > a b:"):
        with pytest.raises(ValueError):
            Automaton([bad])


# -- brute force ------------------------------------------------------------------------

TOKEN = re.compile(r"<(/?)(\w+)((?: \w+=\"[^\"]*\")*)>|([^<]+)")
TAGS, CLASSES = ["a", "b", "p", "br"], ["x", "y"]
start = st.builds(lambda t, c, i: f"<{t}" + (f' class="{" ".join(c)}"' if c else "") + (' id="k"' if i else "") + ">",
                  st.sampled_from(TAGS), st.lists(st.sampled_from(CLASSES), max_size=2), st.booleans())
page = st.lists(st.one_of(start, st.sampled_from([f"</{t}>" for t in TAGS]), st.sampled_from(["t", "u v", "\n"])),
                max_size=25).map("".join)
part = st.sampled_from(["a", "b", "p", "*", ".x", "a.x", "b.x.y", "#k", "p:not(.x)", "*:not([class])", "[class]",
                        "[id=k]"])
selector = st.lists(st.tuples(part, st.sampled_from([" ", " > "])), min_size=1, max_size=3).map(
    lambda x: "".join(p + c for p, c in x[:-1]) + x[-1][0])


def plain_tree(html):
    """[(tag, classes, id, path of ancestors' numbers, begin, end)], by a plain stack."""
    rows, stack = [], []
    for m in TOKEN.finditer(html):
        if m[4]:
            continue
        if not m[1]:
            attrs = dict(re.findall(r'(\w+)="([^"]*)"', m[3]))
            rows.append([m[2], set(attrs.get("class", "").split()), attrs, [*stack], m.start(), None])
            if m[2] in VOID:
                rows[-1][5] = m.end()
            else:
                stack.append(len(rows) - 1)
        elif any(rows[i][0] == m[2] for i in stack):
            while rows[stack[-1]][0] != m[2]:
                rows[stack.pop()][5] = m.start()
            rows[stack.pop()][5] = m.end()
    for i in stack:
        rows[i][5] = len(html)
    return rows


def plain_match(rows, i, steps):
    """Whether element i matches the steps, by trying every ancestor."""
    child, cond = steps[-1]
    tag, classes, attrs, path, *_ = rows[i]
    if not cond.fits(tag, attrs, classes):
        return False
    if len(steps) == 1:
        return True
    above = path[-1:] if child else path
    return any(plain_match(rows, j, steps[:-1]) for j in above)


@settings(max_examples=400, deadline=None)
@given(page, st.lists(selector, min_size=1, max_size=3))
def test_spans_and_matches_equal_brute_force(html, selectors):
    rows = plain_tree(html)
    got = element_spans(html, Automaton(selectors))
    hit = [any(plain_match(rows, i, c) for s in selectors for c in chains(s)) for i in range(len(rows))]
    assert [(g[3], g[2], g[6], g[9], g[10]) for g in got] == [
        (r[0], len(r[3]), r[4], r[5], h) for r, h in zip(rows, hit, strict=True)]
    # cutting intervals leaves exactly the characters outside of all matched elements
    gone = set()
    for r, h in zip(rows, hit, strict=True):
        if h:
            gone |= set(range(r[4], r[5]))
    assert cut(html, [(g[6], g[9]) for g in got if g[10]]) == "".join(
        c for i, c in enumerate(html) if i not in gone)


# -- jobs -------------------------------------------------------------------------------

def test_drop_blocks_keeps_the_rest(spark):
    df = spark.createDataFrame([(1, NEWS, "x"), (2, POST, None), (3, None, "y"), (4, "", "z")],
                               "page_id bigint, html string, begin string")
    got = {r.page_id: r for r in pages.drop_blocks(df, [".imgwrap", ".og-div", "#czone div.date"]).collect()}
    assert got[3].html is None and got[4].html == "" and got[1].begin == "x"
    assert '<div class="write_div">loose text<p>para <i>one</i></p>\n<p>unclosed' in got[2].html
    assert "other" not in got[1].html and "Fire &amp; smoke" in got[1].html and "var x" in got[1].html


def test_posts_news_and_failed_pages(spark):
    df = spark.createDataFrame([(1, "u1", POST), (2, "u2", "<p>nothing</p>"), (3, "u3", None), (4, "u4", NEWS)],
                               "page_id bigint, url string, html string")
    rules = {**POST_RULES, "heading": POST_RULES["title"]}
    got = {r.link: r for r in pages.extract_records(df, "site", "2024-01-01 00:00:00", rules).collect()}
    assert set(got) == {"u1", "u2", "u4"}  # the page that cannot be read is no record
    u1 = got["u1"]
    assert (str(u1.post_time), u1.title, u1.view_count, u1.like_count) == ("2024-02-03 13:05:59", "Subject", 1234, 1056)
    assert u1.content == "loose text para one unclosed in a div - dc official App"
    assert (str(got["u2"].post_time), got["u2"].title, got["u2"].content) == ("2024-01-01 00:00:00", "Untitled", " ")
    _, unread = pages.drop_unread(pages.extract_posts(df, "site", rules))
    assert [r.link for r in unread.collect()] == ["u3"]

    hits = spark.createDataFrame([("u4", "M1"), ("u4", "M2"), ("u4", "M1"), ("u1", "M1"), ("u9", "M1")],
                                 "url string, keyword string")
    ends = F.lit("2024-02-03 13:05:00").cast("timestamp_ntz"), F.lit("2024-02-03 14:00:00").cast("timestamp_ntz")
    good, bad = pages.news_records(df, hits, "N", *ends, NEWS_RULES)
    assert sorted((r.keyword, r.title, str(r.post_time), r.source) for r in good.collect()) == [
        (k, "Fire & smoke", "2024-02-03 13:05:00", "N") for k in ("M1", "M2")]
    assert [(r.link, r.title) for r in bad.collect()] == [("u1", None)]
    assert pages.news_records(df, hits, "N", ends[1], ends[1], NEWS_RULES)[0].count() == 0
