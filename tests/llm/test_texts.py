"""Line dedup, licenses and HTML extraction."""

import random

import pytest
from pyspark.sql import functions as F

from resonara.llm import html_text, licenses, line_dedup
from tests_llm_helpers import repeated_run_lines

SCHEMA = "doc_id long, text string"


def deduped(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartition(3)
    return [row["text"] for row in line_dedup.line_dedup(docs, **options).orderBy("doc_id").collect()]


def brute(texts, min_chars):
    gone = repeated_run_lines([(text or "").split("\n") for text in texts], min_chars)
    return [text if text is None else "\n".join(line for at, line in enumerate(text.split("\n")) if (number, at) not in gone)
            for number, text in enumerate(texts)]


def test_runs_of_short_lines(spark):
    run = "aaaa\nbbbb\ncccc"
    texts = [f"one\n{run}\ntwo", f"three\n{run}\nfour", "aaaa\nfive", f"{run}\n{run}"]
    assert deduped(spark, texts, min_chars=12) == [texts[0], "three\nfour", texts[2], ""]
    assert deduped(spark, texts, min_chars=13) == texts[:3] + [f"{run}\n{run}"]


@pytest.mark.parametrize("seed", range(2))
def test_equals_brute_force(spark, seed):
    source = random.Random(seed)
    lines = ["", "a", "bb", "ccc", "dddd", "e" * 9]
    texts = ["\n".join(source.choices(lines, weights=(3, 3, 2, 2, 1, 1), k=source.randint(1, 14))) for _ in range(40)]
    texts += [texts[3], texts[3] + "\n" + texts[5], None, ""]
    for min_chars in (1, 5, 11):
        assert deduped(spark, texts, min_chars=min_chars) == brute(texts, min_chars)


def test_line_dedup_odd_rows(spark, odd, empty):
    found = line_dedup.line_dedup(odd)
    assert found.columns == odd.columns and found.count() == odd.count()
    texts = {}
    for row in found.collect():
        texts.setdefault(row["doc_id"], []).append(row["text"])
    assert texts[1][0].endswith("first own line") and "\n" in texts[1][0]
    assert sorted(texts[2]) == ["", "second own line"]  # the second of the equal rows repeats all of the first
    assert texts[3] == [None] and texts[4] == [""] and len(texts[8][0]) == 200_000
    assert line_dedup.line_dedup(empty).count() == 0


def findings(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    rows = licenses.license_scan(docs, licenses.known_licenses(spark)).collect()
    return sorted((row["id"], row["license_id"], row["unit"], row["position"]) for row in rows)


def test_license_forms(spark):
    mit = licenses.KNOWN[0][1]
    changed = "Copyright (c) 2020 Some Body\n\n" + mit.replace('"Software"', "'Software'").upper() + "\nCopyright 2021, Others"
    texts = [mit, changed, mit.replace("restriction", "any restriction"),
             "Some prose.\nLicensed under CC BY-NC 4.0.\nMore.", "A paragraph\nof prose.\n\n** Released under the MIT Licence! **",
             "licensed under the Apache Licence, version 2.0", None, "", "Copyright (c) 2020 Nobody", "mit", "The license is not here."]
    assert findings(spark, texts) == [
        (0, "MIT", "text", 0), (1, "MIT", "text", 0), (3, "CC-BY-NC-4.0", "line", 1),
        (4, "MIT", "line", 3), (4, "MIT", "paragraph", 1), (5, "Apache-2.0", "text", 0)]


def test_full_license_texts(spark):
    known = licenses.license_texts
    bullets = known.BSD_3.replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* ")
    texts = {"Apache-2.0": known.APACHE_2, "GPL-2.0-only": known.GPL_2, "GPL-3.0-only": known.GPL_3, "LGPL-3.0-only": known.LGPL_3,
             "MPL-2.0": known.MPL_2, "CC0-1.0": known.CC0_1, "BSD-2-Clause": "Copyright (c) 2020, Some Body\n\n" + known.BSD_2,
             "BSD-3-Clause": "BSD 3-Clause License\n\nCopyright (c) 2020, Some Body\nAll rights reserved.\n\n" + bullets,
             "Zlib": known.ZLIB.replace("License", "Licence"), "Unlicense": known.UNLICENSE}
    found = {(number, license_id) for number, license_id, unit, _ in findings(spark, list(texts.values())) if unit == "text"}
    assert found == set(enumerate(texts))


def test_license_odd_rows(spark, odd, empty):
    known = licenses.known_licenses(spark)
    assert licenses.license_scan(odd, known).count() == 0
    assert licenses.license_scan(empty, known).count() == 0
    assert licenses.license_scan(odd.withColumn("text", F.lit("MIT License")), known).count() == odd.count()
    assert licenses.license_scan(odd, known.limit(0)).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><a href=/>Site</a></header><nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav>
<div id="cookie-notice">We use cookies, many cookies, all of them.</div>
<div class="layout with-sidebar"><div id="content"><h1>Title &amp; more</h1><div class="text">
<p>First  paragraph,\n with a <a href=/x>link</a>, and commas.<p>Second&nbsp;one, <b>bold</b> text.<br>Same block.
<blockquote>A quote</blockquote><ul><li>item one<li>item two</ul><form><input><p>Your mail, please</p></form></div></div>
<div class="sidebar"><p>Aside, aside, aside, aside, aside, aside.</p></div></div>
<section id="comments"><h2>Comments</h2><p>Me too, I like, this, very, much, so, much, that, I, repeat.</p></section>
<div class=advert>Buy, buy, buy</div><footer>&copy; Site</footer></body>"""


def test_page():
    assert html_text.main_text(PAGE) == ("Title & more\nFirst paragraph, with a link, and commas.\n"
                                         "Second one, bold text. Same block.\nA quote\nitem one\nitem two")


@pytest.mark.parametrize("html, text", [
    ("", ""), ("<p>a<b>b</b> c</p>", "ab c"), ("a < b & c", "a < b & c"), ("<div", ""), ("</p></div>x", "x"),
    ("<article><h1>A</h1><p>B<article class=comment><p>c, c, c, c</article></article>", "A\nB"),
    ("<p>one<p>two<!-- <p>three -->", "one\ntwo"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
    ("<p>x &lt;b&gt; &#228;&auml;&amp;amp;</p>", "x <b> ää&amp;"), ("<script>x</script>", ""),
])
def test_small_pages(html, text):
    assert html_text.main_text(html) == text


LONG = "A sentence of the article, long enough to be read as prose, and with commas."


@pytest.mark.parametrize("around", ["article", "main", "div"])
def test_names_inside_the_article(around):
    links = "".join(f"<li><a href=/{n}>Reference {n}</a></li>" for n in range(4))
    page = f"""<body><ul><li><a href=/1>Home</a><li><a href=/2>News</a><li><a href=/3>Mail</a></ul><{around}><h1>Title</h1><p>{LONG}</p><p>{LONG}</p>
<h2 id="discussion">Discussion</h2><p class="notice">{LONG}</p><p>{LONG} <span id="search">search</span></p>
<section id="related-work"><h3 id="search">Search</h3><p>{LONG}</p><p>{LONG}</p></section><ol>{links}</ol>
<div class="related"><a href=/4>Other page</a> <a href=/5>One more</a></div><div class="share">Share this</div><div class="ad">{LONG}</div>
<div class="comments"><div class="comment"><p>{LONG}</p></div><div class="comment"><p>{LONG}</p></div></div></{around}></body>"""
    assert html_text.main_text(page).split("\n") == [
        "Title", LONG, LONG, "Discussion", LONG, f"{LONG} search", "Search", LONG, LONG, *[f"Reference {n}" for n in range(4)]]


@pytest.mark.parametrize("around", ["article", "main", "div"])
@pytest.mark.parametrize("number", [1, 2, 20])
@pytest.mark.parametrize("outer, inner", [
    ('div id="comments"', 'div class="comment"'), ('div class="comment-body"', "div"), ('div class="user-comments"', "div"), ('div class="responses"', "div"),
    ('section id="comments"', "div"), ('section class="replies"', "article"), ('ol class="commentlist"', "li"), ("ul", 'li class="comment"'),
    ('div id="disqus_thread"', "div"), ('div id="respond"', "div"), ("div", 'article class="comment"'), ('div class="replies"', "blockquote")])
def test_comments_inside_the_article_go(around, number, outer, inner):
    if inner == "article" and around != "article":
        pytest.skip("an unnamed article outside any other is the page's")
    tags = [tag.split()[0] for tag in (outer, inner)]
    comments = "".join(f"<{inner}><p>{LONG}</p><p>{LONG} Really, {n}.</p></{tags[1]}>" for n in range(number))
    page = f"""<body><{around}><h1>Title</h1><p>{LONG}</p><section id="reply-to-critics"><h2 id="replies">Replies</h2><p class="comment">{LONG}</p></section>
<p>{LONG}</p><{outer}>{comments}</{tags[0]}></{around}></body>"""
    assert html_text.main_text(page).split("\n") == ["Title", LONG, "Replies", LONG, LONG]


def test_deep_and_long_pages():
    assert html_text.main_text("<div>" * 20_000 + "x") == "x"
    assert len(html_text.main_text("<p>" + "word " * 200_000)) == 999_999


def test_extract_odd(spark, odd, empty):
    found = odd.withColumn("main", html_text.extract("text")).collect()
    assert all(row["main"] == " ".join((row["text"] or "").split()) for row in found)
    assert empty.select(html_text.extract("text")).count() == 0


def test_pages_keep_their_article(spark, small_folder):
    import html
    import re
    for row in spark.read.parquet(f"{small_folder}/pages.parquet").withColumn("main", html_text.extract("html")).collect():
        article = re.search("<article>(.*?)</article>", row["html"], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " ", block)).split()) for block in re.split("</?(?:p|h1)>", article))
        assert row["main"] == "\n".join(filter(None, blocks))
