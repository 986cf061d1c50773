"""op2: wrappers, main text and edge cases."""

import html
import re

from predlake.llm import queries, wrappers

SF = "/root/testdata/sf0.01"
SCHEMA = "page_id long, url string, html string, text string, host string"
PAGE = ("<!DOCTYPE html><html><head><title>T {0}</title><script>var a = '<p>no</p>';</script><style>p{{}}</style></head><body><header>Site {0}</header>"
        "<nav><a href=/>Home {0}</a></nav><div class='sidebar'>links {0}</div><!-- <p>hidden</p> --><article><h1>Head {0}</h1><p>One &amp;  <b>two</b> {0}"
        "<br>three<p>Four</p><div class=share-bar>Share {0}</div><ul><li>x {0}<li>y</ul><form>mail {0}</form></article>"
        "<section id='comments'><p>reader {0}</p></section><footer>&copy; {0}</footer></body></html>")


def test_main_text_of_an_article():
    want = "Head 1\n\nOne & two 1 three\n\nFour\n\nx 1\n\ny"
    assert wrappers.main_text(PAGE.format(1), None) == want


def test_alignment_finds_slots_options_and_repeats():
    pages = ["<div><h1>a</h1><p>x</p></div>", "<div><h1>a</h1><p>y</p><p>z</p></div>", "<div><h1>a</h1><b>n</b><p>q</p></div>"]
    w = wrappers.wrap(wrappers.parse(pages[0]))
    for p in pages[1:]:
        w = wrappers.align(w, wrappers.wrap(wrappers.parse(p)))
    assert wrappers.expression(w) == "<div><h1>a</h1>(<b>n</b>)?(<p>#</p>)+</div>"


def test_content_without_an_article_element_and_shared_texts(spark):
    page = "<html><body><div id=top>logo</div><div id=content><p>{0} first long paragraph</p><p>{0} second one</p><div class=x>Read on, friend</div></div></body></html>"
    rows = spark.createDataFrame([(i, "http://h.example/", page.format(f"text {i}"), "old", "old") for i in range(10)], SCHEMA)
    got = wrappers.extract_text(rows)
    assert got.columns == ["page_id", "url", "html", "text", "host", "n_chars"]
    for r in got.collect():
        assert r.text == f"text {r.page_id} first long paragraph\n\ntext {r.page_id} second one" and r.n_chars == len(r.text)


def test_pages_of_one_template_alike_in_all_copies(spark):
    rows = spark.createDataFrame([(i, "http://h.example/", PAGE.format(1), "", "") for i in range(12)], SCHEMA)
    assert {r.text for r in wrappers.extract_text(rows).collect()} == {wrappers.main_text(PAGE.format(1), None)}


def test_shared_texts_are_counted_on_different_pages(spark):
    page = "<html><body><article><h1>Head {0}</h1><div class=x>Read on, friend</div><p>words of {0} that differ <b>Note</b> from page to page</p>{1}</article></body></html>"
    copied = page.format("copied", "<blockquote>only this article says so</blockquote><pre>and this</pre>")
    rows = [(i, "http://copies.example/", copied, "", "") for i in range(10)] + [(10 + i, "http://copies.example/", page.format(i, ""), "", "") for i in range(3)]
    rows += [(20 + i, "http://few.example/", page.format(i, ""), "", "") for i in range(2)]
    rows += [(30 + i, "http://near.example/", f"<article><p>The same article on both pages</p><i>{i}</i></article>", "", "") for i in range(2)]
    got = {r.page_id: r.text for r in wrappers.extract_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    plain = "Head {0}\n\nwords of {0} that differ Note from page to page"
    assert {got[i] for i in range(10)} == {plain.format("copied") + "\n\nonly this article says so\n\nand this"}
    assert [got[i] for i in (10, 11, 12, 20, 21)] == [plain.format(i) for i in (0, 1, 2, 0, 1)]
    assert got[30] == "The same article on both pages\n\n0"


def test_no_text_beside_the_largest_group_is_lost(spark):
    page = ("<html><body><div class=top>Our paper</div><div class=page><div class=lede>intro {0}</div><div class=body><p>{1}</p></div><div class=more>{2}</div></div></body></html>")
    rows = [(i, "http://h.example/", page.format(i, f"long text of {i} " * 20, f"second part of {i}"), "", "") for i in range(10)]
    rows += [(10, "http://h.example/", page.format(10, "short", "most of the text of this page " * 9), "", "")] * 5
    rows += [(11, "http://h.example/", "<html><body><div class=top>Our paper</div><div class=page><div class=other>a rarer page</div></div></body></html>", "", "")]
    got = {r.page_id: r.text for r in wrappers.extract_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i in range(10):
        assert got[i] == "\n\n".join([f"intro {i}", (f"long text of {i} " * 20).strip(), f"second part of {i}"])
    assert got[10] == "intro 10\n\nshort\n\n" + ("most of the text of this page " * 9).strip() and got[11] == "a rarer page"


def test_odd_pages(spark):
    odd = [None, "", "plain text &lt;b&gt; only", "<p>cut off at &am", "<article><p>open <b>still", "<<>><p", "<script>never closed <p>x</p>", "</div></p>stray",
           "<p>" + "word " * 60_000 + "</p>", "<div>" * 300 + "deep" + "</div>" * 300]
    rows = [(i, None if i % 2 else "ftp://x", h, "", "") for i, h in enumerate(odd)] + [(None, "http://Ex.org/a", PAGE.format(3), "", "")] * 2
    got = {}
    for r in wrappers.extract_text(spark.createDataFrame(rows, SCHEMA)).collect():
        got.setdefault(r.page_id, []).append(r.text)
    assert got[0] == [""] and got[1] == [""] and got[2] == ["plain text <b> only"] and got[3] == ["cut off at &am"] and got[4] == ["open still"]
    assert got[6] == [""] and got[8] == [("word " * 60_000).strip()] and got[9] == ["deep"] and len(got[None]) == 2
    assert wrappers.extract_text(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_equals_the_articles_by_hand(spark):
    """The pages of the test tables hold their text in one article element without boilerplate inside."""
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in queries.QUERIES["op2_wrapper_extraction"](spark, SF).collect():
        inside = re.sub(r"<[^>]*$", "", pages[r.page_id].split("<article>", 1)[-1].split("</article>")[0] if "<article>" in pages[r.page_id] else "")
        want = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inside)]
        assert r.text == "\n\n".join(b for b in want if b) and r.n_chars == len(r.text)


def extracted(spark, pages):
    rows = spark.createDataFrame([(i, f"http://{host}/", h, "", "") for i, (host, h) in enumerate(pages)], SCHEMA)
    return {r.page_id: r.text for r in wrappers.extract_text(rows).collect()}


def test_pages_of_any_depth(spark):
    deep = ["<div>" * 5000 + "deep" + "</div>" * 5000, "<b>" * 5000 + "unclosed", "<p><b>" * 3000 + "mixed", "<ul><li>" * 3000 + "lists", "<article>" * 2000 + "articles"]
    got = extracted(spark, [("deep.example", h) for h in deep] + [(f"alone{i}.example", h) for i, h in enumerate(deep)])
    assert [got[i] for i in range(10)] == ["deep", "unclosed", "mixed", "lists", "articles"] * 2


def test_signs_inside_quoted_attributes():
    read = wrappers.main_text
    assert read('<p title="x > y">hello</p>', None) == "hello"
    assert read("<p title='a > b' data-x=\"<b>\">one<p class=q>two", None) == "one\n\ntwo"
    assert read('<p title="never closed>text', None) == "text" and read("<p title=a\"b>text", None) == "text" and read("<p>it's 3 > 2 <b>\"so\"</b></p>", None) == "it's 3 > 2 \"so\""
    assert read('<article title = "1 > 0" class=\'main\'><h1 id="a=b>c">T</h1>x</article>', None) == "T\n\nx"


def test_all_articles_of_a_page(spark):
    page = "<body><nav>menu</nav><article class=lead><h1>Head {0}</h1><p>short {0}</p></article><div class=teaser>teaser {0}</div><article class=story><p>" + "much longer text of {0} " * 9 + "</p></article></body>"
    got = extracted(spark, [("two.example", page.format(f"n{i}")) for i in range(6)])
    for i in range(6):
        assert got[i] == f"Head n{i}\n\nshort n{i}\n\n" + (f"much longer text of n{i} " * 9).strip()


def test_headings_of_an_article_header_and_plain_words_as_classes():
    page = "<article><header><a class=nav href=/>up</a><h1>Title <i>here</i></h1><p>by someone</p></header><p class=legal>The law says so.</p><div class=side>On the other side</div><footer>tags</footer></article>"
    assert wrappers.main_text(page, None) == "Title here\n\nThe law says so.\n\nOn the other side"


def test_a_wrapper_is_as_large_as_the_template_whatever_the_slugs(spark):
    page = "<body><div id=top>Our paper</div><article id='post-{0}' class='post category-{1} tag-{0}'><h1>Head {0}</h1><div class=x>Read on, friend</div><p class='p-{0}'>words of {0}</p></article></body>"
    names = ["".join("abcdefghij"[int(c)] for c in str(i)) for i in range(1600)]
    sizes = {}
    for n in (100, 1600):
        rows = spark.createDataFrame([(i, "http://slugs.example/", page.format(names[i], names[i][::-1]), "", "") for i in range(n)], SCHEMA)
        sizes[n] = len(wrappers.wrappers(rows.selectExpr("'slugs.example' as host", "html")).first().wrapper)
        got = {r.page_id: r.text for r in wrappers.extract_text(rows).collect()}
        assert all(got[i] == f"Head {names[i]}\n\nwords of {names[i]}" for i in range(n))   # the shared line is known as such
    assert sizes[1600] <= sizes[100] + 40 < 1500


def test_sequences_are_aligned_in_order():
    def whole(*pages):
        w = wrappers.wrap(wrappers.parse(pages[0]))
        for p in pages[1:]:
            w = wrappers.align(w, wrappers.wrap(wrappers.parse(p)))
        assert wrappers.expression(wrappers.loaded(wrappers.dumped(w))) == wrappers.expression(w)
        return wrappers.expression(w)
    assert whole("<dl><dt>a<dd>b<dt>c<dd>d</dl>", "<dl><dt>e<dd>f</dl>") == "<dl>(<dt>#</dt><dd>#</dd>)+</dl>"
    assert whole("<h1>a</h1><p>x</p><h2>s</h2><p>y</p>", "<h1>a</h1><p>x</p><p>z</p><h2>s</h2>") == "<h1>a</h1>(<p>#</p>)+<h2>s</h2>(<p>y</p>)?"
    assert whole("<ul><li>a<li>b<li>c</ul>", "<ul></ul>", "<ul><li>d</ul>") == "<ul>(<li>#</li>)+?</ul>"


def test_a_wrapper_is_bounded_and_what_it_lacks_is_kept(spark, monkeypatch):
    monkeypatch.setattr(wrappers, "WRAPPER_NODES", 40)
    rare = "".join(f"<section class=s{chr(97 + i % 26)}{chr(97 + i // 26)}><h2>part {i}</h2><p>text {i}</p></section><hr>" for i in range(60))
    w = wrappers.pruned(wrappers.wrap(wrappers.parse(f"<article><h1>T</h1>{rare}</article>")))
    assert sum(1 for _ in wrappers.nodes_of(w)) == 40
    got = wrappers.main_text(f"<article><h1>T</h1>{rare}</article>", w)
    assert got == "T\n\n" + "\n\n".join(f"part {i}\n\ntext {i}" for i in range(60))


def test_many_hosts_are_joined_by_salt_with_the_same_result(spark, monkeypatch):
    pages = [(f"h{i % 3}.example", PAGE.format(f"n{i}")) for i in range(30)]
    want = extracted(spark, pages)
    monkeypatch.setattr(wrappers, "BROADCAST_CHARS", 0)
    assert extracted(spark, pages) == want
