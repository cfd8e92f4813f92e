import base64
import hashlib
import random

import pytest

from feedlake.llm import html_main, warc

PAGES = "page_id long, url string, html string"


def page(body, nav="<nav><ul><li><a href='/a'>Menu</a></li></ul></nav>", tail="<footer>&copy; x</footer></body></html>"):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body>{nav}{body}{tail}"


CASES = [
    (page("<article><h1>A &amp; B</h1><p><b>One<br><p>Two\n  three</p></article>"), "A & B\nOne\nTwo three"),
    (page("<!-- ad --><div class='ad'>Buy</div><article><p>x<i>y</i> &lt;b&gt; &am &copy;</p></article>"), "xy <b> &am ©"),
    (page("<article><p>cut here &amp", tail=""), "cut here &"),
    (page("<article><p>cut</p><p>tag</p", tail=""), "cut\ntag"),
    (page("<article><p>text</p><section id=comments><article class='comment'><p>me first</p></article></section></article>"), "text"),
    (page("<article><p>a</p><form><input value='x'><p>mail</p></form><aside>more</aside><p>b</p></article>"), "a\nb"),
    (page("<div role='navigation'>m</div><div class=\"cookie-notice\">ok?</div><p>body text</p>"), "body text"),
    (page("<main><ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table></main>"), "one\ntwo\nc1\nc2"),
    (page("<article><div class='entry-header'><h1>H</h1></div><p>b</p></article>", "<div id='page-header'>site</div>"), "H\nb"),
    ("<p>no wrapper</p> tail", "no wrapper\ntail"),
    ("", ""),
    (None, ""),
    ("a < b <3 & c", "a < b <3 & c"),
    ("<p class='x\">broken quote</p><p>after</p>", "broken quote\nafter"),
    ("<div hidden>secret</div><p title='a > b'>shown</p><script>never closed <p>x", "shown"),
]


@pytest.mark.parametrize("source,want", CASES)
def test_main_text_of_a_page(source, want):
    assert html_main.read_page(source or "")[0] == want


@pytest.mark.parametrize(
    "source,want",
    [
        (page("<div class='layout has-sidebar'><article><p>story</p></article></div>"), "story"),
        (page("<div class='layout sidebar'><article><p>story</p></article><p>side</p></div>"), "story"),
        (page("<form class='promo'><main><p>story</p></main></form>"), "story"),
        (page("<div class='related'><article><p>card</p></article></div><article><p>story</p></article>"), "story"),
        (page("<article><h2 id='related-work'>Related</h2><section id='social-history'><p>b</p></section></article>"), "Related\nb"),
        (page("<article><div style='overflow:hidden'><p title='a hidden gem'>c</p></div><p hidden='hidden'>d</p></article>"), "c"),
        (page("<article><p data-class='ad' data-hidden>e</p><p aria-hidden=false>f</p></article>"), "e\nf"),
        (page("<div hidden><article><p>secret</p></article></div><p>shown</p>"), "shown"),
    ],
)
def test_only_whole_names_mark_boilerplate(source, want):
    assert html_main.read_page(source)[0] == want


def test_recurring_subtrees_of_a_host_go(spark):
    rows = []
    for i in range(30):
        box = "<div><p>We value your privacy.</p></div>" if i % 2 else "<div><p>Sign up today!</p></div>"
        rows.append((i, f"https://User@Site.example:80/p/{i}", page(f"{box}<div><p>Story {i}</p><p>Shared line.</p></div>")))
    rows += [(100 + i, f"https://other.example/{i}", page("<div><p>We value your privacy.</p></div><p>own</p>")) for i in range(2)]
    rows += [(200 + i, f"http://art.example/{i}", page(f"<article><p>Shared line.</p><p>Story {i}</p></article>")) for i in range(9)]
    rows += [(300, None, page("<p>no host</p>")), (301, "not a url", None), (302, "https://site.example/x", "")]
    out = {r.page_id: r for r in html_main.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert len(out) == len(rows)
    assert out[3].text == "Story 3" or out[3].text == "Story 3\nShared line."
    assert "privacy" not in out[3].text and "Sign up" not in out[4].text
    assert "privacy" in out[100].text  # two pages are no template
    assert out[204].text == "Shared line.\nStory 4"  # article text stays though it recurs
    assert out[300].text == "no host" and out[301].text == "" and out[302].n_chars == 0
    assert html_main.extract(spark.createDataFrame([], PAGES)).collect() == []


def test_copies_of_a_page_are_one_page(spark):
    rows = [(i, f"https://c.example/{i}", page(f"<div><p>Story {i}</p></div>")) for i in range(16)]
    rows += [(100 + i, f"https://c.example/16?ref={i}", page("<div><p>The copied story</p></div>")) for i in range(4)]
    rows += [(200, "https://d.example/", "<p>one url</p>")] * 6
    rows += [(300, f"https://e.example/?s={i}", f"<script>var s={i}</script><p>The story of one page, with a token</p>") for i in range(6)]
    out = html_main.extract(spark.createDataFrame(rows, PAGES)).collect()
    assert len(out) == len(rows)
    assert {r.text for r in out if r.page_id in (100, 101, 102, 103)} == {"The copied story"}
    assert {r.text for r in out if r.page_id == 200} == {"one url"}
    assert {r.text for r in out if r.page_id == 300} == {"The story of one page, with a token"}


def test_recurring_boxes_in_an_article_go(spark):
    def body(i):
        offer = f"<div class='x{i}'><p>Get our weekly letter by mail!</p><ul><li>Tweet<li>Mail</ul></div>"
        tag = ("article", "main")[i % 2]
        return page(f"<div id='wrap'><{tag}><h1>Title</h1><div><p>Story {i}</p><p>A line that all stories share, still text.</p></div>{offer}</{tag}></div>")

    rows = [(i, f"https://a.example/{i}", body(i)) for i in range(40)]
    rows += [(100 + i, f"https://b.example/{i}", body(i)) for i in range(3)]
    rows += [(200 + i, f"https://c.example/{i}", page(f"<p>on {i}</p><article><div><p>The same story on many pages.</p></div></article>")) for i in range(9)]
    out = {r.page_id: r.text for r in html_main.extract(spark.createDataFrame(rows, PAGES)).collect()}
    for i in range(40):
        assert out[i] == f"Title\nStory {i}\nA line that all stories share, still text."
    assert "weekly" in out[100]  # three pages are no template
    assert {out[200 + i] for i in range(9)} == {"The same story on many pages."}


def test_templates_of_a_part_of_a_large_host_go(spark):
    def body(i):
        menu = "<div><ul><li>Section start</li><li>Section news</li></ul></div>" if i % 100 < 9 else ""
        line = "<p>This notice is shown with a few of the stories only.</p>" if 20 <= i % 100 < 29 else ""
        few = "<div><p>A passage that three stories share.</p></div>" if 50 <= i < 53 else ""
        cell = f"<table><tr><td>7<td>row {i}</table>" if 60 <= i < 69 else ""
        return page(f"{menu}<div><p>Story {i}</p>{cell}</div>{line}{few}")

    rows = [(i, f"https://big.example/{i}", body(i)) for i in range(400)]
    rows += [(1000 + i, f"https://small.example/{i}", body(i)) for i in range(100)]
    out = {r.page_id: r.text for r in html_main.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert (out[3], out[103], out[1003]) == ("Story 3", "Story 103", "Story 3")
    assert (out[25], out[325], out[1025]) == ("Story 25", "Story 325", "Story 25")
    assert out[65] == "Story 65\n7\nrow 65"  # a short cell is no template for its number of pages
    assert out[51] == "Story 51\nA passage that three stories share."


def test_extra_columns_and_repeated_pages(spark):
    rows = [(1, "https://a.example/", "<p>x</p>", "t"), (1, "https://a.example/", "<p>x</p>", "u"), (None, None, None, None)]
    pages = spark.createDataFrame(rows, PAGES + ", text string")
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in html_main.extract(pages).collect()) == [(0, "", 0), (1, "x", 1), (1, "x", 1)]


# --- archives --------------------------------------------------------------------


def brute_archive(rows):
    groups = {}
    for page_id, _, body in rows:
        groups.setdefault((body or "").encode(), []).append(page_id)
    out = []
    for page_id, _, body in rows:
        data = (body or "").encode()
        first = min((i for i in groups[data] if i is not None), default=None)
        revisit = first is not None and page_id != first
        sha = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page_id, len(data), sha, "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def archive_rows():
    rnd = random.Random(8)
    bodies = ["", None, "é\r\n\r\nWARC/1.1\r\n", "x" * 200_000, *[f"<p>{i}</p>" * rnd.randint(1, 90) for i in range(20)]]
    rows = [(i, rnd.choice([None, f"https://h.example/{i}", "https://h/\r\nEvil: 1 ü"]), rnd.choice(bodies)) for i in range(150)]
    return [*rows, rows[3], (None, "u", rows[4][2]), (None, None, "only without id"), (None, None, "only without id")]


def test_archives_round_trip(spark):
    rows = archive_rows()
    got = warc.round_trip(spark.createDataFrame(rows, PAGES))
    assert sorted(map(tuple, got.collect()), key=str) == brute_archive(rows)
    assert warc.round_trip(spark.createDataFrame([], PAGES)).collect() == []


def test_index_selects_byte_ranges(spark, tmp_path):
    rows = [(i, f"https://h.example/{i}", f"<p>{i}</p>" * 50) for i in range(200)]
    root = f"file://{tmp_path}/archives"
    plan = warc.plan_records(spark.createDataFrame(rows, PAGES).withColumn("refers_to", warc.F.lit("clash")))
    index = warc.write_archives(plan, root, file_bytes=2_000)
    assert index.select("file").distinct().count() > 5  # files roll
    some = index.where("page_id % 7 = 0")
    got = {r.page_id: (bytes(r.payload).decode(), r.url) for r in warc.read_records(some, root, gap=300, most=900).collect()}
    assert got == {i: (h, u) for i, u, h in rows if i % 7 == 0}
    assert warc.read_records(index, root).count() == 200


def test_neighbours_are_read_together():
    rows = [("a", 0, 10), ("a", 10, 10), ("a", 25, 5), ("a", 100, 5), ("b", 105, 5)]
    assert list(warc._spans(rows, gap=5, most=100)) == [
        ("a", 0, 30, [(0, 10), (10, 10), (25, 5)]), ("a", 100, 5, [(0, 5)]), ("b", 105, 5, [(0, 5)]),
    ]
    assert [s[2] for s in warc._spans(rows, gap=5, most=20)] == [20, 5, 5, 5]


def test_small_payloads_can_stay_responses(spark):
    rows = [(1, "u", "tiny"), (2, "u", "tiny"), (3, "u", "large " * 20), (4, "u", "large " * 20)]
    plan = warc.plan_records(spark.createDataFrame(rows, PAGES), min_revisit_bytes=50)
    assert {r.page_id: r.revisit for r in plan.collect()} == {1: False, 2: False, 3: False, 4: True}


def test_reader_comments_by_a_part_of_the_class_name():
    article = "<article><p>the text</p>{}</article>"
    for name in ("post-comments", "comment-body", "user-comments", "comments__list", "c-comment"):
        for box in (f"<div class='{name}'><p>me first</p></div>", f"<section class='x {name}'>me first</section>"):
            assert html_main.read_page(article.format(box))[0] == "the text", name
    # a box that only tells of comments, and a comment in shown code
    for name in ("has-comments", "no-comments", "code-comment"):
        assert html_main.read_page(article.format(f"<div class='{name}'>more</div>"))[0] == "the text\nmore"
    code = "<pre><span class='comment'># add</span> x + 1</pre>"
    assert html_main.read_page(article.format(code))[0] in ("the text\n# add x + 1", "the text\nx + 1")
    assert html_main.read_page(f"<div class='with-sidebar post-comments'>{article.format('')}</div>")[0] == "the text"


def test_deep_and_unbalanced_pages_take_linear_time():
    import time

    def seconds(n):
        pages = [
            "<div>" * n + "deep" + "</span>" * n, "<p><div>" + "<span>" * n + "<p>x</p>" * n, "<b>" * n + "<li>x" * n,
            "<div><p>" * n + "end", "</div>" * n + "text",
        ]
        start = time.perf_counter()
        texts = [html_main.read_page(p)[0] for p in pages]
        assert texts[0] == "deep" and texts[4] == "text"
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(100_000) < 30 * max(seconds(10_000), 0.05)
