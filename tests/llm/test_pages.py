"""HTML extraction against known texts."""

import collections

import pytest

from chemprobe.llm.html_extract import extract, extract_pages, host_paths, vote, with_host

CASES = [
    (None, ""),
    ("", ""),
    ("   \n ", ""),
    ("plain text only", "plain text only"),
    ("<p>a &amp; b&nbsp;c &#233;&lt;</p>", "a & b c é<"),
    ("<body><nav><a href=/>Home</a></nav><article><h1>T</h1><p>One  two<br>three</p><p>Four</article><footer>f</footer>", "T\nOne two three\nFour"),
    ("<article><p>x <b>bold<br><p>y</article><div class='ad'>buy now buy now buy now buy now</div>", "x bold\ny"),
    ("<article><p>text</p><!-- <p>hidden</p> --><script>var a='</p>';</script><style>p{}</style><p>more</p></article>", "text\nmore"),
    ("<main><div class=content><p>Long enough text here.</p><ul><li>one<li>two</ul></div><section class='comments'><p>I like it so very much that I write more than the author did.</p></section></main>", "Long enough text here.\none\ntwo"),
    ("<div id=main><p>Story.</p><form><label>Mail</label><input></form><div class='cookie-banner'>We use cookies</div><aside>Side</aside><p>End.</p></div>", "Story.\nEnd."),
    ("<article><header><h1>Title</h1></header><p>Body text.</p></article><header>Site name</header>", "Title\nBody text."),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
    ("<p>" + "word " * 30000 + "</p>", ("word " * 30000).strip()),
    ("<div" * 500, ""),
]


@pytest.mark.parametrize("html,text", CASES)
def test_text(html, text):
    if html and html.startswith("<div<div"):
        extract(html, None)  # anything but a crash
    else:
        assert extract(html, None) == text


def test_votes_generalise_numbers():
    a = vote("<body><div class='post-12'><p>Some text of a page.</p></div>")
    b = vote("<body><div class='post-13'><p>Some other text of a page.</p></div>")
    assert a[0] == b[0] and a[1] > 0


def test_host_consensus(spark):
    page = "<body><div class='story'><p>{}</p></div><div class='box'><p>{}</p></div>"
    rows = [(i, f"http://h.example.com/{i}", page.format("The story itself goes here. " * 9, "short")) for i in range(5)]
    # on this page the other box is longer, but the host's pages agree
    rows.append((9, "http://h.example.com/9", page.format("A brief story here.", "More and more boxed text. " * 3)))
    rows += [(20, None, None), (21, "odd", ""), (22, "https://user@H.example.com:80/x", page.format("Upper host.", "")), (0, "http://h.example.com/0", rows[0][2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in extract_pages(pages).collect()}
    assert got[9]["text"] == "A brief story here."
    assert got[20]["text"] == "" and got[20]["n_chars"] == 0 and got[21]["text"] == ""
    assert got[22]["text"] == "Upper host."
    assert extract_pages(pages).count() == len(rows)
    assert {r["host"] for r in with_host(pages).collect()} == {"h.example.com", ""}
    assert [r["path"] for r in host_paths(pages).collect()] == ["/body/div.story"]
    assert collections.Counter(r["n_chars"] == len(r["text"]) for r in got.values()) == {True: len(got)}


def test_empty_table(spark):
    assert extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


STORY = "The story itself goes here, and on and on. " * 5
WRAPPED = [
    (f"<body><div class='content-sidebar-wrap'><article><p>{STORY}</p></article><div class='sidebar'>Side</div></div>", STORY),
    (f"<body><div class='has-sidebar'><p>{STORY}</p></div>", STORY),
    (f"<body><div id='page-with-header'><main><p>{STORY}</p></main></div>", STORY),
    (f"<body><div class='sidebar'><main><p>{STORY}</p></main></div>", STORY),
    (f"<body><form id=aspnet><div><p>{STORY}</p></div></form>", STORY),
    (f"<body><form><article><p>{STORY}</p></article><label>Mail</label></form>", STORY),
    (f"<article><h2 id='share-prices'>Prices</h2><p>{STORY}</p><section id='legal'><p>The law.</p></section></article>", "Prices" + STORY + "The law."),
    ("<body><div class='legal'><p>All that is here.</p></div><div class='comments'><p>And said.</p></div>", "All that is here."),
    (f"<article><p>{STORY}</p></article><div class='comments'><article class=c><p>I say</p></article></div><div class='related-posts'>More</div>", STORY),
]


@pytest.mark.parametrize("html,text", WRAPPED)
def test_wrappers_do_not_empty_a_page(html, text):
    assert "".join(extract(html, None).split()) == "".join(text.split())


LIST = "".join(f"<li>item number {i} of the list</li>" for i in range(20))
PARTS = [
    (f"<body><article><h1>Title</h1><p>Lead.</p><div class='body'><p>{STORY}</p></div></article></body>", "Title" + "Lead." + STORY),
    (f"<body><article><p>Before.</p><ul>{LIST}</ul><p>After.</p></article></body>", "Before." + LIST.replace("<li>", "").replace("</li>", "") + "After."),
    (f"<body><div class='post'><h1>Title</h1><p>Lead.</p><div class='body'><p>{STORY}</p></div></div><div class='box'>Box</div></body>", "Title" + "Lead." + STORY),
    (f"<body><h1>Title</h1><div class='body'><p>{STORY}</p></div></body>", "Title" + STORY),
    (f"<body><div class='story'><p>{STORY}</p></div><div class='box'><p>Box</p></div></body>", STORY),
]


@pytest.mark.parametrize("html,text", PARTS)
def test_title_and_lead_stay_with_the_body(html, text):
    assert "".join(extract(html, None).split()) == "".join(text.split())
    assert "".join(extract(html, vote(html)[0]).split()) == "".join(text.split())


def test_host_with_two_templates(spark):
    first = "<body><div class='story'><p>{}</p></div></body>"
    second = "<body><div class='story'><p>A teaser of some length goes before.</p></div><div class='long'><p>{}</p></div></body>"
    rows = [(i, f"http://h.example.com/{i}", first.format(STORY)) for i in range(5)] + [(i, f"http://h.example.com/{i}", second.format("Another story. " * 8)) for i in (7, 8)]
    got = {r["page_id"]: r["text"] for r in extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0] == STORY.strip()
    assert got[7] == got[8] == "A teaser of some length goes before.\n" + ("Another story. " * 8).strip()


def test_a_path_that_covers_half_takes_both():
    html = f"<body><article><div class='a'><p>{STORY}</p></div><div class='b'><p>{STORY}</p></div></article></body>"
    assert extract(html, "/body/article/div.a").count("The story") == 10


LOST = [
    (f"<article><section><p>{STORY * 7}</p></section><section><p>{STORY * 3}</p></section></article>", STORY * 10),
    (f"<article><section><p>{STORY}</p></section><section><p>{STORY}</p></section></article>", STORY * 2),
    (f"<article><p>Before it.</p><table>{'<tr><td>a cell of it</td></tr>' * 60}</table></article>", "Before it." + "a cell of it" * 60),
    (f"<main><h1>Title</h1><div class=content><p>{STORY}</p></div></main>", "Title" + STORY),
    (f"<body><div class='layout has-sidebar'><article><p>{STORY}</p></article></div></body>", STORY),
    (f"<body><div class='post no-comments'><p>{STORY}</p></div></body>", STORY),
    (f"<body><div class='form-guide'><p>{STORY}</p></div></body>", STORY),
    (f"<article><p data=it's>{STORY}</p><p>It isn't {STORY}</p></article>", STORY + "It isn't" + STORY),
    (f"<article><p>{STORY}<a href=\"x>broken</a></p></article>", STORY + "broken"),
    (f"<article><p>{STORY} 3 < 4 and a<b>c</b></p></article>", STORY + "3 < 4 and ac"),
    ("<article><p>a</p></></ x><?php x ?><!doctype html><!---->b<p>c", "a\nb\nc"),
    ("<article><p>shown</p><p title='a > b'>too</p><tag never ends", "shown\ntoo"),
]


@pytest.mark.parametrize("html,text", LOST)
def test_nothing_of_the_article_is_lost(html, text):
    for path in (None, vote(html)[0]):
        assert "".join(extract(html, path).split()) == "".join(text.split())


BROKEN = {
    "tags that never end": "<div" * 250_000,
    "quotes that never end": "<a href=\"" * 110_000,
    "odd quotes": "<a x='\"" * 140_000,
    "nested blocks": "<div>" * 200_000 + "deep",
    "nested inline": "<b>x" * 150_000,
    "stray ends": "<i><div>" + "<b>" * 100_000 + "</i></section></p>" * 40_000,
    "blocks in inline": "<b>" * 100_000 + "<p>x</p>" * 60_000,
    "comments that never end": "<!--" * 250_000,
    "raw elements that never end": "<script><p>" * 90_000,
    "signs": "< " * 500_000,
    "references": "&amp" * 250_000,
    "lists": "<ul><li>x" * 100_000,
    "classes": "<p class='" + "a " * 400_000 + "'>x",
}


@pytest.mark.parametrize("html", BROKEN.values(), ids=BROKEN)
def test_a_megabyte_of_anything_takes_seconds(html):
    import time

    began = time.process_time()
    extract(html, vote(html)[0])
    assert time.process_time() - began < 20


def test_pages_without_a_host_go_by_themselves(spark):
    rows = [(i, None, f"<body><div class='a'><p>{STORY}</p></div><div class='b'><p>short</p></div></body>") for i in range(5)]
    rows.append((9, "no url", f"<body><div class='a'><p>short</p></div><div class='b'><p>{STORY}</p></div></body>"))
    got = {r["page_id"]: r["text"] for r in extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert set(got.values()) == {STORY.strip()}
