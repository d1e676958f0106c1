from __future__ import annotations

import doctest

from aisleworks.llm import html_extract

PAGES = "page_id long, url string, html string"
PAGE = (
    "<html><head><title>t</title><style>p{}</style><script>var a='</p>';</script></head><body class=home>"
    "<header><h1>Site</h1></header><nav><a href=/>Home</a></nav><div class='cookie-notice'>We use cookies</div>"
    "<div id=main><article class='post-12'><h1>Title &amp; more</h1><p>One\n two<br>three<p>Four &lt;b&gt; <b>bold"
    "<ul><li>item<li>other</ul><form>Name <input></form><div class='share'>Share</div></article>"
    "<section id=comments><p>First! I like this page very much indeed, thanks.</p></section></div>"
    "<aside>Also read</aside><div class='ad'>Buy</div><footer>&copy; me</footer></body></html>"
)
TEXT = "Title & more\nOne two three\nFour <b> bold\nitem\nother"


def run(spark, rows):
    return html_extract.extract_main_text(spark.createDataFrame(rows, PAGES)).collect()


def test_doctests():
    assert doctest.testmod(html_extract).failed == 0


def test_article_without_the_rest(spark):
    (row,) = run(spark, [(1, "http://a.example/x", PAGE)])
    assert row.text == TEXT and row.n_chars == len(TEXT) and row.host == "a.example"


def test_paths_are_voted_on_by_host(spark):
    prose = "Words that matter to the reader of this page. " * 5
    usual = f"<body><div class=story>{prose}</div><div class=extra>short</div></body>"
    odd = f"<body><div class=story>brief</div><div class=extra>{prose}</div></body>"
    rows = run(spark, [(k, "http://h/x", usual) for k in range(5)] + [(9, "http://www.h/y", odd), (10, "http://other/", odd)])
    found = {row.page_id: row.text for row in rows}
    assert found[9] == prose.strip(), "the host's path does not cut a page whose prose is elsewhere"
    assert found[10] == prose.strip() and found[1] == prose.strip()


def test_a_page_without_the_hosts_path_stands_for_itself(spark):
    usual = "<body><div class=story><p>Some words of prose.</p></div></body>"
    rows = run(spark, [(k, "http://h/x", usual) for k in range(3)] + [(9, "http://h/y", "<body><main><p>Mine alone</main>")])
    assert {row.page_id: row.text for row in rows}[9] == "Mine alone"


def test_nulls_empty_broken_and_repeated_rows(spark):
    rows = [(1, None, None), (None, "u", ""), (2, "http://h/", "<p>a<p>b"), (2, "http://h/", "<p>a<p>b"),
            (3, "http://h/", "plain text"), (4, "x", "<div><p>cut off &am"), (5, "x", "<p title='never closed>text")]
    found = sorted(((r.page_id or 0), r.text) for r in run(spark, rows))
    assert found[:5] == [(0, ""), (1, ""), (2, "a\nb"), (2, "a\nb"), (3, "plain text")]
    assert found[5] == (4, "cut off &am") and len(found) == 7
    assert run(spark, []) == []


def test_long_page_and_clashing_columns(spark):
    long = "<article>" + "<p>word</p>" * 20_000 + "</article>"
    frame = spark.createDataFrame([(1, "http://h/", long, "z", 3)], PAGES + ", host string, path int")
    (row,) = html_extract.extract_main_text(frame).collect()
    assert row.text.count("\n") == 19_999 and row.host == "h"


def test_whole_table_against_a_plain_reading(tables):
    import html
    import re

    pages = {row.page_id: row.html for row in tables("pages").collect()}
    for row in html_extract.extract_main_text(tables("pages")).collect():
        article = re.search(r"<article>(.*?)(?:</article>|$)", pages[row.page_id], re.S)[1]
        parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", part)).split()) for part in re.split(r"</?(?:p|h1)>", article))
        assert row.text == "\n".join(part for part in parts if part)


def test_title_lead_and_captions_beside_a_content_element(spark):
    body = "".join(f"<p>Paragraph {k} of the article, long enough to be most of it.</p>" for k in range(9))
    inner = f"<h1>Title</h1><p class=lead>The lead.</p><div class=entry-content>{body}</div><figure><figcaption>A caption</figcaption></figure>"
    whole = "\n".join(["Title", "The lead.", *(f"Paragraph {k} of the article, long enough to be most of it." for k in range(9)), "A caption"])
    beside = "<div class=extra>Words of another place.</div><ul><li><a href=/>Elsewhere</a></ul>"
    pages = [
        f"<body><article>{inner}</article>{beside}</body>",
        f"<body><main><div>{inner}</div></main>{beside}</body>",
        f"<body><div class=post>{inner}</div>{beside}</body>",
        f"<body>{inner}{beside}</body>",
        f"{inner}{beside}",
        f"<body><main>{inner.replace('<div class=entry-content>', '<article>').replace('</div>', '</article>')}</main>{beside}</body>",
        f"<body><div class=post><div class=top><h1>Title</h1><div>The lead.</div></div><div>{body}</div><div>A caption</div></div>{beside}</body>",
    ]
    rows = run(spark, [(10 * k + j, f"http://h{k}/", page) for k, page in enumerate(pages) for j in range(3)])
    assert {row.page_id: row.text for row in rows} == {10 * k + j: whole for k in range(len(pages)) for j in range(3)}


def test_names_that_only_sound_like_furniture(spark):
    body = "".join(f"<p>Paragraph {k} of the article, long enough to be most of it.</p>" for k in range(9))
    whole = "\n".join(f"Paragraph {k} of the article, long enough to be most of it." for k in range(9))
    kept = [
        f"<body class=overflow-hidden><article>{body}</article>", f"<body><article style='overflow:hidden'>{body}</article>",
        f"<body><article><div title='the hidden city'>{body}</div></article>", f"<body style='display: none'><article>{body}</article>",
        f"<body><div class='content has-sidebar'>{body}</div>", f"<body><form id=all><div class=sidebar>{body}</div></form>",
        f"<body><div class=content-sidebar-wrap><div>{body}</div><div class=sidebar>Elsewhere in words</div></div>",
        f"<body><article>{body}<div hidden>Unseen</div><div aria-hidden=true>Unseen</div><p style='color:red;display:none'>Unseen</p></article>",
        f"<body><article>{body}<div class=share-buttons>Share it</div><div class='box nav'>Next</div></article>",
    ]
    named = f"<body><article>{body}<h2 id=related-work>Related work</h2><section id=search-results-explained><p>How to read them.</p></section><h2 id=comments>Comments on it</h2></article>"
    short = "<body><article><p>A short note.</p></article><section id=comments>" + "<p>A reply of some length, as long as the note or so.</p>" * 9 + "</section>"
    found = {r.page_id: r.text for r in run(spark, [(k, f"http://h{k}/", p) for k, p in enumerate([*kept, named, short])])}
    assert [found[k] for k in range(len(kept))] == [whole] * len(kept)
    assert found[len(kept)] == whole + "\nRelated work\nHow to read them.\nComments on it" and found[len(kept) + 1] == "A short note."


BODY = "".join(f"<p>Paragraph {k} of the article, long enough to be most of it.</p>" for k in range(9))
WHOLE = "\n".join(f"Paragraph {k} of the article, long enough to be most of it." for k in range(9))


def texts(spark, *pages):
    found = {r.page_id: r.text for r in run(spark, [(k, f"http://h{k}/", page) for k, page in enumerate(pages)])}
    return [found[k] for k in range(len(pages))]


def test_the_hosts_path_decides_where_it_holds_most_of_the_prose(spark):
    prose = "Words that matter to the reader of this page. " * 9
    usual = f"<body><div class=story>{prose}</div><div class=extra>short</div></body>"
    mixed = f"<body><div class=story>{prose}</div><div class=extra>{'Words of elsewhere. ' * 12}</div></body>"
    rows = run(spark, [(k, "http://h/x", usual) for k in range(5)] + [(9, "http://h/y", mixed)])
    assert {row.page_id: row.text for row in rows}[9] == prose.strip()


def test_custom_elements_do_not_swallow_the_page(spark):
    raw = "script style iframe textarea title svg select math object canvas noscript template".split()
    pages = [f"<body><article><p>Before <{name}-x></{name}-x> after</p>{BODY}</article>" for name in raw]
    pages += [f"<{name}-card><body><article>{BODY}</article>" for name in raw]
    pages += [f"<body><article><p>a <svg class=icon /> b <svg><path d='M0'/><title>arrow</title></svg> c</p>{BODY}</article>"]
    pages += [f"<body><article><p>a <math><mi>x</mi></math> b</p><p>c <svg> d</p>{BODY}</article>"]
    pages += [f"<body><article><p>a <script>if (a</b>c) </p></script > b</p>{BODY}</article>"]
    got = texts(spark, *pages)
    assert got[: len(raw)] == [f"Before after\n{WHOLE}"] * len(raw)
    assert got[len(raw) : 2 * len(raw)] == [WHOLE] * len(raw)
    assert got[-3:] == [f"a b c\n{WHOLE}", f"a x b\nc\n{WHOLE}", f"a b\n{WHOLE}"]


def test_topics_inside_an_article_are_kept_and_furniture_is_not(spark):
    prose = "How the thing came to be looked for in the first place, and by whom."
    kept = [f"<section class=search><p>{prose}</p></section>", f"<p class=skip>{prose}</p>", f"<div class=side>{prose}</div>",
            f"<div class='side note'><div class=social><p>{prose}</p></div></div>"]
    gone = [f"<div class=share>{'Share it ' * 2}</div>", f"<div class=search>{prose}<input name=q></div>",
            f"<div class=related><a href=/>{prose}</a> and {prose[:30]}</div>", f"<div class=ad>{prose}</div>",
            f"<div class='cookie-notice'>{prose}</div>", f"<div class=side hidden>{prose}</div>"]
    got = texts(spark, *(f"<body><article>{BODY}{extra}</article>" for extra in [*kept, *gone]),
                f"<body><article><h2 class=social>Social</h2>{BODY}</article>")
    assert got[:4] == [f"{WHOLE}\n{prose}"] * 4
    assert got[4:-1] == [WHOLE] * len(gone)
    assert got[-1] == f"Social\n{WHOLE}"


def test_deep_containers_are_told_apart(spark):
    """The article's own container lies below more wrappers than a path could once name."""
    def page(k):
        wraps = "<div>" * 20
        return f"<body>{wraps}<div class=post-{k}>{BODY}</div><div class=more>{'Read on. ' * 1}</div>{'</div>' * 20}</body>"

    rows = run(spark, [(k, "http://h/", page(k)) for k in range(4)])
    assert {row.path.rpartition("@")[2].partition(":")[0] for row in rows} == {"21"}
    (depths,) = {tuple(sorted(depth for _, depth, _ in html_extract.candidates(page(k)))) for k in range(4)}
    assert depths == tuple(range(22))  # body, twenty wrappers, the post: each a path of its own


def test_nesting_without_end_takes_linear_time_and_memory(spark):
    import time
    import tracemalloc

    pages = ["<div>" * 100_000 + "text", "<div><p>x" * 50_000, "<b>" * 50_000 + "<p>x" * 50_000, "</i>" * 100_000 + "<p>x",
             "<h2>x" * 50_000, "<div class=side>" * 50_000 + "text", "<svg>" * 50_000 + "text", "<li>x" * 50_000, "<span>x</p>" * 50_000]
    began = time.time()
    tracemalloc.start()
    for page in pages:
        path = max(html_extract.candidates(page), key=lambda found: found[1], default=("",))[0]
        assert "text" not in page or "svg" in page or html_extract.main_text(page, path) == "text"
    assert tracemalloc.get_traced_memory()[1] < 300e6
    tracemalloc.stop()
    assert time.time() - began < 90
