import html
import re

import pytest

from netsift.llm.common import table
from netsift.llm.html_text import extract_text, main_text


def article_blocks(page):
    """What the test tables' pages hold, read off their markup: headings and paragraphs of the article."""
    body = page[page.index("<article>") + 9 :].split("</article>")[0]
    parts = re.split(r"</?(?:p|h1)>", re.sub(r"<br>|</?b>", " ", body))
    return "\n".join(t for t in (" ".join(html.unescape(x).split()) for x in parts) if t)


def test_pages_of_the_table(spark):
    pages = table(spark, "/root/testdata/sf0.1", "pages")
    want = {r.page_id: (r.url, article_blocks(r.html)) for r in pages.collect()}
    got = {r.page_id: (r.url, r.text) for r in extract_text(pages).collect()}
    assert got == want


LOREM = "A sentence that is long enough to be taken for running text, with some more words in it. "


def test_page_without_article_element():
    page = f"""<html><body><div id="header"><h1>Site</h1></div><ul class="main-menu"><li><a href=a>One</a><li><a href=b>Two</a></ul>
    <div class="cookie-notice">{LOREM}</div>
    <div class=content><h2>Title &amp; more</h2><p>{LOREM * 3}<p>Short.<p>{LOREM}&eacute;<script>if (a < b) "</p>"</script> end
    <div class="ad-box">{LOREM}</div><p><b>Bold {LOREM}<br>next</div>
    <div class="sidebar"><p>{LOREM}</p></div><section id=comments><p>{LOREM * 2}</p></section>
    <form><p>{LOREM}</p><input></form><footer>{LOREM}</footer>"""
    lines = main_text(page).split("\n")
    one = LOREM.strip()
    assert lines == ["Title & more", " ".join([one] * 3), "Short.", f"{LOREM}é end", f"Bold {one} next"]


def test_article_with_header_inside_and_comments():
    page = f"""<body><header>Top {LOREM}</header><main><article class="post article-header-x"><header><h1>Head</h1></header>
    <p>{LOREM}</p><ul><li>point one</li><li>point two</li></ul><blockquote>said</blockquote><table><tr><td>a<td>b</table>
    <aside>{LOREM}</aside><div class="share">share</div><div class="comments"><p>{LOREM * 5}</p></div></article></main>"""
    assert main_text(page).split("\n") == ["Head", LOREM.strip(), "point one", "point two", "said", "a", "b"]


def test_main_with_article_and_short_ends():
    page = f"""<body><main><article><h1>H</h1><p>{LOREM * 9}</p><p>End.</p></article><div><p>{LOREM}</p></div></main></body>"""
    assert main_text(page).split("\n") == ["H", (LOREM * 9).strip(), "End."]
    page = f"""<body><div class=nav><a href=x>a</a></div><div class=post><h1>H</h1><p>{LOREM * 9}</p><p>One.<p>Two.<p>Three.<p>End.</div><div class=footer>{LOREM}</div>"""
    assert main_text(page).split("\n") == ["H", (LOREM * 9).strip(), "One.", "Two.", "Three.", "End."]


def test_end_tags_left_out():
    one = LOREM.strip()
    assert main_text(f"<head><title>T</title><body><p>{LOREM}") == one
    assert main_text(f"<html><head><meta charset=utf-8><title>T</title><script>x</script><article><p>{LOREM}</article>") == one
    assert main_text(f"<head><title>T</title>{LOREM}<p>{LOREM}") == f"{one}\n{one}"
    assert main_text(f"<head><noscript><div>no</div></noscript><title>T</title></head><body><p>{LOREM}") == one
    assert main_text(f"<body><datalist><option value=a>a<option value=b>b</datalist><p>{LOREM}") == one
    assert main_text(f"<body><div><option>a<option>b</div><p>{LOREM}") == one
    assert main_text(f"<body><select><option>a<option>b</select><p>{LOREM}") == one


def test_words_and_forms_around_the_article():
    one, long = LOREM.strip(), (LOREM * 5).strip()
    side = f'<div class="sidebar"><p>{LOREM}</p></div>'
    for start in ("div class='has-sidebar'", "div class='layout-sidebar-right'", "div id='comments-list'", "form"):
        end = f"</{start.split()[0]}>"
        assert main_text(f"<body><{start}><article><h1>H</h1><p>{long}</article>{side}{end}<footer>{LOREM}</footer>") == f"H\n{long}"
        assert main_text(f"<body><{start}><div><h1>H</h1><p>{long}<p>{long}</div>{side}{end}") == f"H\n{long}\n{long}"
    assert main_text(f"<article><div class=elementor-widget-container><p>{long}</p></div>{side}</article>") == long
    page = f"""<article><h2 id=social-impact class=share>Social</h2><p>{LOREM}<section id=notice-periods><p>{LOREM}</section>
    <section id="sharing-data"><p>{LOREM}</section></article>"""
    assert main_text(page) == "\n".join(["Social", one, one, one])
    page = f"""<body><div class=post><h2 id=social-impact>Social</h2><p>{LOREM}<section id=notice-periods><p>{LOREM}</section><p>{LOREM}</div>"""
    assert main_text(page) == "\n".join(["Social", one, one, one])
    assert main_text(f"<body><form><p>{LOREM}</form><div class=post><p>{LOREM * 3}</div>") == (LOREM * 3).strip()


def test_math_in_a_paragraph():
    page = f"<article><p>{LOREM}<math><semantics><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></semantics></math> end</article>"
    assert main_text(page) == f"{LOREM}x=2 end"


def test_odd_input():
    assert main_text(None) == main_text("") == main_text("  \n ") == main_text("<p></p>") == ""
    assert main_text("just  text &lt;here&gt;") == "just text <here>"
    assert main_text("<article><p>unclosed &am <b>x") == "unclosed &am x"
    assert main_text("</div></p><article>" + "<div>" * 300 + "deep" + "</span>") == "deep"
    assert len(main_text("<article><p>" + LOREM * 30_000)) == len(LOREM) * 30_000 - 1


def test_nulls_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, None, None, "x"), (None, "u", "<p>hello there", "y"), (1, None, None, "x")], "page_id long, url string, html string, text string")
    got = sorted([tuple(r) for r in extract_text(df).collect()], key=str)
    assert got == [(1, None, "", 0), (1, None, "", 0), (None, "u", "hello there", 11)]
    assert extract_text(df.limit(0)).collect() == []


WORDY = "A sentence of the article with some more words in it than a menu has."


def test_names_with_other_words_in_them_exclude_nothing():
    table = "".join(f"<p>{WORDY} Row {i}.</p>" for i in range(6))
    page = f"<body><article><h1>Title</h1><p>{WORDY}</p><div class='share-price-table'>{table}</div><p class='notice-period'>{WORDY} Notice.</p><p>{WORDY}</p></article></body>"
    assert main_text(page).split("\n") == ["Title", WORDY, *[f"{WORDY} Row {i}." for i in range(6)], f"{WORDY} Notice.", WORDY]
    assert main_text(page.replace("share-price-table", "related").replace("notice-period", "x cookie-notice")).split("\n") == ["Title", WORDY, WORDY]


@pytest.mark.parametrize("tail,kept", [
    ('<a href="' + "x<y " * 250_000, ""), ("<!--" + "a<b;" * 250_000, ""), ("<div>" * 50_000, ""), ("<svg>" * 50_000 + "t", ""),
    ("<div>" * 50_000 + "</p></span></li>" * 50_000, ""), ("<script>" + "</" * 300_000, ""), ("<?" * 300_000, ""), ('<a "' * 100_000, ""),
], ids=["attribute", "comment", "nested", "hidden", "stray ends", "script", "instruction", "quotes"])
def test_broken_long_pages_take_time_in_proportion(tail, kept):
    import time

    began = time.perf_counter()
    assert main_text(f"<body><article><p>{WORDY}</p>" + tail) == WORDY
    assert time.perf_counter() - began < 10  # quadratic time would be minutes at least


def test_text_with_signs_that_are_no_tags():
    assert main_text("a<b and c <d " * 50) == ("a<b and c <d " * 50).strip()
    assert main_text("<p>if x<y then</p><p>more of it</p>").startswith("if x")


def _slow(blocks):
    """Ratios, smoothing and threshold written out for one block after another."""
    import math

    ratio = [0.0 if e.out else (len(t) - linked) / max(1, tags) for t, tags, linked, e in blocks]
    weight = {d: math.exp(-d * d / 2) for d in range(-3, 4)}
    total = sum(weight.values())
    even = [sum(w * ratio[min(max(i + d, 0), len(ratio) - 1)] for d, w in weight.items()) / total for i in range(len(ratio))]
    mean = sum(even) / len(even)
    least = min(math.sqrt(sum((x - mean) ** 2 for x in even) / len(even)), mean)
    return [max(a, b) >= least - 1e-9 and b > 0 for a, b in zip(even, ratio)]


def test_regions_against_brute_force(spark):
    from netsift.llm.html_text import Blocks, content_regions

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").limit(60).collect()
    for r in pages:
        blocks = Blocks().read(r.html or "")
        if blocks:
            assert content_regions(blocks).tolist() == _slow(blocks)
