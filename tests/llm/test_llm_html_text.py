from __future__ import annotations

import html
import re

from touchline.llm import html_text

TREE = html_text.trained()


def main(page: str) -> str:
    return html_text.main_texts([page], TREE)[0]


def test_given_pages_match_a_plain_reading_of_their_article(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    found = {r["page_id"]: r for r in html_text.html_text(spark, sf_dir).collect()}
    assert len(found) == len(pages)
    for r in pages:
        inside = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.DOTALL)[1]
        parts = [" ".join(html.unescape(re.sub(r"</?b>", "", p)).split()) for p in re.split(r"<(?!/?b>)[^>]*>", inside)]
        text = " ".join(p for p in parts if p)
        got = found[r["page_id"]]
        assert (got["text"], got["n_chars"], got["url"]) == (text, len(text), r["url"])


def test_everything_around_the_article_goes():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>if (a < b) "</p>"</script></head><body>
    <header><h1>Site</h1><p>A long slogan of the site that goes on for a good while indeed</p></header><nav><a href=/>Home</a> All about us</nav>
    <div class="cookie-notice"><p>We use cookies on this site, and you agree by reading on and on and on.</p></div>
    <main><article><h1>Title &amp; more</h1><p class="intro">First&nbsp;para  with <a href=x>a link</a>.</p><p>Second.</p>
    <div class="advertisement">Buy this now, it is very good and very cheap</div><!-- <p>no</p> --><blockquote>Quote here</blockquote>
    <ul><li>item one</li><li>two</li></ul><table><tr><td>cell</td><td>b</td></tr></table></article>
    <section id="comments"><h2>Comments</h2><p>Nice article, I like it very much, thanks for writing all of this down.</p></section></main>
    <aside><p>Related stories that are long and go on and on and on for ever.</p></aside>
    <form><label>Name</label><textarea>typed</textarea><button>Send</button></form><footer>&copy; us, all of us, for a long time</footer><noscript>enable it</noscript></body></html>"""
    assert main(page) == "Title & more First para with a link. Second. Quote here item one two cell b"


def test_pages_without_sectioning_elements():
    prose = " ".join(["word"] * 40)
    page = f"<body><div><a href=a>Home</a></div><div><a href=b>All news</a></div><h1>Some title of it</h1><p>{prose}</p><p>{prose} <a href=c>more</a></p><div><a href=d>Next page please now</a></div>"
    assert main(page).split() == f"Some title of it {prose} {prose} more".split()


def test_broken_markup_and_references():
    assert main("<article><p>a<b>b<br>c<p>d &lt; e &#233; &amp f &am</article></div></p><footer>x") == "ab c d < e é & f &am"
    assert main("<article><p>cut <a href='x") == "cut"
    assert main("<article><p>a <script>never closed <p>b") == "a"
    assert main("") == ""


def test_nulls_repeats_and_empty_tables(spark):
    schema = "page_id long, url string, html string, text string"
    rows = [(1, "u", None, "x"), (None, None, "<article>a</article>", None), (2, "v", "", "y"), (2, "v", "", "y"), (3, "w", "<article>" + "<p>long text</p>" * 20_000, None)]
    found = sorted(html_text.extracted(spark.createDataFrame(rows, schema)).collect(), key=str)
    assert len(found) == 5 and {r["n_chars"] for r in found} == {0, 1, 20_000 * 10 - 1}
    assert html_text.extracted(spark.createDataFrame([], schema)).collect() == []


def test_silent_elements_end_where_they_are_closed_or_with_their_container():
    def texts(page):
        return [b.text for b in html_text.blocks(page)]

    assert texts("<p>a</p><svg class='icon'/><p>b</p><math/><p>c</p>") == ["a", "b", "c"]
    assert texts("<svg><title/><path d='x'/><text>no</text></svg><p>b</p>") == ["b"]
    for name in ("noscript", "object", "audio", "video", "canvas", "template", "svg"):
        assert texts(f"<div><p>a</p><{name}>no<p>no</p></div><p>b</p></{name}><p>c</p>") == ["a", "b", "c"]
        assert texts(f"<div><p>a</p><{name}><div>no<a>no</div></{name}><p>b</p></div>") == ["a", "b"]
    assert texts("<p>a</p><script>if (x < 1) '</div>'</script><p>b</p><style>no") == ["a", "b"]
    found = html_text.blocks("<div><h2>t<svg/></h2><video>no<h1>no</div>after</div>")
    assert [(b.text, b.heading) for b in found] == [("t", True), ("after", False)]


PROSE = [" ".join(f"{w}{i}" for i in range(60)) for w in ("alpha", "beta", "gamma", "delta", "epsilon")]
ARTICLE = "<article><h1>The title of it</h1>" + "".join(f"<p>{p}</p>" for p in PROSE) + "</article>"
TEXT = " ".join(["The title of it", *PROSE])
AROUND = "<nav><ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li></ul></nav>{}<footer>&copy; us and all of ours</footer>"


def test_a_container_around_the_page_does_not_outweigh_it():
    for wrapper in (
        "<form id='aspnetForm' action='x'>{}</form>",
        "<div class='header-and-body'>{}</div>",
        "<div class='meta-content search'>{}</div>",
        "<section class='related'>{}</section>",
    ):
        assert main("<html><body>" + wrapper.format(AROUND.format(ARTICLE)) + "</body></html>") == TEXT, wrapper
        assert main("<html><body>" + AROUND.format(wrapper.format(ARTICLE)) + "</body></html>") == TEXT, wrapper
        named = ARTICLE.replace("<article>", "<div class='story'>").replace("</article>", "</div>")
        assert main("<html><body>" + wrapper.format(AROUND.format(named)) + "</body></html>") == TEXT, wrapper


def test_content_names_within_boilerplate_do_not_reset_it():
    said = "I liked this a lot and would like to say so at some length, thank you for it."
    for extra in (
        f"<section class='comments'><article class='entry'><p>{said}</p></article><article class='entry'><p>{said}</p></article></section>",
        f"<div id='comments'><div class='post'><div class='text'>{said}</div></div></div>",
        "<section class='comments'>" + f"<article class='entry'><p>{said * 9}</p></article>" * 4 + "</section>",
        f"<div class='sidebar'><div class='post'>{said}</div></div>",
        f"<footer><div class='text'>{said}</div></footer>",
        f"<div class='newsletter'><p class='text'>{said}</p></div>",
    ):
        assert main("<html><body>" + AROUND.format(ARTICLE + extra) + "</body></html>") == TEXT, extra[:60]
        assert main("<html><body><form>" + AROUND.format(ARTICLE + extra) + "</form></body></html>") == TEXT, extra[:60]


def test_marked_cells_close_by_nesting():
    side = "<td class='sidebar'><table><tr><td>Poll of the day</td><td>Yes</td></tr></table>More of the side</td>"
    for row in (f"<tr>{side}<td>{ARTICLE}</td></tr>", f"<tr><td>{ARTICLE}</td>{side}</tr>", f"<tr>{side.removesuffix('</td>')}<td>{ARTICLE}</tr>"):
        assert main(f"<html><body><table>{row}</table></body></html>") == TEXT


def test_a_quote_in_a_bare_value_is_a_character():
    assert main("<article><p data-x=reader's>one</p><p title='a > b'>two</p><p title=\"it's\">three</p><p x=5\" y='>'>four</p></article>") == "one two three four"
