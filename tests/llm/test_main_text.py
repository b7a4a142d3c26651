import html
import re
from pathlib import Path

import pytest

from skyledger.llm import main_text
from skyledger.llm.main_text import Page

PAGES = "page_id LONG, url STRING, html STRING, host STRING, paths INT, text STRING"
PROSE = "A sentence that is long enough to count as prose, and has commas. "


def text_of(source):
    page = Page(source)
    return page.text([page.best()])


def pages(spark, rows):
    return spark.createDataFrame([(k, *r, "x", 1, "y") for k, r in enumerate(rows)], PAGES)


@pytest.mark.parametrize(
    ("source", "expected"),
    [
        ("", ""),
        ("no markup &amp; &lt;b&gt; 1 < 2", "no markup & <b> 1 < 2"),
        ("<p>a&nbsp;\n\t b<br>c</p>\r\n<p>d<b>e</b>f</p>", "a b c def"),
        ("<p>&#65;&#x42;&eacute;&amp;copy;&ampx &unknown; &</p>", "ABé&copy;&x &unknown; &"),
        ("<article><h1>T</h1><p><b>u.<br><p>v</article><footer>f</footer>", "T u. v"),
        ("<p>a<!-- <p>b --> c<!-->d<!-- e", "a cd"),
        ("<article><p>x<script>'</p>' </scripty> y</script >z</p></article>", "xz"),
        ("<p>x<style>never closed <p>y", "x"),
        ("<p title='a > b' alt=\"</p>\">x</p><p", "x"),
        ("<head><title>t</title><meta charset=x></head><body>b</body></html> c", "b c"),
        ("<ul><li>a<li>b<ul><li>c</ul></ul>", "a b c"),
        ("<table><tr><td>a<td>b<tr><th>c</table>d", "a b c d"),
        ("<p>a<span class='ad'>b</span>c</p><p hidden>d</p><p style='display: none'>e</p>", "ac"),
        ("<!DOCTYPE html><![CDATA[x]]><?php y ?></ z>a", "a"),
        ("<P>A</P><ARTICLE CLASS=\"Comment\"><p>B</ARTICLE>", "A"),
    ],
)
def test_literal_pages(source, expected):
    assert text_of(source) == expected


def test_everything_else_is_left_out():
    parts = [
        "<nav><a href=/>menu words</a></nav>", "<header><h1>Site</h1></header>",
        "<div class='cookie-notice'><p>We use cookies, as all do.</p></div>",
        "<aside><p>More of the same site.</p></aside>", "<div id=sidebar><p>Side</p></div>",
        "<form><label>Name</label><select><option>one</select><textarea>t</textarea></form>",
        "<div role=navigation>role</div>", "<div aria-hidden=true>unseen</div>",
        "<noscript>switch it on</noscript>", "<button>press</button>", "<svg><text>s</text></svg>",
    ]
    body = f"<header><h1>Title</h1><p>by line</p></header><p>{PROSE}</p><div class=ad-box>buy</div><p>end</p>"
    comments = f"<div class=comments><h2>Said</h2><p>{PROSE * 9}</p></div>"
    source = "".join(parts) + f"<main><article>{body}{comments}</article></main><footer>f</footer>"
    assert text_of(source) == f"Title {PROSE}end".replace("  ", " ")
    # A wrapper with an unlucky name is not lost, nor is an article without its own element.
    assert text_of(f"<div class='page with-sidebar'><article>{PROSE}</article></div>") == PROSE.strip()
    assert text_of(f"<div class=widget><h1>T</h1><p>{PROSE}</p></div>") == f"T {PROSE.strip()}"


def test_containers_are_scored():
    links = "<div class=x>" + "<a href=/>a link of the page</a> " * 20 + "</div>"
    page = Page(f"{links}<div class=y><p>{PROSE * 3}</p></div><div class=z>short</div>")
    assert page.name(page.best()) == "div.y"
    two = Page(f"{links}<div class=w><div class=a1>{PROSE * 3}</div><div class=a2>{PROSE * 2}</div></div>")
    assert two.name(two.best()) == "div.w"


def test_deep_and_hostile_pages():
    assert text_of("<div>" * 3000 + "x" + "</div>" * 3000 + "y") == "x y"
    for odd in ("<a " * 50_000, '<a ="' * 50_000, "<!--" * 50_000, "</div>" * 50_000, "<p><b>" * 20_000):
        assert text_of(odd) == ""
    assert len(text_of("<p>word</p>" * 50_000)) == 5 * 50_000 - 1


def odd_page(extra=""):
    """Its own best container is not the one of its host."""
    return f"<div class=story0><p>Short news.</p></div><div class=promos><div class=y>{PROSE * 2}</div></div>{extra}"


def test_a_page_follows_its_host(spark):
    usual = f"<div class=story12><p>{PROSE}</p></div><div class=promos><div class=y>t</div></div>"
    rows = [("http://a.org/1", usual)] * 24 + [("http://A.org/2", odd_page())]
    rows += [("http://b.org/", odd_page()), (None, odd_page()), ("no host", odd_page())]
    found = [r for r in main_text.main_texts(pages(spark, rows)).orderBy("page_id").collect()]
    assert [r["path"] for r in found[:25]] == ["div.story0"] * 25
    assert found[24]["text"] == "Short news." and found[0]["text"] == PROSE.strip()
    for r in found[25:]:
        assert r["path"] == "div.promos/div.y" and r["text"] == (PROSE * 2).strip()


def test_votes_equal_a_plain_count(spark):
    rows = [(f"http://h{k % 3}.org/{k}", f"<div class=c{'ab'[k % 2]}><p>{PROSE}</p></div>") for k in range(50)]
    rows += [("http://h0.org/z", f"<section class=rare><p>{PROSE}</p></section>")]
    rows += [("http://h1.org/z", "<article>one of nineteen votes</article>")]
    votes = {}
    for url, source in rows:
        page = Page(source)
        host = votes.setdefault(url.split("/")[2], {})
        host[page.name(page.best())] = host.get(page.name(page.best()), 0) + 1
    expected = {
        host: sorted((p for p, n in of.items() if n * 20 >= sum(of.values())), key=lambda p: (-of[p], p))
        for host, of in votes.items()
    }
    found = main_text.host_paths(pages(spark, rows).repartition(7)).collect()
    assert {r["host"]: r["paths"] for r in found} == expected


def test_awkward_rows(spark):
    rows = [(None, None), ("", ""), ("http://x.org/", None), ("http://x.org/", "<p>a"), ("http://x.org/", "<p>a"),
            ("http://x.org/", "<p>" + "long text " * 200_000)]
    result = main_text.main_texts(pages(spark, rows))
    assert result.columns == ["page_id", "url", "text", "n_chars", "path"]
    found = {r["page_id"]: r for r in result.collect()}
    assert [found[k]["text"] for k in range(5)] == ["", "", "", "a", "a"]
    assert [found[k]["n_chars"] for k in range(6)] == [0, 0, 0, 1, 1, 1_999_999]
    assert main_text.main_texts(pages(spark, rows).limit(0)).isEmpty()


SMALL = Path("/root/testdata/sf0.001/pages.parquet")


@pytest.mark.skipif(not SMALL.exists(), reason="needs the test tables")
def test_articles_of_the_test_pages(spark):
    table = spark.read.parquet(str(SMALL))
    source = {r["page_id"]: r["html"] for r in table.collect()}
    for r in main_text.main_texts(table).collect():
        article = re.search("<article>(.*)</article>", source[r["page_id"]], re.S)[1]
        plain = " ".join(html.unescape(re.sub("<[^>]*>", " ", article)).split())
        assert r["text"] == plain and r["n_chars"] == len(plain)
