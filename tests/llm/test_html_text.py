"""Main text of small pages."""

import re
from html import unescape

import numpy as np
import pytest

from touchline.llm import html_text, queries

LONG = "Some words of a longer paragraph that goes on for a while, as paragraphs do. " * 3


def test_query_keeps_articles_whole(spark):
    sf = "/root/testdata/sf0.001"
    pages = {row["page_id"]: row["html"] for row in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    found = queries.op7_html_text(spark, sf).collect()
    assert sorted(row["page_id"] for row in found) == sorted(pages)
    for row in found:
        article = re.search(r"<article>(.*?)</article>", pages[row["page_id"]], re.S)[1]
        blocks = re.sub(r"</?b>", "", re.sub(r"<br>|</?(p|h\d)>", " ", article))
        assert row["text"] == " ".join(unescape(blocks).split())
        assert row["n_chars"] == len(row["text"])


@pytest.mark.parametrize(
    "html, text",
    [
        ("", ""),
        ("plain &amp; simple\n text", "plain & simple text"),
        ("<p>a<b>b</b> c<p>d", "ab c d"),
        ("<p>unclosed <b>bold <i>both", "unclosed bold both"),
        ("<![weird[x]]><p>text</p>", None),
        ("<", "<"),
        ("<script>var a = '<p>no</p>'</script><style>p{}</style><!-- no --><p>yes</p>", "yes"),
        (f"<div id=x><h1>Head</h1><p>{LONG}</p><p>Short.</p></div><ul><li><a href=/>Home</a><li><a href=/>More</a></ul>",
         f"Head {LONG}Short."),
        (f"<nav><a href=/>Menu</a><article><h1>T</h1><p>{LONG}</p></article>", f"T {LONG}".strip()),
        (f"<div class='cookie-notice'>{LONG}</div><article>Tiny</article><div class=comments>{LONG}</div>", "Tiny"),
        (f"<article><header><h1>H</h1></header>{LONG}<aside>no</aside><form>no<p>no</form></article>", f"H {LONG}".strip()),
        (f"<header>Site</header><main>{LONG}</main><footer>&copy; us</footer>", LONG.strip()),
        (f"<article>{LONG}</article><article class=comment>{LONG} no</article>", LONG.strip()),
    ],
)
def test_pages(html, text):
    found = html_text.main_text(html)
    assert text is None or found == text


def test_smoothing_and_threshold():
    assert html_text.smoothed(np.ones(7)).tolist() == pytest.approx([1.0] * 7)
    values = np.array([0.0, 0.1, 0.2, 5.0, 5.1])
    assert 0.2 < html_text.threshold(values) < 5.0
    assert html_text.threshold(np.zeros(3)) == 0.0


def test_rows(spark, rows):
    table = [(1, "u", "<p>a</p>", "x"), (1, "u", "<p>a</p>", "x"), (2, None, None, "x"), (None, "v", "", "x")]
    frame = spark.createDataFrame(table, "page_id LONG, url STRING, html STRING, text STRING")
    assert rows(html_text.extract(frame)) == sorted([(1, "u", "a", 1), (1, "u", "a", 1), (2, None, "", 0), (None, "v", "", 0)], key=repr)
    assert html_text.extract(frame.limit(0)).collect() == []
    deep = "<div>" * 20_000 + "<b>" * 20_000 + "x"
    assert html_text.main_text(deep) == "x"
