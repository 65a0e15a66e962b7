import html
import re

import pytest

from bulwark.llm import htmltext

LONG = "This is a paragraph with quite a few words, so that its ratio of text to tags is high enough to count. " * 2


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("<html><body></body></html>", ""), ("<script>var a = '<p>x</p>';</script>", ""),
    ("<article><h1>T &amp; U</h1><p>a  <b>b</b>\n c<br>d</p><p>e&nbsp;&#233;&quot;</article>", 'T & U\n\na b c d\n\ne é"'),
    ("<nav>menu</nav><article><header><h1>Head</h1></header><p>x<div class='ad'>buy</div><aside>side</aside><p>y<section id=comments><p>me too</section></article><footer>f</footer>", "Head\n\nx\n\ny"),
    ("<main><form>name <input> <p>hidden</form><p>shown<p hidden>no<p>yes</main>tail", "shown\n\nyes"),
    (f"<div class=menu><a>a</a><a>b</a></div><div id=body><p>{LONG}</p><p>short</p><p>{LONG}</p></div><div><a>x</a> <a>y</a> <a>z</a></div>", f"{LONG.strip()}\n\nshort\n\n{LONG.strip()}"),
    ("<article><ul><li>one<li>two</ul></section></div>three</article>", "one\n\ntwo\n\nthree"),
    ("<article><p>a<!-- b --><style>p{}</style>c &unknown; &copy;</p><p>unclosed <b>bold", "ac &unknown; ©\n\nunclosed bold"),
    ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a\n\nb\n\nc"),
    ("<article><p>" + "word " * 100_000 + "</p></article>", ("word " * 100_000).strip()),
])
def test_pages(page, want):
    assert htmltext.main_text(page) == want


def test_characters_split_between_feeds():
    text = "&amp;&#233;" * (htmltext.FEED // 4)
    assert htmltext.main_text(f"<article><p>{text}</p></article>") == html.unescape(text)


def test_smoothing_keeps_a_constant_and_spreads_a_peak():
    assert htmltext.smoothed([3.0] * 9, 2.0) == pytest.approx([3.0] * 9)
    out = htmltext.smoothed([0.0] * 10 + [10.0] + [0.0] * 10, 2.0)
    assert out[10] == max(out) < 10 and out[9] == pytest.approx(out[11])


def test_rows_and_columns(spark):
    rows = [(1, None, 5), (1, "<article>x</article>", 5), (None, "<article>x</article>", None)]
    out = htmltext.extract(spark.createDataFrame(rows, "page_id long, html string, N_CHARS int"))
    assert out.columns == ["page_id", "text", "n_chars"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, "", 0), (1, "x", 1), (None, "x", 1)], key=str)
    assert htmltext.extract(out.limit(0).selectExpr("page_id", "text as html")).count() == 0


def test_registered_query(spark, sf):
    from bulwark.llm.queries import QUERIES

    got = {r["page_id"]: r for r in QUERIES["op9_tag_ratio_text"](spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        article = r["html"][r["html"].index("<article>") : r["html"].index("</article>")].replace("<br>", " ")
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1|article)>", article))
        want = "\n\n".join(b for b in blocks if b)
        assert tuple(got[r["page_id"]]) == (r["page_id"], r["url"], want, len(want))
