"""Pages on which names, neighbours and articles must not cost text."""

import pytest

from bulwark.llm.htmltext import main_text

LONG = ("This is a paragraph with quite a few words, so that its ratio of text to tags is high enough to count. " * 2).strip()


@pytest.mark.parametrize("page, want", [
    (f"<div class='has-sidebar'><article><p>{LONG}</p></article></div>", LONG),
    (f"<div class='content no-sidebar'><p>{LONG}</p><p>{LONG}</p></div>", f"{LONG}\n\n{LONG}"),
    (f"<div id=header class='banner'><div><article><p>{LONG}</p></article></div></div>", LONG),
    (f"<div class='widget'><p>{LONG}</p></div><div class=menu><a>a</a></div>", LONG),
    (f"<article><div class='entry-header'><h1>Head</h1></div><p>{LONG}</p></article>", f"Head\n\n{LONG}"),
    (f"<article><p>{LONG}</p><h2 id='related-work'>Related</h2><section id=search><p>Trees</p></section><p id='share-prices'>Fell</p></article>", f"{LONG}\n\nRelated\n\nTrees\n\nFell"),
    (f"<div class=post><h2 class='comment'>Title</h2><p class='notice'>{LONG}</p></div>", f"Title\n\n{LONG}"),
])
def test_marked_words_in_names_cost_no_text(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize("mark", ["class=ad", "class='box ads'", "id=comments", "class='cookie-banner'", "class='nav_menu x'", "class=sidebar"])
def test_marks_that_are_the_whole_name_still_leave_out(mark):
    for page in (f"<article><p>{LONG}</p><div {mark}><p>{LONG[:90]}</p></div></article>", f"<div><p>{LONG}</p></div><div {mark}><p>{LONG[:90]}</p></div>"):
        assert main_text(page) == LONG
    assert main_text(f"<div class=ad>{LONG} {LONG}</div><article>x</article>") == "x"


def paragraph(n):
    return ("word " * n)[: n - 1] + "."


@pytest.mark.parametrize("sizes", [[400, 350, 60, 420, 45, 380], [400, 350, 380, 60], [60, 400, 350], [400, 20_000, 400, *[380] * 20], [300, *[40] * 15, 300, 300]])
def test_one_container_for_each_paragraph(sizes):
    texts = [paragraph(n) for n in sizes]
    body = "".join(f"<div><p>{t}</p></div>" for t in texts)
    links = "".join(f"<li><a href=/{i}>item {i}</a></li>" for i in range(6))
    assert main_text(f"<nav>menu</nav>{body}<div><ul>{links}</ul></div><div><a>x</a> <a>y</a></div>") == "\n\n".join(texts)
    assert main_text(f"<div><ul>{links}</ul></div>{body}<footer>f</footer><div>tail</div>") == "\n\n".join(texts)


def test_an_article_is_a_prior_and_the_ratio_decides():
    body = "".join(f"<div><p>{i} {LONG}</p></div>" for i in range(8))
    want = "\n\n".join(f"{i} {LONG}" for i in range(8))
    links = "".join(f"<li><a href=/{i}>item {i}</a></li>" for i in range(9))
    assert main_text(f"<article><a href=/x>Read this next</a></article>{body}") == want
    assert main_text(f"{body}<article><h3><a href=/x>Next</a></h3></article>") == want
    assert main_text(f"<main><ul>{links}</ul>{body}<div><ul>{links}</ul></div></main>") == want
    assert main_text(f"<main>{body}</main><div>All rights reserved by somebody</div>") == want
    table = "".join(f"<tr><td>{i}<td>{i * i}" for i in range(20))
    cells = "\n\n".join(f"{i}\n\n{i * i}" for i in range(20))
    assert main_text(f"<article>{body}<p>Table</p><table>{table}</table></article>") == f"{want}\n\nTable\n\n{cells}"


ADVERT, ASIDE = "<div class='ad'>Buy this now</div>", "<aside>Elsewhere</aside>"
SIXTY = paragraph(300)
LIST = "<ul>" + "".join(f"<li><a href=/{i}>link {i}</a></li>" for i in range(5)) + "</ul>"
ITEMS = "\n\n".join(f"link {i}" for i in range(5))


@pytest.mark.parametrize("page, want", [
    (f"<article>{f'<p>{SIXTY}</p>' * 3}{ADVERT}<p>Short closing sentence here.</p></article>", f"{SIXTY}\n\n" * 3 + "Short closing sentence here."),
    (f"<article><p>{SIXTY}</p>{ASIDE}<p>Ok.</p>{ASIDE}<p>{SIXTY}</p></article>", f"{SIXTY}\n\nOk.\n\n{SIXTY}"),
    (f"<article><p>{SIXTY}</p><p>{SIXTY}</p>{ADVERT}<div>{paragraph(60)}</div></article>", f"{SIXTY}\n\n{SIXTY}\n\n{paragraph(60)}"),
    (f"<article><p>{SIXTY}</p>{LIST}<p>{SIXTY}</p></article>", f"{SIXTY}\n\n{ITEMS}\n\n{SIXTY}"),
    (f"<article><p>{SIXTY}</p><p><a href=/a>One</a></p><p><a href=/b>Two</a></p><p>{SIXTY}</p></article>", f"{SIXTY}\n\nOne\n\nTwo\n\n{SIXTY}"),
    (f"<article><p>{SIXTY}</p><div class=notice>Note</div><div class='login-guide'>{paragraph(96 * 5)}</div></article>", f"{SIXTY}\n\n{paragraph(96 * 5)}"),
    (f"<article><p>{SIXTY}</p><div class=notice>Note</div><div class='login-guide'>{paragraph(60)}</div><p>End.</p></article>", f"{SIXTY}\n\n{paragraph(60)}\n\nEnd."),
    (f"<form id=aspnet action=/><div><p>{SIXTY}</p><p>{SIXTY}</p></div><label>Your name</label><input></form>", f"{SIXTY}\n\n{SIXTY}"),
    (f"<form><nav>menu</nav><article><p>{SIXTY}</p><p>x</p></article><footer>f</footer></form>", f"{SIXTY}\n\nx"),
    (f"<article><p>{SIXTY}</p><form><p>Subscribe to our letters</p><label>Mail</label><input></form><p>End.</p></article>", f"{SIXTY}\n\nEnd."),
    (f"<div><p>{SIXTY}</p><p>{SIXTY}</p></div><form><p>Find</p></form>", f"{SIXTY}\n\n{SIXTY}"),
])
def test_articles_lose_no_text(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize("page", ["{o}<article><p>{t}</p></article>{c}", "<article>{o}<p>{t}</p>{c}</article>", "{o}<p>{t}</p>{c}</i></b>"])
def test_deep_nesting_is_linear(page):
    import time

    n = 8_000
    made = page.format(o="<div><b>x</b>" * n, c="</div></span>" * n, t=LONG)
    begun = time.process_time()
    assert LONG in main_text(made)
    assert time.process_time() - begun < 2
