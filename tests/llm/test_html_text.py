"""Class names, text outside the article and hostile markup in the extraction of main text."""

import time

import pytest

from paytrail.llm import html_text
from paytrail.llm.html_text import main_text

BODY = "A paragraph of the story that is long enough to count as text."


@pytest.mark.parametrize("attribute", [
    'class="content no-sidebar"', 'class="ad-free"', 'class=share-price', 'id="related-work"', 'data-class="menu"', "title='x class=menu'"])
def test_names_that_only_contain_a_mark_keep_their_text(attribute):
    assert main_text(f"<body><div {attribute}><p>{BODY}</p></div></body>") == BODY


@pytest.mark.parametrize("attribute", [
    'class="wide sidebar"', "class='sidebar-left'", "id=cookie-banner", 'class="related_posts"', 'role="navigation"', 'class="ad-slot-2"',
    'class="site-header"', 'CLASS="Comments"'])
def test_marked_elements_are_skipped(attribute):
    assert main_text(f"<body><p>{BODY}</p><div {attribute}><p>{BODY} Not this.</p></div></body>") == BODY


def test_only_the_article_counts_where_there_is_one():
    page = f"<article><p>Short story.</p></article><div class=legal><p>{BODY}</p><p>{BODY}</p></div>"
    assert main_text(page) == "Short story."
    assert main_text(f"<article></article><p>{BODY}</p>") == BODY


def test_hostile_pages_take_linear_time():
    start = time.time()
    for page in ("<a x " * 200_000 + '"', "<a '" * 250_000, '<div class="' * 80_000, "<p " + "x " * 500_000, "<" * 1_000_000):
        main_text(page)
    assert time.time() - start < 20
    assert main_text(f'<p title="x>{BODY}</p>') == BODY
    assert main_text("") == main_text(None) == ""


def test_surge_and_dive_decide_on_every_page(monkeypatch):
    links = "<p><a href=x>Elsewhere</a></p>" * 4
    pages = [f"<article><p>{BODY}</p></article>{links}", f"<p>{BODY}</p>{links}",
             f"<article><p>{BODY}</p></article>{links}<article><p>Second.</p></article>"]
    assert [main_text(p) for p in pages] == [BODY, BODY, f"{BODY}\nSecond."]
    assert html_text.regions([0, 0, 0, 5, 0, 9, 0, 0, 0, 2]) == [(3, 6, 14, 14), (9, 10, 2, 2)]
    monkeypatch.setattr(html_text, "regions", lambda lengths: [])
    assert [main_text(p) for p in pages] == ["", "", ""]


def test_the_region_with_the_longest_block_is_main_text():
    links = "<p><a href=x>Elsewhere</a></p>" * 4
    notes = "".join(f"<p>Note number {i}.</p>" for i in range(60))
    assert main_text(f"<p>{BODY}</p>{links}{notes}").split("\n")[0] == BODY
