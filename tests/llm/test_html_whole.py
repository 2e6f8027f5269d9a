"""What pages must not lose."""

from __future__ import annotations

import pytest

from loomwork.llm import html_text

TEXT = "A long article that says what it has to say."


@pytest.mark.parametrize(
    "opening",
    ['<div class="content has-sidebar">', '<div class="overflow-hidden">', '<article class="post category-social comments-open">', '<main id="search">', '<div class="related">', "<form>"],
)
def test_marks_do_not_lose_the_article(opening):
    tag = opening[1:].split()[0].rstrip(">")
    page = f"<body>{opening}<h1>Title</h1><p>{TEXT}</p></{tag}></body>"
    assert html_text.extract(page, None, frozenset()) == f"Title\n{TEXT}"


@pytest.mark.parametrize("mark", ['class="ad"', 'class="box share"', 'id="cookie-notice"', 'class="related_search"', "hidden", 'style="display:none"'])
def test_marked_parts_go(mark):
    page = f"<body><div><p>{TEXT}</p><div {mark}>Away</div></div></body>"
    assert html_text.extract(page, None, frozenset()) == TEXT


def test_headline_and_lead_beside_the_body_stay(spark):
    rows = [(i, f"http://h.example/{i}", f"<body><div class=t>Menu</div><h1>Title {i}</h1><div class=lead>Lead {i % 3}</div><div class=body><p>{f'word{i} ' * 40}</p></div></body>") for i in range(6)]
    got = html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {i: f"Title {i}\nLead {i % 3}\n{(f'word{i} ' * 40).strip()}" for i in range(6)}
