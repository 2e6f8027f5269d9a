"""Wrappers are inferred from every page of a host, however many it has."""

from __future__ import annotations

from loomwork.llm import html_text

SCHEMA = "page_id long, url string, html string"


def page(i: int, lead: str = "") -> str:
    return f"<html><body><div class=bar><p>Our Site</p></div>{lead}<div class=text><p>{f'word{i} ' * 30}</p><p>more {i}</p></div></body></html>"


def test_what_few_pages_have_beside_the_usual_element_stays(spark):
    rows = [(i, f"https://a.example/{i}", page(i)) for i in range(300)]
    rows += [(300 + i, f"https://a.example/{300 + i}", page(300 + i, f"<div class=lead>lead of {i}</div>")) for i in range(3)]
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    body = lambda i: f"{(f'word{i} ' * 30).strip()}\nmore {i}"
    assert got == {i: body(i) for i in range(300)} | {300 + i: f"lead of {i}\n{body(300 + i)}" for i in range(3)}


def test_all_pages_count_copies_once_and_the_dealing_changes_nothing(spark):
    rows = [(i, f"https://{'ab'[i % 2]}.example/{i}", page(i, "<ul><li>x</li></ul>" if i % 7 == 0 else "")) for i in range(100)]
    rows += [(1000 + i, "https://a.example/0", rows[0][2]) for i in range(50)]
    tables = [spark.createDataFrame(rows, SCHEMA).repartition(n, "page_id") for n in (1, 6)]
    one, other = ({tuple(map(str, r)) for r in html_text.wrappers(t).collect()} for t in tables)
    assert one == other and len(one) == 2
    found = html_text.shapes(tables[1])
    assert found.count() == 100 and found.select("host", "shape").distinct().count() == 4
    kept = [html_text.page_tree(r[2]) for r in rows[:1]]
    assert [html_text._read_tree(html_text._kept_tree(t)) for t in kept] == kept


def test_shapes_summed_up_are_what_merging_pages_gives():
    pages = [page(i) for i in range(5)]
    trees = [html_text.page_tree(p) for p in pages]
    shape = None
    for t in trees:
        name, leaves = html_text._leaves(t)
        texts = [None if c.text is None else hash(c.text) for c in leaves]
        shape = shape or html_text.Shape(texts, leaves)
        shape.add(1, texts, [c.mass for c in leaves], html_text._kept_tree(t))
    merged, summed = html_text.infer(pages), shape.wrapper()
    assert summed.show() == merged.show() and "Our Site" in summed.show() and "word" not in summed.show()
    assert [(c.pages, c.mass) for c in html_text._leaves(summed)[1]] == [(c.pages, c.mass) for c in html_text._leaves(merged)[1]]
