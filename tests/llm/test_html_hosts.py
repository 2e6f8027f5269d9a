"""Whole hosts of generated pages against the articles they were made from, and the aligner against brute force."""

from __future__ import annotations

import html
import random
import time

import pytest

from loomwork.llm import html_text
from loomwork.llm.html_text import Node

SCHEMA = "page_id long, url string, html string"


def article(rng: random.Random) -> list[str]:
    words = lambda n: " ".join("".join(rng.choices("abcdeéü&<", k=rng.randint(1, 8))) for _ in range(n))
    return [words(rng.randint(3, 30)) for _ in range(rng.randint(2, 9))]


def page(rng: random.Random, layout: int, blocks: list[str]) -> str:
    """Menus, adverts, comments and a template text around the blocks; some paragraphs are not closed."""
    body = [f"<h1>{html.escape(blocks[0])}</h1>"]
    for i, b in enumerate(blocks[1:]):
        text = html.escape(b).replace(" ", rng.choice((" ", "\n  ")))
        if i % 3 == 2:
            body.append(f"<ul><li>{text}<li{" class=skip" if layout == 0 else ""}>{text} again</ul>")
        else:
            body.append(f"<p>{text}" + ("</p>" if rng.random() < 0.7 else ""))
    if rng.random() < 0.5:
        body.insert(rng.randint(1, len(body)), f"<div class='ad'>buy {rng.random()}</div>")
    inner = "".join(body)
    tail = f"<section id=comments><p>reader {rng.random()} says</p></section><form><p>write</p></form>"
    head = "<html><head><title>t</title><script>if (a < b) {}</script></head><body><nav><ul><li>Home</ul></nav>"
    shell = "<article>{}<p>Read us daily.</p></article>" if layout == 0 else "<div class=shell><div class=main-column>{}<p>Read us daily.</p></div></div>"
    return f"{head}<div class=top><p>Our Site</p></div>{shell.format(inner)}{tail}<footer>end</footer></body></html>"


def wanted(blocks: list[str]) -> str:
    out = [blocks[0]]
    for i, b in enumerate(blocks[1:]):
        out += [b, f"{b} again"] if i % 3 == 2 else [b]
    return "\n".join(" ".join(x.split()) for x in out)


def test_hosts_against_what_their_pages_were_made_from(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for i in range(90):
        blocks = article(rng)
        layout = 0 if i < 60 else 1
        rows.append((i, f"https://{'abc'[i // 30]}.example/{i}", page(rng, layout, blocks)))
        want[i] = wanted(blocks)
    rows += [(900, "https://a.example/x", None), (901, None, ""), (902, "https://a.example/1", rows[1][2]), (None, "https://b.example/n", rows[40][2])]
    want |= {900: "", 901: "", 902: want[1], None: want[40]}
    got = html_text.main_text(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.page_id: r.text for r in got} == want and len(got) == len(rows)
    assert all(r.n_chars == len(r.text) for r in got)


def test_a_layout_that_the_wrapper_does_not_know(spark):
    rng = random.Random(4)
    rows = [(i, f"https://a.example/{i}", f"<body><article><p>text {i} {'w ' * 30}</p></article></body>") for i in range(40)]
    blocks = article(rng)
    odd = f"<body><article><p>teaser</p></article><main><p>{'long story ' * 30}</p></main></body>"
    got = html_text.main_text(spark.createDataFrame([*rows, (99, "https://a.example/odd", odd)], SCHEMA)).collect()
    assert blocks and {r.page_id: r.text for r in got}[99] == ("long story " * 30).strip()


def test_template_counts_every_page_and_copies_once(spark):
    same = "<p>Read us daily.</p>"
    rows = [(i, f"https://a.example/{i}", f"<body><article><p>own {i}</p>{same if i < 90 else ''}</article></body>") for i in range(100)]
    rows += [(1000 + i, "https://b.example/", "<body><article><p>one page, many copies</p></article></body>") for i in range(20)]
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[3] == "own 3" and got[95] == "own 95" and got[1000] == "one page, many copies"


def value(a: list[Node], b: list[Node], pairs: list[tuple[int, int]]) -> int:
    assert all(x < y and s < t for (x, s), (y, t) in zip(pairs, pairs[1:]))
    assert all(html_text._alike(a[i], b[j]) for i, j in pairs)
    return sum(html_text._alike(a[i], b[j]) for i, j in pairs)


def best(a: list[Node], b: list[Node]) -> int:
    if not a or not b:
        return 0
    same = html_text._alike(a[0], b[0])
    return max(best(a[1:], b), best(a, b[1:]), same + best(a[1:], b[1:]) if same else 0)


@pytest.mark.parametrize("seed", range(30))
def test_the_aligner_finds_the_best_alignment(seed):
    rng = random.Random(seed)
    some = lambda: [Node("#", text=rng.choice("xy")) if rng.random() < 0.4 else Node(rng.choice("pqr")) for _ in range(rng.randint(0, 7))]
    a, b = some(), some()
    assert value(a, b, html_text._aligned(a, b)) == best(a, b)


def test_long_lists_are_aligned_in_pieces():
    rng = random.Random(1)
    a = [Node(rng.choice("pq"), children=[Node("#", text=str(i))]) for i in range(400)]
    b = [c for c in a if rng.random() < 0.9]
    b.insert(50, Node("new"))
    got = value(a, b, html_text._aligned(a, b))
    assert got == value(a, b, html_text._table(a, b)) == 2 * (len(b) - 1)
    alike = [Node("pq"[i % 2]) for i in range(400)]
    assert len(html_text._aligned(alike, alike[: 300])) == 300


def test_pages_of_many_children_take_seconds():
    make = lambda k: "<body>" + "".join(f"<h2>h{i}</h2><p>p{i} {k}</p>" for i in range(10_000)) + "</body>"
    start = time.time()
    html_text.infer([make(1), make(2), make(3)])
    assert time.time() - start < 30


def test_depth_changes_nothing():
    for deep in (10, 199, 200, 201, 3000):
        page = f"<body>{'<div>' * deep}<nav>MENU</nav><div class=ads>ad</div>{'</div>' * deep}<p>body text of the page</p></body>"
        assert html_text.extract(page, None, frozenset()) == "body text of the page"
        assert html_text.extract(f"<body>{'<div>' * deep}<p>in it</p>{'</div>' * deep}</body>", None, frozenset()) == "in it"


@pytest.mark.parametrize("name", ["article-header", "entry-header", "side-by-side", "search-results", "post-comments-free", "notice-board", "skip", "header"])
def test_names_of_parts_of_an_article(name):
    page = f"<body><article><div class='{name}'><h1>Title</h1><p>lead</p></div><p>{'more text ' * 20}</p></article></body>"
    assert html_text.extract(page, None, frozenset()) == f"Title\nlead\n{('more text ' * 20).strip()}"
