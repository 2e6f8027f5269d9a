"""Wikitext and HTML to text, as chains of column expressions."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomwork.functions import lexicons as lex

#: Innermost templates and tables, what opens and closes them, and what opens them. Fixed values, like the patterns of
#: both rule lists: they define the output.
NESTED = (
    (r"\{\{[^{}]*\}\}", r"\{\{|\}\}", "{{"),
    (r"\{\|[^{}]*\|\}", r"\{\||\|\}", "{|"),
)


def _apply(text: Column, rules: list[tuple[str, str]]) -> Column:
    for pattern, with_ in rules:
        text = F.regexp_replace(text, pattern, with_)
    return text


def rules_before() -> list[tuple[str, str]]:
    """Replacements for dump wikitext that come before templates and tables: comments, references, tag blocks."""
    rules = [(r"(?s)<!--.*?-->", ""), (r"(?s)<ref[^>]*>.*?</ref>", ""), (r"<ref[^/]*/?\s*>", "")]
    rules += [(rf"(?s)<{t}[^>]*>.*?</{t}>", "") for t in lex.BLOCK_TAGS]
    rules += [(rf"(?s)<{t}>.*?</{t}>", "") for t in lex.BARE_BLOCK_TAGS]
    return rules


def rules_after() -> list[tuple[str, str]]:
    """Those that come after: links, quotes, headings, character references, tags, white space."""
    return [
        (r"(?i)\[\[(?:Category|File|Image):[^\]]*\]\]", ""),
        (r"\[\[[^\]|]*\|([^\]]*)\]\]", "$1"),
        (r"\[\[([^\]]*)\]\]", "$1"),
        (r"\[https?://[^\s\]]+\s*([^\]]*)\]", "$1"),
        (r"'{2,3}", ""),
        (r"={2,6}\s*(.*?)\s*={2,6}", "$1"),
        ("&nbsp;", " "),
        ("&amp;", "&"),
        ("&lt;", "<"),
        ("&gt;", ">"),
        ("&quot;", '"'),
        (r"&\w+;", " "),
        (r"&#\d+;", " "),
        (r"<[^>]+>", ""),
        (r"\n{3,}", "\n\n"),
        (r"  +", " "),
    ]


def wikitext_rules(levels: int = 8) -> list[tuple[str, str]]:
    """All replacements in order, for text whose templates and tables nest ``levels`` deep at most."""
    return rules_before() + [(pattern, "") for pattern, _, _ in NESTED for _ in range(levels)] + rules_after()


def peeled(text: Column, pattern: str, signs: str, opening: str) -> Column:
    """Text without what ``pattern`` finds, innermost first, until nothing is found: as often as the signs nest, and once more."""
    start = F.struct(F.lit(0).alias("open"), F.lit(0).alias("deepest"))

    def step(state: Column, sign: Column) -> Column:
        now = F.when(sign == opening, state["open"] + 1).otherwise(F.greatest(state["open"] - 1, F.lit(0)))
        return F.struct(now.alias("open"), F.greatest(state["deepest"], now).alias("deepest"))

    depth = F.aggregate(F.regexp_extract_all(text, F.lit(f"({signs})"), 1), start, step, lambda s: s["deepest"])
    return F.aggregate(F.sequence(F.lit(0), F.coalesce(depth, F.lit(0))), text, lambda t, _: F.regexp_replace(t, pattern, ""))


#: The shorter list for pages fetched one by one: templates are peeled once.
SIMPLE_RULES = [
    (r"\{\{[^{}]*\}\}", ""),
    (r"(?s)<ref[^>]*>.*?</ref>", ""),
    (r"<ref[^>]*/?>", ""),
    (r"<[^>]+>", ""),
    (r"(?i)\[\[(?:File|Image):[^\]]*\]\]", ""),
    (r"\[\[([^\]|]+)\|([^\]]+)\]\]", "$2"),
    (r"\[\[([^\]]+)\]\]", "$1"),
    (r"\[https?://[^\s]+\s*([^\]]*)\]", "$1"),
    (r"'{2,}", ""),
    (r"__[A-Z]+__", ""),
    (r"\n{3,}", "\n\n"),
    (r"  +", " "),
]


def clean_wikitext(text: Column) -> Column:
    """Dump wikitext as plain text; templates and tables go however deep they nest."""
    text = _apply(text, rules_before())
    for pattern, signs, opening in NESTED:
        text = peeled(text, pattern, signs, opening)
    return strip(_apply(text, rules_after()))


def clean_wikitext_simple(text: Column) -> Column:
    return strip(_apply(text, SIMPLE_RULES))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+\z", "")


def strip_html(html: Column, least: int = 200) -> Column:
    """Tags become spaces, white space runs one space; null under ``least`` characters. Script and style text stays."""
    text = strip(F.regexp_replace(F.regexp_replace(html, r"<[^>]+>", " "), r"(?U)\s+", " "))
    return F.when(F.char_length(text) >= least, text)


def html_sections(html: Column, least_page: int = 500, least_text: int = 200) -> Column:
    """Sections (title, text) of a page: h2 and h3 open one, text before the first is left out.

    Text in script, style, sup and table is skipped. A section named Introduction or Overview comes first; the last of
    several wins. A page without sections is one section Main of its stripped text; a page under ``least_page``
    characters is null.
    """
    body = F.regexp_replace(html, r"(?is)<(script|style|sup|table)\b[^>]*>.*?(?:</\1\s*>|\z)", "")
    body = F.regexp_replace(body, r"(?s)<!--.*?-->", "")
    parts = F.slice(F.split(body, r"(?i)<h[23]\b[^>]*>"), 2, 1 << 30)

    def section(part: Column) -> Column:
        title = F.regexp_extract(part, r"(?is)^(.*?)</h[23]\s*>", 1)
        text = F.regexp_replace(part, r"(?is)^.*?</h[23]\s*>", "")
        return F.struct(strip(plain(title)).alias("title"), collapse(plain(text)).alias("text"))

    found = F.filter(F.transform(parts, section), lambda s: (s["title"] != "") & (s["text"] != ""))
    intro = F.filter(found, lambda s: s["title"].isin("Introduction", "Overview"))
    rest = F.filter(found, lambda s: ~s["title"].isin("Introduction", "Overview"))
    first = F.transform(F.slice(intro, -1, 1), lambda s: F.struct(F.lit("Introduction").alias("title"), s["text"].alias("text")))
    ordered = F.when(F.size(intro) > 0, F.concat(first, rest)).otherwise(rest)
    whole = strip_html(html, least_text)
    fallback = F.when(whole.isNotNull(), F.array(F.struct(F.lit("Main").alias("title"), whole.alias("text"))))
    return F.when(F.char_length(html) >= least_page, F.when(F.size(found) > 0, ordered).otherwise(fallback))


def plain(html: Column) -> Column:
    """Text of markup, its character references decoded."""
    return decoded(F.regexp_replace(html, r"<[^>]+>", ""))


def decoded(text: Column) -> Column:
    """Text with numeric and HTML5's named character references decoded, each once; unknown ones stay."""
    names = {name[:-1]: sign for name, sign in html5.items() if name.endswith(";")}
    table = F.from_json(F.lit(json.dumps(names)), "map<string, string>")

    def part(p: Column) -> Column:
        name = F.regexp_extract(p, r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);", 1)
        digits = F.regexp_extract(name, r"^#[xX]?([0-9a-fA-F]+)$", 1)
        code = F.when(F.rlike(name, F.lit("^#[xX]")), F.conv(digits, 16, 10)).otherwise(digits).try_cast("long")
        legal = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        sign = F.when(F.startswith(name, F.lit("#")), F.when(legal, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))).otherwise(F.try_element_at(table, name))
        return F.when((name != "") & sign.isNotNull(), F.concat(sign, F.substr(p, F.char_length(name) + 2))).otherwise(F.concat(F.lit("&"), p))

    parts = F.split(text, "&")
    return F.array_join(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(part(p))), "")


def collapse(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"(?U)\s+", " "))


def links(html: Column, title: Column | None = None, prefix: str = r"\./|/wiki/", limit: int = 50) -> Column:
    """Internal links in order: decoded, underscores as spaces, without special pages, repeats and the page itself."""
    found = F.regexp_extract_all(html, F.lit(rf"href=[\"'](?:{prefix})([^\"']+)"), 1)
    special = F.array(*[F.lit(start) for start in lex.LINK_SKIP])
    found = F.filter(found, lambda x: ~F.exists(special, lambda start: F.startswith(x, start)))
    # url_decode reads + as a space, which links do not
    # what cannot be decoded stays as it is
    names = F.transform(found, lambda x: F.replace(F.coalesce(F.try_url_decode(F.replace(x, F.lit("+"), F.lit("%2B"))), x), F.lit("_"), F.lit(" ")))
    if title is not None:
        names = F.filter(names, lambda x: x != title)
    return F.slice(F.array_distinct(names), 1, limit)
