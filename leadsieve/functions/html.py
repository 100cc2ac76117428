"""HTML and markdown pages as text, with built-in expressions only."""

from __future__ import annotations

import html.entities

from pyspark.sql import Column, DataFrame, functions as F

from leadsieve import constants as C
from leadsieve.functions.text import char_at, collapse, strip

PAGE_TYPE = ("struct<url:string,title:string,description:string,"
             "headings:array<string>,text:string,http_status:int>")

# Attributes of a tag; quotes count only after '='. Possessive, so linear.
_ATTRS = r"""[^>=]*+(?:=\s*+(?:"[^"]*+"|'[^']*+')?+[^>=]*+)*+>"""
_TAG = rf"<(?:/?[A-Za-z]{_ATTRS}|[!?/][^>]*>|\z)"
# Comments, scripts and styles; also the two marks that the steps below put into the text.
_UNSEEN = (r"(?is)[\x01\x02<](?:(?<=[\x01\x02])|!--.*?(?:--!?>|\z)"
           r"|(script|style)(?:\s(?:[^>]*[^/>])?)?>.*?(?:</\s*\1\s*>|\z))")
_TITLE = r"title(?=[\s/>])[^>]*>.*?(?:</title\s*>|\z)"
# Start and end tags of hidden elements, and whole titles, told apart by the group found.
_MARKED = (rf"(?is)<(?:(/?)(?:{'|'.join(C.HIDDEN_ELEMENTS)})(?=[\s/>]){_ATTRS}(?<!/>)"
           rf"|(t){_TITLE[1:]})")
_START, _END = "\x01\x02", "\x01/\x02"
# Text and title marks between other marks; a start with its end, nested up to three deep.
_FILL = r"[^\x01]*+(?:\x01t[^\x01]*+)*+"
_PAIR = f"{_START}{_FILL}{_END}"
_PAIR = f"{_START}{_FILL}(?:{_PAIR}{_FILL})*+{_END}"
_PAIR = f"{_START}{_FILL}(?:{_PAIR}{_FILL})*+{_END}"
_NAMED_TAGS = rf"(?is)<(?:(?:a|meta)(?=[\s/]){_ATTRS}|{_TITLE})"
_HEADING = r"<(h[1-3])(?=[\s/>])"
_ATTR = r"""([^\s=/>"'<]+)\s*=\s*("[^"]*"|'[^']*'|[^\s>]*)"""

# Entity tables of the HTML5 standard, as the Python standard library holds them.
_NAMED = html.entities.html5
_FREQUENT = ["amp;", "lt;", "gt;", "quot;", "nbsp;"]
# Names that may stand without a semicolon, longest first so that the longest wins.
_LOOSE = sorted((n for n in _NAMED if not n.endswith(";")), key=lambda n: (-len(n), n))


def _lookup(values: dict[str, str], key: Column) -> Column:
    """A constant map, folded once per plan; its first keys are found fastest."""
    text = "\x02".join(f"{k}\x01{v}" for k, v in values.items())
    table = F.str_to_map(F.lit(text), F.lit("\x02"), F.lit("\x01"))
    return F.try_element_at(table, key)


def _name(full: Column) -> Column:
    return _lookup({n: _NAMED[n] for n in _FREQUENT}
                   | {n: v for n, v in _NAMED.items() if n.endswith(";")}, full)


def _loose_name(name: Column) -> Column:
    return _lookup({n: _NAMED[n] for n in _LOOSE}, name)


def _windows_1252(code: Column) -> Column:
    """Code points 128-159, which browsers read as Windows-1252."""
    return _lookup({str(c): bytes([c]).decode("cp1252", "ignore") or chr(c)
                    for c in range(128, 160)}, code.cast("string"))


def _unescape_piece(piece: Column) -> Column:
    """The text of a piece that followed an '&'."""
    number = F.regexp_extract(piece, "^#(?:[xX][0-9a-fA-F]+|[0-9]+);?", 0)
    digits = F.regexp_extract(number, "[0-9a-fA-F]+", 0)
    code = F.when(number.rlike("^#[xX]"), F.conv(digits, 16, 10)).otherwise(digits) \
            .try_cast("bigint")
    char = (
        F.when(code.isNull() | (code == 0) | (code > 0x10FFFF)
               | code.between(0xD800, 0xDFFF), F.lit("\ufffd"))
        .when(code.between(128, 159), _windows_1252(code))
        .when((code < 32) & ~code.isin(9, 10, 12, 13) | (code == 127)
              | code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE), "")
        .otherwise(char_at(code))
    )
    full = F.regexp_extract(piece, "^[A-Za-z][A-Za-z0-9]*;", 0)
    known = _name(full)
    loose = F.regexp_extract(piece, "^(?:" + "|".join(_LOOSE) + ")", 0)
    after = lambda head: F.substr(piece, F.length(head) + 1)
    return (
        F.when(number != "", F.concat(char, after(number)))
        .when((full != "") & known.isNotNull(), F.concat(known, after(full)))
        .when(loose != "", F.concat(_loose_name(loose), after(loose)))
        .otherwise(F.concat(F.lit("&"), piece))
    )


def unescape(col: Column) -> Column:
    """Character references replaced once, by the HTML5 table."""
    pieces = F.split(col, "&")
    rest = F.transform(F.slice(pieces, 2, 1 << 30), _unescape_piece)
    decoded = F.concat(F.element_at(pieces, 1), F.array_join(rest, ""))
    return F.when(col.contains("&"), decoded).otherwise(col)


def _untagged(markup: Column) -> Column:
    """Markup with its tags read as breaks; a lone '<' stands as a word of its own."""
    return F.replace(F.regexp_replace(markup, _TAG, " "), F.lit("<"), F.lit(" < "))


def _without_pairs(html: Column) -> Column:
    """Marked markup without hidden elements that are closed."""
    marked = F.regexp_replace(html, _MARKED, "\x01$1$2\x02")
    return F.regexp_replace(marked, _PAIR, " ")


def _outside_hidden(marked: Column) -> Column:
    """The markup outside hidden elements and titles.

    One depth counter serves all hidden elements: each start adds one and each end
    takes one off, never below zero. So once the closed elements are gone, stray ends
    mean nothing and the first start left open hides the rest. Deeper nests than the
    pattern covers are counted part by part.
    """
    before = F.substring_index(marked, _START, 1)
    open_rest = F.regexp_replace(before, "\x01[/t]\x02", " ")
    deep = marked.contains(_START) & F.substr(marked, F.length(before) + 1).contains(_END)
    return F.when(deep, _counted(marked)).otherwise(open_rest)


def _counted(marked: Column) -> Column:
    def step(state, part):
        depth = (
            F.when(part.startswith(_START[1:]), state["depth"] + 1)
            .when(part.startswith(_END[1:]), F.greatest(state["depth"] - 1, F.lit(0)))
            .otherwise(state["depth"])
        )
        shown = F.concat(state["text"], F.lit(" "), F.substring_index(part, "\x02", -1))
        return F.struct(depth.alias("depth"),
                        F.when(depth == 0, shown).otherwise(state["text"]).alias("text"))

    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("text"))
    return F.aggregate(F.split(marked, "\x01"), start, step, lambda state: state["text"])


def _attribute(tag: Column, *names: str) -> Column:
    """The last value given to one of the attributes, null if there is none."""
    pairs = F.filter(F.regexp_extract_all(tag, F.lit(_ATTR), F.lit(0)),
                     lambda p: p.rlike(r"(?i)^(?:" + "|".join(names) + r")\s*="))
    value = F.regexp_replace(F.try_element_at(pairs, F.lit(-1)), r"(?s)^[^=]*=\s*", "")
    quoted = value.rlike("""(?s)^(?:".*"|'.*')$""")
    return F.when(quoted, F.substr(value, F.lit(2), F.length(value) - 2)).otherwise(value)


def _closed(html: Column) -> Column:
    """The markup without a tag left open at its end.

    From here on every tag start finds a '>', so no pattern scans to the end in vain.
    """
    tail = F.substring_index(html, ">", -1)
    head = F.left(html, F.length(html) - F.length(tail))
    return F.when(tail.contains("<"), F.concat(
        head, F.regexp_replace(tail, r"(?s)<[/!?A-Za-z].*\z", ""))).otherwise(html)


def _is(name: str):
    return lambda tag: tag.rlike(rf"^<(?i:{name})[\s/>]")


def _titles(tags: Column) -> Column:
    """Contents of all titles in one text, undecoded and without inner tags."""
    inner = F.transform(F.filter(tags, _is("title")), lambda t: F.regexp_replace(
        t, r"(?is)^<title[^>]*>|</title\s*>\z", ""))
    return F.regexp_replace(F.array_join(inner, ""), _TAG, "")


def _descriptions(tags: Column) -> Column:
    """Contents of the description meta tags, undecoded."""
    metas = F.filter(tags, lambda t: _is("meta")(t) & t.rlike("(?i)description"))
    named = F.filter(metas, lambda t: F.lower(
        F.coalesce(F.nullif(_attribute(t, "name"), F.lit("")), _attribute(t, "property")))
        .isin("description", "og:description"))
    return F.transform(named, lambda t: F.coalesce(_attribute(t, "content"), F.lit("")))


def _links(tags: Column) -> Column:
    """The href of every anchor, undecoded."""
    hrefs = F.transform(F.filter(tags, _is("a")), lambda t: _attribute(t, "href"))
    return F.filter(hrefs, lambda h: h.isNotNull() & (h != ""))


def _headings(shown: Column) -> Column:
    """Contents of h1-h3 elements, undecoded; a new heading start drops an unfinished one."""
    found = F.regexp_extract_all(shown, F.lit(
        rf"(?is){_HEADING}.*?(?:</\1\s*>|(?={_HEADING.replace('(h', '(?:h')})|\z)"), F.lit(0))
    inner = F.transform(found, lambda h: F.regexp_extract(
        h, rf"(?is)^{_HEADING}{_ATTRS}(.*)</\1\s*>$", 2))
    return F.transform(F.filter(inner, lambda h: h != ""), _untagged)


def parse_html(df: DataFrame, html: str = "html") -> DataFrame:
    """Replace an HTML column by title, description, headings, text and links.

    Each step that later steps read more than once is its own projection, so that it
    is computed once per row. Entities are decoded in one pass over all parts.
    """
    raw = F.coalesce(F.col(html), F.lit(""))
    keep = [c for c in df.columns if c != html]
    bare = df.select(*keep, F.regexp_replace(_closed(raw), _UNSEEN, " ").alias("_bare"))
    marked = bare.select(
        *keep, _without_pairs(F.col("_bare")).alias("_marked"),
        F.regexp_extract_all("_bare", F.lit(_NAMED_TAGS), F.lit(0)).alias("_tags"))
    shown = marked.select(*keep, _outside_hidden(F.col("_marked")).alias("_shown"), "_tags")
    tags = F.col("_tags")
    found = shown.select(
        *keep, F.array(_titles(tags), _untagged(F.col("_shown"))).alias("_single"),
        _descriptions(tags).alias("_descriptions"),
        _headings(F.col("_shown")).alias("_headings"), _links(tags).alias("_links"),
    )
    lists = ["_single", "_descriptions", "_headings", "_links"]
    sizes = [F.size(c) for c in lists]
    decoded = found.select(*keep, *[n.alias(f"_n{i}") for i, n in enumerate(sizes)],
                           F.transform(F.concat(*lists), unescape).alias("_all"))
    descriptions = F.slice("_all", F.lit(3), F.col("_n1"))
    headings = F.slice("_all", F.col("_n1") + 3, F.col("_n2"))
    links = F.slice("_all", F.col("_n1") + F.col("_n2") + 3, F.col("_n3"))
    described = F.filter(F.transform(descriptions, collapse), lambda d: d != "")
    headed = F.filter(F.transform(headings, collapse),
                      lambda h: (h != "") & (F.length(h) < C.HEADING_LIMIT))
    return decoded.select(
        *keep,
        F.left(collapse(F.col("_all")[0]), F.lit(C.TITLE_CHARS)).alias("title"),
        F.left(F.coalesce(F.try_element_at(described, F.lit(1)), F.lit("")),
               F.lit(C.DESCRIPTION_CHARS)).alias("description"),
        F.slice(headed, 1, C.MAX_HEADINGS).alias("headings"),
        collapse(F.col("_all")[1]).alias("text"),
        links.alias("links"),
    )


# --- markdown ---------------------------------------------------------------

_MD_LINK = r"\[([^\]]*)\]\([^)]*\)"
_MD_IMAGE = r"!\[[^\]]*\]\([^)]*\)"
_MD_MARKS = "[*_`>#]+"
_MD_ESCAPE = r"\\+(?=[^\p{L}\p{N}_]|$)"
_LINE_BREAK = r"\r\n|[\n\r\x0b\f\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def markdown_headings(md: Column) -> Column:
    lines = F.split(F.coalesce(md, F.lit("")), _LINE_BREAK)
    rx = rf"^[{C.SPACE_CLASS}]{{0,3}}#{{1,3}}[{C.SPACE_CLASS}]+(.*)"
    marked = F.filter(lines, lambda l: l.rlike(rx))

    def clean(line):
        label = collapse(F.regexp_replace(F.regexp_extract(line, rx, 1), _MD_LINK, "$1"))
        return strip(F.regexp_replace(F.regexp_replace(label, _MD_MARKS, ""), _MD_ESCAPE, ""))

    kept = F.filter(F.transform(marked, clean),
                    lambda h: (h != "") & (F.length(h) < C.HEADING_LIMIT))
    return F.slice(kept, 1, C.MAX_HEADINGS)


def markdown_text(md: Column) -> Column:
    text = F.regexp_replace(F.coalesce(md, F.lit("")), _MD_IMAGE, " ")
    text = F.regexp_replace(text, _MD_LINK, "$1")
    space = f"[{C.SPACE_CLASS}]*"
    text = F.regexp_replace(text, rf"(?md)^{space}\|.*\|{space}$", " ")
    text = F.regexp_replace(text, r"(?md)^[-=]{3,}$", " ")
    text = F.regexp_replace(text, _MD_MARKS, " ")
    return collapse(F.regexp_replace(text, _MD_ESCAPE, ""))


def page_from_markdown(df: DataFrame, md: str = "markdown") -> DataFrame:
    """Replace a markdown column by headings and text, and cap title and description."""
    def given(name: str, limit: int) -> Column:
        col = F.col(name) if name in df.columns else F.lit("")
        return F.left(collapse(col), F.lit(limit)).alias(name)

    keep = [c for c in df.columns if c not in (md, "title", "description")]
    return df.select(
        *keep, given("title", C.TITLE_CHARS), given("description", C.DESCRIPTION_CHARS),
        markdown_headings(F.col(md)).alias("headings"), markdown_text(F.col(md)).alias("text"),
    )
