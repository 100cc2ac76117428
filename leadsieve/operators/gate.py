"""The content-quality gate and the digest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from leadsieve import constants as C
from leadsieve.functions.domains import path_of, registrable
from leadsieve.functions.text import collapse, content_words, first_phrase
from leadsieve.operators.sites import body_chars


def _letters(col: Column) -> Column:
    return F.regexp_replace(F.lower(col), "[^a-z]", "")


def _blank(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def _headings(page: Column, sep: str = " ") -> Column:
    return _blank(F.array_join(page["headings"], sep))


def quality_gate(sites: DataFrame) -> DataFrame:
    """Add gate_ok and gate_reason: the first failing test names the reason."""
    pages = F.col("pages")
    home = F.try_element_at(pages, F.lit(1))
    meta = F.array_join(F.transform(pages, lambda p: F.concat_ws(
        " ", _blank(p["title"]), _blank(p["description"]), _headings(p))), " ")
    words = F.array_join(pages["text"], " ")
    seen = F.lower(F.left(F.concat_ws(" ", words, meta), F.lit(C.PHRASE_WINDOW)))
    label = _letters(F.concat(_blank(home["title"]), _blank(home["description"]), _headings(home)))
    # Measures used by several tests get a projection of their own.
    measured = sites.select("*", body_chars(pages).alias("_body"), seen.alias("_seen"),
                            _blank(label).alias("_label"),
                            _letters(F.substring_index(registrable(F.col("domain")), ".", 1))
                            .alias("_key"))
    short = F.col("_body") < C.PHRASE_BODY_LIMIT
    phrases = measured.select(
        "*", F.when(short, first_phrase(F.col("_seen"), C.PARKED_PHRASES)).otherwise("")
        .alias("_parked"),
        F.when(short, first_phrase(F.col("_seen"), C.STUB_PHRASES)).otherwise("").alias("_stub"))
    n_words = content_words(words)
    home_chars = F.length(home["text"])

    def reason(prefix: str, col: Column, suffix: str = "") -> Column:
        return F.concat(F.lit(prefix), col.cast("string"), F.lit(suffix))

    why = (
        F.when(~F.col("status").isin(C.REACHED_STATUSES), reason("status:", F.col("status")))
        .when(F.coalesce(F.size(pages), F.lit(0)) <= 0, "no_pages")
        .when(F.col("_parked") != "", reason("parked:", F.replace(F.col("_parked"), F.lit(" "), F.lit("_"))))
        .when(F.col("_stub") != "", reason("stub:", F.replace(F.col("_stub"), F.lit(" "), F.lit("_"))))
        .when(F.col("_body") < C.MIN_BODY_CHARS, reason("thin:", F.col("_body"), "_chars"))
        .when((F.length("_label") < C.MIN_TITLE_LETTERS)
              | ((F.col("_key") != "") & (F.col("_label") == F.col("_key"))), "no_real_title")
        .when((F.size(pages) < 2) & (home_chars < C.MIN_HOME_CHARS),
              reason("single_thin_page:", home_chars))
    )
    tested = phrases.select(*sites.columns, why.alias("_why"),
                            F.when(why.isNull(), n_words).alias("_words"))
    return tested.select(
        *sites.columns,
        F.when(F.col("_why").isNotNull(), F.col("_why"))
        .when(F.col("_words") < C.MIN_CONTENT_WORDS, reason("not_prose:", F.col("_words"), "_words"))
        .otherwise("pass").alias("gate_reason"),
    ).withColumn("gate_ok", F.col("gate_reason") == "pass")


def gate_split(gated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Passed and failed rows."""
    return gated.where("gate_ok"), gated.where("not gate_ok")


def dedupe_headings(headings: Column) -> Column:
    """Headings without blanks and repeats (case ignored), first spelling and order kept."""
    texts = "array<string>"
    clean = F.filter(F.transform(headings, collapse), lambda h: h != "")
    start = F.struct(F.array().cast(texts).alias("keys"), F.array().cast(texts).alias("kept"))

    def step(state, h):
        repeated = F.array_contains(state["keys"], F.lower(h))
        full = F.size(state["kept"]) >= C.DIGEST_HEADINGS
        return F.when(repeated | full, state).otherwise(F.struct(
            F.array_append(state["keys"], F.lower(h)).alias("keys"),
            F.array_append(state["kept"], h).alias("kept")))

    return F.aggregate(clean, start, step, lambda state: state["kept"])


def _short(col: Column, chars: int) -> Column:
    return F.left(collapse(col), F.lit(chars))


def digest(domain: Column, pages: Column) -> Column:
    """The capped text a judge reads for one site; '' without pages."""
    home = F.try_element_at(pages, F.lit(1))
    heads = F.array_join(dedupe_headings(home["headings"]), " | ")

    def line(label: str, value: Column, given: Column) -> Column:
        return F.when(given, F.concat(F.lit(label), value))

    def subpage(page: Column) -> Column:
        parts = F.filter(F.array(
            page["title"], F.left(F.array_join(page["headings"], " "),
                                  F.lit(C.DIGEST_PAGE_HEADINGS_CHARS)), page["text"]),
            lambda x: F.coalesce(x, F.lit("")) != "")
        chunk = _short(F.array_join(parts, " "), C.DIGEST_PAGE_CHARS)
        return F.when(chunk != "", F.concat(F.lit("PAGE "), path_of(page["url"]), F.lit(": "), chunk))

    top = F.array(
        F.concat(F.lit("DOMAIN: "), domain),
        line("TITLE: ", _short(home["title"], C.DIGEST_TITLE_CHARS), home["title"] != ""),
        line("META: ", _short(home["description"], C.DIGEST_META_CHARS), home["description"] != ""),
        line("HEADINGS: ", F.left(heads, F.lit(C.DIGEST_HEADINGS_CHARS)), heads != ""),
        F.concat(F.lit("HOME: "), _short(home["text"], C.DIGEST_HOME_CHARS)),
    )
    rest = F.transform(F.slice(pages, 2, 1 << 30), subpage)
    return F.array_join(F.concat(top, rest), "\n")


def build_digest(sites: DataFrame, max_chars: int = C.DIGEST_MAX_CHARS) -> DataFrame:
    """Add the digest column, cut to its cap."""
    drafted = sites.withColumn("digest", digest(F.col("domain"), F.col("pages")))
    cut = F.concat(F.left("digest", F.lit(max_chars - 3)), F.lit("..."))
    has_pages = F.coalesce(F.size("pages"), F.lit(0)) > 0
    return drafted.withColumn("digest", F.when(~has_pages, "").when(
        F.length("digest") > max_chars, cut).otherwise(F.col("digest")))
