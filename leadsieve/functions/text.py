"""Column functions on plain text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from leadsieve import constants as C

# The character classes in the form the JVM tests fastest: single Latin-1 characters
# share one lookup, and one range test rules the others out for most characters.
SPACES = (r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x20\x{85}\x{a0}"
          rf"[\x{{1680}}-\x{{3000}}&&[{C.SPACE_CLASS}]]]")
_INVISIBLE = rf"[\x{{ad}}[\x{{180e}}-\x{{fffb}}&&[{C.INVISIBLE_CLASS}]]]+"
_EDGES = f"^{SPACES}+|{SPACES}+$"
# A run of spaces that is not already one blank.
_RUN = f"{SPACES}(?:{SPACES}+|(?<! ))"


def strip(col: Column) -> Column:
    """Trim every Unicode space, not only the ASCII blank."""
    return F.regexp_replace(col, _EDGES, "")


def collapse(col: Column) -> Column:
    """Drop invisible characters, turn each run of spaces into one blank, trim."""
    col = F.coalesce(col, F.lit(""))
    # Pure ASCII text holds none of them.
    visible = F.when(F.octet_length(col) > F.length(col), F.regexp_replace(col, _INVISIBLE, "")) \
        .otherwise(col)
    return F.trim(F.regexp_replace(visible, _RUN, " "))


def content_words(text: Column) -> Column:
    """How many distinct words the text has that are not navigation words."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[a-z][a-z-]{2,}"), F.lit(0))
    return F.size(F.array_except(words, F.array(*map(F.lit, C.NAV_WORDS))))


def first_phrase(lowered: Column, phrases: list[str]) -> Column:
    """The first phrase, in list order, that the lowercased text contains; else ''."""
    return F.coalesce(*[F.when(lowered.contains(p), F.lit(p)) for p in phrases], F.lit(""))


def to_number(col: Column) -> Column:
    """The first number in a cell; thousands commas are dropped."""
    digits = F.regexp_extract(F.coalesce(col, F.lit("")), r"-?\d[\d,]*\.?\d*", 0)
    return F.when(digits != "", F.replace(digits, F.lit(","), F.lit("")).try_cast("double"))


def reason_family(col: Column) -> Column:
    """A reason code without its detail."""
    return F.substring_index(col, ":", 1)


def comment_for(reason: Column) -> Column:
    """The fixed comment for a gate reason."""
    known = [F.when(reason.startswith(p), F.lit(text)) for p, text in C.REASON_COMMENTS]
    return F.coalesce(*known, F.lit(C.DEFAULT_REASON_COMMENT))


def site_status(chars: Column) -> Column:
    return F.when(chars >= C.MIN_BODY_CHARS, "ok").otherwise("thin")


def classify_fetch(code: Column, error: Column) -> Column:
    """Status of a failed fetch from its HTTP code, else from its error text."""
    low = F.lower(F.coalesce(error, F.lit("")))
    code = F.coalesce(code, F.lit(0))
    return (
        F.when(code.isin(401, 403, 429), "blocked")
        .when((code >= 400) & (code < 500), "http_4xx")
        .when(code >= 500, "http_5xx")
        .when(low.contains("timed out") | low.contains("timeout"), "timeout")
        .when(low.rlike("resolve|getaddrinfo|name or service|nodename nor servname"), "dns_fail")
        .otherwise("conn_fail")
    )


def fixed(col: Column, digits: int) -> Column:
    """A small number as text, rounded half-even on its exact binary value."""
    return F.replace(F.format_number(col, digits), F.lit(","), F.lit(""))


def rounded(col: Column, digits: int) -> Column:
    return fixed(col, digits).cast("double")


def char_at(code_point: Column) -> Column:
    """The character of a code point beyond Latin-1 as well."""
    return F.decode(F.unhex(F.lpad(F.hex(code_point), 8, "0")), "UTF-32")
