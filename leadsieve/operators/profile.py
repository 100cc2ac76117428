"""Statistics of a raw lead table."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window, functions as F

from leadsieve import constants as C
from leadsieve.functions.domains import normalize_domain
from leadsieve.functions.text import strip


def _columns(leads: DataFrame) -> list[str]:
    return [c for c in leads.columns if c != "row_idx"]


def _value(name: str) -> Column:
    return strip(F.coalesce(F.col(f"`{name}`"), F.lit("")))


def _first_values(leads: DataFrame, n: int) -> DataFrame:
    """The first n non-blank values of every column, from one pass over the leads.

    The window limit keeps n rows per column and task before the shuffle.
    """
    rank = Window.partitionBy("column").orderBy("row_idx")
    return _cells(leads, _columns(leads)).withColumn("_r", F.row_number().over(rank)) \
        .where(F.col("_r") <= n).drop("_r")


def _cells(leads: DataFrame, columns: list[str]) -> DataFrame:
    """The non-blank values of the columns as rows (row_idx, column, value)."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), _value(c).alias("value"))
                                for c in columns]))
    return leads.select("row_idx", pairs.alias("_p")).select("row_idx", "_p.*").where("value <> ''")


def value_counts(leads: DataFrame, columns: list[str]) -> DataFrame:
    """How often each non-blank value of the columns occurs, and where it occurs first."""
    return _cells(leads, columns).groupBy("column", "value").agg(
        F.count("*").alias("n"), F.min("row_idx").alias("first"))


def profile_columns(leads: DataFrame, samples: int = 3, top: int = 4) -> DataFrame:
    """Per column: filled share, sample values, and for columns a rule may test the
    distinct count and the most frequent values."""
    names = _columns(leads)
    filled = leads.agg(F.count("*").alias("rows"),
                       *[F.count_if(_value(c) != "").alias(f"f{i}") for i, c in enumerate(names)])
    long = filled.select("rows", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(i).alias("ord"), F.col(f"f{i}").alias("filled"))
        for i, c in enumerate(names)])).alias("c")).select(
        "c.column", "c.ord", F.floor(F.col("c.filled") * 100 / F.greatest("rows", F.lit(1)))
        .alias("filled_pct"))
    shown = _shown(_first_values(leads, samples))
    testable = _testable(names)
    if not testable:
        return long.join(shown, "column", "left").withColumns(
            {"n_distinct": F.lit(None).cast("bigint"), "top_values": F.lit(None).cast("string")})
    counts = value_counts(leads, testable)
    return _with_counts(long.join(shown, "column", "left"), counts, top)


def _testable(names: list[str]) -> list[str]:
    """The columns that a rule may test."""
    return [c for c in names if re.search(C.RULE_HEADER_PATTERN, c, re.I)]


def _shown(values: DataFrame) -> DataFrame:
    """The values (row_idx, column, value) of each column in one text, in order of rows."""
    return values.groupBy("column").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("row_idx", "value"))), lambda s: s["value"]), " | ")
        .alias("samples"))


def _with_counts(columns: DataFrame, counts: DataFrame, top: int) -> DataFrame:
    """Add the number of distinct values and the most frequent ones, from (column, value, n, first)."""
    # The window limit keeps `top` rows per column and task before the shuffle.
    rank = Window.partitionBy("column").orderBy(F.desc("n"), "first")
    best = counts.withColumn("_r", F.row_number().over(rank)).where(F.col("_r") <= top) \
        .groupBy("column").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(
            "_r", F.concat("value", F.lit(" ("), "n", F.lit(")")).alias("t")))),
            lambda s: s["t"]), " | ").alias("top_values"))
    # Reading all columns of the counts lets Spark reuse their shuffle instead of counting twice.
    distinct = counts.groupBy("column").agg(
        F.count_if((F.col("n") > 0) & (F.col("first") >= 0)).alias("n_distinct"))
    return columns.join(distinct, "column", "left") \
        .join(best, "column", "left")


def header_score(name: str) -> int:
    """Points of the first header pattern that matches."""
    return next((n for rx, n in C.WEBSITE_HEADER_SCORES if re.search(rx, name, re.I)), 0)


def score_url_columns(leads: DataFrame, sample: int | None = C.HOST_SAMPLE) -> DataFrame:
    """How likely each column holds the website; `best` marks the first maximum.

    The share of hosts is taken over the first `sample` values of a column, None for all.
    """
    names = _columns(leads)
    headers = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(i).alias("ord"), F.lit(header_score(c)).alias("hint"))
        for i, c in enumerate(names)]))
    table = leads.sparkSession.range(1).select(headers.alias("h")).select("h.*")
    values = _first_values(leads, sample) if sample else _cells(leads, names)
    sampled = values.select(
        "column", normalize_domain(F.col("value")).alias("host"))
    shares = sampled.groupBy("column").agg(
        F.count_if(F.col("host") != "").alias("hosts"), F.count("*").alias("sampled"))
    share = F.coalesce(F.col("hosts") / F.col("sampled"), F.lit(0.0))
    scored = table.join(shares, "column", "left").select(
        "column", "ord", share.alias("host_share"),
        (F.col("hint") + F.floor(share * C.HOST_SHARE_POINTS)).alias("score"))
    order = Window.orderBy(F.desc("score"), "ord")
    return scored.withColumn("best", F.row_number().over(order) == 1)


def url_health(leads: DataFrame, url_col: str) -> DataFrame:
    """Usable, unique, blank and unparseable websites, and how many repeat.

    Counts per domain are folded before the shuffle; one row per domain is left.
    """
    raw = _value(url_col)
    kinds = leads.select(normalize_domain(F.col(f"`{url_col}`")).alias("domain"),
                         (raw == "").alias("blank"))
    per_domain = kinds.groupBy("domain", "blank").agg(F.count("*").alias("n"))
    ok, n = F.col("domain") != "", F.col("n")

    def total(test: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, n)), F.lit(0))

    return per_domain.agg(
        total(ok).alias("usable"), F.count_if(ok).alias("unique_domains"),
        total(~ok & F.col("blank")).alias("blank"), total(~ok & ~F.col("blank")).alias("unparseable"),
        F.count_if(ok & (n > 1)).alias("duplicate_domains"),
        total(ok & (n > 1)).alias("duplicate_rows"))


# --- the rows behind the counts -------------------------------------------------------

def unparseable_cells(leads: DataFrame, url_col: str) -> DataFrame:
    """The leads whose website is not blank and names no host, as (row_idx, line of the sheet, value as given)."""
    cell = F.col(f"`{url_col}`")
    return leads.where((_value(url_col) != "") & (normalize_domain(cell) == "")).select(
        "row_idx", (F.col("row_idx") + 2).alias("line"), cell.alias("value"))  # the sheet counts from 1 and has a header


def repeated_domains(leads: DataFrame, url_col: str) -> DataFrame:
    """Domains of several leads: how many (n), and the first row of them; they are crawled once and share a verdict."""
    rows = leads.select(normalize_domain(F.col(f"`{url_col}`")).alias("domain"), "row_idx").where("domain <> ''")
    return rows.groupBy("domain").agg(F.count("*").alias("n"), F.min("row_idx").alias("first_row")).where("n > 1")


# --- profiles that merge --------------------------------------------------------------

#: A part's rows come after those of all smaller parts.
PART_ROWS = 1 << 40
FACTS = "kind string, column string, value string, n bigint, first bigint"


def profile_facts(leads: DataFrame, url_col: str, part: int = 0, samples: int = 3) -> DataFrame:
    """What a part of a lead table adds to its profile, as rows (kind, column, value, n, first).

    Kinds: `rows`; `column` (in order) and `filled` cells of each; the first cells (`shown`); the counts of each
    `value` of a column that a rule may test; each `domain` of the websites, and their `blank` and `unparseable` cells.
    The facts of several parts, one below the other, are those of all their rows, so a new file needs no other to be read again.
    """
    names = _columns(leads)
    testable, none = set(_testable(names)), F.lit(None).cast("string")
    host = normalize_domain(F.col(f"`{url_col}`"))

    def fact(kind, column: str, value: Column = none) -> Column:
        kind = F.lit(kind) if isinstance(kind, str) else kind
        return F.struct(kind.alias("kind"), F.lit(column).alias("column"), value.alias("value"))

    def given(name: str, kind: str, value: Column = none) -> Column:
        return F.when(_value(name) != "", fact(kind, name, value))

    told = [fact("rows", ""), fact(F.when(host != "", "domain").when(_value(url_col) == "", "blank").otherwise("unparseable"),
                                   url_col, F.when(host != "", host))]
    told += [given(c, "filled") for c in names]
    told += [given(c, "value", _value(c)) for c in names if c in testable]
    place = (F.col("row_idx") + part * PART_ROWS).cast("bigint")
    cells = leads.select(place.alias("at"), F.explode(F.array(*told)).alias("f")).where("f is not null").select("at", "f.*")
    counts = cells.groupBy("kind", "column", "value").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    shown = _first_values(leads.withColumn("row_idx", place), samples).select(
        F.lit("shown").alias("kind"), "column", "value", F.lit(1).cast("bigint").alias("n"), F.col("row_idx").alias("first"))
    listed = leads.sparkSession.range(1).select(F.posexplode(F.array(*map(F.lit, names))).alias("ord", "column")).select(
        F.lit("column").alias("kind"), "column", none.alias("value"), F.lit(0).cast("bigint").alias("n"),
        F.col("ord").cast("bigint").alias("first"))
    return counts.unionAll(shown).unionAll(listed)


def _summed(facts: DataFrame, *kinds: str) -> DataFrame:
    return facts.where(F.col("kind").isin(*kinds)).groupBy("kind", "column", "value").agg(
        F.sum("n").alias("n"), F.min("first").alias("first"))


def merged_profile(facts: DataFrame, samples: int = 3, top: int = 4) -> DataFrame:
    """`profile_columns` of all parts whose facts are given. Columns that only some parts have come by their place there."""
    sums = _summed(facts, "rows", "column", "filled")
    rows = F.sum(F.when(F.col("kind") == "rows", F.col("n"))).over(Window.partitionBy())  # a few rows for each column
    filled = sums.withColumn("rows", rows).where("kind <> 'rows'").groupBy("column").agg(
        F.min(F.when(F.col("kind") == "column", F.col("first"))).cast("int").alias("ord"),
        F.coalesce(F.floor(F.sum(F.when(F.col("kind") == "filled", F.col("n"))) * 100 / F.greatest(F.max("rows"), F.lit(1))),
                   F.lit(0)).alias("filled_pct"))
    first = Window.partitionBy("column").orderBy("first")
    cells = facts.where("kind = 'shown'").withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= samples).select(
        F.col("first").alias("row_idx"), "column", "value")
    return _with_counts(filled.join(_shown(cells), "column", "left"), _summed(facts, "value").drop("kind"), top)


def merged_url_health(facts: DataFrame) -> DataFrame:
    """`url_health` of all parts whose facts are given."""
    kind, n = F.col("kind"), F.col("n")

    def total(test: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, n)), F.lit(0))

    ok = kind == "domain"
    return _summed(facts, "domain", "blank", "unparseable").agg(
        total(ok).alias("usable"), F.count_if(ok).alias("unique_domains"), total(kind == "blank").alias("blank"),
        total(kind == "unparseable").alias("unparseable"), F.count_if(ok & (n > 1)).alias("duplicate_domains"),
        total(ok & (n > 1)).alias("duplicate_rows"))


def context_columns(columns: list[str]) -> list[str]:
    return [c for c in columns if any(h in c.lower() for h in C.CONTEXT_HINTS)]


def lead_context(leads: DataFrame, url_col: str) -> DataFrame:
    """A short `name=value` line per domain, from its first row."""
    names = context_columns(_columns(leads))
    bits = [F.when(_value(c) != "", F.concat(
        F.lit(f"{c}="), F.left(_value(c), F.lit(C.CONTEXT_VALUE_CHARS)))) for c in names]
    line = F.concat_ws(" | ", *bits) if bits else F.lit("")
    rows = leads.select(normalize_domain(F.col(f"`{url_col}`")).alias("domain"), "row_idx",
                        line.alias("context"))
    return rows.where("domain <> ''").groupBy("domain").agg(
        F.min_by("context", "row_idx").alias("context"), F.min("row_idx").alias("first_row"))
