"""Column functions on hosts, URLs and links."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from leadsieve import constants as C
from leadsieve.functions.text import strip


def normalize_domain(col: Column) -> Column:
    """A messy cell as a bare lowercase host, '' if it holds none.

    Blank tokens such as N/A hold no dot, so they fail the pattern like any other word.
    International names go through the JVM's IDNA 2003 encoder; that branch is only
    evaluated for hosts with non-ASCII characters.
    """
    cell = strip(F.coalesce(col, F.lit("")))
    cell = F.trim(F.trim(cell, F.lit('"')), F.lit("'"))
    host = F.regexp_replace(cell, r"(?i)^\s*(?:https?:)?//", "")
    host = F.substring_index(F.regexp_extract(host, r"^[^/?#]*", 0), "@", -1)
    host = F.lower(F.trim(strip(host), F.lit(".")))
    host = F.regexp_replace(host, r":\p{Nd}+$", "")
    encoded = F.try_reflect(F.lit("java.net.IDN"), F.lit("toASCII"), host, F.lit(1))

    def valid(name: Column) -> Column:
        return F.regexp_extract(name, r"^[a-z0-9.-]+\.[a-z]{2,}$", 0)

    return F.when(host.rlike(r"[^\x00-\x7f]"), F.coalesce(valid(encoded), F.lit(""))) \
        .otherwise(valid(host))


def candidate_urls(domain: Column) -> Column:
    """Start URLs of a host in the order to try them."""
    toggled = F.when(domain.startswith("www."), F.substring(domain, 5, 1 << 20)) \
               .otherwise(F.concat(F.lit("www."), domain))
    urls = F.array(F.concat(F.lit("https://"), domain), F.concat(F.lit("https://"), toggled),
                   F.concat(F.lit("http://"), domain))
    return F.when(domain != "", urls).otherwise(F.array().cast("array<string>"))


def registrable(host: Column) -> Column:
    """The owner part of a host: two labels, or three under a two-label suffix."""
    labels = F.array_remove(F.split(F.lower(F.coalesce(host, F.lit(""))), r"\."), "")
    last_two = F.array_join(F.slice(labels, -2, 2), ".")
    return (
        F.when(F.size(labels) <= 2, F.array_join(labels, "."))
        .when(last_two.isin(C.TWO_LABEL_SUFFIXES), F.array_join(F.slice(labels, -3, 3), "."))
        .otherwise(last_two)
    )


def same_site(host: Column, domain: Column) -> Column:
    host = F.coalesce(host, F.lit(""))
    return (host != "") & (registrable(host) == registrable(domain))


def offdomain_mark(domain: Column, url: Column) -> Column:
    """`redirect_offdomain:` and the host of a page that was reached for another owner's domain, else ''. Ports don't count."""
    host = normalize_domain(url)
    away = (host != "") & ~same_site(host, domain)
    return F.when(away, F.concat(F.lit("redirect_offdomain:"), host_of(url))).otherwise("")


def host_of(url: Column) -> Column:
    """The network location of an absolute URL, port and user included."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def url_path(url: Column) -> Column:
    """The path of an absolute URL without parameters, query and fragment."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.regexp_replace(path, r";[^/]*$", "")


def path_depth(url: Column) -> Column:
    return F.size(F.array_remove(F.split(url_path(url), "/"), ""))


def path_of(url: Column) -> Column:
    """The short path shown in a digest, query included."""
    rest = F.regexp_replace(url, "^https?://[^/]+", "")
    return F.left(F.when(rest == "", "/").otherwise(rest), F.lit(C.DIGEST_PATH_CHARS))


def score_path(path: Column) -> Column:
    """Best weight of the fragments found in a path, less its depth beyond two."""
    low = F.lower(path)
    weights = [F.when(low.rlike("|".join(fragments)), weight).otherwise(0)
               for fragments, weight in C.PATH_WEIGHTS]
    depth = F.size(F.array_remove(F.split(low, "/"), ""))
    return F.greatest(*weights) - F.greatest(F.lit(0), depth - 2)


def crawlable_link(href: Column) -> Column:
    return (F.coalesce(href, F.lit("")) != "") & ~href.rlike("(?i)" + C.SKIP_LINK_PATTERN)


def _inner_filled(parts: Column) -> Column:
    """Segments without the empty ones between the first and the last."""
    last = F.size(parts) - 1
    return F.filter(parts, lambda p, i: (i == 0) | (i == last) | (p != ""))


def _without_dots(parts: Column) -> Column:
    """A path from its segments, with '.' and '..' resolved."""
    walked = F.aggregate(
        parts, F.array().cast("array<string>"),
        lambda done, p: F.when(p == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
                         .when(p == ".", done).otherwise(F.concat(done, F.array(p))))
    trailing = F.when(F.element_at(parts, -1).isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    joined = F.concat(F.array_join(walked, "/"), trailing)
    return F.when(joined.startswith("/"), joined).otherwise(F.concat(F.lit("/"), joined))


def resolve_link(base: Column, href: Column) -> Column:
    """A link as clean absolute URL (scheme, host, path); null unless http(s)."""
    base_scheme = F.lower(F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    base_dir = F.regexp_extract(url_path(base), "^.*/", 0)
    link = F.regexp_replace(href, r"^[\x00-\x20]+|[\t\r\n]", "")
    own = F.lower(F.regexp_extract(link, "^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    rest = F.when(own != "", F.regexp_replace(link, "^[^:]*:", "")).otherwise(link)
    scheme = F.when(own != "", own).otherwise(base_scheme)
    other = (own != "") & (own != base_scheme)
    given = F.regexp_extract(rest, "^//([^/?#]*)", 1)
    absolute = other | (given != "")
    netloc = F.when(absolute, given).otherwise(host_of(base))
    path = F.regexp_extract(rest, "^(?://[^/?#]*)?([^?#]*)", 1)
    bare = F.regexp_replace(path, ";[^/]*$", "")
    local = (
        F.when(path == "", url_path(base))
        .when(bare.startswith("/"), _without_dots(F.split(bare, "/")))
        .otherwise(_without_dots(_inner_filled(F.split(F.concat(
            F.when(base_dir == "", "/").otherwise(base_dir), bare), "/"))))
    )
    full_path = F.when(absolute, bare).otherwise(local)
    clean = F.concat(scheme, F.lit("://"), netloc, F.rtrim(full_path, F.lit("/")))
    return F.when(scheme.isin("http", "https"), clean)


def pick_subpages(links: Column, base: Column, site: Column, k: int = 4) -> Column:
    """The k links of one page most worth reading, best first.

    Works on the page's own link array, so no row leaves its task.
    """
    usable = F.filter(links, crawlable_link)
    urls = F.array_distinct(F.transform(usable, lambda h: resolve_link(base, h)))
    base_url = F.rtrim(base, F.lit("/"))
    ranked = F.transform(urls, lambda u, i: F.struct(
        (-score_path(url_path(u))).alias("rank"), F.length(u).alias("size"),
        i.alias("ord"), u.alias("url")))
    kept = F.filter(ranked, lambda r: (r["rank"] < 0) & (r["url"] != base_url)
                    & same_site(host_of(r["url"]), site))
    return F.slice(F.transform(F.array_sort(kept), lambda r: r["url"]), 1, k)
