"""SQL text of recurring expressions, for the oracles."""

from leadsieve import constants as C

# Cells that mean "no website".
NULL_TOKENS = ["n/a", "na", "none", "null", "-", "--"]


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def values(texts) -> str:
    return ", ".join(map(lit, texts))


def strip(e: str) -> str:
    return f"regexp_replace({e}, '^[{C.SPACE_CLASS}]+|[{C.SPACE_CLASS}]+$', '', 'g')"


def collapse(e: str) -> str:
    return (f"trim(regexp_replace(regexp_replace(coalesce({e}, ''), '[{C.INVISIBLE_CLASS}]', '', 'g'), "
            f"'[{C.SPACE_CLASS}]+', ' ', 'g'))")


def domain(e: str) -> str:
    cell = f"trim(trim({strip(f'coalesce({e}, chr(32))')}, '\"'), '''')"
    host = f"regexp_replace({cell}, '(?i)^\\s*(?:https?:)?//', '')"
    host = f"regexp_replace(regexp_extract({host}, '^[^/?#]*'), '(?s)^.*@', '')"
    host = f"regexp_replace(lower(trim({strip(host)}, '.')), ':[0-9]+$', '')"
    return (f"CASE WHEN lower({cell}) NOT IN ('', {values(NULL_TOKENS)}) "
            f"AND regexp_matches({host}, '^[a-z0-9.-]+\\.[a-z]{{2,}}$') THEN {host} ELSE '' END")


def registrable(e: str) -> str:
    labels = f"list_filter(string_split(lower({e}), '.'), lambda x: x <> '')"
    return (f"CASE WHEN len({labels}) <= 2 THEN array_to_string({labels}, '.') "
            f"WHEN array_to_string(({labels})[-2:], '.') IN ({values(C.TWO_LABEL_SUFFIXES)}) "
            f"THEN array_to_string(({labels})[-3:], '.') ELSE array_to_string(({labels})[-2:], '.') END")


def host_of(e: str) -> str:
    return f"regexp_extract({e}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)"


def url_path(e: str) -> str:
    return (f"regexp_replace(regexp_extract({e}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), "
            f"';[^/]*$', '')")


def depth(path: str) -> str:
    return f"len(list_filter(string_split({path}, '/'), lambda x: x <> ''))"


def words(e: str) -> str:
    """Distinct content words."""
    return (f"len(list_filter(list_distinct(regexp_extract_all(lower({e}), '[a-z][a-z-]{{2,}}')), "
            f"lambda w: w NOT IN ({values(C.NAV_WORDS)})))")


def first_phrase(e: str, phrases) -> str:
    return "CASE " + " ".join(f"WHEN contains({e}, {lit(p)}) THEN {lit(p)}" for p in phrases) \
        + " ELSE '' END"


def comment_for(e: str) -> str:
    return "CASE " + " ".join(f"WHEN starts_with({e}, {lit(p)}) THEN {lit(t)}"
                              for p, t in C.REASON_COMMENTS) + f" ELSE {lit(C.DEFAULT_REASON_COMMENT)} END"


def family(e: str) -> str:
    return f"split_part({e}, ':', 1)"


def number(e: str) -> str:
    return (f"try_cast(replace(nullif(regexp_extract({e}, '-?[0-9][0-9,]*\\.?[0-9]*'), ''), ',', '') "
            f"AS DOUBLE)")


def letters(e: str) -> str:
    return f"regexp_replace(lower({e}), '[^a-z]', '', 'g')"


def path_of(e: str) -> str:
    rest = f"regexp_replace({e}, '^https?://[^/]+', '')"
    return f"left(CASE WHEN {rest} = '' THEN '/' ELSE {rest} END, {C.DIGEST_PATH_CHARS})"


def latest(source: str, key: str, seq: str = "seq") -> str:
    return (f"(SELECT * FROM {source} WHERE coalesce(CAST({key} AS VARCHAR), '') <> '' "
            f"QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {seq} DESC) = 1)")


# --- sites --------------------------------------------------------------------

def site_ctes(pages: str, order: str) -> str:
    """CTEs from a page relation (domain, url, title, description, headings list, text)
    to `gated` (domain, n_pages, chars, status, gate_reason, gate_ok) and `digests`."""
    blank = "coalesce(array_to_string(headings, ' '), '')"
    heads = (f"list_filter(list_transform(headings, lambda h: {collapse('h')}), lambda h: h <> '')")
    return f"""
    picked AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY {order}) AS rk
             FROM {pages} QUALIFY rk <= {C.MAX_PAGES}),
    top5 AS (SELECT * FROM picked WHERE rk = 1 OR coalesce(text, '') <> ''),
    site AS (SELECT domain, count(*) AS n_pages, CAST(sum(length(text)) AS BIGINT) AS chars,
                    string_agg(text, ' ' ORDER BY rk) AS words,
                    string_agg(title || ' ' || description || ' ' || {blank}, ' ' ORDER BY rk) AS meta,
                    max(CASE WHEN rk = 1 THEN length(text) END) AS home_chars,
                    max(CASE WHEN rk = 1 THEN title || description || {blank} END) AS label
             FROM top5 GROUP BY domain),
    measured AS (SELECT *, lower(left(words || ' ' || meta, {C.PHRASE_WINDOW})) AS seen,
                    {letters('label')} AS lab, CASE WHEN chars >= {C.MIN_BODY_CHARS} THEN 'ok' ELSE 'thin' END AS st,
                    {letters("split_part(" + registrable('domain') + ", '.', 1)")} AS dkey FROM site)"""


def gate_case(status: str = "st") -> str:
    parked, stub = first_phrase("seen", C.PARKED_PHRASES), first_phrase("seen", C.STUB_PHRASES)
    n = words("words")
    return f"""CASE WHEN {status} NOT IN ('ok', 'thin') THEN 'status:' || {status}
        WHEN n_pages = 0 THEN 'no_pages'
        WHEN chars < {C.PHRASE_BODY_LIMIT} AND {parked} <> '' THEN 'parked:' || replace({parked}, ' ', '_')
        WHEN chars < {C.PHRASE_BODY_LIMIT} AND {stub} <> '' THEN 'stub:' || replace({stub}, ' ', '_')
        WHEN chars < {C.MIN_BODY_CHARS} THEN 'thin:' || chars || '_chars'
        WHEN length(lab) < {C.MIN_TITLE_LETTERS} OR (dkey <> '' AND lab = dkey) THEN 'no_real_title'
        WHEN n_pages < 2 AND home_chars < {C.MIN_HOME_CHARS} THEN 'single_thin_page:' || home_chars
        WHEN {n} < {C.MIN_CONTENT_WORDS} THEN 'not_prose:' || {n} || '_words' ELSE 'pass' END"""


def digest_ctes() -> str:
    """CTE `digests` (domain, digest) from `top5`."""
    clean = f"list_filter(list_transform(headings, lambda h: {collapse('h')}), lambda h: h <> '')"
    low = f"list_transform({clean}, lambda h: lower(h))"
    heads = (f"array_to_string(list_filter({clean}, lambda h, i: "
             f"list_position({low}, lower(h)) = i)[1:{C.DIGEST_HEADINGS}], ' | ')")
    chunk = ("left(" + collapse(
        "concat_ws(' ', nullif(title, ''), nullif(left(array_to_string(headings, ' '), "
        f"{C.DIGEST_PAGE_HEADINGS_CHARS}), ''), nullif(text, ''))") + f", {C.DIGEST_PAGE_CHARS})")
    return f"""
    lines AS (
      SELECT domain, rk, CASE WHEN rk = 1 THEN concat_ws(chr(10), 'DOMAIN: ' || domain,
          CASE WHEN title <> '' THEN 'TITLE: ' || left({collapse('title')}, {C.DIGEST_TITLE_CHARS}) END,
          CASE WHEN description <> '' THEN 'META: ' || left({collapse('description')}, {C.DIGEST_META_CHARS}) END,
          CASE WHEN {heads} <> '' THEN 'HEADINGS: ' || left({heads}, {C.DIGEST_HEADINGS_CHARS}) END,
          'HOME: ' || left({collapse('text')}, {C.DIGEST_HOME_CHARS}))
        WHEN {chunk} <> '' THEN 'PAGE ' || {path_of('url')} || ': ' || {chunk} END AS line
      FROM top5),
    drafts AS (SELECT domain, string_agg(line, chr(10) ORDER BY rk) AS d FROM lines GROUP BY domain),
    digests AS (SELECT domain, CASE WHEN length(d) > {C.DIGEST_MAX_CHARS}
                THEN left(d, {C.DIGEST_MAX_CHARS - 3}) || '...' ELSE d END AS digest FROM drafts)"""


# --- pages --------------------------------------------------------------------

def parsed_pages(source: str = "pages") -> str:
    """CTEs that parse the HTML of the given pages table; written on its own, with the
    running depth of hidden elements as a window sum per page."""
    from html import entities
    names = [n for n in entities.html5 if n.endswith(";") and n in
             ("lt;", "gt;", "quot;", "nbsp;", "copy;", "middot;", "apos;")]

    def decode(e: str) -> str:
        for n in names:
            e = f"replace({e}, '&{n}', {lit(entities.html5[n])})"
        return f"regexp_replace({e}, '&amp;?', '&', 'g')"

    hidden = "|".join(C.HIDDEN_ELEMENTS)
    tag = "<[a-zA-Z/!][^>]*>"
    return f"""
    bare AS (SELECT page_id, url, regexp_replace(html,
        '(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', ' ', 'g') AS b FROM {source}),
    pieces AS (SELECT page_id, unnest(string_split(regexp_replace(regexp_replace(b,
        '(?is)<title[^>]*>.*?</title>', ' ', 'g'), '(?i)<(/?)(?:{hidden})(?:\\s[^>]*)?>', chr(1) || '\\1' || chr(2), 'g'),
        chr(1))) AS piece, generate_subscripts(string_split(regexp_replace(regexp_replace(b,
        '(?is)<title[^>]*>.*?</title>', ' ', 'g'), '(?i)<(/?)(?:{hidden})(?:\\s[^>]*)?>', chr(1) || '\\1' || chr(2), 'g'),
        chr(1)), 1) AS i FROM bare),
    steps AS (SELECT *, CASE WHEN i > 1 AND starts_with(piece, chr(2)) THEN 1
        WHEN i > 1 AND starts_with(piece, '/' || chr(2)) THEN -1 ELSE 0 END AS d FROM pieces),
    summed AS (SELECT *, sum(d) OVER (PARTITION BY page_id ORDER BY i) AS s FROM steps),
    depths AS (SELECT *, s - least(0, min(s) OVER (PARTITION BY page_id ORDER BY i)) AS depth FROM summed),
    shown AS (SELECT page_id, string_agg(CASE WHEN depth = 0 THEN regexp_replace(piece, '^/?' || chr(2), '')
        ELSE '' END, ' ' ORDER BY i) AS v FROM depths GROUP BY page_id),
    parsed AS (SELECT page_id, url, {domain('url')} AS domain,
        left({collapse(decode("regexp_extract(b, '(?is)<title[^>]*>(.*?)</title>', 1)"))}, {C.TITLE_CHARS}) AS title,
        '' AS description,
        list_filter(list_transform(regexp_extract_all(v, '(?is)<h1[^>]*>(.*?)</h1>', 1),
            lambda h: {collapse(decode(f"regexp_replace(h, '{tag}', ' ', 'g')"))}),
            lambda h: h <> '' AND length(h) < {C.HEADING_LIMIT})[1:{C.MAX_HEADINGS}] AS headings,
        {collapse(decode(f"regexp_replace(v, '{tag}', ' ', 'g')"))} AS text,
        list_filter(list_transform(regexp_extract_all(b, '(?i)<a\\s[^>]*href="([^"]*)"', 1),
            lambda h: {decode('h')}), lambda h: h <> '') AS links,
        {depth(url_path('url'))} AS depth
      FROM bare JOIN shown USING (page_id))"""
