"""SQL fragments of the twins, in DuckDB's dialect."""

from __future__ import annotations


def entities(x: str) -> str:
    """The four references the given tables use; the ampersand last, so none is read twice."""
    return (
        f"regexp_replace(replace(replace(replace({x}, '&quot;', '\"'), '&copy;', '©'), '&middot;', '·'),"
        " '&amp;?', '&', 'g')"
    )


def squeeze(x: str) -> str:
    return rf"trim(regexp_replace({x}, '[\s\p{{Z}}\x1c-\x1f\x{{85}}]+', ' ', 'g'))"


def normalise(x: str) -> str:
    return squeeze(entities(x))


def clean(x: str) -> str:
    out = normalise(x)
    for separator, site in (("\\|", "Fox News"), ("-", "Fox News"), ("\\|", "NBC News"), ("-", "NBC News"), ("\\|", "NBC News Select")):
        out = rf"trim(regexp_replace({out}, '\s*{separator}\s*{site}\s*$', '', 'i'))"
    return f"trim({out}, '\"''“”‘’ ')"


SCHEME = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?"


def host(url: str) -> str:
    return f"lower(regexp_extract({url}, '{SCHEME}//([^/?#]*)', 1))"


def path(url: str) -> str:
    return f"regexp_replace(regexp_extract({url}, '{SCHEME}(?://[^/?#]*)?([^?#]*)', 1), ';[^/]*$', '')"


def query_part(url: str) -> str:
    return rf"regexp_extract({url}, '^[^?#]*\?([^#]*)', 1)"


def label(url: str) -> str:
    h = host(url)
    return f"CASE WHEN contains({h}, 'example.com') THEN 0 WHEN contains({h}, 'example.net') THEN 1 END"


def source(url: str) -> str:
    h = host(url)
    return f"CASE WHEN contains({h}, 'example.com') THEN 'SiteA' WHEN contains({h}, 'example.net') THEN 'SiteB' ELSE 'Unknown' END"


def url_words(url: str) -> str:
    plain = f"replace(replace(url_decode({path(url)}), '.print', ' '), '.html', ' ')"
    return normalise(f"translate({plain}, '/-_', '   ')")


def slug(url: str) -> str:
    last = f"list_extract(string_split(trim({path(url)}, '/'), '/'), -1)"
    bare = rf"regexp_replace(regexp_replace({last}, '\.print$', '', 'i'), '\.html$', '', 'i')"
    return clean(f"translate({bare}, '-_', '  ')")


def h1(html: str) -> str:
    return f"regexp_replace(regexp_extract({html}, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]+>', ' ', 'g')"


def title(html: str) -> str:
    return entities(f"regexp_extract({html}, '(?is)<title[^>]*>(.*?)</title', 1)")


def digest(seed, key: str) -> str:
    return f"md5('{seed}|' || CAST({key} AS VARCHAR))"


def number(hex_text: str) -> str:
    return f"CAST('0x' || {hex_text} AS BIGINT)"


RESOLVED = f"""resolved AS (
  SELECT page_id AS ord, url, {source('url')} AS source, {label('url')} AS label, headline <> '' AS success,
         headline, CASE WHEN headline <> '' THEN 'direct_html' ELSE 'none' END AS headline_method
  FROM (SELECT page_id, url, {clean(entities(h1('html')))} AS headline FROM pages)
)"""

# Rows with their final headline and the first filter that rejects them.
MARKED = f"""marked AS (
  SELECT *, CASE WHEN NOT success THEN 'not_success' WHEN label IS NULL THEN 'no_label'
                 WHEN h = '' THEN 'empty_headline' WHEN length(h) < 8 THEN 'short_headline'
                 WHEN NOT regexp_matches(h, '[\\p{{L}}\\p{{N}}]') THEN 'symbol_only_headline' END AS reason
  FROM (SELECT *, {clean('headline')} AS h FROM source_rows)
)"""


def first_of(rows: str, key: str, order: str) -> str:
    return f"(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {rows}) WHERE rn = 1)"


CLEANED = f"""by_url AS {first_of('(SELECT * FROM marked WHERE reason IS NULL)', 'lower(url)', 'url, ord')},
cleaned AS {first_of('by_url', 'lower(h)', 'url, ord')}"""

REPEATED = """repeated AS (
  SELECT * REPLACE (ord * 2 AS ord) FROM resolved
  UNION ALL SELECT * REPLACE (ord * 2 + 1 AS ord, upper(url) AS url) FROM resolved
)"""

MIXED = f"""{RESOLVED}, {REPEATED}, mixed AS (
  SELECT ord, CASE WHEN ord % 2 = 0 THEN headline END AS title, CAST(NULL AS VARCHAR) AS label, url AS link FROM repeated
  UNION ALL
  SELECT d.doc_id + 1000000000000, d.text, CAST(l.quality AS VARCHAR), '' FROM documents d LEFT JOIN labels l USING (doc_id)
)"""

EXPERIMENT = f"""{RESOLVED}, {REPEATED}, experiment AS (
  SELECT ord, url, headline, label FROM repeated WHERE label IS NOT NULL
  UNION ALL
  SELECT d.doc_id + 1000000000000, NULL, d.text, l.quality FROM documents d JOIN labels l USING (doc_id)
)"""


def loose(rows: str) -> str:
    return f"(SELECT * REPLACE ({normalise('headline')} AS headline, coalesce(trim(url), '') AS url) FROM {rows} WHERE {normalise('headline')} <> '')"


def strict(rows: str, order: str = "ord") -> str:
    kept = f"(SELECT * FROM {loose(rows)} WHERE length(headline) >= 8 AND regexp_matches(headline, '[\\p{{L}}\\p{{N}}]'))"
    return first_of(first_of(kept, "lower(url)", order), "lower(headline)", order)


def split(rows: str, label_column: str, key: str, fraction: float = 0.2, seed: int = 42) -> str:
    """Rows with ``side``: exact per-class sizes, largest remainders to training."""
    return f"""(
  SELECT r.* EXCLUDE (rn), CASE WHEN rn <= t.n - t.train THEN 'test' ELSE 'train' END AS side
  FROM (SELECT *, row_number() OVER (PARTITION BY {label_column} ORDER BY {digest(seed, key)}, {key}) AS rn FROM {rows}) r
  JOIN (
    SELECT c, n, floored + CASE WHEN row_number() OVER (ORDER BY exact - floored DESC, c)
                                     <= train_total - sum(floored) OVER () THEN 1 ELSE 0 END AS train
    FROM (SELECT *, CAST(floor(exact) AS BIGINT) AS floored FROM (
      SELECT c, n, train_total, CAST(n AS DOUBLE) / total * train_total AS exact FROM (
        SELECT c, n, total, total - CAST(ceil({fraction}::DOUBLE * total) AS BIGINT) AS train_total
        FROM (SELECT {label_column} AS c, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM {rows} GROUP BY 1))))
  ) t ON r.{label_column} = t.c)"""


TOKENS = "regexp_extract_all(strip_accents(lower(text)), '[\\p{L}\\p{N}_]{2,}')"


def grams(tokens: str) -> str:
    """Words and word pairs of a token list."""
    return (
        f"list_concat({tokens}, list_transform(range(1, len({tokens})),"
        f" lambda i: {tokens}[i] || ' ' || {tokens}[i + 1]))"
    )
