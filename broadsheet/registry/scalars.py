"""Sources, URL scalars, text and label scalars."""

from __future__ import annotations

from pyspark.sql import functions as F

from broadsheet.functions import labels, text, urls
from broadsheet.registry import sql
from broadsheet.registry.base import RULES, query, resolved_pages, table
from broadsheet.operators.profile import fingerprint
from broadsheet.sources import readers


@query("scan_urls", sql=f"SELECT trim(url) AS url FROM pages WHERE trim(url) <> ''")
def scan_urls(spark, sf):
    return readers.scan_urls(table(spark, sf, "pages"))


@query(
    "resolve_roles",
    sql="""SELECT doc_id AS ord, text AS raw_text, source AS raw_label, '' AS url FROM documents
           UNION ALL SELECT page_id, NULL, NULL, trim(url) FROM pages""",
)
def resolve_roles(spark, sf):
    documents = readers.with_roles(table(spark, sf, "documents"), "doc_id")
    return documents.unionByName(readers.with_roles(table(spark, sf, "pages"), "page_id"))


@query(
    "text_presence",
    sql=rf"SELECT count(*) FILTER (WHERE {sql.squeeze('text')} <> '') AS non_blank, count(*) AS rows FROM documents",
)
def text_presence(spark, sf):
    documents = readers.require_text(table(spark, sf, "documents"))
    return documents.agg(
        F.count_if(readers.non_blank(F.col("text"))).alias("non_blank"), F.count(F.lit(1)).alias("rows")
    )


@query("raw_sorted", sql=f"WITH {sql.RESOLVED} SELECT * FROM resolved ORDER BY url, ord")
def raw_sorted(spark, sf):
    return resolved_pages(spark, sf).orderBy("url", "ord")


_ROW = "md5(concat_ws(chr(31), CAST(doc_id AS VARCHAR), coalesce(text, ''), coalesce(lang, ''), coalesce(source, '')))"


@query(
    "dataset_fingerprint",
    sql=f"""SELECT count(*) AS rows, CAST(CAST(sum({sql.number(f'substr({_ROW}, 1, 8)')}) AS HUGEINT) AS VARCHAR) AS fingerprint
            FROM documents""",
)
def dataset_fingerprint(spark, sf):
    return fingerprint(table(spark, sf, "documents"), "doc_id", "text", "lang", "source")


@query(
    "url_parts",
    sql=f"SELECT page_id, {sql.host('url')} AS host, {sql.path('url')} AS path, {sql.query_part('url')} AS query FROM pages",
)
def url_parts(spark, sf):
    u = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id", urls.authority(u).alias("host"), urls.path(u).alias("path"), urls.query(u).alias("query")
    )


@query("label_from_host", sql=f"SELECT page_id, {sql.label('url')} AS label FROM pages")
def label_from_host(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.label_from_host(F.col("url"), RULES).alias("label"))


@query("source_from_host", sql=f"SELECT page_id, {sql.source('url')} AS source, {sql.label('url')} AS label FROM pages")
def source_from_host(spark, sf):
    u = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id", urls.source_from_host(u, RULES).alias("source"), urls.label_from_host(u, RULES).alias("label")
    )


@query("url_pseudo_text", sql=f"SELECT page_id, {sql.url_words('url')} AS words FROM pages")
def url_pseudo_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.url_words(F.col("url")).alias("words"))


@query("url_slug_headline", sql=f"SELECT page_id, {sql.slug('url')} AS slug FROM pages")
def url_slug_headline(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.slug_headline(F.col("url")).alias("slug"))


@query(
    "url_variants",
    sql=rf"""
WITH parts AS (
  SELECT page_id, trim(url) AS raw,
         CASE WHEN {sql.host('trim(url)')} IN ('example.com', 'example.net') THEN 'www.' ELSE '' END || {sql.host('trim(url)')} AS host,
         CASE WHEN {sql.path('trim(url)')} = '' THEN '/' ELSE {sql.path('trim(url)')} END AS route,
         CASE WHEN {sql.query_part('trim(url)')} = '' THEN '' ELSE '?' || {sql.query_part('trim(url)')} END AS q
  FROM pages
), spelled AS (
  SELECT page_id, 0 AS n, raw AS v FROM parts
  UNION ALL SELECT page_id, 1, 'https://' || host || route || q FROM parts
  UNION ALL SELECT page_id, 2, 'https://' || host || route FROM parts
  UNION ALL SELECT page_id, 3, 'https://' || host || regexp_replace(route, '\.print$', '') || q FROM parts WHERE route LIKE '%.print'
  UNION ALL SELECT page_id, 4, 'https://' || host || regexp_replace(route, '\.print$', '') FROM parts WHERE route LIKE '%.print'
  UNION ALL SELECT page_id, 5, 'https://' || host || rtrim(route, '/') || q FROM parts WHERE route <> '/' AND route LIKE '%/'
  UNION ALL SELECT page_id, 6, 'https://' || host || rtrim(route, '/') FROM parts WHERE route <> '/' AND route LIKE '%/'
  UNION ALL SELECT page_id, 7, 'https://' || host || route || '/' || q FROM parts WHERE route NOT LIKE '%/'
), firsts AS (SELECT page_id, v AS request_url, min(n) AS n FROM spelled GROUP BY 1, 2)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY n) - 1 AS INTEGER) AS variant, request_url FROM firsts""",
)
def url_variants(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", F.posexplode(urls.url_variants(F.col("url"), RULES)).alias("variant", "request_url")
    )


@query("normalize_text", sql=f"SELECT doc_id, {sql.normalise('text')} AS text FROM documents")
def normalize_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.normalise(F.col("text")).alias("text"))


_DECORATED = "'\"' || text || ' | NBC News | Fox News\"'"


@query(
    "clean_headline",
    sql=f"""SELECT doc_id, {sql.clean('text')} AS plain, {sql.clean(_DECORATED)} AS once,
                   {sql.clean(sql.clean(_DECORATED))} AS twice FROM documents""",
)
def clean_headline(spark, sf):
    decorated = F.concat(F.lit('"'), F.col("text"), F.lit(' | NBC News | Fox News"'))
    return table(spark, sf, "documents").select(
        "doc_id",
        text.clean_headline(F.col("text")).alias("plain"),
        text.clean_headline(decorated).alias("once"),
        text.clean_headline(text.clean_headline(decorated)).alias("twice"),
    )


@query(
    "canonical_label",
    sql="""
SELECT 'quality' AS kind, doc_id, CASE WHEN quality = 0 THEN 0 WHEN quality = 1 THEN 1 END AS label FROM labels
UNION ALL
SELECT 'source', doc_id, CASE WHEN lower(source) IN ('src0', 'src2', 'src4') THEN 0
                              WHEN lower(source) IN ('src1', 'src3', 'src5') THEN 1 END FROM documents""",
)
def canonical_label(spark, sf):
    synonyms = {0: ("src0", "src2", "src4"), 1: ("src1", "src3", "src5")}
    by_number = table(spark, sf, "labels").select(
        F.lit("quality").alias("kind"), "doc_id", labels.canonical_label(F.col("quality")).alias("label")
    )
    spelled = F.concat(F.lit("\t "), F.upper("source"), F.lit(" "))
    by_name = table(spark, sf, "documents").select(
        F.lit("source").alias("kind"), "doc_id", labels.canonical_label(spelled, synonyms).alias("label")
    )
    return by_number.unionByName(by_name)


@query(
    "resolve_label",
    sql=f"""SELECT page_id, CASE WHEN url LIKE '%/fr/%' THEN 0 WHEN url LIKE '%/de/%' THEN 1 ELSE {sql.label('url')} END AS label FROM pages""",
)
def resolve_label(spark, sf):
    raw = F.when(F.col("url").contains("/fr/"), F.lit(" FOX ")).when(F.col("url").contains("/de/"), F.lit("nbc news"))
    return table(spark, sf, "pages").select(
        "page_id", labels.resolve_label(raw.otherwise(F.lit("?")), F.col("url"), RULES).alias("label")
    )


@query(
    "coerce_item",
    sql=f"""
WITH {sql.RESOLVED}
SELECT 'record' AS kind, ord, CASE WHEN label IS NOT NULL AND headline <> '' THEN {sql.normalise('headline')} ELSE {sql.url_words('url')} END AS text FROM resolved
UNION ALL SELECT 'url', page_id, {sql.url_words('url')} FROM pages
UNION ALL SELECT 'text', doc_id, {sql.normalise('text')} FROM documents""",
)
def coerce_item(spark, sf):
    records = resolved_pages(spark, sf).select(
        F.lit("record").alias("kind"),
        "ord",
        labels.text_of_map(
            F.create_map(
                F.lit("headline"), F.when(F.col("label").isNotNull(), F.col("headline")).otherwise(F.lit("")),
                F.lit("url"), F.col("url"),
            )
        ).alias("text"),
    )
    links = table(spark, sf, "pages").select(
        F.lit("url").alias("kind"), F.col("page_id").alias("ord"), labels.text_of_string(F.col("url")).alias("text")
    )
    texts = table(spark, sf, "documents").select(
        F.lit("text").alias("kind"), F.col("doc_id").alias("ord"), labels.text_of_string(F.col("text")).alias("text")
    )
    return records.unionByName(links).unionByName(texts)


@query(
    "text_representation",
    sql=f"""
WITH {sql.RESOLVED}, f AS (SELECT ord, {sql.normalise('headline')} AS h, {sql.url_words('url')} AS u FROM resolved)
SELECT ord, h AS headline_only, u AS url_only, h || ' [SEP] ' || u AS headline_plus_url FROM f""",
)
def text_representation(spark, sf):
    pages = resolved_pages(spark, sf).select(
        "ord", text.normalise(F.col("headline")).alias("h"), text.normalise(urls.url_words(F.col("url"))).alias("u")
    )
    modes = ("headline_only", "url_only", "headline_plus_url")
    return pages.select("ord", *[text.fields_text(F.col("h"), F.col("u"), m).alias(m) for m in modes])
