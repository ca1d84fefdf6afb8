"""JSON-LD, embedded JSON, CMS posts and date precedence over JSON built from documents."""

from pyspark.sql import functions as F

from pressmill.checks import sqltext as S
from pressmill.checks.date_checks import AS_OF
from pressmill.checks.fixtures import table
from pressmill.checks.registry import check
from pressmill.functions.dates import iso_local, iso_utc
from pressmill.functions.text import section_slug
from pressmill.operators import extract as E
from pressmill.session import shared_folder
from pressmill.sources import posts as P

_N, _DAY = "cast(doc_id as string)", "lpad(cast(1 + doc_id % 28 as string), 2, '0')"
_DATE = f"concat('2024-05-', {_DAY}, 'T23:', lpad(cast(doc_id % 60 as string), 2, '0'), ':00-06:00')"
_QUOTE = 'type="application/ld+json"'

GRAPH = f"""concat('{{"@context":"https://schema.org","@graph":[{{"@type":"Organization","name":"x"}},',
  case doc_id % 4 when 0 then concat('{{"@type":"Article","datePublished":"2020-01-01T00:00:00Z"}},{{"@type":"WebPage","datePublished":"', {_DATE}, '"}}')
   when 1 then concat('{{"@type":"WebPage","datePublished":"soon"}},{{"@type":"Article","datePublished":"', {_DATE}, '"}}')
   when 2 then concat('{{"@type":"WebPage"}},{{"@type":"Person","datePublished":"', {_DATE}, '"}}')
   else '{{"@type":"WebPage"}}' end, ']}}')"""
TOP = f"""case doc_id % 5 when 0 then 'not json' when 1 then '{{"a":1}}' else concat('{{"datePublished":"', {_DATE}, '"}}') end"""
_UTC = f"strftime(strptime(concat('2024-05-', {_DAY}, ' 23:', lpad(cast(doc_id % 60 as string), 2, '0'), ':00'), '%Y-%m-%d %H:%M:%S') + interval 6 hour, '%Y-%m-%d %H:%M:%S')"
_LOCAL = f"concat('2024-05-', {_DAY}, ' 23:', lpad(cast(doc_id % 60 as string), 2, '0'), ':00')"


@check("jsonld_date", f"""select doc_id, case when doc_id % 4 <> 3 then {_UTC} end as graph_date,
  case when doc_id % 5 > 1 then {_LOCAL} end as top_date from documents""")
def jsonld_date(spark, sf_dir):
    df = table(spark, sf_dir, "documents").select("doc_id", F.expr(GRAPH).alias("g"), F.expr(TOP).alias("t"))
    return df.select("doc_id", E.graph_date(F.col("g"), iso_utc).alias("graph_date"),
                     iso_local(F.get_json_object("t", "$.datePublished")).alias("top_date"))


SCRIPTED = f"""concat('<html><script {_QUOTE}>', case doc_id % 6
   when 0 then concat('{{"@graph":[{{"@type":"WebPage"}},{{"@type":"NewsArticle","datePublished":"', {_DATE}, '","articleSection":["Sucesos ', {_N}, '","B"]}}]}}')
   when 1 then concat('[{{"@type":"Article","datePublished":"', {_DATE}, '","articleSection":"Mundo"}}]')
   when 2 then concat('{{"@type":"NewsArticle","datePublished":"', {_DATE}, '"}}')
   when 3 then '{{broken' when 4 then '{{"@type":"WebPage","datePublished":"2020-01-01"}}'
   else concat('{{"@type":"Article","datePublished":"2019-01-01","articleSection":"A"}}</script><script {_QUOTE}>',
     '{{"@type":"Article","datePublished":"', {_DATE}, '"}}') end, '</script></html>')"""


@check("jsonld_article", f"""select doc_id, case when doc_id % 6 in (0, 1, 2, 5) then {_DATE} end as date,
  case doc_id % 6 when 0 then concat('Sucesos ', {_N}) when 1 then 'Mundo' when 5 then 'A' end as section from documents""")
def jsonld_article(spark, sf_dir):
    df = table(spark, sf_dir, "documents").select("doc_id", F.expr(SCRIPTED).alias("html"))
    return df.withColumn("a", E.graph_article(E.scripts(F.col("html")))).select("doc_id", "a.date", "a.section")


EMBEDDED = f"""concat('<html><script id="__cms_post_meta" type="application/json">', case when doc_id % 4 = 0 then 'oops'
  else concat('{{"author":"x","category":"Política Única","date":"', {_DATE}, '"}}') end, '</script></html>')"""


@check("embedded_meta", f"""select doc_id, case when doc_id % 4 <> 0 then 'politica-unica' end as section,
  case when doc_id % 4 <> 0 then concat('2024-05-', {_DAY}) end as date from documents""")
def embedded_meta(spark, sf_dir):
    df = table(spark, sf_dir, "documents").select("doc_id", F.expr(EMBEDDED).alias("html"))
    return df.withColumn("m", E.embedded_meta(F.col("html"))).select(
        "doc_id", section_slug(F.col("m.category")).alias("section"), F.col("m.date").alias("date"))


DATED = f"""concat('<html>', case when doc_id % 2 = 0 then concat('<script {_QUOTE}>{{"@graph":[{{"@type":"WebPage","datePublished":"', {_DATE}, '"}}]}}</script>') else '' end,
  case when doc_id % 3 = 0 then '<meta property="article:published_time" content="2024-01-01T10:00:00-06:00">' else '' end,
  case when doc_id % 5 = 0 then '<time class="entry-date" datetime="2024-02-02T12:00:00Z">x</time>' else '' end, '</html>')"""
LISTING = "case when doc_id % 7 = 0 then '' else '2024-03-03' end"
_J = f"case when doc_id % 2 = 0 then {_LOCAL} end"
_M = "case when doc_id % 3 = 0 then '2024-01-01 10:00:00' end"
_T = "case when doc_id % 5 = 0 then '2024-02-02 06:00:00' end"
_L = f"nullif({LISTING}, '')"


@check("date_precedence", f"""select doc_id, coalesce({_J}, {_M}, {_L}) as jsonld_meta_listing, coalesce({_M}, {_L}, {_T}) as meta_listing_time,
  coalesce({_L}, {_T}, {_M}) as listing_article, coalesce({_T}, {_M}) as time_meta from documents""")
def date_precedence(spark, sf_dir):
    df = table(spark, sf_dir, "documents").select("doc_id", F.expr(DATED).alias("html"), F.expr(LISTING).alias("listing"))
    page = F.col("html")
    df = df.withColumns({
        "jsonld": E.graph_date(F.try_element_at(E.scripts(page), F.lit(1)), iso_local),
        "meta": iso_local(E.meta_date(page)), "time": iso_local(E.time_date(page))})
    known = {n: F.col(n) for n in ("jsonld", "meta", "listing", "time")}
    known["text"] = known["time"]
    return df.select("doc_id", *[E.by_precedence(o, **known).alias(o) for o in (
        "jsonld_meta_listing", "meta_listing_time", "listing_article", "time_meta")])


# --- CMS posts -----------------------------------------------------------------------------------

_ESC = "replace(replace(translate(text, concat(chr(9), chr(10), chr(13)), '   '), chr(92), concat(chr(92), chr(92))), '\"', concat(chr(92), '\"'))"
_FLAT = "translate(text, concat(chr(9), chr(10), chr(13)), '   ')"
_EQ = "chr(92), '\"'"
POST = f"""concat('{{"id":', {_N}, ',"date":', case doc_id % 6 when 0 then '""' when 1 then '"pronto"'
    else concat('"', {_DATE}, '"') end, ',"link":"https://cms.example.org/', {_N}, '/","slug":"nota-', {_N},
    '","title":{{"rendered":"', case when doc_id % 9 = 0 then '' else concat('Nota <b>', {_N}, '</b> &amp; m&aacute;s | fin') end,
    '"}},"content":{{"rendered":"', case when doc_id % 18 = 0 then '' else concat('<p>', {_ESC}, '</p><figure>F</figure><a href=', {_EQ}, 'https://api.whatsapp.com/x',
    {_EQ}, '>WA</a><img src=', {_EQ}, 'i.png', {_EQ}, '>') end,
    '"}},"categories":[', case doc_id % 5 when 0 then '' when 1 then '99' else concat(cast(doc_id % 5 as string), ',7') end, ']}}')"""
# the category dictionary comes with the data: one entry per language of the documents
CATEGORIES = """select cast(case lang when 'en' then 2 when 'es' then 3 when 'fr' then 4 else 7 end as bigint) as id,
  min(concat('Sección ', upper(lang))) as name from {documents} group by 1"""
_PB = ("case when doc_id % 18 = 0 then '' else concat('<p>', " + _FLAT
       + ", '</p><figure>F</figure><a href=\"https://api.whatsapp.com/x\">WA</a><img src=\"i.png\">') end")
_PT = f"case when doc_id % 9 = 0 then '' else concat('Nota <b>', {_N}, '</b> &amp; más | fin') end"


@check("posts_to_articles", f"""with raw as (select doc_id, {_PT} as t, {_PB} as b from documents), cats as ({CATEGORIES.format(documents='documents')}),
  cleaned as (select doc_id, {S.clean_strict('t')} as title, {S.clean_strict('b')} as full_text from raw)
  select doc_id as id, 'cms' as source, concat('https://cms.example.org/', {_N}, '/') as url, title,
  case doc_id % 6 when 0 then 'N/A' when 1 then null else {_LOCAL} end as publication_date, '{AS_OF}' as scraping_date,
  coalesce(name, 'Noticias') as section, full_text, 'es' as language
  from cleaned left join cats on doc_id % 5 > 0 and id = case when doc_id % 5 = 1 then 99 else doc_id % 5 end where title <> '' or full_text <> ''""")
def posts_to_articles(spark, sf_dir):
    """Landed pages: JSON arrays of a hundred posts, and the categories in an array of their own."""
    docs = table(spark, sf_dir, "documents")
    folder = shared_folder(spark)
    P.write_pages(docs, folder + "/posts", "doc_id", F.expr(POST), size=500)
    P.write_pages(spark.sql(CATEGORIES, documents=docs), folder + "/categories", "id", F.to_json(F.struct("id", "name")))
    return P.to_articles(P.read_posts(spark, folder + "/posts"), P.read_categories(spark, folder + "/categories"), F.lit("cms"), AS_OF)


@check("category_slugs", """select lower(lang) as slug, min(case lang when 'en' then 2 when 'es' then 3 when 'fr' then 4 else 7 end) as id
  from documents where lang is not null group by 1""")
def category_slugs(spark, sf_dir):
    """Slug to id, for the addresses of a section's pages of posts."""
    folder = shared_folder(spark)
    cats = spark.sql("select lower(lang) as slug, cast(min(case lang when 'en' then 2 when 'es' then 3 when 'fr' then 4 else 7 end) as bigint) as id, "
                     "'n' as name from {documents} group by 1", documents=table(spark, sf_dir, "documents"))
    P.write_pages(cats, folder, "id", F.to_json(F.struct("id", "name", "slug")))
    return P.category_ids(P.read_categories(spark, folder))


def _body_sql(b):
    x = S.sub(b, r"(?is)<img\s[^>]*>", "")
    x = S.sub(x, r"(?is)<figure(?:\s[^>]*)?>.*?</figure\s*>", "")
    x = S.sub(x, r'(?is)<a\s[^>]*href="[^"]*(?:whatsapp|facebook)[^"]*"[^>]*>.*?</a\s*>', "")
    return S.collapse(S.markup_text(x))


@check("posts_by_section", f"""with raw as (select doc_id, {_PT} as t, {_PB} as b, lang from documents)
  select doc_id as id, 'acms' as source, concat('https://cms.example.org/', lang, '/nota-', {_N}) as url, {S.collapse(S.markup_text('t'))} as title,
  case doc_id % 6 when 0 then 'Sin fecha' when 1 then 'pronto' else substring({_DATE}, 1, 10) end as publication_date, '{AS_OF}' as scraping_date,
  lang as section, {_body_sql('b')} as full_text, 'es' as language from raw""")
def posts_by_section(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    posts = P.parse_posts(docs.select("lang", F.expr(POST).alias("post")), "post")
    return P.to_sectioned_articles(posts, "https://cms.example.org", F.col("lang"), "acms", AS_OF)

