"""Extraction, links and containers over the pages table."""

from pyspark.sql import functions as F

from pressmill.checks import sqltext as S
from pressmill.checks.date_checks import AS_OF
from pressmill.checks.fixtures import table
from pressmill.checks.listing_pages import LISTINGS, TITLES, listing_sql, numbered
from pressmill.checks.outlet_pages import SAMPLES, literal, page_sql
from pressmill.checks.registry import check
from pressmill.functions import html as M
from pressmill.functions.text import has_markup, once
from pressmill.functions.urls import canonical, host_of, section_by_path
from pressmill.operators import extract as E
from pressmill.operators import gate as G
from pressmill.operators import links as L
from pressmill.operators import stats as ST
from pressmill.plans.link_profiles import LINK_PROFILES, link_profiles_frame
from pressmill.plans.profiles import PROFILES, profiles_frame

# --- oracle pieces -------------------------------------------------------------------------

INLINE = M.INLINE_TAG


def seen(x):
    return S.collapse(S.markup_text(S.sub(x, INLINE, "")))


def first(x, tag):
    return f"regexp_extract({x}, '(?is)<{tag}(?:\\s[^>]*)?>(.*?)</{tag}\\s*>', 1)"


def bare(x):
    x = S.sub(x, r"(?s)<!--.*?-->", "")
    for tag in ("script", "style"):
        x = S.sub(x, rf"(?is)<{tag}(?:\s[^>]*)?>.*?</{tag}\s*>", "")
    return x


def blocks(x):
    return (f"list_transform(string_split_regex({x}, '(?i)<p(?:\\s[^>]*)?>')[2:], "
            f"lambda s: {seen('string_split_regex(s, ' + S.q('(?i)</p>') + ')[1]')})")


def keep_order(x):
    """Distinct list keeping first places."""
    return f"list_filter({x}, lambda t, i: list_position({x}, t) = i)"


def long(x, n):
    return f"list_filter({x}, lambda t: length(t) >= {n})"


RICH = """select page_id, url, replace(replace(html, '<article>', concat(
    '<div class="elementor-widget-container side"><p>Uno ', cast(page_id as string), '</p></div>',
    '<div class="elementor-widget-container main"><article class="entry-content',
    case when page_id % 2 = 0 then '' else ' initial-load' end,
    '"><div class="share-ad"><p>Comparte esta nota con todas tus amistades ahora</p></div>')),
  '</article>', '</article></div>') as html from {pages}"""
RICH_SQL = "rich as (" + RICH.format(pages="pages") + ")"


def _pages(spark, sf_dir):
    return table(spark, sf_dir, "pages")


def _rich(spark, sf_dir):
    return spark.sql(RICH, pages=_pages(spark, sf_dir))


# --- single fields --------------------------------------------------------------------------

@check("extract_title", f"select page_id, nullif({seen(first('html', 'h1'))}, '') as title from pages")
def extract_title(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", E.title(F.col("html")).alias("title"))


SIGNED = """case page_id % 4 when 0 then concat('<div class="post-meta-author"><a href="#">Ana ', cast(page_id as string), ' Ñ</a></div>', html)
  when 1 then concat('<a class="single-layout__author" href="/x">Luis&nbsp;', cast(page_id as string), '</a>', html)
  when 2 then concat('<meta name="author" content="Eva ', cast(page_id as string), '">', html) else html end"""


@check("extract_author", """select page_id, case page_id % 4 when 0 then concat('Ana ', page_id, ' Ñ') when 1 then concat('Luis ', page_id)
  when 2 then concat('Eva ', page_id) else 'Sin autor' end as author from pages""")
def extract_author(spark, sf_dir):
    df = _pages(spark, sf_dir).select("page_id", F.expr(SIGNED).alias("html"))
    return df.select("page_id", E.author(F.col("html")).alias("author"))


_PARS = long(blocks(first(bare("html"), "article")), 15)


@check("extract_paragraphs", f"""select page_id, len(ps) as n, array_to_string(ps, chr(10) || chr(10)) as full_text
  from (select page_id, {keep_order('ps')} as ps from (select page_id, {_PARS} as ps from pages))""")
def extract_paragraphs(spark, sf_dir):
    ps = _pages(spark, sf_dir).withColumn("ps", E.paragraphs(F.col("html")))
    return ps.select("page_id", F.size("ps").cast("long").alias("n"), F.array_join("ps", "\n\n").alias("full_text"))


_QUIET = bare("html")
for _t in ("nav", "footer"):
    _QUIET = S.sub(_QUIET, rf"(?is)<{_t}(?:\s[^>]*)?>.*?</{_t}\s*>", "")
_QUIET = S.sub(_QUIET, r'(?is)<div\s[^>]*class="[^"]*ad[^"]*"[^>]*>.*?</div\s*>', "")


@check("html_remove_noise", f"select page_id, {_QUIET} as html from pages")
def html_remove_noise(spark, sf_dir):
    page = M.drop_elements(M.drop_comments(F.col("html")), ["script", "style", "nav", "footer"])
    return _pages(spark, sf_dir).select("page_id", M.drop_class(page, "div", "ad").alias("html"))


_NOISE_ARTICLE = long(blocks(first(bare("html"), "article")), 26)


PLAIN_SQL = RICH_SQL.replace("elementor-widget-container", "main-column")


@check("noise_class_substring", f"""with {PLAIN_SQL} select page_id, len(b) as n, array_to_string(b, chr(10) || chr(10)) as full_text
  from (select page_id, case when page_id % 2 = 1 then [] else (ps)[2:] end as b from (select page_id, {_NOISE_ARTICLE} as ps from rich))""")
def noise_class_substring(spark, sf_dir):
    return _noise(spark, sf_dir, "substring")


@check("noise_class_tokens", f"""with {PLAIN_SQL} select page_id, len(ps[2:]) as n, array_to_string(ps[2:], chr(10) || chr(10)) as full_text
  from (select page_id, {_NOISE_ARTICLE} as ps from rich)""")
def noise_class_tokens(spark, sf_dir):
    return _noise(spark, sf_dir, "token")


def _noise(spark, sf_dir, mode):
    profile = {**next(p for p in PROFILES if p["source"] == "larepublica"), "source": "x", "noise": mode,
               "containers": ["article"], "blocks": ["p"]}
    plain = F.replace("html", F.lit("elementor-widget-container"), F.lit("main-column"))
    df = _rich(spark, sf_dir).withColumns({"source": F.lit("x"), "html": plain}).join(F.broadcast(profiles_frame(spark, [profile])), "source")
    return E.body_texts(df).select("page_id", F.size("blocks").cast("long").alias("n"), "full_text")


_MAIN = f"len(string_split_regex({first(bare('html'), 'article')}, '(?i)<p(?:\\s[^>]*)?>')) - 1"


@check("best_container", f"""with {RICH_SQL} select page_id, 'elementor-widget-container main' as cls, {_MAIN} as paragraphs from rich""")
def best_container(spark, sf_dir):
    counts = E.container_counts(_rich(spark, sf_dir), ["div"], "elementor-widget-container")
    return E.best_container(counts, least=2).select("page_id", "cls", F.col("paragraphs").cast("long").alias("paragraphs"))


@check("top_containers", f"""with {RICH_SQL} select page_id, cls, paragraphs from (select page_id, case when page_id % 2 = 0 then 'entry-content'
    else 'entry-content initial-load' end as cls, {_MAIN} - 1 as paragraphs from rich) where paragraphs >= 3
  order by paragraphs desc, page_id limit 5""")
def top_containers(spark, sf_dir):
    counts = E.container_counts(_rich(spark, sf_dir), ["div", "article"], direct=True).where("paragraphs >= 3")
    return counts.select("page_id", "cls", F.col("paragraphs").cast("long").alias("paragraphs")) \
        .orderBy(F.desc("paragraphs"), "page_id").limit(5)


# Start tags counted by the coverage report.
COVERAGE = {"p": r"(?i)<p[\s>]", "h1": r"(?i)<h1[\s>]", "article": r"(?i)<article[\s>]", "ad": r'(?i)<div class="ad"',
            "a": r"(?i)<a\s", "time": r"(?i)<time\s"}


@check("selector_coverage", "select lang, count(*) as pages, " + ", ".join(
    f"cast(sum(len(regexp_extract_all(html, {S.q(p)}))) as bigint) as {n}_hits, count(*) filter (regexp_matches(html, {S.q(p)})) as {n}_pages"
    for n, p in COVERAGE.items()) + " from (select split_part(url, '/', 4) as lang, html from pages) group by lang")
def selector_coverage(spark, sf_dir):
    pages = _pages(spark, sf_dir).withColumn("lang", F.split_part("url", F.lit("/"), F.lit(4)))
    return E.selector_coverage(pages, "lang", COVERAGE)


OFFSETS = """case when page_id % 3 = 0 then html else concat(html, '<a href="?start=8">2</a><a href="/x?start=', cast(page_id * 8 as string), '">n</a>') end"""


@check("page_max_offset", "select page_id, case when page_id % 3 = 0 then 0 else greatest(8, page_id * 8) end as max_start from pages")
def page_max_offset(spark, sf_dir):
    df = _pages(spark, sf_dir).select("page_id", F.expr(OFFSETS).alias("html"))
    return df.select("page_id", L.max_offset(F.col("html")).cast("long").alias("max_start"))


PLACED = """case page_id % 6 when 0 then concat('<article class="post category-vida-sana x">', html, '</article>')
  when 1 then concat('<a href="https://x/category/n/">Política &amp; más</a>', html)
  when 2 then concat('<span class="section-label">Sucesos</span>', html)
  when 3 then concat('<span class="section-label">', repeat('muy ', 20), 'largo</span><nav class="breadcrumb"><a href="/">Inicio</a><a href="/d">Deportes</a></nav>', html)
  when 4 then concat('<nav class="breadcrumb"><a href="/">Home</a></nav>', html) else html end"""


@check("section_from_page", """select page_id, case page_id % 6 when 0 then 'Vida Sana' when 1 then 'Política & más' when 2 then 'Sucesos'
  when 3 then 'Deportes' else concat(upper(lang[1]), lang[2:]) end as section
  from (select page_id, split_part(url, '/', 4) as lang from pages)""")
def section_from_page(spark, sf_dir):
    df = _pages(spark, sf_dir).select("page_id", "url", F.expr(PLACED).alias("html"))
    return df.select("page_id", L.section_of_page(F.col("html"), F.col("url")).alias("section"))


# --- links -------------------------------------------------------------------------------------

BASE = "https://site.example.org"
# Listing pages are read per language; the language order is the section order.
SECTION_SEQ = "case split_part(url, '/', 4) when 'en' then 1 when 'es' then 2 when 'fr' then 3 when 'de' then 4 else 5 end"
_A = "regexp_extract_all(" + bare("html") + r""", '(?is)<a\s[^>]*href="[^"]*"[^>]*>.*?</a\s*>')"""
LINKS = f"""anchors as (select page_id, {SECTION_SEQ} as section_seq, split_part(url, '/', 4) as section, unnest({_A}) as a, generate_subscripts({_A}, 1) - 1 as seq from pages),
 parsed as (select page_id, section_seq, section, seq, regexp_extract(a, '(?is)^<a\\s[^>]*href="([^"]*)"', 1) as href,
   regexp_replace({seen("regexp_extract(a, '(?is)^<a" + chr(92) + "s[^>]*>(.*)</a" + chr(92) + "s*>$', 1)")}, '^[0-9]+\\.\\s*', '') as title from anchors),
 links as (select *, regexp_replace(case when href like 'http%' then href when href like '/%' then concat('{BASE}', href)
   else concat('{BASE}/', href) end, '[?#].*', '') as url from parsed where href <> '' and length(title) >= 3
   qualify row_number() over (partition by page_id, url order by seq) = 1)"""


def _links(spark, sf_dir):
    pages = _pages(spark, sf_dir).withColumns({
        "section_seq": F.expr(SECTION_SEQ), "section": F.split_part("url", F.lit("/"), F.lit(4))})
    return L.page_links(pages, BASE, 3, False, "section_seq", "section")


@check("page_links", f"with {LINKS} select page_id, section, seq, url, title from links")
def page_links(spark, sf_dir):
    return _links(spark, sf_dir).select("page_id", "section", F.col("seq").cast("long").alias("seq"), "url", "title")


@check("links_union_distinct", f"with {LINKS} select distinct url from links union select regexp_replace(url, '[?#].*', '') from pages")
def links_union_distinct(spark, sf_dir):
    return L.distinct_urls(_links(spark, sf_dir), _pages(spark, sf_dir).select(canonical(F.col("url")).alias("url")))


# within a section pages follow each other by id
def _sectioned(spark, sf_dir):
    return _links(spark, sf_dir).withColumn("seq", F.struct("page_id", "seq"))


@check("link_section_first", f"""with {LINKS} select url, section from links
  qualify row_number() over (partition by url order by section_seq, page_id, seq) = 1""")
def link_section_first(spark, sf_dir):
    return ST.first_section(_sectioned(spark, sf_dir))


@check("section_link_growth", f"""with {LINKS}, f as (select url, min(section_seq) as section_seq from links group by url),
 n as (select section_seq, count(*) as new_links from f group by section_seq), c as (select section_seq, count(*) as found from links group by section_seq)
 select section_seq, found, coalesce(new_links, 0) as new_links, cast(sum(coalesce(new_links, 0)) over (order by section_seq) as bigint) as unique_so_far
 from c left join n using (section_seq)""")
def section_link_growth(spark, sf_dir):
    return ST.section_link_growth(_sectioned(spark, sf_dir))


LISTING_OF = f"case page_id % {len(LINK_PROFILES)} " + " ".join(f"when {i} then '{p['source']}'" for i, p in enumerate(LINK_PROFILES)) + " end"


def _of_listing(value):
    return "case source " + " ".join(f"when '{p['source']}' then {value(p)}" for p in LINK_PROFILES) + " end"


def _card(p, n):
    path = LISTINGS[p["source"]][1]
    return numbered(p["base"] + (path if n == 0 else path.replace("nota", "nota-otra")))


_WANT = [", ".join([f"{_of_listing(lambda p, n=n: _card(p, n))} as url", f"{numbered(TITLES[n])} as title",
                    *(f"{_of_listing(lambda p, i=i: literal(LISTINGS[p['source']][i]))} as {name}" for i, name in ((2, 'publication_date'), (3, 'section')))])
         for n in (0, 1)]


@check("listing_links", " union all ".join(
    f"select page_id, source, {want} from (select page_id, {LISTING_OF} as source from pages)" for want in _WANT))
def listing_links(spark, sf_dir):
    """Listing pages of every outlet: titles off the block's heading, dates and sections off the block, repeated and empty
    addresses."""
    pages = _pages(spark, sf_dir).withColumn("source", F.expr(LISTING_OF))
    laid_out = pages.withColumn("html", F.expr(_of_listing(lambda p: listing_sql(p["source"], p["base"]))))
    links = L.listing_links(laid_out, link_profiles_frame(spark), 2024)
    return links.select("page_id", "source", "url", "title", "publication_date", "section")


LISTED = """select url, case when page_id % 4 = 0 then '' else concat('Lista ', cast(page_id as string)) end as title,
  case when page_id % 3 = 0 then null else 'Portada' end as section, concat('2024-05-', lpad(cast(1 + page_id % 28 as string), 2, '0')) as publication_date
  from {pages}"""
READ = """select url, case when page_id % 5 = 0 then null else concat('Nota ', cast(page_id as string)) end as title,
  case when page_id % 7 = 0 then 'Sucesos' else '' end as section, case when page_id % 2 = 0 then '2024-05-31 10:00:00' end as publication_date,
  html as full_text from {pages}"""


@check("link_article_merge", f"""with l as ({LISTED.format(pages='pages')}), a as ({READ.format(pages='pages')})
  select url, coalesce(nullif(a.title, ''), nullif(l.title, '')) as title, coalesce(nullif(a.section, ''), nullif(l.section, '')) as section,
  coalesce(nullif(a.publication_date, ''), nullif(l.publication_date, '')) as publication_date, a.full_text from l join a using (url)""")
def link_article_merge(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    return ST.merge_links(spark.sql(LISTED, pages=pages), spark.sql(READ, pages=pages))


# --- whole articles --------------------------------------------------------------------------------

def _profile_sql(p):
    body = first(bare("html"), "article")
    if not p["blocks"]:
        return seen(body)
    every = blocks(body)
    ps = f"list_concat([{seen(first(body, 'h1'))}], {every})" if "h1" in p["blocks"] else every
    ps = long(ps, p["least"])
    if p["source"] == "sinartdigital":
        ps = f"list_concat(['Texto sin párrafos, pero entero.'], {ps})"
    if p["distinct"]:
        ps = keep_order(ps)
    text = f"array_to_string({ps}, {'chr(10) || chr(10)' if p['joiner'] != ' ' else S.q(' ')})"
    if p["choose"] == "most":
        return f"case when len({long(every, 1)}) >= {max(p['need'], 1)} then {text} else '' end"
    if p["lead"]:
        return f"case when {text} <> '' then concat({literal('Resumen {d} ')}, {text}) else '' end"
    return text


_SOURCE = f"case page_id % {len(PROFILES)} " + " ".join(f"when {i} then '{p['source']}'" for i, p in enumerate(PROFILES)) + " end"


def _by_source(value):
    return "case source " + " ".join(f"when '{p['source']}' then {value(p)}" for p in PROFILES) + " end"


_FIELD = {name: _by_source(lambda p, i=i: literal(SAMPLES[p["source"]][i])) for i, name in ((5, "date"), (6, "section"), (7, "author"))}


@check("extract_articles", f"""select * from (select page_id, source, url, nullif({seen(first('html', 'h1'))}, '') as title,
  coalesce({_FIELD['author']}, 'Sin autor') as author, {_FIELD['date']} as publication_date, '{AS_OF}' as scraping_date,
  coalesce({_FIELD['section']}, concat(upper(lang[1]), lang[2:])) as section, {_by_source(_profile_sql)} as full_text,
  nullif(lower(regexp_extract(html, '(?i)<html[^>]*\\slang="([A-Za-z]{{2}})', 1)), '') as language
  from (select page_id, url, regexp_replace(html, '&amp([^;]|$)', '&amp;\\1', 'g') as html, {_SOURCE} as source, split_part(url, '/', 4) as lang from pages))
  where length(full_text) >= {_by_source(lambda p: str(p['least_text']))}""")
def extract_articles(spark, sf_dir):
    """Every outlet's layout, with decoys, removed parts and its own places for title, author, date and section."""
    pages = _pages(spark, sf_dir).withColumn("source", F.expr(_SOURCE))
    laid_out = pages.withColumn("html", F.expr(_by_source(lambda p: page_sql(p["source"]))))
    return E.articles(laid_out, profiles_frame(spark), AS_OF)


def page_articles(pages, as_of):
    """Landed pages to records with native expressions only (flat article layout).

    Pages carry no date of their own, so the scraping date stands in for it."""
    page = F.col("html")
    return pages.select(
        host_of(F.col("url")).alias("source"), canonical(F.col("url")).alias("url"),
        F.lit(as_of).alias("publication_date"), section_by_path(F.col("url")).alias("section"),
        F.regexp_extract(page, r'(?i)<html[^>]*\slang="([A-Za-z]{2})', 1).alias("language"),
        F.lit("pages").alias("file"), F.col("page_id").alias("seq"),
        once(title=E.title(page), full_text=F.array_join(E.paragraphs(page), "\n\n")))


@check("pages_to_corpus", f"""with a as (select regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) as source, regexp_replace(url, '[?#].*', '') as url,
    array_to_string({keep_order('ps')}, chr(10) || chr(10)) as full_text, page_id from (select *, {_PARS} as ps from pages)),
  v as (select * from a where length(full_text) >= 300 qualify row_number() over (partition by url order by page_id) = 1)
  select source, count(*) as articles, count(*) filter (regexp_matches(full_text, '<[^>]+>')) as with_markup from v group by source""")
def pages_to_corpus(spark, sf_dir):
    gated = G.accepted(G.enrich(page_articles(_pages(spark, sf_dir), AS_OF), AS_OF))
    return gated.groupBy("source").agg(
        F.count("*").alias("articles"), F.count_if(has_markup(F.col("full_text"))).alias("with_markup"))
