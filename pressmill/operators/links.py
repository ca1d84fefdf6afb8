"""Listing pages to link records."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.functions import html as M
from pressmill.functions import urls as U
from pressmill.functions.outline import listing
from pressmill.functions.text import collapse, drop_list_number, once, title_case
from pressmill.operators.dedupe import keep_first
from pressmill.operators.extract import DATE_PARSERS, SECTION_PARSERS, field
from pressmill.plans.link_profiles import ANY_LINK, link_profiles_frame

ANCHOR = r'(?is)(<a\s[^>]*href="[^"]*"[^>]*>.*?</a\s*>)'


def anchors(pages: DataFrame, *keep) -> DataFrame:
    """One row per anchor with its place on the page, address, text and inner markup."""
    page = M.drop_silent(F.col("html"))
    found = F.regexp_extract_all(page, F.lit(ANCHOR), F.lit(1))
    exploded = pages.select(*keep, F.posexplode(found).alias("seq", "anchor"))
    inner = F.regexp_extract("anchor", r"(?is)^<a\s[^>]*>(.*)</a\s*>$", 1)
    return exploded.select(
        *keep, "seq", F.regexp_extract("anchor", r'(?is)^<a\s[^>]*href="([^"]*)"', 1).alias("href"),
        drop_list_number(M.element_text(inner)).alias("title"),
        inner.rlike(r"(?i)<h[1-6][\s>]|class=\"[^\"]*text-body").alias("headed"))


def page_links(pages: DataFrame, base: str, least_title: int = 5, headed_only: bool = False, *keep) -> DataFrame:
    """Qualified links: address and title present, title long enough, first of each page."""
    rows = anchors(pages, "page_id", *keep).where(
        (F.col("href") != "") & (F.length("title") >= least_title))
    if headed_only:
        rows = rows.where("headed")
    linked = rows.withColumn("url", U.canonical(U.absolute(F.col("href"), base, "join")))
    return keep_first(linked, ["page_id", "url"], ["seq"])


def listing_links(pages: DataFrame, profiles: DataFrame, year: int, *keep) -> DataFrame:
    """Link records (page_id, source, seq, url, title, section, publication_date) of landed listing pages (page_id,
    source, url, html) by the outlets' link profiles; pages of unknown outlets give all their anchors.

    A table function under a lateral join reads a page once and gives its anchors with what lies in their blocks; which
    title is long enough, how a date is written and which address counts are columns. Profiles and address rules are
    package tables of a few dozen rows and are sent to every task; of a page's links to one address the first stays.
    Outlets that take one link per block take none outside of blocks.
    """
    spark = pages.sparkSession
    named = profiles.unionByName(link_profiles_frame(spark, [ANY_LINK]))
    known = [r["source"] for r in profiles.select("source").collect()]
    rules = U.rules_frame(spark, year)
    rules = rules.select(F.col("source").alias("_kind"), F.struct(*rules.columns).alias("_rule"))
    kind = F.when(F.col("source").isin(known), F.col("source")).otherwise(F.lit(ANY_LINK["source"]))
    of_page = pages.withColumn("_kind", kind).join(F.broadcast(named.withColumnRenamed("source", "_kind")), "_kind")
    judged_by = of_page.join(F.broadcast(rules), "_kind", "left")
    rows = judged_by.select("page_id", "source", "html", "base", "link_rules", "one", "least", "patterns", "never", "_rule", *keep) \
        .lateralJoin(listing(F.col("html").outer(), F.col("link_rules").outer()))
    title = drop_list_number(collapse(F.col("text")))
    long_enough = lambda t: F.length(drop_list_number(collapse(t))) >= F.col("least")
    rows = rows.where((F.col("href") != "") & (~F.col("one") | (F.col("card") >= 0) & (F.col("pick") == 0)))
    rows = rows.select("page_id", "source", "seq", "href", "base", "patterns", "never", "_rule", *keep, once(
        text=field("title", None, "found", long_enough), section=field("section", SECTION_PARSERS, "found"),
        publication_date=field("date", DATE_PARSERS, "found"))).where("text is not null")
    based = F.when(F.col("base") == "", F.col("href")).otherwise(
        F.when(F.col("href").rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), F.col("href"))
        .when(F.col("href").startswith("/"), F.concat("base", "href")).otherwise(F.concat_ws("/", "base", "href")))
    linked = rows.withColumn("address", based).withColumn("url", U.canonical(F.col("address")))
    fits = (F.size("patterns") == 0) | F.exists("patterns", lambda p: F.regexp_like("href", p) | F.regexp_like("address", p))
    judged = F.col("_rule").isNull() | U.is_article(F.col("address"), lambda name: F.col("_rule")[name])
    kept = linked.where(fits & ~F.exists("never", lambda x: F.contains("href", x)) & judged)
    firsts = keep_first(kept, ["page_id", "url"], ["seq"])
    return firsts.select("page_id", "source", "seq", "url", title.alias("title"), "section", "publication_date", *keep)


def distinct_urls(*frames) -> DataFrame:
    """Every address once, over all sections and pages."""
    out = frames[0].select("url")
    for f in frames[1:]:
        out = out.union(f.select("url"))
    return out.distinct()


def max_offset(page):
    """Largest paging offset (``start=``) on a page; 0 without any."""
    found = F.regexp_extract_all(page, F.lit(r"start=(\d+)"), F.lit(1))
    return F.coalesce(F.array_max(F.transform(found, lambda x: x.try_cast("bigint"))), F.lit(0).cast("bigint"))


def section_of_page(page, url):
    """Section from an element class, a category link, a heading label, a breadcrumb, else the path."""
    by_class = F.nullif(F.regexp_extract(page, r'(?i)class="[^"]*\bcategory-([a-z0-9-]+)', 1), F.lit(""))
    link = F.nullif(M.element_text(F.nullif(F.regexp_extract(
        page, r'(?is)<a\s[^>]*href="[^"]*/category/[^"]*"[^>]*>(.*?)</a\s*>', 1), F.lit(""))), F.lit(""))
    label = F.nullif(M.element_text(M.first_with_class(page, "span", "section-label")), F.lit(""))
    label = F.when(F.length(label) < 50, label)
    crumbs = F.transform(F.regexp_extract_all(
        F.coalesce(M.first_with_class(page, "nav", "breadcrumb"), F.lit("")), F.lit(r"(?is)<a\s[^>]*>(.*?)</a\s*>"), F.lit(1)),
        M.element_text)
    crumb = F.try_element_at(F.filter(crumbs, lambda t: ~F.lower(t).isin("inicio", "home", "")), F.lit(1))
    return F.coalesce(title_case(F.replace(by_class, F.lit("-"), F.lit(" "))), link, label, crumb, U.section_by_path(url))
