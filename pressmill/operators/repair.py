"""Repair of article records: dates, markup, sections, titles, repeats, nulls."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.functions.dates import exact_moment, normalize
from pressmill.functions.text import has_markup, strip, strip_markup
from pressmill.operators.dedupe import keep_first
from pressmill.schema import ARTICLE_COLUMNS, DEFAULT_SECTION, NULL_TEXT, UNTITLED_TOKENS

MARKUP_COLUMNS = ["title", "section", "full_text"]


def _untold(c):
    return c.isNull() | strip(c).isin(UNTITLED_TOKENS)


def mend(df: DataFrame, as_of: str) -> DataFrame:
    """Row-level repairs, with one flag column per counted event (``_`` prefix).

    ``as_of`` stands in for the present where a row has no scraping date of its own.
    """
    now = F.lit(as_of).cast("timestamp_ntz")
    scraped = normalize(F.col("scraping_date"), now)
    dated = df.withColumn("_scraped", scraped)
    reference = F.coalesce(exact_moment(F.col("_scraped")), now)
    dated = dated.withColumn("_published", normalize(F.col("publication_date"), reference))
    flags = {f"_html_{c}": F.coalesce(has_markup(F.col(c)), F.lit(False)) for c in MARKUP_COLUMNS}
    cleaned = dated.withColumns({
        **flags,
        "_no_date": F.col("_published").isNull() & F.col("_scraped").isNull(),
        "_date_fallback": F.col("_published").isNull() & F.col("_scraped").isNotNull(),
        "scraping_date": F.coalesce("_scraped", F.lit(NULL_TEXT)),
        "publication_date": F.coalesce("_published", "_scraped", F.lit(NULL_TEXT)),
        **{c: strip_markup(F.col(c)) for c in MARKUP_COLUMNS},
    })
    return cleaned.withColumns({
        "_section_filled": _untold(F.col("section")),
        "_untitled": _untold(F.col("title")),
        "section": F.when(_untold(F.col("section")), F.lit(DEFAULT_SECTION)).otherwise(F.col("section")),
    }).drop("_scraped", "_published")


def repair(df: DataFrame, as_of: str, order=("file", "seq")) -> DataFrame:
    """Repaired records: titled ones only, first of every URL, nulls written out."""
    titled = mend(df, as_of).where(~F.col("_untitled"))
    return keep_first(titled, ["url"], list(order)).select(*ARTICLE_COLUMNS).na.fill(NULL_TEXT)


def repair_stats(df: DataFrame, as_of: str) -> DataFrame:
    """Counts of every repair step, without moving article texts around.

    Rows are counted per URL first, so the second step sees one row per distinct URL.
    """
    mended = mend(df, as_of)
    count = lambda c: F.count_if(c).alias(c)
    flags = ["_no_date", "_date_fallback", "_html_title", "_html_section", "_html_full_text",
             "_section_filled", "_untitled"]
    per_url = mended.groupBy("url").agg(F.count("*").alias("rows"), *[count(c) for c in flags])
    titled = F.col("rows") - F.col("_untitled")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    final = F.count_if(titled > 0)
    return per_url.agg(
        total("rows").alias("initial"),
        total("_no_date").alias("pub_date_set_null"),
        total("_date_fallback").alias("pub_date_fallback_to_scraping"),
        total("_html_title").alias("html_title"),
        total("_html_section").alias("html_section"),
        total("_html_full_text").alias("html_full_text"),
        total("_section_filled").alias("section_filled"),
        total("_untitled").alias("dropped_no_title"),
        (total(titled) - final).alias("deduped"),
        final.alias("final"),
    )
