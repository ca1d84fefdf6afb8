"""Small descriptive reports over articles, links and texts."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressmill.operators.dedupe import top_n


def section_counts(df: DataFrame) -> DataFrame:
    return df.where("section is not null").groupBy("section").agg(F.count("*").alias("articles")) \
        .orderBy(F.desc("articles"), "section")


def text_length_stats(df: DataFrame) -> DataFrame:
    """Mean, smallest and largest text length and the number of sections, per source."""
    n = F.length("full_text")
    return df.groupBy("source").agg(
        F.count("*").alias("articles"), F.round(F.sum(n) / F.count(n), 4).alias("mean_length"),
        F.min(n).alias("min_length"), F.max(n).alias("max_length"),
        F.count_distinct("section").alias("sections"))


def undated_report(df: DataFrame, tokens, examples: int = 10, order=("seq",)) -> DataFrame:
    """Per source: number of articles without a date and the first few addresses."""
    date = F.col("publication_date")
    undated = df.where(date.isNull() | date.isin(list(tokens)))
    counts = undated.groupBy("source").agg(F.count("*").alias("undated"))
    first = top_n(undated.where("url is not null").select("source", "url", *order), ["source"], list(order), examples)
    shown = first.groupBy("source").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("_rn", "url"))), lambda s: s["url"]), " ").alias("first_urls"))
    return counts.join(shown, "source", "left")


def head(df: DataFrame, order, n: int) -> DataFrame:
    """The first ``n`` rows (test mode of a collector): per-task cut, then one merge."""
    return df.orderBy(*order).limit(n)


def section_link_growth(links: DataFrame) -> DataFrame:
    """Per section: links found, links not seen in an earlier place, distinct links so far.

    ``links`` has section_seq, seq and url; the running total runs over one row per section.
    """
    first = links.groupBy("url").agg(F.min(F.struct("section_seq", "seq")).alias("at"))
    fresh = first.groupBy(F.col("at.section_seq").alias("section_seq")).agg(F.count("*").alias("new_links"))
    found = links.groupBy("section_seq").agg(F.count("*").alias("found"))
    so_far = Window.orderBy("section_seq").rowsBetween(Window.unboundedPreceding, 0)
    new = F.coalesce(F.col("new_links"), F.lit(0)).cast("long")
    return found.join(fresh, "section_seq", "left").withColumn("new_links", new) \
        .withColumn("unique_so_far", F.sum("new_links").over(so_far))


def first_section(links: DataFrame) -> DataFrame:
    """Section under which each link was met first; ``general`` where it had none."""
    met = links.groupBy("url").agg(F.min_by("section", F.struct("section_seq", "seq")).alias("section"))
    return met.withColumn("section", F.coalesce(F.nullif("section", F.lit("")), F.lit("general")))


def merge_links(links: DataFrame, articles: DataFrame) -> DataFrame:
    """Article fields where the page gave them, else what the listing said.

    ``links`` must hold every URL once (see ``first_section`` and ``keep_first``).
    """
    given = lambda c: F.nullif(F.col(c), F.lit(""))
    listed = links.select("url", *[F.col(c).alias(f"_{c}") for c in ("title", "section", "publication_date")])
    return listed.join(articles, "url").select("url", *[
        F.coalesce(given(c), given(f"_{c}")).alias(c) for c in ("title", "section", "publication_date")],
        "full_text")
