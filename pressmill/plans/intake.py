"""Adapter intake: outputs of foreign collectors to gated records."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.operators import gate as G
from pressmill.operators.dedupe import top_n
from pressmill.sources.delimited import read_sniffed
from pressmill.sources.files import latest_by_alias

# Fixed value: rows of every source taken in test mode.
TEST_ROWS = 20


def intake(spark, files: DataFrame, patterns: DataFrame, scraping_date: str, since=None, test_mode=False) -> DataFrame:
    """Newest file of every source, read whatever its separator, completed and judged.

    Returns all records with ``_discard_reason`` (null for accepted ones)."""
    chosen = latest_by_alias(files, patterns, since)
    picks = chosen.select("source", "path", "file").collect()  # one row per source
    if not picks:
        raise ValueError("no output file of any source")
    rows = read_sniffed(spark, [p["path"] for p in picks], required=["url"])
    named = rows.drop("source").join(F.broadcast(chosen.select("source", "file")), "file")
    if test_mode:
        named = top_n(named, ["source"], ["file", "seq"], TEST_ROWS).drop("_rn")
    completed = G.complete_schema(named)
    return G.judge(G.enrich(completed, scraping_date))


def select_sources(catalog: DataFrame, wanted: DataFrame) -> DataFrame:
    """Wanted names with ``known``: unknown ones are reported, not dropped."""
    return wanted.join(catalog.select("source").distinct().withColumn("_hit", F.lit(True)), "source", "left") \
        .select("source", F.coalesce("_hit", F.lit(False)).alias("known"))


def coverage_gap(files: DataFrame, catalog: DataFrame) -> DataFrame:
    """Sources with files but no catalogue entry."""
    return files.select("source").distinct().join(catalog.select("source"), "source", "left_anti")


def all_sources(*catalogs) -> DataFrame:
    out = catalogs[0].select("source")
    for c in catalogs[1:]:
        out = out.union(c.select("source"))
    return out.distinct()
