"""CMS posts and JSON article files."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressmill.functions.dates import iso_wall_clock
from pressmill.functions.html import markup_to_text
from pressmill.functions.text import clean_line, clean_strict
from pressmill.schema import ARTICLE_AUTHOR, ARTICLE_COLUMNS, CATEGORY, POST

# Defaults of CMS records.
DEFAULT_SECTION = "Noticias"
UNDATED = "N/A"
# Elements and link targets left out of a post body.
DROPPED = ["figure", "noscript"]
SHARE_HOSTS = ["whatsapp", "facebook"]


def read_posts(spark, paths) -> DataFrame:
    """Landed pages of posts: each file holds one JSON array, read by one task (a collector's page is 20 or 100 posts). Columns
    that folder names stand for come along."""
    return spark.read.schema(POST).option("multiLine", True).json(paths)


def read_categories(spark, paths) -> DataFrame:
    return spark.read.schema(CATEGORY).option("multiLine", True).json(paths)


def read_articles(spark, paths) -> DataFrame:
    """JSON article exports (one array per file), with or without author."""
    return spark.read.schema(ARTICLE_AUTHOR).option("multiLine", True).json(paths)


def category_ids(categories: DataFrame) -> DataFrame:
    """The id of every category slug; of categories with one slug the first id holds."""
    return categories.where("slug is not null").groupBy("slug").agg(F.min("id").alias("id"))


def write_pages(df: DataFrame, path: str, number, record, by=(), size=100):
    """JSON arrays of at most ``size`` records (the JSON text ``record``) in the order of ``number`` (unique whole numbers), as a
    collector lands its pages: one file a page, and a folder for every ``by`` group. Records are paged within ranges of (group,
    number), so pages are full but for the last ones of a range, however thinly a group's numbers lie."""
    paged = df.select(*by, F.struct(F.col(number).alias("n"), record.alias("json")).alias("r")).repartitionByRange(*by, "r.n")
    paged = paged.withColumn("_range", F.spark_partition_id())
    place = F.row_number().over(Window.partitionBy(*by, "_range").orderBy("r.n"))
    pages = paged.withColumn("_page", F.floor((place - 1) / size)).groupBy(*by, "_range", "_page").agg(F.sort_array(F.collect_list("r")).alias("all"))
    text = F.concat(F.lit("["), F.array_join(F.transform("all", lambda x: x["json"]), ",\n"), F.lit("]")).alias("value")
    # files of one group lie in its folder; which page is in which file does not matter to a reader
    pages.select(*by, text).write.partitionBy(*by).option("maxRecordsPerFile", 1).text(path)


def parse_posts(df: DataFrame, column: str) -> DataFrame:
    """Posts held as JSON text in a column; ``POST`` fields at top level."""
    return df.withColumn("_p", F.from_json(column, POST)).select(*[c for c in df.columns if c != column], "_p.*")


def post_text(c):
    """Body text without pictures and share links."""
    c = F.regexp_replace(c, r"(?is)<img\s[^>]*>", "")
    for tag in DROPPED:
        c = F.regexp_replace(c, rf"(?is)<{tag}(?:\s[^>]*)?>.*?</{tag}\s*>", "")
    hosts = "|".join(SHARE_HOSTS)
    c = F.regexp_replace(c, rf'(?is)<a\s[^>]*href="[^"]*(?:{hosts})[^"]*"[^>]*>.*?</a\s*>', "")
    return clean_line(markup_to_text(c))


def to_articles(posts: DataFrame, categories: DataFrame, source, scraping_date: str) -> DataFrame:
    """Posts to records. ``categories`` is the site's id-name dictionary (a few hundred rows); a post without known category is filed under the default section."""
    names = categories.groupBy(F.col("id").alias("_cid")).agg(F.min("name").alias("_name"))
    first = posts.withColumn("_first", F.try_element_at("categories", F.lit(1)))
    joined = first.join(names, F.col("_first") == F.col("_cid"), "left")
    given = F.nullif(F.col("date"), F.lit(""))
    texts = F.struct(clean_strict(F.col("title.rendered")).alias("title"),
                     clean_strict(F.col("content.rendered")).alias("full_text"))
    # a generator keeps the non-empty ones: a filter would be pushed down and clean twice
    kept = F.filter(F.array(texts), lambda t: (t["title"] != "") | (t["full_text"] != ""))
    return joined.select(
        "id", source.alias("source"), F.coalesce("link", F.lit("")).alias("url"),
        # an unreadable date is null; the missing-date text is used only where none was given
        F.when(given.isNull(), F.lit(UNDATED)).otherwise(iso_wall_clock(given)).alias("publication_date"),
        F.lit(scraping_date).alias("scraping_date"),
        clean_strict(F.coalesce("_name", F.lit(DEFAULT_SECTION))).alias("section"),
        F.lit("es").alias("language"), F.inline(kept))


def to_sectioned_articles(posts: DataFrame, site: str, section, source: str, scraping_date: str) -> DataFrame:
    """Posts of one section: address composed of site, section and slug; day-only dates."""
    given = F.nullif(F.col("date"), F.lit(""))
    return posts.select(
        "id", F.lit(source).alias("source"),
        F.concat_ws("/", F.lit(site), section, F.coalesce("slug", F.lit(""))).alias("url"),
        post_text(F.coalesce("title.rendered", F.lit("Sin titulo"))).alias("title"),
        F.coalesce(F.substring(given, 1, 10), F.lit("Sin fecha")).alias("publication_date"),
        F.lit(scraping_date).alias("scraping_date"), section.alias("section"),
        post_text(F.coalesce("content.rendered", F.lit(""))).alias("full_text"), F.lit("es").alias("language"))


def write_articles(df: DataFrame, path: str, columns=ARTICLE_COLUMNS):
    """JSON export, one object per line and file part; nulls kept as JSON nulls."""
    df.select(*columns).write.option("ignoreNullFields", False).mode("errorifexists").json(path)
