"""Record types and fixed token lists shared by every module."""

from pyspark.sql import types as T

# The article record, in export order.
ARTICLE_COLUMNS = [
    "source", "url", "title", "publication_date",
    "scraping_date", "section", "full_text", "language",
]
AUTHOR_COLUMNS = ARTICLE_COLUMNS[:3] + ["author"] + ARTICLE_COLUMNS[3:]
DISCARD_COLUMNS = ARTICLE_COLUMNS + ["_discard_reason"]
MINIMUM_COLUMNS = ["source", "url", "full_text"]

# Text rules of the record contract.
MIN_TEXT_LENGTH = 300
DATE_FORMAT = "%Y-%m-%d %H:%M:%S"
NULL_TEXT = "NULL"
UNTITLED_TOKENS = ["", "None", "nan"]
UNDATED_TOKENS = ["", "NULL", "None", "nan", "NaT", "Sin fecha"]
STRIP_EXEMPT_TOKENS = ["NULL", "None", "nan"]
DATE_SENTINELS = ["Sin fecha", "Error", ""]
DEFAULT_SECTION = "Sin seccion"
# Tokens the tolerant reader takes as null (the usual data-frame defaults).
TOLERANT_NULLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]


def _strings(names):
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


ARTICLE = _strings(ARTICLE_COLUMNS)
ARTICLE_AUTHOR = _strings(AUTHOR_COLUMNS)
DISCARD = _strings(DISCARD_COLUMNS)
LINK = T.StructType([
    T.StructField("section_seq", T.IntegerType()),
    T.StructField("seq", T.IntegerType()),
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("section", T.StringType()),
    T.StructField("publication_date", T.StringType()),
])
_RENDERED = T.StructType([T.StructField("rendered", T.StringType())])
POST = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("date", T.StringType()),
    T.StructField("link", T.StringType()),
    T.StructField("slug", T.StringType()),
    T.StructField("title", _RENDERED),
    T.StructField("content", _RENDERED),
    T.StructField("categories", T.ArrayType(T.LongType())),
])
CATEGORY = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("slug", T.StringType()),
])
EXECUTION = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("run_date", T.DateType()),
    T.StructField("run_ts", T.TimestampNTZType()),
    T.StructField("status", T.StringType()),
    T.StructField("total_valid", T.IntegerType()),
    T.StructField("total_discarded", T.IntegerType()),
    T.StructField("duration_s", T.DoubleType()),
    T.StructField("health_ok", T.BooleanType()),
    T.StructField("error_msg", T.StringType()),
    T.StructField("notes", T.StringType()),
])
PROBE = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("duration_s", T.DoubleType()),
    T.StructField("exception", T.StringType()),
])
ISSUE_COLUMNS = ["file", "type", "value", "count", "details"]
