"""Intake gate: enrich, check and de-duplicate raw article records."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.operators.dedupe import keep_first, mark_first
from pressmill.schema import ARTICLE_COLUMNS, MIN_TEXT_LENGTH, NULL_TEXT

# Reason texts of the discard log.
DUPLICATE_REASON = "URL duplicada"


def enrich(df: DataFrame, scraping_date: str, source: str = None, detector=None) -> DataFrame:
    """Set source and scraping date, and the language where none is given.

    ``detector`` maps the text column to a language column; rows without text (or a job
    without detector) get ``es``.
    """
    given = F.nullif(F.col("language"), F.lit(""))
    text = F.nullif(F.col("full_text"), F.lit(""))
    guess = F.lit(None).cast("string") if detector is None else F.when(
        given.isNull() & text.isNotNull(), detector(text))
    columns = {
        "scraping_date": F.lit(scraping_date),
        "language": F.coalesce(given, guess, F.lit("es")),
    }
    if source is not None:
        columns["source"] = F.lit(source)
    return df.withColumns(columns)


def reject_reason(null_dates=()):
    """Reason column; null means the record passes. ``null_dates`` lists texts that should
    count as a missing date too (none by default)."""
    date = F.col("publication_date")
    if null_dates:
        date = F.when(~date.isin(list(null_dates)), date)
    text = F.col("full_text")
    return (
        F.when(date.isNull() | (date == ""), F.lit("Campo obligatorio nulo: publication_date"))
        .when(text.isNull() | (text == ""), F.lit("Campo obligatorio vacío: full_text"))
        .when(F.length(text) < MIN_TEXT_LENGTH, F.concat(
            F.lit("full_text demasiado corto ("), F.length(text).cast("string"),
            F.lit(f" chars < {MIN_TEXT_LENGTH})")))
    )


def judge(df: DataFrame, order=("file", "seq"), null_dates=()) -> DataFrame:
    """All records with ``_discard_reason``; repeats are searched among the passing records of a source."""
    checked = df.withColumn("_discard_reason", reject_reason(null_dates))
    passing = F.col("_discard_reason").isNull()
    marked = mark_first(checked, ["source", "url"], list(order), flag="_first", among=passing)
    reason = F.when(passing & ~F.col("_first"), F.lit(DUPLICATE_REASON)).otherwise(F.col("_discard_reason"))
    return marked.withColumn("_discard_reason", reason).drop("_first")


def accepted(df: DataFrame, order=("file", "seq"), null_dates=()) -> DataFrame:
    """Only the records that pass, first of every URL of a source: one shuffle and a single look at
    ``df`` where the discards are not wanted."""
    return keep_first(df.where(reject_reason(null_dates).isNull()), ["source", "url"], list(order))


def valid(judged: DataFrame) -> DataFrame:
    return judged.where("_discard_reason is null").drop("_discard_reason")


def discarded(judged: DataFrame) -> DataFrame:
    return judged.where("_discard_reason is not null")


def summary(judged: DataFrame) -> DataFrame:
    """Raw, valid and discarded totals per source."""
    return judged.groupBy("source").agg(
        F.count("*").alias("total_raw"),
        F.count_if(F.col("_discard_reason").isNull()).alias("total_valid"),
        F.count_if(F.col("_discard_reason").isNotNull()).alias("total_discarded"),
    )


def complete_schema(df: DataFrame, columns=ARTICLE_COLUMNS) -> DataFrame:
    """Missing columns and nulls become the text ``NULL``; further columns stay, filled too."""
    missing = {c: F.lit(NULL_TEXT) for c in columns if c not in df.columns}
    return df.withColumns(missing).na.fill(NULL_TEXT)


def sentinel_filter(df: DataFrame, sentinels, minimum=MIN_TEXT_LENGTH) -> DataFrame:
    """Rows with enough text and a date that is not a placeholder (a null date stays)."""
    dated = F.col("publication_date").isNull() | ~F.col("publication_date").isin(list(sentinels))
    return df.where((F.length("full_text") >= minimum) & dated)


def on_or_after(df: DataFrame, cutoff: str, column="publication_date") -> DataFrame:
    """Dated rows from ``cutoff`` on, plus all undated ones."""
    return in_range(df, cutoff, None, column)


def in_range(df: DataFrame, first=None, last=None, column="publication_date") -> DataFrame:
    """Dated rows within the inclusive range (either end open), plus all undated ones."""
    day = F.nullif(F.substring(F.col(column), 1, 10), F.lit(""))
    inside = day.between(F.lit(first or "0000-00-00"), F.lit(last or "9999-99-99"))
    return df.where(F.coalesce(inside, F.lit(True)))
