"""Data-quality checks over article files, all files in one pass."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.functions.dates import exact_moment
from pressmill.functions.text import has_markup, is_blank
from pressmill.operators.dedupe import top_n
from pressmill.schema import ARTICLE_COLUMNS, DATE_FORMAT, ISSUE_COLUMNS, MIN_TEXT_LENGTH

DATE_COLUMNS = ["publication_date", "scraping_date"]
MARKUP_COLUMNS = ["title", "section", "full_text"]
EXAMPLES = 5


def _as_text(name):
    # a null prints as the text None, which is neither a date nor long enough
    return F.coalesce(F.col(name), F.lit("None"))


def _bad_date(name):
    text = _as_text(name)
    return (text != "") & exact_moment(text).isNull()


def _counters():
    out = {("missing_value", c): F.col(c).isNull() | is_blank(F.col(c)) for c in ARTICLE_COLUMNS}
    out.update({("invalid_date_format", c): _bad_date(c) for c in DATE_COLUMNS})
    out.update({("html_detected", c): has_markup(_as_text(c)) for c in MARKUP_COLUMNS})
    out[("short_full_text", "full_text")] = F.length(_as_text("full_text")) < MIN_TEXT_LENGTH
    return out


def _details(kind, column, count, examples=None):
    n = count.cast("string")
    if kind == "missing_value":
        return F.concat(n, F.lit(f" filas con valor nulo o vacio en '{column}'"))
    if kind == "duplicate_url":
        return F.concat(n, F.lit(" filas duplicadas en columna 'url'"))
    if kind == "invalid_date_format":
        return F.concat(n, F.lit(f" valores no siguen el formato {DATE_FORMAT}; ejemplos: "), examples)
    if kind == "html_detected":
        return F.concat(n, F.lit(f" filas contienen etiquetas HTML en '{column}'"))
    return F.concat(n, F.lit(f" filas con full_text menor a {MIN_TEXT_LENGTH} caracteres"))


def bad_date_examples(df: DataFrame) -> DataFrame:
    """First few distinct wrong date texts per file and column, in order of appearance."""
    long = df.select("file", "seq", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), _as_text(c).alias("value"), _bad_date(c).alias("bad"))
        for c in DATE_COLUMNS])).alias("d")).where("d.bad")
    seen = long.groupBy("file", F.col("d.column").alias("column"), F.col("d.value").alias("value")) \
        .agg(F.min("seq").alias("at"))
    first = top_n(seen, ["file", "column"], ["at", "value"], EXAMPLES)
    return first.groupBy("file", "column").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("at", "value"))),
        lambda s: F.concat(F.lit("'"), s["value"], F.lit("'"))), ", ").alias("shown"))


def file_counts(df: DataFrame) -> DataFrame:
    """One row per file with its rows, every counter of the checks, and how many rows share their URL with another one
    (nulls are equal). One pass: counters are added up per URL on the way to the file, a hot URL in each task first."""
    names = [f"{kind}__{col}" for kind, col in _counters()]
    per_url = df.groupBy("file", "url").agg(F.count("*").alias("n"), *[F.count_if(c).alias(n) for n, c in zip(names, _counters().values())])
    return per_url.groupBy("file").agg(
        F.sum("n").alias("rows"), *[F.sum(n).alias(n) for n in names],
        F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("dup_rows"))


def _listed(df: DataFrame) -> DataFrame:
    """Per file its rows and problems (type, value, count, details), from two passes: all counters, then the two date columns
    for examples."""
    wide = file_counts(df)
    entries = [
        F.struct(F.lit(kind).alias("type"), F.lit(col).alias("value"),
                 F.col(f"{kind}__{col}").alias("count"))
        for kind, col in _counters()
    ] + [F.struct(F.lit("duplicate_url").alias("type"), F.lit("url").alias("value"),
                  F.col("dup_rows").alias("count"))]
    shown = bad_date_examples(df).groupBy("file").agg(
        F.map_from_entries(F.collect_list(F.struct("column", F.concat(F.lit("["), "shown", F.lit("]"))))).alias("examples"))

    def worded(e):
        text = F.lit(None).cast("string")
        for kind, col in [*_counters(), ("duplicate_url", "url")]:
            said = _details(kind, col, e["count"], F.try_element_at("examples", F.lit(col)))
            text = F.when((e["type"] == kind) & (e["value"] == col), said).otherwise(text)
        return F.struct(e["type"].alias("type"), e["value"].alias("value"), e["count"].alias("count"), text.alias("details"))

    found = F.transform(F.filter(F.array(*entries), lambda e: e["count"] > 0), worded)
    return wide.join(shown, "file", "left").select("file", "rows", found.alias("issues"))


def issues(df: DataFrame) -> DataFrame:
    """Long list of problems: file, type, value, count, details."""
    return _listed(df).select("file", F.inline("issues")).select(*ISSUE_COLUMNS)


def file_level_issues(headers: DataFrame) -> DataFrame:
    """Problems that stop the row checks. ``headers``: file, columns (null if unreadable),
    present (whether the file exists)."""
    need = F.array(*[F.lit(c) for c in ARTICLE_COLUMNS])
    missing = F.array_except(need, F.col("columns"))
    names = F.array_join(missing, ", ")
    quoted = F.array_join(F.transform(missing, lambda m: F.concat(F.lit("'"), m, F.lit("'"))), ", ")
    issue = (
        F.when(~F.col("present"), F.struct(
            F.lit("missing_file").alias("type"), F.col("file").alias("value"),
            F.lit(1).cast("long").alias("count"), F.lit("El archivo no existe").alias("details")))
        .when(F.col("columns").isNull(), F.struct(
            F.lit("read_error").alias("type"), F.col("file").alias("value"),
            F.lit(1).cast("long").alias("count"), F.lit("No se pudo leer el CSV").alias("details")))
        .when(F.size(missing) > 0, F.struct(
            F.lit("missing_columns").alias("type"), names.alias("value"),
            F.size(missing).cast("long").alias("count"),
            F.concat(F.lit("Columnas obligatorias ausentes: ["), quoted, F.lit("]")).alias("details")))
    )
    return headers.select("file", issue.alias("i")).where("i is not null").select("file", "i.*")


def verdicts(df: DataFrame, columns: int = len(ARTICLE_COLUMNS)) -> DataFrame:
    """Per file: rows, columns, number of issues and whether the file is clean."""
    n = F.size("issues").cast("long")
    return _listed(df).select("file", "rows", F.lit(columns).alias("columns"), n.alias("issues"), (n == 0).alias("ok"))


def totals(verdicts_df: DataFrame) -> DataFrame:
    return verdicts_df.agg(
        F.count("*").alias("files"),
        F.count_if("ok").alias("valid"),
        F.count_if(~F.col("ok")).alias("invalid"))


def report_json(df: DataFrame) -> DataFrame:
    """One JSON text per file: verdict, counts and its issues (a handful per file)."""
    listed = F.array_sort("issues")
    return _listed(df).select("file", F.to_json(F.struct(
        "file", (F.size("issues") == 0).alias("ok"), listed.alias("issues"),
        F.struct("rows", F.lit(len(ARTICLE_COLUMNS)).alias("columns")).alias("counts"))).alias("report"))
