"""Writing: delimited exports, discard logs, run history, reports and corpus versions."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.schema import ARTICLE_COLUMNS, DISCARD_COLUMNS, NULL_TEXT


def write_delimited(df: DataFrame, path: str, columns=ARTICLE_COLUMNS, sep="|", by=(), mode="errorifexists", header=True, **options):
    """Fixed columns, further ones dropped, nulls as ``NULL``; ``by`` columns become folders."""
    df.select(*columns, *[c for c in by if c not in columns]).write.mode(mode).partitionBy(*by).options(
        sep=sep, header=header, quote='"', escape='"', nullValue=NULL_TEXT, emptyValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, **options).csv(path)


def write_daily(df: DataFrame, root: str, dt: str, columns=ARTICLE_COLUMNS):
    """One folder per day and source (``dt=yyyymmdd/of_source=...``); a source written again replaces its own of the day."""
    rows = df.select(*columns, F.lit(dt).alias("dt"), F.col("source").alias("of_source"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt", "of_source").options(
        sep="|", header=True, quote='"', escape='"', nullValue=NULL_TEXT, emptyValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(root.rstrip("/"))


def write_discards(judged: DataFrame, path: str, dt: str):
    """Discard log, a folder per day and source: a source written again replaces its own folder of the
    day and no other; sources without discards write nothing."""
    rows = judged.where("_discard_reason is not null").select(*DISCARD_COLUMNS, F.lit(dt).alias("dt"), F.col("source").alias("of_source"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt", "of_source").parquet(path.rstrip("/"))


def append_runs(runs: DataFrame, path: str):
    runs.write.mode("append").partitionBy("run_date").parquet(path)


def read_runs(spark, path) -> DataFrame:
    return spark.read.parquet(path)


def write_reports(reports: DataFrame, path: str):
    """One JSON text per line (``report`` column)."""
    reports.select("report").write.mode("errorifexists").text(path)


# --- corpus versions: <root>/dt=yyyymmdd/v=n, listed in <root>/finished --------------------

VERSION = "dt string, v int"


def versions(spark, root) -> DataFrame:
    """Finished versions below ``root``: dt, v. A version is listed after its last row is
    written, so half-written ones never show."""
    try:
        return spark.read.schema(VERSION).parquet(f"{root.rstrip('/')}/finished")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], VERSION)


def next_versions(known: DataFrame) -> DataFrame:
    """Next version number of every date."""
    return known.groupBy("dt").agg((F.max("v") + 1).alias("next_v"))


def next_version(known: DataFrame, dt: str) -> int:
    return known.where(F.col("dt") == dt).agg(F.coalesce(F.max("v"), F.lit(0)) + 1).first()[0]


def latest_version(known: DataFrame) -> DataFrame:
    """Newest version: by date, then number (so 10 comes after 9)."""
    return known.agg(F.max(F.struct("dt", "v")).alias("x")).where("x is not null").select("x.*")


def version_path(root, dt, v):
    return f"{root.rstrip('/')}/dt={dt}/v={v}"


def read_latest(spark, root) -> DataFrame:
    top = latest_version(versions(spark, root)).first()
    if top is None:
        raise ValueError(f"no corpus version below {root}")
    return spark.read.parquet(version_path(root, top["dt"], top["v"]))


def write_version(df: DataFrame, root: str, dt: str, v: int) -> str:
    """Write a version and list it. Finished versions are never replaced; the remains of an
    attempt that died before being listed are."""
    spark, path = df.sparkSession, version_path(root, dt, v)
    if versions(spark, root).where((F.col("dt") == dt) & (F.col("v") == v)).limit(1).count():
        raise FileExistsError(path)
    df.write.mode("overwrite").parquet(path)
    spark.createDataFrame([(dt, v)], VERSION).coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/finished")
    return path
