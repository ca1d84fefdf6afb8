"""Whole jobs: from landed files to what is written, with counts taken by the write itself.

Counts are observed on the way, so no row is read a second time to be counted. (Where an executor is lost, rows of tasks
that run again are observed again; what was written is not affected.) The state of every file goes beside the version, as
a table.
"""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pressmill.operators import quality as Q
from pressmill.operators import repair as R
from pressmill.operators.dedupe import keep_first
from pressmill.plans import corpus as C
from pressmill.schema import ARTICLE_COLUMNS
from pressmill.session import shared_folder
from pressmill.sources import delimited as D
from pressmill.sources import sinks as W
from pressmill.sources import status as ST

BUILT = "files_ok long, files_error long, total_raw long, duplicates long, total_final long, sources long, dt string, v int"
UPDATED = "files_ok long, files_error long, rows long, duplicates long, new_rows long, before long, after long, dt string, v int"
REPAIRED = "rows_read long, rows_written long, issues_before long, issues_after long, ok boolean, left map<string,long>"


def _rows(name):
    return Observation(name), F.count(F.lit(1)).alias("n")


def manifest(spark, paths, root: str, dt: str, v: int) -> DataFrame:
    """The state of every file, written as a table beside version ``v`` and read back."""
    path = f"{root.rstrip('/')}/manifest/dt={dt}/v={v}"
    ST.file_status(spark, paths).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def build_run(spark, paths, root: str, dt: str, order=("file", "seq")) -> DataFrame:
    """Files to a new corpus version: files that can be read, first of every URL, rows lacking text or URL dropped.

    One row: counts, day and number of the version (null, and no version, if no file can be read)."""
    v = W.next_version(W.versions(spark, root), dt)
    files = manifest(spark, paths, root, dt, v)
    ok, error = files.transform(ST.counts).first()
    if not ok:
        return spark.createDataFrame([(0, error, 0, 0, 0, 0, dt, None)], BUILT)
    (read, count), (first, _), (kept, _) = _rows("read"), _rows("first"), _rows("kept")
    rows = D.read_listed(spark, ST.readable(files)).observe(read, count)
    firsts = keep_first(rows, ["url"], list(order)).observe(first, count)
    whole = firsts.where(C.has_value("full_text") & C.has_value("url"))
    path = W.write_version(whole.observe(kept, count), root, dt, v)
    sources = spark.read.parquet(path).agg(F.count_distinct("source")).first()[0]  # one narrow column of the result
    n = read.get["n"]
    return spark.createDataFrame([(ok, error, n, n - first.get["n"], kept.get["n"], sources, dt, v)], BUILT)


def update_run(spark, paths, root: str, dt: str, order=("file", "seq")) -> DataFrame:
    """The latest version and the unseen URLs of the files as a new version; nothing new, no version.

    The files are read once; the rows that an update adds are settled before the version is begun, and articles already
    held are moved only if there is a version to write."""
    held = W.read_latest(spark, root)
    v = W.next_version(W.versions(spark, root), dt)
    files = manifest(spark, paths, root, dt, v)
    ok, error = files.transform(ST.counts).first()
    before = held.count()
    if not ok:
        return spark.createDataFrame([(0, error, 0, 0, 0, before, before, dt, None)], UPDATED)
    (read, count), (added, _) = _rows("read"), _rows("added")
    base = shared_folder(spark)
    D.read_listed(spark, ST.readable(files)).observe(read, count).write.parquet(f"{base}/batch")
    batch = spark.read.parquet(f"{base}/batch")
    C.additions(held.select("url"), batch, order).observe(added, count).write.parquet(f"{base}/fresh")
    n, new = read.get["n"], added.get["n"]
    repeats = n - C.arrivals(held.select("url"), batch.select("url")).count()
    if new:
        fresh = spark.read.parquet(f"{base}/fresh")
        W.write_version(held.unionByName(fresh, allowMissingColumns=True), root, dt, v)
    return spark.createDataFrame([(ok, error, n, repeats, new, before, before + new, dt, v if new else None)], UPDATED)


def repair_run(spark, rows: DataFrame, out: str, as_of: str) -> DataFrame:
    """Repaired records written as delimited files below ``out``, then read back strictly and validated.

    One row: rows read and written, number of issues before and after, whether what was written is clean, and the rows of
    each issue that is left (dates that were not to be had stay ``NULL``, short texts stay short)."""
    (read, count), (written, _) = _rows("read"), _rows("written")
    mended = R.repair(rows.observe(read, count), as_of).observe(written, count)
    W.write_delimited(mended, out)
    after = D.read_strict(spark, out, ARTICLE_COLUMNS).withColumn("file", F.lit(out))
    left = {f"{r['type']}:{r['value']}": r["count"] for r in Q.issues(after).select("type", "value", "count").collect()}  # a handful
    found = Q.issues(rows).agg(F.count("*")).first()[0]
    return spark.createDataFrame([(read.get["n"], written.get["n"], found, len(left), not left, left)], REPAIRED)
