"""File states, key runs, whole jobs and their plans."""

import gzip

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressmill.operators import runs as R
from pressmill.plans import jobs as J
from pressmill.plans.held import HeldKeys, distinct, newest
from pressmill.schema import ARTICLE_COLUMNS
from pressmill.sources import delimited as D
from pressmill.sources import sinks as W
from pressmill.sources import status as ST

HEAD = "|".join(ARTICLE_COLUMNS)


def row(n, source="a", text=None):
    cells = {"source": source, "url": f"https://x/{n}", "title": f"t{n}", "full_text": "texto" if text is None else text}
    return "|".join(cells.get(c, "x") for c in ARTICLE_COLUMNS)


@pytest.fixture
def landed(tmp_path):
    whole = "\n".join([HEAD, row(1), row(2), row(2), row(3, text="")]) + "\n"
    packed = gzip.compress("\n".join([HEAD, row(4), row(5)]).encode())
    files = {
        "whole.csv": whole.encode(), "bom.csv": b"\xef\xbb\xbf" + "\n".join([HEAD, row(6)]).encode(), "packed.csv.gz": packed,
        "broken.csv.gz": packed[:-9], "garbled.csv.gz": packed[:20] + b"\x00\xff" + packed[22:], "latin.csv": (HEAD + "\n" + row("ñ")).encode("latin-1"),
        "late.csv": (HEAD + "\n" + row(7) * 300_000).encode() + b"\xff\xfe", "empty.csv": b"", "blank.csv": b"\n\n", "other.csv": b"a,b\n1,2\n",
        "comma.csv": (HEAD.replace("|", ",") + "\n" + row(8).replace("|", ",")).encode()}
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    return str(tmp_path)


def test_status_of_files(spark, landed):
    got = {r["file"]: r["problem"] for r in ST.file_status(spark, landed).collect()}
    assert got == {"whole.csv": None, "bom.csv": None, "packed.csv.gz": None, "comma.csv": None, "broken.csv.gz": "broken archive",
                   "garbled.csv.gz": "broken archive", "latin.csv": "encoding", "late.csv": "encoding", "blank.csv": "empty",
                   "other.csv": "columns"}
    assert ST.file_status(spark, landed).transform(ST.counts).first()[:] == (4, 6)
    rows = D.read_sniffed(spark, landed)
    assert sorted(r["url"] for r in rows.collect()) == sorted(f"https://x/{n}" for n in (1, 2, 2, 3, 4, 5, 6, 8))
    totals = {r["file"]: r["rows"] for r in D.row_totals(spark, landed).collect()}
    assert totals["whole.csv"] == 4 and totals["packed.csv.gz"] == 2 and totals["other.csv"] == 1 and totals["broken.csv.gz"] is None


def test_gzip_of_several_members():
    two = gzip.compress(b"a|b\n") + gzip.compress("é".encode())
    assert ST.examine(two) == (None, "a|b") and ST.examine(two[:-1])[0] == ST.BROKEN and ST.examine(None) == (ST.EMPTY, None)


def test_build_update_repair(spark, landed, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("corpus"))
    built = J.build_run(spark, landed, root, "20240601").first()
    assert built[:] == (4, 6, 8, 1, 6, 1, "20240601", 1)
    assert W.read_latest(spark, root).count() == 6
    states = spark.read.parquet(f"{root}/manifest/dt=20240601/v=1")
    assert states.where("problem is not null").count() == 6
    same = J.update_run(spark, landed, root, "20240602").first()
    # the text of one address is empty: a build drops it, an update takes every unseen address
    assert (same["new_rows"], same["before"], same["after"], same["duplicates"], same["v"]) == (1, 6, 7, 7, 1)
    again = J.update_run(spark, landed, root, "20240603").first()
    assert (again["new_rows"], again["before"], again["after"], again["v"]) == (0, 7, 7, None)
    assert W.versions(spark, root).count() == 2
    nothing = str(tmp_path_factory.mktemp("bad"))
    (tmp_path_factory.getbasetemp() / "x").mkdir(exist_ok=True)
    with open(f"{nothing}/x.csv", "wb") as f:
        f.write(b"\n")
    assert J.build_run(spark, nothing, root, "20240604").first()["v"] is None
    fixed = J.repair_run(spark, W.read_latest(spark, root).withColumns({"file": F.lit("f"), "seq": F.monotonically_increasing_id()}),
                         f"{nothing}/out", "2024-06-15 12:00:00").first()
    assert fixed["rows_read"] == 7 and fixed["rows_written"] == 7 and len(fixed["left"]) == fixed["issues_after"]
    assert not any(k.startswith(("html", "duplicate")) for k in fixed["left"])


def test_a_build_reads_the_files_once(spark, landed):
    files = ST.file_status(spark, landed)
    plan = D.read_listed(spark, ST.readable(files))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 2  # one per separator


@pytest.mark.parametrize("fan", [2, 8])
def test_key_runs_stay_few(spark, tmp_path, fan):
    schema = T.StructType([T.StructField("k", T.StringType())])
    keys = HeldKeys(spark, str(tmp_path), schema, "k", distinct, buckets=4, fan=fan)
    most = 0
    for batch in range(2 * fan + 1):
        held = {r["k"] for r in keys.read(batch).collect()}
        assert held == {f"k{i}" for i in range(batch)} | ({None} if batch else set())
        fresh = spark.createDataFrame([(f"k{batch}",), (None,)], schema)
        keys.add(batch, fresh)
        keys.add(batch, fresh)  # a repeated batch
        most = max(most, len(keys.runs(batch)))
    assert most <= 2 * fan
    some = keys.read(2 * fan, spark.createDataFrame([("k1",)], schema)).count()
    assert some <= 2 * fan + 1
    assert all(len(keys.runs(n)) <= (keys.fan - 1) * 7 for n in range(100))
    for n in range(60):
        covered = sorted(b for level, start in keys.runs(n) for b in range(start, start + fan ** level))
        assert covered == list(range(n))


def test_newest_time_of_a_key(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("t", T.IntegerType())])
    keys = HeldKeys(spark, str(tmp_path), schema, "k", newest("k", "t"), buckets=2, fan=2)
    for batch, t in enumerate([5, 9, 7]):
        keys.add(batch, spark.createDataFrame([("a", t)], schema))
    assert keys.read(3).collect()[0]["t"] == 9


def test_one_source_in_one_hour_spreads(spark):
    n = 4000
    runs = spark.range(n).select(
        F.col("id"), F.lit("hot").alias("source"), F.lit("2024-01-01 10:00:00").cast("timestamp_ntz").alias("run_ts"),
        F.when(F.col("id") % 5 == 0, "ERROR").otherwise("OK").alias("status"), (F.col("id") % 90).cast("int").alias("total_valid"))
    got = R._positions(runs.repartition(7))
    rows = sorted((r["id"], r["n_all"], r["n_ok"]) for r in got.collect())
    assert rows == [(i, i + 1, i + 1 - (i // 5 + 1)) for i in range(n)]
    few = R.tail(runs).collect()
    assert len({r["id"] for r in few}) == len(few) == 10 and max(r["id"] for r in few) == n - 1


def test_reports(spark):
    rows = [(1, "a", "2024-01-01 10:00:00", "OK", 5, 1, 2.0, True, None, "warning", "caída"), (2, "b", "2024-01-01 11:00:00", "ERROR", 0, 0, 1.0, True, "HTTP 403", None, None),
            (3, "a", "2024-01-02 10:00:00", "OK", 5, 1, 2.0, True, None, "ok", "normal")]
    df = spark.createDataFrame(rows, "id long, source string, ts string, status string, total_valid int, total_discarded int, duration_s double, health_ok boolean, "
                                     "error_msg string, level string, reason string")
    df = df.withColumn("run_ts", F.col("ts").cast("timestamp_ntz")).withColumn("run_date", F.col("run_ts").cast("date"))
    import json

    got = {r["execution_date"]: r for r in (json.loads(x["report"]) for x in R.daily_report(df).collect())}
    assert got["2024-01-01"]["totals"] == {"ok": 1, "errors": 1, "skipped_health": 0, "anomalies": 1}
    assert [x.get("error_type") for x in got["2024-01-01"]["results"]] == [None, "BLOQUEADO"] and got["2024-01-02"]["scrapers_run"] == 1


def test_daily_export_replaces_its_own_folders(spark, tmp_path):
    rows = spark.createDataFrame([[c if c != "source" else s for c in ARTICLE_COLUMNS] for s in ("a", "b")], ",".join(f"{c} string" for c in ARTICLE_COLUMNS))
    W.write_daily(rows, str(tmp_path), "20240601")
    W.write_daily(rows.where("source = 'a'"), str(tmp_path), "20240601")
    assert sorted(p.name for p in (tmp_path / "dt=20240601").iterdir()) == ["of_source=a", "of_source=b"]
    assert D.read_strict(spark, f"{tmp_path}/dt=*/of_source=*").count() == 2
