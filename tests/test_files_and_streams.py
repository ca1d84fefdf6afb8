import os

import pytest
from pyspark.sql import functions as F

from pressmill.functions import language as LA
from pressmill.operators import stats as ST
from pressmill.plans import intake as I
from pressmill.schema import ARTICLE_COLUMNS
from pressmill.sources import delimited as D
from pressmill.sources import files as FL
from pressmill.sources import posts as P
from pressmill.sources import sinks as W
from pressmill.streaming import feeds

HEAD = "|".join(ARTICLE_COLUMNS)
LONG = "palabra " * 50


def put(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def test_strict_and_tolerant_readers(spark, tmp_path):
    path = put(tmp_path, "s_20240601.csv", "﻿" + HEAD + "\n"
               's|u1|"a ""q"" | b\nc"|d|d|NULL||es\n' "s|u2|N/A\n" "s|u3|t|d|d|c|x|es|extra\n")
    soft = D.read_tolerant(spark, path).orderBy("seq").collect()
    assert [r["url"] for r in soft] == ["u1", "u2"]
    assert soft[0]["title"] == 'a "q" | b\nc' and soft[0]["section"] is None and soft[0]["full_text"] is None
    assert soft[1]["title"] is None and soft[1]["language"] is None
    good = put(tmp_path, "t_20240601.csv", HEAD + "\ns|u1|N/A|d|d|NULL||es\ns|u2|\n")
    hard = D.read_strict(spark, good).orderBy("seq").collect()
    assert hard[0]["title"] == "N/A" and hard[0]["section"] is None and hard[0]["full_text"] == ""
    assert hard[1]["title"] == "" and hard[1]["language"] is None
    with pytest.raises(Exception, match="too many fields"):
        D.read_strict(spark, path).collect()


def test_long_quoted_texts_and_counts(spark, tmp_path):
    text = 'a ""b"" | c\n' * 10_000
    path = put(tmp_path, "s_20240601.csv", f's|u1|"{text}"\ns|u2|t|d|d|c|"{text}"|es|more\ns|u3|t|d|d|c|x|es\n'.join([HEAD + "\n", ""]))
    rows = D.read_tolerant(spark, path).orderBy("seq").collect()
    assert [r["url"] for r in rows] == ["u1", "u3"] and len(rows[0]["title"]) == len(text.replace('""', '"'))
    assert D.read_tolerant(spark, path).count() == 2


@pytest.mark.parametrize("name", ["a b.csv", "[x]{y}*.csv", "ñandú+1%.csv"])
def test_odd_file_names(spark, tmp_path, name):
    put(tmp_path, name, HEAD + "\ns|u1|t|d|d|c|x|es\n")
    row = D.read_sniffed(spark, str(tmp_path)).first()
    assert (row["url"], row["file"]) == ("u1", name)


def test_discards_of_one_source_keep_the_others(spark, tmp_path):
    columns = ", ".join(f"{c} string" for c in [*ARTICLE_COLUMNS, "_discard_reason"])
    rows = lambda source, n: spark.createDataFrame([(source, *["x"] * (len(ARTICLE_COLUMNS) - 1), "r")] * n, columns)
    folder = str(tmp_path / "log")
    for source, n in (("a", 2), ("b", 3), ("a", 1), ("c", 0)):
        W.write_discards(rows(source, n), folder, "20240615")
    found = {r["of_source"]: r["count"] for r in spark.read.parquet(folder).groupBy("of_source").count().collect()}
    assert found == {"a": 1, "b": 3}


def test_sniffing_groups_by_header(spark, tmp_path):
    put(tmp_path, "a.csv", HEAD + "\ns|u1|t|d|d|c|x|es\n")
    put(tmp_path, "b.csv", "﻿source,url,title,author,full_text\ns,u2,\"t, t\",Ana,x\n")
    put(tmp_path, "c.csv", "nothing,here\n1,2\n")
    rows = {r["url"]: r for r in D.read_sniffed(spark, str(tmp_path)).collect()}
    assert set(rows) == {"u1", "u2"}
    assert rows["u2"]["author"] == "Ana" and rows["u2"]["title"] == "t, t" and rows["u1"]["author"] is None
    flags = {r["file"]: r["readable"] for r in D.readable(D.headers(spark, str(tmp_path))).collect()}
    assert flags == {"a.csv": True, "b.csv": True, "c.csv": False}


def test_discovery_and_intake(spark, tmp_path):
    put(tmp_path, "crc891.csv", "source,url,title,publication_date,full_text\n"
        + f"x,u1,t,2024-01-01,{LONG}\nx,u1,t,2024-01-01,{LONG}\nx,u2,t,,corto\n")
    put(tmp_path, "crc_89_1_20240601_backup.csv", HEAD + "\n")
    put(tmp_path, "otro_20240602_discarded.csv", HEAD + "\n")
    files = FL.listing(spark, str(tmp_path))
    assert FL.outputs(files).count() == 2
    assert [r["file"] for r in FL.of_day(files, "20240601").collect()] == []
    patterns = FL.alias_frame(spark, ["crc_89_1", "otro"])
    judged = I.intake(spark, files, patterns, "2024-06-15 12:00:00").orderBy("seq").collect()
    assert [r["source"] for r in judged] == ["crc_89_1"] * 3
    assert [r["_discard_reason"] for r in judged] == [None, "URL duplicada", "full_text demasiado corto (5 chars < 300)"]


def test_export_format(spark, tmp_path):
    df = spark.createDataFrame([("s", None, 'x "q" | y\nz', "")], "source string, url string, title string, section string")
    W.write_delimited(df.coalesce(1), str(tmp_path / "out"), columns=["source", "url", "title", "section"])
    part = next(p for p in (tmp_path / "out").iterdir() if p.name.endswith(".csv"))
    assert part.read_text() == 'source|url|title|section\ns|NULL|"x ""q"" | y\nz"|\n'


def test_versions(spark, tmp_path):
    root = str(tmp_path / "corpus")
    df = spark.range(3)
    assert W.next_version(W.versions(spark, root), "20240601") == 1
    for v in (9, 10):
        W.write_version(df, root, "20240601", v)
    assert W.next_version(W.versions(spark, root), "20240601") == 11
    assert tuple(W.latest_version(W.versions(spark, root)).first()) == ("20240601", 10)
    W.write_version(spark.range(7), root, "20240602", 1)
    assert W.read_latest(spark, root).count() == 7
    with pytest.raises(FileExistsError):
        W.write_version(df, root, "20240602", 1)


def test_json_articles(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"source":"s","url":"u","title":"t","author":"Ana","full_text":"x"}]')
    row = P.read_articles(spark, str(tmp_path)).first()
    assert row["author"] == "Ana" and row["section"] is None


LAND = "source string, url string, full_text string, file string, seq long, scraping_ts timestamp"


def _land(spark, folder, rows):
    data = [(s, u, t, f, i) for s, u, t, f, i in rows]
    df = spark.createDataFrame(data, "source string, url string, full_text string, file string, seq long")
    df.withColumn("scraping_ts", F.timestamp_seconds(F.lit(1717228800) + F.col("seq"))).coalesce(1).write.mode("append").parquet(folder)


def test_ingest_over_several_runs(spark, tmp_path):
    land, root, state = (str(tmp_path / n) for n in ("land", "corpus", "state"))
    for batch in ([("s", "a", "1", "f", 1), ("s", "a", "2", "f", 2), ("s", None, "3", "f", 3)],
                  [("s", " a ", "4", "g", 4), ("s", "b", "5", "g", 5), ("s", None, "6", "g", 6)]):
        _land(spark, land, batch)
        feeds.ingest(feeds.read_landing(spark, land, LAND), root, state).awaitTermination()
    assert sorted(r["full_text"] for r in spark.read.parquet(root).collect()) == ["1", "3", "5"]


def test_stream_dedupe_over_batches(spark, tmp_path):
    land, root, state = (str(tmp_path / n) for n in ("land", "out", "state"))
    for k in range(4):
        _land(spark, land, [("s", "hot" if i % 3 else f"u{i}", f"t{k}", "f", i + 300 * k) for i in range(300)])
        feeds.dedupe(feeds.read_landing(spark, land, LAND), root, state).awaitTermination()
    rows = spark.read.parquet(root).collect()
    assert len(rows) == len({r["url"] for r in rows}) == 101 and {r["full_text"] for r in rows} == {"t0"}
    # a copy later than the delay counts again
    _land(spark, land, [("s", "hot", "late", "f", 9 * 86400)])
    feeds.dedupe(feeds.read_landing(spark, land, LAND), root, state).awaitTermination()
    assert spark.read.parquet(root).where("url = 'hot'").count() == 2


def test_daily_counts_hold_open_days(spark, tmp_path):
    land, root, state = (str(tmp_path / n) for n in ("land", "out", "state"))
    for k in range(3):
        _land(spark, land, [("s", "u", "t", "f", i * 3600) for i in range(24 * k, 24 * k + 30)])
        feeds.write_daily(feeds.daily_counts(feeds.read_landing(spark, land, LAND)), root, state).awaitTermination()
    assert sorted(r["articles"] for r in feeds.read_daily(spark, root).collect()) == [14, 16, 30, 30]


def test_stream_alerts_use_earlier_runs(spark, tmp_path):
    land, history, alerts, state = (str(tmp_path / n) for n in ("land", "history", "alerts", "state"))
    schema = "id long, source string, run_ts timestamp_ntz, status string, total_valid int"
    for rows in ([(1, "a", "2024-01-01", "OK", 100), (2, "a", "2024-01-02", "OK", 100)], [(3, "a", "2024-01-03", "OK", 1)]):
        spark.createDataFrame(rows, schema.replace("timestamp_ntz", "string")).withColumn(
            "run_ts", F.col("run_ts").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(land)
        feeds.anomaly_alerts(feeds.read_landing(spark, land, schema), history, alerts, state).awaitTermination()
    got = {r["id"]: r["level"] for r in spark.read.parquet(alerts).collect()}
    assert got == {1: "ok", 2: "ok", 3: "warning"}


def test_language(spark):
    texts = [("es", "el perro de la casa come la carne que está en la mesa " * 5), ("en", "the dog of the house eats the meat that is on the table " * 5)]
    df = spark.createDataFrame(texts, "lang string, text string")
    detect = LA.detector(LA.learn(df))
    probe = spark.createDataFrame([(1, "la casa de la mesa"), (2, "the house on the table"), (3, ""), (4, None), (5, "ab")], "i int, t string")
    assert [r[0] for r in probe.orderBy("i").select(detect(F.col("t"))).collect()] == ["es", "en", "es", "es", "es"]


def test_link_reports(spark):
    links = spark.createDataFrame([(1, 1, "a", "x"), (1, 2, "b", ""), (2, 1, "a", "y"), (2, 2, "c", "y")],
                                  "section_seq int, seq int, url string, section string")
    growth = [tuple(r) for r in ST.section_link_growth(links).orderBy("section_seq").collect()]
    assert growth == [(1, 2, 2, 2), (2, 2, 1, 3)]
    assert {r["url"]: r["section"] for r in ST.first_section(links).collect()} == {"a": "x", "b": "general", "c": "y"}
