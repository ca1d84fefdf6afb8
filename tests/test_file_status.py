"""States of files are found line by line: no file is held whole, and damage and encodings are told as its bytes tell them."""

import gzip
import random

import pytest

from pressmill.plans import jobs as J
from pressmill.sources import delimited as D
from pressmill.sources import status as ST


@pytest.fixture
def files(tmp_path):
    draw = random.Random(1)
    body = ("source|url|full_text\n" + "".join(draw.choice("abcñ \n") for _ in range(60_000)) + "\n").encode()
    packed, latin = gzip.compress(body), gzip.compress(b"a|b\n\xff\n" + body)
    out = {"plain.csv": body, "packed.csv.gz": packed, "twice.csv.gz": packed + packed, "cut.csv.gz": packed[:-3], "early.csv.gz": packed[:12],
           "middle.csv.gz": packed[:900] + b"\0\0\xff" + packed[903:], "latin.csv.gz": latin, "latin_cut.csv.gz": latin[:-9],
           "nothing.csv.gz": gzip.compress(b""), "unnamed.csv": packed, "unnamed_cut.csv": packed[:-2], "mark.csv": b"\xef\xbb\xbfsource|url|full_text\r\n",
           "ends.csv": b"a,b\r\r\n", "blank.csv": b" \t\n\n", "wide.csv": "a|b\n".encode("utf-16"), "half.csv": b"a|b\n\xed\xa0\x80\n", "open [1]+%20.csv": b"a|b"}
    for name, content in out.items():
        (tmp_path / name).write_bytes(content)
    return str(tmp_path), out


def test_states_agree_with_the_bytes(spark, files):
    folder, contents = files
    got = {r["file"]: r for r in ST.file_status(spark, folder, []).collect()}
    assert got.keys() == contents.keys()
    for name, content in contents.items():
        problem, line = ST.examine(content)
        sep = None if line is None else "|" if "|" in line else ","
        assert (got[name]["problem"], got[name]["sep"], got[name]["bytes"]) == (problem, sep, len(content)), name
        assert got[name]["columns"] == (None if line is None else [c.strip('" ') for c in line.split(sep)]), name


def test_no_file_is_held_whole(spark, files, tmp_path_factory):
    """A source of bytes takes a file in one piece and refuses pieces beyond this length."""
    folder = tmp_path_factory.mktemp("good")
    for name in ("plain.csv", "packed.csv.gz", "mark.csv"):
        (folder / name).write_bytes(files[1][name])
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", 1000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 5000)  # splits of one file
    try:
        assert {r["file"] for r in ST.readable(ST.file_status(spark, str(folder))).collect()} == {"plain.csv", "packed.csv.gz", "mark.csv"}
        assert D.readable(D.headers(spark, str(folder))).where("readable").count() == 3
        assert {r["file"]: r["rows"] for r in D.row_totals(spark, str(folder)).collect()}["mark.csv"] == 0
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_jobs_hold_no_file_whole(spark, tmp_path_factory):
    folder, root = tmp_path_factory.mktemp("landed"), str(tmp_path_factory.mktemp("root"))
    body = "source|url|full_text\n" + "".join(f"a|https://x/{i}|text {i}\n" for i in range(500))
    (folder / "plain.csv").write_text(body)
    (folder / "packed.csv.gz").write_bytes(gzip.compress(body.replace("x/", "y/").encode()))
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", 1000)
    try:
        assert D.read_sniffed(spark, str(folder)).count() == 1000
        assert J.build_run(spark, str(folder), root, "20240601").first()[:6] == (2, 0, 1000, 0, 1000, 1)
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_archives_without_a_name_for_it_come_in_pieces(spark, files, tmp_path_factory):
    folder, contents = tmp_path_factory.mktemp("unnamed"), files[1]
    packed = contents["packed.csv.gz"]
    tried = {"one.csv": packed, "cut.csv": packed[:-2], "twice.csv": packed + packed, "damaged.csv": contents["middle.csv.gz"], "latin.csv": contents["latin.csv.gz"],
             "ends.csv": packed + b"\n", "nothing.csv": contents["nothing.csv.gz"]}
    for name, content in tried.items():
        (folder / name).write_bytes(content)
    assert min(len(packed), len(contents["middle.csv.gz"])) > 5000  # several splits
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", 1000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 5000)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = {r["file"]: (r["problem"], r["columns"]) for r in ST.file_status(spark, str(folder), []).collect()}
    finally:
        for name in ("sources.binaryFile.maxLength", "files.maxPartitionBytes", "execution.arrow.maxRecordsPerBatch"):
            spark.conf.unset(f"spark.sql.{name}")
    for name, content in tried.items():
        problem, line = ST.examine(content)
        assert got[name] == (problem, line and line.split("|")), name
    assert {n for n, (problem, _) in got.items() if problem is None} == {"one.csv", "twice.csv"}


def test_archive_of_members_beyond_a_step(monkeypatch):
    """Unpacked in steps, several such members one after the other came to no end."""
    monkeypatch.setattr(ST, "STEP", 5000)
    draw = random.Random(1)
    packed = gzip.compress(("a|b\n" + "".join(f"{draw.randrange(10**9)},\n" for _ in range(2000))).encode())
    assert ST.examine(packed * 3) == (None, "a|b")
    assert ST.examine(packed * 3 + packed[:-1]) == (ST.BROKEN, None)
