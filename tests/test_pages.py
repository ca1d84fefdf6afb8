"""Landed JSON pages are full, in order, and few, whatever the gaps between a group's numbers."""

import json
from collections import defaultdict

from pyspark.sql import functions as F

from pressmill.sources import posts as P


def test_pages_of_thin_groups(spark, tmp_path):
    groups = ["a", "b/c ", None]
    rows = spark.range(3000).select("id", F.element_at(F.lit([g or "" for g in groups]), (F.col("id") % 3 + 1).cast("int")).alias("g"))
    rows = rows.withColumns({"g": F.nullif("g", F.lit("")), "n": F.col("id") * 37}).repartition(5)
    path = f"{tmp_path}/pages"
    P.write_pages(rows, path, "n", F.to_json(F.struct("n", "g")), ["g"], size=100)
    seen, files = defaultdict(list), [p for p in (tmp_path / "pages").rglob("part-*") if not p.name.endswith(".crc")]
    for p in files:
        page = json.loads(p.read_text())
        numbers = [r["n"] for r in page]
        assert 0 < len(page) <= 100 and numbers == sorted(numbers) and len({r.get("g") for r in page}) == 1
        seen[page[0].get("g")] += numbers
    assert {g: sorted(n) for g, n in seen.items()} == {g: list(range(i * 37, 3000 * 37, 111)) for i, g in enumerate(groups)}
    assert len(files) <= 30 + 3 + 4 * 2  # ten full pages a group, and the ends of ranges
    got = spark.read.schema("n long, g string").option("multiLine", True).json(path)
    assert got.count() == 3000


def test_pages_without_groups(spark, tmp_path):
    P.write_pages(spark.range(250).withColumnRenamed("id", "n"), f"{tmp_path}/p", "n", F.to_json(F.struct("n")), size=100)
    got = spark.read.schema("n long").option("multiLine", True).json(f"{tmp_path}/p")
    assert sorted(r["n"] for r in got.collect()) == list(range(250))
