"""Pages of a batch are read in pieces, and a piece is all that Python holds of outlines."""

import pyarrow as pa
from pyspark.sql import functions as F

from pressmill.functions import outline as O

SELECTOR = "array(named_struct('kind', 'container', 'n', 0, 'css', 'div', 'attribute', '', 'how', ''))"


def test_pieces_cover_a_batch():
    pages = pa.array(["a" * 10, None, "", "é" * (O.PIECE // 2), "b", "c" * (3 * O.PIECE), "d", None])
    got = list(O._pieces(pages))
    assert [i for start, n in got for i in range(start, start + n)] == list(range(len(pages)))
    sizes = [[len((x or "").encode()) for x in pages.slice(*p).to_pylist()] for p in got]
    assert len(got) == 5 and all(sum(s) <= O.PIECE or len(s) == 1 for s in sizes)
    assert list(O._pieces(pa.array([], pa.string()))) == []


def test_outlines_of_one_batch_come_in_pieces(spark):
    pages = spark.range(0, 60, 1, 1).select("id", F.when(F.col("id") != 7, F.concat(
        F.lit("<div><p>"), F.col("id").cast("string"), F.lit("</p>"), F.repeat(F.lit("<b>x</b>"), 10_000), F.lit("</div>"))).alias("html"))
    read = pages.select("id", O.outline(F.col("html")).alias("o"), O.marked(F.col("html"), F.expr(SELECTOR)).alias("m"))
    rows = read.select("id", "o.tag", F.element_at("o.pars", -1).alias("pars"), "m.containers", F.get("m.texts", F.lit(0)).alias("first")).collect()
    assert [r["id"] for r in rows] == list(range(60))
    for r in rows:
        if r["id"] == 7:
            assert (r["tag"], r["pars"], r["containers"], r["first"]) == ([], 0, [], None)
        else:
            assert len(r["tag"]) == 10_002 and r["pars"] == 1 and r["first"].strip() == str(r["id"])
            assert r["containers"][0]["b1"] == 0 and r["containers"][0]["p1"] == 1
