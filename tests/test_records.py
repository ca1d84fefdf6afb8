from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pressmill.operators import gate as G
from pressmill.operators import quality as Q
from pressmill.operators import repair as R
from pressmill.operators.dedupe import keep_first, mark_first
from pressmill.plans import corpus as C
from pressmill.schema import ARTICLE_COLUMNS

AS_OF = "2024-06-15 12:00:00"
SCHEMA = ", ".join(f"{c} string" for c in ARTICLE_COLUMNS) + ", file string, seq long"
LONG = "x" * 300


def frame(spark, rows):
    base = {"source": "s", "url": "u", "title": "t", "publication_date": "2024-01-01", "scraping_date": "2024-06-01 08:00:00",
            "section": "c", "full_text": LONG, "language": "es", "file": "f"}
    data = [tuple({**base, **r}.get(c) for c in ARTICLE_COLUMNS + ["file"]) + (i,) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA)


def reasons(spark, rows, **kw):
    return [r[0] for r in G.judge(frame(spark, rows), **kw).orderBy("seq").select("_discard_reason").collect()]


def test_gate_rules(spark):
    got = reasons(spark, [
        {"url": "a", "full_text": "x" * 299}, {"url": "a"}, {"url": "a"}, {"publication_date": "", "full_text": ""},
        {"full_text": None}, {"url": None}, {"url": None}, {"url": "b", "publication_date": "NULL"}, {"url": "a ", "full_text": " " * 300}])
    assert got == ["full_text demasiado corto (299 chars < 300)", None, "URL duplicada", "Campo obligatorio nulo: publication_date",
                   "Campo obligatorio vacío: full_text", None, "URL duplicada", None, None]
    assert reasons(spark, [{"publication_date": "NULL"}], null_dates=["NULL"]) == ["Campo obligatorio nulo: publication_date"]


def test_repeats_count_within_a_source(spark):
    row = {"url": "u", "full_text": LONG, "title": "t", "publication_date": "2024-01-01", "section": "s"}
    df = frame(spark, [{**row, "file": f} for f in ("f1", "f2", "f1")]).withColumn("source", F.col("file"))
    assert [r["_discard_reason"] for r in G.judge(df).orderBy("seq").collect()].count("URL duplicada") == 1
    assert G.accepted(df).count() == 2


urls = st.sampled_from([None, "", "a", "a ", "b", "c"])
rows_of = st.lists(st.fixed_dictionaries({
    "url": urls, "full_text": st.sampled_from([None, "", "NULL", " ", LONG, LONG + "y"]),
    "title": st.sampled_from([None, "", "t", "<b>t</b>"]), "publication_date": st.sampled_from([None, "", "2024-01-01", "hace 2 dias"]),
    "section": st.sampled_from([None, "None", "s"]), "file": st.sampled_from(["f1", "f2"])}), min_size=1, max_size=12)


@settings(max_examples=6, deadline=None)
@given(rows_of)
def test_gate_splits_everything_once(spark, rows):
    df = frame(spark, rows)
    judged = G.judge(df)
    kept, gone = G.valid(judged), G.discarded(judged)
    assert kept.count() + gone.count() == len(rows)
    assert sorted(r["seq"] for r in kept.collect()) == sorted(r["seq"] for r in G.accepted(df).collect())


@settings(max_examples=6, deadline=None)
@given(rows_of)
def test_dedupe_properties(spark, rows):
    df = frame(spark, rows)
    once = keep_first(df, ["url"], ["file", "seq"])
    seqs = sorted(r["seq"] for r in once.collect())
    first = {}
    for i, r in sorted(enumerate(rows), key=lambda x: (x[1]["file"], x[0])):
        first.setdefault(r["url"], i)
    assert seqs == sorted(first.values())
    assert sorted(r["seq"] for r in keep_first(once, ["url"], ["file", "seq"]).collect()) == seqs
    marked = mark_first(df, ["url"], ["file", "seq"])
    assert sorted(r["seq"] for r in marked.where("is_first").collect()) == seqs and marked.count() == len(rows)


@settings(max_examples=5, deadline=None)
@given(rows_of)
def test_repair_twice_is_repair_once(spark, rows):
    once = R.repair(frame(spark, rows), AS_OF)
    again = once.withColumns({"file": F.lit("f"), "seq": F.monotonically_increasing_id()})
    assert sorted(map(tuple, R.repair(again, AS_OF).collect())) == sorted(map(tuple, once.collect()))
    stats = R.repair_stats(frame(spark, rows), AS_OF).first()
    assert stats["final"] == once.count() and stats["initial"] == len(rows)


@settings(max_examples=5, deadline=None)
@given(rows_of, rows_of)
def test_update_only_adds(spark, old, new):
    held = C.build(frame(spark, old))
    batch = frame(spark, new).withColumn("seq", F.col("seq") + 100)
    grown = C.update(held, batch)
    before = sorted(map(str, held.collect()))
    after = sorted(map(str, grown.collect()))
    assert set(before) <= set(after)
    known = {(r["url"] or "").strip() for r in held.collect()}
    want = {r["url"] for r in new if r["url"] is None or r["url"].strip() not in known}
    assert len(after) - len(before) == len(want)
    stats = C.update_stats(held, batch).first()
    assert (stats["before"], stats["after"], stats["new_rows"]) == (len(before), len(after), len(want))


def test_first_copy_empty_hides_the_url(spark):
    df = frame(spark, [{"url": "a", "full_text": ""}, {"url": "a"}])
    assert C.build(df).count() == 0
    assert C.build(df, filter_first=True).count() == 1


def test_issue_examples_keep_order_of_appearance(spark):
    dates = ["z", "y", "z", "x", "w", "v", "u", None]
    df = frame(spark, [{"url": str(i), "publication_date": d} for i, d in enumerate(dates)])
    row = Q.issues(df).where("type = 'invalid_date_format'").first()
    assert row["count"] == 8
    assert row["details"].endswith("ejemplos: ['z', 'y', 'x', 'w', 'v']")
    short = Q.issues(frame(spark, [{"full_text": None}])).where("type = 'short_full_text'").first()
    assert short["count"] == 1


def test_plans(spark):
    df = frame(spark, [{}])

    def plan(d):
        return d._jdf.queryExecution().executedPlan().toString()

    first = plan(keep_first(df, ["url"], ["file", "seq"]))
    assert "WindowGroupLimit" in first and "Partial" in first
    assert "BroadcastNestedLoopJoin" not in plan(C.arrivals(df, df)) and "CartesianProduct" not in plan(C.arrivals(df, df))
    for d in (G.judge(df), Q.issues(df), R.repair(df, AS_OF), C.build(df)):
        assert "Python" not in plan(d) and "Pandas" not in plan(d)


def _scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation ")


def test_statistics_read_each_side_once(spark, tmp_path):
    rows = [{"url": u, "full_text": LONG, "title": "t", "publication_date": "2024-01-01", "section": "s", "file": "f1"}
            for u in ("a", "a", "b ", None, None, "c")]
    frame(spark, rows).write.parquet(str(tmp_path / "batch"))
    frame(spark, rows[1:3]).write.parquet(str(tmp_path / "held"))
    batch, held = (spark.read.parquet(str(tmp_path / n)) for n in ("batch", "held"))
    stats = C.update_stats(held, batch)
    assert _scans(stats) == 2 and stats.first().asDict() == {"new_rows": 2, "duplicates": 3, "before": 2, "after": 4}
    stats = C.build_stats(batch)
    assert _scans(stats) == 1
    assert stats.first().asDict() == {"total_raw": 6, "total_final": 3, "sources": 1, "duplicates": 2}
    assert C.additions(held, batch).count() == 2
