import random

from pressmill.operators import health as H
from pressmill.operators import runs as R
from pyspark.sql import functions as F

SCHEMA = "id long, source string, run_ts string, status string, total_valid int"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("run_ts", F.col("run_ts").cast("timestamp_ntz"))


def verdicts(rows):
    """The rule, run by run."""
    out, by_source = {}, {}
    for i, source, ts, status, valid in sorted(rows, key=lambda r: (r[2], r[0])):
        past = by_source.setdefault(source, [])
        past.append((status, valid))
        if status != "OK":
            continue
        recent = [v for s, v in past[-10:][::-1] if s == "OK"]
        oks = [v for s, v in past if s == "OK"][-7:]
        avg = sum(oks) / len(oks)
        if len(recent) < 3:
            out[i] = "ok"
        elif all(v == 0 for v in recent[:2]) and valid == 0:
            out[i] = "critical"
        elif avg > 0 and (avg - valid) / avg * 100 > 50:
            out[i] = "warning"
        else:
            out[i] = "ok"
    return out


def history(n, sources, seed):
    rnd = random.Random(seed)
    # one source holds most of the runs
    return [(i, "hot" if rnd.random() < 0.6 else f"s{rnd.randrange(sources)}",
             f"2024-01-{1 + rnd.randrange(9):02d} {rnd.randrange(24):02d}:{rnd.randrange(60):02d}:00",
             rnd.choice(["OK", "OK", "OK", "ERROR", "SKIPPED"]), rnd.choice([0, 0, 5, 40, 100])) for i in range(n)]


def test_anomalies_match_the_rule_whatever_the_chunk(spark):
    rows = history(400, 4, 7)
    want = verdicts(rows)
    for chunk in (10, 37, 100_000):
        got = {r["id"]: r["level"] for r in R.anomalies(frame(spark, rows), chunk).collect()}
        assert got == want


def test_anomaly_reason_text(spark):
    rows = [(i, "a", f"2024-01-0{i} 00:00:00", "OK", v) for i, v in [(1, 100), (2, 100), (3, 100), (4, 10)]]
    got = {r["id"]: r["reason"] for r in R.anomalies(frame(spark, rows)).collect()}
    assert got[4] == "caída del 87% vs promedio (78 → 10)" and got[2] == "historial insuficiente" and got[3] == "normal"


def test_errors(spark):
    cases = {"Timeout 30s": "TIMEOUT", "playwright browser gone": "PLAYWRIGHT", "playwright": "ERROR GENERAL", "": "DESCONOCIDO",
             "page 404": "URL INVÁLIDA", "IndexError": "CÓDIGO", "got 403 then 404": "BLOQUEADO"}
    df = spark.createDataFrame([(k,) for k in cases], "m string")
    got = {r["m"]: r["t"] for r in df.select("m", R.error_class(F.col("m"))["type"].alias("t")).collect()}
    assert got == cases
    traced = df.where("m = 'IndexError'").select(R.error_class(F.col("m"), F.lit("SSL handshake"))["type"]).first()[0]
    assert traced == "SSL"


def test_health(spark):
    probes = spark.createDataFrame([
        ("a", None, None, None, None), ("b", "u", 404, 1.0, None), ("c", "u", 200, 9.0, None), ("d", "u", None, 1.0, "Timeout"),
        ("e", "u", None, 1.0, "ConnectionError"), ("f", "u", None, 1.236, "odd")],
        "source string, url string, status_code int, duration_s double, exception string")
    rows = {r["source"]: (r["ok"], r["slow"], r["duration_s"]) for r in H.classify(probes).collect()}
    assert rows == {"a": (True, False, 0.0), "b": (False, False, 1.0), "c": (True, True, 9.0), "d": (False, True, 10.0),
                    "e": (False, False, 1.0), "f": (False, False, 1.24)}
    assert tuple(H.rollup(H.classify(probes)).first()) == (6, 2, 4, 2)
