"""Run history of the collectors: latest runs, averages, roll-ups and anomalies."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressmill.operators.dedupe import top_n
from pressmill.session import shared_folder

# Anomaly thresholds.
DROP_PCT = 50
MIN_RUNS = 3
ZERO_RUNS = 2
HISTORY = 10
AVERAGE_OVER = 7

def _newest():
    return [F.desc("run_ts"), F.desc("id")]


# Ordered error rules, as (any of these texts, and any of these, type, description).
ERROR_RULES = [
    (["timeout", "timed out"], [], "TIMEOUT", "El sitio tardó demasiado en responder"),
    (["connectionerror", "connection refused"], [], "CONEXIÓN", "No se pudo conectar al sitio"),
    (["dns", "name or service not known"], [], "DNS", "El dominio no resuelve — sitio fuera de línea"),
    (["ssl", "certificate"], [], "SSL", "Error de certificado de seguridad"),
    (["importerror", "modulenotfounderror"], [], "IMPORTACIÓN", "Error cargando el módulo del scraper"),
    (["attributeerror"], [], "SELECTOR", "HTML del sitio cambió — selector no encontrado"),
    (["playwright"], ["browser", "chromium"], "PLAYWRIGHT", "Error iniciando el navegador"),
    (["permissionerror", "access is denied"], [], "PERMISOS", "Sin permisos para escribir en el directorio"),
    (["memoryerror"], [], "MEMORIA", "Sin RAM suficiente — reducir --workers"),
    (["429", "rate limit"], [], "RATE LIMIT", "Sitio bloqueó temporalmente las peticiones"),
    (["403", "forbidden"], [], "BLOQUEADO", "Sitio rechazó el acceso — posible bot detection"),
    (["404"], [], "URL INVÁLIDA", "La URL del scraper ya no existe"),
    (["zerodivision", "indexerror", "keyerror"], [], "CÓDIGO", "Error interno — estructura del sitio cambió"),
]


def error_class(message, trace=None):
    """Struct (type, description) of an error message and its trace."""
    low = F.lower(F.concat_ws(" ", message, F.coalesce(trace, F.lit("")) if trace is not None else F.lit("")))

    def any_of(texts):
        out = F.lit(False)
        for t in texts:
            out = out | low.contains(t)
        return out

    def pair(kind, text):
        return F.struct(F.lit(kind).alias("type"), text.alias("description"))

    out = F.when(message.isNull() | (message == ""), pair("DESCONOCIDO", F.lit("Error sin mensaje")))
    for first, second, kind, text in ERROR_RULES:
        hit = any_of(first) & any_of(second) if second else any_of(first)
        out = out.when(hit, pair(kind, F.lit(text)))
    return out.otherwise(pair("ERROR GENERAL", F.substring(message, 1, 120)))


def last_run(runs: DataFrame) -> DataFrame:
    return top_n(runs, ["source"], _newest(), 1).drop("_rn")


def history(runs: DataFrame, n: int = HISTORY) -> DataFrame:
    """The newest ``n`` runs per source with their rank, newest first."""
    return top_n(runs, ["source"], _newest(), n, rank="rank")


def average_valid(runs: DataFrame, n: int = AVERAGE_OVER) -> DataFrame:
    """Mean of valid articles over the newest ``n`` successful runs per source."""
    newest = top_n(runs.where("status = 'OK'"), ["source"], _newest(), n)
    return newest.groupBy("source").agg(
        (F.sum("total_valid") / F.count("total_valid")).alias("avg_valid"))


def overview(runs: DataFrame) -> DataFrame:
    """Latest state per source with its number of runs: one aggregation, no self-join."""
    fields = ["run_date", "status", "total_valid", "total_discarded", "duration_s", "health_ok", "error_msg"]
    return runs.groupBy("source").agg(
        F.max_by(F.struct(*fields), F.struct("run_ts", "id")).alias("last"), F.count("*").alias("total_runs"),
    ).select(
        "source", F.col("last.run_date").alias("last_run_date"), F.col("last.status").alias("last_status"),
        F.col("last.total_valid").alias("last_valid"), F.col("last.total_discarded").alias("last_discarded"),
        F.col("last.duration_s").alias("last_duration"), F.col("last.health_ok").alias("last_health"),
        F.col("last.error_msg").alias("last_error"), "total_runs")


def to_do(sources: DataFrame, runs: DataFrame, today) -> DataFrame:
    """Sources still to run: those whose latest run is not a success of ``today``."""
    done = last_run(runs.select("source", "run_ts", "id", "status", "run_date")).where(
        (F.col("status") == "OK") & (F.col("run_date") == today)).select("source")
    return sources.join(done, "source", "left_anti")


def incremental_skips(runs: DataFrame, today) -> DataFrame:
    """The complement of ``to_do``, as run records."""
    done = last_run(runs).where((F.col("status") == "OK") & (F.col("run_date") == today))
    return done.select("source", F.lit("SKIPPED_INCREMENTAL").alias("status"), "total_valid",
                       "total_discarded", F.lit(0.0).alias("duration_s"), F.lit(True).alias("health_ok"))


def _positions(runs: DataFrame) -> DataFrame:
    """Number the runs of each source in time order: ``n_all`` counts all runs up to the row, ``n_ok`` the successful ones.

    Runs are sorted into ranges by (source, time, id), which are written, so that a busy source spreads over many of
    them, whatever its times. Rows are numbered inside a range and shifted by the totals of the source's earlier
    ranges; the table of totals has one row per source and range.
    """
    spark = runs.sparkSession
    path = f"{shared_folder(spark)}/ranges"
    ranged = runs.repartitionByRange("source", "run_ts", "id").withColumn("_range", F.spark_partition_id())
    ranged.write.parquet(path)
    rows = spark.read.schema(ranged.schema).parquet(path)
    ok = (F.col("status") == "OK").cast("long")
    totals = rows.groupBy("source", "_range").agg(F.count("*").alias("_rows"), F.sum(ok).alias("_oks"))
    earlier = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shift = totals.select("source", "_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows0"),
                          F.coalesce(F.sum("_oks").over(earlier), F.lit(0)).alias("_oks0"))
    inside = Window.partitionBy("source", "_range").orderBy("run_ts", "id")
    numbered = rows.withColumns({"_n": F.row_number().over(inside),
                                 "_o": F.sum(ok).over(inside.rowsBetween(Window.unboundedPreceding, 0))})
    match = numbered["source"].eqNullSafe(F.col("_source")) & (numbered["_range"] == F.col("_of"))
    shifted = numbered.join(shift.withColumnsRenamed({"source": "_source", "_range": "_of"}), match)
    return shifted.withColumns({"n_all": F.col("_rows0") + F.col("_n"), "n_ok": F.col("_oks0") + F.col("_o")}).select(*runs.columns, "n_all", "n_ok")


def anomalies(runs: DataFrame, chunk: int = 100_000) -> DataFrame:
    """Verdict for every successful run: anomaly, level, reason.

    The run itself is part of its own history. Successful runs are cut into chunks of
    ``chunk`` per source and each chunk also gets the few rows before it, so the window
    frames are exact while no task holds more than a chunk of a busy source.
    """
    lead_in = max(HISTORY, AVERAGE_OVER, ZERO_RUNS) - 1
    oks = _positions(runs).where("status = 'OK'")
    slot = F.floor((F.col("n_ok") - 1) / chunk)
    late = (F.col("n_ok") - 1) % chunk >= chunk - lead_in
    copies = F.when(late, F.array(slot, slot + 1)).otherwise(F.array(slot))
    spread = oks.withColumn("_slot", F.explode(copies)).withColumn("_own", F.col("_slot") == slot)
    by_time = Window.partitionBy("source", "_slot").orderBy("n_all")
    recent = by_time.rangeBetween(-(HISTORY - 1), 0)
    seven = by_time.rowsBetween(-(AVERAGE_OVER - 1), 0)
    framed = spread.withColumns({
        "_ok10": F.count("*").over(recent),
        "_zeros": F.count_if(F.col("total_valid") == 0).over(by_time.rowsBetween(-(ZERO_RUNS - 1), 0)),
        "_avg": F.sum("total_valid").over(seven) / F.count("total_valid").over(seven),
    }).where("_own")
    drop = (F.col("_avg") - F.col("total_valid")) / F.nullif(F.col("_avg"), F.lit(0.0)) * 100
    enough = F.col("_ok10") >= MIN_RUNS
    critical = enough & (F.col("_zeros") == ZERO_RUNS)
    warning = enough & (F.col("_avg") > 0) & (drop > DROP_PCT)
    whole = lambda x: F.bround(x, 0).cast("long").cast("string")
    level = F.when(critical, F.lit("critical")).when(warning, F.lit("warning")).otherwise(F.lit("ok"))
    reason = (
        F.when(~enough, F.lit("historial insuficiente"))
        .when(critical, F.lit(f"{ZERO_RUNS + 1} ejecuciones consecutivas con 0 artículos"))
        .when(warning, F.concat(F.lit("caída del "), whole(drop), F.lit("% vs promedio ("),
                                whole(F.col("_avg")), F.lit(" → "), F.col("total_valid").cast("string"), F.lit(")")))
        .otherwise(F.lit("normal"))
    )
    return framed.withColumns({"level": level, "reason": reason, "anomaly": level != "ok"}) \
        .select(*runs.columns, "anomaly", "level", "reason")


def tail(runs: DataFrame) -> DataFrame:
    """The runs of each source that the verdicts of later ones depend on: its latest ones, and its latest successes."""
    lead = max(HISTORY, AVERAGE_OVER, ZERO_RUNS) - 1
    latest, good = (top_n(rows, ["source"], _newest(), lead).drop("_rn") for rows in (runs, runs.where("status = 'OK'")))
    return latest.unionByName(good).distinct()  # a few rows per source by now


def rollup(results: DataFrame) -> DataFrame:
    """Totals of one pipeline run. ``results`` has status, counts and a level (null if none)."""
    ok = F.col("status") == "OK"
    inc = F.col("status") == "SKIPPED_INCREMENTAL"
    total = lambda cond, c: F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0))
    return results.agg(
        F.count("*").alias("runs"), F.count_if(ok).alias("ok"),
        F.count_if(F.col("status") == "ERROR").alias("errors"),
        F.count_if(F.col("status") == "SKIPPED").alias("skipped_health"),
        F.count_if(inc).alias("skipped_incremental"),
        F.count_if(ok & (F.col("level") != "ok")).alias("anomalies"),
        total(ok, "total_valid").alias("total_valid"),
        total(ok, "total_discarded").alias("total_discarded"),
        total(inc, "total_valid").alias("valid_incremental"))


def detail(results: DataFrame) -> DataFrame:
    """The tables of a run summary as one long table (``part`` ok, failed or anomaly), from
    a single look at ``results``: successes, failures with their class, flagged successes."""
    ok, down = F.col("status") == "OK", F.col("status") == "SKIPPED"
    cls = error_class(F.col("error_msg"))
    text, number = F.lit(None).cast("string"), F.lit(None).cast("int")

    def row(part, valid=number, gone=number, kind=text, desc=text, level=text, reason=text):
        return F.struct(F.lit(part).alias("part"), valid.alias("total_valid"), gone.alias("total_discarded"),
                        kind.alias("error_type"), desc.alias("error_desc"), level.alias("level"), reason.alias("reason"))

    good = row("ok", F.col("total_valid"), F.col("total_discarded"), level=F.col("level"), reason=F.col("reason"))
    odd = row("anomaly", F.col("total_valid"), level=F.col("level"), reason=F.col("reason"))
    failed = row("failed", kind=F.when(down, F.lit("SITIO CAÍDO")).otherwise(cls["type"]),
                 desc=F.when(down, F.col("error_msg")).otherwise(cls["description"]))
    rows = F.when(ok & (F.coalesce(F.col("level"), F.lit("ok")) != "ok"), F.array(good, odd)) \
        .when(ok, F.array(good)).when(down | (F.col("status") == "ERROR"), F.array(failed))
    return results.select("source", "status", F.inline(rows))


def successes(results: DataFrame) -> DataFrame:
    return detail(results).where("part = 'ok'").orderBy(F.desc("total_valid"), "source")


def failures(results: DataFrame) -> DataFrame:
    return detail(results).where("part = 'failed'").select("source", "status", "error_type", "error_desc")


def flagged(results: DataFrame) -> DataFrame:
    return detail(results).where("part = 'anomaly'").select("source", "level", "reason")


def daily_report(results: DataFrame) -> DataFrame:
    """One JSON text per day (``report``): date, number of runs, totals, and every run with its error class and verdict.

    ``results`` is the run history with a level and reason (null if not judged). A day's list is one row, as its report is one
    file: as long as that day has runs."""
    cls = error_class(F.col("error_msg"))
    failed = F.col("status") != "OK"
    entry = F.struct("source", "status", "total_valid", "total_discarded", "duration_s", "health_ok", F.when(failed, F.col("error_msg")).alias("error"),
                     F.when(failed, cls["type"]).alias("error_type"), F.when(failed, cls["description"]).alias("error_desc"),
                     F.when(F.col("level") != "ok", F.struct("level", "reason")).alias("anomaly"))
    ok = F.col("status") == "OK"
    daily = results.groupBy("run_date").agg(
        F.count("*").alias("scrapers_run"),
        F.struct(F.count_if(ok).alias("ok"), F.count_if(F.col("status") == "ERROR").alias("errors"),
                 F.count_if(F.col("status") == "SKIPPED").alias("skipped_health"), F.count_if(ok & (F.col("level") != "ok")).alias("anomalies")).alias("totals"),
        F.sort_array(F.collect_list(F.struct("run_ts", "id", entry.alias("entry")))).alias("all"))
    return daily.select(F.to_json(F.struct(
        F.col("run_date").cast("string").alias("execution_date"), "scrapers_run", "totals",
        F.transform("all", lambda x: x["entry"]).alias("results"))).alias("report"))


def run_record(results: DataFrame, at: str) -> DataFrame:
    """History rows of finished runs, stamped with the moment ``at`` (local time)."""
    ts = F.lit(at).cast("timestamp_ntz")
    return results.select(
        "source", ts.cast("date").alias("run_date"), ts.alias("run_ts"), "status",
        F.coalesce("total_valid", F.lit(0)).alias("total_valid"),
        F.coalesce("total_discarded", F.lit(0)).alias("total_discarded"),
        F.round("duration_s", 2).alias("duration_s"), "health_ok",
        F.when(F.col("status") != "OK", F.col("error_msg")).alias("error_msg"))
