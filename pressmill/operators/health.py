"""Judging probe results of the outlets' sites."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Limits and texts of the health report.
TIMEOUT_S = 10
SLOW_S = 8
REASONS = {
    "no_url": "sin URL registrada — se permite pasar",
    "http": "servidor devolvió error HTTP ",
    "ok": "ok",
    "connection": "no se pudo conectar — sitio caído o DNS no resuelve",
    "timeout": f"sin respuesta después de {TIMEOUT_S}s",
}


def with_urls(probes, catalog):
    """Probe results (source, ...) with the health address that the catalogue (source, url) has for their source; null
    where none is registered. Of several addresses of a source the first by name holds."""
    known = catalog.where("url is not null").groupBy(F.col("source").alias("_source")).agg(F.min("url").alias("url"))
    return probes.join(known, F.col("source") == F.col("_source"), "left").drop("_source")


def classify(probes: DataFrame) -> DataFrame:
    """Verdict per probe. ``exception`` is ConnectionError, Timeout, another text, or null."""
    no_url = F.col("url").isNull() | (F.col("url") == "")
    exc = F.col("exception")
    refused, late = exc == "ConnectionError", exc == "Timeout"
    bad_code = exc.isNull() & (F.col("status_code") >= 400)
    ok = no_url | (exc.isNull() & ~(F.col("status_code") >= 400))
    reason = (
        F.when(no_url, F.lit(REASONS["no_url"])).when(refused, F.lit(REASONS["connection"]))
        .when(late, F.lit(REASONS["timeout"])).when(exc.isNotNull(), exc)
        .when(bad_code, F.concat(F.lit(REASONS["http"]), F.col("status_code").cast("string")))
        .otherwise(F.lit(REASONS["ok"]))
    )
    duration = F.when(no_url, F.lit(0.0)).when(late, F.lit(float(TIMEOUT_S))) \
        .otherwise(F.round(F.col("duration_s").cast("decimal(20,6)"), 2).cast("double"))
    slow = ~no_url & F.coalesce(late | (exc.isNull() & (F.col("duration_s") > SLOW_S)), F.lit(False))
    return probes.select(
        "source", ok.alias("ok"),
        F.when(~no_url & exc.isNull(), F.col("status_code")).alias("status_code"),
        duration.alias("duration_s"), reason.alias("reason"), slow.alias("slow"))


def rollup(verdicts: DataFrame) -> DataFrame:
    return verdicts.agg(
        F.count("*").alias("checked"), F.count_if("ok").alias("ok"),
        F.count_if(~F.col("ok")).alias("failed"), F.count_if("slow").alias("slow"))


def skipped(verdicts: DataFrame) -> DataFrame:
    """Run records of sources left out because their probe failed."""
    return verdicts.where("not ok").select(
        "source", F.lit("SKIPPED").alias("status"), F.lit(0).alias("total_valid"),
        F.lit(0).alias("total_discarded"), "duration_s", F.col("ok").alias("health_ok"),
        F.col("reason").alias("error_msg"))
