"""Run history, anomalies, errors and site health over the events table."""

from pyspark.sql import functions as F

from pressmill.checks import sqltext as S
from pressmill.checks.fixtures import executions, table, view
from pressmill.checks.registry import check
from pressmill.operators import health as H
from pressmill.operators import runs as R

TODAY = "2024-01-30"
ROW = "id, source, run_date, cast(run_ts as string) as run_ts, status, total_valid, total_discarded, duration_s, health_ok, error_msg"
RANKED = "ranked as (select *, row_number() over (partition by source order by run_ts desc, id desc) as rank from executions)"


def _shown(df, *more):
    # micro-second text in both engines, whatever the session zone
    return df.select("id", "source", "run_date", F.date_format(F.col("run_ts").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("run_ts"),
                     "status", "total_valid", "total_discarded", "duration_s", "health_ok", "error_msg", *more)


ROW = ROW.replace("cast(run_ts as string)", "strftime(run_ts, '%Y-%m-%d %H:%M:%S.%f')")


@check("runs_last", f"with {RANKED} select {ROW} from ranked where rank = 1", ["executions"])
def runs_last(spark, sf_dir):
    return _shown(R.last_run(executions(spark, sf_dir)))


@check("runs_history", f"with {RANKED} select {ROW}, rank from ranked where rank <= 10", ["executions"])
def runs_history(spark, sf_dir):
    return _shown(R.history(executions(spark, sf_dir)), "rank")


@check("runs_avg_last_n", """select source, sum(total_valid) / count(total_valid) as avg_valid from
  (select * from executions where status = 'OK' qualify row_number() over (partition by source order by run_ts desc, id desc) <= 7)
  group by source""", ["executions"])
def runs_avg_last_n(spark, sf_dir):
    return R.average_valid(executions(spark, sf_dir))


@check("runs_summary", f"""with {RANKED} select r.source, run_date as last_run_date, status as last_status, total_valid as last_valid,
  total_discarded as last_discarded, duration_s as last_duration, health_ok as last_health, error_msg as last_error, n as total_runs
  from ranked r join (select source, count(*) as n from executions group by source) c on r.source = c.source where rank = 1""", ["executions"])
def runs_summary(spark, sf_dir):
    return R.overview(executions(spark, sf_dir))


@check("runs_incremental_todo", f"""with {RANKED} select distinct source from executions where source not in
  (select source from ranked where rank = 1 and status = 'OK' and run_date = date '{TODAY}')""", ["executions"])
def runs_incremental_todo(spark, sf_dir):
    runs = executions(spark, sf_dir)
    return R.to_do(runs.select("source").distinct(), runs, F.lit(TODAY).cast("date"))


@check("runs_incremental_skips", f"""with {RANKED} select source, 'SKIPPED_INCREMENTAL' as status, total_valid, total_discarded,
  cast(0 as double) as duration_s, true as health_ok from ranked where rank = 1 and status = 'OK' and run_date = date '{TODAY}'""", ["executions"])
def runs_incremental_skips(spark, sf_dir):
    return R.incremental_skips(executions(spark, sf_dir), F.lit(TODAY).cast("date"))


VERDICTS = """numbered as (select *, row_number() over (partition by source order by run_ts, id) as n,
   sum(case when status = 'OK' then 1 else 0 end) over (partition by source order by run_ts, id rows between 9 preceding and current row) as ok10
   from executions),
 oks as (select *, lag(total_valid) over w as prev,
   sum(total_valid) over (w rows between 6 preceding and current row) / count(total_valid) over (w rows between 6 preceding and current row) as avg7
   from numbered where status = 'OK' window w as (partition by source order by n)),
 dropped as (select *, (avg7 - total_valid) / nullif(avg7, 0) * 100 as drop_pct from oks),
 judged as (select *, case when ok10 < 3 then 'ok' when total_valid = 0 and prev = 0 then 'critical'
     when avg7 > 0 and drop_pct > 50 then 'warning' else 'ok' end as level,
   case when ok10 < 3 then 'historial insuficiente' when total_valid = 0 and prev = 0 then '3 ejecuciones consecutivas con 0 artículos'
     when avg7 > 0 and drop_pct > 50 then concat('caída del ', cast(round_even(drop_pct, 0) as bigint), '% vs promedio (',
       cast(round_even(avg7, 0) as bigint), ' → ', total_valid, ')') else 'normal' end as reason from dropped)"""


@check("runs_anomaly", f"with {VERDICTS} select id, source, total_valid, level <> 'ok' as anomaly, level, reason from judged", ["executions"])
def runs_anomaly(spark, sf_dir):
    runs = executions(spark, sf_dir).select("id", "source", "run_ts", "status", "total_valid")
    return R.anomalies(runs).select("id", "source", "total_valid", "anomaly", "level", "reason")


# one pipeline run: the latest execution of every source, with its verdict
RESULTS = VERDICTS + f""", {RANKED},
 results as (select r.*, j.level, j.reason from ranked r left join judged j on r.id = j.id where r.rank = 1)"""


def _results(spark, sf_dir):
    runs = executions(spark, sf_dir)
    level = R.anomalies(runs.select("id", "source", "run_ts", "status", "total_valid")).select("id", "level", "reason")
    return R.last_run(runs).join(level, "id", "left")


@check("runs_rollup", f"""with {RESULTS} select count(*) as runs, count(*) filter (status = 'OK') as ok,
  count(*) filter (status = 'ERROR') as errors, count(*) filter (status = 'SKIPPED') as skipped_health,
  count(*) filter (status = 'SKIPPED_INCREMENTAL') as skipped_incremental,
  count(*) filter (status = 'OK' and level <> 'ok') as anomalies,
  cast(coalesce(sum(total_valid) filter (status = 'OK'), 0) as bigint) as total_valid,
  cast(coalesce(sum(total_discarded) filter (status = 'OK'), 0) as bigint) as total_discarded,
  cast(coalesce(sum(total_valid) filter (status = 'SKIPPED_INCREMENTAL'), 0) as bigint) as valid_incremental from results""", ["executions"])
def runs_rollup(spark, sf_dir):
    return R.rollup(_results(spark, sf_dir))


def _class_sql(x):
    low = f"lower(concat({x}, ' '))"
    whens = [f"when {x} is null or {x} = '' then 'DESCONOCIDO|Error sin mensaje'"]
    for first, second, kind, text in R.ERROR_RULES:
        cond = "(" + " or ".join(f"contains({low}, {S.q(t)})" for t in first) + ")"
        if second:
            cond += " and (" + " or ".join(f"contains({low}, {S.q(t)})" for t in second) + ")"
        whens.append(f"when {cond} then {S.q(kind + '|' + text)}")
    return "case " + " ".join(whens) + f" else concat('ERROR GENERAL|', substring({x}, 1, 120)) end"


@check("runs_rollup_detail", f"""with {RESULTS}, failed as (select source, status, error_msg, {_class_sql('error_msg')} as c
    from results where status in ('ERROR', 'SKIPPED'))
  select 'ok' as part, source, status, total_valid, total_discarded, null as error_type, null as error_desc, level, reason
    from results where status = 'OK'
  union all select 'failed', source, status, null, null, case when status = 'SKIPPED' then 'SITIO CAÍDO' else split_part(c, '|', 1) end,
    case when status = 'SKIPPED' then error_msg else split_part(c, '|', 2) end, null, null from failed
  union all select 'anomaly', source, status, total_valid, null, null, null, level, reason
    from results where status = 'OK' and level <> 'ok'""", ["executions"])
def runs_rollup_detail(spark, sf_dir):
    return R.detail(_results(spark, sf_dir))


ERRORS = """case event_id % 17 when 0 then 'Page.goto: Timeout 30000ms exceeded' when 1 then 'requests.ConnectionError: refused'
  when 2 then 'Name or service not known' when 3 then 'bad CERTIFICATE' when 4 then 'ModuleNotFoundError: bs4'
  when 5 then 'AttributeError: get_text' when 6 then 'playwright: chromium missing' when 7 then 'playwright failed'
  when 8 then 'Access is denied' when 9 then 'MemoryError' when 10 then 'HTTP 429' when 11 then '403' when 12 then 'HTTP 404 at /x'
  when 13 then 'ZeroDivisionError' when 14 then '' when 15 then null else concat('odd ', repeat(event_type, 40)) end"""


@check("error_classify", f"""select event_id, split_part(c, '|', 1) as error_type, substring(c, position('|' in c) + 1) as error_desc
  from (select event_id, {_class_sql('m')} as c from (select event_id, {ERRORS} as m from events))""")
def error_classify(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", F.expr(ERRORS).alias("m"))
    return df.withColumn("c", R.error_class(F.col("m"))).select(
        "event_id", F.col("c.type").alias("error_type"), F.col("c.description").alias("error_desc"))


HEALTH = """verdicts as (select source,
   url is null or url = '' or (exception is null and not coalesce(status_code >= 400, false)) as ok,
   case when url is not null and exception is null then status_code end as status_code,
   case when url is null then 0.0 when exception = 'Timeout' then 10.0 else cast(round(cast(duration_s as decimal(20,6)), 2) as double) end as duration_s,
   case when url is null then 'sin URL registrada — se permite pasar' when exception = 'ConnectionError'
     then 'no se pudo conectar — sitio caído o DNS no resuelve' when exception = 'Timeout' then 'sin respuesta después de 10s'
     when exception is not null then exception when status_code >= 400 then concat('servidor devolvió error HTTP ', status_code)
     else 'ok' end as reason,
   url is not null and coalesce(exception = 'Timeout' or (exception is null and duration_s > 8), false) as slow from probes)"""


@check("health_classify", f"with {HEALTH} select * replace (cast(duration_s as double) as duration_s) from verdicts", ["probes"])
def health_classify(spark, sf_dir):
    return H.classify(view(spark, sf_dir, "probes"))


@check("health_registered", f"with {HEALTH} select * replace (cast(duration_s as double) as duration_s) from verdicts", ["probes"])
def health_registered(spark, sf_dir):
    """Probe results that carry no address meet the catalogue's health addresses."""
    probes = view(spark, sf_dir, "probes")
    return H.classify(H.with_urls(probes.drop("url"), probes.select("source", "url")))


@check("health_rollup", f"""with {HEALTH} select count(*) as checked, count(*) filter (ok) as ok, count(*) filter (not ok) as failed,
  count(*) filter (slow) as slow from verdicts""", ["probes"])
def health_rollup(spark, sf_dir):
    return H.rollup(H.classify(view(spark, sf_dir, "probes")))


@check("health_skips", f"""with {HEALTH} select source, 'SKIPPED' as status, 0 as total_valid, 0 as total_discarded,
  cast(duration_s as double) as duration_s, ok as health_ok, reason as error_msg from verdicts where not ok""", ["probes"])
def health_skips(spark, sf_dir):
    return H.skipped(H.classify(view(spark, sf_dir, "probes")))
