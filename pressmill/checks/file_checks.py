"""Readers, sinks and versions over files written from the documents."""

from pyspark.sql import functions as F

from pressmill.checks.article_checks import COLS, JUDGED
from pressmill.checks.date_checks import AS_OF
from pressmill.checks.fixtures import articles, executions, table
from pressmill.checks.registry import check
from pressmill.checks.run_checks import VERDICTS
from pressmill.operators import gate as G
from pressmill.operators import quality as Q
from pressmill.operators import runs as R
from pressmill.operators.dedupe import keep_first
from pressmill.plans import intake as I
from pressmill.plans import jobs as J
from pressmill.schema import ARTICLE_COLUMNS, AUTHOR_COLUMNS, TOLERANT_NULLS
from pressmill.session import shared_folder
from pressmill.sources import delimited as D
from pressmill.sources import files as FL
from pressmill.sources import posts as P
from pressmill.sources import sinks as W
from pressmill.sources import status as ST

TOKENS = ", ".join("'" + t + "'" for t in TOLERANT_NULLS)
SOFT = ", ".join(f"case when {c} in ({TOKENS}) then null else {c} end as {c}" for c in ARTICLE_COLUMNS)
# File names carry one of three days; a few are discard logs or backups.
NAMED = """concat(source, case when doc % 40 = 9 then '_discarded' when doc % 40 = 19 then '_backup' else '' end,
  '_2024060', cast(1 + doc % 3 as string), '.csv')"""


def _named(spark, sf_dir):
    df = articles(spark, sf_dir).withColumn("doc", F.col("seq"))
    return df.withColumn("file", F.expr(NAMED)).drop("doc")


NAMED_SQL = f"named as (select * replace ({NAMED} as file) from (select *, seq as doc from articles))"


def _staged(spark, df, **kw):
    folder = shared_folder(spark)
    W.write_delimited(df, folder, by=["file"], **kw)
    return folder


def _paths(folder):
    return f"{folder}/file=*"


@check("scan_strict", f"select {COLS}, file from articles", ["articles"])
def scan_strict(spark, sf_dir):
    folder = _staged(spark, articles(spark, sf_dir))
    return D.read_strict(spark, _paths(folder)).drop("seq")


@check("scan_tolerant", f"select {SOFT}, file from articles", ["articles"])
def scan_tolerant(spark, sf_dir):
    folder = _staged(spark, articles(spark, sf_dir))
    return D.read_tolerant(spark, _paths(folder)).drop("seq")


@check("scan_discovery", f"with {NAMED_SQL} select distinct file from named where not contains(file, '_discarded')", ["articles"])
def scan_discovery(spark, sf_dir):
    folder = _staged(spark, _named(spark, sf_dir))
    return FL.outputs(FL.listing(spark, folder)).select("file").distinct().orderBy("file")


@check("scan_today", f"""with {NAMED_SQL} select distinct file from named where file like '%\\_20240602.csv' escape '\\'
  and not contains(file, '_discarded') and not contains(file, '_backup')""", ["articles"])
def scan_today(spark, sf_dir):
    folder = _staged(spark, _named(spark, sf_dir))
    return FL.of_day(FL.listing(spark, folder), "20240602").select("file").distinct().orderBy("file")


# Files of three days and some backups: the newest written one that is no backup and not older than the run counts.
@check("scan_alias_latest", "select distinct concat('outlet_', source) as source, concat(source, '_20240601.csv') as file from documents")
def scan_alias_latest(spark, sf_dir):
    df = articles(spark, sf_dir).select("source", "url", "file")
    folder, columns = shared_folder(spark), ["source", "url"]
    older = df.withColumn("file", F.replace("file", F.lit("20240601"), F.lit("20240531")))
    W.write_delimited(older, folder, columns, by=["file"])
    since = spark.sql("select current_timestamp() + interval 10 seconds as t").first()[0]  # ten seconds are forgiven
    W.write_delimited(df, folder, columns, by=["file"], mode="append")
    W.write_delimited(df.withColumn("file", F.replace("file", F.lit("_2024"), F.lit("_backup_2024"))), folder, columns, by=["file"], mode="append")
    patterns = df.select(F.concat(F.lit("outlet_"), "source").alias("source"),
                         F.concat("source", F.lit("_*.csv")).alias("pattern")).distinct()
    return FL.latest_by_alias(FL.listing(spark, folder), patterns, F.lit(since)).select("source", "file")


@check("scan_expand", "select distinct file from articles", ["articles"])
def scan_expand(spark, sf_dir):
    """A folder stands for its files."""
    folder = _staged(spark, articles(spark, sf_dir).select("source", "url", "file"), columns=["source", "url"])
    return FL.expanded(spark, folder).select("file").distinct()


@check("scan_sniff", f"select {SOFT}, case when source < 'src15' then null else concat('A', cast(seq as string)) end as author, file from articles",
       ["articles"])
def scan_sniff(spark, sf_dir):
    df = articles(spark, sf_dir)
    folder = shared_folder(spark)
    signed = df.where("source >= 'src15'").withColumn("author", F.expr("concat('A', cast(seq as string))"))
    W.write_delimited(df.where("source < 'src15'"), folder + "/piped", by=["file"])
    W.write_delimited(signed, folder + "/comma", columns=AUTHOR_COLUMNS, sep=",", by=["file"])
    return D.read_sniffed(spark, f"{folder}/*/file=*").drop("seq")


@check("scan_json_articles", f"select {COLS}, concat('A', cast(seq as string)) as author from articles", ["articles"])
def scan_json_articles(spark, sf_dir):
    """Exports of one JSON array per outlet and hundred articles."""
    folder = shared_folder(spark)
    signed = articles(spark, sf_dir).withColumn("author", F.expr("concat('A', cast(seq as string))"))
    P.write_pages(signed, folder, "seq", F.to_json(F.struct(*AUTHOR_COLUMNS), {"ignoreNullFields": "false"}), ["file"])
    return P.read_articles(spark, folder).select(*AUTHOR_COLUMNS)


# Outlets land their files in several states: piped, comma separated and packed; in another encoding, without
# a header, or without the columns that a corpus needs.
STATE = "case hash_of % 7 when 1 then 'comma' when 2 then 'packed' when 3 then 'encoding' when 4 then 'headless' when 5 then 'columns' else 'piped' end"
STATED = f"(select *, {STATE} as state from (select *, cast(substring(source, 4) as int) as hash_of from articles))"


def _landed(spark, sf_dir, where=None):
    """The articles as files in their states below a folder; ``<folder>/*/file=*`` lists them."""
    rows = articles(spark, sf_dir).withColumn("hash_of", F.expr("cast(substring(source, 4) as int)")).withColumn("state", F.expr(STATE))
    rows = (rows if where is None else rows.where(where)).repartition("file").sortWithinPartitions("file", "seq")
    folder, kinds = shared_folder(spark), {
        "piped": {}, "comma": {"sep": ","}, "packed": {"compression": "gzip"}, "encoding": {"encoding": "UTF-16"}, "headless": {"header": False}}
    for state, options in kinds.items():
        W.write_delimited(rows.where(F.col("state") == state), f"{folder}/{state}", by=["file"], **options)
    W.write_delimited(rows.where("state = 'columns'"), f"{folder}/columns", columns=ARTICLE_COLUMNS[2:], by=["file"])
    return f"{folder}/*/file=*"


@check("scan_status", f"""select distinct file, case state when 'encoding' then 'encoding' when 'headless' then 'columns' when 'columns' then 'columns' end as problem,
  state in ('piped', 'comma', 'packed') as readable from {STATED}""", ["articles"])
def scan_status(spark, sf_dir):
    found = ST.file_status(spark, _landed(spark, sf_dir))
    return found.select("file", "problem", F.col("problem").isNull().alias("readable"))


@check("scan_readable", f"select {SOFT}, file from {STATED} where state in ('piped', 'comma', 'packed')", ["articles"])
def scan_readable(spark, sf_dir):
    """Files that cannot be read are skipped, the others are read whatever their separator."""
    return D.read_sniffed(spark, _landed(spark, sf_dir)).drop("seq")


@check("scan_row_totals", f"""select file, case when any_value(state) <> 'encoding' then count(*) end as rows
  from {STATED} where state <> 'headless' group by file""", ["articles"])
def scan_row_totals(spark, sf_dir):
    """Rows of every file; none are known of a file in another encoding."""
    return D.row_totals(spark, _landed(spark, sf_dir, "state <> 'headless'"))


@check("scan_headers", f"""select distinct file, case when source < 'src15' then '|' else ',' end as sep,
  case when source < 'src15' then '{"+".join(ARTICLE_COLUMNS)}' else '{"+".join(ARTICLE_COLUMNS[2:])}' end as header,
  source < 'src15' as readable from articles""", ["articles"])
def scan_headers(spark, sf_dir):
    df = articles(spark, sf_dir)
    folder = shared_folder(spark)
    # one file per folder, so that every file has exactly one header line to report
    W.write_delimited(df.where("source < 'src15'").repartition("file"), folder + "/piped", by=["file"])
    W.write_delimited(df.where("source >= 'src15'").repartition("file"), folder + "/comma", columns=ARTICLE_COLUMNS[2:], sep=",", by=["file"])
    found = D.readable(D.headers(spark, f"{folder}/*/file=*"))
    return found.select("file", "sep", F.array_join("columns", "+").alias("header"), "readable")


@check("quality_file_level", f"""select distinct file, case state when 'columns' then 'missing_columns' when 'encoding' then 'read_error' else 'missing_file' end as type,
  case state when 'columns' then 'source, url' else file end as value, case state when 'columns' then 2 else 1 end as count,
  case state when 'columns' then 'Columnas obligatorias ausentes: [''source'', ''url'']' when 'encoding' then 'No se pudo leer el CSV' else 'El archivo no existe' end as details
  from {STATED} where state in ('columns', 'encoding', 'piped')""", ["articles"])
def quality_file_level(spark, sf_dir):
    """Files without some columns, files that cannot be read, and files that were expected but are not there."""
    wanted = articles(spark, sf_dir).select("file", F.expr("cast(substring(source, 4) as int)").alias("hash_of")).distinct()
    wanted = wanted.withColumn("state", F.expr(STATE)).where("state in ('columns', 'encoding', 'piped')").select("file")
    found = ST.file_status(spark, _landed(spark, sf_dir, "state in ('columns', 'encoding')"), [])
    found = found.select("file", "columns", F.lit(True).alias("present"))
    return Q.file_level_issues(wanted.join(found, "file", "left").withColumn("present", F.coalesce("present", F.lit(False))))


# --- whole jobs ------------------------------------------------------------------------------

_USABLE = f"usable as (select {SOFT}, file, seq from {STATED} where state in ('piped', 'comma', 'packed'))"
_FIRSTS = "firsts as (select * from usable qualify row_number() over (partition by url order by file, seq) = 1)"
_WHOLE = "built as (select * from firsts where trim(full_text) <> '' and trim(url) <> '')"
_FILES = f"""(select count(distinct file) from {STATED} where state in ('piped', 'comma', 'packed')) as files_ok,
  (select count(distinct file) from {STATED} where state not in ('piped', 'comma', 'packed')) as files_error"""


@check("corpus_build_run", f"""with {_USABLE}, {_FIRSTS}, {_WHOLE} select {_FILES}, (select count(*) from usable) as total_raw,
  (select count(*) from usable) - (select count(*) from firsts) as duplicates, (select count(*) from built) as total_final,
  (select count(distinct source) from built) as sources, '20240601' as dt, 1 as v""", ["articles"])
def corpus_build_run(spark, sf_dir):
    """Landed files, some unreadable, to a written version in one go."""
    return J.build_run(spark, _landed(spark, sf_dir), shared_folder(spark), "20240601")


@check("corpus_update_run", f"""with {_USABLE}, old as (select * from usable where file < 'src15'), {_FIRSTS.replace('from usable', 'from old')}, {_WHOLE},
  fresh as (select * from usable where url is null or trim(url) not in (select trim(url) from built)),
  added as (select * from fresh qualify row_number() over (partition by url order by file, seq) = 1)
  select 1 as step, (select count(*) from added) as new_rows, (select count(*) from built) as before,
    (select count(*) from built) + (select count(*) from added) as after, 1 as v
  union all select 2, 0, (select count(*) from built) + (select count(*) from added), (select count(*) from built) + (select count(*) from added), null""", ["articles"])
def corpus_update_run(spark, sf_dir):
    """An update with all files, and the same files once more: nothing new, no version."""
    root, everything = shared_folder(spark), _landed(spark, sf_dir)
    J.build_run(spark, _landed(spark, sf_dir, "file < 'src15'"), root, "20240601")
    first = J.update_run(spark, everything, root, "20240602")
    again = J.update_run(spark, everything, root, "20240603")
    shown = lambda step, df: df.select(F.lit(step).alias("step"), "new_rows", "before", "after", "v")
    return shown(1, first).unionByName(shown(2, again))


@check("repair_validated", """select count(*) as rows_read, (select count(distinct coalesce(url, '')) from articles where title <> '') as rows_written,
  0 as markup, 0 as repeats from articles""", ["articles"])
def repair_validated(spark, sf_dir):
    """Repaired records are written, read back and validated: no markup and no repeated address is left."""
    done = J.repair_run(spark, articles(spark, sf_dir), shared_folder(spark), AS_OF)
    left = lambda kind: F.size(F.filter(F.map_keys("left"), lambda k: k.startswith(kind)))
    return done.select("rows_read", "rows_written", left("html").alias("markup"), left("duplicate").alias("repeats"))


# Reports of every day's runs: what ran, what failed and why, what looked odd.
@check("run_report", f"""with {VERDICTS}, j as (select id, level from judged),
  d as (select cast(run_date as varchar) as day, count(*) as runs, count(*) filter (status = 'OK') as ok,
    count(*) filter (status = 'ERROR') as errors, count(*) filter (status = 'SKIPPED') as skipped,
    count(*) filter (status = 'OK' and level <> 'ok') as anomalies from executions left join j using (id) group by 1)
  select day, runs as scrapers_run, ok, errors, skipped, anomalies, runs as results from d""", ["executions"])
def run_report(spark, sf_dir):
    """Daily reports written as JSON texts and read back."""
    runs = executions(spark, sf_dir)
    levels = R.anomalies(runs.select("id", "source", "run_ts", "status", "total_valid")).select("id", "level", "reason")
    path = shared_folder(spark)
    W.write_reports(R.daily_report(runs.join(levels, "id", "left")), path)
    report = F.from_json("value", "execution_date string, scrapers_run long, totals struct<ok:long,errors:long,skipped_health:long,anomalies:long>, "
                                  "results array<struct<source:string,status:string,error_type:string>>")
    return spark.read.text(path).select(report.alias("r")).select(
        F.col("r.execution_date").alias("day"), "r.scrapers_run", F.col("r.totals.ok").alias("ok"), F.col("r.totals.errors").alias("errors"),
        F.col("r.totals.skipped_health").alias("skipped"), F.col("r.totals.anomalies").alias("anomalies"), F.size("r.results").cast("long").alias("results"))


_READ = ", ".join(f"coalesce(case when {c} in ({TOKENS}) then null else {c} end, 'NULL') as {c}" for c in ARTICLE_COLUMNS)


@check("adapter_intake", JUDGED.replace("from articles)", f"from (select {_READ}, file, seq from articles))")
       + "select source, url, title, section, language, file, _discard_reason from judged", ["articles"])
def adapter_intake(spark, sf_dir):
    df = articles(spark, sf_dir)
    folder = shared_folder(spark)
    # each source leaves one file, rows in order
    W.write_delimited(df.repartition("file").sortWithinPartitions("file", "seq"), folder, by=["file"])
    patterns = df.select("source", F.concat("source", F.lit("_*.csv")).alias("pattern")).distinct()
    judged = I.intake(spark, FL.listing(spark, folder), patterns, AS_OF)
    return judged.select("source", "url", "title", "section", "language", "file", "_discard_reason")


@check("export_discards", JUDGED + f"select {COLS}, _discard_reason from judged where _discard_reason is not null", ["articles"])
def export_discards(spark, sf_dir):
    folder = shared_folder(spark)
    judged = G.judge(G.enrich(articles(spark, sf_dir), AS_OF))
    # sources arrive one after the other and one of them twice: none may erase another
    W.write_discards(judged.where("source < 'src15'"), folder, "20240615")
    W.write_discards(judged.where("source >= 'src15'"), folder, "20240615")
    W.write_discards(judged.where("source = 'src2'"), folder, "20240615")
    return spark.read.parquet(f"{folder}/dt=20240615").drop("of_source")


# --- versions -------------------------------------------------------------------------------

@check("corpus_latest", """select '20240602' as dt, 1 as v, url, source, seq from
  (select * from articles qualify row_number() over (partition by url order by file, seq) = 1) where url is not null""", ["articles"])
def corpus_latest(spark, sf_dir):
    root = shared_folder(spark)
    df = articles(spark, sf_dir).select("url", "source", "file", "seq")
    # an older date with a higher number must not win
    W.write_version(df.select("url", "source", "seq"), root, "20240601", 10)
    whole = df.where("url is not null")
    W.write_version(keep_first(whole, ["url"], ["file", "seq"]).select("url", "source", "seq"), root, "20240602", 1)
    dt, v = W.latest_version(W.versions(spark, root)).first()
    return W.read_latest(spark, root).select(F.lit(dt).alias("dt"), F.lit(v).alias("v"), "url", "source", "seq")


@check("corpus_next_version", """select strftime(run_date, '%Y%m%d') as dt, max(id % 17) + 1 as next_v from executions group by 1""", ["executions"])
def corpus_next_version(spark, sf_dir):
    known = executions(spark, sf_dir).select(F.date_format("run_date", "yyyyMMdd").alias("dt"), (F.col("id") % 17).alias("v"))
    return W.next_versions(known)


@check("runs_append", """select run_date, count(*) as runs, cast(sum(total_valid) as bigint) as total_valid from executions group by run_date""", ["executions"])
def runs_append(spark, sf_dir):
    root = shared_folder(spark)
    runs = executions(spark, sf_dir)
    W.append_runs(runs.where("status = 'OK'"), root)
    W.append_runs(runs.where("status <> 'OK'"), root)
    return W.read_runs(spark, root).groupBy("run_date").agg(
        F.count("*").alias("runs"), F.sum("total_valid").cast("long").alias("total_valid"))


# --- catalogue --------------------------------------------------------------------------------

@check("catalog_select", """with modern as (select n_name as source from nation), adapters as (select concat('src', cast(n_nationkey as string)) as source from nation),
  catalog as (select * from modern union select * from adapters), wanted as (select distinct source from documents union select concat('x', source) from documents)
  select w.source, c.source is not null as known from wanted w left join catalog c using (source)""")
def catalog_select(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    docs = table(spark, sf_dir, "documents")
    catalog = I.all_sources(nation.select(F.col("n_name").alias("source")),
                            nation.select(F.concat(F.lit("src"), F.col("n_nationkey").cast("string")).alias("source")))
    wanted = I.all_sources(docs, docs.select(F.concat(F.lit("x"), "source").alias("source")))
    return I.select_sources(catalog, wanted)


@check("catalog_gap", """select distinct source from documents where source not in (select concat('src', cast(n_nationkey as string)) from nation where n_regionkey < 3)""")
def catalog_gap(spark, sf_dir):
    known = table(spark, sf_dir, "nation").where("n_regionkey < 3").select(
        F.concat(F.lit("src"), F.col("n_nationkey").cast("string")).alias("source"))
    return I.coverage_gap(table(spark, sf_dir, "documents"), known)
