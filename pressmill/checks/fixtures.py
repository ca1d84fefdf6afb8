"""Views over the given tables, one text for Spark SQL and the SQL oracle alike."""

ARTICLES = """
select
  source as source,
  case when doc_id % 50 = 7 then null
       when doc_id % 10 = 3 then concat('https://news.example.org/2024/n', cast(doc_id - 1 as string), '/')
       when doc_id % 31 = 4 then concat(' https://news.example.org/2024/n', cast(doc_id as string), '/ ')
       else concat('https://news.example.org/2024/n', cast(doc_id as string), '/') end as url,
  case when doc_id % 29 = 3 then null
       when doc_id % 23 = 5 then ''
       when doc_id % 11 = 4 then concat('<b>Nota</b>  ', cast(doc_id as string))
       else concat('Nota ', cast(doc_id as string)) end as title,
  case doc_id % 12
       when 0 then concat('2024-', lpad(cast(1 + doc_id % 9 as string), 2, '0'), '-15 10:20:30')
       when 1 then concat('2024-', lpad(cast(1 + doc_id % 9 as string), 2, '0'), '-15')
       when 2 then concat(cast(1 + doc_id % 28 as string), '/', cast(1 + doc_id % 9 as string), '/2024')
       when 3 then concat(cast(1 + doc_id % 28 as string), ' de mayo de 2024')
       when 4 then concat('mayo ', cast(1 + doc_id % 28 as string), ', 2024')
       when 5 then concat('Hace ', cast(1 + doc_id % 20 as string), ' días')
       when 6 then 'hace 1 dia'
       when 7 then 'Sin fecha'
       when 8 then concat('2024-03-', lpad(cast(1 + doc_id % 28 as string), 2, '0'), 'T23:30:00Z')
       when 9 then '31 de febrero de 2024'
       when 10 then null
       else '15-04-2024' end as publication_date,
  case when doc_id % 37 = 1 then '' else '2024-06-01 08:00:00' end as scraping_date,
  case when doc_id % 13 = 6 then '' when doc_id % 19 = 2 then 'None' else lang end as section,
  case when doc_id % 41 = 9 then null
       when doc_id % 17 = 2 then concat('<p>', text, '</p>')
       else text end as full_text,
  case when doc_id % 5 = 0 then null else lang end as language,
  concat(source, '_20240601.csv') as file,
  doc_id as seq
from {documents}
"""

EXECUTIONS = """
select event_id as id, concat('s', cast(user_id as string)) as source, cast(ts as date) as run_date, ts as run_ts,
  case event_type when 'error' then 'ERROR' when 'view' then 'SKIPPED' else 'OK' end as status,
  case when event_type = 'signup' then 0 when event_type in ('error', 'view') then 0
       else cast(floor(value) as int) end as total_valid,
  cast(event_id % 7 as int) as total_discarded, round(value, 2) as duration_s, event_type <> 'view' as health_ok,
  case when event_type <> 'error' then null
       else case event_id % 6 when 0 then 'Timed out' when 1 then 'HTTP 403 Forbidden' when 2 then 'SSL certificate'
            when 3 then 'KeyError: x' when 4 then '' else 'unexpected' end end as error_msg
from {events}
"""

PROBES = """
select concat('e', cast(event_id as string)) as source,
  case when event_id % 11 = 0 then null else concat('https://s', cast(user_id as string), '.example.org/') end as url,
  case when event_type = 'error' then null when event_id % 9 = 4 then 503 when event_id % 13 = 5 then 404
       else 200 end as status_code,
  value / 16 as duration_s,
  case when event_type <> 'error' then null
       else case event_id % 3 when 0 then 'ConnectionError' when 1 then 'Timeout' else 'TooManyRedirects' end
       end as exception
from {events}
"""

TABLES = ["documents", "pages", "events"]
VIEWS = {"articles": (ARTICLES, "documents"), "executions": (EXECUTIONS, "events"), "probes": (PROBES, "events")}


def table(spark, sf_dir, name):
    """A given table, as it is."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark, sf_dir, name):
    text, base = VIEWS[name]
    return spark.sql(text, **{base: table(spark, sf_dir, base)})


def articles(spark, sf_dir):
    return view(spark, sf_dir, "articles")


def executions(spark, sf_dir):
    return view(spark, sf_dir, "executions")


def oracle(body, *views):
    """SQL text with the named views in front of it."""
    parts = [f"{n} as ({VIEWS[n][0].format(**{VIEWS[n][1]: VIEWS[n][1]})})" for n in views]
    body = body.strip()
    if not parts:
        return body
    lead = ", ".join(parts)
    if body.lower().startswith("with "):
        return f"with {lead}, {body[5:]}"
    return f"with {lead} {body}"
