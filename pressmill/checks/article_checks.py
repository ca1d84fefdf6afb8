"""Gate, duplicates, corpus, quality and repair over the articles view."""

from pyspark.sql import functions as F

from pressmill.checks import sqltext as S
from pressmill.checks.date_checks import AS_OF, normalize_sql
from pressmill.checks.fixtures import articles
from pressmill.checks.registry import check
from pressmill.functions.text import SPACE, bind
from pressmill.operators import gate as G
from pressmill.operators import quality as Q
from pressmill.operators import repair as R
from pressmill.operators import stats as ST
from pressmill.operators.dedupe import keep_first
from pressmill.plans import corpus as C
from pressmill.schema import ARTICLE_COLUMNS, DATE_SENTINELS, NULL_TEXT, UNDATED_TOKENS

COLS = ", ".join(ARTICLE_COLUMNS)

# --- gate -------------------------------------------------------------------------------

JUDGED = f"""with enriched as (
  select source, url, title, publication_date, '{AS_OF}' as scraping_date, section, full_text,
    coalesce(nullif(language, ''), 'es') as language, file, seq,
    case when publication_date is null or publication_date = '' then 'Campo obligatorio nulo: publication_date'
         when full_text is null or full_text = '' then 'Campo obligatorio vacío: full_text'
         when length(full_text) < 300 then concat('full_text demasiado corto (', length(full_text), ' chars < 300)')
    end as reason from articles),
 ranked as (select *, row_number() over (partition by source, url order by file, seq) as rn from enriched where reason is null),
 judged as (select * exclude (rn, reason), case when rn > 1 then 'URL duplicada' end as _discard_reason from ranked
   union all by name select * exclude (reason), reason as _discard_reason from enriched where reason is not null)
"""


def _judged(spark, sf_dir):
    return G.judge(G.enrich(articles(spark, sf_dir), AS_OF))


@check("gate_articles", JUDGED + f"select {COLS} from judged where _discard_reason is null", ["articles"])
def gate_articles(spark, sf_dir):
    return G.accepted(G.enrich(articles(spark, sf_dir), AS_OF)).select(*ARTICLE_COLUMNS)


@check("gate_discards", JUDGED + f"select {COLS}, _discard_reason from judged where _discard_reason is not null", ["articles"])
def gate_discards(spark, sf_dir):
    return G.discarded(_judged(spark, sf_dir)).select(*ARTICLE_COLUMNS, "_discard_reason")


@check("gate_summary", JUDGED + """select source, count(*) as total_raw, count(*) filter (_discard_reason is null) as total_valid,
  count(*) filter (_discard_reason is not null) as total_discarded from judged group by source""", ["articles"])
def gate_summary(spark, sf_dir):
    # the text itself is not needed for the totals, only whether it passes
    return G.summary(_judged(spark, sf_dir))


@check("schema_complete", """select coalesce(source, 'NULL') as source, coalesce(url, 'NULL') as url, coalesce(title, 'NULL') as title,
  coalesce(publication_date, 'NULL') as publication_date, 'NULL' as scraping_date, coalesce(section, 'NULL') as section,
  coalesce(full_text, 'NULL') as full_text, 'NULL' as language, seq from articles""", ["articles"])
def schema_complete(spark, sf_dir):
    return G.complete_schema(articles(spark, sf_dir).drop("scraping_date", "language", "file"))


@check("sentinel_filter", """select seq, publication_date from articles where length(full_text) >= 300
  and (publication_date is null or publication_date not in ('Sin fecha', 'Error', ''))""", ["articles"])
def sentinel_filter(spark, sf_dir):
    return G.sentinel_filter(articles(spark, sf_dir), DATE_SENTINELS).select("seq", "publication_date")


DATED = f"""dated as (select seq, {normalize_sql('publication_date', f"timestamp '{AS_OF}'")} as publication_date from articles)"""


def _dated(spark, sf_dir):
    from pressmill.functions.dates import normalize

    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    date = bind(F.col("publication_date"), lambda c: normalize(c, as_of))
    return articles(spark, sf_dir).select("seq", date.alias("publication_date"))


@check("date_cutoff", f"""with {DATED} select * from dated where publication_date is null or publication_date >= '2024-05-01'""", ["articles"])
def date_cutoff(spark, sf_dir):
    return G.on_or_after(_dated(spark, sf_dir), "2024-05-01")


@check("date_range", f"""with {DATED} select * from dated where publication_date is null
  or substring(publication_date, 1, 10) between '2024-03-10' and '2024-05-20'""", ["articles"])
def date_range(spark, sf_dir):
    return G.in_range(_dated(spark, sf_dir), "2024-03-10", "2024-05-20")


# --- duplicates and corpus -----------------------------------------------------------------

@check("dedupe_url", """select url, seq, file, title from articles
  qualify row_number() over (partition by url order by file, seq) = 1""", ["articles"])
def dedupe_url(spark, sf_dir):
    return keep_first(articles(spark, sf_dir).select("url", "seq", "file", "title"), ["url"], ["file", "seq"])


def _value(c):
    return f"({c} is not null and {S.strip(c)} <> '' and {c} <> 'NULL')"


BUILT = f"""firsts as (select * from articles qualify row_number() over (partition by url order by file, seq) = 1),
 built as (select * from firsts where {_value('full_text')} and {_value('url')})"""


@check("corpus_build", f"with {BUILT} select {COLS} from built", ["articles"])
def corpus_build(spark, sf_dir):
    return C.newest_first(C.build(articles(spark, sf_dir))).select(*ARTICLE_COLUMNS)


@check("corpus_by_source", f"with {BUILT} select source, count(*) as articles from built where source is not null group by source", ["articles"])
def corpus_by_source(spark, sf_dir):
    return C.by_source(C.build(C.counted(articles(spark, sf_dir))))


@check("corpus_build_stats", f"""with {BUILT} select (select count(*) from articles) as total_raw,
  (select count(*) from articles) - (select count(*) from firsts) as duplicates,
  (select count(*) from built) as total_final, (select count(distinct source) from built) as sources,
  (select count(distinct file) from articles where source not like 'src1%') as files_ok,
  (select count(distinct file) from articles where source like 'src1%') as files_error""", ["articles"])
def corpus_build_stats(spark, sf_dir):
    df = articles(spark, sf_dir)
    files = df.select("file", "source").distinct().select("file", (~F.col("source").like("src1%")).alias("readable"))
    return C.build_stats(df, files)


@check("corpus_overview", f"""with {BUILT} select count(*) as articles, count(distinct source) as sources,
  max(publication_date) as newest, min(publication_date) as oldest from built""", ["articles"])
def corpus_overview(spark, sf_dir):
    return C.overview(C.build(C.counted(articles(spark, sf_dir), "publication_date")))


# the corpus holds some outlets already; the batch brings the articles of all of them
UPDATE = f"""held as (select * from articles where file < 'src15'),
 corpus as (select * from (select * from held qualify row_number() over (partition by url order by file, seq) = 1)
   where {_value('full_text')} and {_value('url')}),
 fresh as (select * from articles where url is null or {S.strip('url')} not in (select {S.strip('url')} from corpus)),
 added as (select * from fresh qualify row_number() over (partition by url order by file, seq) = 1),
 updated as (select * from corpus union all select * from added)"""


def _held(spark, sf_dir):
    batch = articles(spark, sf_dir)
    return C.build(batch.where("file < 'src15'")), batch


@check("corpus_update", f"with {UPDATE} select {COLS} from updated", ["articles"])
def corpus_update(spark, sf_dir):
    return C.newest_first(C.update(*_held(spark, sf_dir))).select(*ARTICLE_COLUMNS)


@check("corpus_update_stats", f"""with {UPDATE} select (select count(*) from added) as new_rows,
  (select count(*) from articles) - (select count(*) from fresh) as duplicates,
  (select count(*) from corpus) as before, (select count(*) from updated) as after""", ["articles"])
def corpus_update_stats(spark, sf_dir):
    return C.update_stats(*_held(spark, sf_dir))


@check("corpus_update_by_file", f"""with {UPDATE} select a.file, count(f.seq) as new_rows, count(*) - count(f.seq) as existing
  from articles a left join fresh f on a.seq = f.seq group by a.file""", ["articles"])
def corpus_update_by_file(spark, sf_dir):
    return C.update_by_file(*_held(spark, sf_dir))


@check("union_by_name", """select source, url, title, null as author, lang, seq from (select source, url, title, language as lang, seq from articles)
  union all select source, url, title, concat('A', cast(seq as string)) as author, null as lang, seq from articles""", ["articles"])
def union_by_name(spark, sf_dir):
    df = articles(spark, sf_dir)
    plain = df.select("source", "url", "title", F.col("language").alias("lang"), "seq")
    signed = df.select(F.concat(F.lit("A"), F.col("seq").cast("string")).alias("author"), "title", "url", "source", "seq")
    return C.union_by_name([plain, signed])


@check("sample_head", "select file, seq, url from articles order by file, seq limit 20", ["articles"])
def sample_head(spark, sf_dir):
    return ST.head(articles(spark, sf_dir).select("file", "seq", "url"), ["file", "seq"], 20)


@check("section_counts", "select section, count(*) as articles from articles where section is not null group by section", ["articles"])
def section_counts(spark, sf_dir):
    return ST.section_counts(articles(spark, sf_dir))


@check("text_length_stats", """select source, count(*) as articles, round(sum(length(full_text)) / count(full_text), 4) as mean_length,
  min(length(full_text)) as min_length, max(length(full_text)) as max_length, count(distinct section) as sections
  from articles group by source""", ["articles"])
def text_length_stats(spark, sf_dir):
    return ST.text_length_stats(articles(spark, sf_dir))


@check("undated_report", """with u as (select * from articles where publication_date is null
    or publication_date in ('', 'NULL', 'None', 'nan', 'NaT', 'Sin fecha', 'Not Found')),
 f as (select source, url, seq from u where url is not null qualify row_number() over (partition by source order by seq) <= 10),
 s as (select source, string_agg(url, ' ' order by seq) as first_urls from f group by source)
 select c.source, c.undated, s.first_urls from (select source, count(*) as undated from u group by source) c left join s using (source)""",
       ["articles"])
def undated_report(spark, sf_dir):
    return ST.undated_report(articles(spark, sf_dir), UNDATED_TOKENS + ["Not Found"])


# --- quality ---------------------------------------------------------------------------------

_EXACT = r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\s+[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}"


def _bad_date(c):
    t = f"coalesce({c}, 'None')"
    return (f"({t} <> '' and not (regexp_full_match({t}, '{_EXACT}') and try_strptime(case when regexp_full_match({t}, '{_EXACT}') "
            f"then {t} end, '{S.DATE_FMT}') is not null))")


def _issue(kind, value, cond, words):
    return (f"select file, '{kind}' as type, '{value}' as value, count(*) as count, "
            f"concat(count(*), {S.q(words)}) as details from articles where {cond} group by file")


def _issues_sql():
    parts = [_issue("missing_value", c, f"({c} is null or {S.strip(c)} = '')", f" filas con valor nulo o vacio en '{c}'")
             for c in ARTICLE_COLUMNS]
    parts += [_issue("html_detected", c, f"regexp_matches({c}, '<[^>]+>')", f" filas contienen etiquetas HTML en '{c}'")
              for c in ("title", "section", "full_text")]
    parts.append(_issue("short_full_text", "full_text", "length(coalesce(full_text, 'None')) < 300",
                        " filas con full_text menor a 300 caracteres"))
    parts.append("""select file, 'duplicate_url', 'url', count(*), concat(count(*), ' filas duplicadas en columna ''url''')
      from (select *, count(*) over (partition by file, url) as n from articles) where n > 1 group by file""")
    for c in ("publication_date", "scraping_date"):
        parts.append(f"""select file, 'invalid_date_format', '{c}', cast(sum(n) as bigint), concat(cast(sum(n) as bigint),
          ' valores no siguen el formato %Y-%m-%d %H:%M:%S; ejemplos: [',
          string_agg('''' || v || '''', ', ' order by pos) filter (rn <= 5), ']')
          from (select *, row_number() over (partition by file order by pos, v) as rn from
            (select file, coalesce({c}, 'None') as v, min(seq) as pos, count(*) as n from articles where {_bad_date(c)} group by 1, 2))
          group by file""")
    return " union all ".join(parts)


@check("quality_issues", _issues_sql(), ["articles"])
def quality_issues(spark, sf_dir):
    return Q.issues(articles(spark, sf_dir))


@check("quality_files", f"""with i as ({_issues_sql()}), n as (select file, count(*) as issues from i group by file)
  select file, count(*) as rows, 8 as columns, coalesce(any_value(n.issues), 0) as issues, coalesce(any_value(n.issues), 0) = 0 as ok
  from articles left join n using (file) group by file""", ["articles"])
def quality_files(spark, sf_dir):
    return Q.verdicts(articles(spark, sf_dir))


@check("quality_totals", f"""with i as ({_issues_sql()}) select count(distinct a.file) as files,
  count(distinct a.file) filter (i.file is null) as valid, count(distinct a.file) filter (i.file is not null) as invalid
  from articles a left join (select distinct file from i) i using (file)""", ["articles"])
def quality_totals(spark, sf_dir):
    return Q.totals(Q.verdicts(articles(spark, sf_dir)))


_ISSUE_JSON = ("'{\"type\":' || to_json(type) || ',\"value\":' || to_json(value) || ',\"count\":' || count || ',\"details\":' "
               "|| to_json(details) || '}'")


@check("quality_report_json", f"""with i as ({_issues_sql()}),
  l as (select file, string_agg({_ISSUE_JSON}, ',' order by type, value) as issues from i group by file)
  select file, '{{"file":' || to_json(file) || ',"ok":' || case when l.issues is null then 'true' else 'false' end || ',"issues":['
    || coalesce(l.issues, '') || '],"counts":{{"rows":' || n || ',"columns":8}}}}' as report
  from (select file, count(*) as n from articles group by file) left join l using (file)""", ["articles"])
def quality_report_json(spark, sf_dir):
    return Q.report_json(articles(spark, sf_dir))


# --- repair ----------------------------------------------------------------------------------

def _mended():
    strip = lambda c: (f"case when {c} is null or {c} = '' or {S.strip(c)} in ('NULL', 'None', 'nan') then {c} else "  # noqa: E731
                       f"{S.strip(S.sub(S.sub(c, '<[^>]+>', ' '), SPACE + '{2,}', ' '))} end")
    return f"""scraped as (select *, {normalize_sql('scraping_date', f"timestamp '{AS_OF}'")} as sd from articles),
 published as (select *, {normalize_sql('publication_date', f"coalesce(cast(sd as timestamp), timestamp '{AS_OF}')")} as pd from scraped),
 mended as (select source, url, file, seq, language, pd, sd, title as t0, section as s0, full_text as f0,
   {strip('title')} as title, {strip('section')} as sec, {strip('full_text')} as full_text,
   coalesce(pd, sd, 'NULL') as publication_date, coalesce(sd, 'NULL') as scraping_date from published),
 filled as (select *, case when sec is null or {S.strip('sec')} in ('', 'None', 'nan') then 'Sin seccion' else sec end as section,
   (sec is null or {S.strip('sec')} in ('', 'None', 'nan')) as fill,
   (title is null or {S.strip('title')} in ('', 'None', 'nan')) as untitled from mended),
 kept as (select * from filled where not untitled qualify row_number() over (partition by url order by file, seq) = 1)"""


@check("repair_articles", f"with {_mended()} select {', '.join(f'coalesce({c}, {S.q(NULL_TEXT)}) as {c}' for c in ARTICLE_COLUMNS)} from kept",
       ["articles"])
def repair_articles(spark, sf_dir):
    return R.repair(articles(spark, sf_dir), AS_OF)


@check("repair_stats", f"""with {_mended()} select count(*) as initial, count(*) filter (pd is null and sd is null) as pub_date_set_null,
  count(*) filter (pd is null and sd is not null) as pub_date_fallback_to_scraping,
  count(*) filter (regexp_matches(t0, '<[^>]+>')) as html_title, count(*) filter (regexp_matches(s0, '<[^>]+>')) as html_section,
  count(*) filter (regexp_matches(f0, '<[^>]+>')) as html_full_text, count(*) filter (fill) as section_filled,
  count(*) filter (untitled) as dropped_no_title, count(*) filter (not untitled) - (select count(*) from kept) as deduped,
  (select count(*) from kept) as final from filled""", ["articles"])
def repair_stats(spark, sf_dir):
    return R.repair_stats(articles(spark, sf_dir), AS_OF)
