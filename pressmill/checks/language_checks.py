"""Language profiles and detection over the labelled documents."""

from pyspark.sql import functions as F

from pressmill.checks.date_checks import AS_OF
from pressmill.checks.fixtures import articles, table
from pressmill.checks.registry import check
from pressmill.functions import language as L
from pressmill.operators import gate as G

GRAMS = """grams as (select doc_id, lang, concat(a, b, c) as gram from (select doc_id, lang,
   unnest(k) as a, unnest(k[2:]) as b, unnest(k[3:]) as c from (select doc_id, lang, string_split(lower(text), '') as k from documents))
   where c is not null),
 counts as (select lang, gram, count(*) as n from grams where lang is not null group by 1, 2),
 profiles as (select lang, gram, row_number() over (partition by lang order by n desc, gram) as rank, n from counts
   qualify rank <= 300)"""
SCORED = GRAMS + """, tops as (select doc_id, gram, row_number() over (partition by doc_id order by count(*) desc, gram) as rank
   from grams group by 1, 2 qualify rank <= 300),
 langs as (select distinct lang from profiles),
 scores as (select t.doc_id, l.lang, sum(case when p.rank is null then 300 else abs(t.rank - p.rank) end) as distance
   from tops t cross join langs l left join profiles p on p.lang = l.lang and p.gram = t.gram group by 1, 2),
 best as (select doc_id, lang from scores qualify row_number() over (partition by doc_id order by distance, lang) = 1)"""


@check("language_profiles", f"with {GRAMS} select lang, gram, rank, n from profiles")
def language_profiles(spark, sf_dir):
    return L.learn(table(spark, sf_dir, "documents"))


@check("language_detect", f"""with {SCORED} select d.doc_id, d.lang, coalesce(b.lang, 'es') as detected from documents d left join best b using (doc_id)""")
def language_detect(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    detect = L.detector(L.learn(docs))
    return docs.select("doc_id", "lang", detect(F.col("text")).alias("detected"))


_TEXTS = "texts as (select seq as doc_id, full_text as text, language as lang from articles), "


@check("enrich_language", f"""with {_TEXTS + SCORED.replace('from documents', 'from texts')}
  select seq, '{AS_OF}' as scraping_date, case when a.language is not null then a.language else coalesce(b.lang, 'es') end as language
  from articles a left join best b on a.seq = b.doc_id""", ["articles"])
def enrich_language(spark, sf_dir):
    df = articles(spark, sf_dir)
    detect = L.detector(L.learn(df, "full_text", "language"))
    return G.enrich(df, AS_OF, detector=detect).select("seq", "scraping_date", "language")
