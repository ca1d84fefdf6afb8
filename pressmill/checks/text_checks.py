"""Text, slug and URL scalars over the given documents and pages."""

from pyspark.sql import functions as F

from pressmill.checks import sqltext as S
from pressmill.checks.fixtures import articles, table
from pressmill.checks.registry import check
from pressmill.functions import text as X
from pressmill.functions import urls as U

SPACED = "replace(text, '. ', concat('.', chr(9), '  ', chr(10), chr(10), chr(10), chr(160), chr(10)))"
MARKED = ("concat('<p class=\"x\">', replace(text, ' la ', ' <b>la|</b> &eacute;&#233;&amp;quot; ?? “x” \" '), "
          "'</p><script>var a = 1;</script><!-- n -->')")
HEADING = "concat('+ ', text, ' Política  Única ')"


def _docs(spark, sf_dir, raw):
    return table(spark, sf_dir, "documents").select("doc_id", F.expr(raw).alias("raw"))


@check("text_clean_block", f"""select doc_id, {S.strip(S.sub(S.sub(SPACED, "[ " + chr(9) + "]+", " "), chr(10) + "{3,}", chr(10) * 2))}
  as cleaned from documents""")
def text_clean_block(spark, sf_dir):
    return _docs(spark, sf_dir, SPACED).select("doc_id", X.clean_block(F.col("raw")).alias("cleaned"))


@check("text_clean_line", f"""select doc_id, coalesce({S.collapse("raw")}, '') as cleaned from
  (select doc_id, case when doc_id % 9 = 1 then null else {SPACED} end as raw from documents)""")
def text_clean_line(spark, sf_dir):
    raw = f"case when doc_id % 9 = 1 then null else {SPACED} end"
    return _docs(spark, sf_dir, raw).select("doc_id", X.clean_line(F.col("raw")).alias("cleaned"))


def _strip_sql(c):
    done = S.strip(S.sub(S.sub(c, "<[^>]+>", " "), S.SPACE + "{2,}", " "))
    return f"case when {c} is null or {c} = '' or {S.strip(c)} in ('NULL', 'None', 'nan') then {c} else {done} end"


@check("text_strip_html", f"""select seq, {_strip_sql("title")} as title, {_strip_sql("section")} as section,
  {_strip_sql("full_text")} as full_text from articles""", ["articles"])
def text_strip_html(spark, sf_dir):
    return articles(spark, sf_dir).select(
        "seq", *[X.strip_markup(F.col(c)).alias(c) for c in ("title", "section", "full_text")])


@check("text_clean_strict", f"select doc_id, {S.clean_strict('raw')} as cleaned from (select doc_id, {MARKED} as raw from documents)")
def text_clean_strict(spark, sf_dir):
    return _docs(spark, sf_dir, MARKED).select("doc_id", X.clean_strict(F.col("raw")).alias("cleaned"))


def _slug_sql(x):
    return f"trim({S.sub(f'translate({x}, ' + S.q('áéíóú') + ', ' + S.q('aeiou') + ')', S.SPACE + '+', '-')}, '-')"


@check("section_slug", f"""select doc_id, {_slug_sql(f"lower({S.collapse('raw')})")} as slug,
  {_slug_sql("regexp_replace(lower(" + S.collapse('raw') + "), '^[+] *', '')")} as slug_no_plus
  from (select doc_id, {HEADING} as raw from documents)""")
def section_slug(spark, sf_dir):
    raw = F.col("raw")
    return _docs(spark, sf_dir, HEADING).select(
        "doc_id", X.section_slug(raw).alias("slug"), X.section_slug(raw, drop_plus=True).alias("slug_no_plus"))


# --- URLs -----------------------------------------------------------------------------

HREF = ("case page_id % 5 when 0 then regexp_replace(url, '^https?://[^/]*', '') when 1 then url "
        "when 2 then concat('nota-', cast(page_id as string)) when 3 then concat('/n/', cast(page_id as string)) "
        "else concat(url, '#f?x=1') end")


@check("url_absolute", f"""select page_id,
  case when href like 'http%' then href when href like '/%' then concat('https://base.example.org', href) else href end as kept,
  case when href like 'http%' then href when href like '/%' then concat('https://base.example.org', href)
       else concat('https://base.example.org/', href) end as joined,
  case when href like 'http%' then href else concat('https://base.example.org', href) end as appended
  from (select page_id, {HREF} as href from pages)""")
def url_absolute(spark, sf_dir):
    base, href = "https://base.example.org", F.col("href")
    return table(spark, sf_dir, "pages").select("page_id", F.expr(HREF).alias("href")).select(
        "page_id", U.absolute(href, base).alias("kept"), U.absolute(href, base, "join").alias("joined"),
        U.absolute(href, base, "append").alias("appended"))


CANON = "regexp_replace({}, '[?#].*', '')"


@check("url_canonical", f"select page_id, {CANON.format('url')} as canonical from pages")
def url_canonical(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.canonical(F.col("url")).alias("canonical"))


@check("url_slug", f"select page_id, split_part(regexp_replace({CANON.format('url')}, '/+$', ''), '/', -1) as slug from pages")
def url_slug(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.slug(F.col("url")).alias("slug"))


SECTIONED = ("concat('https://site.example.org', case page_id % 9 when 0 then '/categorias/Nacionales/' "
             "when 1 then '/categorias/internacionales/' when 2 then '/am-deportes/' when 3 then '/mundo/' "
             "when 4 then '/2024/05/vida-sana/' when 5 then '/tecnologia/' when 6 then '/categorias/viral/' "
             "when 7 then '/seguridad/' else '/' end, cast(page_id as string), '-', lower(split_part(url, '/', 4)))")


def _rules_sql(x, rules):
    whens = " ".join(f"when contains({x}, {S.q(a)}) then {S.q(b)}" for a, b in rules)
    return f"case {whens} else 'general' end"


def _heading_sql(list_expr):
    words = (f"list_transform(regexp_extract_all(replace(({list_expr})[1], '-', ' '), '([\\p{{L}}]+|[^\\p{{L}}]+)'), "
             "lambda w: concat(upper(w[1]), lower(w[2:])))")
    return f"coalesce(array_to_string({words}, ''), 'Noticias')"


_PARTS = f"list_filter(string_split(regexp_replace({CANON.format('u')}, '^[a-z]+://[^/]*', ''), '/'), lambda s: s <> '')"


@check("section_from_url", f"""select page_id, {_rules_sql('lower(u)', U.AMPRENSA_SECTIONS)} as ruled,
  {_rules_sql('u', U.CRC_SECTIONS)} as ruled_exact, {_heading_sql(_PARTS)} as first_segment,
  {_heading_sql(f"list_filter({_PARTS}, lambda s: not regexp_full_match(s, '[0-9]+'))")} as first_named
  from (select page_id, {SECTIONED} as u from pages)""")
def section_from_url(spark, sf_dir):
    u = F.col("u")
    return table(spark, sf_dir, "pages").select("page_id", F.expr(SECTIONED).alias("u")).select(
        "page_id", U.section_by_rules(F.lower(u), U.AMPRENSA_SECTIONS).alias("ruled"),
        U.section_by_rules(u, U.CRC_SECTIONS).alias("ruled_exact"),
        U.section_by_path(u).alias("first_segment"), U.section_by_path(u, skip_numbers=True).alias("first_named"))


_NAMES = [r[0] for r in U.URL_RULES]
_CASE = "case page_id % {n} {whens} end"
RULE_OF = _CASE.format(n=len(_NAMES), whens=" ".join(f"when {i} then {S.q(n)}" for i, n in enumerate(_NAMES)))
PREFIX_OF = _CASE.format(n=len(_NAMES), whens=" ".join(
    f"when {i} then {S.q(r[1].replace('{year}', '2024'))}" for i, r in enumerate(U.URL_RULES)))
# every eleventh page of an outlet with section addresses stands for one of its sections
BASE_OF = "case " + " ".join(f"when {RULE_OF} = {S.q(n)} and page_id % 11 = 0 then {S.q(b[-1].rstrip('/'))}" for n, b in U.SECTION_BASES.items()) + " end"
CANDIDATE = (f"coalesce({BASE_OF}, concat(case when page_id % 17 = 0 then 'https://other.example.org/' else {PREFIX_OF} end, "
             "case page_id % 7 when 0 then '' when 1 then 'category/' when 2 then 'vida/' when 3 then '2024/05/' "
             "when 4 then 'page/2/' when 5 then 'una-nota-' else 'pais/story/en/' end, "
             "regexp_replace(url, '^https?://[^/]*/', '')))")


def _rule_sql():
    lines = []
    for source, prefix, excluded, least, extra in U.URL_RULES:
        prefix = prefix.replace("{year}", "2024")
        base = "https://sinartdigital.com/trecenoticias/" if source == "sinartdigital" else prefix
        low = "lower(u)" if extra == "hyphenated" else "u"
        path = f"replace(u, {S.q(base)}, '')"
        parts = f"list_filter(string_split({path}, '/'), lambda s: s <> '')"
        cond = [f"starts_with(u, {S.q(prefix)})"] + [f"not contains({low}, {S.q(e)})" for e in excluded]
        cond.append(f"len({parts}) >= {least}")
        cond += [f"concat(rtrim(u, '/'), '/') <> {S.q(b)}" for b in U.SECTION_BASES.get(source, ())]
        cond += {
            "first_not_digits": [f"not regexp_full_match({parts}[1], '[0-9]+')"],
            "has_story": ["contains(u, '/story/')"],
            "hyphenated": [f"contains({path}, '-')"],
            "first_not_page": [f"not starts_with({parts}[1], 'page')"],
            "long_slug": [f"length(trim({path}, '/')) >= 5"],
        }.get(extra, [])
        lines.append(f"when {S.q(source)} then {' and '.join(cond)}")
    return "coalesce(case source " + " ".join(lines) + " end, false)"


@check("article_url_filter", f"""
select page_id, source, u as url, {_rule_sql()} as is_article,
  regexp_matches(u, '/[0-9]{{4}}/[0-9]{{2}}/') as year_month, contains(lower(u), '/noticia/') as noticia,
  contains(u, '/story/') as story, regexp_matches(u, '/[0-9]{{3,}}-') as numbered_slug,
  starts_with(href, '/') and length(href) > 10 and {" and ".join(f"not contains(href, {S.q(e)})" for e in U.RELATIVE_EXCLUDED)} as relative_ok
  from (select page_id, {RULE_OF} as source, {CANDIDATE} as u, {HREF} as href from pages)""")
def article_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(
        "page_id", F.expr(RULE_OF).alias("source"), F.expr(CANDIDATE).alias("url"), F.expr(HREF).alias("href"))
    # the rule table is a constant of a few dozen rows
    rules = F.broadcast(U.rules_frame(spark, 2024))
    url = F.col("url")
    return pages.join(rules, "source").select(
        "page_id", "source", "url", U.is_article(url).alias("is_article"),
        *[url.rlike(p).alias(n) for n, p in U.URL_PATTERNS.items()],
        U.is_relative_article(F.col("href")).alias("relative_ok"))
