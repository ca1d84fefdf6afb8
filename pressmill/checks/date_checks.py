"""Date scalars over texts rendered from the document ids."""

from pyspark.sql import functions as F

from pressmill.checks import sqltext as S
from pressmill.checks.fixtures import articles, table
from pressmill.checks.registry import check
from pressmill.functions import dates as D

ES = list(D.MONTHS_ES)
EN = list(D.MONTHS_EN)[:12]
AS_OF = "2024-06-15 12:00:00"


def _pick(values, n):
    return f"case doc_id % {n} " + " ".join(f"when {i} then {S.q(v)}" for i, v in enumerate(values)) + " end"


_D, _D2 = "cast(1 + doc_id % 33 as string)", "lpad(cast(1 + doc_id % 31 as string), 2, '0')"
_M, _Y = "lpad(cast(1 + doc_id % 13 as string), 2, '0')", "cast(1998 + doc_id % 30 as string)"
_MES = _pick(ES + ["brumario"], 13)
_MON = _pick([m[:3] for m in ES] + ["xyz"], 13)
_MONTH = _pick(EN + ["Brumaire"], 13)
_HH, _MI = "lpad(cast(doc_id % 26 as string), 2, '0')", "lpad(cast(doc_id % 60 as string), 2, '0')"

SPANISH = f"""case doc_id % 11
  when 0 then concat({_D}, ' de ', {_MES}, ' de ', {_Y})
  when 1 then concat('Publicado: ', {_D}, ' de ', upper({_MES}), ' de ', {_Y}, ', ', {_HH}, ':', {_MI}, ' PM')
  when 2 then concat({_D}, ' de ', {_MES}, ' de ', {_Y}, ' - ', {_HH}, ':', {_MI})
  when 3 then concat({_D2}, ' ', {_MES}, ' ', {_Y})
  when 4 then concat({_MES}, ' ', {_D}, ', ', {_Y})
  when 5 then concat('Lunes, ', {_D}, ' ', {_MES}, ' ', {_Y})
  when 6 then concat('Miércoles, ', {_D}, ' de ', {_MES}, ' de ', {_Y})
  when 7 then concat({_D}, ' de ', {_MON}, '. ', {_Y}, ' | 1:35 am')
  when 8 then concat({_D}, ' ', {_MES}, ', ', {_Y})
  when 9 then concat({_Y}, '-', {_M}, '-', {_D2}, 'T01:35:25')
  else 'sin dato' end"""
MIXED = f"""case doc_id % 8
  when 0 then concat({_MON}, ' ', {_D}, ', ', {_Y})
  when 1 then concat({_MONTH}, ' ', {_D}, ', ', {_Y})
  when 2 then concat({_D}, ' ', {_MON}, ', ', {_Y})
  when 3 then concat({_D}, ' ', {_MES}, ', ', {_Y})
  when 4 then concat({_D}, ' de ', {_MES}, ' de ', {_Y})
  when 5 then concat('el ', {_Y}, '-', {_M}, '-', {_D2}, ' hoy')
  when 6 then concat(upper(substring({_MONTH}, 1, 3)), ' ', {_D2}, ', ', {_Y})
  else 'never' end"""
NUMERIC = f"""case doc_id % 7
  when 0 then concat({_D2}, '/', {_M}, '/', substring({_Y}, 3, 2))
  when 1 then concat({_D2}, '/', {_M}, '/', {_Y})
  when 2 then concat({_D2}, '-', {_M}, '-', {_Y})
  when 3 then concat({_D2}, '-', {_M}, '-', {_Y}, ' ', {_HH}, ':', {_MI})
  when 4 then concat({_Y}, '-', {_M}, '-', {_D2})
  when 5 then concat(' ', {_D}, '/', {_M}, '/', {_Y})
  else 'nada' end"""
ISO = f"""case doc_id % 8
  when 0 then concat({_Y}, '-', {_M}, '-', {_D2}, 'T', {_HH}, ':', {_MI}, ':26.012Z')
  when 1 then concat({_Y}, '-', {_M}, '-', {_D2}, 'T', {_HH}, ':', {_MI}, ':24-06:00')
  when 2 then concat({_Y}, '-', {_M}, '-', {_D2}, ' ', {_HH}, ':', {_MI})
  when 3 then concat({_Y}, '-', {_M}, '-', {_D2})
  when 4 then concat(' ', {_Y}, '-', {_M}, '-', {_D2}, 'T', {_HH}, ':', {_MI}, ':00+02:00')
  when 5 then concat({_Y}, '-', {_M}, '-', {_D2}, 'T', {_HH}, ':', {_MI}, ':00 +02:00')
  when 6 then 'yesterday at noon'
  else concat({_Y}, '-', {_M}, '-', {_D2}, 'T', {_HH}, ':', {_MI}, ':59') end"""


def _raw(spark, sf_dir, text):
    return table(spark, sf_dir, "documents").select("doc_id", F.expr(text).alias("raw"))


def _from(text):
    return f"(select doc_id, {text} as raw from documents)"


def _register(name, text, columns):
    """``columns``: output name -> (function, SQL over ``raw``)."""
    sql = "select doc_id, raw, " + ", ".join(f"{s} as {n}" for n, (_, s) in columns.items()) + f" from {_from(text)}"

    @check(name, sql)
    def query(spark, sf_dir):
        return _raw(spark, sf_dir, text).select(
            "doc_id", "raw", *[f(F.col("raw")).alias(n) for n, (f, _) in columns.items()])


# --- oracle pieces ----------------------------------------------------------------------

_W = r"([\p{L}\p{M}\p{N}_]+)"
_LOW = f"lower({S.strip('raw')})"
_LOWC = f"lower({S.collapse('raw')})"
_DE = rf"([0-9]{{1,2}})\s+de\s+{_W}\s+de\s+([0-9]{{4}})"


def _month(x, months):
    return f"case {x} " + " ".join(f"when {S.q(k)} then {v}" for k, v in months.items()) + " end"


def _named(x, pattern, at, months=D.MONTHS_ES):
    y, m, d = (S.grp(x, pattern, i) for i in at)
    return (f"({y} || '-' || lpad(cast({_month(m, months)} as string), 2, '0') || '-' || lpad({d}, 2, '0'))")


def _stamp(x, pattern, at, months=D.MONTHS_ES, clock=None):
    y, m, d = (S.grp(x, pattern, i) for i in at)
    hh, mm = (S.grp(x, pattern, i) for i in clock) if clock else ("'0'", "'0'")
    return (f"try_strptime({y} || '-' || cast({_month(m, months)} as string) || '-' || {d} || ' ' || {hh} || ':' || "
            f"{mm} || ':00', '{S.DATE_FMT}')")


_ISO_AT = S.grp("raw", r"([0-9]{4}-[0-9]{2}-[0-9]{2})")
_ES_LONG = _named(_LOW, _DE, (3, 2, 1))
_TIMED = _DE + r",?\s+([0-9]{1,2}):([0-9]{2})"
_DASHT = _DE + r"\s*-\s*([0-9]{1,2}):([0-9]{2})"
_WEEK = f"regexp_replace({_LOWC}, '^[\\p{{L}}\\p{{M}}\\p{{N}}_]+,?\\s*', '')"
_SHORT = rf"([0-9]{{1,2}})\s+de\s+{_W}\.?\s+([0-9]{{4}})"
_TOK = f"string_split({S.collapse("replace(raw, ',', '')")}, ' ')"

_register("date_es_forms", SPANISH, {
    "long_form": (D.es_long, _ES_LONG),
    "with_time": (D.es_long_time, f"""coalesce({_named(_LOWC, _TIMED, (3, 2, 1))} || ' ' || lpad({S.grp(_LOWC, _TIMED, 4)}, 2, '0')
        || ':' || {S.grp(_LOWC, _TIMED, 5)} || ':00', {_named(_LOWC, _DE, (3, 2, 1))})"""),
    "dash_time": (D.es_dash_time, f"""coalesce({S.show(_stamp(_LOW, _DASHT, (3, 2, 1), clock=(4, 5)))},
        substring({S.show(_stamp(_LOW, _DE, (3, 2, 1)))}, 1, 10))"""),
    "plain": (D.es_plain, f"coalesce({_named(_LOW, rf'([0-9]{{1,2}})\s+{_W}\s+([0-9]{{4}})', (3, 2, 1))}, {_ES_LONG})"),
    "month_first": (D.es_month_first, f"coalesce({_named(_LOW, rf'{_W}\s+([0-9]{{1,2}}),?\s+([0-9]{{4}})', (3, 1, 2))}, {_ES_LONG})"),
    "month_first_strict": (D.es_month_first_strict,
        f"coalesce({_named(_LOW, rf'^{_W}\s+([0-9]{{1,2}}),\s+([0-9]{{4}})', (3, 1, 2))}, {_LOW})"),
    "weekday": (D.es_weekday, _named(_WEEK, rf"([0-9]{{1,2}})\s+(?:de\s+)?{_W}\s+(?:de\s+)?([0-9]{{4}})", (3, 2, 1))),
    "short_month": (D.es_short_month, f"""case when regexp_matches(raw, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') then substring(raw, 1, 10)
        else coalesce({S.grp('raw', _SHORT, 3)} || '-' || lpad(cast(coalesce({_month(f"lower(substring({S.grp('raw', _SHORT, 2)}, 1, 3))",
        D.MONTHS_ES_SHORT)}, 1) as string), 2, '0') || '-' || lpad({S.grp('raw', _SHORT, 1)}, 2, '0'), 'Sin fecha') end"""),
    "by_tokens": (D.es_tokens, f"""coalesce({_TOK}[3] || '-' || lpad(cast(coalesce({_month(f'lower({_TOK}[2])', D.MONTHS_ES)}, 1) as string), 2, '0')
        || '-' || lpad(cast(try_cast({_TOK}[1] as int) as string), 2, '0'), raw)"""),
})

_MDY = r"([0-9]{1,2}),\s*([0-9]{4})"
_DMY = rf"([0-9]{{1,2}})\s+{_W},?\s+([0-9]{{4}})"
_EN_SHORT = {k: v for k, v in D.MONTHS_EN.items() if len(k) == 3}
_register("date_mixed_forms", MIXED, {
    "short_name": (D.mixed_short, f"""coalesce({_named(_LOWC, r'([\p{L}\p{M}\p{N}_]{3})\s+' + _MDY, (3, 1, 2), D.MONTHS_MIXED)}, {_ISO_AT}, '')"""),
    "english": (D.english_long, f"""coalesce({_named(_LOWC, r'([a-z]+)\s+([0-9]{1,2}),?\s*([0-9]{4})', (3, 1, 2), D.MONTHS_EN)}, {_ISO_AT}, '')"""),
    "day_first_name": (D.mixed_day_first, f"""coalesce({S.grp(_LOWC, _DMY, 3)} || '-' || lpad(cast(coalesce(
        {_month(f"substring({S.grp(_LOWC, _DMY, 2)}, 1, 3)", D.MONTHS_MIXED)}, {_month(S.grp(_LOWC, _DMY, 2), D.MONTHS_ES)}) as string), 2, '0')
        || '-' || lpad({S.grp(_LOWC, _DMY, 1)}, 2, '0'), {_named(_LOWC, _DE, (3, 2, 1))}, {_ISO_AT}, '')"""),
    "english_short": (D.english_short, f"""coalesce(strftime({_stamp('lower(raw)', r'^([a-z]{3})\s+([0-9]{1,2}),\s+([0-9]{4})$', (3, 1, 2), _EN_SHORT)},
        '%Y-%m-%d'), raw)"""),
})

_SL = r"([0-9]{1,2})/([0-9]{1,2})/([0-9]{2,4})"
_SL4 = r"([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})"
_DA = r"([0-9]{1,2})-([0-9]{1,2})-([0-9]{4})"


def _year(pattern):
    y = f"cast({S.grp('raw', pattern, 3)} as int)"
    return f"lpad(cast(case when {y} < 100 then {y} + 2000 else {y} end as string), 4, '0')"


def _numeric(pattern, m, d):
    return (f"{_year(pattern)} || '-' || lpad({S.grp('raw', pattern, m)}, 2, '0') || '-' || "
            f"lpad({S.grp('raw', pattern, d)}, 2, '0')")


def _ranged(pattern, late, x="raw"):
    y, m, d = (f"cast({S.grp(x, pattern, i)} as int)" for i in (3, 2, 1))
    cond = f"{m} between 1 and 12 and {d} between 1 and 31" + (f" and {y} > 2000" if late else "")
    return (f"case when {cond} then {S.grp(x, pattern, 3)} || '-' || lpad({S.grp(x, pattern, 2)}, 2, '0') || '-' || "
            f"lpad({S.grp(x, pattern, 1)}, 2, '0') end")


_FIRST = "split_part(raw, ' ', 1)"
_DASHED = "coalesce({}, {}, '')"
_DASH_FIRST = _DASHED.format(_ranged(_DA, True, _FIRST), S.grp(_FIRST, r"([0-9]{4}-[0-9]{2}-[0-9]{2})"))
_register("date_numeric_forms", NUMERIC, {
    "day_first": (D.day_first, f"coalesce({_numeric(_SL, 2, 1)}, '')"),
    "month_first": (D.month_first, f"coalesce({_numeric(_SL, 1, 2)}, '')"),
    "dashed": (D.dashed, _DASHED.format(_ranged(_DA, True), _ISO_AT)),
    "dashed_time": (D.dashed_time, f"""case when {_DASH_FIRST} <> '' and split_part(raw, ' ', 2) <> ''
        then {_DASH_FIRST} || ' ' || split_part(raw, ' ', 2) || ':00' else {_DASH_FIRST} end"""),
    "any_numeric": (D.any_numeric, f"coalesce({_ranged(_SL4, False)}, {_ranged(_DA, True)}, {_ISO_AT}, '')"),
    "slashed_strict": (D.slashed_strict, """coalesce(strftime(case when regexp_full_match(raw, '[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}')
        then try_strptime(raw, '%d/%m/%Y') end, '%Y-%m-%d'), raw)"""),
})

_ISO_RE = (r"^([0-9]{4}-[0-9]{2}-[0-9]{2})(?:[T ]([0-9]{2}:[0-9]{2})(:[0-9]{2})?(?:[.,][0-9]{1,9})?)?"
           r"(Z|[+-][0-9]{2}:?[0-9]{2})?$")


def _iso_ts(x):
    text = (f"{S.grp(x, _ISO_RE, 1)} || ' ' || coalesce({S.grp(x, _ISO_RE, 2)}, '00:00') || "
            f"coalesce({S.grp(x, _ISO_RE, 3)}, ':00')")
    return f"try_strptime({text}, '{S.DATE_FMT}')"


def _iso_min(x, default):
    z = S.grp(x, _ISO_RE, 4)
    digits = f"replace(substring({z}, 2), ':', '')"
    return (f"case when {z} is null then {default} when {z} = 'Z' then 0 else (case when {z} like '-%' then -1 else 1 end) * "
            f"(cast(substring({digits}, 1, 2) as int) * 60 + cast(substring({digits}, 3, 2) as int)) end")


def _iso_shift(x, plus):
    return S.show(f"({_iso_ts(x)} + to_minutes(({plus}) - ({_iso_min(x, -360)})))")


_T, _TT = S.strip("raw"), f"replace({S.strip('raw')}, ' ', '')"
_register("date_iso_local", ISO, {
    "local_text": (D.iso_local, f"coalesce({_iso_shift(_T, -360)}, substring(raw, 1, 10))"),
    "wall_clock": (D.iso_wall_clock, S.show(_iso_ts(_T))),
})
_register("date_iso_utc", ISO, {"utc_text": (D.iso_utc, f"coalesce({_iso_shift(_TT, 0)}, '')")})

RELATIVE = """case doc_id % 9 when 0 then concat('Hace ', cast(doc_id % 400 as string), ' horas') when 1 then 'hace 1 dia'
  when 2 then concat('publicado hace  ', cast(doc_id % 90 as string), ' días, por') when 3 then concat('hace ', cast(doc_id % 9 as string), ' semanas')
  when 4 then concat('HACE ', cast(doc_id % 30 as string), ' MESES') when 5 then concat('hace ', cast(doc_id % 12 as string), ' años')
  when 6 then concat('HACE ', cast(doc_id % 5 as string), case doc_id % 2 when 0 then ' DÍAS' else ' AÑOS' end) when 7 then concat('hace ', cast(doc_id % 7 as string), ' dias') else 'hoy' end"""
_REL_RE = r"(?i)hace\s+([0-9]+)\s+(horas?|días?|dias|semanas?|mes(?:es)?|años?)"


def relative_sql(x, ref):
    unit = f"lower({S.grp(x, _REL_RE, 2)})"
    hours = (f"case when {unit} like 'hora%' then 1 when {unit} like 'd%' then 24 when {unit} like 'semana%' then 168 "
             f"when {unit} like 'mes%' then 720 else 8760 end")
    return f"({ref} - to_hours(cast({S.grp(x, _REL_RE, 1)} as bigint) * {hours}))"


_register("date_relative", RELATIVE, {
    "resolved": (lambda c: D.show(D.relative_moment(c, F.lit(AS_OF).cast("timestamp_ntz"))),
                 S.show(relative_sql("raw", f"timestamp '{AS_OF}'"))),
})


def normalize_sql(x, ref):
    t = S.strip(x)
    forms = [(r"^([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})\s+([0-9]{1,2}):([0-9]{1,2}):([0-9]{1,2})$", (1, 2, 3, 4, 5, 6)),
             (r"^([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})\s+([0-9]{1,2}):([0-9]{1,2})$", (1, 2, 3, 4, 5)),
             (r"^([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})$", (1, 2, 3)),
             (r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})\s+([0-9]{1,2}):([0-9]{1,2}):([0-9]{1,2})$", (3, 2, 1, 4, 5, 6)),
             (r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})$", (3, 2, 1)),
             (r"^([0-9]{1,2})-([0-9]{1,2})-([0-9]{4})$", (3, 2, 1))]
    tries = []
    for pattern, at in forms:
        g = [S.grp(t, pattern, i) for i in at] + ["'0'"] * (6 - len(at))
        tries.append(f"try_strptime({g[0]} || '-' || {g[1]} || '-' || {g[2]} || ' ' || {g[3]} || ':' || {g[4]} || ':' || {g[5]}, '{S.DATE_FMT}')")
    low = f"lower({t})"
    tries.append(_stamp(low, rf"^{_W}\s+([0-9]{{1,2}}),?\s+([0-9]{{4}})$", (3, 1, 2)))
    tries.append(_stamp(low, "^" + _DE + "$", (3, 2, 1)))
    tries.append(relative_sql(t, ref))
    return (f"case when {t} in ('', 'NULL', 'None', 'nan', 'NaT', 'Sin fecha') then null else "
            f"{S.show('coalesce(' + ', '.join(tries) + ')')} end")


@check("date_normalize", f"""select seq, publication_date as raw, {normalize_sql('publication_date', f"timestamp '{AS_OF}'")}
  as normalized from articles""", ["articles"])
def date_normalize(spark, sf_dir):
    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    return articles(spark, sf_dir).select(
        "seq", F.col("publication_date").alias("raw"), D.normalize(F.col("publication_date"), as_of).alias("normalized"))
