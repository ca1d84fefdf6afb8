"""Date texts to canonical date texts, as column expressions.

Everything works on wall-clock values (TIMESTAMP_NTZ) or text, so results do not depend
on the session time zone. "Now" never appears: a reference time is always an argument.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressmill.functions.text import SPACE, WORD, collapse, literal_map, strip

# Month names.
MONTHS_ES = {
    "enero": 1, "febrero": 2, "marzo": 3, "abril": 4, "mayo": 5, "junio": 6, "julio": 7,
    "agosto": 8, "septiembre": 9, "octubre": 10, "noviembre": 11, "diciembre": 12,
}
MONTHS_ES_SHORT = {
    "ene": 1, "feb": 2, "mar": 3, "abr": 4, "may": 5, "jun": 6,
    "jul": 7, "ago": 8, "sep": 9, "oct": 10, "nov": 11, "dic": 12,
}
MONTHS_EN = {
    "january": 1, "february": 2, "march": 3, "april": 4, "may": 5, "june": 6, "july": 7,
    "august": 8, "september": 9, "october": 10, "november": 11, "december": 12,
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "jun": 6, "jul": 7, "aug": 8, "sep": 9,
    "oct": 10, "nov": 11, "dec": 12,
}
MONTHS_MIXED = {
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "may": 5, "jun": 6, "jul": 7, "aug": 8,
    "sep": 9, "oct": 10, "nov": 11, "dec": 12, "ene": 1, "abr": 4, "ago": 8,
}
# Relative dates ("hace 3 días") in hours; months count 30 days, years 365.
RELATIVE_UNITS = {
    "hora": 1, "horas": 1, "día": 24, "días": 24, "dias": 24, "semana": 168, "semanas": 168,
    "mes": 720, "meses": 720, "año": 8760, "años": 8760,
}
RELATIVE = (r"hace" + SPACE + r"+(\d+)" + SPACE
            + r"+(horas?|días?|dias|semanas?|mes(?:es)?|años?)")
# The whole-text forms tried in order, each with its storage-form rewriting.
_CLOCK = SPACE + r"+(\d{1,2}):(\d{1,2}):(\d{1,2})$"
STORED = r"^(\d{4})-(\d{1,2})-(\d{1,2})" + _CLOCK
NUMERIC_FORMS = [
    (STORED, "$1-$2-$3 $4:$5:$6"),
    (r"^(\d{4})-(\d{1,2})-(\d{1,2})" + SPACE + r"+(\d{1,2}):(\d{1,2})$", "$1-$2-$3 $4:$5:0"),
    (r"^(\d{4})-(\d{1,2})-(\d{1,2})$", "$1-$2-$3 0:0:0"),
    (r"^(\d{1,2})/(\d{1,2})/(\d{4})" + _CLOCK, "$3-$2-$1 $4:$5:$6"),
    (r"^(\d{1,2})/(\d{1,2})/(\d{4})$", "$3-$2-$1 0:0:0"),
    (r"^(\d{1,2})-(\d{1,2})-(\d{4})$", "$3-$2-$1 0:0:0"),
]
SPANISH_FORMS = [
    (rf"^({WORD}+){SPACE}+(\d{{1,2}}),?{SPACE}+(\d{{4}})$", "$3-#-$2", 1),
    (rf"^(\d{{1,2}}){SPACE}+de{SPACE}+({WORD}+){SPACE}+de{SPACE}+(\d{{4}})$", "$3-#-$1", 2),
]
LOCAL_OFFSET_MINUTES = -360


def group(c, pattern, i) -> Column:
    """Capture group, or null when the pattern is not found."""
    return F.nullif(F.regexp_extract(c, pattern, i), F.lit(""))


def number(c, pattern, i) -> Column:
    return F.regexp_extract(c, pattern, i).try_cast("int")


def month_text(name, months) -> Column:
    """Two-digit month of a name; null for unknown names."""
    return F.try_element_at(literal_map({k: f"{v:02d}" for k, v in months.items()}), name)


def moment(text) -> Column:
    """Wall-clock value of ``y-m-d H:M:S`` text; impossible moments are null."""
    return text.try_cast("timestamp_ntz")


def show(ts) -> Column:
    return F.substring(ts.cast("string"), 1, 19)


def day_text(ts) -> Column:
    return F.substring(ts.cast("string"), 1, 10)


def padded(y, m, d) -> Column:
    """``yyyy-mm-dd`` text without range checks."""
    return F.concat(F.lpad(y.cast("string"), 4, "0"), F.lit("-"), F.lpad(m.cast("string"), 2, "0"),
                    F.lit("-"), F.lpad(d.cast("string"), 2, "0"))


def exact_moment(c) -> Column:
    """Moment of a text in the storage form; parts need not be padded, no blanks around."""
    return moment(F.when(c.rlike(STORED), c))


def _rewritten(c) -> Column:
    """Text in storage form if it has one of the numeric or Spanish whole-text forms.

    The forms exclude each other, so one chain of tests is enough."""
    low = F.lower(c)
    out = None
    for pattern, form in NUMERIC_FORMS:
        text = F.regexp_replace(c, pattern, form)
        out = F.when(c.rlike(pattern), text) if out is None else out.when(c.rlike(pattern), text)
    for pattern, form, name in SPANISH_FORMS:
        month = month_text(F.regexp_extract(low, pattern, name), MONTHS_ES)
        out = out.when(low.rlike(pattern), F.replace(F.regexp_replace(low, pattern, form), F.lit("#"), month))
    return out


def relative_moment(c, reference) -> Column:
    units = literal_map({k: str(v) for k, v in RELATIVE_UNITS.items()})
    c = F.lower(c)  # accented capitals included, which a case-insensitive pattern leaves out
    unit = F.try_element_at(units, F.regexp_extract(c, RELATIVE, 2))
    # 17 million hours or more would leave the calendar
    hours = F.try_multiply(F.regexp_extract(c, RELATIVE, 1).try_cast("bigint"), unit.cast("bigint")).try_cast("int")
    return reference - F.make_dt_interval(F.lit(0), F.when(hours < 17_000_000, hours))


def normalize(c, reference) -> Column:
    """Storage form of a date text, or null. ``reference`` anchors relative dates."""
    text = strip(c)
    return show(F.coalesce(moment(_rewritten(text)), relative_moment(text, reference)))


# --- ISO texts -------------------------------------------------------------------------

_ZONE = r"(Z|[+-]\d{2}:?\d{2})$"
_ISO = (r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:[.,]\d{1,9})?)?)?(?:Z|[+-]\d{2}:?\d{2})?$")


def _iso_moment(text) -> Column:
    return moment(F.when(text.rlike(_ISO), F.replace(F.regexp_replace(text, _ZONE, ""), F.lit(","), F.lit("."))))


def _iso_shifted(text, target_minutes) -> Column:
    """Moment moved from the text's own offset (local time without one) to the target's."""
    zone = F.translate(F.replace(F.regexp_extract(text, _ZONE, 1), F.lit("Z"), F.lit("0")), ":", "")
    n = zone.try_cast("int")
    own = F.coalesce(F.expr("0") + F.when(n < 0, -(F.floor(-n / 100) * 60 + (-n) % 100))
                     .otherwise(F.floor(n / 100) * 60 + n % 100), F.lit(LOCAL_OFFSET_MINUTES))
    shift = F.make_dt_interval(F.lit(0), F.lit(0), (F.lit(target_minutes) - own).cast("int"))
    return _iso_moment(text) + shift


def iso_local(c) -> Column:
    """ISO text in the newsroom's zone (UTC-6); unreadable texts give their first ten
    characters. A text without offset already is local time."""
    return F.coalesce(show(_iso_shifted(strip(c), LOCAL_OFFSET_MINUTES)), F.substring(c, 1, 10))


def iso_utc(c) -> Column:
    """ISO text in UTC, inner blanks ignored; unreadable texts give an empty text."""
    return F.coalesce(show(_iso_shifted(F.replace(strip(c), F.lit(" "), F.lit("")), 0)), F.lit(""))


def iso_wall_clock(c) -> Column:
    """ISO text with its own wall clock, whatever the offset; null if unreadable."""
    return show(_iso_moment(strip(c)))


# --- Spanish forms of single outlets ----------------------------------------------------

_W = rf"({WORD}+)"
_DE = rf"(\d{{1,2}}){SPACE}+de{SPACE}+{_W}{SPACE}+de{SPACE}+(\d{{4}})"


def _named(c, pattern, at, months=MONTHS_ES) -> Column:
    y, m, d = (F.regexp_extract(c, pattern, i) for i in at)
    return F.concat(y, F.lit("-"), month_text(m, months), F.lit("-"), F.lpad(d, 2, "0"))


def _low(c) -> Column:
    return F.lower(strip(c))


def es_long(c) -> Column:
    """``7 de abril de 2026`` anywhere in the text; null otherwise."""
    return _named(_low(c), _DE, (3, 2, 1))


def es_long_time(c) -> Column:
    """``25 de mayo de 2026, 18:50`` with the time kept, else the date alone."""
    low = collapse(F.lower(c))
    p = _DE + rf",?{SPACE}+(\d{{1,2}}):(\d{{2}})"
    clock = F.concat(F.lit(" "), F.lpad(F.regexp_extract(low, p, 4), 2, "0"), F.lit(":"),
                     F.regexp_extract(low, p, 5), F.lit(":00"))
    return F.coalesce(F.concat(_named(low, p, (3, 2, 1)), clock), _named(low, _DE, (3, 2, 1)))


def es_dash_time(c) -> Column:
    """``22 de Mayo de 2026 - 15:18``, impossible moments are null."""
    low = _low(c)
    p = _DE + rf"{SPACE}*-{SPACE}*(\d{{1,2}}):(\d{{2}})"
    clock = F.concat(F.lit(" "), F.regexp_extract(low, p, 4), F.lit(":"), F.regexp_extract(low, p, 5), F.lit(":00"))
    return F.coalesce(show(moment(F.concat(_named(low, p, (3, 2, 1)), clock))),
                      day_text(moment(_named(low, _DE, (3, 2, 1)))))


def es_plain(c) -> Column:
    """``07 mayo 2026``, else the long form."""
    low = _low(c)
    return F.coalesce(_named(low, rf"(\d{{1,2}}){SPACE}+{_W}{SPACE}+(\d{{4}})", (3, 2, 1)), es_long(c))


def es_month_first(c) -> Column:
    """``enero 16, 2026``, else the long form."""
    low = _low(c)
    return F.coalesce(_named(low, rf"{_W}{SPACE}+(\d{{1,2}}),?{SPACE}+(\d{{4}})", (3, 1, 2)), es_long(c))


def es_month_first_strict(c) -> Column:
    """``abril 14, 2026`` at the start with its comma; other texts stay, lower-cased."""
    low = _low(c)
    return F.coalesce(_named(low, rf"^{_W}{SPACE}+(\d{{1,2}}),{SPACE}+(\d{{4}})", (3, 1, 2)), low)


def es_weekday(c) -> Column:
    """``Lunes, 11 [de] Noviembre [de] 2024``: the first word is dropped."""
    low = F.regexp_replace(collapse(F.lower(c)), rf"^{WORD}+,?{SPACE}*", "")
    return _named(low, rf"(\d{{1,2}}){SPACE}+(?:de{SPACE}+)?{_W}{SPACE}+(?:de{SPACE}+)?(\d{{4}})", (3, 2, 1))


def es_short_month(c) -> Column:
    """``6 de Abr. 2026 | 1:35 am`` or an ISO start; an unknown month counts as January."""
    text = strip(c)
    p = rf"(?i)(\d{{1,2}}){SPACE}+de{SPACE}+{_W}\.?{SPACE}+(\d{{4}})"
    month = F.coalesce(month_text(F.substring(F.lower(F.regexp_extract(text, p, 2)), 1, 3), MONTHS_ES_SHORT), F.lit("01"))
    found = padded(number(text, p, 3), month, number(text, p, 1))
    iso = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(text, 1, 10))
    return F.coalesce(iso, found, F.lit("Sin fecha"))


def es_tokens(c) -> Column:
    """``5 julio, 2023`` by position of its words; unknown month January, else unchanged."""
    parts = F.split(collapse(F.replace(c, F.lit(","), F.lit(""))), " ")
    get = lambda i: F.try_element_at(parts, F.lit(i))
    month = F.coalesce(month_text(F.lower(get(2)), MONTHS_ES), F.lit("01"))
    day = F.format_string("%02d", get(1).try_cast("int"))
    return F.coalesce(F.when(get(1).try_cast("int").isNotNull(),
                             F.concat(get(3), F.lit("-"), month, F.lit("-"), day)), c)


# --- mixed and numeric forms -------------------------------------------------------------


def _iso_anywhere(c) -> Column:
    return group(c, r"(\d{4}-\d{2}-\d{2})", 1)


def mixed_short(c) -> Column:
    """``Jul 17, 2025`` or ``Abr 17, 2026``, else an ISO date in the text, else empty."""
    low = collapse(F.lower(c))
    p = rf"({WORD}{{3}}){SPACE}+(\d{{1,2}}),{SPACE}*(\d{{4}})"
    return F.coalesce(_named(low, p, (3, 1, 2), MONTHS_MIXED), _iso_anywhere(low), F.lit(""))


def english_long(c) -> Column:
    """``March 21, 2026`` or ``Mar 21, 2026``, else ISO, else empty."""
    low = collapse(F.lower(c))
    p = rf"([a-z]+){SPACE}+(\d{{1,2}}),?{SPACE}*(\d{{4}})"
    return F.coalesce(_named(low, p, (3, 1, 2), MONTHS_EN), _iso_anywhere(low), F.lit(""))


def mixed_day_first(c) -> Column:
    """``22 May, 2026`` or ``22 mayo 2026``, the long Spanish form, ISO, else empty."""
    low = collapse(F.lower(c))
    p = rf"(\d{{1,2}}){SPACE}+{_W},?{SPACE}+(\d{{4}})"
    name = F.regexp_extract(low, p, 2)
    month = F.coalesce(month_text(F.substring(name, 1, 3), MONTHS_MIXED), month_text(name, MONTHS_ES))
    return F.coalesce(padded(number(low, p, 3), month, number(low, p, 1)),
                      _named(low, _DE, (3, 2, 1)), _iso_anywhere(low), F.lit(""))


def english_short(c) -> Column:
    """``MAR 21, 2026``; anything else, impossible dates too, stays as it is."""
    p = rf"^([a-z]{{3}}){SPACE}+(\d{{1,2}}),{SPACE}+(\d{{4}})$"
    short = {k: v for k, v in MONTHS_EN.items() if len(k) == 3}
    low = F.lower(c)
    return F.coalesce(day_text(moment(_named(low, p, (3, 1, 2), short))), c)


_SLASHED = r"(\d{1,2})/(\d{1,2})/(\d{2,4})"


def _two_digit(year) -> Column:
    return F.when(year < 100, year + 2000).otherwise(year)


def day_first(c) -> Column:
    """``22/02/24``: parts are not range-checked."""
    n = lambda i: number(c, _SLASHED, i)
    return F.coalesce(padded(_two_digit(n(3)), n(2), n(1)), F.lit(""))


def month_first(c) -> Column:
    n = lambda i: number(c, _SLASHED, i)
    return F.coalesce(padded(_two_digit(n(3)), n(1), n(2)), F.lit(""))


def _checked(c, pattern, after_2000=True) -> Column:
    y, m, d = number(c, pattern, 3), number(c, pattern, 2), number(c, pattern, 1)
    ok = m.between(1, 12) & d.between(1, 31)
    return F.when(ok & (y > 2000) if after_2000 else ok, padded(y, m, d))


_DASHED = r"(\d{1,2})-(\d{1,2})-(\d{4})"


def dashed(c) -> Column:
    """``21-05-2026`` within ranges, else ISO, else empty."""
    return F.coalesce(_checked(c, _DASHED), _iso_anywhere(c), F.lit(""))


def dashed_time(c) -> Column:
    """``21-05-2026 09:49`` keeps its time."""
    first = F.element_at(F.split(c, " "), 1)
    clock = F.coalesce(F.try_element_at(F.split(c, " "), F.lit(2)), F.lit(""))
    date = dashed(first)
    return F.when((date != "") & (clock != ""), F.concat(date, F.lit(" "), clock, F.lit(":00"))).otherwise(date)


def any_numeric(c) -> Column:
    """``18/05/2026``, ``18-05-2026`` or ISO, in that order."""
    return F.coalesce(_checked(c, r"(\d{1,2})/(\d{1,2})/(\d{4})", after_2000=False),
                      _checked(c, _DASHED), _iso_anywhere(c), F.lit(""))


def slashed_strict(c) -> Column:
    """``22/03/2026`` as a real date; anything else stays."""
    pattern, form = NUMERIC_FORMS[4]
    return F.coalesce(day_text(moment(F.when(c.rlike(pattern), F.regexp_replace(c, pattern, form)))), c)
