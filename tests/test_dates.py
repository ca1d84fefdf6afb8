import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pressmill.functions import dates as D

AS_OF = "2024-06-15 12:00:00"

CASES = [
    (D.es_long_time, "25 de mayo de 2026, 18:50 PM", "2026-05-25 18:50:00"),
    (D.es_long_time, "25 de mayo de 2026", "2026-05-25"),
    (D.es_long_time, "25 de nada de 2026", None),
    (D.es_dash_time, "22 de Mayo de 2026 - 15:18", "2026-05-22 15:18:00"),
    (D.es_dash_time, "31 de febrero de 2026 - 15:18", None),
    (D.es_plain, "07 mayo 2026", "2026-05-07"),
    (D.es_month_first, "enero 16, 2026", "2026-01-16"),
    (D.es_month_first_strict, "Abril 4, 2026", "2026-04-04"),
    (D.es_month_first_strict, "Hoy MISMO", "hoy mismo"),
    (D.es_weekday, "Lunes, 11 Noviembre 2024", "2024-11-11"),
    (D.es_weekday, "Miércoles, 5 de Marzo 2024", "2024-03-05"),
    (D.es_short_month, "6 de Abr. 2026 | 1:35 am", "2026-04-06"),
    (D.es_short_month, "6 de Xyz 2026", "2026-01-06"),
    (D.es_short_month, "nada", "Sin fecha"),
    (D.es_tokens, "5 julio, 2023", "2023-07-05"),
    (D.es_tokens, "ayer", "ayer"),
    (D.day_first, "22/02/24", "2024-02-22"),
    (D.day_first, "40/13/2026", "2026-13-40"),
    (D.month_first, "04/26/2025", "2025-04-26"),
    (D.dashed, "21-05-2026", "2026-05-21"),
    (D.dashed, "2026-05-21", "2026-05-21"),
    (D.dashed_time, "21-05-2026 09:49", "2026-05-21 09:49:00"),
    (D.any_numeric, "18/05/2026", "2026-05-18"),
    (D.slashed_strict, "22/03/2026", "2026-03-22"),
    (D.slashed_strict, "31/02/2026", "31/02/2026"),
    (D.mixed_short, "Abr 17, 2026", "2026-04-17"),
    (D.english_long, "March 21, 2026", "2026-03-21"),
    (D.english_short, "MAR 21, 2026", "2026-03-21"),
    (D.mixed_day_first, "22 May, 2026", "2026-05-22"),
    (D.mixed_day_first, "22 de mayo de 2026", "2026-05-22"),
    (D.iso_local, "2026-05-15T17:38:26.012Z", "2026-05-15 11:38:26"),
    (D.iso_local, "2026-04-24T15:24:24-06:00", "2026-04-24 15:24:24"),
    (D.iso_local, "2026-04-24T01:00:00+05:30", "2026-04-23 13:30:00"),
    (D.iso_local, "sometime soon", "sometime s"),
    (D.iso_utc, "2026-04-24 T 15:24:24 -06:00", "2026-04-24 21:24:24"),
    (D.iso_utc, "nope", ""),
    (D.iso_wall_clock, "2026-04-24T15:24:24+02:00", "2026-04-24 15:24:24"),
    (D.iso_wall_clock, "2026-04-31T15:24:24", None),
]


def _one(spark, text, *columns):
    df = spark.createDataFrame([(text,)], "raw string")
    return df.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


def test_forms(spark):
    texts = spark.createDataFrame([(i, t) for i, (_, t, _) in enumerate(CASES)], "i int, raw string")
    rows = {r["i"]: r for r in texts.select("i", *[f(F.col("raw")).alias(f"c{i}") for i, (f, _, _) in enumerate(CASES[:19])]).collect()}
    more = {r["i"]: r for r in texts.select("i", *[f(F.col("raw")).alias(f"c{i}") for i, (f, _, _) in list(enumerate(CASES))[19:]]).collect()}
    got = {i: (rows if i < 19 else more)[i][f"c{i}"] for i in range(len(CASES))}
    wrong = {CASES[i][1]: (got[i], CASES[i][2]) for i in got if got[i] != CASES[i][2]}
    assert not wrong


@pytest.mark.parametrize("text,want", [
    ("Hace 2 dias", "2024-06-13 12:00:00"), ("hace 1 dia", None), ("hace 1 ano", None),
    ("hace 3 meses", "2024-03-17 12:00:00"), ("publicado hace 1 año", "2023-06-16 12:00:00"),
    ("hace 5 horas", "2024-06-15 07:00:00"), ("hace 2 semanas", "2024-06-01 12:00:00"),
    (" 2024-3-5 1:2:3 ", "2024-03-05 01:02:03"), ("05/03/2024", "2024-03-05 00:00:00"),
    ("31 de febrero de 2024", None), ("Sin fecha", None), ("", None), ("hace 99999999999999999999 horas", None),
])
def test_normalize(spark, text, want):
    assert _one(spark, text, D.normalize(F.col("raw"), F.lit(AS_OF).cast("timestamp_ntz")))[0] == want


@settings(max_examples=10, deadline=None)
@given(st.lists(st.dates(dt.date(1900, 1, 1), dt.date(2100, 12, 31)), min_size=1, max_size=20))
def test_every_written_form_reads_back(spark, days):
    months = list(D.MONTHS_ES)
    rows = [(d.isoformat(), t) for d in days for t in (
        f"{d.day} de {months[d.month - 1]} de {d.year}", f"{months[d.month - 1]} {d.day}, {d.year}",
        f"{d.day}/{d.month}/{d.year}", f"{d.day}-{d.month}-{d.year}", d.isoformat())]
    df = spark.createDataFrame(rows, "day string, raw string")
    bad = df.where(F.substring(D.normalize(F.col("raw"), F.lit(AS_OF).cast("timestamp_ntz")), 1, 10) != F.col("day"))
    assert bad.count() == 0
