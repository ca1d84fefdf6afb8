"""Names of any script, titles without gender, national phone numbers, and long texts."""

import time

import pytest
from pyspark.sql import functions as F

from pressmill.llm import pii


@pytest.mark.parametrize("text, kinds", [
    ("Dr Jane Roe", ["name_u", "family"]), ("Prof. Smith", ["family"]), ("Sra. María Pérez", ["name_f", "family"]), ("Lord John Doe", ["name_m", "family"]),
    ("020 7946 0958", ["phone"]), ("06 12 34 56 78", ["phone"]), ("06.12.34.56.78", ["phone"]), ("01.02.2024 10:30", []), ("01 02 2024", []),
    ("0 1 2 3", []), ("10 20 30 40 50", []), ("١٢٣-٤٥-٦٧٨٩", ["ssn"])])
def test_kinds(text, kinds):
    assert [k for _, _, k, _ in pii.find(text)] == kinds


def test_surrogates_keep_script_and_gender():
    for name, ends in (("María", "a"), ("Анна", "а"), ("Μαρία", "α")):
        new = pii.surrogate(b"k", "name_f", name)
        assert pii._script(new) == pii._script(name) and new.endswith(ends) and new[0].isupper() and new != name
    for name, ends in (("José", "on"), ("Иван", "ан"), ("Γιώργος", "ος")):
        assert pii.surrogate(b"k", "name_m", name).endswith(ends)
    assert pii.surrogate(b"k", "family", "ÖZIL").isupper()
    assert pii._script("aж") is None and pii.surrogate(b"k", "family", "aж") != "aж"
    new, n = pii.replace("Herr Jörg Müller rief an. Müller kam.", b"k")
    assert n == 3 and new.count(pii.surrogate(b"k", "family", "Müller")) == 2


def test_many_entities_in_one_text_take_linear_time():
    def seconds(n):
        text = " ".join(f"a{i}@x{i}.example.com 10.{i % 250}.{i // 250 % 250}.7" for i in range(n))
        start = time.process_time()
        assert len(pii.find(text)) == 2 * n
        return time.process_time() - start

    assert seconds(40_000) < 25 * max(seconds(4_000), 0.01)


def test_rows_clashing_names_and_long_texts(spark):
    long = "x " * 200_000 + "Mrs Ada Byron " + "y " * 1000
    rows = [(1, "a@b.example.com", "t", 1), (1, "a@b.example.com", "t", 1), (2, long, None, 2), (3, None, "t", 3), (4, "", "t", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, entity string, n_entities int").repartition(3)
    got = pii.pseudonymised(docs, b"key")
    assert got.count() == 5 and got.where(F.col("doc_id") == 1).distinct().count() == 1
