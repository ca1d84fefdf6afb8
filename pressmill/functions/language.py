"""Language of a text by ranked character trigrams (Cavnar and Trenkle, 1994).

Profiles are learned from labelled text with a plain aggregation. Detection scores each
text inside its task against all profiles, so texts are never exploded or shuffled.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.operators.dedupe import top_n

DEFAULT = "es"
RANKS = 300
FLUSH = 4_000_000  # counted trigrams that a task holds before it adds them up
LANGUAGES = 1000  # more profiles than this are not sent to the tasks


def learn(labelled: DataFrame, text="text", label="lang", ranks=RANKS) -> DataFrame:
    """Profile rows (lang, gram, rank): the commonest trigrams of every language.

    Trigrams are counted as numbers inside each task, so that what is shuffled is one row per task, language and
    trigram; the ranking keeps ``ranks`` rows per language per task, so a language holding most of the text does
    not pile up."""
    def count(batches):
        held, size = {}, 0
        for batch in batches:
            for lang, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                grams, n = np.unique(_codes(value), return_counts=True)
                held.setdefault(lang, []).append((grams, n))
                size += len(grams)
            if size > FLUSH:
                yield from _counted(held)
                held, size = {}, 0
        yield from _counted(held)

    known = labelled.where(F.col(label).isNotNull() & F.col(text).isNotNull())
    rows = known.select(F.col(label).cast("string").alias("lang"), F.lower(F.col(text)).alias("text"))
    counts = rows.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    # numbers are ordered like the trigrams themselves
    ranked = top_n(counts, ["lang"], [F.desc("n"), "code"], ranks, rank="rank")
    point = lambda shift: F.lpad(F.hex(F.shiftright("code", shift).bitwiseAND(F.lit((1 << 21) - 1))), 8, "0")
    gram = F.decode(F.unhex(F.concat(point(42), point(21), point(0))), "UTF-32")  # big-endian without a mark
    return ranked.select("lang", gram.alias("gram"), "rank", "n")


def _counted(held):
    """Batches of (lang, code, n) from lists of counted trigrams per language."""
    for lang, parts in held.items():
        codes, at = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
        n = np.bincount(at, np.concatenate([x for _, x in parts]).astype(float), len(codes)).astype(np.int64)
        if len(codes):
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(n)], ["lang", "code", "n"])


def _codes(text):
    """One number per trigram, ordered like the trigrams themselves."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.int64)
    return (points[:-2] << 42) | (points[1:-1] << 21) | points[2:]


def _nearest(text, langs, codes, ranks, limit):
    """First language with the smallest sum of rank differences, or None without trigrams."""
    grams = _codes(text)
    if not len(grams):
        return None
    found, n = np.unique(grams, return_counts=True)
    top = found[np.argsort(-n, kind="stable")[:limit]]
    at = np.minimum(np.searchsorted(codes, top), len(codes) - 1)
    theirs = np.where(codes[at] == top, ranks[:, at], 0)
    distance = np.where(theirs > 0, np.abs(theirs - np.arange(1, len(top) + 1)), limit).sum(axis=1)
    return langs[int(distance.argmin())]


def detector(profiles: DataFrame, default=DEFAULT, ranks=RANKS):
    """Function from a text column to a language column.

    The profiles are at most ``ranks`` rows for each of at most LANGUAGES languages (more are an error);
    they travel as a broadcast value. Ties go to the first language by name; texts without any trigram get ``default``."""
    rows = profiles.select("lang", "gram", "rank").where(F.col("rank") <= ranks).limit(LANGUAGES * ranks + 1).collect()
    if len(rows) > LANGUAGES * ranks:
        raise ValueError(f"profiles of more than {LANGUAGES} languages")
    langs = sorted({r["lang"] for r in rows})
    codes = np.unique([int(_codes(r["gram"])[0]) for r in rows])
    table = np.zeros((len(langs), len(codes)), dtype=np.int64)
    for r in rows:
        table[langs.index(r["lang"]), np.searchsorted(codes, _codes(r["gram"])[0])] = r["rank"]
    shared = profiles.sparkSession.sparkContext.broadcast((langs, codes, table))

    @F.pandas_udf("string")
    def nearest(texts: pd.Series) -> pd.Series:
        langs, codes, table = shared.value
        return texts.map(lambda t: (_nearest(t or "", langs, codes, table, ranks) if langs else None) or default)

    return lambda c: nearest(F.lower(c))
