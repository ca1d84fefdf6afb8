"""Building and updating the master corpus."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.functions.text import is_blank, strip
from pressmill.operators.dedupe import keep_first, unseen, unseen_keyed
from pressmill.schema import NULL_TEXT


def union_by_name(frames) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def has_value(name):
    c = F.col(name)
    return c.isNotNull() & ~is_blank(c) & (c != NULL_TEXT)


def one_row(**values) -> DataFrame:
    """One row of single-valued frames: each frame holds one row with one column."""
    long = None
    for name, frame in values.items():
        part = frame.select(F.lit(name).alias("_metric"), F.col(frame.columns[0]).cast("long").alias("_value"))
        long = part if long is None else long.unionByName(part)
    return long.agg(*[F.max(F.when(F.col("_metric") == n, F.col("_value"))).alias(n) for n in values])


def newest_first(df: DataFrame) -> DataFrame:
    """By date text, undated last. Only for export: a total order costs a range shuffle.
    The address breaks ties, which also keeps the ranges even when one date dominates."""
    return df.orderBy(F.desc_nulls_last("publication_date"), "url")


def build(df: DataFrame, order=("file", "seq"), filter_first=False) -> DataFrame:
    """Corpus rows: first of every URL, then rows lacking text or URL dropped.

    With ``filter_first`` a URL whose first copy is empty survives through a later copy.
    """
    if filter_first:
        df = df.where(has_value("full_text") & has_value("url"))
    return keep_first(df, ["url"], list(order)).where(has_value("full_text") & has_value("url"))


def counted(df: DataFrame, *keep) -> DataFrame:
    """Records for counting: the text shrinks to a mark before anything is shuffled."""
    mark = F.when(has_value("full_text"), F.lit("x")).alias("full_text")
    return df.select("source", "url", "file", "seq", mark, *keep)


def by_source(corpus: DataFrame) -> DataFrame:
    return corpus.where("source is not null").groupBy("source").agg(F.count("*").alias("articles")) \
        .orderBy(F.desc("articles"), "source")


def build_stats(df: DataFrame, files: DataFrame = None) -> DataFrame:
    """Build counts, from one pass over the records. ``files`` (file, readable) adds the file counts."""
    whole = has_value("full_text") & has_value("url")
    first = F.min_by(F.struct(whole.alias("whole"), "source"), F.struct("file", "seq"))
    urls = df.groupBy("url").agg(F.count("*").alias("n"), first.alias("first"))
    out = urls.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_raw"),
        F.count_if("first.whole").alias("total_final"),
        F.count_distinct(F.when(F.col("first.whole"), F.col("first.source"))).alias("sources"),
        (F.coalesce(F.sum("n"), F.lit(0)) - F.count("*")).alias("duplicates"))
    if files is None:
        return out
    counts = files.agg(F.count_if("readable").alias("files_ok"), F.count_if(~F.col("readable")).alias("files_error"))
    return out.withColumn("_one", F.lit(1)).join(counts.withColumn("_one", F.lit(1)), "_one").drop("_one")


def overview(corpus: DataFrame) -> DataFrame:
    """Rows, sources, newest and oldest date text."""
    return corpus.agg(
        F.count("*").alias("articles"),
        F.count_distinct("source").alias("sources"),
        F.max("publication_date").alias("newest"),
        F.min("publication_date").alias("oldest"))


def _look_up(corpus: DataFrame, batch: DataFrame, rule) -> DataFrame:
    known = corpus.select(strip(F.col("url")).alias("_url"))
    return rule(batch.withColumn("_url", strip(F.col("url"))), known, "_url").drop("_url")


def arrivals(corpus: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of ``batch`` whose trimmed URL the corpus does not hold (null URLs included)."""
    return _look_up(corpus, batch, unseen)


def additions(corpus: DataFrame, batch: DataFrame, order=("file", "seq")) -> DataFrame:
    """The rows an update appends: first of every unseen URL.

    Trimming applies to the look-up only. A row without URL is added once, and only if the
    corpus has none; such rows go their own way, as one group of any size cut per task.
    """
    order = list(order)
    # repeats go first: the look-up depends on the URL alone, and a hot URL has shrunk by then
    firsts = keep_first(batch.where("url is not null"), ["url"], order)
    fresh = _look_up(corpus, firsts, unseen_keyed)
    held = corpus.where("url is null").select(F.lit(1).alias("_held")).limit(1)
    nameless = keep_first(batch.where("url is null"), ["url"], order)
    return fresh.unionByName(nameless.join(held, F.lit(1) == F.col("_held"), "left_anti"))


def update(corpus: DataFrame, batch: DataFrame, order=("file", "seq"), unique=True) -> DataFrame:
    """Corpus plus its additions.

    A corpus written by this package holds every URL once, so nothing of it moves: the
    additions are appended. ``unique=False`` also drops repeats within the corpus.
    """
    fresh = additions(corpus, batch, order)
    old = corpus if unique else keep_first(corpus, ["url"], list(order))
    return old.unionByName(fresh, allowMissingColumns=True)


def update_stats(corpus: DataFrame, batch: DataFrame, order=("file", "seq")) -> DataFrame:
    """New rows, skipped rows, corpus size before and after: one pass over the URLs of either side.

    Rows of a URL are counted before they meet, so a hot URL is one row per task."""
    key = strip(F.col("url")).alias("k")
    held = corpus.groupBy("url").agg(F.count("*").alias("held")).select(key, "held", F.lit(0).cast("long").alias("n"), F.lit(0).alias("urls"))
    came = batch.groupBy("url").agg(F.count("*").alias("n")).select(key, F.lit(0).cast("long").alias("held"), "n", F.lit(1).alias("urls"))
    met = held.unionByName(came).groupBy("k").agg(*[F.sum(c).alias(c) for c in ("held", "n", "urls")])
    unheld, total = F.col("held") == 0, lambda what, rule=F.lit(True): F.coalesce(F.sum(F.when(rule, F.col(what))), F.lit(0))
    # rows without URL always count as new; one of them is added if the corpus has none
    fresh = unheld | F.col("k").isNull()
    return met.agg(
        total("urls", fresh).alias("new_rows"), (total("n") - total("n", fresh)).alias("duplicates"),
        total("held").alias("before"), (total("held") + total("urls", unheld)).alias("after"))


def update_by_file(corpus: DataFrame, batch: DataFrame) -> DataFrame:
    """Per file: rows not yet held and rows already held."""
    known = corpus.select(strip(F.col("url")).alias("_url"))
    keyed = batch.select("file", "seq", strip(F.col("url")).alias("_url"))
    fresh = unseen(keyed, known, "_url").groupBy("file").agg(F.count("*").alias("new_rows"))
    rows = batch.groupBy("file").agg(F.count("*").alias("_rows"))
    n = F.coalesce(F.col("new_rows"), F.lit(0)).cast("long")
    return rows.join(fresh, "file", "left").select(
        "file", n.alias("new_rows"), (F.col("_rows") - n).alias("existing"))
