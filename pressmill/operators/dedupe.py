"""Duplicate handling that stays even when one key holds most of the rows."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys, order) -> DataFrame:
    """First row of every key (null keys form one group).

    ``row_number() = 1`` lets Spark keep one row per key in each input task before the
    shuffle, so a hot key sends at most one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def top_n(df: DataFrame, keys, order, n: int, rank="_rn") -> DataFrame:
    """First ``n`` rows of every key with their rank; cut per task before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def mark_first(df: DataFrame, keys, order, flag="is_first", among=None) -> DataFrame:
    """Add ``flag``: whether the row is the first of its key among the rows meeting ``among``.

    ``order`` columns together identify a row. The first row per key comes from a partial
    aggregation; rows are matched back on key *and* order columns, so the copies of a hot key
    spread over all join partitions.
    """
    pool = df if among is None else df.where(among)
    picks = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]
    names = [f"_k{i}" for i in range(len(keys))]
    firsts = (
        pool.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.struct(*picks).alias("_at"))
        .groupBy(*names).agg(F.min("_at").alias("_at"))
        .select(*names, "_at.*", F.lit(True).alias("_hit"))
    )
    match = F.lit(True)
    for k, n in zip(keys, names):
        match = match & F.col(k).eqNullSafe(F.col(n))
    for i, c in enumerate(order):
        match = match & F.col(c).eqNullSafe(F.col(f"_o{i}"))
    joined = df.join(firsts, match, "left")
    return joined.select(*df.columns, F.coalesce(F.col("_hit"), F.lit(False)).alias(flag))


def unseen_keyed(new: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` with a ``key`` that ``known`` does not hold; rows without key are left
    out. Only the key column of ``known`` is read."""
    known_keys = known.select(F.col(key).alias("_seen")).where("_seen is not null")
    return new.where(F.col(key).isNotNull()).join(known_keys, F.col(key) == F.col("_seen"), "left_anti")


def unseen(new: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """As ``unseen_keyed``, with the rows without key added: they always count as new.

    Null keys never enter the join: they would all land in one partition."""
    return unseen_keyed(new, known, key).unionByName(new.where(F.col(key).isNull()))
