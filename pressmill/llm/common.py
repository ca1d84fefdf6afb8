"""Small shared helpers: word rules, free column names, durable intermediate tables."""

import zlib

from pyspark.sql import functions as F

from pressmill.session import shared_folder

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(col):
    """A-Z to a-z and nothing else."""
    return F.translate(col, UPPER, LOWER)


def word_count(col):
    """Number of words as a long; null text has none."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def free(df, *names):
    """Column names close to ``names`` that ``df`` does not use (names ignore case in Spark)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def keep(df):
    """``df`` written once as Parquet below the folder of spark.checkpoint.dir and read back:
    lineage ends there, and lost executors cost only the tasks they ran."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/kept"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut(df):
    """``df`` after a checkpoint in the shared folder, for tables that a loop replaces."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def crc_mod(col, n):
    """crc32 of the value as text, modulo n."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % n


def text_bytes(column):
    """An Arrow string column as a list of UTF-8 bytes (null: empty)."""
    return [x or b"" for x in column.cast("large_binary").to_pylist()]


def crc(value):
    return zlib.crc32(str(value).encode())
