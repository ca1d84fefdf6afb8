"""Keys that earlier batches hold, apart from the rows themselves.

Every batch leaves a run of its keys, dealt into hash buckets. When ``fan`` runs of a level are there, their merge is a run of
the next level, so before batch n at most (fan - 1) runs of each of log(n) levels are read, and of these only the buckets
that the new keys fall into. Which runs stand for batch n follows from n alone: a batch that is repeated after a failure
sees what it saw before, and writes the same runs again. Runs that a merge has replaced are never read again and may be
deleted.
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS, FAN = 16, 8


class HeldKeys:
    """Runs below ``root`` with the columns of ``schema`` (``key`` among them). ``merge`` turns the union of runs into one row
    set per key, whatever the order of merging."""

    def __init__(self, spark, root, schema, key, merge, buckets=BUCKETS, fan=FAN):
        self.spark, self.root, self.key, self.merge, self.buckets, self.fan = spark, root.rstrip("/"), key, merge, buckets, fan
        self.columns = [f.name for f in schema.fields]
        self.schema = T.StructType([*schema.fields, T.StructField("_bucket", T.IntegerType())])

    def bucket(self, key=None):
        return F.pmod(F.xxhash64(F.col(key or self.key)), F.lit(self.buckets)).cast("int")

    def _path(self, level, start):
        return f"{self.root}/level={level}/start={start}"

    def runs(self, batch):
        """(level, first batch) of the runs that hold all batches before ``batch``."""
        levels, size = [], 1
        while size <= batch:
            levels.append(size)
            size *= self.fan
        out, start = [], 0
        for level in range(len(levels) - 1, -1, -1):
            while start + levels[level] <= batch:
                out.append((level, start))
                start += levels[level]
        return out

    def _read(self, runs) -> DataFrame:
        frames = [self.spark.read.schema(self.schema).parquet(self._path(*run)) for run in runs]
        return reduce(DataFrame.unionByName, frames) if frames else self.spark.createDataFrame([], self.schema)

    def read(self, batch, among: DataFrame = None) -> DataFrame:
        """The rows held before ``batch``; with ``among`` only those of buckets that its keys fall into (a list of at most
        ``buckets`` numbers)."""
        rows = self._read(self.runs(batch))
        if among is not None:
            wanted = [r[0] for r in among.select(self.bucket()).distinct().collect()]
            rows = rows.where(F.col("_bucket").isin(wanted))
        return self.merge(rows.select(self.columns))

    def _write(self, rows, level, start):
        rows.withColumn("_bucket", self.bucket()).repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(self._path(level, start))

    def add(self, batch, rows: DataFrame):
        """Leave the run of a batch (rows that ``merge`` would leave as they are), and the merges that it completes."""
        self._write(rows.select(self.columns), 0, batch)
        level, size = 1, self.fan
        while (batch + 1) % size == 0:
            parts = [(level - 1, batch + 1 - size + i * size // self.fan) for i in range(self.fan)]
            self._write(self.merge(self._read(parts).select(self.columns)), level, batch + 1 - size)
            level, size = level + 1, size * self.fan


def newest(keys, time):
    """A merge that keeps the latest ``time`` of every key."""
    return lambda rows: rows.groupBy(keys).agg(F.max(time).alias(time))


def distinct(rows):
    """A merge of plain keys."""
    return rows.distinct()
