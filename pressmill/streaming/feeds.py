"""The daily increment as Structured Streaming."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressmill.operators import runs as R
from pressmill.operators.dedupe import keep_first
from pressmill.plans import corpus as C
from pressmill.plans.held import HeldKeys, distinct, newest


def read_landing(spark, folder, schema, files_per_batch=None, fmt="parquet", **options) -> DataFrame:
    """Stream of newly landed files."""
    reader = spark.readStream.schema(schema).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.format(fmt).load(folder)


def ingest(stream: DataFrame, root: str, checkpoint: str, gate=None, order=("file", "seq"), available_now=True):
    """Append unseen articles to the corpus in ``root``, one folder per micro-batch.

    ``gate`` filters a batch first. What the corpus holds is looked up in its key runs (``HeldKeys``, beside the checkpoint), of
    which a batch reads a few folders and the buckets it needs, however many batches came before. A batch overwrites its
    own folders, so running it again after a lost executor or driver gives the same corpus."""
    schema = T.StructType([stream.schema["url"]])

    def apply(batch: DataFrame, batch_id: int):
        spark = _session(batch)
        keys = HeldKeys(spark, f"{checkpoint}/held", schema, "url", distinct)
        rows = gate(batch) if gate else batch
        # look-ups ignore blanks around an address, so keys are kept and dealt out without them
        trimmed = rows.select(C.strip(F.col("url")).alias("url"))
        C.additions(keys.read(batch_id, trimmed), rows, order).write.mode("overwrite").parquet(f"{root}/batch={batch_id}")
        added = spark.read.schema(stream.schema).parquet(f"{root}/batch={batch_id}")
        keys.add(batch_id, added.select(C.strip(F.col("url")).alias("url")))

    return _start(stream.writeStream.foreachBatch(apply), checkpoint, available_now)


def _session(batch):
    """The session of a micro-batch, with adaptive execution: a stream's own plan goes without, but what is done with a
    batch are ordinary jobs of any size."""
    batch.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
    return batch.sparkSession


def _start(writer, checkpoint, available_now):
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def dedupe(stream: DataFrame, root: str, checkpoint: str, key="url", time="scraping_ts", delay="7 days", order=("scraping_ts",),
           available_now=True):
    """First copy of each key, one folder per micro-batch below ``root``; copies that follow a kept one within
    ``delay`` are dropped. Null keys count as one key.

    Repeats within a batch shrink in each task before the shuffle. Of earlier batches only the key runs are read, in the
    buckets that the batch's keys fall into and no older than ``delay`` before it."""
    schema = T.StructType([stream.schema[key], stream.schema[time]])

    def apply(batch: DataFrame, batch_id: int):
        spark = _session(batch)
        keys = HeldKeys(spark, f"{checkpoint}/held", schema, key, newest(key, time))
        firsts = keep_first(batch, [key], list(order)).alias("n")
        since = batch.agg(F.min(time) - F.expr(f"interval {delay}")).first()[0]
        held = keys.read(batch_id, batch).where(F.col(time) >= F.lit(since)).select(F.col(key).alias("_key"), F.col(time).alias("_held"))
        near = firsts[key].eqNullSafe(F.col("_key")) & (F.col(time) <= F.col("_held") + F.expr(f"interval {delay}"))
        firsts.join(held, near, "left_anti").write.mode("overwrite").parquet(f"{root}/batch={batch_id}")
        keys.add(batch_id, spark.read.schema(stream.schema).parquet(f"{root}/batch={batch_id}"))

    return _start(stream.writeStream.foreachBatch(apply), checkpoint, available_now)


def daily_counts(stream: DataFrame, time="scraping_ts", delay="1 day") -> DataFrame:
    """Arrivals per source and day; rows behind the watermark are dropped.

    Counts are combined in each task first, so a busy source sends one row per task and day."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, "1 day"), "source") \
        .agg(F.count("*").alias("articles"))


def write_daily(counts: DataFrame, root: str, checkpoint: str, available_now=True):
    """Every count that a micro-batch changed, open days included, in the batch's own folder."""
    def apply(batch: DataFrame, batch_id: int):
        batch.write.mode("overwrite").parquet(f"{root}/batch={batch_id}")

    return _start(counts.writeStream.outputMode("update").foreachBatch(apply), checkpoint, available_now)


def read_daily(spark, root: str) -> DataFrame:
    """The newest count of every source and day."""
    return spark.read.parquet(root).groupBy("window", "source").agg(F.max_by("articles", "batch").alias("articles"))


def anomaly_alerts(stream: DataFrame, history: str, alerts: str, checkpoint: str, available_now=True):
    """Append each micro-batch of runs to the history and judge its successful runs.

    A verdict depends on a source's latest runs and successes only. Those are kept apart per source (``HeldKeys``), so a
    batch reads a few rows of the sources it brings and never the history."""
    state = T.StructType([*stream.schema.fields, T.StructField("_batch", T.LongType())])

    def latest(rows):
        """The tails of every source as its latest batch left them."""
        last = rows.groupBy("source").agg(F.max("_batch").alias("_last")).withColumnRenamed("source", "_s")
        return rows.join(last, rows["source"].eqNullSafe(F.col("_s")) & (rows["_batch"] == F.col("_last")), "left_semi")

    def apply(batch: DataFrame, batch_id: int):
        spark = _session(batch)
        tails = HeldKeys(spark, f"{checkpoint}/tails", state, "source", latest)
        batch.write.mode("overwrite").parquet(f"{history}/batch={batch_id}")
        new = spark.read.schema(stream.schema).parquet(f"{history}/batch={batch_id}")
        sources = new.select("source").distinct()
        earlier = tails.read(batch_id, sources).drop("_batch").join(sources, "source", "left_semi")
        marked = earlier.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)))
        R.anomalies(marked).where("_new").drop("_new").write.mode("overwrite").parquet(f"{alerts}/batch={batch_id}")
        tails.add(batch_id, R.tail(marked.drop("_new")).withColumn("_batch", F.lit(batch_id).cast("long")))

    return _start(stream.writeStream.foreachBatch(apply), checkpoint, available_now)


def write_parquet(frame: DataFrame, path: str, checkpoint: str, mode="append", available_now=True):
    return _start(frame.writeStream.outputMode(mode).format("parquet").option("path", path), checkpoint, available_now)
