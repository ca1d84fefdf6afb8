"""Session defaults and the shared scratch folder."""

import os
import shutil
import uuid

from pyspark.sql import SparkSession

# Adaptive execution picks partition counts and splits skewed joins at run time;
# 128 MB input splits keep a task's share of a 100 TB scan inside one executor core.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app="pressmill", master=None, **conf):
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark):
    """A new folder below the cluster's shared checkpoint folder (spark.checkpoint.dir).

    Where that is not set, the warehouse, which all executors share too, takes its place; no folder of
    one machine's own is used. What is left there after a job may be deleted.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def ship(spark, folder):
    """Hand this package to executors that do not have it installed: packed below ``folder`` of the
    driver, from where Spark sends it to them."""
    root = os.path.dirname(os.path.abspath(__file__))
    packed = shutil.make_archive(os.path.join(folder, "pressmill"), "zip", os.path.dirname(root), os.path.basename(root))
    spark.sparkContext.addPyFile(packed)
    return packed
