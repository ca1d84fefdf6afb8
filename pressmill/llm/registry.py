"""The named queries of the subpackage and the SQL that gives the same rows."""

QUERIES = {}
ORACLES = {}


def query(sql=None):
    """Register ``fn(spark, sf_dir)`` under its own name."""
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return register


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
