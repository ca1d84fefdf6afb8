"""Collects the named queries and the SQL that must give the same rows."""

from pressmill.checks.fixtures import oracle

QUERIES = {}
ORACLES = {}


def check(name, sql=None, views=()):
    """Register a query ``fn(spark, sf_dir)``; ``sql`` may use the named fixture views."""
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = oracle(sql, *views)
        return fn
    return register
