"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator
key, plus the equivalent portable SQL used as an oracle."""

from tablewatch.plans.common import ORACLE, QUERIES


def load_all():
    # Importing the modules registers their queries.
    from tablewatch.plans import (  # noqa: F401
        dq, suite, profile, reconcile, cost, freshness, runs, transform, similarity, score,
        nested, sources, streams)
    return QUERIES, ORACLE
