"""Choose how few rows make a key hot."""

from contextlib import contextmanager

from gradewell.operators.spread import MAX_ROWS


@contextmanager
def limits(spark, rows=20):
    """Treat every key with more than ``rows`` rows as hot."""
    spark.conf.set(MAX_ROWS[0], str(rows))
    try:
        yield
    finally:
        spark.conf.unset(MAX_ROWS[0])


def both(spark, build):
    """The same operator with few hot keys and with many."""
    with limits(spark, rows=10**9):
        plain = build()
    with limits(spark):
        forced = build()
    return plain, forced
