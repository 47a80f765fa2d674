"""Count how often jobs read a table, over everything that runs while a query is built and shown."""

import io
import re
from collections import Counter
from contextlib import contextmanager, redirect_stdout

from pyspark.sql.classic.dataframe import DataFrame
from pyspark.sql.readwriter import DataFrameWriter


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@contextmanager
def counted_scans():
    """Scans by file name, and the number of writes and collects, of all that runs inside."""
    scans, actions = Counter(), Counter()

    def note(df, action):
        scans.update(re.findall(r"^Location: .*/([\w.]+)\]$", plan(df), re.M))
        actions[action] += 1

    kept = {(owner, name): getattr(owner, name) for owner, name in ((DataFrame, "collect"), (DataFrameWriter, "parquet"), (DataFrameWriter, "saveAsTable"))}

    def wrapped(original, action):
        def run(self, *args, **kwargs):
            note(getattr(self, "_df", self), action)
            return original(self, *args, **kwargs)

        return run

    for (owner, name), original in kept.items():
        setattr(owner, name, wrapped(original, name))
    try:
        yield scans, actions
    finally:
        for (owner, name), original in kept.items():
            setattr(owner, name, original)
