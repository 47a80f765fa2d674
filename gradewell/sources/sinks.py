"""CSV sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from gradewell.operators.columns import quoted
from gradewell.operators.filters import allow


def write_by(
    df: DataFrame, key: str, values: Sequence[str], path: str, sort: Sequence[str]
) -> None:
    """One folder of sorted CSV files per allowed key value.

    Rows are range partitioned by key and sort columns: small values share a
    task, a large one is cut into consecutive sorted files, none is gathered.
    The key stays a column of the files; the folder is named ``by_<key>=<value>``.
    """
    folder = f"by_{key}"
    order = [quoted(c) for c in [folder, *sort]]
    (
        allow(df, key, values)
        .withColumn(folder, quoted(key))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.partitionBy(folder)
        .option("header", True)
        .csv(path)
    )


def write_single(df: DataFrame, path: str, files: int = 1) -> None:
    """CSV in as many files as the caller asks for, one by default.

    Whatever made the rows stays parallel; one file means one writing task, so a
    large table should ask for more.
    """
    df.repartition(files).write.option("header", True).csv(path)
