"""A run: the bases that its jobs share, each written once under its name."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gradewell.session import METHOD_LIMIT, shared_folder


class Run:
    """Named tables in a database of their own, in the folder all executors share.

    ``base`` writes a table the first time a name is asked for; jobs of the same run
    read it from then on. Nothing is read again where a base is shared, lineage ends
    at it, and a lost executor costs the tasks it ran. As a context manager the run
    removes its tables at the end, also after an error; without ``with`` they stay until
    ``close``, for results that are still to be read.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.database = f"run_{uuid.uuid4().hex}"
        self.names: list[str] = []
        # The jobs of a run have wide rows. The session keeps the limit, as results are read after it.
        spark.conf.set(*METHOD_LIMIT)
        spark.sql(f"CREATE DATABASE {self.database} LOCATION '{shared_folder(spark)}/{self.database}'")

    def base(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The table ``name``, made by ``build`` if the run has none yet."""
        table = f"{self.database}.{name}"
        if name not in self.names:
            build().write.format("parquet").saveAsTable(table)
            self.names.append(name)
        return self.spark.table(table)

    def close(self) -> None:
        self.spark.sql(f"DROP DATABASE IF EXISTS {self.database} CASCADE")
        self.names.clear()

    def __enter__(self) -> Run:
        return self

    def __exit__(self, *error: object) -> None:
        self.close()
