"""Table sources: CSV folders, files by extension, snapshots, table classes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradewell.operators.columns import quoted, select_cols

# Column that marks a standard clinical table, in order of precedence (fixed values).
SIGNATURES = {
    "px_codetype": "PROCEDURE",
    "dtimpute": "DEATH",
    "race": "DEMOGRAPHIC",
    "dx_codetype": "DIAGNOSIS",
    "rx_codetype": "DISPENSING",
    "discharge_disposition": "ENCOUNTER",
    "chart": "ENROLLMENT",
    "facility_location": "FACILITY",
    "fast_ind": "LAB",
    "birth_type": "MIL",
    "specialty": "PROVIDER",
}
UNKNOWN = "UNKNOWN_DATASET"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header. A schema is checked row by row; without one all columns are text."""
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema).option("mode", "FAILFAST").option("enforceSchema", False)
    return reader.csv(path)


def read_tables(
    spark: SparkSession, folder: str, schemas: Mapping[str, T.StructType | None]
) -> dict[str, DataFrame]:
    """The named CSV tables of one folder, ``<folder>/<name>.csv`` each."""
    return {name: read_csv(spark, f"{folder}/{name}.csv", s) for name, s in schemas.items()}


def route(tables: Mapping[str, DataFrame], snapshot: str) -> dict[str, DataFrame]:
    """Tables named ``<name>_<snapshot>`` under their plain names; other snapshots are left out."""
    tail = f"_{snapshot}"
    return {n.removesuffix(tail): df for n, df in tables.items() if n.endswith(tail)}


def file_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per file under ``folder`` that belongs to a table snapshot, from the listing alone.

    ``<name>_<snapshot>.csv`` or ``.parquet``, a file or a folder of files, gives columns
    ``name``, ``snapshot`` (the part after the last underscore), ``kind``, ``place`` (what to
    scan), ``path``, ``time`` and ``bytes``. Other files are left out. No file is opened, so
    the manifest can choose what a job reads.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    path, shape = F.col("path"), r"^(.*/([^/]+)_([^/_]+)\.(csv|parquet))(/[^/]+)?$"
    return files.where(path.rlike(shape)).select(
        F.regexp_extract(path, shape, 2).alias("name"),
        F.regexp_extract(path, shape, 3).alias("snapshot"),
        F.regexp_extract(path, shape, 4).alias("kind"),
        F.regexp_extract(path, shape, 1).alias("place"),
        "path",
        F.col("modificationTime").alias("time"),
        F.col("length").alias("bytes"),
    )


def chosen_places(manifest: DataFrame, snapshot: str | None = None) -> DataFrame:
    """One row per table: the place of the given snapshot, or of its newest one by name."""
    wanted = manifest if snapshot is None else manifest.where(F.col("snapshot") == snapshot)
    last = F.max_by(F.struct("snapshot", "place"), "snapshot").alias("last")
    return wanted.groupBy("name").agg(last).select("name", "last.snapshot", "last.place")


def read_snapshot(
    spark: SparkSession,
    folder: str,
    snapshot: str | None = None,
    schemas: Mapping[str, T.StructType] | None = None,
) -> dict[str, DataFrame]:
    """Every table of ``folder`` under its plain name, as of one snapshot or each at its newest.

    The manifest is cut to one row per table before it comes to the driver, and only
    the chosen files are ever scanned.
    """
    schemas = schemas or {}
    chosen = chosen_places(file_manifest(spark, folder), snapshot).collect()
    return {r["name"]: scan(spark, r["place"], schemas.get(r["name"])) for r in chosen}


def scan(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Lazy scan of a .csv or .parquet path."""
    extension = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if extension == "csv":
        return read_csv(spark, path, schema)
    if extension == "parquet":
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    raise ValueError(f"neither .csv nor .parquet: {path}")


def read_lookup(spark: SparkSession, path: str, cols: Sequence[str]) -> DataFrame:
    """Chosen columns of a lookup table; only these are read."""
    return select_cols(spark.read.parquet(path), cols)


def latest_snapshot(df: DataFrame, col: str = "_metadata.file_modification_time") -> DataFrame:
    """Rows of the newest snapshot.

    The newest stamp comes to the driver as one value and goes back as a filter,
    so older files, or row groups, are not read.
    """
    newest = df.select(F.max(F.col(col)).alias("newest")).first()["newest"]
    return df.where(F.col(col) == F.lit(newest))


def select_files(df: DataFrame, pattern: str) -> DataFrame:
    """Rows of files whose name matches, with the name as ``file_name``."""
    name = F.col("_metadata.file_name")
    return df.where(name.rlike(pattern)).withColumn("file_name", name)


def classify(df: DataFrame) -> str:
    """Class of a table by the first signature column it has, in any letter case."""
    names = {c.lower() for c in df.columns}
    return next((table for sign, table in SIGNATURES.items() if sign in names), UNKNOWN)


def load_classified(spark: SparkSession, paths: Sequence[str]) -> dict[str, DataFrame]:
    """Recognised tables by class. Unknown files are left out, a repeated class is an error."""
    found: dict[str, DataFrame] = {}
    for path in paths:
        df = scan(spark, path)
        table = classify(df)
        if table == UNKNOWN:
            continue
        if table in found:
            raise ValueError(f"two files of class {table}: {path}")
        found[table] = df
    return found


def lower_headers(df: DataFrame) -> DataFrame:
    return df.select(*[quoted(c).alias(c.lower()) for c in df.columns])
