"""Readers and writers: declared-schema scans and full-replace table loads."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from growthlens.sources.schemas import FEED_SCHEMAS


# Fixed value: ISO-8601 text of the load audit stamp.
LOADED_AT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def stamp_loaded_at(df: DataFrame) -> DataFrame:
    """Set the ``loaded_at`` audit column to the load time as ISO text in UTC.

    ``current_timestamp()`` is fixed once per query, so every row of one load
    carries the same stamp (also on retried tasks).
    """
    utc = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    stamp = F.date_format(utc, LOADED_AT_FORMAT).alias("loaded_at")
    return df.select(*[c for c in df.columns if c != "loaded_at"], stamp)


def load_feed(df: DataFrame, path: str) -> DataFrame:
    """Full-replace load of a raw feed with a fresh audit stamp; returns the stored copy."""
    return overwrite_roundtrip(stamp_loaded_at(df), path)


def read_feed(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Scan a raw feed with its declared schema (no inference, pushdown intact)."""
    schema = FEED_SCHEMAS[name]
    return spark.read.schema(schema).format(fmt).load(path)


_VERSION = "version="


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of the committed versions of the table at ``path``, oldest first."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]
    done = [n for n in names if n.startswith(_VERSION) and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    return [f"{path}/{n}" for n in sorted(done)]


def current_path(spark: SparkSession, path: str) -> str:
    """Where the current rows of the table at ``path`` are."""
    return (_versions(spark, path) or [path])[-1]


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] | None = None,
    fmt: str = "parquet",
    replace_partitions_only: bool = False,
) -> str:
    """Full-replace load in one step, on success only; returns the folder written.

    Each load goes to a new version folder.  Readers take the newest version
    with Spark's success marker, so the old rows stay current until the whole
    job has committed, a failed load leaves them untouched, and loads at the
    same time do not write to one folder.  ``drop_old_versions`` frees space.

    ``replace_partitions_only`` replaces just the partitions present in ``df``
    in the current version (dynamic partition overwrite) and keeps the others.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    if partition_by and replace_partitions_only:
        target = current_path(spark, path)
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        target = f"{path}/{_VERSION}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        writer = df.write
    writer = writer.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(target)
    return target


def drop_old_versions(spark: SparkSession, path: str, keep: int = 1) -> None:
    """Deletes all but the newest ``keep`` committed versions; only when no reader uses the older ones."""
    jvm = spark.sparkContext._jvm
    for old in _versions(spark, path.rstrip("/"))[: -max(1, keep)]:
        folder = jvm.org.apache.hadoop.fs.Path(old)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """Read the current version of a written table (schema taken from the files unless given)."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(current_path(spark, path.rstrip("/")))


def publish_table(spark: SparkSession, name: str, path: str) -> None:
    """Names the current version of the table at ``path`` in the session's catalog.

    ``name`` (``database.table`` or ``table``) becomes a stored view on that
    version.  Replacing the view is one catalog step, so readers by name see the
    old load or the new one, never a mixture, and a failed load changes nothing.
    """
    target = current_path(spark, path.rstrip("/"))
    quoted = ".".join(f"`{part}`" for part in name.split("."))
    spark.sql(f"create or replace view {quoted} as select * from parquet.`{target}`")


def overwrite_roundtrip(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> DataFrame:
    """Write ``df`` as a full-replace table at ``path`` and return the stored copy.

    The returned frame reads the version it wrote, so its lineage stops at the
    write and a later load does not change it.
    """
    target = write_table(df, path, partition_by=partition_by)
    return read_table(df.sparkSession, target, schema=df.schema).select(*df.columns)
