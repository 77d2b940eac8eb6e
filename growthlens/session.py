"""Session settings and the shared storage folder.

On a cluster the session is created by the platform and already names a shared
``spark.checkpoint.dir``; we only read it.  A private folder is created only
when the setting is missing *and* the master is local (tests, bench).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every growthlens job relies on.  AQE re-plans joins from runtime
# sizes (the size check behind every broadcast), coalesces small shuffle
# partitions and splits skewed ones.
_SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
# Static settings (only at session creation).  Skipping the capture of the
# Python call site on every Column function call saves several driver round
# trips per expression while plans are built.
_STATIC_CONF = {
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "growthlens",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create a session with growthlens' SQL settings; an active session is returned as it is.

    ``master`` and ``shuffle_partitions`` are for local runs; on a cluster leave
    them unset so the platform's values apply.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        # Local runs are non-interactive: no web UI, driver holds all memory.
        builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        builder = builder.config("spark.driver.memory", os.environ.get("GROWTHLENS_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**_STATIC_CONF, **_SQL_CONF, **(extra_conf or {})}.items():
        builder = builder.config(key, value)
    existing = SparkSession.getActiveSession()
    if existing is not None:
        return existing  # its settings belong to whoever created it
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by all executors for written tables and checkpoints.

    Read from the session: the configured ``spark.checkpoint.dir`` (the stable
    base, not the per-application subfolder Spark creates under it), else a
    checkpoint dir set on the context.  Only a local-mode session with neither
    gets a private temporary folder.
    """
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    found = found or sc.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder all executors share "
            "(a machine-local temporary folder is not safe on a cluster)"
        )
    local = tempfile.mkdtemp(prefix="growthlens-")
    sc.setCheckpointDir(local)
    return local
