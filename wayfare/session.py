"""SparkSession construction and session-level settings.

The library never creates a session behind the caller's back: every operator
takes DataFrames. ``get_session`` is for tests, the bench and scripts.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter for correctness (not just speed) of the operators.
CORRECTNESS_CONF = {
    # Dates and weekday math are computed on DATE values; pin the zone so a
    # TIMESTAMP source cast to DATE gives the same day everywhere.
    "spark.sql.session.timeZone": "UTC",
}

# Settings for running at scale. AQE re-plans joins and coalesces partitions
# from runtime statistics; skew join splits hot keys of sort-merge joins.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Python workers run numpy kernels one per task slot: one BLAS thread
    # each, or 8 workers x 8 BLAS threads oversubscribe the cores.
    "spark.executorEnv.OMP_NUM_THREADS": "1",
    "spark.executorEnv.OPENBLAS_NUM_THREADS": "1",
    "spark.executorEnv.MKL_NUM_THREADS": "1",
}


def get_session(master: str | None = None, app: str = "wayfare",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    master = master or os.environ.get("WAYFARE_MASTER", "local[8]")
    b = SparkSession.builder.master(master).appName(app)
    conf = {**CORRECTNESS_CONF, **SCALE_CONF,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("WAYFARE_DRIVER_MEMORY", "8g")}
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # pragma: no cover - sessions without a local SparkContext
        pass
    return spark


# Folders chosen for local sessions without a setting, by application.
_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which the driver and all
    executors share.

    Only a session in one process (master ``local`` or ``local[...]``, as in
    tests) gets a temporary folder when the setting is missing. On a cluster
    a machine-local folder would be invisible to the other machines, so there
    it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if context.applicationId not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="wayfare-shared-")
        folder = _LOCAL_FOLDERS[context.applicationId]
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def written(df, name: str):
    """The table written to the shared folder and read back: later passes read
    it instead of computing it again, a lost executor costs a re-read, and no
    cache has to be released."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
