"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "kpitide", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are written for. ``conf`` keys use ``__`` for a dot."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, as the cluster names it.

    Only a local session without that setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="kpitide-")
    return _local_roots[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own under the shared folder, for one run of one job."""
    return f"{scratch_root(spark)}/kpitide/{name}-{uuid.uuid4().hex}"
