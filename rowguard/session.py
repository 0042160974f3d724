"""Session helpers for tests, the bench and the examples.

On a cluster the session comes from the platform; these helpers only fill in
settings that are *unset*, never override what the cluster configured.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and the bench (``local[cores]``)."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("rowguard")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
    )
    for k, v in {**LOCAL_DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    A session whose driver and executors are one process may go without: it gets
    a fresh scratch folder. Anywhere else such a folder would be invisible to
    the other machines, so an unset one is an error.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    try:
        context = spark.sparkContext
    except PySparkException:  # a remote session has none; its server reads the setting itself
        if not conf:
            raise ValueError("spark.checkpoint.dir is not set; name a folder that all executors share") from None
        return conf
    configured = context.getCheckpointDir()
    if configured:
        return configured
    if not conf:
        master = context.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is not set; name a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="rowguard-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    context.setCheckpointDir(conf)
    return context.getCheckpointDir() or conf
