"""Session for local work. On a cluster the caller's own session is used as it is."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", app: str = "parley", **conf: str) -> SparkSession:
    """A local session. UTC, AQE with skew splitting, ANSI left on."""
    partitions = cpus if isinstance(cpus, int) else 8
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.driver.memory": "8g",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def require_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``.

    Only a session on one machine may go without; on a cluster a machine-local folder would
    be lost with its machine.
    """
    context = spark.sparkContext
    configured = context.getCheckpointDir() or context.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured
    if not context.master.startswith("local[") and context.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    own = tempfile.mkdtemp(prefix="parley-")
    context.setCheckpointDir(own)
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    return own
