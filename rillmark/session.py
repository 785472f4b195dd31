"""Session factory and the shared-folder rule for checkpoints."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "rillmark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time, ANSI arithmetic and adaptive execution on."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        # checkpoints go when nothing refers to them any more
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for k, v in {**base, **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir`` of the session.

    A machine-local folder is made only where none is set and the master is local, as in tests.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    d = tempfile.mkdtemp(prefix="rillmark-")
    spark.conf.set("spark.checkpoint.dir", d)
    return d


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder once, with its lineage cut."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
