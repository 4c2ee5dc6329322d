"""Session helpers: sensible defaults for large jobs, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings a job relies on. They only fill gaps: a cluster's own values win.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a checkpoint's files go when nothing refers to it any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None) -> SparkSession:
    """A local session for tests and the bench (`local[cores]`)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName("tessera")
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
    b = b.config("spark.driver.memory", "16g")
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this names shared storage and is left alone.  Only where it is
    unset on a local master (a bare test) is a scratch folder chosen: elsewhere a
    folder of one machine would not be seen by the others, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """The rows written once to the checkpoint folder, for steps that would each compute them anew."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
