"""Session helpers: sane defaults, checkpoint directory, lineage cuts."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "colloquy",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session for tests, bench and scripts. On a cluster, pass master=None."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    return sc.getConf().get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Use ``spark.checkpoint.dir`` when set; only a local session (one machine,
    as in tests) gets a folder of its own where it is missing."""
    sc = spark.sparkContext
    d = checkpoint_dir(spark) or fallback
    if d is None:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir is not set: it must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="colloquy-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory (never machine-local
    on a cluster, because the checkpoint dir is the cluster's shared folder)."""
    base = ensure_checkpoint_dir(spark)
    run = f"{name}-{os.getpid()}-{next(_counter)}-{os.urandom(4).hex()}"
    return base.rstrip("/") + "/colloquy-scratch/" + run


def _count():
    i = 0
    while True:
        i += 1
        yield i


_counter = _count()


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage reliably: ``df`` written once to a table in the shared folder
    (survives executor loss) and read back.  A checkpoint would compute it
    twice, once to count it and once to store it."""
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def persist(df: DataFrame) -> DataFrame:
    """Cache for reuse within one job; recomputed from lineage on loss."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
