"""Session helpers: a shared scratch location and tuned defaults.

On a cluster the scratch location must be a shared filesystem, so it is taken
from ``spark.checkpoint.dir`` of the running session; without that setting library
code raises.  Only a ``local[...]`` session gets a folder of its own, registered so
that ``DataFrame.checkpoint()`` works too.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def build_session(master: str = "local[8]", app: str = "intervalflow",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Session for tests, bench and scripts.  Cluster jobs get theirs from the launcher."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session.  Only a ``local[...]`` session, whose
    tasks all run on this machine, gets one of its own when the setting is absent."""
    root = spark.conf.get(_CKPT_KEY, None) or spark.sparkContext.getConf().get(_CKPT_KEY, None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError(f"set {_CKPT_KEY} to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="intervalflow-ckpt-")
        spark.conf.set(_CKPT_KEY, root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh, never reused path below the shared checkpoint root; its writer creates it."""
    root = checkpoint_root(spark)
    return f"{root.rstrip('/')}/intervalflow-scratch/{tag}-{uuid.uuid4().hex}"


def staged(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to a fresh table in the shared folder and read back: computed once, and safe from lost executors."""
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
