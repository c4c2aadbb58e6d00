"""Session and shared-folder helpers.

Intermediate outputs (checkpoints, landing fixtures, stream sinks of the demo queries) go to the
shared folder the cluster names in ``spark.checkpoint.dir``. Only when that setting is unset on a
local master (tests, a laptop) is a fresh local folder created and registered as the checkpoint dir.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.speculation": "false",
    # HotSpot does not JIT-compile methods above 8000 bytes of bytecode; a whole-stage method
    # that large (hundreds of row checks) would run interpreted. Above this size Spark falls back
    # to per-expression code generation, which splits the work into small compiled methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(master: str = "local[8]", app: str = "sluice", **conf) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in {**LOCAL_CONF, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; created locally only for local masters when unset."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if root:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; on a cluster it must name a shared folder"
        )
    root = tempfile.mkdtemp(prefix="sluice-ckpt-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir().rstrip("/")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    path = f"{checkpoint_root(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"
    if spark.sparkContext.master.startswith("local") and ("://" not in path or path.startswith("file:")):
        os.makedirs(path.removeprefix("file:"), exist_ok=True)
    return path


def cut_lineage(df):
    """Reliable checkpoint into the shared folder (survives executor loss, unlike a local one)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
