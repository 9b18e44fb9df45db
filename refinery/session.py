"""Session creation and the shared scratch location.

Intermediate and demo outputs are written below the cluster's shared
checkpoint folder (``spark.checkpoint.dir``), never below a machine-local
temporary folder.  Only a ``local[...]`` session that names no such folder
(unit tests, a laptop) gets one of its own; on a cluster that is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings we rely on.  AQE re-plans joins and coalesces / splits
# shuffle partitions at run time (skew join, skewed rebalance); UTC keeps
# date casts identical to the SQL oracle.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(app: str = "refinery", master: str | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings above plus ``conf``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster, created only when unset."""
    root = None
    try:
        sc = spark.sparkContext
        root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    except Exception:  # Spark Connect: no SparkContext on the client
        sc = None
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:
            root = None
    if not root:
        root = spark.__dict__.get("_refinery_local_root")
    if not root:
        if sc is None or not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        # Kept on the session object: a later session gets its own folder.
        root = tempfile.mkdtemp(prefix="refinery-ckpt-")
        spark.__dict__["_refinery_local_root"] = root
        if sc is not None:
            sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory path below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/refinery/{name}-{uuid.uuid4().hex[:12]}"
