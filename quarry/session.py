"""Session construction and the shared folder used to cut lineage.

On a cluster ``spark.checkpoint.dir`` names a shared, fault-tolerant
folder (HDFS, object store).  Everything this package writes as an
intermediate (checkpoints, table snapshots, stream state) lives under it.
Only when the setting is absent -- tests, a laptop -- do we make one.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that hold on any cluster size.  Shuffle partition count is left
# to AQE coalescing; the initial number should be sized by the deployer for
# the target scale (e.g. input bytes / 128 MB).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app: str = "quarry",
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if master and master.startswith("local"):
        # Single-host runs: bind the driver to loopback on both settings.
        conf["spark.driver.host"] = "127.0.0.1"
        conf["spark.driver.bindAddress"] = "127.0.0.1"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; created under /tmp only when unset."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = sc.getConf().get("spark.checkpoint.dir", None)
        if d:
            sc.setCheckpointDir(d)
            d = sc.getCheckpointDir()
    if not d:
        if not (sc.master or "").startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir names no folder that the cluster shares")
        d = tempfile.mkdtemp(prefix="quarry-ckpt-")  # local / test sessions only
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir()
    return d


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared folder (never reused, never cleaned)."""
    base = shared_dir(spark).rstrip("/")
    return "/".join([base, "quarry", *parts, uuid.uuid4().hex])
