"""Session helpers: a configured session, the shared checkpoint folder and a
size-checked broadcast."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest side, by the measured size of its rows, that is hinted for a broadcast.
BROADCAST_BYTES = 16 << 20

# Settings a job of this library expects; all are runtime SQL settings except
# the master and memory, which a cluster submit sets instead.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast a join side only on a measured size: no static guess from file
    # sizes (compressed parquet can be many times larger in memory); AQE
    # converts a join to broadcast from the runtime size of the shuffled side.
    # Explicit hints come only from ``bounded_broadcast``, which measures bytes.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # A long-lived session runs many plans: keep more compiled code around.
    "spark.sql.codegen.cache.maxEntries": "1000",
    # Streaming state off the JVM heap (bundled with Spark), with small
    # changelog commits per micro-batch instead of full snapshots.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "keyreport", conf: dict | None = None) -> SparkSession:
    """Create (or get) a session with AQE and skew-join handling on.

    ``master`` and ``shuffle_partitions`` are for local runs; on a cluster leave
    them to spark-submit.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster must name it; only a local session without one gets its own
    folder (as tests do), and that folder is then set on the context.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a shared folder on the cluster")
    root = tempfile.mkdtemp(prefix="keyreport-ckpt-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, *parts: str) -> str:
    """A new, unique folder path under the shared checkpoint folder."""
    return "/".join([checkpoint_root(spark), "keyreport", *parts, uuid.uuid4().hex])


def bounded_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast only when its rows are proven to take at most
    ``max_bytes``; otherwise return it unchanged so the planner shuffles.

    The check is one partially aggregated sum over the columns ``df`` selects (text
    by its bytes, lists and structs by their JSON, other values 16 bytes each): no
    rows are gathered in one task.
    """
    cost = F.lit(16)
    for f in df.schema.fields:
        kind = f.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            cost = cost + F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) + 16
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            cost = cost + F.coalesce(F.octet_length(F.to_json(F.struct(f"`{f.name}`"))), F.lit(0)) + 16
        else:
            cost = cost + 16
    size = df.agg(F.coalesce(F.sum(cost.cast("long")), F.lit(0)).alias("b")).first()["b"]
    return F.broadcast(df) if size <= max_bytes else df
