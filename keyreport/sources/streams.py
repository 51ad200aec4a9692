"""Unbounded sources and the per-batch consumer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

# Input of one micro-batch; size it to the cluster (about 128 MB a core).
MAX_BYTES = 64 << 30

__all__ = ["MAX_BYTES", "read_file_stream", "read_table_stream", "read_messages", "consume"]


def read_file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                     max_bytes_per_trigger: int | None = MAX_BYTES, **options) -> DataFrame:
    """Files arriving in a folder (or matching a glob) as a stream; each new file
    is read once, tracked in the query's checkpoint. A micro-batch takes files up to
    ``max_bytes_per_trigger`` (one at least; None: all there are), so neither a
    backlog becomes one batch nor each small file a batch of its own."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def read_table_stream(spark: SparkSession, base: str, name: str, schema: T.StructType,
                      max_bytes_per_trigger: int | None = MAX_BYTES) -> DataFrame:
    """The parquet table ``{base}/{name}.parquet`` (one file or a folder of part
    files) as a file stream."""
    base = base.rstrip("/")
    return read_file_stream(spark, f"{base}/{name}.parq[u]et", schema, "parquet",
                            max_bytes_per_trigger, basePath=base)


def read_messages(spark: SparkSession, fmt: str = "kafka", schema: T.StructType | str | None = None,
                  **options) -> DataFrame:
    """A message stream as ``value: BINARY, ts: TIMESTAMP`` (``ReadFromPubSub``).

    ``fmt`` is any streaming source with ``value`` and ``timestamp`` columns,
    e.g. ``kafka`` with ``kafka.bootstrap.servers`` and ``subscribe`` options,
    or a file format (give ``schema`` and a ``path`` option). A broker
    connector jar must be on the classpath; it is not part of this library. Bound
    its batches with the source's own option (``maxOffsetsPerTrigger``); a file
    format takes ``maxBytesPerTrigger``, ``MAX_BYTES`` if not given.
    """
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if schema is not None:
        options = {"maxBytesPerTrigger": MAX_BYTES} | options
    for k, v in options.items():
        reader = reader.option(k, v)
    df = reader.load()
    return df.select(F.col("value").cast("binary").alias("value"), F.col("timestamp").alias("ts"))


def consume(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
            available_now: bool = False) -> StreamingQuery:
    """``subscribe(callback)`` with ack: ``handle(batch_df, batch_id)`` runs per
    micro-batch and the source offsets are committed to ``checkpoint`` only after
    it returns (at-least-once; make ``handle`` idempotent per ``batch_id``)."""
    w = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
