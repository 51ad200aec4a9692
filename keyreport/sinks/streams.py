"""Streaming writers."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

__all__ = ["write_messages", "publish_table", "preview_batches", "fan_out", "batch_folder"]


def write_messages(stream: DataFrame, checkpoint: str, fmt: str = "kafka",
                   available_now: bool = False, **options) -> StreamingQuery:
    """``WriteToPubSub``: a stream with a ``value`` column to a topic sink (e.g.
    ``kafka`` with ``kafka.bootstrap.servers`` and ``topic``)."""
    w = stream.select("value").writeStream.format(fmt).option("checkpointLocation", checkpoint)
    for k, v in options.items():
        w = w.option(k, v)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def publish_table(df: DataFrame, fmt: str = "kafka", path: str | None = None, **options) -> None:
    """Publish every row of a batch table (``value`` column, and ``timestamp``
    when present) to a topic, or, with a file format and ``path``, to files a
    file stream source picks up."""
    cols = ["value"] + (["timestamp"] if "timestamp" in df.columns and fmt != "kafka" else [])
    w = df.select(*cols).write.format(fmt)
    for k, v in options.items():
        w = w.option(k, v)
    if path:
        w.mode("append").save(path)
    else:
        w.save()


def preview_batches(stream: DataFrame, checkpoint: str, n: int = 20,
                    available_now: bool = False) -> StreamingQuery:
    """Print a bounded preview of every micro-batch (the consumer's print)."""

    def show(batch: DataFrame, batch_id: int) -> None:
        print(f"batch {batch_id}")
        batch.show(n, truncate=False)

    w = stream.writeStream.foreachBatch(show).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def batch_folder(path: str, batch_id: int) -> str:
    """The folder of one batch below ``path``; overwriting it makes a replay harmless."""
    return f"{path}/batch_id={batch_id}"


def _marker(spark: SparkSession, marks: str, sink: str, batch_id: int):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{marks}/{sink}/{batch_id}")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def fan_out(stream: DataFrame, sinks: Mapping[str, Callable[[DataFrame, int], None]], checkpoint: str,
            available_now: bool = False) -> StreamingQuery:
    """One source feeding several sinks: each micro-batch is read and computed once, kept,
    and given to every ``sink(batch, batch_id)`` in turn.

    A sink that returns gets a marker for that batch under ``<checkpoint>-sinks``, and the
    source's offsets are committed after the last one. If a sink fails, the batch is
    replayed on restart for it and the sinks behind it only. A sink that writes
    ``batch_folder`` with overwrite also survives a failure between its write and its marker.
    """
    marks = f"{checkpoint}-sinks"

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        marked = {name: _marker(spark, marks, name, batch_id) for name in sinks}
        todo = [name for name, (fs, path) in marked.items() if not fs.exists(path)]
        if not todo:
            return
        batch.persist()
        try:
            for name in todo:
                sinks[name](batch, batch_id)
                fs, path = marked[name]
                fs.create(path, True).close()
        finally:
            batch.unpersist()

    w = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
