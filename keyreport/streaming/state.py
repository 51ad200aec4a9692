"""What a streaming query leaves in its checkpoint, as batch tables.

* ``state_rows``: the state store, such as the windows that append mode hasn't emitted yet.
* ``batch_watermarks`` and ``batch_files``: the watermark and the input files of each batch.
* ``late_rows``: the input rows that a windowed aggregate dropped, whole, not only their
  number. (The query's own counter ``numRowsDroppedByWatermark`` counts partial aggregates:
  rows of one task, window and key count once.)

All of them read what the query has committed; the query may be stopped, and nothing is
kept on the driver between runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keyreport.session import bounded_broadcast
from keyreport.streaming.windows import EVENT_TIME, as_event_time, fixed_window, sliding_window, window_bound

__all__ = ["state_rows", "open_windows", "batch_watermarks", "batch_files", "late_rows", "DROPPED_FROM"]

DROPPED_FROM = "dropped_from"


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0, batch_id: int | None = None) -> DataFrame:
    """Rows ``key, value`` (structs) of one stateful operator, after the last committed
    batch or ``batch_id``. Operators are numbered from the sink."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint).select("key", "value")


def open_windows(spark: SparkSession, checkpoint: str, keys: Sequence[str], values: dict[str, str],
                 operator: int = 0, ntz: bool = False) -> DataFrame:
    """The windows that a windowed aggregate holds open: ``window_start, window_end``,
    ``keys...`` and, by ``values``, names for its buffers (such as ``{"n": "count"}``).
    ``ntz``: the event time had no zone."""
    rows = state_rows(spark, checkpoint, operator)
    return rows.select(window_bound(F.col("key.window.start"), ntz).alias("window_start"),
                       window_bound(F.col("key.window.end"), ntz).alias("window_end"),
                       *[F.col(f"key.`{k}`").alias(k) for k in keys],
                       *[F.col(f"value.`{b}`").alias(n) for n, b in values.items()])


def _offset_log(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``batch_id, lines`` of each batch's entry: version, metadata, then an offset per source."""
    files = spark.read.text(f"{checkpoint}/offsets", wholetext=True)
    return files.select(F.regexp_extract("_metadata.file_name", r"(\d+)$", 1).cast("long").alias("batch_id"),
                        F.split("value", "\n").alias("lines")).where("size(lines) > 1")


def batch_watermarks(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``batch_id, watermark, late_before`` of each batch in the offset log: the watermark
    that closes windows in that batch, and the one before, which makes its rows late. The log keeps
    the last ``spark.sql.streaming.minBatchesToRetain`` batches."""
    marks = _offset_log(spark, checkpoint).select("batch_id", F.timestamp_millis(F.get_json_object(
        F.get("lines", 1), "$.batchWatermarkMs").cast("long")).alias("watermark"))
    before = F.lag("watermark").over(Window.orderBy("batch_id"))  # one row per batch
    return marks.select("batch_id", "watermark", F.when(F.col("batch_id") == 0, F.timestamp_millis(F.lit(0)))
                        .otherwise(before).alias("late_before"))


def batch_files(spark: SparkSession, checkpoint: str, source: int = 0) -> DataFrame:
    """``batch_id, file`` of a file source: the batch that read each input file (NULL if its
    entry is no longer in the offset log). A batch reads what the source logged up to its offset."""
    log = spark.read.text(f"{checkpoint}/sources/{source}").select(F.from_json("value", "path string, batchId long").alias("e"))
    # A compacted log repeats earlier entries.
    files = log.where("e.path IS NOT NULL").select(F.col("e.batchId").alias("logged"), F.col("e.path").alias("file")).distinct()
    upto = _offset_log(spark, checkpoint).select("batch_id", F.get_json_object(
        F.get("lines", 2 + source), "$.logOffset").cast("long").alias("upto"))
    # One row per kept batch; a batch without data repeats the offset before it.
    steps = upto.groupBy("upto").agg(F.min("batch_id").alias("batch_id"))
    steps = steps.withColumn("after", F.lag("upto").over(Window.orderBy("upto")))
    # The oldest entry left says nothing of what came before it, unless it is the first batch.
    start = F.when(F.col("batch_id") == 0, F.lit(0)).otherwise(F.col("after") + 1)
    steps = steps.select("batch_id", "upto", start.alias("start")).where("start <= upto")
    steps = steps.select("batch_id", F.explode(F.sequence("start", "upto")).alias("logged"))
    return files.join(steps, "logged", "left").select("batch_id", "file")


def _same_form(path: str) -> Column:
    """A path as readers and logs both have it (file:/x and file:///x)."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def late_rows(spark: SparkSession, checkpoint: str, rows: DataFrame, ts: str, size: str,
              period: str | None = None, source: int = 0) -> DataFrame:
    """The rows of ``rows`` (a batch read of the stream's input files) that a windowed
    aggregate over them dropped: their columns, ``batch_id``, and ``dropped_from``, the
    window (start, end) that was closed when they came. A row of several sliding windows
    comes once per window it missed. Rows of batches whose watermark is no longer in the
    log fail the read rather than being left out.

    Only rows below the highest of these watermarks meet the list of files."""
    names = rows.columns
    marks = batch_watermarks(spark, checkpoint)
    highest = marks.agg(F.max("late_before").alias("m")).first()["m"]
    files = batch_files(spark, checkpoint, source).join(marks, "batch_id", "left")
    known = F.coalesce("late_before", F.raise_error(F.concat(
        F.lit("no watermark is kept for the batch of "), F.col("file"))).cast("timestamp"))
    files = files.select("batch_id", _same_form("file").alias("file"), known.alias("late_before"))
    timed, _ = as_event_time(rows.withColumn("__file", _same_form("_metadata.file_path")), ts)
    w = sliding_window(EVENT_TIME, size, period) if period else fixed_window(EVENT_TIME, size)
    windowed = timed.withColumn(DROPPED_FROM, w).where(F.col(f"{DROPPED_FROM}.end") <= F.lit(highest))
    met = windowed.join(bounded_broadcast(files), windowed["__file"] == files["file"])
    return met.where(F.col(f"{DROPPED_FROM}.end") <= F.col("late_before")).select(*names, "batch_id", DROPPED_FROM)
