"""Fixed and sliding event-time windows with watermarks.

``FixedWindows(size)`` is ``F.window(ts, size)``; ``SlidingWindows(size,
period)`` is ``F.window(ts, size, period)``; both are epoch-aligned, start
inclusive, end exclusive. The state of a streaming aggregate lives in Spark's
state store, one per shuffle partition, checkpointed with the offsets.

A window is emitted (append mode) once the watermark — max event time seen
minus ``lateness`` — reaches its end; a row older than the watermark when it
arrives is dropped and counted in ``numRowsDroppedByWatermark``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyreport.session import scratch_dir

__all__ = [
    "EVENT_TIME", "as_event_time", "window_bound", "fixed_window", "sliding_window",
    "windowed_aggregate", "windowed_tagged_aggregate", "windowed_cogroup", "run_to_files",
    "Measure", "sum_of", "count_of", "min_of", "max_of", "mean_of", "pane_aggregate", "windowed_outer_join",
]

EVENT_TIME = "__event_time"
_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def as_event_time(df: DataFrame, ts: str, out: str = EVENT_TIME) -> tuple[DataFrame, bool]:
    """Add ``out`` as a TIMESTAMP usable for windows and watermarks.

    A TIMESTAMP_NTZ column (wall-clock, no zone) is read as UTC, independent of
    the session time zone. Returns the frame and whether the input was NTZ, so
    window bounds can be given back in the input's type.
    """
    ntz = isinstance(df.schema[ts].dataType, T.TimestampNTZType)
    if ntz:
        col = F.expr(f"timestamp_micros(timestampdiff(MICROSECOND, {_EPOCH_NTZ}, `{ts}`))")
    else:
        col = F.col(ts).cast("timestamp")
    return df.withColumn(out, col), ntz


def window_bound(c: Column, ntz: bool) -> Column:
    """A window bound back in the input's type (UTC wall-clock for NTZ)."""
    if not ntz:
        return c
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), F.expr(_EPOCH_NTZ))


def fixed_window(ts: str | Column, size: str) -> Column:
    """``FixedWindows(size)``, e.g. ``'5 seconds'``."""
    return F.window(ts, size)


def sliding_window(ts: str | Column, size: str, period: str) -> Column:
    """``SlidingWindows(size, period)``: each row in ``size/period`` windows."""
    return F.window(ts, size, period)


def windowed_aggregate(df: DataFrame, ts: str, keys: Sequence[str], size: str,
                       aggs: Mapping[str, Column], period: str | None = None,
                       lateness: str | None = "0 seconds") -> DataFrame:
    """Aggregates per (window, keys): ``window_start, window_end, keys..., aggs``.

    ``lateness`` sets the watermark delay (``None``: no watermark; a streaming
    append query needs one). On a batch frame the watermark is a no-op and every
    window is returned.
    """
    df, ntz = as_event_time(df, ts)
    if lateness is not None:
        df = df.withWatermark(EVENT_TIME, lateness)
    w = sliding_window(EVENT_TIME, size, period) if period else fixed_window(EVENT_TIME, size)
    out = df.groupBy(w.alias("window"), *keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return out.select(window_bound(F.col("window.start"), ntz).alias("window_start"),
                      window_bound(F.col("window.end"), ntz).alias("window_end"),
                      *keys, *aggs.keys())


@dataclass(frozen=True)
class Measure:
    """An aggregate in two steps: ``parts`` over rows, each merged by the function beside
    it, and ``final`` over the merged parts."""
    parts: Sequence[tuple[Column, Callable[[Column], Column]]]
    final: Callable[..., Column] = staticmethod(lambda part: part)


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def sum_of(col: str | Column) -> Measure:
    return Measure([(F.sum(_c(col)), F.sum)])


def count_of(col: str | Column | None = None) -> Measure:
    """Rows, or rows whose ``col`` isn't NULL."""
    return Measure([(F.count(F.lit(1) if col is None else _c(col)), F.sum)])


def min_of(col: str | Column) -> Measure:
    return Measure([(F.min(_c(col)), F.min)])


def max_of(col: str | Column) -> Measure:
    return Measure([(F.max(_c(col)), F.max)])


def mean_of(col: str | Column) -> Measure:
    """The mean as a double; NULL values don't count."""
    return Measure([(F.sum(_c(col)), F.sum), (F.count(_c(col)), F.sum)],
                   lambda total, n: F.when(n > 0, total.cast("double") / n))


# Lengths of the interval units that have one.
_UNITS = {"microsecond": 1, "millisecond": 10**3, "second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6,
          "day": 86400 * 10**6, "week": 7 * 86400 * 10**6}


def _micros(interval: str) -> int:
    found = re.findall(r"(\d+)\s+([a-z]+?)s?(?=\s|$)", interval.lower())
    if not found or any(u not in _UNITS for _, u in found):
        raise ValueError(f"not a fixed interval: {interval!r}")
    return sum(int(n) * _UNITS[u] for n, u in found)


def pane_aggregate(df: DataFrame, ts: str, keys: Sequence[str], size: str, period: str,
                   measures: Mapping[str, Measure], lateness: str | None = "0 seconds") -> DataFrame:
    """Sliding windows over panes: ``window_start, window_end, keys..., measures``, the rows of
    ``windowed_aggregate`` with the same window.

    Every row falls into one pane, as long as the greatest common divisor of ``size`` and
    ``period``, and is aggregated there once (map-side combined); only panes are copied
    into the size / period windows that hold them. So a day every minute costs a row one
    update rather than 1,440. On a stream both steps are stateful operators of one
    query; the first keeps a state row per open pane and key, the second one per open
    window and key.
    """
    pane = math.gcd(_micros(size), _micros(period))
    df, ntz = as_event_time(df, ts)
    if lateness is not None:
        df = df.withWatermark(EVENT_TIME, lateness)
    parts = {f"__p{i}_{j}": part for i, m in enumerate(measures.values()) for j, part in enumerate(m.parts)}
    panes = df.groupBy(F.window(EVENT_TIME, f"{pane} microseconds").alias("__pane"), *keys).agg(
        *[step.alias(name) for name, (step, _) in parts.items()])
    # The last instant of a pane is in the same windows as all its rows.
    wide = F.window(F.window_time("__pane"), size, period).alias("window")
    out = panes.groupBy(wide, *keys).agg(*[merge(F.col(name)).alias(name) for name, (_, merge) in parts.items()])
    finals = [m.final(*[F.col(f"__p{i}_{j}") for j in range(len(m.parts))]).alias(name)
              for i, (name, m) in enumerate(measures.items())]
    return out.select(window_bound(F.col("window.start"), ntz).alias("window_start"),
                      window_bound(F.col("window.end"), ntz).alias("window_end"), *keys, *finals)


def windowed_outer_join(sides: Mapping[str, tuple[DataFrame, Mapping[str, Column]]], ts: str, keys: Sequence[str],
                        size: str, period: str | None = None, lateness: str | None = "0 seconds") -> DataFrame:
    """Two inputs, each aggregated per (window, keys) by aggregates of its own, met in a full
    outer join: ``window_start, window_end, keys..., <tag>_<name>...`` with NULL where a
    side has no row. NULL keys meet.

    On streams this is two stateful aggregates with a watermark each and a stream-stream
    join: a closed window waits in the join's state for the other side and comes out
    alone once the later of both watermarks has passed its end. Sides that are sums and
    counts need no join, see ``windowed_cogroup``; this is for any other aggregates.
    """
    if len(sides) != 2:
        raise ValueError("a windowed outer join has two sides")
    frames, ntz = [], False
    for tag, (df, aggs) in sides.items():
        df, ntz = as_event_time(df, ts)
        if lateness is not None:
            df = df.withWatermark(EVENT_TIME, lateness)
        w = sliding_window(EVENT_TIME, size, period) if period else fixed_window(EVENT_TIME, size)
        frames.append(df.groupBy(w.alias(f"{tag}_window"), *[F.col(k).alias(f"{tag}__{k}") for k in keys]).agg(
            *[c.alias(f"{tag}_{n}") for n, c in aggs.items()]))
    (a, b), (left, right) = sides, frames
    met = F.col(f"{a}_window") == F.col(f"{b}_window")
    for k in keys:
        met = met & F.col(f"{a}__{k}").eqNullSafe(F.col(f"{b}__{k}"))
    both = left.join(right, met, "full_outer")
    window = F.coalesce(f"{a}_window", f"{b}_window")
    return both.select(
        window_bound(window["start"], ntz).alias("window_start"), window_bound(window["end"], ntz).alias("window_end"),
        *[F.coalesce(f"{a}__{k}", f"{b}__{k}").alias(k) for k in keys],
        *[f"{tag}_{n}" for tag, (_, aggs) in sides.items() for n in aggs])


def windowed_tagged_aggregate(df: DataFrame, ts: str, keys: Sequence[str], tag: str | Column,
                              tags: Sequence[str], value: str, size: str, period: str | None = None,
                              lateness: str | None = "0 seconds") -> DataFrame:
    """Per (window, key), for every tag: the sum and the count of ``value`` over
    the rows carrying that tag (``<tag>_total``, ``<tag>_n``; 0 and NULL when
    the tag has no row in the window). Rows with another tag are skipped before
    the aggregate.

    This is a co-group of branches that come from one input: one scan and one
    stateful aggregate instead of a scan and an aggregate per branch.
    """
    tag_col = F.col(tag) if isinstance(tag, str) else tag
    rows = df.select(ts, *keys, value, tag_col.alias("__tag")).where(F.col("__tag").isin(list(tags)))
    aggs: dict[str, Column] = {}
    for t in tags:
        hit = F.col("__tag") == t
        aggs[f"{t}_total"] = F.sum(F.when(hit, F.col(value)))
        aggs[f"{t}_n"] = F.count(F.when(hit, F.lit(1)))
    return windowed_aggregate(rows, ts, keys, size, aggs, period, lateness)


def windowed_cogroup(sides: Mapping[str, DataFrame], ts: str, keys: Sequence[str], value: str,
                     size: str, period: str | None = None,
                     lateness: str | None = "0 seconds") -> DataFrame:
    """Co-group of several keyed inputs per (window, key): for every tag the sum
    and the count of ``value`` (see ``windowed_tagged_aggregate``).

    The inputs are tagged and unioned and then aggregated once, so the plan holds
    one stateful operator and one state store rather than an aggregate per side
    plus a stream-stream join. When the sides are filters of one input, call
    ``windowed_tagged_aggregate`` on that input directly: it scans it once.
    """
    tagged = None
    for t, df in sides.items():
        part = df.select(ts, *keys, value).withColumn("__side", F.lit(t))
        tagged = part if tagged is None else tagged.unionByName(part)
    return windowed_tagged_aggregate(tagged, ts, keys, "__side", list(sides), value, size, period, lateness)


def run_to_files(spark: SparkSession, stream: DataFrame, name: str, output_mode: str = "append",
                 base: str | None = None) -> DataFrame:
    """Run a streaming query over all input available now, appending its output
    to parquet under the shared checkpoint folder, and return that output as a
    batch DataFrame. The query's checkpoint sits beside it (``base``: in that folder),
    so a rerun after a failure, or with later input, resumes without duplicate rows."""
    base = base or scratch_dir(spark, "streams", name)
    sink, ckpt = f"{base}/out", f"{base}/checkpoint"
    q = (stream.writeStream.format("parquet").outputMode(output_mode)
         .option("path", sink).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.schema(stream.schema).parquet(sink)
