"""Shared helpers of the training-data operators.

* ``written`` cuts lineage with a parquet table under ``spark.checkpoint.dir``,
  the folder all executors share.
* ``tidy`` removes the tables that a step wrote and its result doesn't read.
* ``join_small`` joins by a broadcast only after the small side's rows and bytes
  were measured under a fixed bound; beyond it the planner shuffles.
* ``words`` finds and hashes the words of many texts at once with numpy.
* ``components`` labels connected components with grouped minima only.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Callable, Iterator
from contextvars import ContextVar
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyreport.session import scratch_dir

# Largest side (bytes of its rows, measured) that join_small may broadcast.
BROADCAST_BYTES = 32 << 20
# Text bytes handled at once inside a Python task.
CHUNK_BYTES = 1 << 20
# Spark's setting that drops a query's shuffle files when the query has ended.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Tables written by the innermost step that tidies up.
_WRITTEN: ContextVar[list[str] | None] = ContextVar("written", default=None)


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` as a parquet table in the shared folder, read back: later steps
    survive a lost executor without computing it again. The shuffle files behind it
    go when it is written: nothing reads them again."""
    spark = df.sparkSession
    path = scratch_dir(spark, "llm", name)
    if _WRITTEN.get() is not None:
        _WRITTEN.get().append(path)
    before = spark.conf.get(DROP_SHUFFLES)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path, compression=compression)
    finally:
        spark.conf.set(DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def join_small(big: DataFrame, small: DataFrame, on: str | list[str], how: str = "inner",
               row_bytes: Column | int = 32) -> DataFrame:
    """Join ``big`` with ``small``, which should be a written table. ``small`` is
    broadcast when its measured size (sum of ``row_bytes``) is at most
    ``BROADCAST_BYTES``; otherwise both sides shuffle. The rows are the same."""
    cost = row_bytes if isinstance(row_bytes, Column) else F.lit(row_bytes)
    size = small.agg(F.coalesce(F.sum(cost), F.lit(0)).alias("b")).first()["b"]
    return big.join(F.broadcast(small) if size <= BROADCAST_BYTES else small.hint("merge"), on, how)


def tidy(step: Callable) -> Callable:
    """``step``, a function that returns one or several DataFrames, without the tables
    that ``written`` made in it: when it returns, those that none of its results reads
    are removed. Those that stay belong to the step around it, if that tidies up, too.
    A table that is kept elsewhere than in the results must not be written in ``step``."""
    @functools.wraps(step)
    def run(*args, **kwargs):
        outer = _WRITTEN.get()
        token = _WRITTEN.set([])
        try:
            out = step(*args, **kwargs)
            paths = _WRITTEN.get()
        finally:
            _WRITTEN.reset(token)
        frames = [x for x in (out if isinstance(out, tuple) else (out,)) if x is not None]
        read = {f.rsplit("/", 2)[1] for x in frames for f in x.inputFiles()}  # each table's folder has a name of its own
        for path in paths:
            if path.rsplit("/", 1)[1] not in read:
                removed(frames[0].sparkSession if frames else SparkSession.active(), path)
            elif outer is not None:
                outer.append(path)
        return out

    return run


def drop(done: DataFrame) -> None:
    """Remove the table ``done``, which ``written`` gave and nothing reads any more."""
    for path in {f.rsplit("/", 1)[0] for f in done.inputFiles()}:
        removed(done.sparkSession, path)


def removed(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def lut(pattern: Callable[[int], bool]) -> np.ndarray:
    return np.array([pattern(b) for b in range(256)], dtype=np.uint8)


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SAME = np.arange(256, dtype=np.uint8)
# Byte classes; every byte of a multi-byte UTF-8 character is >= 0x80.
NOT_SPACE = lut(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
WORD_BYTES = lut(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)


def _odd_powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, dtype=U64)
    out[0] = 1
    filled = 1
    with np.errstate(over="ignore"):
        step = U64(base)
        while filled < n:
            take = min(filled, n - filled)
            out[filled:filled + take] = out[:take] * step
            step = step * step
            filled += take
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


class _Hasher:
    """Hash of byte ranges by prefix sums: sum of T[byte] * B^i modulo 2^64, with
    random T and odd (so invertible) B; ``lane`` picks independent T and B."""

    def __init__(self, lane: int):
        rng = np.random.default_rng(20_240_117 + lane)
        self.t = rng.integers(1, 2**63, 256, dtype=np.int64).astype(U64) | U64(1)
        self.b = int(rng.integers(2**40, 2**62)) | 5
        self.pow = self.inv = np.ones(1, dtype=U64)

    def ranges(self, b: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self.over(self.t[b], start, end)

    def over(self, values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of ranges of 64-bit values."""
        n = len(values)
        if len(self.pow) < n:
            self.pow = _odd_powers(self.b, n + 1024)
            self.inv = _odd_powers(pow(self.b, -1, 1 << 64), n + 1024)
        with np.errstate(over="ignore"):
            c = np.empty(n + 1, dtype=U64)
            c[0] = 0
            np.cumsum(values * self.pow[:n], out=c[1:])
            # An empty range may start behind the last value.
            h = (c[end] - c[start]) * self.inv[np.minimum(start, len(self.inv) - 1)]
            return mix(h + (end - start).astype(U64))


_HASHERS: dict[int, _Hasher] = {}


def range_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray, lane: int = 0) -> np.ndarray:
    return _hasher(lane).over(values, start, end)


def _hasher(lane: int) -> _Hasher:
    if lane not in _HASHERS:
        _HASHERS[lane] = _Hasher(lane)
    return _HASHERS[lane]


@dataclass
class Words:
    """The words of a chunk of texts: ``first[i]:first[i + 1]`` are text i's."""
    data: np.ndarray                # the texts' bytes, after letter mapping, a newline after each
    start: np.ndarray               # byte range of each word in data
    end: np.ndarray
    first: np.ndarray               # n_texts + 1 offsets into the word arrays
    lanes: list[np.ndarray]         # 64-bit hashes of each word

    @property
    def h(self) -> np.ndarray:
        return self.lanes[0]

    def text(self, w: int) -> str:
        return self.data[self.start[w]:self.end[w]].tobytes().decode("utf-8", "replace")


def words(texts: pa.Array, word_bytes: np.ndarray, letters: np.ndarray = SAME, lanes: int = 1) -> Words:
    """Words (maximal runs of ``word_bytes``) of ``texts`` (null: empty) after the
    byte mapping ``letters``. Works in segments of bounded size that end between
    words, so a very long text needs no more than its own bytes and word arrays."""
    texts = pc.fill_null(texts, "")
    joined = pc.binary_join_element_wise(texts.cast(pa.large_string()), pa.scalar("\n", pa.large_string()),
                                         pa.scalar("", pa.large_string()))
    if isinstance(joined, pa.ChunkedArray):
        joined = joined.combine_chunks()
    off = np.frombuffer(joined.buffers()[1], dtype=np.int64)[joined.offset:joined.offset + len(joined) + 1]
    raw = np.frombuffer(joined.buffers()[2], dtype=np.uint8)[off[0]:off[-1]] if len(joined) and off[-1] > off[0] \
        else np.zeros(0, dtype=np.uint8)
    off = off - off[0] if len(off) else np.zeros(1, dtype=np.int64)
    data = letters[raw]
    starts, ends, hashes = [], [], [[] for _ in range(lanes)]
    pos = 0
    while pos < len(data):
        stop = min(pos + CHUNK_BYTES, len(data))
        while stop < len(data) and word_bytes[data[stop]]:
            gap = np.flatnonzero(word_bytes[data[stop:stop + 65536]] == 0)
            stop = stop + int(gap[0]) if len(gap) else min(stop + 65536, len(data))
        seg = data[pos:stop]
        m = word_bytes[seg]
        edge = np.flatnonzero(m[1:] != m[:-1]) + 1
        if m[0]:
            edge = np.concatenate([[0], edge])
        if len(edge) % 2:
            edge = np.concatenate([edge, [len(seg)]])
        s, e = edge[0::2], edge[1::2]
        for k in range(lanes):
            hashes[k].append(_hasher(k).ranges(seg, s, e))
        starts.append(s + pos)
        ends.append(e + pos)
        pos = stop
    cat = lambda xs, kind: np.concatenate(xs) if xs else np.zeros(0, dtype=kind)
    start = cat(starts, np.int64)
    return Words(data, start, cat(ends, np.int64), np.searchsorted(start, off), [cat(x, U64) for x in hashes])


def texts_of(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """A column of strings; ``record.x`` is the field x of the struct column record."""
    outer, _, inner = column.partition(".")
    x = batch.column(outer)
    return (pc.struct_field(x, inner) if inner else x).cast(pa.string())


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches holding about ``limit`` bytes of ``column``, at
    least one row each; all rows, in order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(texts_of(batch, column)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(size.astype(np.int64)) // limit
        cut = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [batch.num_rows]])
        for a, b in itertools.pairwise(cut):
            yield batch.slice(a, b - a)


def lists(xs: list[np.ndarray]) -> pa.ListArray:
    """One list of longs per array."""
    off = np.concatenate([[0], np.cumsum([len(x) for x in xs])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off), i64(np.concatenate(xs) if xs else np.zeros(0, dtype=np.int64)))


def i64(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == U64 else x.astype(np.int64, copy=False))


def _stars(e: DataFrame) -> bool:
    """Whether each ``u`` of the distinct edges has one ``v``, which is no edge's ``u``."""
    ends = e.select("u", F.lit(1).alias("up")).union(e.select("v", F.lit(0)))
    return not ends.groupBy("u").agg(F.sum("up").alias("up"), F.min("up").alias("least")).where(
        "up > 1 OR (up = 1 AND least = 0)").count()


@tidy
def components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """Connected components of ``edges(a, b)`` (longs): one row (id, root) per
    node that has an edge, root the smallest id it can reach.

    Alternating large-star and small-star steps. Each step is a grouped minimum,
    combined before its shuffle, and a join that adaptive execution may split,
    so a hub with a third of all nodes meets no single task; each result is a
    written table. They end when every node of an edge is either a root or has one
    smaller neighbour, a root. Null ids and self loops are ignored.
    """
    e = (edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
         .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    e = written(e, name)
    while not _stars(e):
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("x"))
        e = written(small.select("x.u", "x.v").where("u <> v").distinct(), name)
    roots = e.select(F.col("u").alias("id"), F.col("v").alias("root"))
    return roots.union(e.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())
