"""Packing of tokenised documents into sequences of fixed capacity.

A document's ids, with the end id, longer than the capacity are cut into full
pieces and one shorter first piece. All pieces are then known by the histogram of
their lengths, which has at most ``capacity`` entries however many documents there
are; the configuration linear program (least number of patterns that cover the
histogram, a pattern being a multiset of lengths within the capacity) is solved
over it on the driver:

* multiplicative weights price each length: a length's price starts at its size
  and falls by a factor with each share of it that is covered, so that lengths
  which lag behind grow dear against the rest;
* a knapsack dynamic program over the capacity finds the pattern of highest price;
* it is used as often as half the scarcest of its lengths allows. Uses are whole
  numbers, so this solution is rounded as it grows; what stays of the histogram when
  patterns are no longer full is packed best-fit by decreasing length;
* if that needs more than ``GAP`` above the bound of the tokens, the program is solved
  with fractional uses: a simplex method whose columns are the knapsack's patterns at
  the dual prices, until the price of the dearest pattern proves that at most ``GAP``
  is left to gain (or ``PIVOTS`` columns have entered). Uses are rounded down, what
  stays is packed best-fit or by the same patterns, whichever takes fewer sequences:
  at most one sequence per length above the program's optimum. The better of both
  solutions is taken.

Spark ranks the pieces of each length (in salted groups, so a length that a third
of all pieces share is no single task) and finds each rank's pattern, sequence and
offset in a small table.

Defined results: text null or empty: one piece, the end id. Rows that repeat an id
are packed each. Other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyreport.llm.common import chunks, join_small, table, written
from keyreport.llm.queries import query
from keyreport.llm.tokens import encoder

CAPACITY = 1024
END_ID = 2
# Pieces of one length ranked by one task.
RANKED = 100_000
# The same of pieces that carry their ids, so that sorting them needs no disk.
RANKED_WITH_IDS = 10_000
STEP = 0.5
LEAST_FILL = 0.995
GAP = 0.001
PIVOTS = 1000


def pieces(docs: DataFrame, capacity: int, end_id: int, with_ids: bool, json_path: str | None,
           ranks_path: str | None) -> DataFrame:
    """Pieces of ``docs(doc_id, text)``: piece, start, length, crc32 of its ids."""
    end = np.array([end_id], dtype="<u4").tobytes()
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches):
        encode = encoder(json_path, ranks_path).ids_bytes
        for batch in chunks(batches):
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, text in enumerate(batch.column("text")):
                data = memoryview(encode(text.as_py() or "") + end)
                n = len(data) // 4
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    row.append(i)
                    piece.append(p)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(data[4 * a:4 * b]))
                    if with_ids:
                        ids.append(np.frombuffer(data[4 * a:4 * b], dtype="<i4"))
            cols = [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                    *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                off = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                cols.append(pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate(ids))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.mapInArrow(run, schema)


def dearest_pattern(lengths: np.ndarray, prices: np.ndarray, most: np.ndarray, capacity: int) -> dict[int, int]:
    """Knapsack by dynamic programming: how often each index of ``lengths`` is used
    in the pattern of highest total price (at most ``most`` of each)."""
    best = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1)
    for c in range(int(lengths.min()), capacity + 1):
        k = np.searchsorted(lengths, c, "right")
        total = best[c - lengths[:k]] + prices[:k]
        i = int(np.argmax(total))
        if total[i] > best[c - 1]:
            best[c], last[c] = total[i], i
        else:
            best[c], last[c] = best[c - 1], -1
    out: dict[int, int] = {}
    c = capacity
    while c > 0:
        i = int(last[c])
        if i < 0:
            c -= 1
        else:
            out[i] = out.get(i, 0) + 1
            c -= int(lengths[i])
    return {i: min(k, int(most[i])) for i, k in out.items()}


def linear_program(sizes: np.ndarray, n: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Fractional cover of ``n`` pieces of each of ``sizes`` by patterns: the patterns
    (one per row, times of each size), their uses, and a lower bound of any cover."""
    m = len(sizes)
    each = capacity // sizes
    cost = np.ones(m)                   # 0: a column that takes one piece too many of a size
    basis = np.diag(each).astype(float)  # columns
    inverse = np.diag(1 / each)
    uses = n / each
    many = np.full(m, capacity, dtype=np.int64)
    bound = 0.0
    for turn in range(PIVOTS):
        if turn % 64 == 63:
            inverse = np.linalg.inv(basis)
            uses = np.maximum(inverse @ n, 0)
        prices = cost @ inverse
        low = int(np.argmin(prices))
        column = np.zeros(m)
        if prices[low] < -1e-9:
            column[low], price = -1, 0.0
        else:
            for i, k in dearest_pattern(sizes, np.maximum(prices, 0), many, capacity).items():
                column[i] = k
            price = 1.0
            worth = float(prices @ column)
            bound = max(bound, float(cost @ uses) / max(worth, 1.0))
            if worth <= 1 + 1e-9 or cost @ uses <= (1 + GAP) * bound:
                break
        way = inverse @ column
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(way > 1e-9, uses / way, np.inf)
        out = int(np.argmin(ratio))
        if not np.isfinite(ratio[out]):
            break
        step = ratio[out]
        uses = np.maximum(uses - step * way, 0)
        uses[out] = step
        row = inverse[out] / way[out]
        inverse -= np.outer(way, row)
        inverse[out] = row
        basis[:, out], cost[out] = column, price
    real = cost > 0
    return basis.T[real].astype(np.int64), uses[real], bound


def rounded(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """The linear program's cover in whole sequences that hold the histogram exactly."""
    sizes = np.array(sorted(histogram), dtype=np.int64)
    n = np.array([histogram[int(x)] for x in sizes], dtype=np.int64)
    patterns, uses, _ = linear_program(sizes, n, capacity)
    out = []

    def use(left: np.ndarray, pattern: np.ndarray, times: int, into: list) -> None:
        # A size of which fewer pieces are left is taken as often as it goes.
        while times > 0:
            pattern = np.minimum(pattern, left)
            on = np.flatnonzero(pattern)
            if not len(on):
                return
            now = min(times, int((left[on] // pattern[on]).min()))
            left -= now * pattern
            times -= now
            into.append(({int(sizes[i]): int(pattern[i]) for i in on}, now))

    left = n.copy()
    for pattern, x in zip(patterns, uses, strict=True):
        use(left, pattern, int(x + 1e-6), out)
    again, rest = [], left.copy()
    for k in np.argsort(-(uses + 1e-6) % 1, kind="stable"):
        use(rest, patterns[k], 1, again)
    again += best_fit({int(sizes[i]): int(rest[i]) for i in np.flatnonzero(rest)}, capacity)
    fitted = best_fit({int(sizes[i]): int(left[i]) for i in np.flatnonzero(left)}, capacity)
    return out + min(fitted, again, key=sequences)


def sequences(configs: list[tuple[dict[int, int], int]]) -> int:
    return sum(uses for _, uses in configs)


def configurations(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Patterns ({length: times}, number of sequences) that hold the histogram exactly."""
    out = priced(histogram, capacity)
    least = -(-sum(x * k for x, k in histogram.items()) // capacity)
    if sequences(out) <= (1 + GAP) * least:
        return out
    return min(out, rounded(histogram, capacity), key=sequences)


def priced(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Whole uses of patterns at multiplicative prices, then best fit."""
    out = []
    if histogram.get(capacity):
        out.append(({capacity: 1}, histogram[capacity]))
    sizes = np.array(sorted(x for x in histogram if x != capacity), dtype=np.int64)
    n = np.array([histogram[int(x)] for x in sizes], dtype=np.int64)
    left, weight = n.copy(), sizes / capacity
    poor = 0
    while left.sum() and poor < 8:
        on = np.flatnonzero(left)
        found = dearest_pattern(sizes[on], weight[on], left[on], capacity)
        pattern = {int(on[i]): k for i, k in found.items()}
        filled = sum(int(sizes[i]) * k for i, k in pattern.items())
        uses = max(1, int(STEP * min(left[i] // k for i, k in pattern.items())))
        for i, k in pattern.items():
            weight[i] *= np.exp(-0.1 * k * uses / n[i])
        if filled < LEAST_FILL * capacity:
            # A pattern the knapsack could not fill: raise what lags behind, leave the rest to best fit.
            poor += 1
            continue
        for i, k in pattern.items():
            left[i] -= k * uses
        out.append(({int(sizes[i]): k for i, k in pattern.items()}, uses))
    rest = {int(sizes[i]): int(left[i]) for i in np.flatnonzero(left)}
    return out + best_fit(rest, capacity)


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best fit by decreasing length, many equal sequences at a time."""
    groups: dict[int, dict[tuple, int]] = {}  # free room: {pattern: sequences}
    for size in sorted(histogram, reverse=True):
        todo = histogram[size]
        while todo:
            room = min((r for r in groups if r >= size), default=None)
            if room is None:
                each = capacity // size
                full, over = divmod(todo, each)
                for k, uses in ((each, full), (over, 1)):
                    if k and uses:
                        x = groups.setdefault(capacity - k * size, {})
                        x[((size, k),)] = x.get(((size, k),), 0) + uses
                break
            pattern, uses = groups[room].popitem()
            take = min(todo, uses)
            if take < uses:
                groups[room][pattern] = uses - take
            if not groups[room]:
                del groups[room]
            grown = (*pattern[:-1], (size, pattern[-1][1] + 1)) if pattern[-1][0] == size else (*pattern, (size, 1))
            x = groups.setdefault(room - size, {})
            x[grown] = x.get(grown, 0) + take
            todo -= take
    return [(dict(p), uses) for x in groups.values() for p, uses in x.items()]


def places(configs: list[tuple[dict[int, int], int]]) -> dict[int, list[tuple]]:
    """Per length its ranges of ranks: (from, to, first sequence, times, offset)."""
    out: dict[int, list[tuple]] = {}
    sequence = 0
    for pattern, uses in configs:
        offset = 0
        for size, k in pattern.items():
            ranges = out.setdefault(size, [])
            begin = ranges[-1][1] if ranges else 0
            ranges.append((begin, begin + k * uses, sequence, k, offset))
            offset += k * size
        sequence += uses
    return out


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False,
         json_path: str | None = None, ranks_path: str | None = None, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset
    (and its ids, if ``with_ids``); see the module text."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    cut = written(pieces(docs, capacity, end_id, with_ids, json_path, ranks_path), "packing-pieces")
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most `capacity` rows
    spark = docs.sparkSession
    found = places(configurations(histogram, capacity))
    slots = spark.createDataFrame(
        [(size, [tuple(int(v) for v in r) for r in ranges]) for size, ranges in found.items()],
        "length long, ranges array<struct<a: long, b: long, seq: long, times: long, off: long>>")
    salts = max(1, -(-max(histogram.values(), default=1) // (RANKED_WITH_IDS if with_ids else RANKED)))
    cut = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    counts = cut.groupBy("length", "salt").agg(F.count("*").alias("c"))
    before = F.sum("c").over(Window.partitionBy("length").orderBy("salt")) - F.col("c")
    base = written(counts.select("length", "salt", before.alias("base")), "packing-ranks")
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = join_small(cut.withColumn("r", F.row_number().over(order) - 1), base, ["length", "salt"])
    ranked = ranked.withColumn("rank", F.col("base") + F.col("r"))
    place = F.filter("ranges", lambda x: (x["a"] <= F.col("rank")) & (F.col("rank") < x["b"]))[0]
    nth = F.col("rank") - F.col("p.a")
    return (ranked.join(F.broadcast(slots), "length").withColumn("p", place)
            .select("doc_id", "piece", "start", "length", "ids_crc32",
                    (F.col("p.seq") + F.floor(nth / F.col("p.times"))).cast("long").alias("sequence_id"),
                    (F.col("p.off") + nth % F.col("p.times") * F.col("length")).cast("long").alias("offset"),
                    *(["ids"] if with_ids else [])))


@query("op4_best_fit_packing")
def op4_best_fit_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"))
