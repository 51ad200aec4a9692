"""Exact top-k inner products by norm order, rotated partial sums and residual bounds.

Vectors become integers, floor(scale * x). Candidates are cut into blocks by
descending length, queries into blocks by the length a candidate needs to reach
their threshold; a pair of blocks meets in one task unless the longest candidate
is too short for every query of the block (Cauchy-Schwarz).

* **Thresholds.** The ``HEAD`` longest vectors are scored first for every query;
  the k-th best score is the query's threshold from then on.
* **Inside a pair of blocks** candidates go by descending length, and a query drops
  out when |q||v| falls below its threshold. The rest are compared by partial sums over
  the leading coordinates after a rotation (right singular vectors of a bounded sample):
  an eighth of them, then a quarter, then half. A partial sum plus the product of the two
  residual lengths is an upper bound of the score; pairs whose bound stays below the
  threshold go at each level. Only the rest are multiplied in full, in integers.
* **Copies.** Queries are cut into as many blocks as their number needs, so a
  candidate is sent once per ``block_bytes / 4`` of queries that it can reach.

Bounds carry a margin over rounding errors, and equal scores stay in, so the result
is exact; the sample and the rotation only decide the speed. Block sizes are
bytes, so a task's memory doesn't grow with dimension, and vectors of equal length
are spread over blocks by a hash.

Defined results: a vector that is null or holds a null or non-finite component
takes no part. Vectors meet only those of the same dimension. A query's own row is no
candidate, other rows are, also those that repeat its id. Equal scores: smaller id first,
null ids last. A row without an id is a candidate (null vec_id) and no query. Rows that
repeat a query's id each get their ranks. Scores beyond 64 bits saturate. Other columns
are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyreport.llm.common import table, written
from keyreport.llm.queries import query

SCALE = 1024
HEAD = 2048
SAMPLE = 2048
BLOCK_BYTES = 8 << 20
NORM_GROUPS = 32
STEP = 512
NEVER = -float(2**63)
EXACT = 2.0**52


def integer_vectors(vectors: DataFrame, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """(row, id, v, dim, norm) of the vectors that take part; row is a number of the row."""
    x = F.col(vec_col).cast("array<double>")
    odd = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(math.inf)))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), x.alias("x")).where(x.isNotNull() & ~odd)
    v = F.transform("x", lambda e: F.floor(e * scale).cast("long"))
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "id", v.alias("v"))
    square = F.aggregate("v", F.lit(0.0), lambda s, e: s + e.cast("double") * e.cast("double"))
    return rows.select("row", "id", "v", F.size("v").alias("dim"), F.sqrt(square).alias("norm"))


def names(table) -> np.ndarray:
    """Row number and id of each row, as the two columns of a matrix; a null id is the
    largest number, and a third column tells it from that id."""
    ids = table["id"] if isinstance(table, pa.Table) else table.column("id")
    ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
    row = np.asarray(table["row"] if isinstance(table, pa.Table) else table.column("row"))
    none = np.asarray(ids.is_null()).astype(np.int64)
    return np.stack([row, np.asarray(ids.fill_null(2**63 - 1)), none], axis=1).astype(np.int64)


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten(), dtype=np.int64).reshape(len(flat), dim)


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact row-by-row inner products of two integer matrices of equal shape."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[1])
    if top < EXACT:
        return np.einsum("ij,ij->i", q.astype(np.float64), c.astype(np.float64)).astype(np.int64)
    exact = (q.astype(object) * c.astype(object)).sum(axis=1)
    return np.array([max(-2**63, min(2**63 - 1, int(x))) for x in exact], dtype=np.int64)


class Search:
    """Best k per query, over blocks of candidates."""

    def __init__(self, rows: np.ndarray, q: np.ndarray, norm: np.ndarray, least: np.ndarray, k: int, turn: np.ndarray):
        self.rows, self.q, self.norm, self.k, self.turn = rows, q, norm, k, turn
        d = q.shape[1]
        self.levels = sorted({max(1, d // 8), max(1, d // 4), max(1, d // 2)})
        self.turned = q @ turn
        self.rests = self._rests(self.turned)
        self.least = least.astype(np.float64).copy()
        self.row = self.score = np.zeros(0, dtype=np.int64)
        self.vec = np.zeros((0, 3), dtype=np.int64)

    def _rests(self, r: np.ndarray) -> list[np.ndarray]:
        """Length of what each level leaves out."""
        return [np.sqrt((r[:, cut:] ** 2).sum(axis=1)) for cut in self.levels]

    def add(self, vecs: np.ndarray, c: np.ndarray, norm: np.ndarray) -> None:
        """Score candidates ``c``, named by the rows of ``vecs``."""
        order = np.argsort(-norm, kind="stable")
        for a in range(0, len(order), STEP):
            part = order[a:a + STEP]
            longest = norm[part[0]]
            on = np.flatnonzero(self.norm * longest * (1 + 1e-9) + 1 >= self.least)
            if not len(on):
                break
            v = c[part]
            r = v @ self.turn
            rests = self._rests(r)
            first = self.levels[0]
            partial = self.turned[on, :first] @ r[:, :first].T
            margin = np.outer(self.norm[on], norm[part]) * 1e-9 + 1
            i, j = np.nonzero(partial + np.outer(self.rests[0][on], rests[0]) + margin >= self.least[on][:, None])
            partial, i = partial[i, j], on[i]
            other = self.rows[i] != vecs[part[j], 0]
            i, j, partial = i[other], j[other], partial[other]
            for b in range(0, len(i), 1 << 15):  # the vectors of a bounded number of pairs at once
                x, y = self._refined(i[b:b + (1 << 15)], j[b:b + (1 << 15)], partial[b:b + (1 << 15)], r, rests, norm[part])
                self.keep(x, products(self.q[x], v[y]), vecs[part[y]])

    def _refined(self, i, j, partial, r, rests, norm):
        """The pairs that longer partial sums leave."""
        for level in range(1, len(self.levels)):
            a, b = self.levels[level - 1], self.levels[level]
            partial = partial + np.einsum("ij,ij->i", self.turned[i, a:b], r[j, a:b])
            bound = partial + self.rests[level][i] * rests[level][j] + self.norm[i] * norm[j] * 1e-9 + 1
            stay = bound >= self.least[i]
            i, j, partial = i[stay], j[stay], partial[stay]
        return i, j

    def keep(self, row: np.ndarray, score: np.ndarray, vec: np.ndarray) -> None:
        row, score, vec = (np.concatenate(x) for x in ((self.row, row), (self.score, score), (self.vec, vec)))
        order = np.lexsort((vec[:, 0], vec[:, 1], vec[:, 2], ~score, row))
        row, score, vec = row[order], score[order], vec[order]
        start = np.searchsorted(row, row)
        best = np.arange(len(row)) - start < self.k
        self.row, self.score, self.vec = row[best], score[best], vec[best]
        last = np.flatnonzero(np.arange(len(row)) - start == self.k - 1)
        self.least[row[last]] = np.maximum(self.least[row[last]], score[last].astype(np.float64) * (1 - 1e-15) - 1
                                           if np.abs(score).max(initial=0) >= EXACT else score[last])


def rotation(sample: np.ndarray) -> np.ndarray:
    d = sample.shape[1]
    if not d or not len(sample):
        return np.eye(d)
    return np.linalg.svd(sample.astype(np.float64), full_matrices=True)[2].T if len(sample) >= d else np.eye(d)


def topk(vectors: DataFrame, is_query, k: int = 10, scale: int = SCALE, block_bytes: int = BLOCK_BYTES,
         id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows where ``is_query`` (a column
    over ``id``) holds, against all rows; see the module text."""
    rows = written(integer_vectors(vectors, scale, id_col, vec_col), "topk-vectors")
    parts = [_one_dimension(rows.where(F.col("dim") == r["dim"]), r["dim"], is_query, k, block_bytes)
             for r in sorted(rows.groupBy("dim").count().collect(), key=lambda r: r["dim"])]
    if not parts:
        return rows.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"),
                           F.lit(0).cast("long").alias("score"))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def _one_dimension(rows: DataFrame, dim: int, is_query, k: int, block_bytes: int) -> DataFrame:
    spark = rows.sparkSession
    size = 8 * max(1, dim)
    per_block = max(STEP, block_bytes // size)
    head = rows.orderBy(F.desc("norm"), "row").limit(max(2 * k, min(HEAD, per_block))).toArrow()
    sample = rows.orderBy(F.xxhash64("row"), "row").limit(min(SAMPLE, per_block)).select("v").collect()
    turn = rotation(np.array([r["v"] for r in sample], dtype=np.int64).reshape(len(sample), dim))
    first = names(head), matrix(head["v"], dim), np.asarray(head["norm"])
    sent = spark.sparkContext.broadcast((first, turn))

    def thresholds(batches):
        (vecs, c, norm), turn = sent.value
        for b in batches:
            for a in range(0, b.num_rows, 256):
                part = b.slice(a, 256)
                q = matrix(part.column("v"), dim)
                n = part.num_rows
                s = Search(np.asarray(part.column("row")), q, np.asarray(part.column("norm")), np.full(n, NEVER), k, turn)
                s.add(vecs, c, norm)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(s.least)], names=[*part.schema.names, "least"])

    queries = rows.where(F.col("id").isNotNull() & is_query)
    queries = queries.select("row", "id", "v", "norm").mapInArrow(
        thresholds, "row long, id long, v array<long>, norm double, least double")
    # The length a candidate needs to reach the threshold of the query.
    need = F.when(F.col("least") <= 0, 0.0).otherwise(F.col("least") / F.col("norm"))
    queries = written(queries.withColumn("need", need), "topk-queries")

    def grouped(df: DataFrame, by: str, per: int, prefix: str):
        many = min(NORM_GROUPS, -(-df.count() // per))
        cuts = sorted(set(df.approxQuantile(by, [i / many for i in range(1, many)], 0.01))) if many > 1 else []
        group = F.pmod("row", F.lit(1)).cast("int")  # 0, and no constant that turns the join below into a product
        for c in cuts:
            group = group + (F.col(by) > c).cast("int")
        df = df.withColumn(f"{prefix}g", group)
        stats = df.groupBy(f"{prefix}g").agg(F.count("*").alias("n"), F.min(by).alias("lo"), F.max(by).alias("hi"))
        stats = [(r[f"{prefix}g"], max(1, -(-r["n"] // per)), r["lo"], r["hi"]) for r in stats.collect()]
        return df, stats

    candidates, lengths = grouped(rows, "norm", max(STEP, per_block // NORM_GROUPS), "c")
    queries, needs = grouped(queries, "need", per_block // 4, "q")
    # Pairs of groups that can hold a result: at most NORM_GROUPS squared.
    pairs = [(cg, cs, qg, qs) for cg, cs, _, longest in lengths for qg, qs, least, _ in needs
             if longest * (1 + 1e-9) + 1 >= least]
    if not pairs:
        return queries.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"),
                              F.lit(0).cast("long").alias("score")).where("false")
    met = F.broadcast(spark.createDataFrame(pairs, "cg int, cs int, qg int, qs int"))
    meet_c = (candidates.join(met, "cg").withColumn("c", F.pmod(F.xxhash64("row"), F.col("cs")))
              .withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("qs") - 1)))
              .select("cg", "c", "qg", F.col("qb").cast("long").alias("qb"), "row", "id", "v", "norm"))
    meet_q = (queries.join(met, "qg").withColumn("qb", F.pmod(F.xxhash64("row"), F.col("qs")))
              .withColumn("c", F.explode(F.sequence(F.lit(0), F.col("cs") - 1)))
              .select("cg", F.col("c").cast("long").alias("c"), "qg", "qb", "row", "id", "v", "norm", "least"))

    def block(cand: pa.Table, ask: pa.Table) -> pa.Table:
        turn = sent.value[1]
        out = np.zeros((0, 6), dtype=np.int64)
        if cand.num_rows and ask.num_rows:
            s = Search(np.asarray(ask["row"]), matrix(ask["v"], dim), np.asarray(ask["norm"]), np.asarray(ask["least"]),
                       k, turn)
            s.add(names(cand), matrix(cand["v"], dim), np.asarray(cand["norm"]))
            out = np.column_stack([s.rows[s.row], np.asarray(ask["id"])[s.row], s.vec, s.score])
        vec_id = pa.array(out[:, 3], mask=out[:, 4] == 1)
        return pa.table({"q": out[:, 0], "query_id": out[:, 1], "vec_row": out[:, 2], "vec_id": vec_id, "score": out[:, 5]})

    keys = ["cg", "c", "qg", "qb"]
    best = meet_c.groupBy(*keys).cogroup(meet_q.groupBy(*keys)).applyInArrow(
        block, "q long, query_id long, vec_row long, vec_id long, score long")
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "vec_row")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


@query("op2_exact_topk", r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
""")
def op2_exact_topk(spark, sf_dir):
    return topk(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)
