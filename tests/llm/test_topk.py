import math

import numpy as np
from pyspark.sql import functions as F

from keyreport.llm.topk import topk


def brute(rows, k):
    vectors = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
               if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (q, a) in enumerate(vectors):
        if q is None or q % 100:
            continue
        # Every row but the query's own; null ids behind all others.
        scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i is None, i or 0) for m, (i, b) in enumerate(vectors)
                        if m != n and len(a) == len(b))
        out += [(q, r, None if none else i, -s) for r, (s, none, i) in enumerate(scores[:k], 1)]
    return sorted(out, key=str)


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_equals_brute_force_with_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(0, 0.1, 8).round(2).tolist()) for i in range(600)]
    rows += [(1000 + i, [0.25] * 8) for i in range(150)]       # one vector many times: ties
    rows += [(2000 + i, rng.normal(0, 1, 3).tolist()) for i in range(6)]  # another dimension: fewer than k
    rows += [(3000, None), (3100, [None] * 8), (3200, [float("nan")] * 8), (3300, [float("inf")] + [0.0] * 7),
             (3400, [0.0] * 8), (3500, []), (3600, []), (3700, [2.0**30] * 8)]
    frame = spark.createDataFrame([(i, v, 0.0, 1) for i, v in rows], "vec_id long, embedding array<double>, norm double, q int")
    assert got(topk(frame, F.col("id") % 100 == 0)) == brute(rows, 10)
    small = topk(frame, F.col("id") % 100 == 0, block_bytes=64 * 40)  # many blocks
    assert got(small) == brute(rows, 10)


def test_null_and_repeated_ids(spark):
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(0, 0.1, 16).round(2).tolist()) for i in range(300)]
    twin = rows[100][1]
    rows += [(100, twin), (100, [2 * x for x in twin]), (None, twin), (None, [3 * x for x in twin]), (None, None), (2**63 - 1, twin)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    assert got(topk(frame, F.col("id") % 100 == 0, k=4)) == brute(rows, 4)
    assert got(topk(frame, F.col("id") % 100 == 0, k=4, block_bytes=16 * 8 * 40)) == brute(rows, 4)


def test_candidates_are_sent_once_for_few_queries(spark, monkeypatch):
    from keyreport.llm import topk as module

    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(0, 0.1, 8).tolist()) for i in range(6000)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = topk(frame, F.col("id") % 100 == 0)
    out.collect()
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(0, (qs" in plan
    assert min(module.NORM_GROUPS, -(-60 // (module.BLOCK_BYTES // 64 // 4))) == 1  # one block of queries
    assert got(out) == brute(rows, 10)


def test_partial_sums_leave_few_pairs():
    from keyreport.llm.topk import NEVER, Search, rotation

    rng = np.random.default_rng(9)
    base = rng.normal(0, 1, (64, 64)) * (2.0 ** -np.arange(64) / 2 ** -8)
    c = np.floor(1024 * (rng.normal(0, 1, (4000, 64)) @ base / 64)).astype(np.int64)
    s = Search(np.arange(20), c[:20], np.sqrt((c[:20] ** 2).sum(axis=1)), np.full(20, NEVER), 5, rotation(c[:500]))
    assert s.levels == [8, 16, 32]
    full = []
    keep = s.keep
    s.keep = lambda row, score, vec: full.append(len(row)) or keep(row, score, vec)
    s.add(np.stack([np.arange(4000), np.arange(4000), np.zeros(4000, int)], axis=1), c, np.sqrt((c ** 2).sum(axis=1)))
    assert sum(full) < 20 * 4000 / 4
    best = [sorted(((-int(x @ y), j) for j, y in enumerate(c) if j != i))[:5] for i, x in enumerate(c[:20])]
    assert [(int(r), int(v[1]), int(z)) for r, v, z in zip(s.row, s.vec, s.score)] == [
        (i, j, -z) for i, b in enumerate(best) for z, j in b]


def test_empty_table(spark):
    assert topk(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("id") % 100 == 0).count() == 0
