from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from keyreport.llm import ngram_jaccard as module
from keyreport.llm.ngram_jaccard import most_differing, ngram_jaccard, parity_sketch

from .conftest import space_words


def brute(rows, n, num, den):
    sets = []
    for _, text in rows:
        w = space_words(text, lower=True)
        sets.append(frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n
                    else frozenset([tuple(w)] if w else []))
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    places = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            places[x].append(i)
    shared = Counter(p for ids in places.values() for p in combinations(ids, 2))
    for (i, j), k in shared.items():
        a, b = rows[i][0], rows[j][0]
        if a is not None and b is not None and den * k >= num * (len(sets[i]) + len(sets[j]) - k):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return sorted((str(d), len(s), None if d is None else find(d)) for (d, _), s in zip(rows, sets, strict=True))


def got(frame):
    return sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in frame.collect())


@pytest.mark.parametrize("n,num", [(4, 85), (5, 80)])
def test_equals_brute_force(documents, rows, n, num):
    assert got(ngram_jaccard(documents, n, num, 100)) == brute(rows, n, num, 100)


def test_empty_table(nothing):
    assert got(ngram_jaccard(nothing)) == []


def test_shared_passage_and_near_copies(spark):
    """Many documents around one passage (costly keys), near copies of each other in
    groups, some linked only through the rarest elements."""
    rng = np.random.default_rng(3)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for g in range(60):
        own = [f"g{g}w{i}" for i in range(int(rng.integers(4, 50)))]
        for c in range(int(rng.integers(1, 4))):
            w = own[:len(own) // 2] + passage + own[len(own) // 2:]
            for _ in range(int(rng.integers(0, 3))):
                w[int(rng.integers(len(w)))] = f"e{g}x{c}x{rng.integers(9)}"
            rows.append((1000 * g + c, " ".join(w)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(ngram_jaccard(frame, 4, 85, 100)) == brute(rows, 4, 85, 100)


def test_keys_with_many_components_end_in_few_rounds(spark, monkeypatch):
    """A round takes dozens of shuffles, whatever the size of the table."""
    passage = [f"p{i}" for i in range(90)]
    rows = [(g, " ".join([*passage, *(f"g{g // 2}w{i}" for i in range(8 + g % 16 // 2)), *[f"x{g}"] * (g % 2)])) for g in range(70)]
    rounds, compared = [], module._Links.in_blocks
    monkeypatch.setattr(module._Links, "in_blocks", lambda *args: rounds.append(1) or compared(*args))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(ngram_jaccard(frame, 4, 85, 100)) == brute(rows, 4, 85, 100)
    assert 1 <= len(rounds) <= 2


def test_pairs_of_a_key_take_little_memory():
    import tracemalloc

    def side(n):
        short = pa.array([[i % 2] * module.SHORT_WORDS for i in range(n)], pa.list_(pa.int64()))
        same = pa.array(np.zeros(n, dtype=np.int64))
        return pa.table({"key": same, "blk": same, "doc": np.arange(n), "n": pa.array(np.full(n, 900)),
                         "place": same, "c": np.arange(n), "short": short})

    members, pivots = side(1500), side(700)
    tracemalloc.start()
    pairs = module.near_pairs(members, pivots, 85, 100)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert pairs.num_rows == 1500 * 700 - 700
    assert most - 3 * pairs.nbytes < 60 << 20


def test_sketch_is_a_lower_bound():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(rng.integers(0, 2**63, int(rng.integers(1, 300))).astype(np.uint64))
        b = np.unique(np.concatenate([a[: int(rng.integers(0, len(a) + 1))],
                                      rng.integers(0, 2**63, int(rng.integers(1, 60))).astype(np.uint64)]))
        x, y = parity_sketch(a), parity_sketch(b)
        while len(x) > len(y):
            x = x[:len(x) // 2] ^ x[len(x) // 2:]
        while len(y) > len(x):
            y = y[:len(y) // 2] ^ y[len(y) // 2:]
        assert int(np.bitwise_count(x ^ y).sum()) <= len(np.setxor1d(a, b))


def test_most_differing_is_tight():
    for r in range(1, 60):
        for s in range(1, 60):
            links = [r + s - 2 * i for i in range(min(r, s) + 1) if 100 * i >= 85 * (r + s - i)]
            assert max(links, default=0) <= most_differing(r, s, 85, 100)


def test_output_ignores_other_columns(documents):
    assert ngram_jaccard(documents.select("doc_id", "text", F.lit(1).alias("doc"), F.lit(2).alias("n"))).columns == [
        "doc_id", "n_shingles", "component_id"]
