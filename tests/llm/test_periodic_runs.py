import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from keyreport.llm import periodic_runs as pr
from keyreport.llm.catalog import QUERIES
from keyreport.llm.periodic_runs import Extension, periodic_runs, runs_of

from .conftest import SF, space_words


def brute_runs(w, min_length=12):
    """Runs by comparing all words of each period: (start, length, period)."""
    n, ids = len(w), {x: i for i, x in enumerate(dict.fromkeys(w))}
    s = np.array([ids[x] for x in w], dtype=np.int64)
    found = {}
    for q in range(1, n // 2 + 1):
        same = np.concatenate([[False], s[:-q] == s[q:], [False]])
        edge = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edge[0::2], edge[1::2]):
            if b - a >= q and b - a + q >= min_length:
                found.setdefault((int(a), int(b - a + q)), q)  # the smallest q comes first
    return sorted(((a, m, q) for (a, m), q in found.items()), key=lambda r: (r[0], r[2]))


def collapse(w, runs):
    gone = set()
    for a, m, q in runs:
        gone.update(range(a + q, a + m))
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def planted(doc_id, w):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if doc_id is None or h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), max_size=60), min_size=1, max_size=4), st.integers(1, 14))
def test_runs_of_short_sequences(texts, min_length):
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    start, end, period = runs_of(np.array([x for t in texts for x in t], dtype=np.int64), first, min_length)
    got = sorted(zip(start.tolist(), (end - start).tolist(), period.tolist()))
    want = [(a + int(o), m, q) for t, o in zip(texts, first) for a, m, q in brute_runs(t, min_length)]
    assert got == sorted(want)


@pytest.mark.parametrize("letters,n", [(1, 300), (2, 500), (4, 900), (50, 2000)])
def test_common_extensions(letters, n):
    rng = np.random.default_rng(n)
    s = rng.integers(1, letters + 1, n)
    s[n // 2:n // 2 + n // 4] = s[:n // 4]  # a long repeat
    s = np.append(s, letters + 1)
    i, j = rng.integers(0, n, (2, 4000))
    i, j = i[i != j], j[i != j]
    want = [next(k for k in range(n + 1) if s[a + k] != s[b + k]) for a, b in zip(np.minimum(i, j), np.maximum(i, j))]
    assert Extension(s).common(i, j).tolist() == want


def test_only_the_cover_is_sorted():
    assert len(Extension(np.arange(1, 1302)).rank) == 1301 * 4 // 13 + 1
    assert pr._SHIFT.max() <= 12


def test_grid_in_small_blocks(monkeypatch):
    w = ["a", "b", "c"] * 30 + ["d"] + ["e"] * 40 + ["a", "b"] * 25
    numbers = np.unique(w, return_inverse=True)[1] + 1
    monkeypatch.setattr(pr, "PAIRS", 7)
    start, end, period = runs_of(numbers, np.array([0, len(w)]))
    assert [tuple(x) for x in zip(start, end - start, period)] == brute_runs(w)


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return " ".join(b[:n])


PERIODIC = [
    (1, "x " * 5000), (2, "x y " * 40 + "z " + "x y z " * 30), (3, fibonacci(2000)), (4, "a " * 11), (5, "a " * 12),
    (6, " ".join([f"u{i}" for i in range(300)] * 2)), (7, " ".join([f"u{i}" for i in range(300)] * 2 + ["u0"])),
    (8, "p q p q p q p q p q p q r " * 9), (9, "a" * 5000), (10, "été 中 \x1c \x85 " * 7),
    (11, None), (12, ""), (12, "\t\n"), (None, "k " * 20), (13, "1 2 3 4 5 6 1 2 3 4 5 6"), (13, "1 2 3 4 5 6 1 2 3 4 5 6"),
]


@pytest.mark.parametrize("min_length", [12, 4])
def test_equals_brute_force(spark, documents, rows, min_length):
    more = spark.createDataFrame(PERIODIC, "doc_id long, text string").repartition(3)
    for frame, data in ((documents, [r for r in rows if len(r[1] or "") < 30_000]), (more, PERIODIC)):
        if frame is documents:
            frame = frame.where("text IS NULL OR length(text) < 30000")
        got = sorted((str(r["record"]["doc_id"]), r["n_words"], [tuple(x) for x in r["runs"]], r["kept_text"])
                     for r in periodic_runs(frame, min_length).collect())
        want = []
        for d, t in data:
            w = space_words(t)
            runs = brute_runs(w, min_length)
            want.append((str(d), len(w), runs, collapse(w, runs)))
        assert got == sorted(want)


def test_a_very_long_text_of_own_words(documents):
    out = periodic_runs(documents.where("length(text) >= 30000")).collect()
    assert out and all(r["runs"] == [] and r["kept_text"].split(" ") == space_words(r["record"]["text"]) for r in out
                       if r["n_words"] >= 60_000)


def test_query_equals_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = QUERIES["op13_periodic_runs"](spark, SF).collect()
    assert len(out) == len(texts) and any(r["n_runs"] for r in out)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for r in out:
        w = planted(r["doc_id"], space_words(texts[r["doc_id"]]))
        runs = brute_runs(w)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        milli = 1000 * best[1] // best[2] if runs else None
        assert (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"]) == (len(runs), *best, milli)
        assert r["runs_sha256"] == sha("".join(f"{a},{m},{q}\n" for a, m, q in runs))
        assert r["collapsed_sha256"] == sha(collapse(w, runs))


def test_no_shuffle(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = periodic_runs(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1 and "Exchange" not in plan


def test_empty_table(nothing):
    assert periodic_runs(nothing).collect() == []
