import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from keyreport.llm import common
from keyreport.llm.substring_dedup import substring_dedup

from .conftest import space_words

FAR = 2**63


def brute(rows, width):
    """Kept words per row, judged by the earliest (id, start) of each window."""
    earliest = {}
    texts = [(FAR if d is None else d, d, space_words(t)) for d, t in rows]
    for key, _, w in texts:
        for i in range(len(w) - width + 1):
            x = tuple(w[i:i + width])
            earliest[x] = min(earliest.get(x, (FAR + 1, 0)), (key, i))
    out = []
    for key, d, w in texts:
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - width + 1):
            if earliest[tuple(w[i:i + width])] < (key, i):
                gone[i:i + width] = True
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((str(d), len(w), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def got(frame):
    frame = frame.select("record.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("h"))
    return sorted((str(r[0]), r[1], r[2], r[3]) for r in frame.collect())


@pytest.mark.parametrize("width", [20, 7])
def test_equals_brute_force(documents, rows, width):
    assert got(substring_dedup(documents, width)) == brute(rows, width)


def test_shared_passages_runs_and_periods(spark):
    rng = np.random.default_rng(8)
    passages = [[f"p{k}x{rng.integers(30)}" for _ in range(int(rng.integers(18, 60)))] for k in range(6)]
    rows = []
    for d in range(120):
        w = []
        for _ in range(int(rng.integers(1, 6))):
            w += [f"o{rng.integers(10**6)}" for _ in range(int(rng.integers(0, 30)))]
            p = passages[int(rng.integers(6))]
            a = int(rng.integers(0, 4))
            w += p[a:]
            w += ["z"] * int(rng.integers(0, 45)) + ["x", "y"] * int(rng.integers(0, 20))
        rows.append((int(rng.integers(1000)) * 200 + d, " ".join(w)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(substring_dedup(frame, 20)) == brute(rows, 20)


def test_texts_that_lose_nothing_stay_as_they_are(spark):
    rows = [(1, " a  b\nc "), (2, None), (3, "")]
    kept = substring_dedup(spark.createDataFrame(rows, "doc_id long, text string"), 20, joined=False)
    assert sorted((r["record"]["doc_id"], r["kept_text"]) for r in kept.collect() if r["record"]["doc_id"] != 2) == [
        (1, " a  b\nc "), (3, "")]


def test_empty_table(nothing):
    assert got(substring_dedup(nothing)) == []


def plan_of(frame, capsys):
    frame.explain()
    return capsys.readouterr().out


@pytest.mark.parametrize("limit", [None, -1])
def test_records_stay_out_of_python(documents, rows, monkeypatch, capsys, limit):
    """Python gets each text once and no other column, and a filter on the result does not
    compute it again; rows shuffled with large marks give the same."""
    if limit is not None:
        monkeypatch.setattr(common, "BROADCAST_BYTES", limit)
    kept = substring_dedup(documents.select("doc_id", "text"))
    plan = plan_of(kept.where("n_removed < n_words"), capsys)
    assert "MapInArrow" not in plan and plan.count("ArrowEvalPython") == 1
    sent = plan.split("ArrowEvalPython [")[1].split("(", 1)[1].split(")")[0]
    assert [x.split("#")[0] for x in sent.split(", ")] in ([x, "starts", "counts", "copy"] for x in ("record", "text", "_extract_text"))
    assert (limit is None) == ("BroadcastHashJoin" in plan)
    assert got(kept) == brute(rows, 20)


def test_rows_of_their_own_under_one_id(spark):
    """With a column of row numbers, rows that repeat an id are ordered by it."""
    p = " ".join(f"p{i}" for i in range(25))
    docs = [(7, f"{p} a"), (7, f"{p} b"), (7, f"{p} a"), (None, f"{p} c"), (3, f"d {p}")]
    numbered = spark.createDataFrame([(d, t, n) for n, (d, t) in enumerate(docs)], "doc_id long, text string, n long")
    kept = {r["record"]["n"]: (r["n_removed"], r["kept_text"]) for r in substring_dedup(numbered, row_col="n").collect()}
    assert kept == {0: (25, "a"), 1: (25, "b"), 2: (26, ""), 3: (25, "c"), 4: (0, f"d {p}")}
    alone = {r["record"]["n"]: r["kept_text"] for r in substring_dedup(numbered.where("doc_id = 7"), row_col="n").collect()}
    assert alone == {0: f"{p} a", 1: "b", 2: ""}
