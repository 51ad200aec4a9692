import hashlib
import re

import pytest
from pyspark.sql import functions as F

from keyreport.llm.fill_in_middle import LINE_UNIT, fill_in_middle, restore

from .conftest import SF

SPACED = r"\S*\s+|\S+"


def brute(doc_id, text, unit, rate, spm, seed="7"):
    """(n, form, prefix, middle, output), unit by unit."""
    text = text or ""
    units, pos = [], 0
    while pos < len(text):
        m = re.compile(unit).match(text, pos)
        units.append(m[0])
        pos = m.end()
    sha = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(sha[8 * k:8 * k + 8], 16) for k in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= rate:
        return n, "plain", None, None, text
    if h4 % 100 < spm:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


ODD = [(1, "<"), (2, "<S"), (3, "S>\n>\n<"), (4, "<P\n<S\n<M"), (5, "a\r\nb c\x85d\n"), (6, "\n\n\n"), (7, "x<M>y"),
       (8, "été 中文 \U0001F600\n" * 9 + "end"), (9, "<<S\n<P\n"), (None, "a\nb\nc"), (10, None), (11, "﻿\n\u0000\n"),
       *[(100 + i, f"l{i}<\nP>\n<S\n>" + "z\n" * i) for i in range(60)], (12, "no newline"), (12, "no newline"),
       (13, "ab\n" * 200_000)]


@pytest.mark.parametrize("unit,rate,spm", [(LINE_UNIT, 100, 50), (LINE_UNIT, 40, 100), (SPACED, 80, 0)])
def test_equals_brute_force_and_round_trip(spark, documents, rows, unit, rate, spm):
    more = spark.createDataFrame(ODD, "doc_id long, text string")
    for frame, data in ((documents, rows), (more.repartition(4), ODD)):
        out = fill_in_middle(frame, unit, rate=rate, spm=spm)
        got = [(r["id"], r["text"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["back"])
               for r in out.select(F.col("record.doc_id").alias("id"), F.col("record.text").alias("text"), "*",
                                   restore(F.col("output"), F.col("form")).alias("back")).collect()]
        assert all(g[-1] == (g[1] or "") for g in got)
        want = [(d, t, *brute(d, t, unit, rate, spm)) for d, t in data]
        order = lambda r: (str(r[0]), str(r[1]))
        assert sorted((g[:-1] for g in got), key=order) == sorted(want, key=order)


def test_all_forms_occur(documents):
    assert {r["form"] for r in fill_in_middle(documents, rate=90).select("form").distinct().collect()} == {"plain", "psm", "spm"}


def test_a_unit_that_does_not_fit_leaves_the_text(spark):
    frame = spark.createDataFrame([(1, "ab1"), (2, "ab")], "doc_id long, text string")
    out = {r["record"]["doc_id"]: r for r in fill_in_middle(frame, "[a-z]").collect()}
    assert (out[1]["n"], out[1]["form"], out[1]["output"]) == (0, "plain", "ab1") and out[2]["n"] == 2


def test_one_narrow_python_call_and_no_shuffle(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = fill_in_middle(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1 and "Exchange" not in plan and "MapIn" not in plan


def test_empty_table(nothing):
    assert fill_in_middle(nothing).collect() == []
