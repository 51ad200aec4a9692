import numpy as np

from keyreport.llm.catalog import QUERIES
from keyreport.llm.license_scan import Automaton, license_scan, scanner
from keyreport.llm.license_texts import PHRASES, TEMPLATES

from .conftest import SF, alnum_words


def base(text):
    w = alnum_words(text)
    return len(w), sorted((i, label) for label, p in PHRASES for i in range(len(w)) if w[i:i + len(p.split())] == p.split())


def test_base_places_equal_brute_force(documents, rows):
    got = license_scan(documents).collect()
    assert sorted((str(r["doc_id"]), (r["n_words"], [(p["word"], p["label"]) for p in r["base_places"]])) for r in got) == \
        sorted((str(d), base(t)) for d, t in rows)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_matching_statistics_equal_brute_force():
    rng = np.random.default_rng(9)
    for _ in range(40):
        texts = [rng.integers(0, 4, int(rng.integers(1, 14))).tolist() for _ in range(3)]
        a = Automaton(texts)
        s = rng.integers(0, 5, 30).tolist()

        def inside(x):
            return [(t, i + len(x) - 1) for t, y in enumerate(texts) for i in range(len(y) - len(x) + 1) if y[i:i + len(x)] == x]

        longest = [max((n for n in range(i + 2) if inside(s[i - n + 1:i + 1]) or not n)) for i in range(len(s))]
        want = {(i, n) for i, n in enumerate(longest) if n >= 2 and (i + 1 == len(s) or longest[i + 1] <= n)}
        got = list(a.matches(s, 2))
        assert {(i, n) for i, n, _ in got} == want
        for i, n, state in got:
            assert sorted(a.states[state].ends) == sorted(inside(s[i - n + 1:i + 1]))


def test_templates_are_found_whole_and_damaged(spark):
    rows = []
    for k, (_, text) in enumerate(TEMPLATES):
        w = text.split()
        rows.append((2 * k, "before this\n" + "\n * ".join([text.upper()]) + " and after"))
        half = len(w) // 2
        rows.append((2 * k + 1, " ".join(w[:half] + ["changed"] + w[half + 1:])))
    found = {r["doc_id"]: r for r in license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, (label, text) in enumerate(TEMPLATES):
        assert label in [s["label"] for s in found[2 * k]["spans"]] and found[2 * k]["score"] == 1.0
        if len(alnum_words(text)) >= 20:
            assert label in [s["label"] for s in found[2 * k + 1]["spans"]]


def test_short_notices_as_files_word_them(spark):
    rows = [(1, "Licensed under the CC BY 4.0", "cc-by-4.0"), (2, "x Released under MIT License y", "mit"),
            (3, "Licensed under CC BY-SA 4.0", "cc-by-sa-4.0")]
    found = license_scan(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"))
    assert {r["doc_id"]: sorted({s["label"] for s in r["spans"]}) for r in found.collect()} == {
        d: [label] for d, _, label in rows}


def test_plain_prose_has_no_licence(spark):
    rows = [(1, "the permission of the software and the conditions of this work are as is for any purpose " * 50)]
    row = license_scan(spark.createDataFrame(rows, "doc_id long, text string")).first()
    assert row["spans"] == [] and row["score"] == 0.0


def test_query_digest(spark):
    for r in QUERIES["op5_license_scan"](spark, SF).collect():
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert (r["n_base"] == 0) == (r["first_word"] is None)


def test_empty_table(nothing):
    assert license_scan(nothing).count() == 0 and scanner().templates
