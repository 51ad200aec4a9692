import importlib

import pytest

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from keyreport.llm.common import components, written
from keyreport.llm.ngram_jaccard import ngram_jaccard
from keyreport.llm.packing import pack

from .conftest import SF


def test_names_of_the_contract():
    names = list(entry.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10
    assert "pipeline" in names and len(pipeline.STAGES) == 5
    assert set(entry.oracle_sql()) <= set(names)


def test_stages_one_by_one(spark, documents):
    from pyspark.sql import functions as F

    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()["text"]
    long = " ".join(f"passage{i}" for i in range(70))
    base = spark.read.parquet(f"{SF}/documents.parquet")
    alone = ngram_jaccard(base, 5, 40, 100).groupBy("component_id").count().where("count = 1")
    english = written(base.where("lang = 'en' AND n_chars > 900").join(
        alone.select(F.col("component_id").alias("doc_id")), "doc_id").orderBy("doc_id").limit(3), "test-english")
    tails = [r["text"] for r in english.collect()]
    planted = spark.createDataFrame(
        [(2_000_001, f"{tails[0]} {item}", "en", "a", 1), (2_000_002, f"{tails[1]}\n{long}", "en", "a", 2),
         (2_000_003, f"{long} {tails[2]}", "en", "a", 3)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = planted.union(documents.select("doc_id", "text", "lang", "source", "n_chars").where(
        ~F.col("doc_id").isin([r["doc_id"] for r in english.collect()])))
    docs = docs.withColumn("score", F.lit("mine")).withColumn("n_words", F.lit(1))
    docs = written(docs, "test-pipeline")
    seen = {}
    for name, stage in pipeline.STAGES:
        out = written(stage(spark, docs, SF), "test-pipeline")
        if name != "packing":
            assert out.columns == docs.columns
        seen[name] = out
        docs = out if name != "packing" else docs
    ids = {n: [r["doc_id"] for r in f.select("doc_id").collect()] for n, f in seen.items()}
    assert {2_000_001, 2_000_002, 2_000_003} <= set(ids["language"])
    assert {2_000_001, 2_000_002, 2_000_003} <= set(ids["near_duplicates"])
    assert not {1_000_001, 1_000_002, 1_000_003, 1_000_016} & set(ids["language"])
    assert {1_000_007, 1_000_012} <= set(ids["near_duplicates"])
    assert not {1_000_008, 1_000_009, 1_000_013} & set(ids["near_duplicates"])
    text = {r["doc_id"]: r for r in seen["substrings"].collect()}
    assert "passage5 " in text[2_000_002]["text"] and "passage" not in text[2_000_003]["text"]
    assert text[2_000_003]["n_chars"] == len(text[2_000_003]["text"]) and text[2_000_002]["n_chars"] == 2
    assert 2_000_001 in ids["substrings"] and 2_000_001 not in ids["decontamination"]
    assert set(ids["packing"]) == set(ids["decontamination"])
    assert sorted(map(str, pack(seen["decontamination"], with_ids=True).collect())) == sorted(map(str, seen["packing"].collect()))


def test_clean_documents_stay(spark):
    """A document that shares nothing with others leaves the pipeline whole."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = {r["doc_id"] for r in pipeline.run(spark, SF).select("doc_id").distinct().collect()}
    assert len(ids) > 0.8 * docs.count()


def test_documents_without_any_language_stay(spark):
    docs = spark.createDataFrame([(1, "One two", None), (2, "12 34", None), (3, None, None), (4, "été 中文", None)],
                                 "doc_id long, text string, lang string")
    out = pipeline.language(spark, docs, SF)
    assert out.columns == docs.columns and sorted(r["doc_id"] for r in out.collect()) == [1, 4]


def test_null_and_repeated_ids(spark):
    """Rows are judged each by its own text, whatever their ids."""
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()["text"]
    text = lambda name, n=40: " ".join(f"{name}{i}" for i in range(n))
    docs = lambda rows: written(spark.createDataFrame(
        [(d, t, "en", "a", len(t)) for d, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long").coalesce(1), "test-ids")
    got = lambda f: sorted(((r["doc_id"], r["text"]) for r in f.collect()), key=str)
    want = lambda rows: sorted(rows, key=str)

    rows = [(None, text("a")), (None, text("a")), (None, text("b")), (7, text("c")), (7, text("c")), (7, text("d")),
            (3, text("e")), (9, text("e")), (9, text("f")), (None, text("g")), (5, text("g"))]
    assert got(pipeline.near_duplicates(spark, docs(rows), SF)) == want(
        [(None, text("a")), (None, text("b")), (7, text("c")), (7, text("d")), (3, text("e")), (9, text("f")),
         (5, text("g"))])

    p, q = text("p", 30), text("q", 30)
    rows = [(None, f"{p} {text('h')}"), (None, f"{p} {text('i')}"), (4, f"{q} {text('j')}"), (4, f"{q} {text('k')}"),
            (None, text("l")), (None, text("l")), (2, f"{text('m')} {q}")]
    left = [t for _, t in got(pipeline.substrings(spark, docs(rows), SF))]
    assert sum("p0 " in t for t in left) == 1 and sum("q0 " in t for t in left) == 1
    assert sum("l0 " in t for t in left) == 1 and len(left) == 6
    assert f"{text('m')} {q}" in left  # the smallest id comes first

    rows = [(None, f"{text('r')} {item}"), (None, text("s")), (8, item), (8, text("t"))]
    assert got(pipeline.decontamination(spark, docs(rows), SF)) == want([(None, text("s")), (8, text("t"))])


def test_empty_table(spark, nothing):
    docs = nothing.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


@pytest.mark.parametrize("edges,want", [
    ([], {}), ([(5, 5), (None, 3), (3, None)], {}),
    ([(i, i + 1) for i in range(40)], {i: 0 for i in range(41)}),
    ([(100, i) for i in range(30)] + [(7, 200), (300, 301), (301, 300)],
     {**{i: 0 for i in range(30)}, 100: 0, 200: 0, 300: 300, 301: 300}),
])
def test_components(spark, edges, want):
    frame = spark.createDataFrame(edges, "a long, b long")
    got = [(r["id"], r["root"]) for r in components(frame).collect()]
    assert len(got) == len(dict(got)) and dict(got) == want


def test_components_that_are_stars_take_no_step(spark, monkeypatch):
    from keyreport.llm import common

    made, write = [], common.written
    monkeypatch.setattr(common, "written", lambda *args: made.append(args[1]) or write(*args))
    frame = spark.createDataFrame([(9, 1), (1, 7), (8, 2), (9, 1)], "a long, b long")
    assert dict(components(frame).collect()) == {9: 1, 7: 1, 8: 2, 1: 1, 2: 2}
    assert len(made) == 1


def test_the_rest_does_not_import_the_subpackage():
    import pathlib

    root = pathlib.Path(importlib.import_module("keyreport").__file__).parent
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "keyreport.llm" not in path.read_text()
