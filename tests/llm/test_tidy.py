"""Tables that a step writes go when nothing reads them any more."""

import os
from uuid import uuid4

import pytest

import corpus_pipeline
from keyreport.llm import common, ngram_jaccard
from keyreport.llm.common import tidy, written
from keyreport.llm.ngram_jaccard import ngram_jaccard as jaccard
from keyreport.llm.substring_dedup import substring_dedup
from tests.conftest import rows
from tests.llm.conftest import edge_rows


@pytest.fixture(autouse=True)
def scratch(tmp_path, monkeypatch):
    """A scratch folder that no other process writes to."""
    monkeypatch.setattr(common, "scratch_dir", lambda spark, *parts: "/".join([f"{tmp_path}/scratch", *parts, uuid4().hex]))
    monkeypatch.setitem(ROOT, "llm", f"{tmp_path}/scratch/llm")


ROOT = {}


def tables(spark):
    root = ROOT["llm"]
    return {(kind, one) for kind in (os.listdir(root) if os.path.isdir(root) else ())
            for one in os.listdir(os.path.join(root, kind))}


def left(spark, before):
    return sorted(kind for kind, _ in tables(spark) - before)


def few(spark):
    return spark.createDataFrame(edge_rows(), "doc_id long, text string, lang string, source string, n_chars long")


def test_what_the_result_reads_stays(spark):
    before = tables(spark)

    @tidy
    def inner():
        once = written(spark.range(5), "tidy-once")
        return written(once.where("id > 1"), "tidy-kept"), written(once, "tidy-second")

    @tidy
    def outer():
        kept, second = inner()
        assert left(spark, before) == ["tidy-kept", "tidy-second"]
        return kept.select("id")

    assert rows(outer()) == [(2,), (3,), (4,)]
    assert left(spark, before) == ["tidy-kept"]


def test_operators_keep_little(spark):
    docs, before = few(spark), tables(spark)
    found = jaccard(docs)
    assert set(left(spark, before)) <= {"jaccard-rows", "jaccard-copies", "jaccard-roots", "cc", "jaccard-cc"}
    assert found.count() == docs.count()
    before = tables(spark)
    found = substring_dedup(docs)
    assert set(left(spark, before)) <= {"substring-copies", "substring-marks"}
    assert found.count() == docs.count()


def test_keys_are_gone_before_sets_are_written(spark, monkeypatch):
    before, seen, whole_sets = tables(spark), [], ngram_jaccard.whole_sets

    def watched(*args):
        seen.extend(left(spark, before))
        return whole_sets(*args)

    monkeypatch.setattr(ngram_jaccard, "whole_sets", watched)
    jaccard(few(spark)).count()
    assert "jaccard-bucket" in seen and "jaccard-signatures" not in seen

def test_pipeline_leaves_its_result(spark, tmp_path):
    few(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "no such item stands anywhere here")], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    before = tables(spark)
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert found.count() > 0
    assert left(spark, before) == ["pipeline-packing"]


def test_decontamination_copies_no_rows(spark, tmp_path):
    text = "this very item of nine words stands here whole"
    docs = spark.createDataFrame([(1, text), (1, "another text of its own"), (None, "x y " + text), (None, None)],
                                 "doc_id long, text string")
    spark.createDataFrame([(1, text)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    before = tables(spark)
    found = corpus_pipeline.decontamination(spark, docs, str(tmp_path))
    assert rows(found) == [(1, "another text of its own"), (None, None)]
    assert left(spark, before) == ["pipeline-leaks"]


def test_stages_copy_no_rows_of_files(spark, tmp_path):
    """Rows read from files are known by file and place: only narrow tables are written, whatever the ids."""
    text = lambda name, n=40: " ".join(f"{name}{i}" for i in range(n))
    some = [(7, text("c")), (7, text("c")), (7, text("d")), (None, text("c")), (None, text("e")), (3, f"{text('f')} {text('d', 30)}")]
    spark.createDataFrame(some, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    before = tables(spark)
    kept = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path))
    assert rows(kept) == sorted([(7, text("c")), (7, text("d")), (None, text("e")), some[-1]], key=str)
    assert left(spark, before) == ["pipeline-near"]
    before = tables(spark)
    kept = corpus_pipeline.substrings(spark, docs, str(tmp_path))
    assert rows(kept) == sorted([(7, text("c")), (7, " ".join(f"d{i}" for i in range(30, 40))), (None, text("e")), some[-1]], key=str)
    assert set(left(spark, before)) <= {"substring-copies", "substring-marks"}


def test_rows_read_twice_get_keys_of_their_own(spark, tmp_path):
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame([(1, "one two three"), (None, "four")], "doc_id long, text string").write.parquet(path)
    once = spark.read.parquet(path)
    for docs in (once, once.union(once), spark.read.parquet(path, path), once.crossJoin(spark.range(2)).drop("id"),
                 spark.createDataFrame([(1, "x"), (1, "x")], "doc_id long, text string")):
        numbered, key = corpus_pipeline.keyed(docs)
        assert numbered.columns == [*docs.columns, key]
        assert numbered.where(f"{key} IS NOT NULL").select(key).distinct().count() == numbered.count() == docs.count()
        assert rows(numbered.drop(key)) == rows(docs)


def test_copies_of_sets_are_gone_before_pairs(spark, monkeypatch):
    """The sets of costly keys' documents, as large as their texts, go when their rarest elements are known."""
    passage, before, seen = " ".join(f"p{i}" for i in range(60)), tables(spark), []
    docs = spark.createDataFrame([(d, f"{' '.join(f'w{d}x{i}' for i in range(9))} {passage}") for d in range(60)],
                                 "doc_id long, text string")
    rounds = ngram_jaccard._Links.rounds

    def watched(self, bucket, most):
        if most is None:
            seen.append(left(spark, before))
        return rounds(self, bucket, most)

    monkeypatch.setattr(ngram_jaccard._Links, "rounds", watched)
    assert jaccard(docs).count() == 60
    assert seen and all("jaccard-rarest" in x and "jaccard-part-sets" not in x for x in seen)
