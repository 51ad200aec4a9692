import re

import pytest

SF = "/root/testdata/sf0.001"
SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}

SENTENCE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
LONG = " ".join(f"w{i * i % 7919}x{i}" for i in range(60_000))


def edge_rows():
    """Null, empty, blank, tiny, repeated, very long and odd texts."""
    many = " ".join(f"{SENTENCE} {i}" for i in range(12))
    near = many.replace("kappa lambda", "kappa  Lambda", 1)
    return [
        (1_000_001, None, None, "a", None), (1_000_002, "", "en", "a", 0), (1_000_003, " \n\t ", None, None, 4),
        (1_000_004, "one", "en", "b", 3), (1_000_005, "One", "fr", "b", 3), (1_000_006, "one two three", None, "b", 13),
        (1_000_007, many, "en", "a", len(many)), (1_000_008, many, "en", "a", len(many)),
        (1_000_008, many, "en", "a", len(many)), (1_000_009, near, "en", "c", len(near)),
        (1_000_010, "a " * 400, "en", "a", 800), (1_000_011, "a " * 300 + "b " * 300, "en", "a", 1200),
        (1_000_012, LONG, "en", "a", len(LONG)), (1_000_013, LONG + " end", "de", "a", len(LONG) + 4),
        (None, many, "en", "a", len(many)), (None, None, None, None, None),
        (1_000_014, "12 34 中文 été \u0001 x y", "fr", "d", 16),
        (1_000_015, "<|endoftext|> a   b \n \n c  ", None, "d", 26),
        (1_000_016, "1234 5678", "en", "d", 9),
    ]


CLASH = ["n_words", "key", "keys", "record", "score", "lang_pred", "row", "bucket", "shard", "slot", "size", "c", "t",
         "starts", "kept_text", "component_id", "n_shingles", "length", "ids", "spans", "item_id", "rank"]


@pytest.fixture(scope="session")
def documents(spark):
    """The smallest table with edge rows, and columns whose names the operators use."""
    from pyspark.sql import functions as F

    base = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    edges = spark.createDataFrame(edge_rows(), base.schema)
    return base.union(edges).repartition(3).select("*", *(F.lit(c).alias(c) for c in CLASH)).cache()


@pytest.fixture(scope="session")
def rows(documents):
    return [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def nothing(documents):
    return documents.limit(0)


def space_words(text, lower=False):
    text = text or ""
    return SPACE.findall(text.translate(LOWER) if lower else text)


def alnum_words(text):
    return ALNUM.findall((text or "").translate(LOWER))
