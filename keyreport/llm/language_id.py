"""Language identification: sparse multinomial logistic regression on TF-IDF of
character n-grams.

* Features: all character 1-, 2- and 3-grams of the lower-cased text, hashed to
  ``FEATURES`` columns; term frequency is the share of the text's n-grams, weighted
  by inverse document frequency. Document frequencies are counted over every
  row that may be learned from.
* Training: follow-the-regularised-leader (proximal, per coordinate) with elastic
  net penalties, on the driver over a sample of at most ``SAMPLE`` rows (one per label
  at least), spread evenly over the labels: the smallest hashes of id and text first.
  Rows equal in id, text and label are one row of the sample. Rows far above the hash
  that a label's share needs never reach the ranking. One row has at most ``FEATURES``
  numbers, so the sample is bounded.
* Calibration: one temperature, fitted to the log loss of a fifth of the sample
  that isn't trained on.

Prediction reads every whole text, in one pass without a shuffle: a scalar Arrow
function of the text, so the other columns stay in the JVM.

Rows learned from have a label and crc32(id as text) mod 4 other than 2; the rest
is held out. Defined results: text null or without a letter: ``und``, score 0.
Null id: neither learned from nor held out. Nothing to learn from: ``und``
everywhere. Rows that repeat an id are predicted each. More than ``MAX_LABELS`` labels
are an error, as the model has a column for each. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyreport.llm.common import CHUNK_BYTES, chunks, join_small, table, written
from keyreport.llm.queries import query

FEATURES = 1 << 15
SIZES = (1, 2, 3)
SAMPLE = 2400
MAX_LABELS = 400
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.01
SCALE = 64.0
BLOCK_ROWS = 128
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray     # FEATURES x labels, with the inverse document frequencies
    bias: np.ndarray
    temperature: float


def columns_of(texts: list[str]):
    """Feature column of every n-gram of ``texts`` (no n-gram spans two), per size,
    with its text's number."""
    texts = [t.lower() for t in texts]
    code = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), dtype=np.uint32)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in texts])
    shift = np.uint32(32 - int(np.log2(FEATURES)))
    with np.errstate(over="ignore"):
        for n in SIZES:
            m = max(0, len(code) - n + 1)
            x = np.full(m, n, dtype=np.uint32)
            for j in range(n):
                x = (x ^ code[j:j + m]) * _FACTORS[j]
                x ^= x >> np.uint32(15)
            x = (x * np.uint32(0x27D4EB2F)) >> shift
            if n > 1:
                inside = owner[:m] == owner[n - 1:]
                yield x[inside], owner[:m][inside]
            else:
                yield x, owner


def blocks(batches):
    """(batch slice, its texts) with few enough rows for a table of all features."""
    for batch in chunks(batches, limit=CHUNK_BYTES // 2):
        for a in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(a, BLOCK_ROWS)
            yield part, [t or "" for t in part.column("text").to_pylist()]


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    def run(batches):
        total, rows = np.zeros(FEATURES, dtype=np.int64), 0
        for _, texts in blocks(batches):
            seen = np.zeros((len(texts), FEATURES), dtype=bool)
            for x, owner in columns_of(texts):
                seen[owner, x] = True
            total += seen.sum(axis=0)
            rows += len(texts)
        at = np.append(np.flatnonzero(total), FEATURES)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(np.append(total, rows)[at])],
                                         names=["x", "n"])

    # At most FEATURES + 1 sums.
    sums = docs.select("text").mapInArrow(run, "x int, n long").groupBy("x").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(FEATURES + 1, dtype=np.int64)
    for r in sums:
        out[r["x"]] = r["n"]
    return int(out[-1]), out[:-1]


def counted(docs: DataFrame) -> DataFrame:
    """Per row of ``docs(lang, part, text)`` its n-gram shares by feature column."""
    def run(batches):
        for part, texts in blocks(batches):
            share = np.zeros((len(texts), FEATURES), dtype=np.float32)
            for x, owner in columns_of(texts):
                np.add.at(share, (owner, x), 1)
            rows = [np.flatnonzero(s) for s in share]
            off = pa.array(np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32))
            value = np.concatenate([s[r] / max(1, s.sum()) for s, r in zip(share, rows, strict=True)])
            yield pa.RecordBatch.from_arrays(
                [part.column("lang"), part.column("part"),
                 pa.ListArray.from_arrays(off, pa.array(np.concatenate(rows), pa.int32())),
                 pa.ListArray.from_arrays(off, pa.array(value, pa.float32()))], names=["lang", "part", "x", "v"])

    return docs.select("lang", "part", "text").mapInArrow(run, "lang string, part int, x array<int>, v array<float>")


def softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], labels: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias by follow-the-regularised-leader; rows: (label, columns, values)."""
    z, n = np.zeros((FEATURES + 1, labels)), np.zeros((FEATURES + 1, labels))
    rng = np.random.default_rng(11)

    def leader(at):
        zs, ns = z[at], n[at]
        w = -(zs - np.sign(zs) * L1) / ((BETA + np.sqrt(ns)) / ALPHA + L2)
        return np.where(np.abs(zs) > L1, w, 0.0)

    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            y, x, v = rows[i]
            at, v = np.append(x, FEATURES), np.append(v, 1.0)
            w = leader(at)
            error = softmax(v @ w)
            error[y] -= 1.0
            g = v[:, None] * error
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - step * w
            n[at] += g * g
    w = leader(np.arange(FEATURES + 1))
    return w[:-1], w[-1]


def temperature_for(scores: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search on its logarithm."""
    if not len(y):
        return 1.0

    def loss(t):
        return -np.log(np.maximum(softmax(scores / np.exp(t))[np.arange(len(y)), y], 1e-12)).mean()

    a, b, r = -3.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def held_out(id_column: Column) -> Column:
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def with_hash(rows: DataFrame) -> DataFrame:
    return rows.withColumn("h", F.xxhash64("id", "text"))


def sample_rows(rows: DataFrame, sizes: dict[str, int], share: int) -> DataFrame:
    """``lang, id, h, part`` of the ``share`` rows of each label with the smallest hashes."""
    bounds = rows.sparkSession.createDataFrame(  # one row per label
        [(x, min((1 << 63) - 1, ((3 * share + 100) << 63) // n)) for x, n in sizes.items()], "lang string, most long")
    place = F.shiftrightunsigned("h", 1)
    near = with_hash(rows).join(F.broadcast(bounds), "lang").where(place < F.col("most"))
    once = near.select("lang", "id", "h").distinct()
    order = Window.partitionBy("lang").orderBy(place, "h", "id")
    ranked = once.withColumn("r", F.row_number().over(order)).where(F.col("r") <= share)
    return ranked.select("lang", "id", "h", (F.col("r") % 5).alias("part"))


def fit(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang") -> Model:
    """Learn from the rows of ``docs`` that aren't held out and have a label and text."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(~held_out(F.col("id")) & F.col("id").isNotNull() & F.col("lang").isNotNull()
                      & F.col("text").isNotNull())
    per_label = rows.groupBy("lang").agg(F.count("*").alias("rows"))
    sizes = {r["lang"]: r["rows"] for r in per_label.limit(MAX_LABELS + 1).collect()}
    labels = sorted(sizes)
    if len(labels) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels to learn")
    if not labels:
        return Model([], np.zeros((FEATURES, 0), np.float32), np.zeros(0), 1.0)
    total, df = document_frequencies(rows)
    idf = np.log((1.0 + total) / (1.0 + df)) + 1.0
    chosen = written(sample_rows(rows, sizes, max(1, sample // len(labels))), "language-sample")
    # The join meets a chosen row once per equal row; one of them is enough.
    again = join_small(with_hash(rows), chosen, ["lang", "id", "h"]).dropDuplicates(["lang", "id", "h"])
    got = counted(again).collect()
    number = {x: i for i, x in enumerate(labels)}
    data = []
    for r in sorted(got, key=lambda r: (r["lang"], r["part"], r["x"][:8], len(r["x"]))):
        x = np.array(r["x"], dtype=np.int64)
        data.append((number[r["lang"]], x, np.array(r["v"]) * idf[x] * SCALE, r["part"]))
    weights, bias = train([d[:3] for d in data if d[3] != 0], len(labels))
    check = [d for d in data if d[3] == 0]
    scores = np.array([v @ weights[x] + bias for _, x, v, _ in check]).reshape(len(check), len(labels))
    t = temperature_for(scores, np.array([d[0] for d in check], dtype=np.int64))
    return Model(labels, (weights * (idf * SCALE)[:, None]).astype(np.float32), bias, t)


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """(record, lang_pred, score) per row of ``docs``: record is a struct of its
    columns, score the calibrated probability."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES x labels numbers

    def judged(texts: list[str], model: Model, dense: np.ndarray) -> tuple[list[str], np.ndarray]:
        known = np.array([bool(model.labels) and _LETTER.search(t) is not None for t in texts], dtype=bool)
        score, pred = np.zeros(len(texts)), [UNKNOWN] * len(texts)
        if known.any():
            sums, size = np.zeros((len(texts), len(model.labels))), np.zeros(len(texts))
            for x, owner in columns_of(texts):
                size += np.bincount(owner, minlength=len(texts))
                for c, w in enumerate(dense):
                    sums[:, c] += np.bincount(owner, weights=w[x], minlength=len(texts))
            p = softmax((sums / np.maximum(size, 1)[:, None] + model.bias) / model.temperature)
            best = p.argmax(axis=1)
            score = np.where(known, p.max(axis=1), 0.0)
            pred = [model.labels[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
        return pred, score

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = sent.value
        dense = np.ascontiguousarray(model.weights.T)
        for texts in batches:
            preds, scores = [], []
            for part in chunks([pa.RecordBatch.from_arrays([texts], names=["text"])], limit=CHUNK_BYTES // 2):
                pred, score = judged([t or "" for t in part.column("text").to_pylist()], model, dense)
                preds += pred
                scores.append(score)
            yield pa.StructArray.from_arrays([pa.array(preds, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())],
                                             names=["lang_pred", "score"])

    found = docs.select(F.struct("*").alias("record"), judge(F.col(text_col).cast("string")).alias("found"))
    return found.select("record", "found.lang_pred", "found.score")


@query("op7_language_id")
def op7_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = predict(docs.select("doc_id", "text"), fit(docs))
    return found.select("record.doc_id", held_out(F.col("record.doc_id")).alias("held_out"), "lang_pred", "score")
