import zlib
from collections import Counter

import numpy as np
import pytest

from keyreport.llm import language_id
from keyreport.llm.catalog import QUERIES
from keyreport.llm.language_id import columns_of, fit, predict, temperature_for, train


@pytest.fixture(scope="module")
def model(documents):
    return fit(documents)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    out = QUERIES["op7_language_id"](spark, sf).collect()
    assert len(out) == len(lang)
    held = [r for r in out if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in out)
    right = [r["lang_pred"] == lang[r["doc_id"]] for r in held if lang[r["doc_id"]] is not None]
    assert np.mean(right) > 0.98
    assert abs(np.mean([r["score"] for r in held]) - np.mean(right)) < 0.05  # calibrated


def test_edge_rows(documents, rows, model):
    out = predict(documents, model)
    got = [(r["record"]["doc_id"], r["record"]["text"], r["lang_pred"], r["score"]) for r in out.collect()]
    assert sorted(map(str, ((a, b) for a, b, _, _ in got))) == sorted(map(str, rows))
    for _, text, lang, score in got:
        letter = any(c.isalpha() for c in text or "")
        assert (lang in model.labels) if letter else (lang == "und" and score == 0.0)
        assert 0.0 <= score <= 1.0
    assert out.select("record.*").columns == documents.columns


def test_nothing_to_learn_or_predict(documents, nothing, model):
    assert predict(nothing, model).count() == 0
    empty = fit(nothing)
    assert {r["lang_pred"] for r in predict(documents, empty).select("lang_pred").collect()} == {"und"}


def test_grams_stay_inside_their_text():
    one = [sorted(zip(o.tolist(), x.tolist(), strict=True)) for x, o in columns_of(["abc", "", "Ab"])]
    assert [len(x) for x in one] == [5, 3, 1]
    alone = [x.tolist() for x, _ in columns_of(["ab"])]
    assert alone[1] == [x for o, x in one[1] if o == 2]


def test_temperature_undoes_overconfidence():
    rng = np.random.default_rng(2)
    logits = rng.normal(0, 1, (4000, 3))
    p = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True)
    y = np.array([rng.choice(3, p=q) for q in p])
    assert temperature_for(4 * logits, y) == pytest.approx(4, rel=0.15)
    assert temperature_for(np.zeros((0, 3)), np.zeros(0, int)) == 1.0


def learnable(n):
    """Ids that may be learned from."""
    return [i for i in range(4 * n) if zlib.crc32(str(i).encode()) % 4 != 2][:n]


def test_repeated_ids_and_rows_do_not_multiply_the_sample(spark, monkeypatch):
    a, b = learnable(2)
    rows = [(a if i % 3 else b, f"the word {i} of a text", "en" if i % 2 else "de") for i in range(600)]
    rows += [(a, "one row many times", "fr")] * 300
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    got = []
    monkeypatch.setattr(language_id, "train", lambda data, labels: got.extend(data) or train(data, labels))
    fit(frame, sample=90)
    assert len([x for x in got if x[0] == 2]) <= 1  # equal rows are one row
    assert 40 <= len(got) <= 60  # four fifths of 30 for two labels, and the one row if it is among them
    assert fit(frame, sample=90).labels == ["de", "en", "fr"]


def test_every_label_is_learned_or_refused(spark, monkeypatch):
    rows = [(i, f"text {i}", f"l{i % 40}") for i in learnable(200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert len(fit(frame, sample=10).labels) == 40  # a row for each, though the sample is smaller
    monkeypatch.setattr(language_id, "MAX_LABELS", 39)
    with pytest.raises(ValueError):
        fit(frame)


def test_training_equals_a_slow_twin(monkeypatch):
    monkeypatch.setattr(language_id, "FEATURES", 12)
    rng = np.random.default_rng(4)
    rows = []
    for _ in range(30):
        x = np.sort(rng.choice(12, 4, replace=False))
        rows.append((int(rng.integers(3)), x, rng.random(4) * 5))
    z, n = [[0.0] * 3 for _ in range(13)], [[0.0] * 3 for _ in range(13)]

    def weight(i, c):
        if abs(z[i][c]) <= language_id.L1:
            return 0.0
        sign = 1 if z[i][c] > 0 else -1
        return -(z[i][c] - sign * language_id.L1) / ((language_id.BETA + n[i][c] ** 0.5) / language_id.ALPHA + language_id.L2)

    order = np.random.default_rng(11)
    for _ in range(language_id.EPOCHS):
        for k in order.permutation(len(rows)):
            y, x, v = rows[k]
            row = [*zip(x.tolist(), v.tolist()), (12, 1.0)]
            w = {i: [weight(i, c) for c in range(3)] for i, _ in row}
            score = [sum(w[i][c] * u for i, u in row) for c in range(3)]
            e = [np.exp(s - max(score)) for s in score]
            for i, u in row:
                for c in range(3):
                    g = u * (e[c] / sum(e) - (c == y))
                    step = ((n[i][c] + g * g) ** 0.5 - n[i][c] ** 0.5) / language_id.ALPHA
                    z[i][c] += g - step * w[i][c]
                    n[i][c] += g * g
    weights, bias = train(rows, 3)
    assert np.allclose(weights, [[weight(i, c) for c in range(3)] for i in range(12)])
    assert np.allclose(bias, [weight(12, c) for c in range(3)])


def test_prediction_equals_a_slow_twin(documents, model):
    out = predict(documents, model).select("record.text", "lang_pred", "score").collect()
    for text, lang, score in out:
        if lang == "und" or len(text) > 20_000:
            continue
        counts = Counter(int(c) for x, _ in columns_of([text]) for c in x)
        total = sum(counts.values())
        s = [(sum(n * float(model.weights[c, k]) for c, n in counts.items()) / total + model.bias[k]) / model.temperature
             for k in range(len(model.labels))]
        p = np.exp(np.array(s) - max(s))
        p /= p.sum()
        assert score == pytest.approx(p.max(), abs=1e-6) and lang == model.labels[int(p.argmax())]


def test_other_columns_stay_in_the_jvm(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = predict(docs, model)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1 and "MapInArrow" not in plan and "Exchange" not in plan
