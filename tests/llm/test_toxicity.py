"""Toxicity: features, ratios, gradients and scores against plain versions; held-out accuracy."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import toxicity
from strata.llm.words import chunks
from tests.llm.conftest import prose

SPACES = " \t\n\x0b\x0c\r"


def grams(text: str | None) -> set[bytes]:
    data = b" " + (text or "").encode() + b" "
    data = bytes(32 if b in SPACES.encode() else b + 32 if 65 <= b <= 90 else b for b in data)
    return {data[k:k + n] for n in toxicity.ORDERS for k in range(len(data) - n + 1)}


def test_features_are_the_distinct_grams_of_each_text():
    texts = ["", None, "a", "Ab c", "été\nÜber  x", "moron moron", "z" * 50, "moron  moron", "B\tc"] * 2
    per = []
    for chunk in chunks(pa.array(texts)):
        doc, slot = toxicity.found(chunk)
        per += [slot[doc == d] for d in range(chunk.last - chunk.first)]
    slots: dict[bytes, set[int]] = {}
    for text, own in zip(texts, per):
        mine = grams(text)
        assert len(own) == len(set(own.tolist())) == len(mine)  # no two of these few share a slot
        slots.setdefault(text, set(own.tolist()))
        assert slots[text] == set(own.tolist())
    alone = toxicity.found(next(chunks(pa.array(["Ab c"]))))[1]
    assert set(alone.tolist()) == slots["Ab c"] != slots["B\tc"]
    wanted = np.zeros(1 << toxicity.BITS, bool)
    wanted[alone[:3]] = True
    assert toxicity.found(next(chunks(pa.array(["Ab c"]))), wanted)[1].tolist() == alone[:3].tolist()


def test_log_ratios():
    ratio, clear = toxicity.log_ratios(np.array([0.0, 90, 1]), np.array([40.0, 9, 1]), 900, 100)
    assert ratio[0] == pytest.approx(np.log(40.5 / 101) - np.log(0.5 / 901))
    assert abs(ratio[1]) < 0.1 and clear[1] < 1 and clear[0] > 4
    assert clear[2] == 0  # too few documents


def test_fit_follows_the_gradient():
    draw = np.random.default_rng(1)
    dense = (draw.random((300, 20)) < 0.3) * draw.normal(1, 0.2, 20)
    want = (dense @ draw.normal(0, 3, 20) > 0).astype(float)
    rows, cols = np.nonzero(dense)
    def loss(w, b):
        z = dense @ w + b
        return np.mean(np.log1p(np.exp(-z)) + (1 - want) * z)
    weights, bias = toxicity.fit(rows, cols, dense[rows, cols], want, 20, rounds=1, decay=0)
    slope = np.array([loss(1e-4 * e, -2.0) - loss(-1e-4 * e, -2.0) for e in np.eye(20)]) / 2e-4
    # the first step of each weight is as long for all, against the slope of the loss
    assert np.sign(weights)[abs(slope) > 1e-4] == pytest.approx(-np.sign(slope)[abs(slope) > 1e-4])
    assert bias == pytest.approx(-2.0 - 0.1 * np.sign(loss(0 * slope, -1.999) - loss(0 * slope, -2.001)), abs=1e-3)
    losses = [loss(*toxicity.fit(rows, cols, dense[rows, cols], want, 20, rounds=n, decay=0)) for n in (1, 50, 150, 600)]
    assert losses == sorted(losses, reverse=True) and losses[-1] < 0.6 * losses[0]


def corpus(seed: int, n: int) -> list[tuple]:
    draw = random.Random(seed)
    bad = ["grubnik", "mordax", "Vlekkig", "snurtch", "öddling"]
    out = []
    for k in range(n):
        text, toxic = prose(draw, draw.choice([6, 40, 150])), int(draw.random() < 0.2)
        words = text.split()
        for _ in range(max(1, len(words) // 12) if toxic else 0):
            words.insert(draw.randrange(len(words)), draw.choice(bad))
        out.append((k, " ".join(words), toxic))
    return out


@pytest.fixture(scope="module")
def learned(spark):
    rows = corpus(3, 1500)
    docs = spark.createDataFrame([(i, t, "xx", i, 1.0) for i, t, _ in rows],
                                 "doc_id long, text string, toxic string, label long, score double")
    labels = spark.createDataFrame([(i, t, 9, "n") for i, _, t in rows if i % 5], "doc_id long, toxic int, quality int, text string")
    return rows, docs, labels


def test_held_out_documents(learned):
    rows, docs, labels = learned
    got = {r.doc_id: r for r in toxicity.score_documents(docs, labels).collect()}
    assert len(got) == len(rows)
    hits = Counter()
    for i, _, toxic in rows:
        held = zlib.crc32(str(i).encode()) % 4 == 2
        assert got[i].held_out == held and 0 <= got[i].score <= 1 and got[i].predicted == int(got[i].score >= 0.3)
        hits[(held, toxic, got[i].predicted)] += 1
    assert hits[(True, 1, 1)] >= 0.95 * (hits[(True, 1, 0)] + hits[(True, 1, 1)])
    assert hits[(True, 0, 1)] <= 0.01 * (hits[(True, 0, 0)] + hits[(True, 0, 1)])


def test_held_out_labels_are_not_read(spark, learned):
    rows, docs, labels = learned
    other = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2 THEN 1 - toxic ELSE toxic END AS toxic")
    a, b = (sorted(tuple(r) for r in toxicity.score_documents(docs, x).collect()) for x in (labels, other))
    assert a == b


def test_scores_are_the_models_own(learned):
    rows, docs, labels = learned
    model = toxicity.train(docs, labels)
    weight = dict(zip(model.slots.tolist(), model.weights.tolist()))
    score = model.scorer()
    texts = [t for _, t, _ in rows[:40]] + ["", None, "grubnik " * 5000]
    for chunk in chunks(pa.array(texts)):
        doc, slot = toxicity.found(chunk)
        for d, p in enumerate(score(chunk).tolist()):
            total = sum(weight.get(s, 0.0) for s in slot[doc == d].tolist()) + model.bias
            assert p == pytest.approx(1 / (1 + np.exp(-total)))


def test_odd_rows(docs, no_docs, spark):
    labels = spark.createDataFrame([(k, int(k % 9 == 0)) for k in range(60)] + [(None, 1), (3, None), (7, 0), (7, 1), (999, 1)],
                                   "doc_id long, toxic int")
    got = toxicity.score_documents(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    nulls = {r.score for r in got if r.doc_id in (100, 101)}
    assert len(nulls) == 1 and all(not r.held_out for r in got if r.doc_id is None)
    assert toxicity.score_documents(no_docs, labels).collect() == []
    assert max(r.score for r in toxicity.score_documents(docs, labels.where("false")).collect()) < 1e-9
    assert {r.predicted for r in toxicity.score_documents(docs, labels.where("toxic = 1")).collect()} == {1}


def test_the_sample_is_bounded(learned, monkeypatch):
    _, docs, labels = learned
    monkeypatch.setattr(toxicity, "TOXIC", 20)
    monkeypatch.setattr(toxicity, "OTHERS", 50)
    kinds = Counter(r.toxic for r in toxicity.sample(docs.unionByName(docs), labels).collect())
    assert sum(kinds.values()) <= 70 and kinds[1] and kinds[0]
