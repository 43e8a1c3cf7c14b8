"""Language identification: averaged hashed subword embeddings with a linear softmax.

A document is the mean embedding of its hashed byte trigrams and words; a linear layer and a softmax
give language scores. Embeddings and layer are trained together by stochastic gradient descent in
numpy on a bounded sample of labelled documents, the scores are calibrated by a temperature on a held
part of the sample, and a score below the calibrated threshold is marked as not accepted. As the
layer is linear, prediction adds up one row of class scores for each feature.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import documents, map_arrow
from strata.llm.words import LOWER, Chunk, chunks, mix, words

#: Hash slots of features; width of an embedding.
SLOTS, WIDTH = 1 << 15, 8
#: Labelled documents of a language, and of all languages, that training reads at most.
SAMPLE, SAMPLE_ALL = 400, 4000
#: Most wrong answers among accepted ones on the held part of the sample.
ERROR = 0.01

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_ASCII = np.zeros(256, bool)
_ASCII[65:91] = _ASCII[97:123] = True


def features(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(slot, document) of all features, by document: trigrams around each letter byte, and words."""
    data, n = chunk.data, len(chunk.data)
    letter = _LETTER[data]
    flat = np.where(letter, LOWER[data], 0).astype(np.uint64)
    edge = np.zeros(n + 1, bool)
    edge[chunk.offsets] = True
    before, after = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    before[1:], after[:-1] = flat[:-1], flat[1:]
    before[edge[:-1]] = 0
    after[edge[1:]] = 0
    at = np.flatnonzero(letter)
    gram = (before[at] << np.uint64(16)) | (flat[at] << np.uint64(8)) | after[at]
    w = words(chunk, lower=True)
    doc = np.concatenate([np.searchsorted(chunk.offsets, at, "right") - 1, w.docs])
    slot = np.concatenate([mix(gram + np.uint64(1 << 40)), w.codes]) & np.uint64(SLOTS - 1)
    order = np.argsort(doc, kind="stable")
    return slot[order].astype(np.int64), doc[order]


def has_letter(chunk: Chunk) -> np.ndarray:
    """Whether each document has a letter."""
    inside = np.concatenate([[0], np.cumsum(_ASCII[chunk.data])])[chunk.offsets]
    out = np.diff(inside) > 0
    for d in np.flatnonzero(~out).tolist():
        out[d] = any(map(str.isalpha, chunk.text(d).decode()))
    return out


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3: 1 is held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


@dataclass
class LanguageModel:
    """Class scores by slot, temperature and threshold."""

    languages: list[str]
    scores: np.ndarray  # (classes, SLOTS)
    temperature: float = 1.0
    threshold: float = 0.0

    def predict(self, slot: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
        """Calibrated probabilities (documents, classes)."""
        bounds = np.searchsorted(doc, np.arange(docs + 1))
        size = np.maximum(np.diff(bounds), 1)
        logits = np.stack([np.diff(np.concatenate([[0.0], np.cumsum(s[slot])])[bounds]) / size for s in self.scores],
                          axis=1) / self.temperature
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        return p / p.sum(axis=1, keepdims=True)


def _histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, order, slots, counts) of each document."""
    for batch in batches:
        slots, counts = [], []
        for chunk in chunks(batch.column("_text")):
            slot, doc = features(chunk)
            bounds = np.searchsorted(doc, np.arange(chunk.last - chunk.first + 1))
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                s, c = np.unique(slot[a:b], return_counts=True)
                slots.append(s.astype(np.int32))
                counts.append(c.astype(np.float32))
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang"), batch.column("order"), pa.array(slots, pa.list_(pa.int32())),
             pa.array(counts, pa.list_(pa.float32()))], names=["lang", "order", "slots", "counts"])


def sample(docs: DataFrame) -> DataFrame:
    """At most SAMPLE labelled documents of each language that are not held out, by a hash of the id, and
    at most SAMPLE_ALL in all. Ids are chosen without their texts, which are then fetched for these alone."""
    order = F.xxhash64(F.col("doc_id"), F.lit(11))
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder(F.col("doc_id")) != 1)) \
        .select(F.col("lang").cast("string").alias("lang"), order.alias("order"), F.col("text").alias("_text"))
    ids = labelled.select("lang", "order")
    # of more languages than the sample has documents, only the first by name can be in it
    sizes = ids.groupBy("lang").agg(F.count(F.lit(1)).alias("_n")).orderBy("lang").limit(SAMPLE_ALL)
    # a hash threshold leaves about twice the sample of each language, which is then ranked
    share = (F.col("order") / F.lit(float(1 << 63)) + 1) / 2
    near = ids.join(F.broadcast(sizes), "lang").where(share <= F.lit(2.0 * SAMPLE) / F.col("_n")).select("lang", "order").distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("order"))
    chosen = near.withColumn("_rank", rank).where(F.col("_rank") <= SAMPLE).orderBy("_rank", "lang").limit(SAMPLE_ALL)
    # at most SAMPLE_ALL rows are broadcast; ids that many rows share give no larger sample
    return labelled.join(F.broadcast(chosen), ["lang", "order"]) \
        .orderBy("_rank", "lang", F.xxhash64("_text")).limit(SAMPLE_ALL).select("lang", "order", "_text")


def train(docs: DataFrame, epochs: int = 12, rate: float = 40.0) -> LanguageModel | None:
    """Train on the sample (its histograms, at most SAMPLE_ALL rows of SLOTS counts, come to the driver)."""
    rows = map_arrow(sample(docs), _histograms, "lang string, order long, slots array<int>, counts array<float>").collect()
    rows = sorted((r for r in rows if r["slots"]), key=lambda r: (r["order"], r["lang"]))
    if not rows:
        return None
    languages = sorted({r["lang"] for r in rows})
    draw = np.random.default_rng(3)
    slots = [np.array(r["slots"], np.int64) for r in rows]
    parts = [np.array(r["counts"]) / sum(r["counts"]) for r in rows]
    want = np.array([languages.index(r["lang"]) for r in rows])
    held = np.arange(len(rows)) % 5 == 4 if len(rows) >= 25 else np.zeros(len(rows), bool)
    learn = np.flatnonzero(~held)
    table = draw.normal(0, 0.1, (SLOTS, WIDTH))
    layer = draw.normal(0, 0.1, (WIDTH, len(languages)))
    size = 16
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        draw.shuffle(learn)
        for i in range(0, len(learn), size):
            some = learn[i:i + size]
            ids, part = np.concatenate([slots[d] for d in some]), np.concatenate([parts[d] for d in some])
            first = np.concatenate([[0], np.cumsum([len(slots[d]) for d in some])])
            mean = np.add.reduceat(table[ids] * part[:, None], first[:-1], axis=0)
            logits = mean @ layer
            logits -= logits.max(axis=1, keepdims=True)
            p = np.exp(logits)
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(some)), want[some]] -= 1
            p /= len(some)
            back = np.repeat(p @ layer.T, np.diff(first), axis=0) * part[:, None]
            layer -= 0.02 * step * (mean.T @ p)
            np.subtract.at(table, ids, step * back)
    model = LanguageModel(languages, (table @ layer).T.copy())
    if held.any():
        _calibrate(model, [(slots[d], parts[d]) for d in np.flatnonzero(held)], want[held])
    return model


def _calibrate(model: LanguageModel, held: list[tuple[np.ndarray, np.ndarray]], want: np.ndarray) -> None:
    """The temperature of least log loss, and the least score from which at most ERROR answers are wrong."""
    logits = np.stack([model.scores[:, s] @ p for s, p in held])

    def scores(t: float) -> np.ndarray:
        x = logits / t - (logits / t).max(axis=1, keepdims=True)
        return np.exp(x) / np.exp(x).sum(axis=1, keepdims=True)

    grid = np.geomspace(0.05, 20, 60)
    model.temperature = float(min(grid, key=lambda t: -np.log(np.maximum(scores(t)[np.arange(len(want)), want], 1e-12)).sum()))
    p = scores(model.temperature)
    top, right = p.max(axis=1), p.argmax(axis=1) == want
    order = np.argsort(-top)
    wrong = np.cumsum(~right[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(wrong <= ERROR)
    model.threshold = float(top[order[good[-1]]]) if len(good) else 1.0


def _predict(model: LanguageModel | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], []
            for chunk in chunks(batch.column("_text")):
                letters = has_letter(chunk)
                if model is None:
                    langs += ["und"] * len(letters)
                    scores += [0.0] * len(letters)
                    continue
                p = model.predict(*features(chunk), len(letters))
                langs += [model.languages[k] if ok else "und" for k, ok in zip(p.argmax(axis=1).tolist(), letters.tolist())]
                scores += np.where(letters, p.max(axis=1), 0.0).tolist()
            limit = model.threshold if model else 1.0
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()),
                 pa.array(scores, pa.float64()), pa.array([s > 0 and s >= limit for s in scores], pa.bool_())],
                names=["doc_id", "held_out", "lang_pred", "score", "accepted"])
    return run


def identify(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, accepted.

    ``und`` (score 0, not accepted) is given to a NULL text, a text without a letter, and to all texts
    if nothing can be learned. A NULL doc_id is not learned from and not held out; repeated rows get
    equal results; texts of any length are read whole; an empty table gives no rows; other columns, whatever
    their names, are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(remainder(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"),
                       F.col("text").alias("_text"))
    return map_arrow(rows, _predict(train(docs)),
                     "doc_id long, held_out boolean, lang_pred string, score double, accepted boolean")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents."""
    return identify(documents(spark, sf_dir))
