"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A document's features are the distinct hashed n-grams (3 to 8 bytes, A-Z as a-z, white space as a
space, one space before and after the text) that it holds. Learning takes a bounded sample of
labelled documents: the number of toxic and of other documents that hold each n-gram gives its log
ratio r; n-grams whose ratio stands clear of chance are kept; a logistic regression over r-scaled
presence gives their weights. Scoring reads every document whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import documents, map_arrow, stored
from strata.llm.words import _BASE, _BYTES, _INVERSE, LOWER, SPACE, Chunk, _power, chunks

#: Lengths of the n-grams in bytes; bits of a slot; slots whose counts travel as one row.
ORDERS = (3, 4, 5, 6, 7, 8)
BITS = 22
BLOCK = 1 << 14
#: Labelled documents that learning reads at most: toxic ones, and others.
TOXIC, OTHERS = 1500, 4500
#: An n-gram counts if this many sampled documents hold it and its log ratio is this many standard
#: errors from 0; at most MOST of them, the clearest first.
HOLDERS, CLEAR, MOST = 5, 4.0, 1 << 16
#: From this score on a document is called toxic.
LIMIT = 0.3
#: Tasks over the sample.
TASKS = 16

_FOLD = np.where(SPACE, 32, LOWER).astype(np.uint8)
_SPREAD = np.uint64(0x9E3779B97F4A7C55)


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4: 2 is held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def found(chunk: Chunk, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(document, slot) of the distinct n-grams of each document, by document and slot; with ``wanted``
    (a flag for each slot) only of those."""
    docs = chunk.last - chunk.first
    sizes = np.diff(chunk.offsets)
    lead = chunk.offsets[:-1] + np.arange(docs)  # the space before each document
    data = np.full(len(chunk.data) + docs + 1, 32, np.uint8)
    data[np.arange(len(chunk.data)) + np.repeat(np.arange(docs), sizes) + 1] = _FOLD[chunk.data]
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[data] * _power(_BASE, n), out=sums[1:])
    inverse = _power(_INVERSE, n)
    last = np.append(lead[1:], n - 1)  # the space after each document
    keys = []
    for order in ORDERS:
        if n < order:
            break
        slot = (sums[order:] - sums[:-order]) * inverse[:n - order + 1]
        slot *= _SPREAD
        slot >>= np.uint64(64 - BITS)
        at = np.arange(len(slot)) if wanted is None else np.flatnonzero(wanted[slot])
        doc = np.searchsorted(lead, at, "right") - 1
        whole = at + order - 1 <= last[doc]
        keys.append(doc[whole].astype(np.int64) << BITS | slot[at[whole]].astype(np.int64))
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    every = np.unique(np.concatenate(keys))
    return every >> BITS, every & ((1 << BITS) - 1)


@dataclass
class ToxicityModel:
    """Weight of each kept slot (log ratio times the linear weight), bias, and the score if nothing can be learned."""

    slots: np.ndarray
    weights: np.ndarray
    bias: float

    def scorer(self):
        """score(chunk): the probability of each document."""
        wanted = np.zeros(1 << BITS, bool)
        wanted[self.slots] = True

        def score(chunk: Chunk) -> np.ndarray:
            doc, slot = found(chunk, wanted)
            value = self.weights[np.searchsorted(self.slots, slot)] if len(slot) else np.empty(0)
            total = np.bincount(doc, weights=value, minlength=chunk.last - chunk.first) + self.bias
            return 1 / (1 + np.exp(-np.clip(total, -500, 500)))
        return score


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(toxic, _order, _text) of at most TOXIC toxic and OTHERS other labelled documents that are not
    held out, by a hash of the id. Rows without id, text or label are left out; an id labelled twice
    counts as toxic if any of its labels does."""
    narrow = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (remainder(F.col("doc_id")) != 2)) \
        .groupBy(F.col("doc_id").cast("long").alias("_id")).agg((F.max("toxic") > 0).cast("int").alias("toxic")) \
        .withColumn("_order", F.xxhash64("_id", F.lit(13)))
    sizes = narrow.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()
    share = (F.col("_order") / F.lit(float(1 << 63)) + 1) / 2
    near = F.lit(False)
    for row in sizes:  # a hash threshold leaves about twice the bound of each class, which is then ranked
        bound = TOXIC if row["toxic"] else OTHERS
        near = near | ((F.col("toxic") == row["toxic"]) & (share <= F.lit(2.0 * bound / row["n"])))
    rank = F.row_number().over(Window.partitionBy("toxic").orderBy("_order", "_id"))
    chosen = narrow.where(near).withColumn("_rank", rank) \
        .where(F.col("_rank") <= F.when(F.col("toxic") == 1, TOXIC).otherwise(OTHERS)).select("_id", "toxic", "_order")
    texts = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("_id"), F.col("text").alias("_text"))
    # at most TOXIC + OTHERS ids and labels are broadcast; ids that many rows share give no larger sample
    return texts.join(F.broadcast(chosen), "_id").select("toxic", "_order", "_text") \
        .orderBy("_order", F.xxhash64("_text"), "_text").limit(TOXIC + OTHERS)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, holders): for each block of slots the number of (other, toxic) documents that hold each."""
    held = np.zeros((2, 1 << BITS), np.uint32)
    for batch in batches:
        toxic = np.asarray(batch.column("toxic"))
        for chunk in chunks(batch.column("_text")):
            doc, slot = found(chunk)
            for kind in (0, 1):
                held[kind] += np.bincount(slot[toxic[chunk.first + doc] == kind], minlength=1 << BITS).astype(np.uint32)
    for first in range(0, 1 << BITS, BLOCK):
        part = np.ascontiguousarray(held[:, first:first + BLOCK])
        if part.any():
            yield pa.RecordBatch.from_arrays([pa.array([first], pa.int64()), pa.array([part.tobytes()], pa.binary())],
                                             names=["block", "holders"])


def log_ratios(other: np.ndarray, toxic: np.ndarray, others: int, toxics: int) -> tuple[np.ndarray, np.ndarray]:
    """(log ratio, clearness) of n-grams held by so many of the ``others`` and ``toxics`` documents."""
    ratio = np.log((toxic + 0.5) / (toxics + 1)) - np.log((other + 0.5) / (others + 1))
    clear = np.abs(ratio) / np.sqrt(1 / (toxic + 0.5) + 1 / (other + 0.5))
    return ratio, np.where(toxic + other >= HOLDERS, clear, 0.0)


def _chosen(others: int, toxics: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        held = np.zeros((2, BLOCK), np.int64)
        for raw in table.column("holders"):
            held += np.frombuffer(raw.as_py(), np.uint32).reshape(2, BLOCK)
        ratio, clear = log_ratios(held[0].astype(float), held[1].astype(float), others, toxics)
        keep = np.flatnonzero(clear >= CLEAR)
        return pa.table({"slot": pa.array(keep + key[0].as_py(), pa.int64()), "ratio": pa.array(ratio[keep]),
                         "clear": pa.array(clear[keep])})
    return run


def _presence(slots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.zeros(1 << BITS, bool)
        wanted[slots] = True
        for batch in batches:
            held = []
            for chunk in chunks(batch.column("_text")):
                doc, slot = found(chunk, wanted)
                bounds = np.searchsorted(doc, np.arange(1, chunk.last - chunk.first))
                held += np.split(np.searchsorted(slots, slot).astype(np.int32), bounds)
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), batch.column("_order"), pa.array(held, pa.list_(pa.int32()))],
                                             names=["toxic", "_order", "held"])
    return run


def fit(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, want: np.ndarray, width: int,
        rounds: int = 150, decay: float = 0.01) -> tuple[np.ndarray, float]:
    """Logistic regression by whole-sample gradients with a step of its own for each weight."""
    weights, bias, seen, seen_bias = np.zeros(width), -2.0, np.full(width, 1e-8), 1e-8
    for _ in range(rounds):
        logit = np.bincount(rows, weights=weights[cols] * values, minlength=len(want)) + bias
        error = (1 / (1 + np.exp(-np.clip(logit, -500, 500))) - want) / len(want)
        slope = np.bincount(cols, weights=error[rows] * values, minlength=width) + decay * weights / max(width, 1)
        seen += slope * slope
        seen_bias += error.sum() ** 2
        weights -= 0.02 * slope / np.sqrt(seen)
        bias -= 0.1 * error.sum() / np.sqrt(seen_bias)
    return weights, float(bias)


def train(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Learn from the sample. To the driver come two counts, at most MOST n-grams, and which of these
    each sampled document holds. Without both kinds of documents the score is 0 or 1 for all."""
    rows = stored(sample(docs, labels).repartition(TASKS, "_order"), "toxicity-sample")
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    others, toxics = sizes.get(0, 0), sizes.get(1, 0)
    if not others or not toxics:
        return ToxicityModel(np.empty(0, np.int64), np.empty(0), 500.0 if toxics else -500.0)
    blocks = map_arrow(rows.select("toxic", "_text"), _counts, "block long, holders binary")
    kept = blocks.groupBy("block").applyInArrow(_chosen(others, toxics), "slot long, ratio double, clear double") \
        .orderBy(F.col("clear").desc(), "slot").limit(MOST).collect()
    kept = sorted((r["slot"], r["ratio"]) for r in kept)
    slots, ratio = np.array([s for s, _ in kept], np.int64), np.array([r for _, r in kept])
    held = map_arrow(rows, _presence(slots), "toxic int, _order long, held array<int>").collect()
    held = sorted(((r["_order"], r["toxic"], r["held"]) for r in held), key=lambda r: (r[0], r[1], r[2]))
    want = np.array([t for _, t, _ in held], float)
    cols = np.concatenate([np.array(h, np.int64) for _, _, h in held])
    place = np.repeat(np.arange(len(held)), [len(h) for _, _, h in held])
    weights, bias = fit(place, cols, ratio[cols], want, len(slots))
    return ToxicityModel(slots, weights * ratio, bias)


def _score(model: ToxicityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for batch in batches:
            parts = [score(chunk) for chunk in chunks(batch.column("_text"))]
            scores = np.concatenate(parts) if parts else np.empty(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()),
                 pa.array((scores >= LIMIT).astype(np.int32), pa.int32())], names=["doc_id", "held_out", "score", "predicted"])
    return run


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1), predicted (1 from LIMIT on).

    ``labels`` has doc_id and toxic. The score depends on the text alone: equal texts score alike, in
    repeated rows too, and a NULL or empty text scores like one without any n-gram. A NULL doc_id is
    not learned from and not held out. Texts of any length are read whole (a chunk holds one long text
    or many short ones). Other columns of either table, whatever their names, are not read. An empty
    table gives no rows; without labels, or without a toxic one, every score is 0, and 1 if there are
    only toxic ones. Scores are odds in the sample, in which a quarter at most is toxic if there are
    enough other documents.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(remainder(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"),
                       F.col("text").alias("_text"))
    return map_arrow(rows, _score(train(docs, labels)), "doc_id long, held_out boolean, score double, predicted int")


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of all documents, learned from the labels table."""
    return score_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
