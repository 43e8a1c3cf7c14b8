"""Ranked lexical search: MaxScore with bounds of term pairs.

Documents are tokenised once; only terms that some item asks for are kept. A task turns its documents into
segments: for each term a list of (document, impact) with the largest impact, and for the pairs of terms
that an item joins their intersection list with the largest joint impact. An item's terms are taken as such
pairs, each bounded by max(joint maximum, maximum of either alone), which is never above the sum of both
maxima. Units whose bounds together stay below the item's 20th score so far are not walked: their
terms are looked up only for documents that the other units found, as long as these can still get in.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import documents, map_arrow, stored
from strata.llm.words import LOWER, Chunk, Words, chunks, span_codes

#: Documents kept for an item; documents of a segment at most; salts of the last ranking.
TOP = 20
SEGMENT = 1 << 15
SALTS = 64
#: Bytes of items that are searched for together: their terms, lists and best documents are in every task.
BLOCK = 8 << 20
#: Weight of a document's length.
SHARE = 25

_TERM = np.zeros(256, bool)
_TERM[48:58] = _TERM[65:91] = _TERM[97:123] = _TERM[128:] = True


def terms(chunk: Chunk) -> Words:
    """Runs of ASCII letters, digits and everything beyond ASCII; codes take A-Z as a-z."""
    data, n = chunk.data, len(chunk.data)
    inside = np.zeros(n + 1, bool)
    inside[:-1] = _TERM[data]
    fresh = np.zeros(n + 1, bool)
    fresh[chunk.offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:n - 1] if n else False
    starts = np.flatnonzero(inside[:-1] & (~before | fresh[:-1]))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | fresh[1:])) + 1
    return Words(starts, ends, np.searchsorted(starts, chunk.offsets), span_codes(LOWER[data], starts, ends))


@dataclass
class Query:
    """An item: its number and id, its terms (places in the vocabulary) and how often it holds each."""

    number: int
    item: int | None
    terms: np.ndarray
    times: np.ndarray


def read_items(rows: list[tuple[int | None, str | None]], first: int = 0) -> tuple[np.ndarray, list[Query]]:
    """(sorted codes of all terms, queries)."""
    codes: list[np.ndarray] = []
    for chunk in chunks(pa.array([t for _, t in rows], pa.string())):
        w = terms(chunk)
        codes += np.split(w.codes, w.bounds[1:-1])
    vocabulary = np.unique(np.concatenate(codes)) if codes else np.empty(0, np.uint64)
    out = []
    for k, ((item, _), own) in enumerate(zip(rows, codes)):
        u, times = np.unique(own, return_counts=True)
        out.append(Query(first + k, item, np.searchsorted(vocabulary, u), times.astype(np.int64)))
    return vocabulary, out


def _postings(vocabulary: np.ndarray):
    """(doc_id, n, held, tf): number of terms, and the asked terms with their occurrences, of each document with a term."""
    width = max(len(vocabulary), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("_text")):
                w = terms(chunk)
                n = np.diff(w.bounds)
                at = np.searchsorted(vocabulary, w.codes)
                at[at == len(vocabulary)] = 0
                hit = vocabulary[at] == w.codes if len(vocabulary) else np.zeros(len(at), bool)
                keys, tf = np.unique(w.docs[hit] * width + at[hit], return_counts=True)
                bounds = np.searchsorted(keys, np.arange(len(n) + 1) * width).astype(np.int32)
                some = pa.array(n > 0)
                out = pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(chunk.first, len(n)), pa.array(n, pa.int64()),
                     pa.ListArray.from_arrays(bounds, pa.array(keys % width, pa.int32())),
                     pa.ListArray.from_arrays(bounds, pa.array(tf, pa.int64()))], names=["doc_id", "n", "held", "tf"])
                yield out.filter(some)
    return run


def weight(documents_: int, holders: int) -> int:
    """Of a term that ``holders`` of the documents hold."""
    return math.floor(1000 * math.log((2 * documents_ + 2) / (2 * holders + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, w: np.ndarray, documents_: int, length: int) -> np.ndarray:
    """What one occurrence of the term in an item adds to the document's score."""
    m = 100 - SHARE + (SHARE * n * documents_) // length
    return w * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


def pairs_of(query: Query, weights: np.ndarray) -> list[tuple[int, ...]]:
    """The query's terms by falling weight, in twos: (term, times, term, times), the last maybe alone."""
    order = np.lexsort((query.terms, -weights[query.terms] * query.times))
    flat = [(int(query.terms[k]), int(query.times[k])) for k in order if weights[query.terms[k]] > 0]
    return [sum(flat[k:k + 2], ()) for k in range(0, len(flat), 2)]


class Segment:
    """Inverted lists of some documents: by term, and by pair of terms."""

    def __init__(self, size: int, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, width: int,
                 pairs: set[tuple[int, ...]]) -> None:
        order = np.argsort(term * np.int64(size) + doc, kind="stable")
        order = order[impact[order] > 0]
        self.size, self.doc, self.impact = size, doc[order], impact[order]
        self.bounds = np.searchsorted(term[order], np.arange(width + 1))
        self.most = np.zeros(width, np.int64)
        full = np.flatnonzero(np.diff(self.bounds))
        if len(full):
            self.most[full] = np.maximum.reduceat(self.impact, self.bounds[full])
        self.sums = np.zeros(size, np.int64)
        self.pairs: dict[tuple[int, ...], np.ndarray] = {}  # joint impacts, highest first, TOP at most
        last, dense = -1, np.zeros(size, np.int64)
        for pair in sorted(p for p in pairs if len(p) == 4 and self.most[p[0]] and self.most[p[2]]):
            a, times_a, b, times_b = pair
            if a != last:
                if last >= 0:
                    dense[self.list(last)[0]] = 0
                docs, impact_a = self.list(a)
                dense[docs], last = impact_a, a
            docs, impact_b = self.list(b)
            joint = dense[docs]
            both = joint > 0
            joint = joint[both] * times_a + impact_b[both] * times_b
            self.pairs[pair] = np.sort(np.partition(joint, len(joint) - TOP)[-TOP:] if len(joint) > TOP else joint)[::-1]

    def list(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        s, e = self.bounds[term], self.bounds[term + 1]
        return self.doc[s:e], self.impact[s:e]

    def bound(self, unit: tuple[int, ...]) -> int:
        """The most that a document of the segment can get from the unit."""
        alone = [int(self.most[unit[k]]) * unit[k + 1] for k in range(0, len(unit), 2)]
        joint = self.pairs.get(unit)
        return max(*alone, int(joint[0]) if joint is not None and len(joint) else 0) if len(alone) > 1 else alone[0]

    def search(self, units: list[tuple[int, ...]], floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of all documents whose score is at least ``floor`` and above 0, or, if
        more than TOP documents do better, a superset of the best TOP and all that equal the last."""
        for unit in units:  # a joint impact is a part of its document's score
            joint = self.pairs.get(unit)
            if joint is not None and len(joint) >= TOP:
                floor = max(floor, int(joint[TOP - 1]))
        bounds = sorted(((self.bound(u), u) for u in units))
        below = np.cumsum([0] + [b for b, _ in bounds])  # bound of all units before each
        if below[-1] == 0 or below[-1] < floor:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        skip = max(int(np.searchsorted(below, floor, "left")) - 1, 0)  # units whose bounds stay below the floor
        sums, found = self.sums, []
        for _, unit in bounds[skip:]:
            for k in range(0, len(unit), 2):
                docs, impact = self.list(unit[k])
                sums[docs] += impact * unit[k + 1]
                found.append(docs)
        every = np.concatenate(found)
        if len(every) > self.size // 4:
            docs = np.flatnonzero(sums)
        else:
            docs = np.unique(every)
        scores = sums[docs]
        sums[docs] = 0
        if len(scores) > TOP:  # sums so far are parts of scores
            floor = max(floor, int(np.partition(scores, len(scores) - TOP)[len(scores) - TOP]))
        for place in range(skip - 1, -1, -1):
            can = scores + below[place + 1] >= floor
            if not can.all():
                docs, scores = docs[can], scores[can]
            unit = bounds[place][1]
            for k in range(0, len(unit), 2):
                own, impact = self.list(unit[k])
                if len(own):
                    at = np.minimum(np.searchsorted(own, docs), len(own) - 1)
                    scores = scores + np.where(own[at] == docs, impact[at] * unit[k + 1], 0)
        keep = scores >= max(floor, 1)
        return docs[keep], scores[keep]


def _search(queries: list[Query], weights: np.ndarray, documents_: int, length: int):
    units = [pairs_of(q, weights) for q in queries]
    pairs = {u for unit in units for u in unit}
    largest = np.iinfo(np.int64).max

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in queries]  # scores, ids; a NULL id is the largest

        def take(table: pa.Table) -> None:
            held, tf = table.column("held").combine_chunks(), table.column("tf").combine_chunks()
            sizes = np.asarray(held.value_lengths())
            doc, term = np.repeat(np.arange(len(sizes)), sizes), np.asarray(held.flatten()).astype(np.int64)
            impact = impacts(np.asarray(tf.flatten()), np.asarray(table.column("n"))[doc], weights[term], documents_, length)
            segment = Segment(len(sizes), term, doc, impact, len(weights), pairs)
            ids = np.asarray(table.column("doc_id").fill_null(largest))
            for k, unit in enumerate(units):
                scores, kept = best[k]
                docs, fresh = segment.search(unit, int(scores[-1]) if len(scores) == TOP else 0)
                if len(docs):
                    scores, kept = np.concatenate([scores, fresh]), np.concatenate([kept, ids[docs]])
                    order = np.lexsort((kept, -scores))[:TOP]
                    best[k] = scores[order], kept[order]

        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            waiting.append(batch)
            if sum(map(len, waiting)) >= SEGMENT:
                take(pa.Table.from_batches(waiting))
                waiting = []
        if sum(map(len, waiting)):
            take(pa.Table.from_batches(waiting))
        counts = [len(scores) for scores, _ in best]
        if sum(counts):
            ids = np.concatenate([kept for _, kept in best])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat([q.number for q in queries], counts), pa.int64()),
                 pa.array([i for q, n in zip(queries, counts) for i in [q.item] * n], pa.int64()),
                 pa.array(ids, pa.int64(), mask=ids == largest),
                 pa.array(np.concatenate([s for s, _ in best]), pa.int64())], names=["number", "item_id", "doc_id", "score"])
    return run


def _best(found: DataFrame) -> DataFrame:
    """Ranks by item; first within salts, so no item's rows meet in one task before they are few."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
    some = found.withColumn("_salt", salt) \
        .withColumn("rank", F.row_number().over(Window.partitionBy("number", "_salt").orderBy(*order))).where(F.col("rank") <= TOP)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("number").orderBy(*order))) \
        .where(F.col("rank") <= TOP).select("item_id", "rank", "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of each item's TOP best documents with a score above 0.

    ``items`` has item_id and text; every row is an item of its own, so rows that share an id, or are
    repeated, each get their ranks. Equal scores rank by doc_id, NULL ids last; repeated documents are
    ranked one after the other. A NULL or empty text holds no term: such an item gets no row, such a
    document is in no list and does not count. Texts of any length are read whole. Empty tables give
    no rows. Other columns, whatever their names, are not read.

    Items are searched for in blocks of BLOCK bytes of text (an item is in one block whatever its
    length); each block reads the documents once.
    """
    spark = docs.sparkSession
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("_text"))
    size = asked.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    blocks = int(size // BLOCK + 1)
    part = F.pmod(F.xxhash64("item_id", "_text"), F.lit(blocks))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("_text"))
    out = None
    for block in range(blocks):
        own = sorted(((r["item_id"], r["_text"]) for r in asked.where(part == block).collect()),
                     key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
        vocabulary, queries = read_items(own, block << 32)
        table = stored(map_arrow(rows, _postings(vocabulary), "doc_id long, n long, held array<int>, tf array<long>"), "ranking")
        total = table.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("length")).first()
        holders = np.zeros(len(vocabulary), np.int64)
        for row in table.select(F.explode("held").alias("term")).groupBy("term").count().collect():
            holders[row["term"]] = row["count"]
        weights = np.array([weight(total["documents"], int(h)) for h in holders], np.int64)
        found = map_arrow(table, _search(queries, weights, total["documents"], total["length"] or 1),
                          "number long, item_id long, doc_id long, score long")
        out = found if out is None else out.unionByName(found)
    return _best(out)


def op11_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best documents of every benchmark item."""
    return rank_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_FIND = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SQL = f"""
WITH found AS (SELECT row, doc_id, unnest({_FIND}) AS term
               FROM (SELECT row_number() OVER () AS row, doc_id, text FROM documents WHERE text IS NOT NULL)),
     counted AS (SELECT row, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM found GROUP BY row, term),
     sizes AS (SELECT row, CAST(sum(tf) AS BIGINT) AS size FROM counted GROUP BY row),
     corpus AS (SELECT count(*) AS docs, CAST(sum(size) AS BIGINT) AS length FROM sizes),
     holders AS (SELECT term, count(*) AS df FROM counted GROUP BY term),
     asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_FIND}) AS term FROM benchmark)
               GROUP BY item_id, term),
     scored AS (SELECT item_id, row, any_value(doc_id) AS doc_id,
                       CAST(sum(times * CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT)
                                * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * size * docs) // length)))) AS BIGINT) AS score
                FROM asked JOIN counted USING (term) JOIN holders USING (term) JOIN sizes USING (row) CROSS JOIN corpus
                GROUP BY item_id, row),
     ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank,
                       doc_id, score FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
