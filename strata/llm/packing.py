"""Packing token sequences by cutting-stock column generation.

Documents are tokenised whole; every full stretch of ``length`` tokens is a sequence of its own,
and the rests are the items of a cutting-stock problem. Rests are counted by length class (a
histogram of bounded size). A linear program over patterns (how many rests of each class share a
sequence) starts from one-class patterns; a knapsack by dynamic programming over the dual prices
finds the pattern that enters next. The rounded-down pattern counts are laid out as slots per
class, the few rests left over go by best-fit-decreasing, and the document of rank k in its class
takes slot k.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.llm.common import documents, map_arrow, prefix_sum, stored
from strata.llm.sharding import best_fit_decreasing
from strata.llm.words import LOWER, Chunk, chunks, mix, span_codes, words

#: Tokens of a sequence; tokens that a length class spans; the id that ends a document.
LENGTH = 2048
STEP = 16
END_ID = 1
#: Share of sequences within which the linear program's optimum must be known.
SLACK = 0.0002
#: Words whose ids a worker keeps, and that are tokenised at once.
KNOWN, SOME = 1_500_000, 20_000


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordIds:
    """Token ids by word. The tokenizer never joins text across white space, so a document's ids
    are its words' ids in order; a word is tokenised when first met."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel work
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.forget()

    def forget(self) -> None:
        self.codes = np.empty(0, np.uint64)
        self.places = np.empty(0, np.int64)  # first id << 24 | number of ids
        self.flat, self.used = np.empty(1 << 16, np.uint32), 0

    def learn(self, codes: np.ndarray, texts: list[str]) -> None:
        """``codes`` must rise."""
        ids = [x.ids for k in range(0, len(texts), SOME)
               for x in self.tokenizer.encode_batch_fast(texts[k:k + SOME], add_special_tokens=False)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        new = np.fromiter((i for x in ids for i in x), np.uint32, int(sizes.sum()))
        while self.used + len(new) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty(len(self.flat), np.uint32)])
        self.flat[self.used:self.used + len(new)] = new
        places = (self.used + np.cumsum(sizes) - sizes << 24) + sizes
        self.used += len(new)
        at = np.searchsorted(self.codes, codes)
        self.codes = np.insert(self.codes, at, codes)
        self.places = np.insert(self.places, at, places)

    def ids(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a chunk, and the number of ids before each document (one more entry than documents)."""
        w = words(chunk, codes=False)
        starts, ends = split_marks(chunk.data, w.starts, w.ends)
        bounds = np.searchsorted(starts, chunk.offsets)
        if not len(starts):
            return np.empty(0, np.uint32), np.zeros(len(bounds), np.int64)
        each_code = lower_codes(chunk.data, starts, ends)
        codes, first, each = np.unique(each_code, return_index=True, return_inverse=True)
        at = np.searchsorted(self.codes, codes)
        new = np.ones(len(codes), bool)
        old = at < len(self.codes)
        new[old] = self.codes[at[old]] != codes[old]
        if new.any():
            if len(self.codes) + new.sum() > KNOWN:
                self.forget()
                new[:] = True
            raw = chunk.data.tobytes()
            where = first[new]
            self.learn(codes[new], [raw[s:e].decode() for s, e in zip(starts[where].tolist(), ends[where].tolist())])
            at = np.searchsorted(self.codes, codes)
        place = self.places[at][each]
        sizes = place & 0xFFFFFF
        before = np.concatenate([[0], np.cumsum(sizes)])
        flat = self.flat[np.repeat((place >> 24) - before[:-1], sizes) + np.arange(before[-1])]
        return flat, before[bounds]


def split_marks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cuts a last ``.`` or ``,`` off words in which a letter comes before it: the tokenizer cuts there
    too, and fewer different words are left. Letters here: ASCII ones and U+00C0 to U+017F, but for
    U+0130, which the tokenizer turns into a letter and a mark."""
    last, before = data[ends - 1], data[np.maximum(ends - 2, 0)]
    lead = data[np.maximum(ends - 3, 0)]
    long_enough = ends - starts
    letter = ((before | 32) >= 97) & ((before | 32) <= 122) & (before < 128) & (long_enough > 1)
    letter |= (lead >= 0xC3) & (lead <= 0xC5) & (long_enough > 2) & (before >= 128) & (before < 192) \
        & ~((lead == 0xC3) & ((before == 0x97) | (before == 0xB7))) & ~((lead == 0xC4) & (before == 0xB0))
    cut = ends[letter & ((last == 44) | (last == 46))] - 1
    all_starts, all_ends = np.concatenate([starts, cut]), np.concatenate([ends, cut])
    return np.sort(all_starts), np.sort(all_ends)


def lower_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Codes of words whatever the case of ASCII letters, for which the tokenizer does not care; words
    with a bar may hold a special token and keep their case."""
    codes = span_codes(LOWER[data], starts, ends)
    bars = np.concatenate([[0], np.cumsum(data == 124)])
    barred = bars[ends] > bars[starts]
    if barred.any():
        codes[barred] = mix(span_codes(data, starts[barred], ends[barred]) + np.uint64(1))
    return codes


_workers: dict[str, WordIds] = {}


def document_ids(column: pa.Array, path: str) -> Iterator[np.ndarray]:
    """The ids of each text (little-endian unsigned 32-bit), with the end id."""
    known = _workers.setdefault(path, None) or WordIds(path)
    _workers[path] = known
    end = np.array([END_ID], "<u4")
    for chunk in chunks(column):
        flat, before = known.ids(chunk)
        for d in range(len(before) - 1):
            yield np.concatenate([flat[before[d]:before[d + 1]], end]).astype("<u4", copy=False)


def _measure(path: str, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, crcs = [], []
            for ids in document_ids(batch.column("text"), path):
                raw = memoryview(ids.tobytes())
                sizes.append(len(ids))
                crcs.append([zlib.crc32(raw[i:i + 4 * length]) for i in range(0, len(raw), 4 * length)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), batch.column("doc_id"), pa.array(sizes, pa.int64()),
                 pa.array(crcs, pa.list_(pa.int64()))], names=["_row", "doc_id", "doc_tokens", "_crcs"])
    return run


def best_pattern(price: np.ndarray, widths: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The knapsack of most value: how many items of each class (widths rise) fit the capacity."""
    best, took = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(widths, np.arange(capacity + 1), "right")
    for c in range(1, capacity + 1):
        best[c], took[c] = best[c - 1], -1
        if fits[c]:
            values = best[c - widths[:fits[c]]] + price[:fits[c]]
            k = int(values.argmax())
            if values[k] > best[c] + 1e-12:
                best[c], took[c] = values[k], k
    pattern, c = np.zeros(len(widths), np.int64), capacity
    while c > 0:
        if took[c] < 0:
            c -= 1
        else:
            pattern[took[c]] += 1
            c -= int(widths[took[c]])
    return float(best[capacity]), pattern


def solve_patterns(widths: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 5000
                   ) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (one a column) and how often each is used in the linear program's optimum.

    Revised simplex: the basis starts with one-class patterns, the knapsack finds the entering
    column, the ratio test the leaving one. Ends when the dual bound is near: no solution can save
    half a sequence, or the share SLACK of them.
    """
    m = len(widths)
    basis = np.diag((capacity // widths).astype(float))
    inverse = np.diag(1 / (capacity // widths))
    x = inverse.diagonal() * demand
    for _ in range(rounds):
        value, pattern = best_pattern(inverse.sum(axis=0), widths, capacity)
        if x.sum() * (1 - 1 / value) < max(0.5, SLACK * x.sum()):  # the optimum is at least x.sum() / value
            break
        step = (inverse * pattern).sum(axis=1)
        ratio = np.full(m, np.inf)
        up = step > 1e-9
        ratio[up] = x[up] / step[up]
        out = int(ratio.argmin())
        basis[:, out] = pattern
        row = inverse[out] / step[out]
        inverse = inverse - np.outer(step, row)
        inverse[out] = row
        x = np.maximum((inverse * demand).sum(axis=1), 0)
    return basis.astype(np.int64), x


class Layout:
    """Slots of the rests: for each class the ranks at which a pattern's slots begin, the slots a
    sequence, and the pattern's first sequence."""

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        widths = np.array(sorted(counts), np.int64)
        demand = np.array([counts[w] for w in widths.tolist()], np.int64)
        patterns: list[tuple[np.ndarray, int]] = []
        if len(widths):
            basis, x = solve_patterns(widths, demand.astype(float), capacity)
            uses = np.floor(x + 1e-7).astype(np.int64)
            while (over := (basis * uses).sum(axis=1) > demand).any():  # rounding noise
                uses[(basis[over].sum(axis=0) > 0) & (uses > 0)] -= 1
            patterns = [(basis[:, j], int(uses[j])) for j in range(len(widths)) if uses[j]]
            left = demand - (basis * uses).sum(axis=1)
            items = np.repeat(widths[::-1], left[::-1])
            bins = best_fit_decreasing(items.tolist(), capacity)
            for b in range(max(bins, default=-1) + 1):
                inside = items[np.array(bins) == b]
                patterns.append((np.array([(inside == w).sum() for w in widths]), 1))
        self.sequences = sum(n for _, n in patterns)
        self.slots = {}
        for i, w in enumerate(widths.tolist()):
            start, first, rows = 0, 0, []
            for pattern, n in patterns:
                if pattern[i]:
                    rows.append((start, int(pattern[i]), first))
                    start += n * int(pattern[i])
                first += n
            self.slots[w] = np.array(rows, np.int64)

    def sequence(self, width: np.ndarray, rank: np.ndarray) -> np.ndarray:
        out = np.empty(len(rank), np.int64)
        for w in np.unique(width).tolist():
            mine, rows = width == w, self.slots[w]
            row = rows[np.searchsorted(rows[:, 0], rank[mine], "right") - 1]
            out[mine] = row[:, 2] + (rank[mine] - row[:, 0]) // row[:, 1]
        return out


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH, step: int = STEP) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Only documents longer than a sequence are cut. A NULL or empty text is the end id alone;
    repeated rows and NULL doc_ids are packed like any other row; an empty table gives no rows;
    other columns are not read. ``sequence_id`` numbers sequences from 0, first those of the rests.
    """
    path = path or tokenizer_path()
    rows = docs.select(F.monotonically_increasing_id().alias("_row"),
                       F.col("doc_id").cast("long").alias("doc_id"), "text")
    sized = stored(map_arrow(rows, _measure(path, length), "_row long, doc_id long, doc_tokens long, "
                                                           "_crcs array<long>", give_back=True), "pack-sizes")
    sized = sized.withColumn("_rest", F.col("doc_tokens") % length) \
        .withColumn("_full", F.floor(F.col("doc_tokens") / length)) \
        .withColumn("_class", F.ceil(F.col("_rest") / step).cast("int"))
    rests = sized.where("_rest > 0")
    # at most length / step rows
    counts = {r["_class"]: r["count"] for r in rests.groupBy("_class").count().collect()}
    layout = Layout(counts, length // step)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = layout.sequence(b.column("_class").to_numpy(), b.column("_rank").to_numpy())
            yield b.drop_columns(["_class", "_rank"]).append_column("sequence_id", pa.array(at))

    rests = prefix_sum(rests, ["_class"], ["doc_id", "_row"], F.lit(1), "_rank").select(
        "doc_id", "_row", (F.col("_full") * length).alias("start"), F.col("_rest").alias("length"),
        F.element_at("_crcs", -1).alias("ids_crc32"), "doc_tokens", "_class", "_rank")
    ahead = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "_row") \
        .rowsBetween(Window.unboundedPreceding, -1)
    rests = (map_arrow(rests, place, "doc_id long, _row long, start long, length long, ids_crc32 long, "
                                      "doc_tokens long, sequence_id long", give_back=True)
             .withColumn("offset", F.coalesce(F.sum("length").over(ahead), F.lit(0))).drop("_row"))
    full = prefix_sum(sized.where("_full > 0"), [], ["doc_id", "_row"], "_full", "_first") \
        .select("doc_id", "doc_tokens", "_first", "_crcs", F.posexplode(F.slice("_crcs", F.lit(1), F.col("_full").cast("int")))
                .alias("_piece", "ids_crc32")) \
        .select("doc_id", (F.col("_piece") * F.lit(length).cast("long")).alias("start"),
                F.lit(length).cast("long").alias("length"), "ids_crc32", "doc_tokens",
                (F.lit(layout.sequences) + F.col("_first") + F.col("_piece")).alias("sequence_id"),
                F.lit(0).cast("long").alias("offset"))
    return rests.unionByName(full)


def sequences(docs: DataFrame, pieces: DataFrame, path: str | None = None) -> DataFrame:
    """The packed sequences themselves (sequence_id, ids): documents are tokenised again and their
    pieces laid out by offset. ``doc_id`` must be unique."""
    path = path or tokenizer_path()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = pa.array([x.tolist() for x in document_ids(batch.column("text"), path)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], names=["doc_id", "_ids"])

    ids = map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), encode,
                    "doc_id long, _ids array<long>", give_back=True)
    cut = F.slice("_ids", (F.col("start") + 1).cast("int"), F.col("length").cast("int"))
    return (pieces.join(ids, "doc_id").select("sequence_id", "offset", cut.alias("_ids"))
            .groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "_ids"))).alias("_pieces"))
            .select("sequence_id", F.flatten(F.col("_pieces._ids")).alias("ids")))


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return pack(documents(spark, sf_dir))
