"""Substring dedup with suffix automata of reference shards.

Word windows that occur in an earlier document are found by streaming documents through suffix
automata of earlier text. One automaton of the whole corpus fits no task, and sending every shard to
every document is quadratic, so the reference is sharded by content: each window of ``SPAN`` words
elects the least of its short word grams as its anchor (equal windows elect equal anchors), and the
text of the windows around an anchor goes to that anchor's shard. Anchors of one row only are left
out by a bitmap of fixed size. A text that an earlier document of the same task or shard holds as a
whole is removed as a whole; the first copies of a shard's texts, by doc_id, are streamed through the
automaton of the texts of smaller doc_ids for their matching statistics, maximal spans of at least
``SPAN`` words are noted, and the text is added. A shard of very many different texts is split by
whole windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import documents, map_arrow, numbered, stored
from strata.llm.words import Chunk, Words, chunks, grams, mix, run_codes, whole, words

#: Words of a window, and of the grams among which it elects its anchor.
SPAN, GRAM = 13, 3
#: Grams with fewer bytes are elected only where there is no longer one.
LONG = 14
#: Different texts of one anchor above which its shard is split by window.
MANY = 2000
#: Bits of the map of shared anchors that goes to the tasks.
MAP_BITS = 27
#: Texts that a task remembers.
KNOWN = 1_000_000
_CHOICES = SPAN - GRAM + 1


class SuffixAutomaton:
    """All substrings of the word sequences added so far."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.last = 0
        self.texts = 0

    def _extend(self, word) -> None:
        nxt, link, length = self.next, self.link, self.length
        at, p = len(nxt), self.last
        nxt.append({})
        length.append(length[p] + 1)
        link.append(0)
        while p >= 0 and word not in nxt[p]:
            nxt[p][word] = at
            p = link[p]
        if p >= 0:
            q = nxt[p][word]
            if length[q] == length[p] + 1:
                link[at] = q
            else:
                copy = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(word) == q:
                    nxt[p][word] = copy
                    p = link[p]
                link[q] = link[at] = copy
        self.last = at

    def add(self, sequence: list[bytes]) -> None:
        for word in sequence:
            self._extend(word)
        self.texts += 1
        self._extend(self.texts)  # a mark that no text holds

    def spans(self, sequence: list[bytes], least: int) -> list[tuple[int, int]]:
        """Maximal spans (start, end) covered by matches of at least ``least`` words."""
        nxt, link, length = self.next, self.link, self.length
        out: list[tuple[int, int]] = []
        state = n = 0
        for i, word in enumerate(sequence):
            while state and word not in nxt[state]:
                state = link[state]
                n = length[state]
            if word in nxt[state]:
                state = nxt[state][word]
                n += 1
            if n >= least:
                if out and i + 1 - n <= out[-1][1]:
                    out[-1] = (min(out[-1][0], i + 1 - n), i + 1)
                else:
                    out.append((i + 1 - n, i + 1))
        return out


def _elect(chunk: Chunk, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The key of each gram, the least key of each window, and the windows that lie in one document."""
    codes = grams(w.codes, GRAM) >> np.uint64(1)
    if len(codes) < _CHOICES:
        return codes, codes[:0], np.empty(0, np.int64)
    short = (w.ends[GRAM - 1:] - w.starts[:len(codes)]) < LONG
    keys = codes | (short.astype(np.uint64) << np.uint64(63))
    least = keys
    width = 1
    while width * 2 <= _CHOICES:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = _CHOICES - width
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    return keys, least, np.flatnonzero(whole(w.bounds, SPAN))


def _elected(keys: np.ndarray, least: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Elected grams, and the first and last window that elected each (they form one run)."""
    low, high = np.full(len(keys), len(keys)), np.full(len(keys), -1)
    for j in range(_CHOICES if len(windows) else 0):
        hit = windows[keys[windows + j] == least[windows]]
        low[hit + j] = np.minimum(low[hit + j], hit)
        high[hit + j] = np.maximum(high[hit + j], hit)
    at = np.flatnonzero(high >= 0)
    return at, low[at], high[at]


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, _row): the anchors of each row."""
    for batch in batches:
        row = batch.column("_row").to_numpy()
        for chunk in chunks(batch.column("_text")):
            w = words(chunk)
            keys, least, windows = _elect(chunk, w)
            at, _, _ = _elected(keys, least, windows)
            doc = np.searchsorted(w.bounds, at, "right") - 1
            yield pa.RecordBatch.from_arrays([pa.array(keys[at].view(np.int64)), pa.array(row[chunk.first + doc])],
                                             names=["anchor", "_row"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (anchor, _row): the anchors of two rows or more (now and then one twice)."""
    last = None
    for batch in batches:
        anchor, row = batch.column("anchor").to_numpy(), batch.column("_row").to_numpy()
        if not len(anchor):
            continue
        if last is not None:
            anchor, row = np.concatenate([[last[0]], anchor]), np.concatenate([[last[1]], row])
        last = anchor[-1], row[-1]
        found = anchor[1:][(anchor[1:] == anchor[:-1]) & (row[1:] != row[:-1])]
        found = found[np.concatenate([[True], found[1:] != found[:-1]])] if len(found) else found
        yield pa.RecordBatch.from_arrays([pa.array(found)], names=["anchor"])


def _anchor_map(anchors: DataFrame) -> np.ndarray:
    """A bit map of the anchors modulo 2**MAP_BITS: 16 MB, however many anchors there are."""
    slot = F.col("anchor").bitwiseAND(F.lit((1 << MAP_BITS) - 1).cast("long"))
    bits = anchors.select(F.shiftrightunsigned(slot, 6).alias("_word"), F.call_function(
        "shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63).cast("long")).cast("int")).alias("_bit")) \
        .groupBy("_word").agg(F.bit_or("_bit").alias("_bits")).toArrow()
    out = np.zeros(1 << (MAP_BITS - 6), np.uint64)
    out[bits.column("_word").to_numpy()] = bits.column("_bits").to_numpy().view(np.uint64)
    return out


TEXTS = "shard long, code long, _id long, _row long, first int, last int, words binary"


def _texts(shared: np.ndarray):
    """Rows of TEXTS: the text of the windows that elected a shared anchor. A text that this task has
    met in a smaller _id is no longer needed: its span is passed on as found (NULL code), joined with
    its neighbours. Of other texts the first of a task carries the words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, int] = {}
        for batch in batches:
            row, ident = batch.column("_row").to_numpy(), batch.column("_id").to_numpy()
            for chunk in chunks(batch.column("_text")):
                w = words(chunk)
                keys, least, windows = _elect(chunk, w)
                at, low, high = _elected(keys, least, windows)
                slot = (keys[at] & np.uint64((1 << MAP_BITS) - 1)).astype(np.int64)
                keep = (shared[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) == 1
                at, low, high = at[keep], low[keep], high[keep]
                if not len(at):
                    continue
                stop = high + SPAN
                code = run_codes(w.codes, low, stop) ^ (stop - low).astype(np.uint64)
                doc = np.searchsorted(w.bounds, at, "right") - 1
                ids = ident[chunk.first + doc]
                new, bare, done = [], [], []
                for k, (x, d) in enumerate(zip((mix(code) ^ keys[at]).tolist(), ids.tolist())):
                    m = known.get(x)
                    if m is None:
                        known[x] = d
                        new.append(k)
                    elif d > m:
                        done.append(k)
                    else:
                        known[x] = d
                        bare.append(k)
                if len(known) > KNOWN:
                    known.clear()
                raw = chunk.data.tobytes()
                first = low - w.bounds[doc]
                texts = [raw[a:b] for a, b in zip(w.starts[low[new]].tolist(), w.ends[stop[new] - 1].tolist())]
                some = np.array(new + bare, np.int64)
                out = [keys[at[some]].view(np.int64), code[some].view(np.int64), ids[some], row[chunk.first + doc[some]],
                       first[some], (first + stop - low)[some]]
                done = np.array(done, np.int64)
                if len(done):
                    # spans of one document that touch become one
                    cut = np.flatnonzero(np.concatenate([[True], (doc[done[1:]] != doc[done[:-1]])
                                                         | (low[done[1:]] > stop[done[:-1]])]))
                    end = np.concatenate([cut[1:], [len(done)]]) - 1
                    rows = row[chunk.first + doc[done[cut]]]
                    found = [mix(rows.astype(np.uint64)).view(np.int64), None, ids[done[cut]], rows, first[done[cut]],
                             (first + stop - low)[done[end]]]
                    yield _text_batch(found, [None] * len(cut))
                yield _text_batch(out, texts + [None] * len(bare))
    return run


def _text_batch(columns: list, texts: list) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
    arrays = [pa.nulls(len(texts), t) if c is None else pa.array(c, t) for c, t in zip(columns, kinds)]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(texts, pa.binary())],
                                      names=["shard", "code", "_id", "_row", "first", "last", "words"])


FOUND = "_row long, first int, last int, shard long, window long, _id long"


def _match(many: int):
    """Rows of TEXTS come sorted by (shard, code, _id): rows of FOUND. Spans have no shard; a row with one
    is a window of a shard with too many texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = code = None
        texts: list[tuple[int, list[bytes], list]] = []  # smallest _id, words, its (row, first)
        least, sequence, owners, crowded = 0, None, [], False
        out: list[tuple] = []

        def split(least, sequence, owners):
            for i in range(len(sequence) - SPAN + 1):
                window = int.from_bytes(hashlib.blake2b(b" ".join(sequence[i:i + SPAN]), digest_size=8).digest(),
                                        "little", signed=True)
                out.extend((r, f + i, f + i + SPAN, shard, window, least) for r, f in owners)

        def end_text():
            nonlocal crowded
            if sequence is None:
                return
            texts.append((least, sequence, owners))
            if crowded or len(texts) > many:
                crowded = True
                for t in texts:
                    split(*t)
                texts.clear()

        def end_shard():
            if len(texts) > 1:
                texts.sort(key=lambda t: t[0])
                automaton, waiting = SuffixAutomaton(), []
                for k, (d, words_, rows) in enumerate(texts):
                    if k and d != texts[k - 1][0]:
                        for t in waiting:
                            automaton.add(t)
                        waiting = []
                    if automaton.texts:
                        spans = automaton.spans(words_, SPAN)
                        out.extend((r, f + a, f + b, None, None, None) for r, f in rows for a, b in spans)
                    waiting.append(words_)
            texts.clear()

        for batch in batches:
            for s, c, d, r, a, b, raw in zip(*(batch.column(n).to_pylist() for n in batch.schema.names)):
                if c is None:
                    out.append((r, a, b, None, None, None))
                    continue
                if s != shard or c != code:
                    end_text()
                    if s != shard:
                        end_shard()
                        shard, crowded = s, False
                    code, least, sequence, owners = c, d, None, []
                if raw is not None and sequence is None:
                    sequence = raw.split()
                if d == least:
                    owners.append((r, a))
                else:
                    out.append((r, a, b, None, None, None))
            yield _found(out)
            out.clear()
        end_text()
        end_shard()
        yield _found(out)
    return run


def _found(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
    columns = list(zip(*rows)) if rows else [()] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                      names=["_row", "first", "last", "shard", "window", "_id"])


def _removed(count: int, spans: list | None) -> np.ndarray:
    edge = np.zeros(count + 1, np.int32)
    for x in spans or ():
        edge[x["first"]] += 1
        edge[x["last"]] -= 1
    return np.cumsum(edge[:-1]) > 0


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words, n_removed, kept = [], [], []
        for text, spans in zip(batch.column("_text").to_pylist(), batch.column("_spans").to_pylist()):
            found = (text or "").encode().split()  # bytes split at ASCII white space only
            n_words.append(len(found))
            if spans:
                gone = _removed(len(found), spans)
                found = [x for x, g in zip(found, gone.tolist()) if not g]
            n_removed.append(n_words[-1] - len(found))
            kept.append(b" ".join(found))
        yield pa.RecordBatch.from_arrays(
            [batch.column("_row"), batch.column("_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
             pa.array([hashlib.sha256(x).hexdigest() for x in kept])],
            names=["_row", "doc_id", "n_words", "n_removed", "kept_sha256"])


KEPT = "_row long, doc_id long, n_words long, n_removed long, kept_sha256 string"


def _placed(held: np.ndarray, hit: bool):
    """Rows whose place is in the bit map (all with spans, and a few others), or those that are not."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = batch.column("_place").to_numpy().view(np.uint64) & np.uint64((1 << MAP_BITS) - 1)
            there = (held[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1)
            yield batch.filter(pa.array((there == 1) == hit)).drop_columns(["_place"])
    return run


def _alone(held: np.ndarray):
    """Rows without spans: their texts stay where they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = (b.append_column("_spans", pa.nulls(len(b), pa.null())) for b in _placed(held, False)(batches))
        yield from _keep(nothing)
    return run


def repeated_spans(rows: DataFrame, many: int = MANY) -> DataFrame:
    """(_row, first, last) for numbered rows: spans of words covered by windows of an earlier document."""
    rows = rows.where("_id is not null")
    anchors = map_arrow(rows.select("_row", "_text"), _anchors, "anchor long, _row long")
    shared = map_arrow(anchors.repartition("anchor").sortWithinPartitions("anchor", "_row"), _shared, "anchor long")
    texts = map_arrow(rows, _texts(_anchor_map(shared)), TEXTS)
    found = stored(map_arrow(texts.repartition("shard").sortWithinPartitions("shard", "code", "_id"), _match(many), FOUND),
                   "substring-found")
    windows = found.where("shard is not null")
    least = windows.groupBy("shard", "window").agg(F.min("_id").alias("_least"))
    split = windows.join(least, ["shard", "window"]).where("_id > _least")
    return found.where("shard is null").select("_row", "first", "last").unionByName(split.select("_row", "first", "last"))


def remove_repeats(docs: DataFrame, many: int = MANY) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256.

    A word goes if a window of SPAN words that covers it also starts in a document with a smaller
    doc_id. A NULL text has no words (its digest is that of the empty string); a row with a NULL
    doc_id is neither a source nor changed; rows of one doc_id are not compared with each other, so
    repeated rows share their fate; texts of any length are read whole; an empty table gives no rows;
    other columns, whatever their names, are not read.
    """
    rows = numbered(docs, "substring-rows")
    runs = repeated_spans(rows, many)
    held = _anchor_map(runs.select(F.xxhash64("_row").alias("anchor")))
    placed = rows.withColumn("_place", F.xxhash64("_row"))
    spans = runs.groupBy("_row").agg(F.collect_list(F.struct("first", "last")).alias("_spans"))
    some = map_arrow(placed, _placed(held, True), rows.schema).join(spans, "_row", "left")
    return map_arrow(placed, _alone(held), KEPT).unionByName(map_arrow(some, _keep, KEPT)).drop("_row")


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated windows removed from all documents."""
    return remove_repeats(documents(spark, sf_dir))
