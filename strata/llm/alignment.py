"""Alignment of two tokenizers' ids by lockstep merging of their token boundaries.

Every document is tokenised by A (byte-level) and by B (pieces with byte fallback). One state vector
holds an A and a B pointer for each lane; in each step every lane moves the pointer whose token ends
first (both if they end together, which cuts a group and emits the group's links), and finished lanes
are compacted away. A lane is a document, or a run of a long document's cells: both tokenizers start
afresh at a space after an ordinary character, so both end there whatever else they do.

Corpus-wide counts come in two passes that move no text. Documents of one batch form a chunk, which is
stored with the chunk's distinct id pairs; pairs are counted and compared by a shuffle of one row for
each chunk and pair; each chunk gets its pairs' counts back and adds them up for its documents.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import documents, map_arrow, stored
from strata.llm.packing import tokenizer_path
from strata.llm.words import Chunk, chunks, span_codes

#: Bytes of text aligned at once, and of a chunk (a longer document is one alone); cells of a lane; cells
#: that a worker keeps, and that are tokenised at once.
PIECE_BYTES, CHUNK_BYTES = 1 << 20, 4 << 20
LANE = 48
KNOWN, SOME = 300_000, 20_000
#: A group of more links than this is counted by distinct ids instead of link by link.
WIDE = 4096
MARK = "▁"

#: Bits of an id in a pair's key: 20 hold a vocabulary of a million.
ID_BITS = 20
PAIR = (1 << 2 * ID_BITS) - 1

SCHEMA = ("chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
          "held array<int>, times array<int>, pairs array<long>, docs array<int>")
NAMES = [part.split()[0] for part in SCHEMA.split(", ")]


def cells(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(data, starts, bounds): each document with a space before it, cut before a space that follows a
    printable ASCII character or a character U+00C0 to U+00FF; ``bounds``: the cells before each document.

    No pattern of A's splitter goes on over such a space, and no piece of B holds a mark inside.
    """
    docs = chunk.last - chunk.first
    lead = chunk.offsets[:-1] + np.arange(docs)
    data = np.empty(len(chunk.data) + docs, np.uint8)
    data[np.arange(len(chunk.data)) + np.repeat(np.arange(1, docs + 1), np.diff(chunk.offsets))] = chunk.data
    data[lead] = 32
    before, early = np.roll(data, 1), np.roll(data, 2)
    plain = ((before > 32) & (before < 127)) | ((before >= 128) & (early == 0xC3))
    cut = (data == 32) & plain
    cut[lead] = True
    starts = np.flatnonzero(cut)
    return data, starts, np.append(np.searchsorted(starts, lead), len(starts))


@dataclass
class Stream:
    """Tokens of one side: ids and byte lengths by token; ``bounds``: the tokens before each cell."""

    ids: np.ndarray
    sizes: np.ndarray
    bounds: np.ndarray


class Side:
    """Ids of cells, kept once met, and the bytes of each id (``first``: where they begin in ``bytes``)."""

    def __init__(self, pieces: list[bytes]) -> None:
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)
        #: Decimal ids with what follows them: "," in a list, "|" or ";" at its end.
        self.names = np.array([f"{k}{end}" for k in range(len(pieces)) for end in (",", "|", ";")], object)
        self.forget()

    def forget(self) -> None:
        self.codes = np.empty(0, np.uint64)
        self.places, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)
        self.flat, self.used = np.empty(1 << 16, np.int32), 0

    def encode(self, texts: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def learn(self, codes: np.ndarray, texts: list[str]) -> None:
        """``codes`` must rise."""
        parts = []
        for k in range(0, len(texts), SOME):
            ids = self.encode(texts[k:k + SOME])
            parts.append((np.fromiter(map(len, ids), np.int64, len(ids)), np.fromiter((i for x in ids for i in x), np.int32)))
        sizes, new = (np.concatenate(x) for x in zip(*parts))
        while self.used + len(new) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty(len(self.flat), np.int32)])
        self.flat[self.used:self.used + len(new)] = new
        places = self.used + np.cumsum(sizes) - sizes
        self.used += len(new)
        at = np.searchsorted(self.codes, codes)
        self.codes, self.places, self.counts = (np.insert(*x) for x in (
            (self.codes, at, codes), (self.places, at, places), (self.counts, at, sizes)))

    def stream(self, raw: bytes, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray, first: np.ndarray,
               each: np.ndarray) -> Stream:
        """Tokens of the cells; ``codes`` are the distinct ones, ``first`` where each stands, ``each`` the cells'."""
        at = np.searchsorted(self.codes, codes)
        new = np.ones(len(codes), bool)
        old = at < len(self.codes)
        new[old] = self.codes[at[old]] != codes[old]
        if new.any():
            if len(self.codes) + new.sum() > KNOWN:
                self.forget()
                new[:] = True
            where = first[new]
            self.learn(codes[new], [raw[s:e].decode() for s, e in zip(starts[where].tolist(), ends[where].tolist())])
            at = np.searchsorted(self.codes, codes)
        place, count = self.places[at][each], self.counts[at][each]
        bounds = np.concatenate([[0], np.cumsum(count)])
        ids = self.flat[np.repeat(place - bounds[:-1], count) + np.arange(bounds[-1])]
        return Stream(ids, self.sizes[ids], bounds)

    def text(self, stream: Stream) -> np.ndarray:
        """The joined bytes of the tokens."""
        before = np.cumsum(stream.sizes) - stream.sizes
        total = int(stream.sizes.sum())
        return self.bytes[np.repeat(self.first[stream.ids] - before, stream.sizes) + np.arange(total)]


class ByteSide(Side):
    """A: byte-level ids from a tokenizer file."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel work
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # The public byte alphabet: printable bytes stand for themselves, the others follow from U+0100 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
        names = [self.tokenizer.id_to_token(k) or "" for k in range(self.tokenizer.get_vocab_size())]
        super().__init__([bytes(byte[c] for c in n) if all(c in byte for c in n) else n.encode() for n in names])

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class PieceSide(Side):
    """B: pieces with byte fallback; the model puts a space before each text itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        super().__init__([bytes([int(n[1:-1], 16)]) if self.model.is_byte(k) else n.replace(MARK, " ").encode()
                          for k, n in enumerate(names)])
        if any(MARK in n.lstrip(MARK) for n in names if n != MARK * len(n)):
            raise ValueError("a piece holds a space inside: texts cannot be cut at spaces for this model")
        self.space = self.model.piece_to_id(MARK)

    def encode(self, texts: list[str]) -> list[list[int]]:
        # a cell begins with the space that the model adds by itself; it adds none to an empty text
        out = self.model.encode([t[1:] for t in texts], num_threads=1)
        return [x if len(t) > 1 else [self.space] for t, x in zip(texts, out)]


def lockstep(a: Stream, b: Stream, first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
    """Groups of the lanes (first cell, one past the last): (first A token, one past its last, first B
    token, one past its last) of each, by A.

    All lanes advance at once: ``i``/``j`` are the A and B tokens they stand on, ``ea``/``eb`` the bytes to
    the ends of those. A lane in which both end cuts a group; a lane without tokens left is dropped.
    """
    i, j = a.bounds[first], b.bounds[first]
    stop_a, stop_b = a.bounds[stop], b.bounds[stop]
    live = (i < stop_a) & (j < stop_b)
    i, j, stop_a, stop_b = i[live], j[live], stop_a[live], stop_b[live]
    from_a, from_b = i.copy(), j.copy()
    ea, eb = a.sizes[i], b.sizes[j]
    cuts: list[tuple[np.ndarray, ...]] = []
    while len(i):
        both, move_a = ea == eb, ea <= eb
        move_b = eb <= ea
        at = np.flatnonzero(both)
        if len(at):
            cuts.append((from_a[at], i[at] + 1, from_b[at], j[at] + 1))
            from_a[at], from_b[at] = i[at] + 1, j[at] + 1
        i += move_a
        j += move_b
        done = (i >= stop_a) | (j >= stop_b)
        if done.any():
            keep = ~done
            i, j, stop_a, stop_b, from_a, from_b, ea, eb, move_a, move_b = (
                x[keep] for x in (i, j, stop_a, stop_b, from_a, from_b, ea, eb, move_a, move_b))
        ea = ea + np.where(move_a, a.sizes[i], 0)
        eb = eb + np.where(move_b, b.sizes[j], 0)
    if not cuts:
        return (np.empty(0, np.int64),) * 4
    out = [np.concatenate(x) for x in zip(*cuts)]
    order = np.argsort(out[0], kind="stable")
    return tuple(x[order] for x in out)


def links(a: Stream, b: Stream, groups: tuple[np.ndarray, ...], doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, A id, B id in one key, number of links) of all groups' links; keys may repeat."""
    a0, a1, b0, b1 = groups
    na, nb = a1 - a0, b1 - b0
    wide = na * nb > WIDE
    small = np.flatnonzero(~wide)
    size = (na * nb)[small]
    nth = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    g = np.repeat(small, size)
    left, right = a.ids[a0[g] + nth // nb[g]].astype(np.int64), b.ids[b0[g] + nth % nb[g]]
    keys, times = [doc[g] << 2 * ID_BITS | left << ID_BITS | right], [np.ones(len(g), np.int64)]
    for g in np.flatnonzero(wide).tolist():  # few: long runs in which the tokenizers do not meet
        u, m = np.unique(a.ids[a0[g]:a1[g]], return_counts=True)
        v, n = np.unique(b.ids[b0[g]:b1[g]], return_counts=True)
        keys.append((doc[g] << 2 * ID_BITS | u.astype(np.int64)[:, None] << ID_BITS | v[None, :]).ravel())
        times.append((m[:, None] * n[None, :]).ravel())
    return np.concatenate(keys), np.concatenate(times)


def digests(side_a: Side, side_b: Side, a: Stream, b: Stream, groups: tuple[np.ndarray, ...], bounds: np.ndarray
            ) -> list[str]:
    """sha256 of each document's groups as text; ``bounds``: the groups before each document."""
    a0, a1, b0, b1 = groups
    na, nb = a1 - a0, b1 - b0
    # a document's groups follow one another: tokens in order of group, A before B
    first = np.cumsum(na + nb) - na - nb
    out = np.empty(int((na + nb).sum()), object)
    ends = np.zeros(int(na.sum()), np.int64)
    ends[np.cumsum(na) - 1] = 1
    take = np.repeat(a0 - (np.cumsum(na) - na), na) + np.arange(int(na.sum()))
    out[np.repeat(first - (np.cumsum(na) - na), na) + np.arange(int(na.sum()))] = \
        side_a.names[a.ids[take].astype(np.int64) * 3 + ends]
    ends = np.zeros(int(nb.sum()), np.int64)
    ends[np.cumsum(nb) - 1] = 2
    take = np.repeat(b0 - (np.cumsum(nb) - nb), nb) + np.arange(int(nb.sum()))
    out[np.repeat(first + na - (np.cumsum(nb) - nb), nb) + np.arange(int(nb.sum()))] = \
        side_b.names[b.ids[take].astype(np.int64) * 3 + ends]
    where = np.append(first, len(out))[bounds].tolist()
    return [hashlib.sha256("".join(out[s:e])[:-1].encode()).hexdigest() if e > s else "" for s, e in zip(where[:-1], where[1:])]


@dataclass
class Aligned:
    """Documents of a chunk: counts by document, digests, and (document, pair) keys with numbers of links."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digests: list[str]
    keys: np.ndarray
    times: np.ndarray


def _per(bounds: np.ndarray, values: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(values)])[bounds])


def align(chunk: Chunk, side_a: Side, side_b: Side) -> Aligned:
    """Align all documents of a chunk."""
    docs = chunk.last - chunk.first
    data, starts, bounds = cells(chunk)
    ends = np.append(starts[1:], len(data))
    codes, first, each = np.unique(span_codes(data, starts, ends), return_index=True, return_inverse=True)
    raw = data.tobytes()
    a = side_a.stream(raw, starts, ends, codes, first, each)
    b = side_b.stream(raw, starts, ends, codes, first, each)
    # documents whose bytes do not come back have no tokens
    cell_doc = np.repeat(np.arange(docs), np.diff(bounds))
    good = np.diff(chunk.offsets) > 0
    width = ends - starts
    for side, stream in ((side_a, a), (side_b, b)):
        size = _per(stream.bounds, stream.sizes)
        good[cell_doc[size != width]] = False
        if (size == width).all():
            bad = np.flatnonzero(side.text(stream) != data)
            good[cell_doc[np.searchsorted(starts, bad, "right") - 1]] = False
        else:
            text, where = side.text(stream), np.concatenate([[0], np.cumsum(size)])
            for c in np.flatnonzero((size == width) & good[cell_doc]).tolist():
                if good[cell_doc[c]] and not np.array_equal(text[where[c]:where[c + 1]], data[starts[c]:ends[c]]):
                    good[cell_doc[c]] = False
    lanes = np.flatnonzero(((np.arange(len(starts)) - bounds[cell_doc]) % LANE == 0) & good[cell_doc])
    groups = lockstep(a, b, lanes, np.minimum(lanes + LANE, bounds[cell_doc[lanes] + 1]))
    group_doc = cell_doc[np.searchsorted(a.bounds, groups[0], "right") - 1]
    keys, times = links(a, b, groups, group_doc)
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    times = np.add.reduceat(times, new) if len(new) else times
    by_doc = np.searchsorted(group_doc, np.arange(docs + 1))
    n_links = _per(by_doc, (groups[1] - groups[0]) * (groups[3] - groups[2]))
    return Aligned(np.where(good, np.diff(a.bounds[bounds]), 0), np.where(good, np.diff(b.bounds[bounds]), 0),
                   np.diff(by_doc), n_links, digests(side_a, side_b, a, b, groups, by_doc), keys[new], times)


_workers: dict[tuple[str, str], tuple[Side, Side]] = {}


def _sides(path_a: str, path_b: str) -> tuple[Side, Side]:
    key = (path_a, path_b)
    if key not in _workers:
        _workers[key] = ByteSide(path_a), PieceSide(path_b)
    return _workers[key]


def joined(parts: list[Aligned]) -> Aligned:
    """The documents of several pieces as one chunk."""
    before = np.cumsum([0] + [len(p.n_a) for p in parts])
    keys = np.concatenate([p.keys + (int(k) << 2 * ID_BITS) for p, k in zip(parts, before)])
    counts = (np.concatenate([getattr(p, name) for p in parts]) for name in ("n_a", "n_b", "n_groups", "n_links"))
    return Aligned(*counts, [d for p in parts for d in p.digests], keys, np.concatenate([p.times for p in parts]))


def _batch(number: int, ids: pa.Array, got: Aligned) -> pa.RecordBatch:
    """Rows of a chunk: its documents, each with the places of its pairs, and last the chunk's own with the pairs."""
    docs = len(ids)
    pairs, at, holders = np.unique(got.keys & PAIR, return_inverse=True, return_counts=True)
    bounds = np.append(np.searchsorted(got.keys, np.arange(docs + 1) << 2 * ID_BITS), len(got.keys)).astype(np.int32)
    none = pa.nulls(1, pa.int64())

    def column(values: np.ndarray) -> pa.Array:
        return pa.concat_arrays([pa.array(values, pa.int64()), none])

    def lists(values: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(bounds), pa.array(values, pa.int32()))

    def own(values: np.ndarray, kind: pa.DataType) -> pa.Array:
        return pa.concat_arrays([pa.nulls(docs, pa.list_(kind)), pa.array([values], pa.list_(kind))])

    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(docs + 1, number), pa.int64()), pa.concat_arrays([ids.cast(pa.int64()), none]),
         column(got.n_a), column(got.n_b), column(got.n_groups), column(got.n_links), pa.array([*got.digests, None], pa.string()),
         lists(at), lists(got.times), own(pairs, pa.int64()), own(holders, pa.int32())], names=NAMES)


def _chunks(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = _sides(path_a, path_b)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            first, size, parts = 0, 0, []
            for piece in chunks(batch.column("_text"), PIECE_BYTES):
                if parts and size + len(piece.data) > CHUNK_BYTES:
                    yield _batch(number, batch.column("doc_id").slice(first, piece.first - first), joined(parts))
                    first, size, parts, number = piece.first, 0, [], number + 1
                parts.append(align(piece, *sides))
                size += len(piece.data)
            if parts:
                yield _batch(number, batch.column("doc_id").slice(first), joined(parts))
                number += 1
    return run


def _sums(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """Documents of a chunk with the counts of its pairs added up over their links."""
    place = np.asarray(right.column("place"))
    count, best = np.zeros((2, len(place)), np.int64)
    count[place], best[place] = np.asarray(right.column("count")), np.asarray(right.column("best"))
    held, times = left.column("held").combine_chunks(), left.column("times").combine_chunks()
    ends = np.concatenate([[0], np.cumsum(np.asarray(held.value_lengths()))])
    at, times = np.asarray(held.flatten()), np.asarray(times.flatten()).astype(np.int64)
    return left.drop_columns(["chunk", "held", "times"]) \
        .append_column("n_best", pa.array(_per(ends, best[at] * times), pa.int64())) \
        .append_column("count_sum", pa.array(_per(ends, count[at] * times), pa.int64()))


def align_documents(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum.

    ``path_a`` is a byte-level tokenizer file, ``path_b`` a piece model with byte fallback. A NULL or empty
    text, and one whose joined A or B bytes are not a space and the text, has no tokens: zeros and an
    empty digest. Repeated rows, NULL ids and equal ids are documents of their own and count each.
    Texts of any length are read whole: a long one is a chunk by itself, cut into lanes. Other columns,
    whatever their names, are not read; an empty table gives no rows.
    """
    path_a, path_b = path_a or tokenizer_path("byte_bpe_50k.json"), path_b or tokenizer_path("piece_bpe_32k.model")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("_text"))
    table = stored(map_arrow(rows, _chunks(path_a, path_b), SCHEMA), "alignment")
    own = table.where(F.col("pairs").isNotNull()) \
        .select("chunk", F.posexplode(F.arrays_zip("pairs", "docs")).alias("place", "_pair")) \
        .select("chunk", "place", F.col("_pair.pairs").alias("pair"), F.col("_pair.docs").alias("docs"))
    # an A id stands beside B's vocabulary at most, so its window is bounded
    same_a = Window.partitionBy(F.shiftright("pair", ID_BITS))
    counts = own.groupBy("pair").agg(F.sum("docs").alias("count")) \
        .withColumn("best", (F.col("count") == F.max("count").over(same_a)).cast("int"))
    back = own.select(F.col("chunk").alias("into"), "place", "pair").join(counts, "pair").select("into", "place", "count", "best")
    return table.where(F.col("pairs").isNull()).drop("pairs", "docs").groupBy("chunk") \
        .cogroup(back.groupBy("into")).applyInArrow(
            _sums, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long")


def op12_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alignment of both tokenizers over all documents."""
    return align_documents(documents(spark, sf_dir))
