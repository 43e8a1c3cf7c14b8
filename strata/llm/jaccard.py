"""N-gram Jaccard join with PartEnum signatures.

A document is its set of distinct word shingles. Sizes fall into bands such that similar sets lie in
the same or in neighbouring bands; a band and the next share a tag, and a tag fixes the largest
symmetric difference k of a similar pair. The feature domain is parted twice by hash (first-level
parts, each of two second-level parts, of which the subsets of size one are enumerated): k differences
leave some enumerated part untouched, so similar sets share that part's signature, the hash of the
features in it. Sets with one shared signature are compared: first by bitmaps of feature parity, whose
difference never exceeds that of the sets and which grow with them, then exactly, from their texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import documents, map_arrow, numbered, stored
from strata.llm.components import components
from strata.llm.words import Chunk, chunks, grams, mix, words

#: Words of a shingle; percent of the union that two linked sets share.
SHINGLE, PERCENT = 5, 80
#: Bits of the map of candidate sets that goes to the tasks.
MAP_BITS = 26
#: Least 64-bit words of a parity bitmap, and words of its folded form that is compared first.
SKETCH, FOLDED = 16, 8
#: Pairs with the same first set that one group of compared texts holds, about.
PIECE = 2048
#: Rows of one signature that a task holds before it passes them on.
HELD = 200_000
_SUBSETS = 2  # second-level parts; subsets of one part each are enumerated


def size_bands(most: int, percent: int = PERCENT) -> np.ndarray:
    """The least size of each band, up to the band after that of ``most``."""
    lows = [1]
    while lows[-1] <= most:
        lows.append(lows[-1] * 100 // percent + 1)
    return np.array([*lows, lows[-1] * 100 // percent + 1], np.int64)


def differences(largest: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The largest symmetric difference of a similar pair whose smaller set has ``largest`` features."""
    return largest * (100 - percent) // percent


def parts(k: np.ndarray) -> np.ndarray:
    """Enumerated parts for k differences: more than k, with some to spare for parts that are empty in
    both sets (an empty part gives no signature)."""
    n = k + 3 + k // 12
    return n + n % _SUBSETS


def shingle_sets(chunk: Chunk, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each document, and where each document's begin (one more entry)."""
    w = words(chunk, lower=True)
    codes = grams(w.codes, n)
    out, ends = [], [0]
    for first, last in zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist()):
        if last - first >= n:
            got = np.sort(codes[first:last - n + 1])
            got = got[np.concatenate([[True], got[1:] != got[:-1]])]
        elif last > first:
            got = mix(grams(w.codes[first:last], last - first) + np.uint64(last - first))
        else:
            got = codes[:0]
        out.append(got)
        ends.append(ends[-1] + len(got))
    return np.concatenate(out) if out else np.empty(0, np.uint64), np.array(ends, np.int64)


def set_codes(shingles: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit code of each set (whatever the order of its members)."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(shingles), dtype=np.uint64)])
    return mix(sums[ends[1:]] - sums[ends[:-1]] + np.diff(ends).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def signatures(shingles: np.ndarray, ends: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """(signature, document) rows of all sets.

    A set whose features meet no more than k parts of a tag could lose a partner to empty parts. That
    can only happen to two such sets, so they also get the signatures of a prefix filter: the least
    size - ceil(similarity * size) + 1 of their features.
    """
    size = np.diff(ends)
    lows = size_bands(int(size.max(initial=1)), percent)
    band = np.searchsorted(lows, size, "right") - 1
    feature_doc = np.repeat(np.arange(len(size)), size)
    spread = mix(shingles)
    out_sig, out_doc = [], []
    thin = np.zeros(len(size), bool)
    for back in (0, 1):
        tag = band - back
        k = differences(lows[np.maximum(tag, 0) + 1] - 1, percent)
        used = (tag >= 0) & (k > 0) & (size > 0)
        n = np.where(used, parts(k), 0)
        first = np.concatenate([[0], np.cumsum(n)])
        mine = used[feature_doc]
        doc, value = feature_doc[mine], spread[mine]
        seed = mix(tag.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))
        part = ((mix(value ^ seed[doc]) >> np.uint64(32)) * n[doc].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        at = first[doc] + part
        sums = np.zeros(first[-1], np.uint64)
        np.add.at(sums, at, value)
        full = np.flatnonzero(np.bincount(at, minlength=int(first[-1])))
        owner = np.searchsorted(first, full, "right") - 1
        out_sig.append(mix(sums[full] + mix((full - first[owner]).astype(np.uint64) + seed[owner])))
        out_doc.append(owner)
        thin |= used & (np.bincount(owner, minlength=len(size)) <= k)
    for d in np.flatnonzero(thin).tolist():
        s = int(size[d])
        keep = np.sort(spread[ends[d]:ends[d + 1]])[:s - (percent * s + 99) // 100 + 1]
        out_sig.append(mix(keep ^ np.uint64(0x6A09E667F3BCC909)))
        out_doc.append(np.full(len(keep), d))
    return np.concatenate(out_sig), np.concatenate(out_doc)


def _sign(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies within a task sign once
        for batch in batches:
            for chunk in chunks(batch.column("_text")):
                shingles, ends = shingle_sets(chunk, n)
                codes = set_codes(shingles, ends)
                new = np.zeros(len(codes), bool)
                for d, c in enumerate(codes.tolist()):
                    if c not in seen:
                        seen.add(c)
                        new[d] = True
                if len(seen) > 1_000_000:
                    seen.clear()
                size = np.diff(ends)
                keep = np.repeat(new, size)
                sig, doc = signatures(shingles[keep], np.concatenate([[0], np.cumsum(np.where(new, size, 0))]), percent)
                yield pa.RecordBatch.from_arrays([pa.array(sig.view(np.int64)), pa.array(codes[doc].view(np.int64))],
                                                 names=["sig", "code"])
    return run


def _meet(most: int):
    return lambda batches: _meeting(batches, most)


def _meeting(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (sig, code): passes on those of signatures with two codes or more, as
    (group, code). Groups with the same members get the same name, so that they fold."""
    sig, code = np.empty(0, np.int64), np.empty(0, np.int64)
    opened: int | None = None  # signature too large to hold

    def rows(group, member):
        return pa.RecordBatch.from_arrays([pa.array(group), pa.array(member)], names=["group", "code"])

    def close(sig: np.ndarray, code: np.ndarray, opened) -> list[pa.RecordBatch]:
        out = []
        if opened is not None and len(sig):
            more = sig == opened
            if more.any():
                out.append(rows(sig[more], code[more]))
                sig, code = sig[~more], code[~more]
        if len(sig):
            new = np.concatenate([[True], (sig[1:] != sig[:-1]) | (code[1:] != code[:-1])])
            sig, code = sig[new], code[new]
            first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
            size = np.diff(np.concatenate([first, [len(sig)]]))
            name = mix(np.add.reduceat(mix(code.view(np.uint64)), first) + size.astype(np.uint64)).view(np.int64)
            many = np.repeat(size > 1, size)
            if many.any():
                out.append(rows(np.repeat(name, size)[many], code[many]))
        return out

    for batch in batches:
        sig = np.concatenate([sig, batch.column("sig").to_numpy()])
        code = np.concatenate([code, batch.column("code").to_numpy()])
        if not len(sig):
            continue
        cut = int(np.searchsorted(sig, sig[-1]))  # the last signature may go on
        yield from close(sig[:cut], code[:cut], opened)
        sig, code = sig[cut:], code[cut:]
        if opened is not None and opened != sig[0]:
            opened = None
        if len(sig) > most:
            opened = int(sig[0])
            yield rows(sig, code)
            sig, code = sig[:0], code[:0]
    yield from close(sig, code, opened)


def parity_sketches(shingles: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A bitmap for each set, of a bit a feature or more (a power of two): whether an odd number of its
    features falls on each bit. Returns their 64-bit words, and where each set's begin (one more entry).

    A bitmap of fixed size would be full for large sets, and keep no pair of them from the exact comparison.
    """
    size = np.diff(ends)
    bits = np.maximum(np.left_shift(1, np.frexp(np.maximum(size - 1, 0))[1].astype(np.int64)), 64 * SKETCH)
    first = np.concatenate([[0], np.cumsum(bits)])
    doc = np.repeat(np.arange(len(size)), size)
    at = first[doc] + (mix(shingles ^ np.uint64(0xBB67AE8584CAA73B)) & (bits[doc] - 1).astype(np.uint64)).astype(np.int64)
    at, times = np.unique(at, return_counts=True)  # memory by features and bytes, not by 64-bit counts
    odd = np.zeros(int(first[-1]), np.uint8)
    odd[at] = times & 1
    return np.packbits(odd, bitorder="little").view(np.int64), first // 64


def folded_sketches(sketch: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Bitmaps folded to ``FOLDED`` words: parities of parities, so the bound still holds."""
    if len(first) == 1:
        return np.empty((0, FOLDED), np.int64)
    return np.bitwise_xor.reduceat(sketch.reshape(-1, FOLDED), first[:-1] // FOLDED, axis=0)


class _First:
    """Which codes are wanted (by the map) and new to this task."""

    def __init__(self, wanted: np.ndarray) -> None:
        self.wanted, self.seen = wanted, set()

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        slot = (codes & np.uint64((1 << MAP_BITS) - 1)).astype(np.int64)
        out = (self.wanted[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) == 1
        if len(self.seen) > 1_000_000:
            self.seen.clear()
        for d in np.flatnonzero(out).tolist():
            c = int(codes[d])
            out[d] = c not in self.seen
            self.seen.add(c)
        return out


def _sketch(n: int, wanted: np.ndarray):
    """Per row: number of shingles, the set's code, and the bitmaps where the map has the code."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = _First(wanted)
        for batch in batches:
            for chunk in chunks(batch.column("_text")):
                shingles, ends = shingle_sets(chunk, n)
                code = set_codes(shingles, ends)
                keep = first(code)
                size = np.diff(ends)
                sketch, at = parity_sketches(shingles[np.repeat(keep, size)], np.concatenate([[0], np.cumsum(size[keep])]))
                words = np.zeros(len(size), np.int64)
                words[keep] = np.diff(at)
                folded = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(keep)]) * FOLDED, pa.int32()),
                                                  pa.array(folded_sketches(sketch, at).ravel()))
                full = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(words)]), pa.int32()), pa.array(sketch))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_row").slice(chunk.first, chunk.last - chunk.first),
                     batch.column("_id").slice(chunk.first, chunk.last - chunk.first), pa.array(size),
                     pa.array(code.view(np.int64)), folded, full],
                    names=["_row", "_id", "n_shingles", "code", "folded", "sketch"])
    return run


def _wanted(wanted: np.ndarray):
    """The rows whose key the map has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = batch.column("code").to_numpy() & ((1 << MAP_BITS) - 1)
            keep = (wanted[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) == 1
            yield batch.select(["_row", "_text"]).filter(pa.array(keep))
    return run


def _similar(n: int, percent: int):
    """Rows come grouped, in each group first the text of set ``a``, then those of the sets to compare it with:
    passes on the pairs of codes whose sets are similar, by all their shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = np.empty(0, np.uint64)
        for batch in batches:
            centre = batch.column("_centre").to_numpy(zero_copy_only=False)
            good = np.zeros(len(centre), bool)
            for chunk in chunks(batch.column("_text")):
                shingles, ends = shingle_sets(chunk, n)
                for d in range(chunk.last - chunk.first):
                    two = shingles[ends[d]:ends[d + 1]]
                    if centre[chunk.first + d]:
                        one = two.copy()
                        continue
                    at = np.minimum(np.searchsorted(one, two), len(one) - 1)
                    both = int(np.count_nonzero(one[at] == two))
                    good[chunk.first + d] = 100 * both >= percent * (len(one) + len(two) - both)
            yield batch.select(["a", "b"]).filter(pa.array(good))
    return run


def _candidate_map(codes: DataFrame) -> np.ndarray:
    """A bit map of the codes modulo 2**MAP_BITS: 8 MB, however many codes there are."""
    slot = F.col("code").bitwiseAND(F.lit((1 << MAP_BITS) - 1).cast("long"))
    bits = codes.select(F.shiftrightunsigned(slot, 6).alias("_word"), F.call_function(
        "shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63).cast("long")).cast("int")).alias("_bit")) \
        .groupBy("_word").agg(F.bit_or("_bit").alias("_bits")).toArrow()
    out = np.zeros(1 << (MAP_BITS - 6), np.uint64)
    out[bits.column("_word").to_numpy()] = bits.column("_bits").to_numpy().view(np.uint64)
    return out


def _may_link(x: str, y: str, percent: int, odd: Column) -> Column:
    """Whether sizes (n) with the prefixes ``x`` and ``y`` and ``odd`` differing bits leave room for a link."""
    total = F.col(f"{x}n") + F.col(f"{y}n")
    return (100 * F.col(f"{x}n") >= percent * F.col(f"{y}n")) & (100 * F.col(f"{y}n") >= percent * F.col(f"{x}n")) \
        & F.coalesce((100 + percent) * odd <= (100 - percent) * total, F.lit(True))


def _odd_folded(x: str, y: str) -> Column:
    """Differing bits of the folded bitmaps (m0, m1, ...)."""
    odd = [F.bit_count(F.col(f"{x}m{i}").bitwiseXOR(F.col(f"{y}m{i}"))) for i in range(FOLDED)]
    return sum(odd[1:], odd[0])


def _odd(x: Column, y: Column) -> Column:
    """Differing bits of two bitmaps; one of twice the other's size is folded (NULL if it is still longer)."""
    def halved(c: Column) -> Column:
        half = F.shiftright(F.size(c), 1)
        return F.zip_with(F.slice(c, F.lit(1), half), F.slice(c, half + 1, half), lambda p, q: p.bitwiseXOR(q))

    x, y = (F.when(F.size(c) > F.size(d), halved(c)).otherwise(c) for c, d in ((x, y), (y, x)))
    return F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, v: s + v)


def _folded(sketches: DataFrame, prefix: str, key: str) -> DataFrame:
    return sketches.select(F.col("code").alias(key), F.col("n_shingles").alias(f"{prefix}n"),
                           *(F.col("folded")[i].alias(f"{prefix}m{i}") for i in range(FOLDED)))


def _near_folded(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    return pairs.join(_folded(sketches, "_y", "b"), "b").join(_folded(sketches, "_x", "a"), "a") \
        .where(_may_link("_x", "_y", percent, _odd_folded("_x", "_y"))).select("a", "b")


def _near(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) that their whole bitmaps leave, and a row of each (_xrow, _yrow)."""
    def side(prefix: str, key: str) -> DataFrame:
        return sketches.select(F.col("code").alias(key), F.col("n_shingles").alias(f"{prefix}n"),
                               F.col("sketch").alias(f"{prefix}m"), F.col("row").alias(f"{prefix}row"))

    return pairs.join(side("_y", "b"), "b").join(side("_x", "a"), "a") \
        .where(_may_link("_x", "_y", percent, _odd(F.col("_xm"), F.col("_ym")))).select("a", "b", "_xrow", "_yrow")


def _linked(pairs: DataFrame, rows: DataFrame, n: int, percent: int, name: str) -> DataFrame:
    """Those of the pairs (a, b, and a row of each) whose sets are similar, by all their shingles.

    The texts move, which are smaller than their shingles: those of the pairs' rows to the pairs, then those of
    each set ``a`` with its partners, in several groups if they are many."""
    many = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PIECE).alias("_many"))
    pairs = pairs.join(many, "a").withColumn("_piece", F.pmod(F.xxhash64("b"), F.col("_many")))
    asked = pairs.select("a", "_piece", F.col("a").alias("b"), F.col("_xrow").alias("_row"), F.lit(True).alias("_centre")) \
        .distinct().unionByName(pairs.select("a", "_piece", "b", F.col("_yrow").alias("_row"), F.lit(False).alias("_centre")))
    key = F.xxhash64("_row").alias("code")
    texts = map_arrow(rows.select("_row", key, "_text"), _wanted(_candidate_map(asked.select(key))), "_row long, _text string",
                      give_back=True)
    groups = texts.join(asked, "_row").repartition("a", "_piece").sortWithinPartitions("a", "_piece", F.desc("_centre"))
    return stored(map_arrow(groups.select("a", "b", "_centre", "_text"), _similar(n, percent), "a long, b long",
                            give_back=True), name)


def jaccard_components(rows: DataFrame, n: int = SHINGLE, percent: int = PERCENT, held: int = HELD) -> DataFrame:
    """One row per row of the numbered ``rows``: _row, _id (its doc_id), n_shingles, _component (a number
    that rows reachable by links share; NULL for a set without links).

    Equal sets fold into one
    node. Nodes that share a signature are compared with a centre among them; where such a
    comparison fails, the bitmaps of that signature's nodes in different components are compared too, so
    no link is lost and nodes of one component are never paired with each other. Empty sets (NULL or blank text) link
    with nothing; NULL doc_ids and repeated rows are rows like any other; an empty table gives no rows.
    """
    rows = rows.select("_row", "_id", "_text")
    signed = map_arrow(rows.select("_text"), _sign(n, percent), "sig long, code long", give_back=True)
    met = stored(map_arrow(signed.repartition("sig").sortWithinPartitions("sig", "code"), _meet(held),
                           "group long, code long", give_back=True).distinct(), "jaccard-groups")
    table = stored(map_arrow(rows, _sketch(n, _candidate_map(met)), "_row long, _id long, n_shingles long, code long, "
                                                                    "folded array<long>, sketch array<long>", give_back=True),
                   "jaccard-table")
    sketches = stored(table.where(F.size("sketch") > 0).groupBy("code").agg(
        F.min("_row").alias("row"), *(F.first(c).alias(c) for c in ("n_shingles", "folded", "sketch"))), "jaccard-sketches")
    # a group's centre is the node that most groups hold: of a text and its edited copies, the text
    held_by = met.groupBy("code").agg(F.count(F.lit(1)).alias("_n"))
    met = met.join(held_by, "code")
    centres = met.groupBy("group").agg(F.max(F.struct("_n", "code")).alias("_top")) \
        .select("group", F.col("_top.code").alias("centre"))
    met = stored(met.drop("_n").join(centres, "group"), "jaccard-centres")
    stars = met.where("centre != code").select(F.col("centre").alias("a"), F.col("code").alias("b")).distinct()
    near = stored(_near(_near_folded(stars, sketches, percent), sketches, percent), "jaccard-near")
    links = _linked(near, rows, n, percent, "jaccard-links")
    found = components(links, "jaccard-components")

    # groups in which some node does not link with the centre, with their nodes' components
    good = links.select(F.col("a").alias("centre"), F.col("b").alias("code"))
    loose = met.where("centre != code").join(good, ["centre", "code"], "left_anti").select("group").distinct()
    nodes = stored(met.join(loose, "group").join(found.withColumnRenamed("node", "code"), "code", "left")
                   .select("group", "centre", "code", F.coalesce("component", "code").alias("component")), "jaccard-nodes")
    several = nodes.groupBy("group").agg(F.min("component").alias("_x"), F.max("component").alias("_y")) \
        .where("_x != _y").select("group")
    nodes = nodes.where("code != centre").join(several, "group")
    left = nodes.select("group", F.col("code").alias("a"), F.col("component").alias("_ca")) \
        .join(_folded(sketches, "_x", "a"), "a")
    right = nodes.select("group", F.col("code").alias("b"), F.col("component").alias("_cb")) \
        .join(_folded(sketches, "_y", "b"), "b")
    cross = left.join(right, (left["group"] == right["group"]) & (F.col("_ca") < F.col("_cb"))
                      & _may_link("_x", "_y", percent, _odd_folded("_x", "_y"))).select("a", "b").distinct()
    cross = stored(_near(cross, sketches, percent), "jaccard-cross")
    if not cross.isEmpty():
        more = _linked(cross, rows, n, percent, "jaccard-more")
        found = components(links.unionByName(more), "jaccard-components")
    return table.drop("folded", "sketch").join(found.select(F.col("node").alias("code"), F.col("component").alias("_component")),
                                     "code", "left") \
        .withColumn("_component", F.when(F.col("n_shingles") > 0, F.coalesce("_component", "code"))).drop("code")


def link_documents(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT, held: int = HELD) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (the smallest doc_id reachable).

    A NULL or blank text has no shingles and links with nothing; a text of fewer than ``n`` words is one
    shingle. NULL doc_ids are linked like others (a component of such rows alone has a NULL id); repeated
    rows link with each other; texts of any length are read whole; an empty table gives no rows; other
    columns, whatever their names, are not read.
    """
    rows = stored(jaccard_components(numbered(docs, "jaccard-texts"), n, percent, held), "jaccard-rows")
    least = rows.where("_component is not null").groupBy("_component").agg(F.min("_id").alias("_least"))
    return rows.join(least, "_component", "left").select(
        F.col("_id").alias("doc_id"), "n_shingles", F.coalesce("_least", "_id").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` less all but one (the smallest doc_id) of each group of linked rows.

    Of equal doc_ids the first row of the table stays, NULL ones only if the group has no other; rows with
    NULL or blank texts link with nothing and stay. Has the columns of ``docs``, whatever their names; an
    empty table gives no rows.
    """
    others = [c for c in docs.columns if c != "text"]  # the text is stored once
    texts = numbered(docs, "jaccard-texts", F.struct(*[F.col(f"`{c}`") for c in others]).alias("_doc"))
    rows = stored(jaccard_components(texts), "jaccard-rows").where("_component is not null")
    order = F.struct(F.col("_id").isNull(), F.col("_id"), F.col("_row"))
    first = rows.groupBy("_component").agg(F.min(order).alias("_first"))
    gone = rows.join(first, "_component").where(F.col("_first._row") != F.col("_row")).select("_row")
    return texts.join(gone, "_row", "left_anti").select(
        *(F.col("_text").alias("text") if c == "text" else F.col("_doc")[c].alias(c) for c in docs.columns))


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-copies of all documents."""
    return link_documents(documents(spark, sf_dir))
