"""Repeated line runs by a suffix array over line ids, built by distributed prefix doubling.

Every line with a word has an id. The rank of a suffix among all suffixes by its first 2**j lines comes
from the ranks by the first 2**(j - 1) lines at its start and at its middle: pairs of ranks are
sorted by range and numbered. Only suffixes that share their rank go on, so the work shrinks to the
repeated runs. Suffixes of equal rank are an interval of the suffix array whose longest common
prefix is at least 2**j lines; all but its first (by doc_id, row and place) are later copies. Runs
that such intervals cover are deleted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.llm.common import documents, map_arrow, numbered, stored
from strata.llm.words import chunks, span_codes, words

#: A repeated run counts with at least two lines, or as one line of LONE_WORDS words, or of LEAST_WORDS if its
#: words times the documents that hold it come to LONE_WEIGHT. Shorter lines meet by chance.
LONE_WORDS, LEAST_WORDS, LONE_WEIGHT = 20, 3, 60


def _line_table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_row, _id, at, lines, code, words, fresh) of each line with a word; ``at`` counts such lines from 0,
    ``fresh`` is 1 where a document holds the line first."""
    for batch in batches:
        row, ident = batch.column("_row"), batch.column("_id")
        for chunk in chunks(batch.column("_text")):
            data, offsets = chunk.data, chunk.offsets
            w = words(chunk, codes=False)
            cut = np.flatnonzero(data == 10)
            starts = np.sort(np.concatenate([offsets[:-1], cut + 1]))
            ends = np.sort(np.concatenate([cut, offsets[1:]]))
            n = np.searchsorted(w.starts, ends) - np.searchsorted(w.starts, starts)
            starts, ends, n = starts[n > 0], ends[n > 0], n[n > 0]
            doc = np.searchsorted(offsets, starts, "right") - 1
            first = np.searchsorted(doc, np.arange(len(offsets) - 1))
            lines = np.bincount(doc, minlength=len(offsets) - 1)
            where = pa.array(chunk.first + doc)
            codes = span_codes(data, starts, ends)
            order = np.lexsort((codes, doc))
            fresh = np.ones(len(doc), np.int64)
            fresh[order[1:]] = (codes[order][1:] != codes[order][:-1]) | (doc[order][1:] != doc[order][:-1])
            yield pa.RecordBatch.from_arrays(
                [row.take(where), ident.take(where), pa.array(np.arange(len(doc)) - first[doc], pa.int64()),
                 pa.array(lines[doc], pa.int64()), pa.array(codes.view(np.int64)), pa.array(n, pa.int64()), pa.array(fresh)],
                names=["_row", "_id", "at", "lines", "code", "words", "fresh"])


def _ranks(keys: DataFrame, names: list[str]) -> DataFrame:
    """Number distinct keys in their order: sorted by range, counted by partition, numbered within."""
    placed = stored(keys.repartitionByRange(*names).withColumn("_part", F.spark_partition_id()), "line-keys")
    ahead = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_ahead"))  # one row a partition
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*names))
    return placed.withColumn("_inside", inside).join(ahead, "_part") \
        .withColumn("_rank", F.col("_ahead") + F.col("_inside")).drop("_part", "_ahead", "_inside")


def _shared(suffixes: DataFrame, names: list[str], more: tuple[Column, ...] = ()) -> DataFrame:
    """Suffixes whose key another has too, with the key's rank and its first place, and aggregates of the key."""
    place = F.struct("_id", "_row", "at")
    keys = suffixes.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"), F.min(place).alias("first"), *more) \
        .where("_n > 1").drop("_n")
    return suffixes.join(_ranks(keys, names), names) \
        .withColumn("later", place > F.col("first")) \
        .select("_row", "_id", "at", "lines", "words", F.col("_rank").alias("rank"), "later",
                *(["holders"] if more else []))


def repeated_runs(rows: DataFrame, lone_words: int = LONE_WORDS) -> DataFrame:
    """(_row, at, length) for numbered rows: windows of lines with an earlier copy, of 1, 2, 4, ... lines."""
    table = stored(map_arrow(rows.select("_row", "_id", "_text"), _line_table, "_row long, _id long, at long, "
                             "lines long, code long, words long, fresh long", give_back=True), "lines")
    level = stored(_shared(table, ["code"], (F.sum("fresh").alias("holders"),)), "line-ranks")
    often = (F.col("words") >= LEAST_WORDS) & (F.col("words") * F.col("holders") >= LONE_WEIGHT)
    runs = level.where(F.col("later") & ((F.col("words") >= lone_words) | often)) \
        .select("_row", "at", F.lit(1).cast("long").alias("length"))
    reach = 1
    while not level.isEmpty():
        ahead = Window.partitionBy("_row").orderBy("at").rangeBetween(reach, reach)
        # where the middle is unique or past the end, so is the longer prefix
        longer = level.withColumn("middle", F.max("rank").over(ahead)).where("middle is not null")
        reach *= 2
        level = stored(_shared(longer, ["rank", "middle"]), "line-ranks")
        runs = runs.unionByName(level.where("later").select("_row", "at", F.lit(reach).cast("long").alias("length")))
    return runs


def _cut(text: str | None, runs: list | None) -> tuple[str | None, int, int, int]:
    """(kept text, lines with a word, lines removed, longest removed run)."""
    lines = (text or "").split("\n")
    worded = [i for i, x in enumerate(lines) if x.encode().strip()]
    if not runs:
        return text, len(worded), 0, 0
    edge = np.zeros(len(worded) + 1, np.int64)
    for x in runs:
        edge[x["at"]] += 1
        edge[x["at"] + x["length"]] -= 1
    gone = np.cumsum(edge[:-1]) > 0
    steps = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    drop = set(np.array(worded)[gone].tolist())
    return ("\n".join(x for i, x in enumerate(lines) if i not in drop), len(worded), int(gone.sum()),
            int((steps[1::2] - steps[::2]).max(initial=0)))


def _delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = [_cut(t, r) for t, r in zip(batch.column("_text").to_pylist(), batch.column("_runs").to_pylist())]
        kept = [n for n in batch.schema.names if n not in ("_text", "_runs")]
        yield pa.RecordBatch.from_arrays(
            [batch.column(n) for n in kept] + [pa.array([g[0] for g in got], pa.string())]
            + [pa.array([g[k] for g in got], pa.int64()) for k in (1, 2, 3)],
            names=kept + ["_kept", "_n_lines", "_n_removed", "_longest_run"])


def delete_repeats(docs: DataFrame, keep: list[str | Column], lone_words: int = LONE_WORDS) -> DataFrame:
    """The ``keep`` columns of each row of ``docs`` with _kept (its text without later copies of line
    runs), _n_lines, _n_removed and _longest_run.

    A line goes if it lies in a run of lines (two or more, or one of ``lone_words`` words, or one of
    LEAST_WORDS words and more that stands in so many documents that both multiply to LONE_WEIGHT) that
    also occurs earlier, by doc_id (NULL first), row and place. Lines without a word are not counted and
    stay. A NULL text stays NULL; a repeated row is a later copy; an empty table gives no rows. Texts of
    any length are read whole; other columns of ``docs`` may have any names.
    """
    rows = numbered(docs, "line-rows", F.struct(*keep).alias("_keep"))
    runs = repeated_runs(rows, lone_words).groupBy("_row").agg(F.collect_list(F.struct("at", "length")).alias("_runs"))
    rows = rows.join(runs, "_row", "left").select("_keep.*", "_text", "_runs")
    schema = StructType([f for f in rows.schema if f.name not in ("_text", "_runs")])
    for name, kind in (("_kept", "string"), ("_n_lines", "long"), ("_n_removed", "long"), ("_longest_run", "long")):
        schema = schema.add(name, kind)
    return map_arrow(rows, _delete, schema, give_back=True)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with shortened texts (and n_chars, if there), less the rows that lost all their lines.

    NULL and blank texts stay as they are; of repeated rows, and of texts with equal lines, the one with the
    smallest doc_id (NULL first) keeps the lines. Other columns keep their values, whatever their names;
    an empty table gives no rows.
    """
    others = [c for c in docs.columns if c != "text"]
    out = delete_repeats(docs, [F.struct(*others).alias("_doc")]) \
        .where((F.col("_n_removed") == 0) | (F.col("_n_removed") < F.col("_n_lines")))
    new = {"text": F.col("_kept")}
    if "n_chars" in others:
        new["n_chars"] = F.when(F.col("_n_removed") > 0, F.length("_kept").cast(docs.schema["n_chars"].dataType)) \
            .otherwise(F.col("_doc.n_chars"))
    return out.select(*(new.get(c, F.col("_doc")[c]).alias(c) for c in docs.columns))


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated line runs removed from all documents."""
    return delete_repeats(documents(spark, sf_dir), ["doc_id"]).select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"),
        F.col("_longest_run").alias("longest_run"), F.sha2(F.coalesce("_kept", F.lit("")), 256).alias("kept_sha256"))
