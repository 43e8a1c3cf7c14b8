"""Quality rules: counts of each text, and n-gram perplexity bands by language.

The language model is a modified Kneser-Ney model of the symbols inside words (UTF-8 bytes with a
start and an end mark), one for each language. Spark counts the n-grams of the whole corpus and
derives discounts, probabilities and back-off weights; the model is then stored in arrays sorted by full
64-bit keys, an entry for every gram and context, and goes to the tasks in that form. A large model goes
there in pieces that each score the symbols after some previous symbols, so that neither the driver nor a
task holds more than one. A document's score is its log perplexity a word; a document outside its
language's band is rejected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructType

from strata.llm.common import documents, map_arrow, stored
from strata.llm.words import SPACE, Chunk, Words, chunks, grams, mix, span_codes, whole, words

#: Symbols of the longest n-gram (at most 4, so that a gram beside the number of a language is one long).
ORDER = 4
#: Entries of the model that the driver and a task hold at once (on average; a model has as many pieces as it needs).
PIECE = 1 << 22
#: Words, and symbols with what is before them, whose score a task keeps: 2**KNOWN_BITS of each.
KNOWN_BITS = 18
#: Bytes of text scored at once.
SLICE = 1 << 19
#: Band: from the median so many robust standard deviations down and up (distance to the first and third
#: quartile / 0.6745) in documents of the same language and length class (a doubling of the words, up to
#: 2**LONGEST). Names and numbers give clean texts a long upper tail; the lower one is short.
REACH, LONGEST = (3.0, 5.5), 14
#: Documents below which a class takes the language's spread, which shrinks with the root of the words.
FEW = 50
#: Fixed values of the base rules: least words, most percent of words in repeated windows, their
#: width, the symbols counted.
LEAST_WORDS, MOST_REPEATED, WINDOW, SYMBOLS = 10, 20, 5, b"#*$%&|<>"

_START, _END = 2, 3
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True
_MODEL_BYTE = np.maximum(np.arange(256), 4).astype(np.uint64)  # 0 to 3 are marks


def _totals(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])[offsets])


def _twice(codes: np.ndarray) -> np.ndarray:
    """Which codes occur more than once."""
    ordered = np.sort(codes)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return np.zeros(len(codes), bool)
    return again[np.minimum(np.searchsorted(again, codes), len(again) - 1)] == codes


def text_counts(chunk: Chunk, w: Words | None = None) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each document of a chunk (``w``: its words)."""
    data, offsets, docs = chunk.data, chunk.offsets, len(chunk.offsets) - 1
    w = w or words(chunk)
    out = {"n_words": np.diff(w.bounds), "n_symbols": _totals(_SYMBOL[data], offsets),
           "word_chars": _totals(~SPACE[data] & ((data & 0xC0) != 0x80), offsets)}

    cut = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], cut + 1]))
    ends = np.sort(np.concatenate([cut, offsets[1:]]))
    some = np.searchsorted(w.starts, ends) > np.searchsorted(w.starts, starts)
    starts, ends = starts[some], ends[some]
    doc = np.searchsorted(offsets, starts, "right") - 1
    codes = span_codes(data, starts, ends)
    out["n_dup_lines"] = _repeated(doc, codes, docs)

    windows, ok = grams(w.codes, WINDOW), whole(w.bounds, WINDOW)
    at = np.flatnonzero(ok)
    covered = np.zeros(len(w.codes) + 1, np.int64)
    hit = at[_twice(mix(windows[at] ^ mix(w.docs[at].astype(np.uint64) + np.uint64(1))))]
    np.add.at(covered, hit, 1)
    np.add.at(covered, hit + WINDOW, -1)
    out["n_repeat_words"] = _totals(np.cumsum(covered)[:-1] > 0, w.bounds)
    return out


def _repeated(doc: np.ndarray, codes: np.ndarray, docs: int) -> np.ndarray:
    """Rows of each document that equal an earlier row of it."""
    order = np.lexsort((codes, doc))
    same = (codes[order][1:] == codes[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    return np.bincount(doc[order][1:][same], minlength=docs)


def _symbols(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every symbol of the words (bytes and end mark): the packed gram of ORDER symbols that ends
    with it (zeros before the start mark), and its word."""
    size = ends - starts + 2
    first = np.cumsum(size) - size
    total = int(size.sum())
    word = np.repeat(np.arange(len(size)), size)
    place = np.arange(total) - first[word]
    flat = np.full(total, _END, np.uint64)
    flat[first] = _START
    byte = (place > 0) & (place < size[word] - 1)
    flat[byte] = _MODEL_BYTE[data[(starts[word] + place - 1)[byte]]]
    gram = flat.copy()
    for j in range(1, ORDER):
        back = np.zeros(total, np.uint64)
        back[j:] = flat[:-j]
        back[place < j] = 0
        gram |= back << np.uint64(8 * j)
    keep = place > 0
    return gram[keep], word[keep]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of a batch, summed over the batch."""
    for batch in batches:
        langs, each = np.unique(np.array(batch.column("_lang").to_pylist(), dtype=object).astype(str),
                                return_inverse=True) if len(batch) else (np.empty(0, str), np.empty(0, int))
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for chunk in chunks(batch.column("_text")):
            w = words(chunk)
            lang = each[chunk.first:chunk.last][w.docs]
            codes, at, n = np.unique(mix(w.codes + lang.astype(np.uint64)), return_index=True, return_counts=True)
            gram, word = _symbols(chunk.data, w.starts[at], w.ends[at])
            parts.append(_sum(lang[at][word], gram, n[word]))
            if len(parts) == 16:
                parts = [_sum(*map(np.concatenate, zip(*parts)))]
        if parts:
            lang, gram, n = _sum(*map(np.concatenate, zip(*parts)))
            yield pa.RecordBatch.from_arrays([pa.array(langs[lang].tolist(), pa.string()),
                                              pa.array(gram.astype(np.int64)), pa.array(n.astype(np.int64))],
                                             names=["lang", "gram", "n"])


def _sum(lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not len(n):
        return lang, gram, n
    key = gram | lang.astype(np.uint64) << np.uint64(8 * ORDER)
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    at = order[first]
    return lang[at], gram[at], np.add.reduceat(n[order], first)


def _key(lang_code: np.ndarray | np.uint64, level: int, gram: np.ndarray, kind: int) -> np.ndarray:
    """Full 64-bit key of an entry: within a language no two entries share one."""
    return mix(gram + np.uint64((level * 2 + kind + 1) * 0xD1B54A32D192ED03 & (2**64 - 1)) ^ lang_code)


def _home(lang_code: np.ndarray | np.uint64, before: np.ndarray) -> np.ndarray:
    """Number (below 2**16) of a language's symbols that follow the symbol ``before``, by which a model is cut in pieces."""
    return (mix(lang_code + mix(before + np.uint64(1))) >> np.uint64(48)).astype(np.int64)


def lang_code(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


@dataclass
class Model:
    """Sorted keys with discounted probabilities (kind 0) and back-off weights (kind 1): those of one piece of a model
    of ``pieces``, which has all that the symbols of its homes ask for."""

    keys: np.ndarray
    values: np.ndarray
    piece: int = 0
    pieces: int = 1

    def _get(self, key: np.ndarray, missing: float) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(key), missing)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], missing)

    def has(self, gram: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Whether the symbols packed in ``gram`` are scored by this piece."""
        if self.pieces == 1:
            return np.ones(len(gram), bool)
        return _home(code, gram >> np.uint64(8) & np.uint64(255)) % self.pieces == self.piece

    def log_probs(self, gram: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Natural log of each symbol's probability after the symbols packed before it."""
        p = np.full(len(gram), 1 / 256)
        for level in range(1, ORDER + 1):
            low = gram & np.uint64((1 << 8 * level) - 1)
            oldest = (low >> np.uint64(8 * (level - 1))) & np.uint64(255)
            # a context that begins with the start mark is of the top level, whatever its length
            usable = oldest != 0
            top = np.where(oldest == _START, ORDER, level)
            for t in {level, ORDER}:
                mine = usable & (top == t)
                if mine.any():
                    g, c = low[mine], code[mine]
                    weight = self._get(_key(c, t, g >> np.uint64(8), 1), 1.0)
                    p[mine] = self._get(_key(c, t, g, 0), 0.0) + weight * p[mine]
        return np.log(np.maximum(p, 1e-12))


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all words of all texts."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("_lang"),
                       F.col("text").alias("_text"))
    return map_arrow(rows, _count, "lang string, gram long, n long", give_back=True) \
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _mask(symbols: int):
    return F.lit((1 << 8 * symbols) - 1).cast("long")


def kneser_ney(counts: DataFrame) -> DataFrame:
    """(lang, level, gram, kind, value): discounted probabilities of grams (kind 0) and back-off
    weights of contexts (kind 1). Levels below the top count distinct symbols before a gram."""
    symbol = lambda j: F.shiftrightunsigned("gram", 8 * j).bitwiseAND(F.lit(255).cast("long"))
    counts = stored(counts, "quality-counts")  # every level reads it
    # a top gram has ORDER symbols or begins with the start mark, after zeros
    levels = counts.select("lang", F.lit(ORDER).alias("level"), "gram", F.col("n").alias("c"))
    for k in range(1, ORDER):
        inner = F.lit(True)
        for j in range(k):
            inner = inner & (symbol(j) > _START)
        kinds = (counts.where(inner & (symbol(k) > 0))
                 .select("lang", F.col("gram").bitwiseAND(_mask(k + 1)).alias("_longer")).distinct())
        levels = levels.unionByName(
            kinds.groupBy("lang", F.col("_longer").bitwiseAND(_mask(k)).alias("gram"))
            .agg(F.count(F.lit(1)).alias("c")).select("lang", F.lit(k).alias("level"), "gram", "c"))
    levels = stored(levels, "quality-grams")
    n = [F.count(F.when(F.col("c") == i, 1)).cast("double") for i in range(1, 5)]
    y = F.when(n[0] + 2 * n[1] > 0, n[0] / (n[0] + 2 * n[1])).otherwise(F.lit(0.5))
    step = lambda i: F.greatest(F.lit(0.0), F.least(F.lit(float(i)), F.when(
        n[i - 1] > 0, i - (i + 1) * y * n[i] / n[i - 1]).otherwise(F.lit(0.5 * i))))
    discounts = levels.groupBy("lang", "level").agg(step(1).alias("_d1"), step(2).alias("_d2"), step(3).alias("_d3"))
    cut = F.when(F.col("c") == 1, F.col("_d1")).when(F.col("c") == 2, F.col("_d2")).otherwise(F.col("_d3"))
    # one row per language and level: with them at hand, a language's grams need not meet in one task
    cut_rows = levels.join(F.broadcast(discounts), ["lang", "level"]).withColumn("_cut", F.least(cut, F.col("c").cast("double"))) \
        .withColumn("_context", F.shiftrightunsigned("gram", 8))
    contexts = cut_rows.groupBy("lang", "level", "_context").agg(
        F.sum("c").alias("_all"), (F.sum("_cut") / F.sum("c")).alias("_weight"))
    probs = cut_rows.join(contexts, ["lang", "level", "_context"]).select(
        "lang", "level", "gram", F.lit(0).alias("kind"), ((F.col("c") - F.col("_cut")) / F.col("_all")).alias("value"))
    weights = contexts.select("lang", "level", F.col("_context").alias("gram"), F.lit(1).alias("kind"),
                              F.col("_weight").alias("value"))
    return probs.unionByName(weights)


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, home, value); the entries of level 1, which all pieces need, have the home -1."""
    for batch in batches:
        codes = {x: lang_code(x) for x in set(batch.column("lang").to_pylist())}
        lang = np.array([codes[x] for x in batch.column("lang").to_pylist()], np.uint64)
        level, kind = batch.column("level").to_numpy(), batch.column("kind").to_numpy()
        gram = batch.column("gram").to_numpy().astype(np.uint64)
        key = np.zeros(len(gram), np.uint64)
        for t in range(1, ORDER + 1):
            for k in (0, 1):
                mine = (level == t) & (kind == k)
                key[mine] = _key(lang[mine], t, gram[mine], k)
        before = np.where(kind == 0, gram >> np.uint64(8), gram) & np.uint64(255)
        home = np.where(level == 1, -1, _home(lang, before))
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(home.astype(np.int32)), batch.column("value")],
                                         names=["key", "home", "value"])


def entries(docs: DataFrame) -> DataFrame:
    """The model of the corpus, stored: an entry (key, home, value) for each gram and context."""
    return stored(map_arrow(kneser_ney(count_grams(docs)).withColumn("value", F.col("value").cast("float")), _entries,
                            "key long, home int, value float", give_back=True), "quality-model")


def load(model: DataFrame, piece: int = 0, pieces: int = 1) -> Model:
    """A piece of the stored model as sorted arrays."""
    mine = model.where((F.col("home") < 0) | (F.col("home") % pieces == piece)).select("key", "value").toArrow()
    keys = mine.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return Model(keys[order], mine.column("value").to_numpy()[order], piece, pieces)


def train(docs: DataFrame) -> Model:
    """Count the corpus and bring its whole model into sorted arrays."""
    return load(entries(docs))


class _Known:
    """Values by 64-bit key, of which each place keeps the last."""

    def __init__(self) -> None:
        self.keys = np.arange(1, (1 << KNOWN_BITS) + 1, dtype=np.uint64)  # none is a key of its place
        self.values = np.zeros(1 << KNOWN_BITS)

    def get(self, keys: np.ndarray, find) -> np.ndarray:
        """The values of ``keys``; ``find`` gives those of the rows it is called with."""
        at = (keys & np.uint64((1 << KNOWN_BITS) - 1)).astype(np.int64)
        out = self.values[at]
        new = np.flatnonzero(self.keys[at] != keys)
        if len(new):
            _, first, each = np.unique(keys[new], return_index=True, return_inverse=True)
            rows = new[first]
            found = find(rows)
            out[new] = found[each]
            place, pick = np.unique(at[rows], return_index=True)
            self.keys[place], self.values[place] = keys[rows[pick]], found[pick]
        return out


class _Scores:
    """Log probabilities of words (by language), each found when first met."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.words, self.symbols = _Known(), _Known()

    def of(self, chunk: Chunk, w: Words, codes: np.ndarray) -> np.ndarray:
        """Sum of log probabilities of each document; ``codes``: its language."""
        docs = w.docs
        code = codes[docs]

        def find(rows: np.ndarray) -> np.ndarray:
            gram, word = _symbols(chunk.data, w.starts[rows], w.ends[rows])
            lang = code[rows][word]
            mine = self.model.has(gram, lang)
            gram, word, lang = gram[mine], word[mine], lang[mine]
            logs = self.symbols.get(mix(gram ^ lang), lambda r: self.model.log_probs(gram[r], lang[r]))
            return np.bincount(word, logs, minlength=len(rows))

        return np.bincount(docs, self.words.get(mix(w.codes ^ code), find), minlength=len(codes))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _codes(langs: pa.Array) -> np.ndarray:
    known: dict[str, np.uint64] = {}
    return np.array([known.get(x) or known.setdefault(x, lang_code(x)) for x in (x or "und" for x in langs.to_pylist())], np.uint64)


def _score(model: Model, count: bool = True):
    """The columns of a batch but _lang and _text, the counts (if ``count``) and _log, the sum of the log probabilities
    of the symbols that the model's piece scores."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _Scores(model)
        for batch in batches:
            codes = _codes(batch.column("_lang"))
            found: dict[str, list[np.ndarray]] = {k: [] for k in (*COUNTS * count, "log")}
            for chunk in chunks(batch.column("_text"), SLICE):
                w = words(chunk)
                if count:
                    for k, v in text_counts(chunk, w).items():
                        found[k].append(v)
                found["log"].append(scores.of(chunk, w, codes[chunk.first:chunk.last]))
            arrays = [np.concatenate(found[k]) if found[k] else np.empty(0) for k in found]
            yield pa.RecordBatch.from_arrays(
                [c for n, c in zip(batch.schema.names, batch.columns) if n not in ("_lang", "_text")]
                + [pa.array(a.astype(np.int64)) for a in arrays[:-1]] + [pa.array(arrays[-1].astype(float))],
                names=[n for n in batch.schema.names if n not in ("_lang", "_text")] + [f"_{k}" for k in found])
    return run


def _scored(docs: DataFrame, keep: list[str | Column]) -> DataFrame:
    """The ``keep`` columns with _language, the counts and _log_perplexity. Each piece of the model reads the texts
    once; equal texts of a language have equal scores, so the pieces' sums meet by hashes of both."""
    model = entries(docs)
    pieces = max(1, -(-model.count() // PIECE))
    language = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    texts = [F.col("lang").cast("string").alias("_lang"), F.col("text").alias("_text")]
    same = [F.xxhash64(language, "text").alias("_one"), F.xxhash64(F.lit(5), language, "text").alias("_two")] * (pieces > 1)
    rows = docs.select(*keep, language.alias("_language"), *same, *texts)
    schema = StructType([f for f in rows.schema if f.name not in ("_lang", "_text")])
    for k in COUNTS:
        schema = schema.add(f"_{k}", LongType())
    out = map_arrow(rows, _score(load(model, 0, pieces)), schema.add("_log", DoubleType()), give_back=True)
    if pieces > 1:
        more = []
        for piece in range(1, pieces):  # stored one by one: the driver holds one piece
            sums = map_arrow(docs.select(*same, *texts), _score(load(model, piece, pieces), False),
                             "_one long, _two long, _log double", give_back=True)
            more.append(stored(sums.groupBy("_one", "_two").agg(F.struct(F.lit(piece), F.min("_log").alias("log")).alias("_more")),
                               "quality-piece"))
        sums = reduce(DataFrame.unionByName, more).groupBy("_one", "_two").agg(F.array_sort(F.collect_list("_more")).alias("_more"))
        out = out.join(sums, ["_one", "_two"]).withColumn("_log", F.aggregate(
            "_more", F.col("_log"), lambda log, x: log + x["log"])).drop("_one", "_two", "_more")
    return out.withColumn("_log_perplexity", -F.col("_log") / F.greatest(F.col("_n_words"), F.lit(1))).drop("_log")


def judge_documents(docs: DataFrame, keep: list[str | Column], name: str = "quality") -> DataFrame:
    """The ``keep`` columns of every row of ``docs`` with _n_words, _word_chars, _n_symbols,
    _n_dup_lines, _n_repeat_words, _log_perplexity, _base_failed and _kept.

    The model and the bands are made from all of ``docs``; a NULL language is a language of its own
    (``und``). Bands come from the documents that pass the base rules. A NULL or blank text fails
    the base rules. Repeated rows are judged alike; texts of any length are read whole; columns other
    than lang and text are read only if they are kept, and may have any names; an empty table gives no rows.
    """
    failed = (F.col("_n_words") < LEAST_WORDS) | \
        (100 * F.col("_n_repeat_words") > MOST_REPEATED * F.col("_n_words"))
    scored = stored(_scored(docs, keep).withColumn("_base_failed", failed), name)
    quartiles = lambda x: F.percentile_approx(x, F.array(*map(F.lit, (0.25, 0.5, 0.75))), F.lit(1000))
    length = F.least(F.lit(LONGEST), F.floor(F.log2(F.greatest(F.col("_n_words"), F.lit(1)))))
    passed = scored.where(~F.col("_base_failed")).withColumn("_length", length)
    middle = passed.groupBy("_language").agg(quartiles(F.col("_log_perplexity"))[1].alias("_middle"))
    root = F.sqrt(F.greatest(F.col("_n_words"), F.lit(1)))
    whole_language = passed.join(F.broadcast(middle), "_language") \
        .groupBy("_language").agg(F.first("_middle").alias("_middle"),
                                  quartiles((F.col("_log_perplexity") - F.col("_middle")) * root).alias("_w"))
    classes = passed.groupBy("_language", "_length").agg(
        quartiles(F.col("_log_perplexity")).alias("_q"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= FEW)
    # one row per language and class
    bands = whole_language.join(classes.withColumnRenamed("_language", "_l"), F.col("_language") == F.col("_l"), "left") \
        .groupBy("_language").agg(F.first("_middle").alias("_middle"), F.first("_w").alias("_w"), F.map_from_entries(
            F.collect_list(F.when(F.col("_q").isNotNull(), F.struct("_length", "_q")))).alias("_classes"))
    q = F.try_element_at("_classes", length)
    middle = F.coalesce(q[1], F.col("_middle"))
    down, up = (F.coalesce(q[k + 1] - q[k], (F.col("_w")[k + 1] - F.col("_w")[k]) / root) / 0.6745 for k in (0, 1))
    inside = F.col("_log_perplexity").between(middle - REACH[0] * down - 1e-9, middle + REACH[1] * up + 1e-9)
    return (scored.join(bands, "_language", "left")
            .withColumn("_kept", ~F.col("_base_failed") & F.coalesce(inside, F.lit(False))))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns, whatever their names.

    Rows with a NULL or blank text go; repeated rows stay or go together; ids, NULL or not, do not matter;
    an empty table gives no rows.
    """
    judged = judge_documents(docs, [F.struct("*").alias("_doc")], "quality-documents")
    return judged.where("_kept").select("_doc.*")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    judged = judge_documents(documents(spark, sf_dir), ["doc_id"])
    return judged.select("doc_id", *(F.col(f"_{k}").alias(k) for k in COUNTS),
                         F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"),
                         F.col("_log_perplexity").alias("log_perplexity"))
