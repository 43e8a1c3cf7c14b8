"""Training-corpus pipeline: five of the corpus operators, one after the other, over ``documents``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's documents. All but the last return the columns of documents.

What a stage stores on its way is needed until its rows are written. They are when the next stage is
called, which deletes it (of the call before it in the same thread, and not what its own documents are
read from). The first stage deletes nothing, so the last one's rows may be read at any time.
"""

from __future__ import annotations

from collections.abc import Callable
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from strata.llm.common import documents, noting, stored
from strata.llm.jaccard import keep_one
from strata.llm.lines import without_repeats
from strata.llm.mixing import mixed_documents
from strata.llm.packing import pack
from strata.llm.quality import keep_good
from strata.operators.files import delete_path

#: Perplexity bands, suffix arrays, near-copy components and packing layouts have no plain SQL form.
ORACLE_SQL = None


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_left: ContextVar[tuple[str, ...]] = ContextVar("left", default=())


def tidy(stage: Stage) -> Stage:
    """``stage``, which first deletes what the stage before it has stored."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if stage.__name__ != "quality_rules":
            read = docs.inputFiles()
            for path in _left.get():
                if not any(path.split(":")[-1].rstrip("/") + "/" in f for f in read):
                    delete_path(spark, path)
        paths: list[str] = []
        with noting(paths):
            out = stage(spark, docs, sf_dir)
        _left.set(tuple(paths))
        return out
    return run


@tidy
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie in their language's perplexity band.

    NULL and blank texts go; repeated rows stay or go together; a NULL language is a language of its own."""
    return keep_good(docs)


@tidy
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of line runs; documents that lose all their lines go.

    The copy of the smallest doc_id (NULL first, then table order) stays; NULL and blank texts stay as they are."""
    return without_repeats(docs)


@tidy
def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest doc_id) of each group of near-copies.

    Of equal doc_ids the first row stays, a NULL one only without others; NULL and blank texts are in no group."""
    return keep_one(docs)


@tidy
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order.

    A NULL source is a source of its own; blank and NULL texts are never taken; repeated rows are taken one by one."""
    return mixed_documents(docs)


@tidy
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences.

    A NULL or empty text is the end id alone; repeated rows and NULL doc_ids are packed like any other row."""
    return pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("mix_sources", mix_sources),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each stage's rows are a stored table."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
