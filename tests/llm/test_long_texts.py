"""Texts of megabytes, with and without white space, through every operator over documents."""

from __future__ import annotations

import random

import pytest

from strata.llm import (alignment, jaccard, language, lines, mixing, packing, quality, secrets, sharding, substrings,
                        toxicity)
from tests.llm import brute
from tests.llm.conftest import prose

TEXTS = {1: "x" * 2_000_000, 2: "a\n" * 200_000, 3: "word " * 200_000, 4: prose(random.Random(1), 60_000),
         5: "é" * 500_000 + "\n" + "0123456789abcdef" * 50_000, 6: "plain words of a short text with nothing odd in it at all", 7: "\n" * 1_000_000}


@pytest.fixture(scope="module")
def long_docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("long") / "documents.parquet")
    rows = [(k, t, "en", "web", len(t)) for k, t in TEXTS.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_counts_and_spans(long_docs):
    spans = by_id(secrets.scan_secrets(long_docs))
    assert spans[5].n_hex == 1 and spans[1].n_hex == 0 and len(spans) == len(TEXTS)
    judged = quality.judge_documents(long_docs, ["doc_id"]).collect()
    for r in judged:
        assert (r._n_words, r._word_chars, r._n_symbols, r._n_dup_lines, r._n_repeat_words) == brute.text_counts(TEXTS[r.doc_id])


def test_repeats(long_docs):
    kept = by_id(substrings.remove_repeats(long_docs))
    assert all(r.n_removed == 0 and r.n_words == len(brute.words(TEXTS[i])) for i, r in kept.items())
    cut = by_id(lines.delete_repeats(long_docs, ["doc_id"]))
    assert cut[2]._n_lines == 200_000 and cut[2]._n_removed >= 199_998 and cut[1]._kept == TEXTS[1] and cut[7]._kept == TEXTS[7]
    linked = by_id(jaccard.link_documents(long_docs))
    assert {i: r.n_shingles for i, r in linked.items()} == {i: len(brute.shingles(t)) for i, t in TEXTS.items()}
    assert all(r.component_id == i for i, r in linked.items())


def test_sizes_and_pieces(long_docs):
    pieces = packing.pack(long_docs).collect()
    for i in TEXTS:
        own = sorted((r.start, r.length, r.doc_tokens) for r in pieces if r.doc_id == i)
        assert own[0][0] == 0 and sum(n for _, n, _ in own) == own[0][2]
    shards = by_id(sharding.shard_rows(long_docs))
    assert {i: r["size"] for i, r in shards.items()} == {i: len(t.encode()) + 8 for i, t in TEXTS.items()}
    mix = by_id(mixing.plan_mix(long_docs))
    assert {i: r["size"] for i, r in mix.items()} == {i: len(brute.words(t)) for i, t in TEXTS.items()}


def test_models(spark, long_docs):
    assert len(language.identify(long_docs).collect()) == len(TEXTS)
    labels = spark.createDataFrame([(i, i % 2) for i in TEXTS], "doc_id long, toxic int")
    assert all(0 <= r.score <= 1 for r in toxicity.score_documents(long_docs, labels).collect())


def test_alignment_of_long_texts(long_docs):
    got = by_id(alignment.align_documents(long_docs))
    assert len(got) == len(TEXTS) and all(r.n_groups <= min(r.n_a, r.n_b) for r in got.values())
    assert got[6].n_a > 0 and got[3].n_links >= 200_000
