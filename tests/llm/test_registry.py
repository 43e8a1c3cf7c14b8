"""Empty tables, the registered queries, and the pipeline."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import jaccard, language, lines, mixing, packing, quality, secrets, sharding, substrings, vectors
from strata.llm.queries import QUERIES
from strata.operators.files import path_exists
from tests.llm import brute


def test_empty_tables(no_docs, spark):
    for run in (secrets.scan_secrets, packing.pack, substrings.remove_repeats, sharding.shard_rows, language.identify,
                lines.without_repeats, jaccard.link_documents, quality.keep_good, mixing.plan_mix, mixing.mixed_documents):
        assert run(no_docs).collect() == [], run.__name__
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vectors.near_vectors(none).collect() == []


def test_names():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)] + ["pipeline"]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "jaccard_join", "mix_sources", "packing"]


def test_stages(spark, docs, tmp_path):
    """Each stage on its predecessor's rows, against the plain versions."""
    now = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        frame, before = now, now.collect()
        out = stage(spark, now, "")
        if name != "packing":
            assert out.columns == docs.columns
            assert out.dtypes == docs.dtypes
        out.write.parquet(str(tmp_path / str(k)))
        now = spark.read.parquet(str(tmp_path / str(k)))
        after = now.collect()
        if name == "quality_rules":
            assert Counter(after) <= Counter(before)
            for r in after:
                n = brute.text_counts(r.text)
                assert n[0] >= 10 and 100 * n[4] <= 20 * n[0]
        elif name == "line_dedup":
            rows = [(r.doc_id, r.text) for r in before]
            want = Counter()
            for (i, t), (text, gone, n) in zip(rows, brute.deleted_lines(rows)):
                if not gone or len(gone) < n:
                    want[(i, "\n".join(x for j, x in enumerate(text) if j not in gone) if gone else t)] += 1
            assert Counter((r.doc_id, r.text) for r in after) == want
        elif name == "jaccard_join":
            sets = [brute.shingles(r.text) for r in before]
            root = brute.groups(len(before), lambda a, b: brute.similar(sets[a], sets[b]))
            assert len(after) == len(set(root))
            assert Counter(after) <= Counter(before)
        elif name == "mix_sources":
            plan = Counter()
            for r in mixing.plan_mix(frame).collect():
                plan[(r.doc_id, r.source, r.size)] += int(r.taken / r.size + 0.5) if r.size else 0
            assert Counter((r.doc_id, r.source, len(brute.words(r.text))) for r in after) == +plan
            assert set(after) <= set(before)
        else:
            assert sum(r.length for r in after if r.start == 0) > 0
            assert max(r.offset + r.length for r in after) <= 2048


def test_pipeline_runs(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert out.count() > 0


def test_a_stage_deletes_what_the_one_before_stored(spark, docs, tmp_path):
    stages = [stage for _, stage in corpus_pipeline.STAGES]
    there = lambda paths: [path_exists(spark, p) for p in paths]
    one = stages[0](spark, docs, "")
    first = corpus_pipeline._left.get()
    one.write.parquet(str(tmp_path / "1"))
    assert len(first) > 1 and all(there(first))
    two = stages[1](spark, spark.read.parquet(str(tmp_path / "1")), "")
    second = corpus_pipeline._left.get()
    assert not any(there(first)) and second and all(there(second))
    assert two.count() > 0
    # documents that are still read from such a table keep it
    kept = spark.read.parquet(second[0])
    stages[3](spark, kept.select(F.col("_id").alias("doc_id"), F.col("_text").alias("text"), F.lit("web").alias("source")), "")
    assert there(second)[0] and not any(there(second)[1:])
    other = stages[0](spark, docs, "")  # the first stage deletes nothing
    assert all(there(corpus_pipeline._left.get())) and other.count() > 0
