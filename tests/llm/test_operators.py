"""Each operator against a plain version on a small table of ordinary and odd rows."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import (jaccard, language, lines, mixing, packing, quality, secrets, sharding, substrings, vectors)
from strata.llm.common import noting, stored
from tests.llm import brute
from tests.llm.conftest import prose


def test_secrets(docs, rows):
    got = secrets.scan_secrets(docs).collect()
    want = Counter()
    for i, t in rows:
        n, digest, _ = brute.base_secrets(t)
        want[(i, *n, digest)] += 1
    assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == want
    for r in got:
        text = dict(rows).get(r.doc_id) or ""
        spans = {f"{x['kind']}:{x['start']}:{x['end']}" for x in r.spans}
        if r.doc_id is not None:
            assert set(brute.base_secrets(text)[2]) <= spans


def test_secret_ownership(spark):
    shared, own = "sk-Zx81kQpLm20Vbn3TyRw9", "ghp_A9s8D7f6G5h4J3k2L1qW"
    table = spark.createDataFrame([(k, f"see {shared} here", f"s{k}") for k in range(4)] + [(9, f"use {own} now", "s0")],
                                  "doc_id long, text string, source string")
    got = {r.doc_id: r for r in secrets.scan_secrets(table).collect()}
    assert got[0].spans == [] and got[3].spans == []  # four owners: a copied example
    assert [(x["kind"], x["class"], x["owners"], x["repositories"]) for x in got[9].spans] == [("vendor", "live", 1, 1)]


def test_packing(docs, rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    pieces = packing.pack(docs).collect()
    want = Counter()
    for i, t in rows:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        for start in range(0, len(ids), 2048):
            part = ids[start:start + 2048]
            want[(i, start, len(part), zlib.crc32(part.tobytes()), len(ids))] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in pieces) == want
    by = defaultdict(list)
    for r in pieces:
        by[r.sequence_id].append(r)
    for group in by.values():
        group.sort(key=lambda r: r.offset)
        assert [r.offset for r in group] == list(np.cumsum([0] + [r.length for r in group])[:-1])
        assert sum(r.length for r in group) <= 2048
    assert set(by) == set(range(len(by)))
    assert len(by) <= sum(r.length for r in pieces) / 2048 * 1.03 + 2


def test_packed_sequences(docs):
    some = docs.where("doc_id < 40").select("doc_id", "text").dropDuplicates(["doc_id"])
    pieces = packing.pack(some)
    whole = {r.sequence_id: r.ids for r in packing.sequences(some, pieces).collect()}
    for r in pieces.collect():
        part = np.array(whole[r.sequence_id][r.offset:r.offset + r.length], "<u4")
        assert zlib.crc32(part.tobytes()) == r.ids_crc32


def test_cutting_stock_reaches_the_bound():
    draw = random.Random(2)
    counts = {w: draw.randrange(1, 400) for w in range(1, 129)}
    layout = packing.Layout(counts, 128)
    _, uses = packing.solve_patterns(np.arange(1, 129), np.array([*counts.values()], float), 128)
    assert uses.sum() - 1 <= layout.sequences <= uses.sum() + 64
    # the large items alone need this many sequences, and so does the area
    assert layout.sequences >= max(sum(n for w, n in counts.items() if w > 64), sum(w * n for w, n in counts.items()) / 128)
    load = Counter()
    for w, n in counts.items():
        for q in layout.sequence(np.full(n, w), np.arange(n)):
            load[int(q)] += w
    assert max(load.values()) <= 128


def test_substrings(docs, rows):
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substrings.remove_repeats(docs).collect())
    want = Counter()
    for i, w, gone in brute.kept_words(rows):
        want[(i, len(w), sum(gone), brute.sha(" ".join(x for x, g in zip(w, gone) if not g)))] += 1
    assert got == want


def test_substrings_of_a_frequent_passage(spark, tmp_path):
    """A passage that many rows share, in more texts than one shard takes."""
    draw = random.Random(6)
    passage = " ".join(f"shared{k}" for k in range(40))
    rows = [(k, f"{prose(draw, 30)} {passage} {prose(draw, 30)}") for k in range(90)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "d"))
    got = {r.doc_id: r.n_removed for r in substrings.remove_repeats(spark.read.parquet(str(tmp_path / "d")), 20).collect()}
    assert got == {i: sum(gone) for i, _, gone in brute.kept_words(rows)}


def test_suffix_automaton():
    draw = random.Random(9)
    for _ in range(40):
        texts = [[draw.choice("abc") for _ in range(draw.randrange(1, 30))] for _ in range(4)]
        asked = [draw.choice("abc") for _ in range(25)]
        automaton = substrings.SuffixAutomaton()
        for t in texts:
            automaton.add(t)
        covered = set()
        for k in range(len(asked) - 3):
            if any(asked[k:k + 4] == t[j:j + 4] for t in texts for j in range(len(t) - 3)):
                covered.update(range(k, k + 4))
        assert {x for a, b in automaton.spans(asked, 4) for x in range(a, b)} == covered


def test_sharding(docs, rows):
    got = sharding.shard_rows(docs, 5).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    slots = defaultdict(list)
    load = Counter()
    for r in got:
        slots[r.shard].append(r.slot)
        load[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({r.shard for r in got if r.text_crc32 == zlib.crc32(rows[0][1].encode())}) == 1
    biggest = max(len((t or "").encode()) + 8 for _, t in rows)
    others = sorted(load.values())[:-1]
    assert max(others) - min(others) <= max(200, biggest // 100)


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_decreasing(seed):
    draw = random.Random(seed)
    sizes = sorted((draw.randrange(1, 400) for _ in range(300)), reverse=True)
    free, want = [], []
    for s in sizes:  # the tightest bin that still holds the item, by looking at all
        fits = [(f, b) for b, f in enumerate(free) if f >= s]
        if not fits:
            free.append(1000)
            fits = [(1000, len(free) - 1)]
        f, b = min(fits)
        free[b] -= s
        want.append(b)
    assert sharding.best_fit_decreasing(sizes, 1000) == want
    load = np.bincount(sharding.level_bins(sizes, 7), weights=sizes)
    assert load.max() - load.min() <= 0.02 * load.mean()


def test_language(spark, docs):
    """Held-out accuracy, odd texts, and what may be learned from."""
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.identify(table).join(table.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.98
    changed = table.withColumn("lang", F.when(language.remainder(F.col("doc_id")) == 1, "xx").otherwise(F.col("lang")))
    again = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(changed).collect()}
    assert again == {r.doc_id: (r.lang_pred, r.score) for r in got}
    odd = language.identify(docs).collect()
    assert len(odd) == docs.count()
    for r in odd:
        assert 0 <= r.score <= 1
        if r.doc_id in (54, 55, 60, 67, 100, 101):  # empty, blank, digits, marks, NULL
            assert (r.lang_pred, r.score) == ("und", 0.0)


def test_lines(docs, rows):
    got = Counter((r.doc_id, r._n_lines, r._n_removed, r._kept) for r in lines.delete_repeats(docs, ["doc_id"]).collect())
    want = Counter()
    for (i, t), (text, gone, n) in zip(rows, brute.deleted_lines(rows)):
        kept = "\n".join(x for k, x in enumerate(text) if k not in gone) if gone else t
        want[(i, n, len(gone), kept)] += 1
    assert got == want


def test_longest_runs(spark, tmp_path):
    """Runs of many lines are followed to their ends by doubling."""
    run = "\n".join(f"line number {k}" for k in range(37))
    rows = [(1, "first\n" + run), (2, run + "\nlast"), (3, "other\ntext")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "d"))
    got = {r.doc_id: r for r in lines.delete_repeats(spark.read.parquet(str(tmp_path / "d")), ["doc_id"]).collect()}
    assert (got[1]._n_removed, got[2]._n_removed, got[2]._longest_run, got[3]._n_removed) == (0, 37, 37, 0)
    assert got[2]._kept == "last"


def test_jaccard(docs, rows):
    got = jaccard.link_documents(docs).collect()
    sets = [brute.shingles(t) for _, t in rows]
    root = brute.groups(len(rows), lambda a, b: brute.similar(sets[a], sets[b]))
    least = defaultdict(list)
    for (i, _), r in zip(rows, root):
        least[r].append(i)
    want = Counter()
    for (i, _), r, s in zip(rows, root, sets):
        ids = [x for x in least[r] if x is not None]
        want[(i, len(s), (min(ids) if ids else None) if s else i)] += 1
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want


def test_signatures_cover_all_similar_pairs():
    """Any two sets of at least 80 % similarity share a signature, whatever their sizes."""
    draw = np.random.default_rng(1)
    for size in (4, 5, 6, 9, 10, 17, 40, 41, 130, 600):
        for _ in range(60):
            a = draw.integers(0, 1 << 62, size).astype(np.uint64)
            drop = int(draw.integers(0, size // 5 + 1))
            extra = int(draw.integers(0, max(1, int(1.25 * (size - drop)) - size + 1)))
            b = np.concatenate([a[drop:], draw.integers(0, 1 << 62, extra).astype(np.uint64)])
            if 100 * (size - drop) < 80 * (size + extra) or (drop == 0 and extra == 0):
                continue
            sets = [np.sort(a), np.sort(b)]
            sig, doc = jaccard.signatures(np.concatenate(sets), np.array([0, len(a), len(a) + len(b)]))
            assert set(sig[doc == 0]) & set(sig[doc == 1])


def test_jaccard_of_large_groups(spark, tmp_path):
    """A chain of near copies around a shared text: not all are near the first one."""
    draw = random.Random(8)
    base = prose(draw, 150).split()
    rows = []
    for k in range(70):
        edited = list(base)
        for j in range(k % 7):
            edited[10 + 20 * j] = f"edit{k % 3}_{j}"
        rows.append((k, " ".join(edited)))
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "d"))
    table = spark.read.parquet(str(tmp_path / "d"))
    got = {r.doc_id: r.component_id for r in jaccard.link_documents(table, held=10).collect()}
    sets = [brute.shingles(t) for _, t in rows]
    assert got == dict(enumerate(brute.groups(len(rows), lambda a, b: brute.similar(sets[a], sets[b]))))


def test_jaccard_of_large_texts(spark, tmp_path):
    """Large texts that share a passage, not enough to link, are told apart by their bitmaps; only near copies
    of one are compared by their texts, in pieces."""
    draw = random.Random(17)
    words = [f"w{k}" for k in range(5000)]
    passage = draw.choices(words, k=900)
    rows = [(k, " ".join(passage + draw.choices(words, k=2100 + 10 * k))) for k in range(8)]
    edited = rows[0][1].split()
    for j in range(5):
        edited[400 * j + 50] = f"edit{j}"
        rows.append((10 + j, " ".join(edited)))
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "d"))
    table = spark.read.parquet(str(tmp_path / "d"))
    paths = []
    with noting(paths):
        got = {r.doc_id: r.component_id for r in jaccard.link_documents(table).collect()}
    assert got == {k: k if k < 8 else 0 for k, _ in rows}
    nodes = {r.code for p in paths if "/jaccard-table-" in p for r in spark.read.parquet(p).where("size(sketch) > 0").collect()}
    compared = [r for p in paths if "/jaccard-near-" in p or "/jaccard-cross-" in p for r in spark.read.parquet(p).collect()]
    near = {c for r in compared for c in (r.a, r.b)}
    assert len(nodes) > 6 and len(near) == 6  # others share signatures, too


def test_similar_sets_pass_the_bitmaps(spark):
    """No two sets of at least 80 % similarity are told apart, whatever the sizes of their bitmaps."""
    draw = np.random.default_rng(2)
    rows = []
    for size in (1, 5, 900, 1020, 1024, 1100, 4000, 8200):
        for _ in range(6):
            a = draw.integers(0, 1 << 62, size).astype(np.uint64)
            drop = int(draw.integers(0, size // 5 + 1))
            extra = int(draw.integers(0, max(0, 5 * (size - drop) // 4 - size) + 1))
            b = np.concatenate([a[drop:], draw.integers(0, 1 << 62, extra).astype(np.uint64)])
            both, union = size - drop, size + extra
            other = draw.integers(0, 1 << 62, len(b)).astype(np.uint64)
            (x, fx), (y, fy), (z, fz) = ((w.tolist(), jaccard.folded_sketches(w, at)[0].tolist()) for w, at in (
                jaccard.parity_sketches(s, np.array([0, len(s)])) for s in (a, b, other)))
            rows.append((100 * both >= 80 * union, size >= 900, len(a), len(b), x, y, z, fx, fy))
    df = spark.createDataFrame(rows, "similar boolean, large boolean, _xn long, _yn long, x array<long>, y array<long>, "
                                     "z array<long>, fx array<long>, fy array<long>")
    df = df.select("*", *(F.col(f"f{s}")[i].alias(f"_{s}m{i}") for s in "xy" for i in range(jaccard.FOLDED)))
    got = df.select("similar", "large", *(jaccard._may_link("_x", "_y", 80, odd).alias(name) for name, odd in (
        ("whole", jaccard._odd(F.col("x"), F.col("y"))), ("turned", jaccard._odd(F.col("y"), F.col("x"))),
        ("folded", jaccard._odd_folded("_x", "_y")), ("unlike", jaccard._odd(F.col("x"), F.col("z")))))).collect()
    assert sum(r.similar for r in got) > 30 and all(r.whole and r.turned and r.folded for r in got if r.similar)
    assert not any(r.unlike for r in got if r.large)


def test_compared_texts_in_pieces(spark, tmp_path, monkeypatch):
    """A set with many partners is compared in several groups."""
    monkeypatch.setattr(jaccard, "PIECE", 3)
    test_jaccard_of_large_groups(spark, tmp_path)


def test_quality(docs, rows):
    got = quality.judge_documents(docs, ["doc_id"]).collect()
    want = Counter((i, *brute.text_counts(t)) for i, t in rows)
    assert Counter((r.doc_id, r._n_words, r._word_chars, r._n_symbols, r._n_dup_lines, r._n_repeat_words) for r in got) == want
    for r in got:
        assert r._base_failed == (r._n_words < 10 or 100 * r._n_repeat_words > 20 * r._n_words)
        assert not (r._base_failed and r._kept)


def test_kneser_ney_probabilities(spark):
    """Symbols' probabilities after any context sum to one (few grams, so no slots collide)."""
    table = spark.createDataFrame([(1, "abba abab baba aab cab abc", "en")], "doc_id long, text string, lang string")
    model = quality.train(table)
    code = quality.lang_code("en")
    for context in ([0, 0, 2], [0, 2, 97], [2, 97, 98], [97, 98, 97], [98, 98, 98], [99, 120, 121]):
        head = sum(c << (8 * (3 - k)) for k, c in enumerate(context))
        gram = np.array([head + s for s in range(256)], np.uint64)
        total = np.exp(model.log_probs(gram, np.full(256, code, np.uint64))).sum()
        assert abs(total - 1) < 1e-3


def _random_words():
    draw = random.Random(30)
    word = lambda: "".join(draw.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(draw.choice([3, 6, 7])))
    return [(k, " ".join(word() for _ in range(20)), ("en", None)[k % 2]) for k in range(2000)]


def test_scores_are_those_of_a_plain_model(spark):
    """With some 250,000 entries, no gram reads the value of another."""
    rows = _random_words()
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = {r.doc_id: r._log_perplexity for r in quality.judge_documents(table, ["doc_id"]).collect()}
    for lang in ("en", None):
        model = brute.KneserNey(w for _, t, x in rows if x == lang for w in t.split())
        for k, t, x in rows:
            if x == lang:
                assert got[k] == pytest.approx(-sum(map(model.log, t.split())) / 20, rel=1e-6)


def test_a_model_in_pieces_scores_alike(spark, docs, monkeypatch):
    table = docs.select("doc_id", "text", "lang").unionByName(
        spark.createDataFrame(_random_words()[:300], "doc_id long, text string, lang string"))
    judged = lambda: sorted(quality.judge_documents(table, ["doc_id"]).collect(), key=lambda r: (r.doc_id is None, r.doc_id, r._n_words))
    whole = judged()
    monkeypatch.setattr(quality, "PIECE", 10_000)
    assert quality.entries(table).count() > 30_000
    held = []
    load = quality.load
    monkeypatch.setattr(quality, "load", lambda *a: held.append(load(*a)) or held[-1])
    for one, two in zip(whole, judged(), strict=True):
        assert two._log_perplexity == pytest.approx(one._log_perplexity, rel=1e-9, abs=1e-12)
        assert all(one[k] == two[k] for k in ("doc_id", "_kept", "_base_failed", *(f"_{k}" for k in quality.COUNTS)))
    assert len(held) > 3 and max(len(m.keys) for m in held) < 20_000


def test_quality_keeps_good_documents(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality.judge_documents(table, ["doc_id"]).join(labels, "doc_id").where("not _base_failed").collect()
    assert np.mean([r._kept for r in got if r.quality == 1]) > 0.99
    assert any(not r._kept for r in got if r.quality == 0)


def test_quality_rejects_each_kind_of_bad_document(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "quality")
    pipes = (F.size(F.split("text", r" \| ")) > 6).alias("pipes")
    got = quality.judge_documents(table, ["doc_id", pipes]).join(labels, "doc_id").where("not _base_failed").collect()
    kept = lambda quality, pipes, least=0: np.mean([
        r._kept for r in got if r.quality == quality and (r.pipes == pipes or quality) and r._n_words >= least])
    assert kept(1, None) > 0.99
    assert kept(0, False) < 0.1
    assert kept(0, True) < 0.85 and kept(0, True, 512) < 0.1


def _cosines(x):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    return x @ x.T


def test_vectors(spark):
    draw = np.random.default_rng(0)
    base = draw.normal(size=(300, 16))
    tight = base[0] + 0.05 * draw.normal(size=(120, 16))
    loose = base[1] + 0.28 * draw.normal(size=(60, 16))
    x = np.concatenate([base, tight, loose, base[:5], base[7:8].repeat(40, axis=0)])
    rows = [(k, v.tolist(), k % 3, 1) for k, v in enumerate(x)]
    odd = [(9000, None, 0, 1), (9001, [0.0] * 16, 0, 1), (9002, [1.0] * 15 + [float("nan")], 0, 1), (9003, [None] * 16, 0, 1),
           (9004, [float("inf")] * 16, 0, 1), (9005, [], 0, 1), (9006, [1.0, 2.0], 0, 1), (None, x[3].tolist(), 0, 1)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int, node int")
    got = {r.vec_id: r for r in vectors.near_vectors(table).collect()}
    full = np.concatenate([x, x[3:4]])
    near = _cosines(full) >= 0.9
    root = brute.groups(len(full), lambda a, b: near[a, b])
    n = near.sum(axis=1) - 1
    found = sum(got[k].n_links for k in range(len(x)))
    assert all(got[k].n_links <= n[k] for k in range(len(x)))
    assert found >= 0.97 * n[:-1].sum()
    right = [got[k].component_id == root[k] for k in range(len(x))]
    assert np.mean(right) > 0.97
    assert all(got[k].kept == (got[k].component_id == k) for k in range(len(x)))
    for k in range(9000, 9007):
        assert (got[k].n_links, got[k].component_id, got[k].kept) == (0, k, True)
    assert got[None].component_id == got[3].component_id and not got[None].kept


def test_vector_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    near = F.transform("embedding", lambda x, i: (x + 0.02 * F.sin(F.col("vec_id") + i)).cast("float"))
    copies = table.where("vec_id % 5 = 0").select((F.col("vec_id") + 1_000_000).alias("vec_id"), near.alias("embedding"))
    found, there = vectors.audit_recall(table.unionByName(copies), 5)
    assert there and found >= 0.9 * there and found <= there


def test_vector_lists_of_far_neighbours(spark):
    """Lists are full where no two vectors are alike, and isolated pairs at the threshold are found."""
    draw = np.random.default_rng(3)
    x = draw.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = draw.normal(size=(400, 64))
    side -= (side * x[:400]).sum(axis=1, keepdims=True) * x[:400]
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cosine = draw.uniform(0.9005, 0.92, size=(400, 1))
    x = np.concatenate([x, cosine * x[:400] + np.sqrt(1 - cosine ** 2) * side])
    nodes = stored(spark.createDataFrame([(k, 1, v.tolist()) for k, v in enumerate(x)], vectors.NODE), "test-nodes")
    lists = vectors.neighbour_lists(nodes, [], len(x)).groupBy("a").count().collect()
    assert len(lists) == len(x) and all(r["count"] >= vectors.LIST for r in lists)
    got = {r.vec_id: r.component_id for r in vectors.near_vectors(nodes, "node", "unit").collect()}
    assert np.mean([got[3000 + k] == got[k] for k in range(400)]) >= vectors.RECALL


@pytest.mark.parametrize("count", [2_000, 100_000, 10_000_000])
def test_leaf_tables_grow_with_the_bits(count):
    bits, tables = vectors.leaf_bits(count)
    assert 1 - (1 - (1 - np.arccos(0.9) / np.pi) ** bits) ** tables >= vectors.RECALL


def test_vectors_of_two_tight_groups(spark):
    """Lists are full of a node's own group; the groups are linked with each other all the same."""
    draw = np.random.default_rng(5)
    one, two = np.zeros(32), np.zeros(32)
    one[0], two[0], two[1] = 1, 0.93, np.sqrt(1 - 0.93 ** 2)
    x = np.concatenate([c + 0.01 * draw.normal(size=(500, 32)) for c in (one, two)])
    near = _cosines(x) >= 0.9
    assert near[:500, 500:].mean() > 0.9
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in vectors.near_vectors(table).collect()}
    assert sum(r.kept for r in got.values()) == 1
    assert all(got[k].n_links == near[k].sum() - 1 for k in range(1000))


def test_mixing(docs, rows):
    table = [(r.doc_id, r.source, len(brute.words(r.text))) for r in docs.collect()]
    sizes = defaultdict(int)
    for _, s, n in table:
        sizes[s] += n
    want = brute.mix_targets(sizes)
    got = mixing.plan_mix(docs).collect()
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter(table)
    taken = defaultdict(int)
    for r in got:
        assert r.target == pytest.approx(want[r.source], rel=1e-9, abs=1e-9)
        assert r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 3 * r.size
        assert (r.position is None) == (r.taken == 0) and (r.position is None or 0 <= r.position <= 1)
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    key = lambda r: (str(r.doc_id), r.source or "", r.taken, r.position or 0)
    assert sorted(map(key, got)) == sorted(map(key, mixing.plan_mix(docs).collect()))


@pytest.mark.parametrize("knots", mixing.SCHEDULES)
def test_positions_invert_the_schedule(spark, knots):
    shares = [k / 50 for k in range(51)]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in shares], "x double")
           .select(mixing.position(F.col("x"), knots)).collect()]
    t = np.linspace(0, 1, 20001)
    w = np.interp(t, *zip(*knots))
    total = np.concatenate([[0], np.cumsum((w[1:] + w[:-1]) / 2)])
    assert np.allclose(got, np.interp(shares, total / total[-1], t), atol=1e-3)


def test_mixed_documents(docs):
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    most = Counter(r.doc_id for r in out.collect())
    have = Counter(r.doc_id for r in docs.collect())
    assert all(n <= 3 * have[i] for i, n in most.items())


def test_row_ids_of_passes_that_see_other_orders(spark):
    """A table whose rows come in another order at each pass, as after a change of splits."""
    draw = random.Random(12)
    texts = [prose(draw, 60) for _ in range(40)]
    texts += [t + " one more" for t in texts[:20]] + texts[20:30]
    plain = spark.createDataFrame([(k, t, "web") for k, t in enumerate(texts)],
                                  "doc_id long, text string, source string").coalesce(1)

    def shuffle(batches):
        for batch in batches:
            yield batch.take(np.random.default_rng().permutation(len(batch)))

    moving = plain.mapInArrow(shuffle, plain.schema)
    for run in (lambda d: lines.delete_repeats(d, ["doc_id"]), substrings.remove_repeats, jaccard.keep_one, mixing.plan_mix):
        key = lambda r: r.doc_id
        assert sorted(run(moving).collect(), key=key) == sorted(run(plain).collect(), key=key)


def test_mix_order_does_not_follow_the_splits(spark):
    rows = [(None, f"word{k} and more {'x ' * (k % 5)}", "web" if k % 3 else "code") for k in range(60)]
    one, two = (spark.createDataFrame(r, "doc_id long, text string, source string").coalesce(1) for r in (rows, rows[::-1]))
    assert [r.text for r in mixing.mixed_documents(one).collect()] == [r.text for r in mixing.mixed_documents(two).collect()]


def test_the_stream_follows_the_plan(spark, docs):
    """Copies of each row as often as a plain reading of the plan says, in order of position."""
    table = docs.withColumn("a.map", F.expr("map('k', coalesce(lang, ''))")).unionByName(
        docs.where("doc_id = 3").withColumn("a.map", F.expr("map('k', 'other')")))
    plan = defaultdict(list)
    for r in mixing.plan_mix(table).collect():
        plan[(r.doc_id, r.source, r.size)].append(int(np.floor(r.taken / r.size + 0.5)) if r.size else 0)
    out = mixing.mixed_documents(table)
    assert out.columns == table.columns and out.dtypes == table.dtypes
    got, size = Counter(), lambda r: len(brute.words(r.text))
    stream = out.collect()
    for r in stream:
        got[(r.doc_id, r.source, size(r))] += 1
    assert got == Counter({k: sum(v) for k, v in plan.items() if sum(v)})
    assert {r["a.map"]["k"] for r in stream if r.doc_id == 3} <= {"de", "other"}


def test_the_plan_is_folded_from_the_stream(spark, tmp_path):
    """Each document's words, copies and first place, counted again in the sorted stream of copies."""
    draw = random.Random(21)
    rows = [(k, prose(draw, draw.choice([3, 20, 70])), ["web", "code", "books", None][k % 4 if k % 5 else 0]) for k in range(90)]
    table = spark.createDataFrame([*rows, *rows[:4], (99, None, "web")], "doc_id long, text string, source string").coalesce(1)
    table.write.parquet(str(tmp_path / "documents.parquet"))
    got = mixing.op10_mix(spark, str(tmp_path)).collect()
    assert len(got) == 95
    plan = mixing._each(mixing._plan(mixing._items(table, F.lit(0).cast("long"), F.lit(0).cast("long"))))
    stream = sorted(mixing.mix_stream(plan, ["doc_id", "size"]).collect(), key=lambda r: r._place)
    assert [r._place for r in stream] == list(range(len(stream)))
    assert [r._position for r in stream] == sorted(r._position for r in stream)
    assert sum(r.copies for r in got) == len(stream)
    words = lambda rows, n: Counter({i: sum(n(r) for r in rows if r.doc_id == i) for i in range(100)})
    assert words(got, lambda r: r.taken) == words(stream, lambda r: r._words)
    for r in got:
        assert (r.place is None) == (r.copies == 0) == (r.taken == 0) and r.copies == (-(-r.taken // r.size) if r.size else 0)
        if r.copies:
            assert (stream[r.place].doc_id, stream[r.place]._position) == (r.doc_id, r.position)


def test_many_equal_rows_are_one_item(spark, monkeypatch):
    rows = [(None, "same words here", "web")] * 50 + [(k, f"text number {k}", "web") for k in range(30)] + [(9, "a b", "code")] * 7
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1)
    monkeypatch.setattr(mixing, "BLOCK", 4)
    got = mixing.plan_mix(table).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    for source in ("web", "code"):
        taken = sum(r.taken for r in got if r.source == source)
        target = next(r.target for r in got if r.source == source)
        assert abs(taken - target) <= 1
    equal = [r.taken for r in got if r.doc_id is None]
    assert sum(t % 3 != 0 for t in equal) <= 1  # but for one, each row is taken whole or not at all
    copies = Counter(r.doc_id for r in mixing.mixed_documents(table).collect())
    assert copies[9] == 21 and copies[None] == sum((t + 1) // 3 for t in equal)


def test_a_widely_held_line_stays_once(spark):
    draw = random.Random(8)
    footer, rare, short = "All rights reserved by us.", "A line that few have", "See also"
    own = lambda n: prose(draw, n).replace("\n", " ")
    texts = ["\n".join([own(9), *([footer] * (1 + (k % 4 == 0)) if k % 2 else []), own(8), *([rare] if k in (3, 30) else []),
                        own(6), short, own(7)]) for k in range(60)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r._kept for r in lines.delete_repeats(table, ["doc_id"]).collect()}
    assert sum(t.split("\n").count(footer) for t in got.values()) == 1 and footer in got[1]
    assert sum(rare in t for t in got.values()) == 2 and all(short in t for t in got.values())
    want = brute.deleted_lines(list(enumerate(texts)))
    for k, (text, gone, n) in enumerate(want):
        assert got[k] == "\n".join(x for j, x in enumerate(text) if j not in gone)


def test_the_audit_asks_other_nodes_each_round(spark, monkeypatch):
    """With the search switched off only audits find links: they must not accept what they added themselves."""
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(120, 16))
    x = np.concatenate([centres, centres + draw.normal(size=centres.shape) * 0.05])
    cosine = (x @ x.T) / np.outer(*[np.linalg.norm(x, axis=1)] * 2)
    pairs = int(((cosine >= 0.9) & ~np.eye(len(x), dtype=bool)).sum())
    nothing = spark.createDataFrame([], "a long, b long, cosine double")
    monkeypatch.setattr(vectors, "ASKED", 60)
    monkeypatch.setattr(vectors, "neighbour_lists", lambda *a: nothing)
    monkeypatch.setattr(vectors, "crowded_links", lambda *a: nothing.select("a", "b"))
    monkeypatch.setattr(vectors, "_meet", lambda *a: nothing)
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = vectors.near_vectors(table).collect()
    assert sum(r.n_links for r in got) >= 0.9 * pairs > 200
