"""Ranked search against a plain scorer over all documents."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from strata.llm import ranking

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = {k: k + 32 for k in range(65, 91)}


def split(text: str | None) -> list[str]:
    return TERM.findall((text or "").translate(LOW))


def plain(documents: list[tuple], items: list[tuple]) -> Counter:
    bags = [(i, Counter(split(t))) for i, t in documents]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    held = Counter(t for _, b, _ in bags for t in b)
    n, length = len(bags), sum(s for _, _, s in bags)
    out = Counter()
    for item, text in items:
        scored = []
        for i, bag, size in bags:
            m = 75 + (25 * size * n) // length
            score = sum(times * math.floor(1000 * math.log((2 * n + 2) / (2 * held[t] + 1)))
                        * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 12 * m))
                        for t, times in Counter(split(text)).items() if t in bag)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(scored)[:20], 1):
            out[(item, rank, i, -score)] += 1
    return out


def table(spark, rows, name="item_id"):
    return spark.createDataFrame([(*r, "x", 3) for r in rows], f"{name} long, text string, term string, rank int")


ITEMS = [(1, "the river and the stone of winter"), (2, "River RIVER river"), (3, None), (4, ""), (5, "nothing zzz"),
         (6, "the of and"), (7, "日本語 の 文 Über été"), (1, "light house"), (8, "garden 42 walk 17 signal 301"),
         (None, "bridge cloud"), (6, "the of and"), (9, "x\x1cy don't 12345")]


@pytest.mark.parametrize("segment", [1 << 15, 7])
def test_ranking(spark, docs, rows, monkeypatch, segment):
    want = plain(rows, ITEMS)
    units = []
    real = ranking._search

    def small(*args):  # the workers get the limit with the function
        units.append(args)
        return real(*args)
    monkeypatch.setattr(ranking, "_search", small)
    monkeypatch.setattr(ranking, "SEGMENT", segment)
    got = ranking.rank_documents(docs.repartition(3), table(spark, ITEMS))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(tuple(r) for r in got.collect()) == want
    assert len(units) == 1


def test_items_in_several_blocks(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(ranking, "BLOCK", 60)
    assert Counter(tuple(r) for r in ranking.rank_documents(docs, table(spark, ITEMS)).collect()) == plain(rows, ITEMS)


def test_nothing_to_search(spark, docs, no_docs):
    assert ranking.rank_documents(no_docs, table(spark, ITEMS)).collect() == []
    assert ranking.rank_documents(docs, table(spark, [])).collect() == []
    assert ranking.rank_documents(docs, table(spark, [(1, None), (2, "qqqq")])).collect() == []


def segments(seed: int, size: int):
    """A random segment and its queries' units, with the scores of all documents by plain sums."""
    draw = np.random.default_rng(seed)
    width = 12
    term, doc = np.nonzero(draw.random((width, size)) < draw.random((width, 1)) * 0.6)
    impact = draw.integers(0, 50, len(term)) * draw.integers(1, 30, width)[term]
    weights = draw.integers(0, 9, width)
    for _ in range(30):
        own = np.sort(draw.choice(width, draw.integers(1, width), replace=False))
        query = ranking.Query(0, 0, own, draw.integers(1, 4, len(own)))
        units = ranking.pairs_of(query, weights)
        segment = ranking.Segment(size, term, doc, impact, width, set(units))
        full = np.zeros(size, np.int64)
        for unit in units:
            for k in range(0, len(unit), 2):
                at = term == unit[k]
                np.add.at(full, doc[at], impact[at] * unit[k + 1])
        yield segment, units, full


@pytest.mark.parametrize("seed", range(4))
def test_no_document_is_skipped_that_could_rank(seed):
    for segment, units, full in segments(seed, 200):
        for floor in (0, 1, int(np.median(full)), int(np.sort(full)[-20]), int(full.max()), int(full.max()) + 1):
            docs, scores = segment.search(units, floor)
            assert (full[docs] == scores).all() and not segment.sums.any()
            found = dict(zip(docs.tolist(), scores.tolist()))
            last = max(floor, 1, int(np.sort(full)[-20]))
            assert {d: s for d, s in enumerate(full.tolist()) if s >= last} == {d: s for d, s in found.items() if s >= last}


def test_pair_bounds_hold_and_are_tighter():
    tighter = 0
    for segment, units, full in segments(9, 60):
        for unit in units:
            parts = np.zeros(segment.size, np.int64)
            for k in range(0, len(unit), 2):
                docs, impact = segment.list(unit[k])
                parts[docs] += impact * unit[k + 1]
            assert parts.max() == segment.bound(unit)  # the bound is reached by some document
            tighter += segment.bound(unit) < sum(int(segment.most[unit[k]]) * unit[k + 1] for k in range(0, len(unit), 2))
    assert tighter > 10


def test_ties_rank_by_id(spark):
    docs = spark.createDataFrame([(k, "same words here") for k in [*range(60, 0, -1), None, 5]] + [(None, "other")],
                                 "doc_id long, text string")
    got = ranking.rank_documents(docs, table(spark, [(1, "words same")])).orderBy("rank").collect()
    assert [r.doc_id for r in got] == [1, 2, 3, 4, 5, 5, *range(6, 20)]
    assert [r["rank"] for r in got] == list(range(1, 21)) and len({r.score for r in got}) == 1


def test_a_very_long_text(spark):
    draw = random.Random(2)
    words = [f"w{draw.randrange(5000)}" for _ in range(400_000)]
    docs = [(1, " ".join(words)), (2, "w17 w18"), (3, "z" * 2_000_000 + " w17"), (4, "nothing here")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    items = [(1, "w17 w18 w19"), (2, "z" * 2_000_000)]
    assert Counter(tuple(r) for r in ranking.rank_documents(frame, table(spark, items)).collect()) == plain(docs, items)


def test_query_terms_with_their_counts():
    vocabulary, queries = ranking.read_items([(4, "b a B"), (5, None), (6, "c")])
    assert len(vocabulary) == 3 and [q.item for q in queries] == [4, 5, 6]
    assert sorted(queries[0].times.tolist()) == [1, 2] and len(queries[1].terms) == 0
    assert defaultdict(int, Counter(q.number for q in queries)) == {0: 1, 1: 1, 2: 1}
