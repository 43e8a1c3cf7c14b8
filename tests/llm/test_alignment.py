"""Alignment against the tokenizers run on whole texts, and a plain two-pointer walk."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import alignment
from strata.llm.packing import tokenizer_path
from strata.llm.words import chunks

ZERO = (0, 0, 0, 0, "", 0, 0)


class Plain:
    """Both tokenizers on whole texts."""

    def __init__(self) -> None:
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer, decoders

        self.a = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.byte = {c: b for b, c in zip([*shown, *(b for b in range(256) if b not in shown)],
                                          [*map(chr, shown), *map(chr, range(256, 256 + 256 - len(shown)))])}
        assert decoders.ByteLevel().decode([c for c in self.byte if self.byte[c] < 128][:3])

    def tokens(self, text: str) -> tuple[list, list] | None:
        ids = self.a.encode(" " + text, add_special_tokens=False).ids
        a = [(i, bytes(self.byte[c] for c in self.a.id_to_token(i))) for i in ids]
        b = [(i, bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode())
             for i in self.b.encode(text) for p in [self.b.id_to_piece(i)]]
        want = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == want == b"".join(x for _, x in b) else None


def plain(texts: list[str | None]) -> list[tuple]:
    tokenizers, found, holders = Plain(), [], Counter()
    for text in texts:
        both = tokenizers.tokens(text) if text else None
        if not both:
            found.append(None)
            continue
        ends = [set(np.cumsum([len(x) for _, x in side]).tolist()) for side in both]
        groups, now, at = [], [[], []], [0, 0]
        marks = sorted(ends[0] & ends[1])
        position = [np.cumsum([len(x) for _, x in side]).tolist() for side in both]
        for mark in marks:
            for k in (0, 1):
                while at[k] < len(both[k]) and position[k][at[k]] <= mark:
                    now[k].append(both[k][at[k]][0])
                    at[k] += 1
            groups.append(now)
            now = [[], []]
        links = Counter((x, y) for g in groups for x in g[0] for y in g[1])
        holders.update(links.keys())
        found.append((both, groups, links))
    top = {}
    for (x, _), n in holders.items():
        top[x] = max(top.get(x, 0), n)
    out = []
    for row in found:
        if row is None:
            out.append(ZERO)
            continue
        both, groups, links = row
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        out.append((len(both[0]), len(both[1]), len(groups), sum(links.values()), hashlib.sha256(text.encode()).hexdigest(),
                    sum(n for p, n in links.items() if holders[p] == top[p[0]]), sum(n * holders[p] for p, n in links.items())))
    return out


def digest(rows) -> Counter:
    return Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256, r.n_best, r.count_sum) for r in rows)


def test_alignment(docs, rows):
    got = alignment.align_documents(docs)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    assert digest(got.collect()) == Counter((i, *x) for (i, _), x in zip(rows, plain([t for _, t in rows])))


ODD = ["  two  spaces ", " ", "   ", "a ", " \n x", "\n", "x\n y", "x \n\t y", "tab\tsep  end  ", "  x", "x  y", "a　 b", "▁ mark", "a▁b",
       "don't we'll I'm 's", "é è à  ü", "日本 語 です", "🙂 🙂🙂", "​ zero", "a\x00 b", "<s> </s> <unk> <0x41> <|endoftext|> x", "ﬁ Ａ",
       "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "1234567890 " * 30, "=" * 500, "x\x1c y \x85 z", "﻿ bom", "é a"]


def test_odd_texts_and_long_ones(spark):
    draw = random.Random(5)
    alphabet = ["a", "b", " ", "  ", "é", "ß", "\n", "\t", ".", ",", "1", "日", "🙂", "'s", "the", " of", " ", "ing", "-", "_"]
    texts = ODD + ["".join(draw.choice(alphabet) for _ in range(draw.randrange(1, 90))) for _ in range(250)]
    texts += ["word " * 30_000, "".join(draw.choice(alphabet) for _ in range(60_000)), "z" * 60_000, None, ""]
    table = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").coalesce(2)
    assert digest(alignment.align_documents(table).collect()) == Counter((k, *x) for k, x in enumerate(plain(texts)))


def test_a_wide_group_is_counted_like_a_small_one(monkeypatch):
    sides = alignment._sides(tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    column = pa.array(ODD + ["Straßenbahn été naïve 12345"])
    (chunk,) = chunks(column)
    one = alignment.align(chunk, *sides)
    monkeypatch.setattr(alignment, "WIDE", 0)
    other = alignment.align(chunk, *sides)
    assert one.keys.tolist() == other.keys.tolist() and one.times.tolist() == other.times.tolist()
    monkeypatch.setattr(alignment, "LANE", 1)
    monkeypatch.setattr(alignment, "SOME", 3)
    for side in sides:
        side.forget()
    assert alignment.align(chunk, *sides).digests == one.digests


@pytest.mark.parametrize("cuts", [([2, 3, 1], [1, 4, 1]), ([1] * 6, [6]), ([3], [1, 2])])
def test_lockstep(cuts):
    a, b = (alignment.Stream(np.arange(len(c)), np.array(c), np.array([0, len(c)])) for c in cuts)
    got = alignment.lockstep(a, b, np.array([0]), np.array([1]))
    ends = sorted(set(np.cumsum(cuts[0]).tolist()) & set(np.cumsum(cuts[1]).tolist()))
    want = [(int(np.sum(np.cumsum(cuts[0]) <= e)), int(np.sum(np.cumsum(cuts[1]) <= e))) for e in ends]
    assert list(zip(got[1].tolist(), got[3].tolist())) == want


def test_an_empty_table_and_clashing_names(no_docs, spark):
    assert alignment.align_documents(no_docs).collect() == []
    row = spark.createDataFrame([(1, "the cat", 3, "p", [1])], "doc_id int, text string, chunk long, pairs string, held array<int>")
    assert alignment.align_documents(row).count() == 1


def test_pieces_join_to_a_chunk():
    sides = alignment._sides(tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    column = pa.array([*ODD, None, "the cat", "été"])
    whole = alignment.align(next(chunks(column)), *sides)
    parts = alignment.joined([alignment.align(c, *sides) for c in chunks(column, 20)])
    for name in ("n_a", "n_b", "n_groups", "n_links", "keys", "times"):
        assert getattr(whole, name).tolist() == getattr(parts, name).tolist(), name
    assert whole.digests == parts.digests
