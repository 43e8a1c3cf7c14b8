"""Plain versions of the corpus operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall(text or "")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def base_secrets(text):
    """(counts by kind, digest) of the base patterns."""
    text, found = text or "", []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                         text, re.IGNORECASE | re.ASCII):
        if len(m[2]) >= 12:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    kinds = ("assign", "access", "hex")
    spans = [f"{kinds[k]}:{s}:{e}" for s, k, e in sorted(found)]
    return [sum(x[1] == k for x in found) for k in range(3)], sha(",".join(spans)), spans


def kept_words(rows, span=13):
    """[(doc_id, words, removed flags)] for (doc_id, text) rows; NULL ids neither give nor lose windows."""
    first = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - span + 1):
            key = tuple(w[k:k + span])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - span + 1):
            if i is not None and first[tuple(w[k:k + span])] < i:
                gone[k:k + span] = [True] * span
        out.append((i, w, gone))
    return out


def deleted_lines(rows, lone=20):
    """[(lines, indexes of deleted lines, lines with a word)] for (doc_id, text) rows in table order."""
    order = sorted(range(len(rows)), key=lambda r: (rows[r][0] is not None, rows[r][0] or 0, r))
    place = {r: p for p, r in enumerate(order)}
    worded = {r: [k for k, x in enumerate((rows[r][1] or "").split("\n")) if WORD.search(x)] for r in place}
    line = {r: (rows[r][1] or "").split("\n") for r in place}
    holders = Counter(x for r in place for x in {line[r][k] for k in worded[r]})
    one, two = {}, {}
    for r in order:
        for p, k in enumerate(worded[r]):
            one.setdefault(line[r][k], (place[r], p))
            if p + 1 < len(worded[r]):
                two.setdefault((line[r][k], line[r][worded[r][p + 1]]), (place[r], p))
    out = []
    for r in range(len(rows)):
        gone = set()
        for p, k in enumerate(worded[r]):
            n = len(words(line[r][k]))
            if (n >= lone or (n >= 3 and n * holders[line[r][k]] >= 60)) and one[line[r][k]] < (place[r], p):
                gone.add(p)
            if p + 1 < len(worded[r]) and two[line[r][k], line[r][worded[r][p + 1]]] < (place[r], p):
                gone |= {p, p + 1}
        out.append((line[r], {worded[r][p] for p in gone}, len(worded[r])))
    return out


def shingles(text, n=5):
    w = words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def groups(n, linked):
    """Component root of each of n rows."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(n):
        for b in range(a):
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(x) for x in range(n)]


def similar(x, y, percent=80):
    both = len(x & y)
    return bool(x) and bool(y) and 100 * both >= percent * (len(x) + len(y) - both)


def text_counts(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    five = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    covered = set()
    for k in range(len(w) - 4):
        if five[tuple(w[k:k + 5])] > 1:
            covered.update(range(k, k + 5))
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def mix_targets(sizes: dict) -> dict:
    """Targets by source, by sharing out the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    left, open_, target = float(sum(sizes.values())), set(names), {s: 0.0 for s in names}
    while open_ and left > 1e-9:
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_}
        left = 0.0
        for s, x in share.items():
            target[s] += x
            if target[s] >= 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
        open_ = {s for s in open_ if target[s] < 3 * sizes[s]}
    return target


def by_id(rows, key="doc_id"):
    out = defaultdict(list)
    for r in rows:
        out[r[key]].append(r)
    return out


class KneserNey:
    """Modified Kneser-Ney model of up to four symbols inside words, by dictionaries."""

    def __init__(self, words) -> None:
        self.counts = [Counter() for _ in range(5)]
        for word in words:
            self.counts[4].update(self.grams(word))
        for k in (1, 2, 3):
            self.counts[k].update(g[1:] for g in {g[-k - 1:] for g in self.counts[4] if len(g) > k})
        self.cuts, self.all, self.cut_all = [], [], []
        for counts in self.counts:
            n = Counter(counts.values())
            y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else 0.5
            cut = [max(0.0, min(i, i - (i + 1) * y * n[i + 1] / n[i] if n[i] else 0.5 * i)) for i in (1, 2, 3)]
            self.cuts.append(cut)
            all_, cut_all = Counter(), Counter()
            for g, c in counts.items():
                all_[g[:-1]] += c
                cut_all[g[:-1]] += min(cut[min(c, 3) - 1], c)
            self.all.append(all_)
            self.cut_all.append(cut_all)

    @staticmethod
    def grams(word: str) -> list[tuple]:
        symbols = (2, *word.encode(), 3)
        return [symbols[max(0, i - 3):i + 1] for i in range(1, len(symbols))]

    def step(self, level: int, g: tuple, lower: float) -> float:
        c, context = self.counts[level][g], g[:-1]
        return (c - min(self.cuts[level][min(c, 3) - 1], c) + self.cut_all[level][context] * lower) / self.all[level][context]

    def log(self, word: str) -> float:
        out = 0.0
        for g in self.grams(word):
            p = 1 / 256
            for k in range(1, len(g)):
                p = self.step(k, g[-k:], p)
            out += math.log(self.step(4, g, p))
        return out
