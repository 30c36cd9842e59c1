"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def shingles(text, size):
    w = words((text or "").translate(LOWER))
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def components(texts, size, percent):
    """Least id reachable by links, for a dict id -> text."""
    sets = {i: shingles(t, size) for i, t in texts.items()}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in {(a, b) for group in holders.values() for a in group for b in group if a < b}:
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            one, two = root(a), root(b)
            parent[max(one, two)] = min(one, two)
    return {i: root(i) for i in sets}


def without_repeats(docs, least=50):
    """(id, text) rows in order of id with later repeats of line runs cut out."""
    seen, out = {}, []
    for doc, text in docs:
        lines = (text or "").split("\n")
        used = [i for i, line in enumerate(lines) if words(line)]
        sizes = [len(words(lines[i])) for i in used]
        windows = set()
        for a in range(len(used)):
            for step in (1, -1):
                total, b = 0, a
                while 0 <= b < len(used):
                    total += sizes[b]
                    if total >= least:
                        windows.add((min(a, b), max(a, b)))
                        break
                    b += step
        gone = set()
        for a, b in sorted(windows):
            key = tuple(lines[i] for i in used[a : b + 1])
            first = seen.setdefault(key, (doc, text, a, b))
            if first[:2] != (doc, text) or a > first[3]:
                gone.update(range(used[a], used[b] + 1))
        out.append((doc, None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone)))
    return out


def leaks(docs, items, percent=80):
    """{(doc, item): shared shingles}."""
    sets = {i: s for i, t in items if (s := {x for x in shingles(t, 5) if len(x) == 5})}
    out = {}
    for doc, text in docs:
        own = shingles(text, 5)
        for item, s in sets.items():
            if 100 * len(s & own) >= percent * len(s):
                out[doc, item] = len(s & own)
    return out


class KneserNey:
    """The bigram model on dictionaries."""

    def __init__(self, texts):
        self.count, self.pair = Counter(), Counter()
        for text in texts:
            tokens = self.tokens(text)
            self.count.update(tokens)
            self.pair.update(zip(["<begin>", *tokens[:-1]], tokens, strict=True))
        self.n, self.v = sum(self.count.values()), len(self.count)
        self.context, self.follow, self.before = Counter(), defaultdict(lambda: [0, 0, 0]), Counter()
        for (u, w), k in self.pair.items():
            self.context[u] += k
            self.follow[u][min(k, 3) - 1] += 1
            self.before[w] += 1
        self.d, self.lower = self.discount(self.pair.values()), self.discount(self.before.values())
        self.weight = sum(self.lower[min(b, 3)] for b in self.before.values()) / max(len(self.pair), 1)

    @staticmethod
    def tokens(text):
        return [*words((text or "").translate(LOWER)), " end"]

    @staticmethod
    def discount(values):
        of = [sum(v == k for v in values) for k in (1, 2, 3, 4)]
        if min(of) == 0:
            return [0, 0.5, 0.75, 0.9]
        y = of[0] / (of[0] + 2 * of[1])
        return [0, *[min(max(k - (k + 1) * y * of[k] / of[k - 1], 0.05), k - 0.05) for k in (1, 2, 3)]]

    def probability(self, u, w):
        low = max(self.before[w] - self.lower[min(self.before[w], 3)], 0) / len(self.pair) + self.weight / (self.v + 1)
        if not self.context[u]:
            return low
        k, total = self.pair[u, w], self.context[u]
        share = sum(a * b for a, b in zip(self.d[1:], self.follow[u], strict=True)) / total
        return max(k - self.d[min(k, 3)], 0) / total + share * low

    def score(self, text):
        tokens = self.tokens(text)
        return sum(math.log10(self.probability(u, w)) for u, w in zip(["<begin>", *tokens[:-1]], tokens, strict=True))

    def base(self, text):
        return sum(math.log10((self.count[w] + 0.1) / (self.n + 0.1 * (self.v + 1))) for w in self.tokens(text))


def runs(words_, least=12):
    """(start, length, smallest period) of every maximal stretch that repeats."""
    n, best = len(words_), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words_[j] == words_[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                best.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in best.items())


def planted(doc, text):
    """The words of a text, with the stretch that every tenth repeats."""
    w = words(text)
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    if h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [*w[:a], *(w[a + (i - a) % p] for i in range(a, n))]


def run_digests(doc, text):
    w = planted(doc, text)
    found = runs(w)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    exponent = best[1] * 1000 // best[2] if best else None
    return (len(found), *(best or (None,) * 3), exponent, sha("".join("%d,%d,%d\n" % r for r in found)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def merkle(rows, arity=8):
    """{index of row: (leaf, subroot, root, siblings in order, folded from the tampered leaf)} for rows of (doc_id, source, lang, n_chars, text)."""
    frame = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    digest = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()
    leaf = lambda row: digest(*map(frame, row))

    def climb(nodes):
        """The top, and for each node its steps as (left, right)."""
        steps, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
        while len(level) > 1:
            for k, place in enumerate(at):
                first = place // arity * arity
                steps[k].append(("".join(level[first:place]), "".join(level[place + 1 : first + arity])))
                at[k] = place // arity
            level = [digest(*level[i : i + arity]) for i in range(0, len(level), arity)]
        return level[0], steps

    groups = defaultdict(list)
    for k, row in enumerate(rows):
        groups[row[2]].append(k)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    out, tops = {}, {}
    for name in names:
        groups[name].sort(key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, leaf(rows[k])))
        tops[name] = climb([leaf(rows[k]) for k in groups[name]])
    root, high = climb([tops[name][0] for name in names])
    for name, above in zip(names, high, strict=True):
        for k, steps in zip(groups[name], tops[name][1], strict=True):
            row = rows[k]
            low = row[4] is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            node = leaf((*row[:4], row[4].translate(LOWER))) if low else leaf(row)
            for left, right in [*steps, *above]:
                node = digest(left, node, right)
            out[k] = (leaf(row), tops[name][0], root, "".join(a + b for a, b in [*steps, *above]), node)
    return out
