"""Plain versions of the operators, for comparison on small tables."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def rows_of(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]


def windows_removed(units, size):
    """Masks of what windows cover that start at two places or more."""
    seen = Counter(tuple(u[i:i + size]) for u in units for i in range(len(u) - size + 1))
    out = []
    for u in units:
        m = [False] * len(u)
        for i in range(len(u) - size + 1):
            if seen[tuple(u[i:i + size])] > 1:
                m[i:i + size] = [True] * size
        out.append(m)
    return out


def substring_rows(rows, size=35):
    units = [WORD.findall(t) for _, t in rows]
    return sorted(((i, len(u), sum(m), hashlib.sha256(" ".join(w for w, g in zip(u, m) if not g).encode()).hexdigest())
                   for (i, _), u, m in zip(rows, units, windows_removed(units, size))), key=repr)


def byte_rows(rows, size=400):
    data = [t.encode() for _, t in rows]
    seen = Counter(d[i:i + size] for d in data for i in range(len(d) - size + 1))
    out = []
    for (i, _), d in zip(rows, data):
        m = np.zeros(len(d), bool)
        for s in range(len(d) - size + 1):
            if seen[d[s:s + size]] > 1:
                m[s:s + size] = True
        runs = int((m & ~np.r_[False, m[:-1]]).sum()) if len(m) else 0
        out.append((i, len(d), int(m.sum()), runs, hashlib.sha256(np.frombuffer(d, np.uint8)[~m].tobytes()).hexdigest()))
    return sorted(out, key=repr)


def shingles(text, size=5):
    w = WORD.findall(text.translate(LOWER))
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def near_rows(rows, percent=85):
    s = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(s)):
        for j in range(i):
            both = len(s[i] & s[j])
            if s[i] and s[j] and 100 * both >= percent * (len(s[i]) + len(s[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = d if least.get(r) is None else least[r] if d is None else min(d, least[r])
    out = []
    for i, (d, _) in enumerate(rows):
        c = least[find(i)] if s[i] else d
        out.append((d, len(s[i]), c, d is not None and d == c))
    return sorted(out, key=repr)


def quality_counts(text):
    w = WORD.findall(text)
    three = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    m = [False] * len(w)
    for i in range(len(w) - 2):
        if three[tuple(w[i:i + 3])] > 1:
            m[i:i + 3] = [True] * 3
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, sum(m)


def held(doc_id, mod):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % mod == 0
