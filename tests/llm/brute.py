"""Plain-Python versions of the operators, for small tables."""
import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower_ascii(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def near_components(rows, k=5, percent=80):
    """rows: (doc_id, text) -> {doc_id: (n_shingles, component_id)}"""
    sets = []
    for _, t in rows:
        w = WORD.findall(lower_ascii(t or ""))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    index = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            index[g].append(i)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, s in enumerate(sets):
        common = Counter(j for g in s for j in index[g] if j < i)
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            low[r] = min(low.get(r, d), d)
    return [(d, len(s), low.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def repeated_cover(rows, window=35):
    """rows: (doc_id, text) -> [(doc_id, n_words, n_removed, kept_sha256)]"""
    words = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((d, len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out
