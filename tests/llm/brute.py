"""Plain Python versions of the set-wise operators."""

import hashlib
import re
from collections import Counter, defaultdict


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, k=5):
    w = [x for x in re.split(r"[\x20\x09-\x0d]+", lower(text)) if x]
    return frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def near_components(rows):
    """rows (doc_id, text) -> {doc_id: (set size, smallest id reachable)}"""
    rows = sorted(set(rows), key=lambda r: r[0])
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    where = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    common = Counter((a, b) for ids in where.values() for k, b in enumerate(ids) for a in ids[:k])
    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def without_repeats(texts, length):
    """Per text: (bytes, removed, spans, sha256 of the rest, the rest)."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[p:p + length] for b in data for p in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                gone[p:p + length] = b"\1" * length
        rest = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for p in range(len(b)) if gone[p] and not (p and gone[p - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest(), rest))
    return out


def edit_distance_to_part(item, text):
    """Least edit distance of item to any part of text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        last, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (a != b)))
    return min(row)
