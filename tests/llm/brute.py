"""Plain Python versions of the operators' results, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOKEN = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def low(text):
    return (text or "").translate(LOWER)


def fold(doc_id, parts):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % parts


def exact(rows):
    """doc_id, keep_id, group_size, kept, sha for rows (doc_id, text)."""
    norm = [(d, re.sub("[\x20\x09-\x0D]+", " ", t or "")) for d, t in rows]
    ids, size = defaultdict(list), Counter(t for _, t in norm)
    for d, t in norm:
        if d is not None:
            ids[t].append(d)
    out = []
    for d, t in norm:
        keep = min(ids[t]) if ids[t] else None
        out.append((d, keep if size[t] > 1 else d, size[t], d == keep, hashlib.sha256(t.encode()).hexdigest()))
    return out


def shingles(text, k):
    w = TOKEN.findall(low(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def near(rows, k, threshold=80):
    """{row number: (set size, component)} for rows (doc_id, text), all pairs compared."""
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = root(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return [(d, len(s), least.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def leaks(rows, items, size=10):
    """(doc_id, n_words, n_hit, n_items, sha, contaminated)."""
    windows = defaultdict(set)
    for item, text in items:
        w = WORD.findall(low(text))
        if w:
            for i in range(max(1, len(w) - size + 1)):
                windows[tuple(w[i:i + size])].add(item)
    lengths = {len(w) for w in windows}
    out = []
    for d, t in rows:
        w = WORD.findall(low(t))
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        names = ",".join(sorted(str(x) for x in found if x is not None))
        out.append((d, len(w), len(hit), len([x for x in found if x is not None]), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return out


def repeats(rows, length=200):
    """(doc_id, n_bytes, n_removed, n_spans, sha)."""
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for (name, _), d in zip(rows, data):
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = b"\x01" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((name, len(d), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(d, gone) if not g)).hexdigest()))
    return out


def unigram(rows, parts=5):
    """{(doc_id, text): (n_tokens, n_known, N, base)}."""
    tokens = [(d, TOKEN.findall(low(t)) + [None]) for d, t in rows]
    count = Counter(x for d, ts in tokens if fold(d, parts) != 1 for x in ts)
    n, v = sum(count.values()), len(count)
    return [(d, len(ts), sum(count[x] > 0 for x in ts), n, sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in ts)) for d, ts in tokens]


def phrases(text, table):
    """(n_words, places, first, last, labels)."""
    w = WORD.findall(low(text))
    places, labels = [], set()
    for phrase, label in table.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), labels


def templates(text, table, threshold):
    """Labels and best containment over the lines of a text."""
    best, labels = 0.0, set()
    for line in (text or "").split("\n"):
        w = set(WORD.findall(low(line)))
        for label, t in table:
            t = set(WORD.findall(low(t)))
            if len(w & t) >= math.ceil(threshold * len(t) - 1e-9):
                labels.add(label)
                best = max(best, len(w & t) / len(t))
    return labels, best
