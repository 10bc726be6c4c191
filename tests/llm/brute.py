"""Plain single-machine versions of the operators, for small tables."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def split(text):
    return WORD.findall(text or "")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def repeated_words(rows, width=35):
    """(doc_id, n_words, n_removed, digest) for rows of (doc_id, text)."""
    count = Counter()
    split_rows = [(i, split(t)) for i, t in rows]
    for _, words in split_rows:
        count.update(tuple(words[k:k + width]) for k in range(len(words) - width + 1))
    out = []
    for i, words in split_rows:
        gone = [False] * len(words)
        for k in range(len(words) - width + 1):
            if count[tuple(words[k:k + width])] > 1:
                gone[k:k + width] = [True] * width
        kept = [w for w, g in zip(words, gone) if not g]
        out.append((i, len(words), sum(gone), sha(" ".join(kept))))
    return out


def repeated_bytes(rows, width=100):
    """(doc_id, n_bytes, n_removed, n_spans, digest); rows in doc_id order."""
    seen, out = set(), []
    for i, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - width + 1):
            piece = data[k:k + width]
            if piece in seen:
                gone[k:k + width] = b"\x01" * width
            seen.add(piece)
        spans = len(re.findall(b"\x01+", bytes(gone)))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((i, len(data), sum(gone), spans, sha(kept)))
    return out


def shingles(text):
    words = split((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                                                       "abcdefghijklmnopqrstuvwxyz")))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4)))


def near_duplicates(rows, percent=85):
    """doc_id -> (n_shingles, component_id), through an inverted index over shingles."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    index = defaultdict(list)
    for a, (_, items) in enumerate(sets):
        shared = Counter(b for s in items for b in index[s])
        for b, n in shared.items():
            if 100 * n >= percent * (len(items) + len(sets[b][1]) - n):
                parent[root(a)] = root(b)
        for s in items:
            index[s].append(a)
    least = {}
    for a, (i, _) in enumerate(sets):
        least[root(a)] = min(i, least.get(root(a), i))
    return [(i, len(items), least[root(a)]) for a, (i, items) in enumerate(sets)]


def quality_kept(text):
    """The verdict of the repetition rules."""
    words = split(text)
    n, total = len(words), max(1, sum(map(len, words)))
    grams = {k: [tuple(words[i:i + k]) for i in range(n - k + 1)] for k in range(2, 11)}
    count = {k: Counter(g) for k, g in grams.items()}
    inside = set()
    for i, g in enumerate(grams[5]):
        if count[5][g] > 1:
            inside.update(range(i, i + 5))
    if n < 10 or 100 * len(inside) > 20 * n:
        return False
    seen, line_chars = set(), 0
    for line in (text or "").split("\n"):
        if split(line):
            line_chars += sum(map(len, split(line))) if line in seen else 0
            seen.add(line)
    if line_chars > 0.20 * total:
        return False
    for k, limit in {2: 0.20, 3: 0.18, 4: 0.16}.items():
        worst = max((c * sum(map(len, g)) for g, c in count[k].items() if c > 1), default=0)
        if worst / total > limit:
            return False
    for k, limit in {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}.items():
        found, hidden = set(), set()
        for i, g in enumerate(grams[k]):
            if g in found:
                hidden.update(range(i, i + k))
            found.add(g)
        if sum(len(words[i]) for i in hidden) / total > limit:
            return False
    return True


def kept_bytes(rows, width=100):
    """doc_id -> text without what starts earlier; rows in doc_id order."""
    seen, out = set(), {}
    for i, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - width + 1):
            piece = data[k:k + width]
            if piece in seen:
                gone[k:k + width] = b"\x01" * width
            seen.add(piece)
        out[i] = bytes(b for b, g in zip(data, gone) if not g).decode("utf-8", "ignore")
    return out


def pipeline_texts(rows):
    """What the stages before packing leave: doc_id -> text."""
    rows = [(i, t) for i, t in rows if quality_kept(t)]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    best = {}
    for i, t in rows:
        key = (t or "").translate(lower)
        best[key] = max(i, best.get(key, i))
    rows = [(i, t) for i, t in rows if best[(t or "").translate(lower)] == i]
    parts = {i: c for i, _, c in near_duplicates(rows)}
    return kept_bytes(sorted((i, t) for i, t in rows if parts[i] == i))
