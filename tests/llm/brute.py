"""Plain-Python versions of the operators for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))


def shingle_list(text):
    w = words(text)
    return [tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))] if w else []


def components(nodes, edges):
    up = {n: n for n in nodes}

    def find(a):
        while up[a] != a:
            a = up[a]
        return a
    for a, b in edges:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def jaccard(rows):
    """rows: (id, text) -> {id: component}; ids repeat, null ids and empty sets link with nothing."""
    sets = [(i, frozenset(shingle_list(t))) for i, t in rows if i is not None]
    sets = [(i, s) for i, s in sets if s]
    edges = [(i, j) for k, (i, a) in enumerate(sets) for j, b in sets[:k]
             if 100 * len(a & b) >= 80 * len(a | b)]
    return components({i for i, _ in rows if i is not None}, edges)


def repeats(texts, width=200):
    """Per text (n_removed, n_spans, kept bytes)."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + width] for b in data for i in range(len(b) - width + 1))
    out = []
    for b in data:
        gone = [False] * len(b)
        for i in range(len(b) - width + 1):
            if seen[b[i:i + width]] > 1:
                gone[i:i + width] = [True] * width
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def sha(b):
    return hashlib.sha256(b).hexdigest()


def contaminated(docs, items, threshold=0.8):
    """{(doc position, item position): best weighted similarity of an item-sized window}."""
    out = {}
    bags = [(k, Counter(shingle_list(t)), len(shingle_list(t))) for k, t in enumerate(items)]
    for d, text in enumerate(docs):
        s = shingle_list(text)
        for k, bag, m in bags:
            if not m or not s or not set(s) & set(bag):
                continue
            n = min(m, len(s))
            best = 0.0
            for i in range(len(s) - n + 1):
                both = sum((Counter(s[i:i + n]) & bag).values())
                best = max(best, both / (n + m - both))
            if best >= threshold:
                out[d, k] = best
    return out


def mix(rows, weights=(1, 2, 3), most=3):
    """rows: (id, source, text) -> list of (id, size, source_size, target, taken) in the operator's order."""
    sized = [(i, s, len(re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()))) for i, s, t in rows]
    total = defaultdict(int)
    for _, s, n in sized:
        total[s] += n
    names = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, free, left = {}, set(names), sum(total.values())
    while free:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > most * total[s]]
        if not over:
            target.update({s: level * weight[s] for s in free})
            break
        for s in over:
            target[s] = float(most * total[s])
            left -= most * total[s]
            free.discard(s)
    out = []
    for s in names:
        budget, size = int(target[s] + 1e-9), total[s]
        epochs = budget // size if size else 0
        rest = budget - epochs * size
        mine = [(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest(), -1 if i is None else i, n, i)
                for i, x, n in sized if x == s]
        for _, _, n, i in sorted(mine):
            part = max(0, min(n, rest))
            rest -= part
            out.append((i, n, size, target[s], epochs * n + part))
    return out
