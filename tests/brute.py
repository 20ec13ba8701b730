"""Plain Python versions of the clustering operators, for small inputs."""

import math


def dist(a, b):
    return math.sqrt(sum((x - y) ** 2 for x, y in zip(a, b)))


def nearest(p, centres):
    """``centres``: {cid: vector}. Cid and distance; the lowest cid on ties."""
    return min(((dist(p, c), cid) for cid, c in centres.items()))[::-1]


def step(points, centres):
    groups = {}
    for p in points:
        groups.setdefault(nearest(p, centres)[0], []).append(p)
    return {cid: [sum(v) / len(ps) for v in zip(*ps)] for cid, ps in groups.items()}


def score(a, b):
    return 0.0 if a == 0 and b == 0 else (b - a) / max(a, b)


def pairwise(points, centres):
    """Silhouette of each point, in order."""
    own = [nearest(p, centres)[0] for p in points]
    out = []
    for p, cid in zip(points, own):
        others = [dist(p, q) for q, c in zip(points, own) if c == cid and q != p]
        away = [dist(p, c) for c in centres.values() if c != centres[cid]]
        out.append((cid, score(sum(others) / len(others) if others else 0, min(away, default=0))))
    return out


def simple(points, centres):
    out = []
    for p in points:
        cid, a = nearest(p, centres)
        out.append((cid, score(a, min((dist(p, c) for i, c in centres.items() if i != cid), default=0))))
    return out


def agglomerate(points, target=1):
    start = sorted({tuple(p) for p in points})
    centres, fresh, merges = {i: list(c) for i, c in enumerate(start)}, len(start), []
    while len(centres) > target:
        centres = step(points, centres)
        pairs = [(dist(centres[i], centres[j]), i, j) for i in centres for j in centres if i < j]
        if len(centres) <= target or not pairs:
            break
        d, i, j = min(pairs)
        merged = [(x + y) / 2 for x, y in zip(centres.pop(i), centres.pop(j))]
        centres[fresh] = merged
        merges.append((i, j, d, merged))
        fresh += 1
    return merges, centres, step(points, centres)


def neighbours(train, query, k, one_per_distance=False):
    """``train``: (id, numbers, words, label); scaled already."""
    found = []
    for ident, numbers, words, label in train:
        d = 0.0
        for x, y in zip(query[0], numbers):
            d += (x - y) * (x - y)
        for x, y in zip(query[1], words):
            d += 0.0 if x == y else 1.0
        found.append((d, ident, label))
    found.sort()
    if one_per_distance:
        first = {}
        for row in found:
            first.setdefault(row[0], row)
        found = sorted(first.values())
    return found[:k]


def vote(found):
    labels = [f[2] for f in found]
    return min(set(labels), key=lambda x: (-labels.count(x), x))
