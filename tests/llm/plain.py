"""The contracts of the operators in plain Python, over small lists of rows."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def exact_groups(docs):
    groups = defaultdict(list)
    for i, t in docs:
        groups[(t or "").translate(LOWER)].append(i)
    out = []
    for text, ids in groups.items():
        best = max(ids, key=lambda i: (i is not None, i or 0))
        kept = False
        for i in ids:
            out.append((i, best, len(ids), i == best and not kept, sha(text)))
            kept = kept or i == best
    return out


def contamination(docs, items, window=13):
    found = defaultdict(set)
    for item, text in items:
        w = ALNUM.findall((text or "").translate(LOWER))
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            found[tuple(w[k : k + n])].add("" if item is None else str(item))
    sizes = sorted({len(k) for k in found})
    out = []
    for i, text in docs:
        w = ALNUM.findall((text or "").translate(LOWER))
        hit, ids = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in found:
                    hit.update(range(k, k + n))
                    ids |= found[tuple(w[k : k + n])]
        out.append((i, len(w), len(hit), sorted(ids), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def removal(docs, window=13):
    least = {}
    split = [(i, SPACED.findall(t or "")) for i, t in docs]
    for i, w in split:
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            if i is not None:
                least[key] = min(least.get(key, i), i)
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and least[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def fingerprint(text):
    w = SPACED.findall((text or "").translate(LOWER))
    shingles = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or [" ".join(w)] * bool(w)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_components(docs, bits=3):
    prints = [fingerprint(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(docs)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(docs):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return [(i, prints[k], least.get(root(k)), root(k)) for k, (i, _) in enumerate(docs)]


def mix_targets(docs, weights=(3, 1, 2)):
    """docs: (source, text). Target of each source, by resharing the excess until there is none."""
    size = Counter()
    for s, t in docs:
        size[s] += len(SPACED.findall(t or ""))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, open_ = {}, set(order)
    while open_:
        left = 1.5 * sum(size.values()) - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = [s for s in open_ if share[s] > 2 * size[s]]
        if not full:
            target.update(share)
            break
        for s in full:
            target[s] = 2.0 * size[s]
            open_.discard(s)
    return size, target
