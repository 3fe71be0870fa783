"""Plain Python readings of the contracts, for small tables."""

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(t):
    return WORD.findall(t or "")


def quality(t):
    t = t or ""
    w = words(t)
    lines = [x for x in t.split("\n") if words(x)]
    seen = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if seen[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


ASSIGN = re.compile(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(t):
    t = t or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(out)


def joined(spans):
    return ",".join(f"{('assign', 'access', 'hex', 'random')[k]}:{a}:{b}" for a, k, b in spans)


def shingles(t):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def join_components(rows):
    """Union-find over all similar pairs; sorted (doc_id, n_shingles, component_id)."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    index = {}
    for i, s in enumerate(sets):
        near = Counter(j for x in s for j in index.get(x, ()))
        for j, shared in near.items():
            if 100 * shared >= 75 * (len(s) + len(sets[j]) - shared):
                parent[find(i)] = find(j)
        for x in s:
            index.setdefault(x, []).append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        k = find(i)
        least[k] = min(least.get(k, d), d)
    return sorted((d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def repeats(rows, depth=200):
    """Windows counted in a dictionary over the whole table; sorted digests."""
    import hashlib

    raws = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(r[i:i + depth] for _, r in raws for i in range(len(r) - depth + 1))
    out = []
    for d, r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - depth + 1):
            if seen[r[i:i + depth]] > 1:
                gone[i:i + depth] = b"\x01" * depth
        spans = len(re.findall(b"\x01+", bytes(gone)))
        kept = bytes(b for b, g in zip(r, gone) if not g)
        out.append((-1 if d is None else d, len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)
