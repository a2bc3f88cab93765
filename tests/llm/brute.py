"""Plain re-statements of the operators' contracts, for small inputs."""

import collections
import hashlib
import itertools
import re

WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def shingle_set(text, k=5):
    words = WORD.findall(re.sub(rb"[A-Z]+", lambda m: m[0].lower(), (text or "").encode()))
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def components(rows, percent):
    """id -> (set size, component, kept)"""
    sets = {i: shingle_set(t) for i, t in rows}
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    holders, common = collections.defaultdict(list), collections.Counter()
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    for ids in holders.values():
        common.update(itertools.combinations(sorted(ids), 2))
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


def without_repeats(rows, width):
    """id -> (bytes, removed, spans, sha256 of what is kept)"""
    seen, raw = {}, {i: (t or "").encode() for i, t in rows}
    for i in sorted(raw):
        for s in range(len(raw[i]) - width + 1):
            seen.setdefault(raw[i][s : s + width], (i, s))
    out = {}
    for i, r in raw.items():
        gone = bytearray(len(r))
        for s in range(len(r) - width + 1):
            if seen[r[s : s + width]] != (i, s):
                gone[s : s + width] = b"\1" * width
        spans = sum(1 for j in range(len(r)) if gone[j] and not (j and gone[j - 1]))
        out[i] = (len(r), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(r, gone, strict=True) if not g)).hexdigest())
    return out
