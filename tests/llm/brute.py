"""Plain single-process answers that the operators are compared with."""

from __future__ import annotations

import hashlib


def shingles(text, words=5):
    found = (text or "").encode().lower().split()
    if not found:
        return set()
    return {tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))}


def jaccard_components(rows, percent=80):
    """{doc_id: (set size, least reachable id)} of (doc_id, text) pairs with distinct ids."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    holders = {}
    for i in ids:
        for s in sets[i]:
            holders.setdefault(s, []).append(i)
    for i in ids:
        near = {j for s in sets[i] for j in holders[s] if j < i}
        for j in near:
            inner = len(sets[i] & sets[j])
            if 100 * inner >= percent * (len(sets[i]) + len(sets[j]) - inner):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


def remove_repeats(rows, length=50):
    """{doc_id: (bytes, removed, runs, hash of the rest)} of (doc_id, text) pairs."""
    seen, out = set(), {}
    groups = {}
    for i, t in rows:
        groups.setdefault(i, []).append(t)
    for i in sorted(groups):
        new = set()
        for t in groups[i]:
            raw = (t or "").encode()
            gone = bytearray(len(raw))
            for p in range(len(raw) - length + 1):
                s = raw[p : p + length]
                if s in seen:
                    gone[p : p + length] = b"\1" * length
                new.add(s)
            kept = bytes(b for b, g in zip(raw, gone) if not g)
            runs = sum(1 for p in range(len(gone)) if gone[p] and (not p or not gone[p - 1]))
            out[i, t] = (len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest())
        seen |= new
    return out
