"""Slow, plain versions of the operators' contracts, for comparison on small tables."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np
from xxhash import xxh64_intdigest


def removed_bytes(rows, length=100):
    """doc_id -> (n_bytes, n_removed, n_spans, sha256 of the rest), by a set of all strings met."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = [False] * len(data)
        for i in range(len(data) - length + 1):
            if data[i : i + length] in seen:
                gone[i : i + length] = [True] * length
            seen.add(data[i : i + length])
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[doc_id] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def base_spans(text):
    assign = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?[ ]*[:=][ ]*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [("assign", *m.span()) for m in assign.finditer(text) if len(m[2]) >= 8]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found, key=lambda x: (x[1], ("assign", "access", "hex").index(x[0])))


def fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


class Sets:
    def __init__(self, items):
        self.parent = {x: x for x in items}

    def find(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.parent[b] = a


def simhash_components(rows):
    prints = {doc_id: fingerprint(text) for doc_id, text in rows}
    sets, ids = Sets(prints), sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if bin(prints[a] ^ prints[b]).count("1") <= 2:
                sets.join(a, b)
    return {x: (format(prints[x], "016x"), sets.find(x)) for x in ids}


def five_word_shingles(text):
    words = (text or "").lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def near_components(texts):
    """id -> smallest id linked by Jaccard similarity of at least 0.8 on five-word shingles."""
    shingles = {i: five_word_shingles(t) for i, t in texts.items()}
    holders = defaultdict(list)
    for i, own in shingles.items():
        for s in own:
            holders[s].append(i)
    sets = Sets(texts)
    for a, b in {(x, y) for held in holders.values() for x in held for y in held if x < y}:
        both = len(shingles[a] & shingles[b])
        if both >= 0.8 * (len(shingles[a]) + len(shingles[b]) - both):
            sets.join(a, b)
    return {i: sets.find(i) for i in texts}


def leaks(documents, items):
    def parts(text, width=5):
        words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
        return words, {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}

    out = {}
    for item, text in items:
        words, _ = parts(text)
        width = min(5, len(words))
        if not width:
            continue
        wanted = parts(text, width)[1]
        for doc, own in documents:
            shared = len(wanted & parts(own, width)[1])
            if shared >= 0.8 * len(wanted):
                out[doc, item] = (len(wanted), shared)
    return out


def nearest(ids, points, queries, k=5):
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    out = {}
    for q in queries:
        scores = unit @ unit[ids.index(q)]
        best = sorted((i for i in range(len(ids)) if ids[i] != q), key=lambda i: (-round(scores[i], 12), ids[i]))[:k]
        out[q] = [ids[i] for i in best]
    return out
