"""Brute-force versions of the operators, on plain Python rows."""

import hashlib
import re
from collections import defaultdict

import xxhash

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def covered(docs, window):
    """{doc_id: which words are covered} for (doc_id, text) rows with distinct ids."""
    first, out = {}, {}
    for d, t in sorted(docs, key=lambda x: x[0]):
        w = words(t)
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i : i + window]), (d, i))
    for d, t in docs:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] != (d, i):
                gone[i : i + window] = [True] * window
        out[d] = gone
    return out


def fingerprint(text, n=4):
    w = words(ascii_lower(text))
    shingles = [" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, linked):
    """{node: smallest node reachable} for a function of two nodes."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def near(a, b, bits=4):
    return bin(a ^ b).count("1") <= bits


def shingles(text, n=5):
    w = re.findall("[0-9a-z\x80-\U0010ffff]+", ascii_lower(text))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def item_size(text):
    """Words of a shingle of a test item: five, or all it has."""
    return min(5, len(re.findall("[0-9a-z\x80-\U0010ffff]+", ascii_lower(text))))


def contains(doc, item, threshold=0.8):
    n = item_size(item)
    own = shingles(item, n) if n else set()
    return bool(own) and len(own & shingles(doc, n)) >= threshold * len(own) - 1e-9


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def grouped(rows):
    out = defaultdict(list)
    for key, *rest in rows:
        out[key].append(rest)
    return out
