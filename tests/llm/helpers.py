"""Brute-force versions of the operators, written from the contracts."""

import hashlib
import re
import zlib
from collections import Counter

import xxhash


def lower(text):
    return re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or "")


def simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(pairs, budget=3):
    """{id: least id reachable} of (id, fingerprint) pairs."""
    root = {i: i for i, _ in pairs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, f) in enumerate(pairs):
        for j, g in pairs[:k]:
            if (f ^ g).bit_count() <= budget:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i, _ in pairs}


def repeats(docs, length):
    """(id, bytes, removed, runs, digest) of each (id, text)."""
    data = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(b[k:k + length] for _, b in data for k in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = len(re.findall(b"\1+", bytes(gone)))
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2
