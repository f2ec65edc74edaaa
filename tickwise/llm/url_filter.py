"""URL filter over a sorted digest array.

Every rule ``host/path`` is one entry: its 64-bit xxHash in a sorted array,
its full text beside it.  The arrays are packed into one block that each
worker maps into memory; a batch of URLs makes one array of candidate keys
(the host and its parent domains, with the path cut at the lengths that rules
have), a vectorised binary search finds equal digests, and the stored text
decides whether a hit is the rule or a collision.
"""

from __future__ import annotations

import mmap
import os

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import append

#: Packed rules that a task maps at once, in bytes; more are probed as several arrays.
PART_BYTES = 64 << 20
#: What a rule takes in the array besides its text.
RULE_BYTES = 25
JUDGED = StructType([StructField(c, StringType()) for c in ("host", "path", "rule", "verdict")])


def parts(url: str | None) -> tuple[str, str]:
    """Host and path of a URL; both empty for null or without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((at for c in "/?#" if (at := rest.find(c)) >= 0), default=len(rest))
    tail = rest[end:]
    stop = min((at for c in "?#" if (at := tail.find(c)) >= 0), default=len(tail))
    host = rest[:end].translate({c: c + 32 for c in range(65, 91)})
    return host, tail[:stop]


def digest(key: str) -> int:
    return xxhash.xxh64_intdigest(key.encode())


def pack(rules: list[tuple[str, str, str]]) -> bytes:
    """The rules (host, path, verdict) as digests, offsets, host lengths,
    verdicts and texts, sorted by digest.  Of one rule with two verdicts,
    block holds."""
    merged: dict[tuple[str, str], str] = {}
    for host, path, verdict in rules:
        if merged.get((host, path)) != "block":
            merged[host, path] = verdict
    rows = sorted((digest(h + p), h, p, v) for (h, p), v in merged.items())
    texts = [(h + p).encode() for _, h, p, _ in rows]
    arrays = (np.array([len(rows)], np.int64),
              np.array([r[0] for r in rows], np.uint64),
              np.cumsum([0, *map(len, texts)]).astype(np.int64),
              np.array([len(r[1].encode()) for r in rows], np.int64),
              np.array([r[3] == "block" for r in rows], np.uint8))
    return b"".join(a.tobytes() for a in arrays) + b"".join(texts)


class DigestArray:
    """The packed rules, mapped into memory."""

    def __init__(self, packed: bytes):
        fd = os.memfd_create("rules")
        os.write(fd, packed)
        self.map = mmap.mmap(fd, len(packed), prot=mmap.PROT_READ)
        os.close(fd)
        n = int(np.frombuffer(self.map, np.int64, 1)[0])
        self.digests = np.frombuffer(self.map, np.uint64, n, 8)
        self.offsets = np.frombuffer(self.map, np.int64, n + 1, 8 + 8 * n)
        self.hosts = np.frombuffer(self.map, np.int64, n, 16 + 16 * n)
        self.blocks = np.frombuffer(self.map, np.uint8, n, 16 + 24 * n)
        self.start = 16 + 25 * n
        self.host_sizes: set[int] = set()
        self.path_sizes: set[int] = set()
        for k in range(n):
            host, path = self.rule(k)
            self.host_sizes.add(len(host))
            self.path_sizes.add(len(path))

    def rule(self, k: int) -> tuple[str, str]:
        at, end = self.start + int(self.offsets[k]), self.start + int(self.offsets[k + 1])
        cut = at + int(self.hosts[k])
        return self.map[at:cut].decode(), self.map[cut:end].decode()

    def candidates(self, host: str, path: str):
        """(host, path) of the rules that could fit."""
        tops, at = [host] if len(host) in self.host_sizes else [], len(host)
        while (at := host.rfind(".", 0, at)) >= 0 and len(host) - at - 1 <= max(self.host_sizes, default=0):
            if len(host) - at - 1 in self.host_sizes:
                tops.append(host[at + 1:])
        for top in tops:
            for size in self.path_sizes:
                if size <= len(path):
                    yield top, path[:size]

    def judge(self, urls: list[str | None], default: str) -> list[dict]:
        found = [parts(u) for u in urls]
        tried = [(i, h, p) for i, (host, path) in enumerate(found) if host
                 for h, p in self.candidates(host, path)]
        keys = np.array([digest(h + p) for _, h, p in tried], np.uint64)
        at = np.searchsorted(self.digests, keys)
        best: dict[int, tuple] = {}
        n = len(self.digests)
        hit = np.flatnonzero((at < n) & (self.digests[np.minimum(at, n - 1)] == keys)) if n else []
        for j in hit:
            i, h, p = tried[j]
            k = int(at[j])
            while k < n and self.digests[k] == keys[j]:
                if self.rule(k) == (h, p):
                    best[i] = max(best.get(i, (-1,)),
                                  (len(h) + len(p), len(h), h + p, bool(self.blocks[k])))
                k += 1
        return [{"host": host, "path": path, "rule": best[i][2] if i in best else None,
                 "verdict": ("block" if best[i][3] else "allow") if i in best else default}
                for i, (host, path) in enumerate(found)]


def longest(parts: list[dict]) -> dict:
    """The judgement of several parts of a rule list: the longest rule's, with the
    longer host among equally long ones; of a rule in several parts, a block."""
    def order(x: dict) -> tuple:
        rule = x["rule"] or ""
        host = rule.find("/") if "/" in rule else len(rule)
        return x["rule"] is not None, len(rule), host, rule, x["verdict"] == "block"
    return max(parts, key=order)


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], url: str = "url",
               out: str = "judged", default: str = "allow",
               part_bytes: int = PART_BYTES) -> DataFrame:
    """``pages`` plus a struct ``out``: ``host``, ``path``, the longest fitting
    ``rule`` and its ``verdict``.

    A rule fits its host and all subdomains where the path starts with the
    rule's; the longest rule (host and path together, then host) wins.  The
    array is a list of exceptions: a URL whose keys are not in it has no rule
    and the verdict ``default``.  Null, empty and schemeless URLs have an empty
    host and path, which no rule fits.  Other columns pass through; one named
    ``out`` is replaced.  A list of more than ``part_bytes`` is probed as several
    arrays, and the longest rule of all counts.
    """
    size = sum(len(h.encode()) + len(p.encode()) + RULE_BYTES for h, p, _ in rules)
    parts = -(-size // part_bytes) or 1
    step = -(-len(rules) // parts) or 1
    rest = [c for c in pages.columns if c != out]

    def probed(rows: DataFrame, source: str, some: list, name: str) -> DataFrame:
        shared = pages.sparkSession.sparkContext.broadcast(pack(some))

        def start():
            array = DigestArray(shared.value)
            return lambda urls: array.judge(urls, default)

        return append(rows, source, name, JUDGED, start)

    if parts == 1:
        return probed(pages, url, rules, out)
    found = pages.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"), F.col(url).alias("url"))
    names = []
    for at in range(0, len(rules), step):
        names.append(f"part_{len(names)}")
        found = probed(found, "url", rules[at:at + step], names[-1])
    found = found.select("row", F.array(*names).alias("parts"))
    return (append(found, "parts", "all", JUDGED, lambda: lambda rows: [longest(r) for r in rows])
            .select(*[F.col(f"row.`{c}`") for c in rest], F.col("all").alias(out)))
