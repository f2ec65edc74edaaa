"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the windows of the benchmark items: 13 consecutive words, or
the whole item where it is shorter.  Patterns of one length m share tables:

* the shift table leads from a block of two words to the distance from the
  block's last place in any pattern to that pattern's end; a block in no
  pattern lets the search skip m - 1 words at once;
* where the shift is zero, the bucket of that suffix block holds the patterns
  that end so, and a comparison of the words confirms an occurrence.

The tables are built from the benchmark alone.  One that is larger than a task
should hold is searched in parts, and the runs of hit words are merged, which
gives the same.  The documents are not shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, IntegerType, LongType, StringType, StructField,
                               StructType)

from .common import append

WINDOW = 13
#: Benchmark text whose tables a task holds at once, in bytes (a window takes
#: about 300 bytes there); more is searched part by part and merged.
PART_BYTES = 2 << 20
SPAN = StructType([StructField("start", IntegerType(), False),
                   StructField("end", IntegerType(), False)])
FOUND = StructType([StructField("n_words", LongType(), False),
                    StructField("spans", ArrayType(SPAN, False), False),
                    StructField("items", ArrayType(StringType(), False), False)])
# Digits, letters and all bytes of non-ASCII characters stay; the rest parts words.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else
                   b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased; none for null."""
    return text.encode().translate(WORD_BYTES).split() if text else []


class WuManber:
    """Shift table and buckets of all patterns of one length in words."""

    def __init__(self, length: int, patterns: dict[tuple, set[str | None]]):
        self.m, self.block = length, min(2, length)
        self.patterns = patterns
        self.shift: dict[tuple, int] = {}
        self.bucket: dict[tuple, set[tuple]] = {}
        for pattern in patterns:
            for end in range(self.block, length + 1):
                key = pattern[end - self.block:end]
                self.shift[key] = min(self.shift.get(key, length), length - end)
            self.bucket.setdefault(pattern[-self.block:], set()).add(pattern)

    def search(self, words: list[bytes]):
        """(start, pattern) of every occurrence."""
        m, block, n = self.m, self.block, len(words)
        skip, shift = m - block + 1, self.shift
        end = m
        while end <= n:
            step = shift.get(key := tuple(words[end - block:end]), skip)
            if step == 0:
                candidate = tuple(words[end - m:end])
                if candidate in self.bucket[key]:
                    yield end - m, candidate
                step = 1
            end += step


def tables(items: list[tuple[str | None, str | None]], window: int = WINDOW) -> list[WuManber]:
    """One search per pattern length of the items ``(item_id, text)``."""
    by_length: dict[int, dict[tuple, set[str | None]]] = {}
    for item, text in items:
        words = words_of(text)
        length = min(window, len(words))
        for at in range(len(words) - length + 1 if words else 0):
            (by_length.setdefault(length, {})
             .setdefault(tuple(words[at:at + length]), set()).add(item))
    return [WuManber(length, patterns) for length, patterns in sorted(by_length.items())]


def merged(runs: list[tuple[int, int]]) -> list[dict]:
    """Maximal runs of (start, end) runs."""
    spans: list[dict] = []
    for start, end in sorted(runs):
        if spans and start <= spans[-1]["end"]:
            spans[-1]["end"] = max(end, spans[-1]["end"])
        else:
            spans.append({"start": start, "end": end})
    return spans


def find(searches: list[WuManber], text: str | None) -> dict:
    """Word count, maximal runs of hit words and sorted items of one text."""
    words = words_of(text)
    runs: list[tuple[int, int]] = []
    items: set[str | None] = set()
    for search in searches:
        for at, pattern in search.search(words):
            runs.append((at, at + search.m))
            items |= search.patterns[pattern]
    return {"n_words": len(words), "spans": merged(runs), "items": sorted(items - {None})}


def together(parts: list[dict]) -> dict:
    """What the searches of several parts of a benchmark found in one text."""
    return {"n_words": parts[0]["n_words"],
            "spans": merged([(s["start"], s["end"]) for p in parts for s in p["spans"]]),
            "items": sorted({i for p in parts for i in p["items"]})}


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, text: str = "text",
                   out: str = "hits", window: int = WINDOW, part_bytes: int = PART_BYTES) -> DataFrame:
    """``docs`` plus a struct ``out``: ``n_words``, the maximal runs ``spans`` of
    hit words (start, end) and the ids ``items`` of the items found, as sorted
    strings.

    ``benchmark`` has item_id and text; rows without words match nothing, equal
    items all count.  An item with a null id is searched like any other but not
    listed in ``items``.  A null or empty document has no words and
    no hits.  Other columns pass through; one named ``out`` is replaced.  A
    benchmark of more than ``part_bytes`` is searched in parts of about that
    size, with the same result.
    """
    bench = benchmark.select(F.col("item_id").cast("string"), "text").where("text is not null")
    size = bench.agg(F.sum(F.octet_length("text") + F.coalesce(F.octet_length("item_id"), F.lit(0)))).first()[0] or 0
    parts = -(-size // part_bytes) or 1
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    rest = [c for c in docs.columns if c != out]
    found = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"), F.col(text).alias("text")) if parts > 1 else docs

    def searched(rows: DataFrame, items: list[tuple], name: str) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def start():
            searches = tables(shared.value, window)
            return lambda texts: [find(searches, t) for t in texts]

        return append(rows, text if parts == 1 else "text", name, FOUND, start)

    for n in range(parts):
        items = [tuple(r) for r in bench.where(part == n).collect()]
        found = searched(found, items, out if parts == 1 else f"part_{n}")
    if parts == 1:
        return found
    all_parts = found.select("row", F.array(*[f"part_{n}" for n in range(parts)]).alias("parts"))
    return (append(all_parts, "parts", "all", FOUND, lambda: lambda rows: [together(r) for r in rows])
            .select(*[F.col(f"row.`{c}`") for c in rest], F.col("all").alias(out)))


def contaminated(hits: str = "hits"):
    """At least a twentieth of the words are hit, and one is."""
    n_hit = hit_words(hits)
    return (n_hit > 0) & (n_hit * 20 >= F.col(f"{hits}.n_words"))


def hit_words(hits: str = "hits"):
    """Number of hit words."""
    return F.aggregate(F.col(f"{hits}.spans"), F.lit(0).cast("long"),
                       lambda n, s: n + (s["end"] - s["start"]).cast("long"))
