"""Ranked lexical search, term-at-a-time for short lists and then document-at-a-time.

Documents lie in blocks, one inverted index each; every query meets every block.
Within a block the lists of a query's terms are dealt with by their length:

* short lists are summed term by term into accumulators, one per document that
  any of them holds;
* the accumulators, sorted by document, become one more iterator whose bound is
  the largest sum; the long lists are iterators with their largest score;
* documents are then taken one at a time.  Iterators whose bounds together stay
  below the k-th best score so far are not walked but searched: a document is
  looked up in them, the largest bound first, until it can't reach that score.

A task carries the best k of each query from block to block, so later blocks are
mostly skipped.  The k-th full score of the documents with the largest sums
starts the bound in each block.  Scores are integers, so ties are exact.

Blocks are written once: the corpus counts come from them before they are
searched, and a lost executor re-reads its own.  No document is shuffled.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..session import materialize
from .decontaminate import words_of

#: Query texts that go to the tasks at once, in bytes; more are searched part by part.
PART_BYTES = 64 << 20
#: A list is short if it holds at most this share of its block's documents.
SHORT = 1 / 16
#: Results of a query are first ranked in so many groups of tasks.
GROUPS = 64
BLOCKS = ("docs array<long>, filled long, words long, terms array<int>, sizes array<int>, packed binary")


def _blocks(batches: Iterator[pa.RecordBatch], made) -> Iterator[pa.RecordBatch]:
    vocabulary, schema = made.value
    pack = zstandard.ZstdCompressor(3).compress
    for batch in batches:
        docs, lengths, terms, places, counts = [], [], [], [], []
        for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist()):
            words = words_of(text)
            if not words:
                continue
            held = Counter(words)
            own = [(vocabulary[t], c) for t, c in held.items() if t in vocabulary]
            terms += (t for t, _ in own)
            counts += (c for _, c in own)
            places += [len(docs)] * len(own)
            docs.append(doc)
            lengths.append(len(words))
        order = np.argsort(np.array(terms, np.int64), kind="stable")
        term, sizes = np.unique(np.array(terms, np.int64), return_counts=True)
        lists = np.concatenate([np.array(places, np.int64)[order], np.array(counts, np.int64)[order],
                                np.array(lengths, np.int64)])
        yield pa.RecordBatch.from_pylist([{
            "docs": docs, "filled": len(docs), "words": sum(lengths), "terms": term.tolist(), "sizes": sizes.tolist(),
            "packed": pack(lists.tobytes())}], schema)


class Block:
    """Lists of (place, score) of one block, by term."""

    def __init__(self, terms: np.ndarray, sizes: np.ndarray, lists: np.ndarray, weights: dict[int, int],
                 filled: int, words: int):
        total = int(sizes.sum())
        place, tf, lengths = lists[:total], lists[total:2 * total], lists[2 * total:]
        m = 10 + (90 * lengths * filled) // words
        weight = np.repeat(np.array([weights[t] for t in terms.tolist()], np.int64), sizes)
        score = weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[place]))
        ends = np.cumsum(sizes)
        bound = np.maximum.reduceat(score, ends - sizes) if total else []
        self.bound = {t: b for t, b in zip(terms.tolist(), np.asarray(bound).tolist()) if b > 0}
        self.lists = {t: (place[e - n:e], score[e - n:e]) for t, e, n in zip(terms.tolist(), ends.tolist(), sizes.tolist())}
        self.short = max(1, int(len(lengths) * SHORT))
        self.walked: dict[int, tuple[list, list]] = {}  # long lists as Python lists

    def walk(self, term: int) -> tuple[list, list]:
        if term not in self.walked:
            place, score = self.lists[term]
            self.walked[term] = place.tolist(), score.tolist()
        return self.walked[term]


def _summed(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Accumulators of short lists: documents in order, and their summed scores."""
    if not lists:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    place, score = (np.concatenate(x) for x in zip(*lists))
    order = np.argsort(place, kind="stable")
    place = place[order]
    first = np.flatnonzero(np.diff(place, prepend=-1))
    return place[first], np.add.reduceat(score[order], first)


def _found(places: list, scores: list, place: int, since: int = 0) -> tuple[int, int]:
    """(score, position) of a document in a list, searched from a position on."""
    at = bisect_left(places, place, since)
    return (scores[at] if at < len(places) and places[at] == place else 0), at


def search(block: Block, terms: list[int], docs: list, best: list[tuple[int, int]], k: int) -> None:
    """Adds the documents of a block to the heap ``best`` of (score, -id), if they
    are among the best ``k``; of equal scores the lesser id is better."""
    own = [t for t in terms if t in block.bound]
    floor = best[0][0] if len(best) == k else 1
    if sum(block.bound[t] for t in own) < floor:
        return
    places, sums = _summed([block.lists[t] for t in own if len(block.lists[t][0]) <= block.short])
    long = [(block.bound[t], *block.walk(t)) for t in own if len(block.lists[t][0]) > block.short]
    if len(places) >= k:  # what the largest accumulators come to is a first bound
        top = np.argpartition(sums, len(sums) - k)[-k:]
        floor = max(floor, min(int(s) + sum(_found(p, v, d)[0] for _, p, v in long)
                               for d, s in zip(places[top].tolist(), sums[top].tolist())))
    rest = sum(b for b, _, _ in long)
    if rest < floor:  # accumulators that can't reach the bound are passed over at once
        able = sums + rest >= floor
        places, sums = places[able], sums[able]
    lists = sorted([*long, *([(int(sums.max()), places.tolist(), sums.tolist())] if len(places) else [])],
                   key=lambda x: x[0])
    below = np.cumsum([0, *(b for b, _, _ in lists)]).tolist()  # what the lists before each one can add
    at = [0] * len(lists)
    end = len(docs)
    first = 0
    while True:
        while first < len(lists) and below[first + 1] < floor:
            first += 1  # only searched from now on
        place = end
        for i in range(first, len(lists)):
            p = lists[i][1]
            if at[i] < len(p) and p[at[i]] < place:
                place = p[at[i]]
        if place == end:
            return
        score = 0
        for i in range(first, len(lists)):
            _, p, v = lists[i]
            if at[i] < len(p) and p[at[i]] == place:
                score += v[at[i]]
                at[i] += 1
        for i in range(first - 1, -1, -1):
            if score + below[i + 1] < floor:
                break
            more, at[i] = _found(lists[i][1], lists[i][2], place, at[i])
            score += more
        else:
            if score >= floor:
                entry = (score, -docs[place])
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
                if len(best) == k:
                    floor = max(floor, best[0][0])


def _ranked(batches: Iterator[pa.RecordBatch], made, k: int) -> Iterator[pa.RecordBatch]:
    queries, weights, filled, words, schema = made.value
    unpack = zstandard.ZstdDecompressor().decompress
    best: list[list[tuple[int, int]]] = [[] for _ in queries]
    for batch in batches:
        for i in range(batch.num_rows):
            terms, sizes, lists = (batch.column(c)[i] for c in ("terms", "sizes", "packed"))
            block = Block(terms.values.to_numpy(), sizes.values.to_numpy(), np.frombuffer(unpack(lists.as_py()), np.int64),
                          weights, filled, words)
            docs = [1 << 63 if d is None else d for d in batch.column("docs")[i].as_py()]
            for heap, (_, own) in zip(best, queries):
                search(block, own, docs, heap, k)
    rows = [(q, item, score, None if d == -(1 << 63) else -d)
            for q, (heap, (item, _)) in enumerate(zip(best, queries)) for score, d in heap]
    if rows:
        task = TaskContext.get().partitionId() % GROUPS
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*((*r, task) for r in rows)), schema)],
                                         schema=schema)


def ranked(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", k: int = 10, part_bytes: int = PART_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item.

    Each row of ``items`` is a query of its own, also where ids or texts repeat.
    An item without a term, or with none that any document holds, has no rows;
    neither have documents without a term, which don't count as documents.  Null
    ids are allowed and rank behind others of equal score; rows that repeat an id
    are ranked each.  ``items`` of more than ``part_bytes`` of text are searched
    in parts, each against all documents; the result is the same.  Other columns
    of either table are not read.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    queries = items.select(F.col(item_id).alias("item"), F.col(item_text).alias("text")).where("text is not null")
    size = queries.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = math.ceil(size / part_bytes) or 1
    part = F.pmod(F.xxhash64("text"), F.lit(parts))
    found = [_part(spark, own, queries.where(part == n), k) for n in range(parts)]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.select(F.col("item").alias(item_id), "rank", F.col("doc").alias(doc_id), "score")


def _part(spark, docs: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    rows = [(item, [*dict.fromkeys(words_of(text))]) for item, text in queries.collect()]
    vocabulary = {t: i for i, t in enumerate(dict.fromkeys(t for _, terms in rows for t in terms))}
    share = spark.sparkContext.broadcast
    made = share((vocabulary, to_arrow_schema(StructType.fromDDL(BLOCKS))))
    blocks = materialize(docs.mapInArrow(lambda b: _blocks(b, made), BLOCKS))
    filled, words = (x or 0 for x in blocks.agg(F.sum("filled"), F.sum("words")).first())
    # One row per term of the queries.
    held = (blocks.select(F.explode(F.arrays_zip("terms", "sizes")).alias("t"))
            .groupBy("t.terms").agg(F.sum("t.sizes")).collect())
    weights = {t: math.floor(1000 * math.log((2 * filled + 2) / (2 * df + 1))) for t, df in held}
    schema = StructType([StructField("query", IntegerType()), StructField("item", queries.schema["item"].dataType),
                         StructField("score", LongType()), StructField("doc", LongType()), StructField("tasks", IntegerType())])
    asked = share(([(item, [vocabulary[t] for t in terms]) for item, terms in rows], weights, filled, words,
                   to_arrow_schema(schema)))
    some = blocks.select("docs", "terms", "sizes", "packed").mapInArrow(lambda b: _ranked(b, asked, k), schema)
    order = (F.col("score").desc(), F.col("doc").asc_nulls_last())
    place = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return (some.withColumn("rank", place("query", "tasks")).where(F.col("rank") <= k)
            .withColumn("rank", place("query")).where(F.col("rank") <= k).drop("query", "tasks"))
