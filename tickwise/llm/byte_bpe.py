"""Byte-level BPE by merge replay over batches of distinct pieces.

A text is split by the tokenizer's pattern and a task encodes every distinct
piece once while it keeps it, not once per occurrence; other tasks that meet
the piece replay it again.  The pieces of a batch lie one after another in
linked lists of tokens; an inverted index of the batch leads from a merge rank
to the positions whose pair merges at that rank, and the merges are replayed
over these pieces in rank order.  A merge touches only
its two neighbours' pairs, so a piece of n bytes costs O(n log n) however long
it is.  Nothing is shuffled; a lost task is simply run again.
"""

from __future__ import annotations

import base64
import gc
import heapq
from array import array
from bisect import bisect_right
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import (ArrayType, BinaryType, IntegerType, StructField, StructType)

from .common import append

#: Encoded pieces that a task keeps; beyond, it forgets them and starts again.
CACHED_PIECES = 600_000
#: Texts that are cut and encoded together.
ENCODED_TEXTS = 1_000
#: Pieces that are replayed together; their lists stay in the processor's cache.
REPLAYED_PIECES = 2_000
#: Token ids are below 2 to this power.
PAIR_BITS = 20
ENCODED = StructType([StructField("ids", ArrayType(IntegerType(), False), False),
                      StructField("decoded", BinaryType(), False)])


def load_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks from the lines ``base64(token) rank`` of a rank file."""
    return {base64.b64decode(token): int(rank)
            for token, rank in (line.split() for line in data.splitlines() if line)}


class MergeReplay:
    """Encodes byte strings by ranks; the vocabulary must hold all 256 bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.vocab = {rank: token for token, rank in ranks.items()}
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)])
        # Every pair of tokens that makes a token, and its rank.
        self.pairs = {(ranks[token[:at]] << PAIR_BITS) + ranks[token[at:]]: rank
                      for token, rank in ranks.items() for at in range(1, len(token))
                      if token[:at] in ranks and token[at:] in ranks}
        self.first = np.array([[self.pairs.get((int(a) << PAIR_BITS) + int(b), -1) for b in self.bytes]
                               for a in self.bytes])

    def encode(self, pieces: list[bytes]) -> list[list[int]]:
        """Token ids of each piece, as lowest-rank-first merging gives them."""
        out: list = [[self.ranks[p]] if p in self.ranks else None for p in pieces]
        todo = [k for k, ids in enumerate(out) if ids is None]
        lengths = np.array([len(pieces[k]) for k in todo], np.int64)
        raw = np.frombuffer(b"".join(pieces[k] for k in todo), np.uint8)
        ends = np.cumsum(lengths)
        starts = (ends - lengths).tolist()
        token = self.bytes[raw].tolist()
        after = np.arange(1, len(raw) + 1)
        before = np.arange(-1, len(raw) - 1)
        after[ends[lengths > 0] - 1] = -1
        before[(ends - lengths)[lengths > 0]] = -1
        # The inverted index: from a rank to the places of the pairs that merge at it.
        merges = self.first[raw[:-1], raw[1:]] if len(raw) else np.empty(0, int)
        merges[after[:-1] < 0] = -1
        order = np.argsort(merges, kind="stable")
        found, cut = np.unique(merges[order], return_index=True)
        index = {int(r): places.tolist() for r, places in zip(found, np.split(order, cut[1:])) if r >= 0}
        after, before = after.tolist(), before.tolist()
        heap = list(index)
        heapq.heapify(heap)
        pairs, entry, bits = self.pairs.get, index.get, PAIR_BITS
        while heap:
            r = heapq.heappop(heap)
            places = index.pop(r)
            places.sort()
            # A merge may open a pair of lower rank, which comes first in its piece.
            held: set[int] = set()
            later: list[int] = []
            high = r << bits
            for p in places:
                left, q = token[p], after[p]
                if left < 0 or q < 0 or pairs((left << bits) + token[q]) != r:
                    continue
                if held and bisect_right(starts, p) in held:
                    later.append(p)
                    continue
                token[p], token[q] = r, -1
                after[p] = n = after[q]
                if n >= 0:
                    before[n] = p
                    new = pairs(high + token[n])
                    if new is not None:
                        if (waiting := entry(new)) is not None:
                            waiting.append(p)
                        else:
                            index[new] = [p]
                            heapq.heappush(heap, new)
                        if new < r:
                            held.add(bisect_right(starts, p))
                n = before[p]
                if n >= 0:
                    new = pairs((token[n] << bits) + r)
                    if new is not None:
                        if (waiting := entry(new)) is not None:
                            waiting.append(n)
                        else:
                            index[new] = [n]
                            heapq.heappush(heap, new)
                        if new < r:
                            held.add(bisect_right(starts, p))
            if later:
                index[r] = later
                heapq.heappush(heap, r)
        for k, start, length in zip(todo, starts, lengths.tolist()):
            out[k] = [t for t in token[start:start + length] if t >= 0]
        return out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.vocab.__getitem__, ids))


class Encoder:
    """Encodes batches of texts; each distinct piece is replayed once."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.replay = MergeReplay(ranks)
        self.cut = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}  # a piece's ids, as 32-bit integers
        self.types = to_arrow_type(ENCODED["ids"].dataType), pa.binary()

    def some(self, texts: list[str]) -> list[np.ndarray]:
        known = self.known
        if len(known) > CACHED_PIECES:
            known.clear()
        pieces = [self.cut(t) for t in texts]
        new = list(set(chain.from_iterable(pieces)).difference(known))
        for at in range(0, len(new), REPLAYED_PIECES):
            part = new[at:at + REPLAYED_PIECES]
            made = self.replay.encode([w.encode() for w in part])
            known.update(zip(part, (array("i", ids).tobytes() for ids in made)))
        return [np.frombuffer(b"".join(map(known.__getitem__, own)), np.int32) for own in pieces]

    def run(self, texts: list) -> pa.Array:
        # Nothing here refers to itself; the collector would only walk the lists again and again.
        gc.disable()
        try:
            ids = [x for at in range(0, len(texts), ENCODED_TEXTS)
                   for x in self.some([t or "" for t in texts[at:at + ENCODED_TEXTS]])]
        finally:
            gc.enable()
        offsets = np.cumsum([0, *map(len, ids)], dtype=np.int32)
        return pa.StructArray.from_arrays(
            [pa.ListArray.from_arrays(offsets, np.concatenate(ids), type=self.types[0]),
             pa.array([self.replay.decode(own.tolist()) for own in ids], self.types[1])],
            fields=list(to_arrow_type(ENCODED)))


def encode_decode(docs: DataFrame, rank_file: bytes, pattern: str, text: str = "text",
                  out: str = "bpe") -> DataFrame:
    """``docs`` plus a struct ``out``: the token ``ids`` of the text, and the
    bytes ``decoded`` from them.

    ``rank_file``: the content of a rank file (under 1 MB, shipped with the
    task); ``pattern``: the pattern that cuts a text into pieces.  No special
    tokens.  A null text counts as empty: no ids, no bytes.  Other columns pass
    through; one named ``out`` is replaced.
    """
    packed = docs.sparkSession.sparkContext.broadcast(rank_file)

    def start():
        return Encoder(load_ranks(packed.value), pattern).run

    return append(docs, text, out, ENCODED, start)
