"""Exact repeats of long byte strings by prefix-free parsing.

Every byte is removed that lies in a string of ``length`` bytes which also
starts somewhere else.  The corpus is not sorted as a whole:

1. *Triggers.*  A rolling hash of 12 bytes has a least value among the first
   ``spread`` places of each string of ``length`` bytes; that place is the
   string's trigger.  It depends on the string alone, so equal strings have
   their trigger at the same distance from their start.  Triggers cut a
   document into phrases of at most ``spread`` bytes; all starts that share a
   trigger are successive.
2. *Candidates.*  The bytes that every string of a trigger has in common (its
   core) and those of all its strings together (its reach) are hashed.  A core
   that occurs once settles its strings as unique, a reach that occurs twice
   settles them as repeats; both follow from counts with map-side aggregation.
3. *Corpus order.*  What remains are triggers with one core and unlike reaches,
   one representative of each reach.  For each core, the phrases before the
   trigger form the dictionary, sorted by their ends (equal phrase suffixes of
   k bytes are then neighbours), and the text that follows forms the parse,
   sorted with its LCP array.  Strings that start k bytes before a trigger lie
   in corpus order by phrase suffix first and rank in the parse second, and
   one is a repeat exactly if a neighbour in that order shares ``length`` bytes.
4. *Removal.*  The runs found go back to their documents.

A core with more reaches than a task should hold is settled start by start: a
hash of each string is counted, so no group is capped and none grows with the
corpus.  Texts are packed before they are shuffled.  Reaches and strings are
compared by 64-bit hashes beside that of their core.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from ..session import materialize
from .common import append

LENGTH = 400
SPREAD = 192
TRIGGER = 12
#: Starts whose triggers are found at once.
SEGMENT = 1 << 21
#: Reaches of one core that one task orders; a core with more is counted.
TASK_ROWS = 2_000
_RANDOM = np.random.default_rng(20).integers(1 << 63, size=(256,), dtype=np.uint64)
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)

ANCHORS = "k long, doc long, t int, lo int, hi int, core long, reach long"
CONTEXTS = "core long, k long, doc long, t int, lo int, hi int, n long, left binary, right binary, string long"
SPANS = "k long, doc long, start int, end int"
CUT = StructType([StructField(c, LongType(), False) for c in ("n_bytes", "n_removed", "n_spans")]
                 + [StructField("kept", BinaryType(), False)])


def hashed(values) -> np.ndarray:
    """64-bit hashes of byte strings, as signed integers."""
    return np.array([xxhash.xxh3_64_intdigest(v) for v in values], np.uint64).view(np.int64)


def triggers(data: bytes, length: int = LENGTH, spread: int = SPREAD) -> tuple[np.ndarray, ...]:
    """(t, lo, hi): the triggers of a text, and the least and greatest distance
    to the strings' starts.  Of equal hashes the first place is the trigger."""
    starts = len(data) - length + 1
    if starts <= 0:
        return (np.empty(0, np.int64),) * 3
    h = _RANDOM[np.frombuffer(data, np.uint8)]
    size = 1
    for factor in _FACTORS:  # sums of 2, 4, 8 and then 12 bytes
        step = min(size, TRIGGER - size)
        h = h[:-step] * factor + h[step:]
        size += step
    h ^= h >> np.uint64(29)
    key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    size = 1
    while size < spread:
        step = min(size, spread - size)
        key = np.minimum(key[:-step], key[step:])
        size += step
    at = (key[:starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
    last = np.concatenate([first[1:], [starts]]) - 1
    t = at[first]
    return t, t - last, t - first


def _anchors(batches: Iterator[pa.RecordBatch], length: int, spread: int) -> Iterator[pa.RecordBatch]:
    core = length - spread + 1
    for batch in batches:
        for k, doc, data in zip(*(batch.column(c).to_pylist() for c in ("k", "doc", "data"))):
            # A very long text is cut by starts; a trigger on a cut gets two rows.
            for at in range(0, len(data) - length + 1, SEGMENT):
                t, lo, hi = triggers(data[at:at + SEGMENT + length - 1], length, spread)
                p, a, b = (t + at).tolist(), lo.tolist(), hi.tolist()
                n = len(p)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, k)), pa.array(np.full(n, doc)),
                    *(pa.array(x, pa.int32()) for x in (p, a, b)),
                    pa.array(hashed(data[x:x + core] for x in p)),
                    pa.array(hashed(data[x - z:x - y + length] for x, y, z in zip(p, a, b)))],
                    names=["k", "doc", "t", "lo", "hi", "core", "reach"])


def _contexts(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """For the picked triggers the phrase before and the text after; for those
    of crowded cores a hash of each string instead."""
    names = ["core", "k", "doc", "t", "lo", "hi", "n", "left", "right", "string"]
    types = [pa.int64(), pa.int64(), pa.int64(), *[pa.int32()] * 3, pa.int64(), pa.binary(), pa.binary(), pa.int64()]
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        rows, size = [], 0
        for row in batch.to_pylist():
            data = unpack(row["packed"])
            for p in row["picked"]:
                t, lo, hi = p["t"], p["lo"], p["hi"]
                head = (p["core"], row["k"], row["doc"], t)
                if p["crowded"]:
                    strings = hashed(data[t - o:t - o + length] for o in range(lo, hi + 1)).tolist()
                    rows += [(*head, o, o, p["n"], None, None, s) for o, s in zip(range(lo, hi + 1), strings)]
                else:
                    rows.append((*head, lo, hi, p["n"], data[t - hi:t], data[t:t - lo + length], None))
                size += length if p["crowded"] else length + hi
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(zip(*rows), types)], names=names)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(zip(*rows), types)], names=names)


def _padded(values: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(v) for v in values])
    return np.frombuffer(b"".join(v.ljust(width, b"\0") for v in values), np.uint8).reshape(-1, width), sizes


def _common(values: list[bytes], width: int) -> np.ndarray:
    """LCP array: bytes that each value shares with the one before it."""
    rows, sizes = _padded(values, width + 1)
    out = np.zeros(len(values), np.int64)
    for at in range(1, len(values), 1024):
        part = rows[at - 1:at + 1024]
        out[at:at + 1024] = (part[1:] != part[:-1]).argmax(axis=1) + width * (part[1:] == part[:-1]).all(axis=1)
    out[1:] = np.minimum(out[1:], np.minimum(sizes[1:], sizes[:-1]))
    return out


def repeats(core: np.ndarray, left: list[bytes], right: list[bytes], lo: np.ndarray, hi: np.ndarray,
            length: int = LENGTH) -> np.ndarray:
    """For each trigger (row) and distance (column): does the string that starts
    so far before the trigger occur at another one of the same core?"""
    n, width = len(core), int(hi.max()) + 1
    found = np.zeros((n, width), bool)
    # The parse: what follows the triggers, sorted, and its LCP array.
    keys = core.tolist()
    order = sorted(range(n), key=lambda i: (keys[i], right[i]))
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    lcp = _common([right[i] for i in order], length)
    lcp[1:][core[order][1:] != core[order][:-1]] = 0
    table = [lcp]
    while 1 << len(table) <= n:
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))

    def shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bytes that the texts of ranks a < b share: the least LCP between."""
        level = np.frexp((b - a).astype(float))[1] - 1
        out = np.empty(len(a), np.int64)
        for x in np.unique(level):
            own = level == x
            out[own] = np.minimum(table[x][a[own] + 1], table[x][b[own] + 1 - (1 << int(x))])
        return out

    # The dictionary: the phrases before the triggers, sorted by their ends.
    ends = [v[::-1] for v in left]
    by_end = np.array(sorted(range(n), key=lambda i: (keys[i], ends[i])))
    suffix = _common([ends[i] for i in by_end], width)
    suffix[1:][core[by_end][1:] != core[by_end][:-1]] = -1
    suffix[0] = -1
    for o in range(int(lo.min()), width):
        group = np.empty(n, np.int64)
        group[by_end] = np.cumsum(suffix < o)
        rows = np.flatnonzero((lo <= o) & (o <= hi))
        rows = rows[np.lexsort((rank[rows], group[rows]))]
        same = np.flatnonzero(group[rows[1:]] == group[rows[:-1]])
        if not len(same):
            continue
        a, b = rows[same], rows[same + 1]
        near = shared(rank[a], rank[b]) >= length - o
        found[a[near], o] = True
        found[b[near], o] = True
    return found


def _ordered(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Runs of repeated strings from a stream sorted by core; a core that a
    batch cuts is carried to the next one."""
    left = None

    def solve(table: pa.Table) -> pa.RecordBatch:
        lo, hi, t, n = (table.column(c).to_numpy() for c in ("lo", "hi", "t", "n"))
        found = repeats(table.column("core").to_numpy(), table.column("left").to_pylist(),
                        table.column("right").to_pylist(), lo, hi, length)
        found[n > 1] = False  # settled before
        edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, first = np.nonzero(edge == 1)
        last = np.nonzero(edge == -1)[1] - 1
        return pa.RecordBatch.from_arrays(
            [pa.array(table.column("k").to_numpy()[row]), pa.array(table.column("doc").to_numpy()[row]),
             pa.array((t[row] - last).astype(np.int32)), pa.array((t[row] - first + length).astype(np.int32))],
            names=["k", "doc", "start", "end"])

    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([left, table]) if left is not None else table
        core = table.column("core").to_numpy()
        cut = np.flatnonzero(core[1:] != core[:-1])
        whole = int(cut[-1]) + 1 if len(cut) else 0
        left = table.slice(whole).combine_chunks()
        if whole:
            yield solve(table.slice(0, whole))
    if left is not None and left.num_rows:
        yield solve(left)


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The key of a row is its id and its text: equal rows lose equal bytes."""
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    doc = F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63)))
    return docs.select(*docs.columns, F.xxhash64(doc, data).alias("__k"), doc.alias("__doc"), data.alias("__data"))


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
                   spread: int = SPREAD, task_rows: int = TASK_ROWS) -> DataFrame:
    """(k, doc, start, end): runs of bytes in repeated strings of ``length``
    bytes; they may overlap, and their union is what is repeated."""
    keyed = _keyed(docs.select(doc_id, text), doc_id, text).select(
        F.col("__k").alias("k"), F.col("__doc").alias("doc"), F.col("__data").alias("data"))
    long_enough = keyed.where(F.octet_length("data") >= length)
    anchors = materialize(long_enough.mapInArrow(lambda b: _anchors(b, length, spread), ANCHORS))
    # Counts are written before they are joined, so that the join may split a hot core.
    cores = materialize(anchors.groupBy("core").agg(
        F.count(F.lit(1)).alias("n"), F.min("reach").alias("a"), F.max("reach").alias("b")).where("n > 1"))
    met = materialize(anchors.join(cores.select("core", (F.col("a") == F.col("b")).alias("alike")), "core"))
    run = ["k", "doc", (F.col("t") - F.col("hi")).alias("start"), (F.col("t") - F.col("lo") + length).alias("end")]
    alike = met.where("alike").select(*run)

    unlike = met.where("not alike")
    reaches = materialize(unlike.groupBy("core", "reach").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("k", "doc", "t", "lo", "hi")).alias("r")))
    # A stage of its own, so that the join may split a reach that many documents share.
    twice = materialize(unlike.join(reaches.where("n > 1").select("core", "reach"), ["core", "reach"], "left_semi")
                        .select(*run))
    crowds = materialize(reaches.groupBy("core").agg((F.count(F.lit(1)) > task_rows).alias("crowded")))
    picked = (reaches.join(crowds, "core").select("r.k", "r.doc", F.struct("core", "r.t", "r.lo", "r.hi", "n", "crowded").alias("p"))
              .groupBy("k", "doc").agg(F.collect_list("p").alias("picked")))
    contexts = materialize(_packed(keyed).join(picked, ["k", "doc"])
                           .mapInArrow(lambda b: _contexts(b, length), CONTEXTS))
    ordered = (contexts.where("string is null").repartition("core").sortWithinPartitions("core")
               .mapInArrow(lambda b: _ordered(b, length), SPANS))
    strings = contexts.where("string is not null")
    often = materialize(strings.groupBy("core", "string").agg(F.sum("n").alias("all")).where("all > 1")
                        .select("core", "string"))
    counted = materialize(strings.where("n = 1").join(often, ["core", "string"], "left_semi").select(*run))
    return alike.unionByName(twice).unionByName(ordered).unionByName(counted)


def _packed(keyed: DataFrame) -> DataFrame:
    def start():
        pack = zstandard.ZstdCompressor(level=3).compress
        return lambda values: [pack(v) for v in values]
    return append(keyed, "data", "packed", BinaryType(), start).drop("data")


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", out: str = "cut",
                    length: int = LENGTH, spread: int = SPREAD, task_rows: int = TASK_ROWS) -> DataFrame:
    """(doc_id, ``out``): for each row ``n_bytes``, ``n_removed``, ``n_spans`` (maximal
    removed runs) and the bytes ``kept``.

    A null text is empty; texts below ``length`` bytes keep everything, and so
    does a text all of whose strings occur once.  Strings that repeat within
    one document, or overlap, count as well; matches never cross documents.  Of
    repeated rows each loses the same.  A null id is allowed.  Bytes may be cut
    inside a character, so the rest is binary.
    """
    spans = (repeated_spans(docs, doc_id, text, length, spread, task_rows)
             .groupBy("k", "doc").agg(F.collect_set(F.struct("start", "end")).alias("spans")))
    keyed = _keyed(docs.select(doc_id, text), doc_id, text).select(
        F.col(doc_id), F.col("__k").alias("k"), F.col("__doc").alias("doc"), F.col("__data").alias("data"))
    both = _packed(keyed).join(spans, ["k", "doc"], "left").select(
        doc_id, F.struct("packed", "spans").alias("both"))

    def start():
        unpack = zstandard.ZstdDecompressor().decompress

        def cut(row: dict) -> dict:
            data = unpack(row["packed"])
            runs: list[list[int]] = []
            for s in sorted((x["start"], x["end"]) for x in row["spans"] or ()):
                if runs and s[0] <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], s[1])
                else:
                    runs.append([*s])
            edges = [0, *(x for r in runs for x in r), len(data)]
            kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
            return {"n_bytes": len(data), "n_removed": len(data) - len(kept), "n_spans": len(runs), "kept": kept}

        return lambda rows: [cut(r) for r in rows]

    return append(both, "both", out, CUT, start).select(doc_id, out)
