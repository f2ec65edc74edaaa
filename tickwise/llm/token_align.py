"""Alignment of two tokenizers over the same bytes, once per distinct text.

1. *Exact-text deduplication.*  The rows are grouped by their full text with a
   map-side count, so copies meet before the shuffle; a text keeps its
   multiplicity and goes by the SHA-256 of its bytes from there on.
2. *Chunks.*  A task encodes some megabytes of distinct texts by both
   tokenizers.  Byte offsets where tokens end are marked in one array for the
   whole chunk; places with both marks part the groups, and every stretch
   between two marks is one link, since just one token of each side covers it.
   A chunk keeps its distinct pairs, and for each text which of them it links
   how often, as packed numbers.
3. *Pair counts.*  The pairs of all chunks, weighted by the multiplicity of the
   texts that link them, are summed with map-side aggregation.  The counts go
   back to the chunks that hold the pair, one row per chunk and pair, so neither
   the table of pairs nor the links of a frequent pair meet in one place.
4. *Measures* of each text come from its chunk and are joined to the rows.

Chunks are written before they are used twice, so a lost executor re-reads them.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import materialize

#: Bytes of text that are aligned together; a longer text is a chunk of its own.
CHUNK_BYTES = 4 << 20
#: Ids of either side are below this.
IDS = 1 << 24
# Fixed values of the byte-level alphabet: bytes that stand for themselves.
PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
PER_TEXT = "n_a int, n_b int, n_groups int, n_links int, groups_sha256 string, groups string"
CHUNKS = ("chunk long, keys array<binary>, texts array<struct<n_a:int,n_b:int,n_groups:int,n_links:int,"
          "groups_sha256:string,groups:string>>, sizes array<int>, pairs array<long>, weights array<long>, packed binary")
MEASURES = f"key binary, {PER_TEXT}, n_best long, count_sum long"


def load_byte_level(data: bytes) -> dict[bytes, int]:
    """Ids by token bytes from a byte-level BPE file, without special tokens.

    The order of the merges must be that of the ids, and nothing but the byte
    level may change a text, or the file is refused.
    """
    spec = json.loads(data)
    model, special = spec["model"], {t["id"] for t in spec["added_tokens"]}
    rest = (b for b in range(256) if b not in set(PLAIN))
    value = {chr(b): b for b in PLAIN} | {chr(256 + i): b for i, b in enumerate(rest)}
    ranks = {bytes(value[c] for c in token): i for token, i in model["vocab"].items() if i not in special}
    pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
    made = [model["vocab"][a + b] for a, b in pairs]
    own = spec["pre_tokenizer"]
    if (spec["normalizer"] or own["type"] != "ByteLevel" or own["add_prefix_space"] or made != sorted(made)
            or sorted(ranks.values()) != [*range(len(ranks))] or len(made) + 256 != len(ranks)):
        raise ValueError("not a plain byte-level BPE whose ids follow its merges")
    return ranks


class Aligner:
    """Encodes texts by both tokenizers and aligns them; made once a task."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, piece_model: bytes):
        self.a = tiktoken.Encoding("byte_level", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        token = {i: t for t, i in ranks.items()}
        self.a_bytes = [token[i] for i in range(len(token))]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i in range(self.b.get_piece_size()) for p in (self.b.id_to_piece(i),)]
        self.a_size, self.b_size = (np.array([len(t) for t in x]) for x in (self.a_bytes, self.b_bytes))
        # What an id adds to the text of groups: A inside and at the end of a group, then B.
        self.written = [f"{i}{mark}" for n, marks in ((len(self.a_bytes), ",|"), (len(self.b_bytes), ",;"))
                        for mark in marks for i in range(n)]

    def chunk(self, texts: list[str], keys: list[bytes], weights: list[int], groups: bool) -> dict:
        """One row of CHUNKS, without its id; texts that don't line up are left out."""
        a_ids, b_ids, held = [], [], []
        for i, (text, b) in enumerate(zip(texts, self.b.encode(texts, num_threads=1))):
            a, data = self.a.encode_ordinary(" " + text), b" " + text.encode()
            if text and b"".join(map(self.b_bytes.__getitem__, b)) == data == b"".join(map(self.a_bytes.__getitem__, a)):
                a_ids.append(np.array(a, np.int32))
                b_ids.append(np.array(b, np.int32))
                held.append(i)
        if not held:
            return {}
        a, b = np.concatenate(a_ids), np.concatenate(b_ids)
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        marks = np.zeros(a_end[-1] + 1, np.int8)
        marks[a_end] = 1
        marks[b_end] += 2
        ends = np.flatnonzero(marks)
        kind = marks[ends]
        a_of, b_of = (np.cumsum(kind & x > 0) - (kind & x > 0) for x in (1, 2))  # the tokens that cover each stretch
        both = kind == 3
        # Where each text begins among tokens, stretches and groups.
        n_a, n_b = np.array([len(x) for x in a_ids]), np.array([len(x) for x in b_ids])
        last = np.searchsorted(ends, a_end[np.cumsum(n_a) - 1])
        n_links = np.diff(last, prepend=-1)
        n_groups = np.diff(np.cumsum(both)[last], prepend=0)
        written = self._written(a, b, kind, np.cumsum(both) - both, a_of, b_of)
        cut = np.cumsum(n_a + n_b)
        told = ["".join(map(self.written.__getitem__, written[e - n:e].tolist()))[:-1] for e, n in zip(cut, n_a + n_b)]
        # Each text's distinct pairs, as places among the chunk's pairs, and how often.
        pair = a[a_of].astype(np.int64) * IDS + b[b_of]
        pairs, place = np.unique(pair, return_inverse=True)
        own = np.repeat(np.arange(len(held), dtype=np.int64), n_links) * len(pairs) + place
        entry, times = np.unique(own, return_counts=True)
        text, place = np.divmod(entry, len(pairs))
        weight = np.bincount(place, np.array([weights[i] for i in held], float)[text]).astype(np.int64)
        packed = np.concatenate([np.diff(place, prepend=0), times]).astype(np.int32).tobytes()
        rows = zip(*(x.tolist() for x in (n_a, n_b, n_groups, n_links)),
                   (hashlib.sha256(t.encode()).hexdigest() for t in told), told if groups else [None] * len(told))
        names = [f.split()[0] for f in PER_TEXT.split(", ")]
        return {"keys": [keys[i] for i in held], "texts": [dict(zip(names, r)) for r in rows],
                "sizes": np.bincount(text, minlength=len(held)).tolist(), "pairs": pairs.tolist(),
                "weights": weight.tolist(), "packed": zstandard.ZstdCompressor(3).compress(packed)}

    def _written(self, a, b, kind, group, a_of, b_of) -> np.ndarray:
        """Places in ``written`` of all tokens: group by group, first those of A."""
        a_last, b_last = kind & 1 > 0, kind & 2 > 0
        a_group, b_group = group[a_last], group[b_last]  # the group of each token
        n = group[-1] + 1
        before = lambda x: np.cumsum(np.bincount(x, minlength=n))  # noqa: E731  tokens up to a group's end
        out = np.empty(len(a) + len(b), np.int64)
        a_closes, b_closes = np.diff(a_group, append=n) > 0, np.diff(b_group, append=n) > 0
        out[np.arange(len(a)) + np.concatenate([[0], before(b_group)])[a_group]] = a + a_closes * len(self.a_bytes)
        out[np.arange(len(b)) + before(a_group)[b_group]] = (
            b + 2 * len(self.a_bytes) + b_closes * len(self.b_bytes))
        return out


def _chunks(batches: Iterator[pa.RecordBatch], made, groups: bool) -> Iterator[pa.RecordBatch]:
    aligner, schema, number = None, made.value[3], TaskContext.get().partitionId() << 32
    for batch in batches:
        aligner = aligner or Aligner(*made.value[:3])
        rows = [batch.column(c).to_pylist() for c in ("text", "key", "n")]
        size = np.cumsum([len(t) for t in rows[0]])
        at = 0
        while at < len(size):
            end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + CHUNK_BYTES, "right")))
            row = aligner.chunk(*(x[at:end] for x in rows), groups)
            at = end
            if row:
                yield pa.RecordBatch.from_pylist([row | {"chunk": number}], schema)
                number += 1


def _measures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for i in range(batch.num_rows):
            own = lambda c: batch.column(c)[i].values  # noqa: E731, B023
            sizes, pairs, held = own("sizes").to_numpy(), own("pairs").to_numpy(), own("counts")
            places, times = np.frombuffer(unpack(batch.column("packed")[i].as_py()), np.int32).astype(np.int64).reshape(2, -1)
            order = np.argsort(held.field("pair").to_numpy())  # each pair of the chunk once, as in ``pairs``
            count, top = (held.field(c).to_numpy(zero_copy_only=False)[order] for c in ("n", "top"))
            places = np.cumsum(places)
            begin = np.cumsum(sizes) - sizes
            texts = own("texts")
            yield pa.RecordBatch.from_arrays(
                [own("keys"), *texts.flatten(), pa.array(np.add.reduceat(times * top[places], begin)),
                 pa.array(np.add.reduceat(times * count[places], begin))],
                names=["key", *(f.name for f in texts.type), "n_best", "count_sum"])


def _key(text: str):
    return F.unhex(F.sha2(F.col(text), 256))


def chunks_of(docs: DataFrame, byte_level: bytes, pattern: str, piece_model: bytes, text: str = "text",
              groups: bool = False) -> DataFrame:
    """The aligned chunks of the distinct texts, written once."""
    schema = to_arrow_schema(StructType.fromDDL(CHUNKS))
    made = docs.sparkSession.sparkContext.broadcast((load_byte_level(byte_level), pattern, piece_model, schema))
    distinct = (docs.select(F.col(text).alias("text")).where("text <> ''")
                .groupBy("text").agg(F.count(F.lit(1)).alias("n")).select("text", _key("text").alias("key"), "n"))
    return materialize(distinct.mapInArrow(lambda b: _chunks(b, made, groups), CHUNKS))


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(pair, n, top): how many rows link the pair of ids (``pair`` is A id times
    IDS plus B id), and whether no pair of the A id is linked by more rows."""
    linked = chunks.select(F.explode(F.arrays_zip("pairs", "weights")).alias("p"))
    counts = linked.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.weights").alias("n"))
    own = Window.partitionBy(F.shiftright("pair", 24))  # at most as many rows as B has ids
    return counts.select("pair", "n", (F.col("n") == F.max("n").over(own)).alias("top"))


def aligned(docs: DataFrame, byte_level: bytes, pattern: str, piece_model: bytes, text: str = "text",
            out: str = "aligned", groups: bool = False) -> DataFrame:
    """``docs`` plus a struct ``out``: ``n_a``, ``n_b`` (tokens), ``n_groups``,
    ``n_links``, ``n_best``, ``count_sum`` and the ``groups`` as text (null unless
    asked for) with their ``groups_sha256``.

    A is the byte-level BPE of the file content ``byte_level``, over a space and
    the text; ``pattern`` is the one its byte level cuts by.  B is the piece model
    ``piece_model``, which adds the space.  Groups: ``a1,a2|b1;a3|b2`` in order.  A
    pair's count is the number of rows whose text links it; equal rows all count.

    A null or empty text, and one whose tokens don't spell it (such as one with
    U+2581), has no tokens: zeros and '' as digest and groups.  Other columns pass
    through; one named ``out`` is replaced, and any other name may be used.
    """
    chunks = chunks_of(docs, byte_level, pattern, piece_model, text, groups)
    counts = materialize(pair_counts(chunks))
    held = (chunks.select("chunk", F.explode("pairs").alias("pair")).join(counts, "pair")
            .groupBy("chunk").agg(F.collect_list(F.struct("pair", "n", "top")).alias("counts")))
    measures = chunks.drop("weights").join(held, "chunk").drop("chunk").mapInArrow(_measures, MEASURES)
    kept = [c for c in docs.columns if c != out]
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), _key(text).alias("key"))
    joined = keyed.join(measures.alias("m"), "key", "left")
    number = lambda c, kind="long": F.coalesce(F.col(c), F.lit(0)).cast(kind).alias(c)
    told = F.when(F.col("groups_sha256").isNull(), "").otherwise(F.col("groups")) if groups else F.lit(None).cast("string")
    return joined.select(*[F.col(f"row.`{c}`") for c in kept], F.struct(
        *[number(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")],
        told.alias("groups"), F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")).alias(out))
