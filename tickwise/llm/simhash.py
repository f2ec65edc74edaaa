"""SimHash near-duplicates by a binary trie self-join.

The distinct 64-bit fingerprints form a binary trie.  Two nodes of one depth
are traversed together: their children are paired, a pair of unlike children
costs one differing bit, and a pair whose bits exceed the budget is pruned
with all that lies below it.

The traversal is dealt out in two ways.  A pair within ``budget`` bits agrees
in at least one of ``budget + 1`` blocks of the fingerprint, so the trie is
entered once for each block, turned to stand on top, at the nodes that spell
the block out: no bit differs so far.  A pair of nodes with few fingerprints
is then traversed within one task, all pairs of a batch at once, bit by bit.
A pair with many is taken a byte further by a join of its children, as often
as needed: when all bits are spelt out a node holds one fingerprint, so no
task ever gets an unbounded group, and no bucket is capped.

A task keeps a spanning forest of the links it finds, not all pairs; the
forests' components are joined by alternating large-star and small-star steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ..session import materialize
from .common import append, spare

SHINGLE_WORDS = 3
BUDGET = 3
BITS = 64
#: Fingerprints of a node pair that are traversed within one task.
TASK_ROWS = 1024
#: Pairs of fingerprints that a step within a task may look at, at most.
TASK_PAIRS = 1 << 20
#: Shingles that are hashed and counted at once.
COUNTED = 1 << 16
SEED = 42


def fingerprint(text: str | None, size: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a text, as a signed integer.

    A-Z are lower-cased; words are parted by ASCII white space; a shingle is
    ``size`` words (repeats count; fewer words are one shingle) joined by
    spaces.  A bit is set if it is set in over half the hashes.  Without words,
    or null: zero.
    """
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])
    n = max(1, len(words) - size + 1)
    ends = (ends[size - 1:] if len(words) >= size else ends[-1:]) - 1
    hashed, counts = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, n, COUNTED):
        part = zip(starts[at:min(n, at + COUNTED)].tolist(), ends[at:at + COUNTED].tolist())
        hashes = np.array([hashed(joined[a:b], SEED) for a, b in part], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", out: str = "fp",
                     size: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` plus the signed fingerprint ``out`` of ``text``."""
    return append(docs, text, out, LongType(),
                  lambda: lambda texts: [fingerprint(t, size) for t in texts])


def node_pairs(values: np.ndarray, pairs: np.ndarray, depth: int, errors: np.ndarray,
               budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of fingerprints within ``budget`` bits.

    ``values``: fingerprints, sorted within each node.  ``pairs``: the ranges
    (a start, a end, b start, b end) of node pairs at ``depth``; a node paired
    with itself has equal ranges.  ``errors``: the bits that differ so far.
    """
    for bit in range(BITS - depth - 1, -1, -1):
        if not len(pairs):
            return
        a, a_end, b, b_end = pairs.T
        selves = a == b
        single = (a_end - a == 1) & (b_end - b == 1)
        i, j = a[single & ~selves], b[single & ~selves]
        near = np.bitwise_count(values[i] ^ values[j]) <= budget
        yield i[near], j[near]
        pairs, errors, selves = pairs[~single], errors[~single], selves[~single]
        a, a_end, b, b_end = pairs.T
        zeros = np.concatenate([[0], np.cumsum((values >> np.uint64(bit)) & np.uint64(1) == 0)])
        a_mid, b_mid = a + zeros[a_end] - zeros[a], b + zeros[b_end] - zeros[b]
        children = [((a, a_mid, b, b_mid), 0, None), ((a_mid, a_end, b_mid, b_end), 0, None),
                    ((a, a_mid, b_mid, b_end), 1, None), ((a_mid, a_end, b, b_mid), 1, ~selves)]
        found, costs = [], []
        for (p, p_end, q, q_end), cost, only in children:
            keep = (p < p_end) & (q < q_end) & (errors + cost <= budget)
            if only is not None:
                keep &= only
            found.append(np.stack([p, p_end, q, q_end], axis=1)[keep])
            costs.append(errors[keep] + cost)
        pairs, errors = np.concatenate(found), np.concatenate(costs)
    a, _, b, _ = pairs.T
    yield a[a != b], b[a != b]


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes the lowest node of its component."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _turned(block: int, width: int) -> Column:
    """The fingerprint with ``block`` on top (as signed bits)."""
    shift = block * width
    v = F.col("fp")
    return v if not shift else F.shiftleft(v, shift).bitwiseOR(F.shiftrightunsigned(v, BITS - shift))


def _traverse(batches: Iterator[pa.RecordBatch], budget: int) -> Iterator[pa.RecordBatch]:
    """Links of the node pairs in a sorted stream of rows; a node pair that a
    batch cuts is carried to the next one."""
    left = None
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def solve(table: pa.Table) -> Iterator[pa.RecordBatch]:
        cols = {c: table.column(c).to_numpy() for c in ("turn", "p", "q", "errors", "depth", "side", "v", "id")}
        values = cols["v"].astype(np.uint64)
        key = np.stack([cols[c] for c in ("turn", "p", "q", "errors", "side")])
        cut = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        start = np.concatenate([[0], cut])
        end = np.concatenate([cut, [len(values)]])
        same = (key[:4, start[1:]] == key[:4, start[:-1]]).all(axis=0)  # a second side follows
        selves = cols["p"][start] == cols["q"][start]
        first = np.flatnonzero(np.concatenate([same, [False]]))
        pairs = np.concatenate([np.stack([start[selves], end[selves]] * 2, axis=1),
                                np.stack([start[first], end[first], start[first + 1], end[first + 1]], axis=1)])
        cost = np.cumsum((pairs[:, 1] - pairs[:, 0]) * (pairs[:, 3] - pairs[:, 2]))
        at = 0
        while at < len(pairs):
            upto = max(at + 1, int(np.searchsorted(cost, (cost[at - 1] if at else 0) + TASK_PAIRS, "right")))
            part = pairs[at:upto]
            for depth in np.unique(cols["depth"][part[:, 0]]):
                own = part[cols["depth"][part[:, 0]] == depth]
                hits = list(node_pairs(values, own, int(depth), cols["errors"][own[:, 0]], budget))
                i, j = (np.concatenate(x) for x in zip(*hits)) if hits else (np.empty(0, int),) * 2
                used = np.unique(np.concatenate([i, j]))
                if not len(used):
                    continue
                label = used[forest(len(used), np.searchsorted(used, i), np.searchsorted(used, j))]
                other = used != label
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols["id"][used[other]]), pa.array(cols["id"][label[other]])], schema=schema)
            at = upto

    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([left, table]) if left is not None else table
        key = np.stack([table.column(c).to_numpy() for c in ("turn", "p", "q", "errors")])
        changes = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0))
        whole = int(changes[-1]) + 1 if len(changes) else 0
        left = table.slice(whole).combine_chunks()
        if whole:
            yield from solve(table.slice(0, whole))
    if left is not None and left.num_rows:
        yield from solve(left)


def links(fps: DataFrame, budget: int = BUDGET, task_rows: int = TASK_ROWS) -> DataFrame:
    """(a, b): links that join the same components as all pairs of
    fingerprints within ``budget`` bits.

    ``fps``: distinct signed ``fp`` and an ``id`` for each.
    """
    width = BITS // (budget + 1)
    node = F.shiftrightunsigned("v", BITS - width)
    front = fps.select("id", F.posexplode(F.array(*[_turned(k, width) for k in range(budget + 1)]))
                       .alias("turn", "v"))
    front = front.select("turn", node.alias("p"), node.alias("q"), F.lit(0).alias("errors"),
                         F.lit(0).alias("side"), "v", "id")
    keys, depth, found = ["turn", "p", "q", "errors"], width, None
    while True:
        sides = front.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("side").alias("n_b"))
        alive = sides.where(F.when(F.col("p") == F.col("q"), F.col("n") > 1)
                            .otherwise((F.col("n_b") > 0) & (F.col("n_b") < F.col("n"))))
        many = F.col("n") > task_rows
        few = front.join(alive.where(~many).select(*keys), keys)
        part = (few.withColumn("depth", F.lit(depth)).repartition(*keys)
                .sortWithinPartitions(*keys, "side", F.shiftrightunsigned("v", 1), F.expr("v & 1"))
                .mapInArrow(lambda batches: _traverse(batches, budget), "a long, b long"))
        part = materialize(part)
        found = part if found is None else found.unionByName(part)
        if depth >= BITS:
            return found
        heavy = materialize(front.join(alive.where(many).select(*keys), keys))
        if heavy.isEmpty():
            return found
        front = materialize(_step(heavy, keys, depth, budget))
        depth += 8


def _step(front: DataFrame, keys: list[str], depth: int, budget: int) -> DataFrame:
    """The rows of crowded node pairs, dealt to the pairs of their children one
    byte down whose bits keep the budget."""
    child = F.shiftrightunsigned("v", BITS - depth - 8).bitwiseAND(F.lit(255))
    rows = front.withColumn("child", child)
    nodes = rows.select(*keys, "side", "child").distinct()
    selves = F.col("p") == F.col("q")
    a = nodes.where(F.col("side") == 0).select(*keys, F.col("child").alias("c"))
    b = nodes.where(selves | (F.col("side") == 1)).select(*keys, F.col("child").alias("d"))
    more = F.col("errors") + F.bit_count(F.col("c").bitwiseXOR(F.col("d")))
    pairs = (a.join(b, keys).where((more <= budget) & (~selves | (F.col("c") <= F.col("d"))))
             .select(*keys, "c", "d", more.alias("more")))
    up = lambda x, c: F.shiftleft(x, 8).bitwiseOR(F.col(c))
    def dealt(pairs, at, side):
        return (rows.where(selves | (F.col("side") == side)).drop("side")
                .join(pairs.withColumn("child", F.col(at)), [*keys, "child"])
                .select("turn", up("p", "c").alias("p"), up("q", "d").alias("q"),
                        F.col("more").alias("errors"), F.lit(side).alias("side"), "v", "id"))
    # A child paired with itself needs its rows once.
    return dealt(pairs, "c", 0).unionByName(dealt(pairs.where(~selves | (F.col("c") < F.col("d"))), "d", 1))


def components(edges: DataFrame) -> DataFrame:
    """(id, root): the lowest id of each id's component, for the linked ids.

    Alternating steps: large-star ties all larger neighbours to the least one,
    small-star the smaller ones; the number of rounds grows with the logarithm
    of a component's size.  A hub's least neighbour comes from a map-side
    aggregation, and the join that follows may split the hub.
    """
    def low(df: DataFrame) -> DataFrame:
        return df.groupBy("u").agg(F.min("v").alias("m"))

    def signature(df: DataFrame):
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    tree = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                       .where("u <> v").distinct())
    seen = signature(tree)
    while True:
        both = tree.unionByName(tree.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = low(both).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        large = materialize(large)
        least = low(large)
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        tree = materialize(small)
        now = signature(tree)
        if now == seen:
            return tree.select(F.col("u").alias("id"), F.col("v").alias("root"))
        seen = now


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    size: int = SHINGLE_WORDS, budget: int = BUDGET,
                    task_rows: int = TASK_ROWS) -> DataFrame:
    """(doc_id, fp, component_id, root, text_hash): for each row its fingerprint
    and the smallest ``doc_id`` reachable over links of at most ``budget``
    differing bits; the lowest fingerprint of the component; xxhash64 of the text.

    Equal fingerprints are linked, those of texts without words (zero; null
    texts too) like any other.  A row with a null ``doc_id`` gets the component
    of its fingerprint, or null if no row with an id has that fingerprint; it
    links nothing itself.  Repeated rows each give a row; rows of one id with
    unlike texts aren't linked by it, so two components may share an id.
    """
    rows = materialize(with_fingerprint(docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                                                    F.col(text).alias("text")), "text", "fp", size)
                       .select("doc_id", "fp", F.xxhash64("text").alias("text_hash")))
    fps = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")).where("least is not null"))
    roots = components(links(fps.select("fp", F.col("fp").alias("id")), budget, task_rows))
    rooted = materialize(fps.join(roots.withColumnRenamed("id", "fp"), "fp", "left")
                         .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(names, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp", "left").select("doc_id", "fp", "component_id", "root", "text_hash")


def one_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """One document of each component of ``found``: that with the component's id.

    Rows without an id stay.  Of a component's rows with that id, the one whose
    text has the smallest hash stays.
    """
    columns, own = docs.columns, spare(docs.columns)
    key, row = [f"{own}id", f"{own}hash"], f"{own}row"
    kept = (found.where(F.col("doc_id") == F.col("component_id"))
            .groupBy("root").agg(F.min("doc_id").alias(key[0]), F.min("text_hash").alias(key[1]))
            .select(*key))
    keys = [F.col("doc_id").cast("long").alias(key[0]), F.xxhash64("text").alias(key[1])]
    staying = docs.select("*", *keys).join(kept, key, "left_semi")
    # Equal texts of one id lie in one component.
    one = (staying.groupBy(*key)
           .agg(F.first(F.struct(*columns)).alias(row)).select(f"{row}.*"))
    return one.unionByName(docs.where(F.col("doc_id").isNull()))
