"""Language identification by string kernels.

A text is the set of its blended-spectrum n-grams: the 1- to 3-byte strings
of its lower-cased UTF-8, hashed to fixed places.  The presence kernel of two
texts counts the n-grams that both hold, divided by the root of the product
of their numbers.  With m landmark texts the Nyström map is K(x, landmarks)
K(landmarks, landmarks)^-1/2, on which a ridge regression is solved for each
language against the rest.  Its normal equations are sums over the training rows,
so tasks add up their own rows and only landmark-by-landmark matrices meet.
Scoring a batch is two matrix products: presence by landmarks, and kernel by
coefficients.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StringType, StructField, StructType

from ..session import materialize
from .common import append, held_out

#: Places of the 1-, 2- and 3-grams.
PLACES = (256, 4096, 8192)
#: Training rows of a language, all training rows, landmarks: about so many.
PER_LANGUAGE, MAX_ROWS, LANDMARKS = 1_000, 20_000, 192
RIDGE = 1e-3
#: Tasks that add up the training rows.
TRAIN_TASKS = 8
SCORED = 256
#: Bytes of a text that are looked at in one step.
SEGMENT = 1 << 22
GUESS = StructType([StructField("lang", StringType(), False), StructField("score", DoubleType(), False)])


def presence(text: str, row: np.ndarray) -> None:
    """Mark the n-grams of a text in a row of zeros."""
    whole = np.frombuffer(text.lower().encode(), np.uint8)
    for start in range(0, len(whole), SEGMENT):
        data = whole[start:start + SEGMENT + len(PLACES) - 1].astype(np.uint32)
        at, code = 0, data
        for n, places in enumerate(PLACES, 1):
            if n > 1:
                code = code[:-1] * np.uint32(256) + data[n - 1:]
            row[at + (code if n == 1 else (code * np.uint32(2654435761) >> np.uint32(16)) % np.uint32(places))] = 1
            at += places


def matrix(texts: list[str]) -> np.ndarray:
    out = np.zeros((len(texts), sum(PLACES)), np.float32)
    for text, row in zip(texts, out):
        presence(text, row)
    return out


def kernel(x: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Presence kernel of the rows with the landmarks."""
    sizes = np.maximum(1, x.sum(axis=1))[:, None] * np.maximum(1, landmarks.sum(axis=1))[None, :]
    return x @ landmarks.T / np.sqrt(sizes)


def unpacked(sets) -> np.ndarray:
    """Rows of zeros and ones from packed bits."""
    return np.unpackbits(np.stack([np.frombuffer(s, np.uint8) for s in sets]), axis=1).astype(np.float32)


def nystrom(landmarks: np.ndarray) -> np.ndarray:
    """K(landmarks, landmarks)^-1/2."""
    values, vectors = np.linalg.eigh(kernel(landmarks, landmarks).astype(np.float64))
    return vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T


def normal_equations(x: np.ndarray, y: np.ndarray, sizes: np.ndarray, landmarks: np.ndarray,
                     root: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the rows add to both sides of the one-versus-rest ridge regressions.
    A language counts the same however many rows (``sizes``) it has."""
    mapped = kernel(x, landmarks) @ root
    weighted = mapped / sizes[y][:, None]
    return mapped.T @ weighted, weighted.T @ np.where(y[:, None] == np.arange(len(sizes)), 1.0, -1.0)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"):
    """(languages, packed landmarks, coefficients), or None without any rows.

    Learns from rows outside the held-out quarter that have a language and a
    text with a letter; equal rows count once.  They are sampled by a hash of id and
    text: about PER_LANGUAGE of each language, MAX_ROWS in all.  Texts become sets of
    n-grams (1.5 KB each) in the tasks that read them.  LANDMARKS of these, evenly
    over the languages, and the sums of TRAIN_TASKS tasks reach the driver.  The
    languages themselves (a short list of codes) are counted there.
    """
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        ~held_out("doc_id") & F.col("text").isNotNull() & F.col("lang").isNotNull())
    place = F.xxhash64(F.col("doc_id"), F.col("text"), F.lit("sample"))
    counts = {r[0]: r[1] for r in own.groupBy("lang").agg(F.approx_count_distinct(place)).collect()}
    if not counts:
        return None
    each = min(PER_LANGUAGE, max(1, MAX_ROWS // len(counts)))
    shares = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, each / n))])
    sample = own.select("lang", "text", place.alias("place")).where(
        F.pmod("place", F.lit(1 << 30)) / (1 << 30) < shares[F.col("lang")])

    def bits(texts: list) -> list:
        return [np.packbits(matrix([t])[0] > 0).tobytes() if has_letter(t) else None for t in texts]

    sets = materialize(append(sample, "text", "bits", BinaryType(), lambda: bits).select("lang", "place", "bits")
                       .where("bits is not null").distinct())
    rows = {r[0]: r[1] for r in sets.groupBy("lang").count().collect()}
    if not rows:
        return None
    names = sorted(rows)
    number, sizes = {k: i for i, k in enumerate(names)}, np.array([rows[k] for k in names], float)
    first = F.row_number().over(Window.partitionBy("lang").orderBy("place", "bits"))
    picked = sets.withColumn("n", first).where(F.col("n") <= max(1, LANDMARKS // len(names))).collect()
    packed = b"".join(r.bits for r in sorted(picked, key=lambda r: (number[r.lang], r.n)))
    shared = docs.sparkSession.sparkContext.broadcast(packed)  # 1.5 KB a landmark

    def add_up(batches):
        landmarks = unpacked([shared.value]).reshape(-1, sum(PLACES))
        root, left, right = nystrom(landmarks), 0.0, 0.0
        for batch in batches:
            for at in range(0, len(batch), SCORED):
                part = batch[at:at + SCORED]
                a, b = normal_equations(unpacked(part["bits"]), part["lang"].map(number).to_numpy(), sizes, landmarks, root)
                left, right = left + a, right + b
        if isinstance(left, np.ndarray):
            yield pd.DataFrame({"left": [left.tobytes()], "right": [right.tobytes()]})

    sums = (sets.repartition(TRAIN_TASKS, "place").sortWithinPartitions("place", "bits")
            .mapInPandas(add_up, "left binary, right binary").collect())
    left, right = (sum(np.frombuffer(r[c], np.float64) for r in sums) for c in ("left", "right"))
    landmarks = unpacked([packed]).reshape(-1, sum(PLACES))
    m = len(landmarks)
    solved = np.linalg.solve(left.reshape(m, m) + RIDGE * np.eye(m), right.reshape(m, -1))
    return names, packed, (nystrom(landmarks) @ solved).tobytes()


def with_language(docs: DataFrame, model, text: str = "text", out: str = "guess") -> DataFrame:
    """``docs`` plus a struct ``out``: the language ``lang`` of the whole text and
    its ``score``, 0 to 1.

    A null text, or one without a letter, is ``und`` with score 0, and so is
    every text without a model.  Other columns pass through; one named ``out``
    is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 1.5 KB a landmark

    def start():
        if shared.value is None:
            return lambda texts: [{"lang": "und", "score": 0.0}] * len(texts)
        names, packed, coefficients = shared.value
        landmarks = unpacked([packed]).reshape(-1, sum(PLACES))
        solved = np.frombuffer(coefficients, np.float64).reshape(len(landmarks), len(names))

        def run(texts: list) -> list:
            guesses = [{"lang": "und", "score": 0.0}] * len(texts)
            lettered = [i for i, t in enumerate(texts) if has_letter(t)]
            for at in range(0, len(lettered), SCORED):
                rows = lettered[at:at + SCORED]
                scores = kernel(matrix([texts[i] for i in rows]), landmarks) @ solved
                best = scores.argmax(axis=1)
                top = np.clip((scores[np.arange(len(rows)), best] + 1) / 2, 0, 1)
                for i, b, s in zip(rows, best.tolist(), top.tolist()):
                    guesses[i] = {"lang": names[b], "score": s}
            return guesses

        return run

    return append(docs, text, out, GUESS, start)
