"""Toxicity by non-negative positive-unlabelled (PU) learning.

Training sees confirmed toxic texts and unlabelled ones, never a confirmed
clean one.  With the class prior p, the risk of calling all unlabelled text
clean is corrected by what its toxic share contributes:

    risk = p * R+(toxic) + max(0, R-(unlabelled) - p * R-(toxic))

Where the bracket falls below zero the classifier overfits the toxic examples,
and the step goes back along it instead.

A text is the set of its words; a word's weight is the sum of the weights of
its hashed features (the word and its beginnings, so that unseen forms of a
known stem count), and a text's logit is the sum over its distinct words
divided by the square root of their number, plus an offset.  Several such
classifiers are trained, each in a task of its own on its own share of the
unlabelled sample, and their logits are averaged.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, StructField, StructType

from .common import append, held_out

FEATURES = 1 << 18
STEMS = (3, 4, 5, 6)
MEMBERS = 3
#: Training rows of one member, about: toxic ones, unlabelled ones, bytes of each.
MAX_TOXIC, MAX_UNLABELLED, MAX_BYTES = 4_000, 12_000, 64 << 20
BATCH, EPOCHS, STEPS, RATE, DECAY = 1_000, 20, 200, 0.1, 1e-4
#: A feature of fewer toxic examples tells nothing.
MIN_TOXIC = 2
CACHED_WORDS = 300_000
PACKED = StructType([StructField("words", IntegerType(), False), StructField("features", BinaryType(), False)])
words_in = regex.compile(r"[^\W\d_]+").findall


def word_features(word: str) -> list[int]:
    """Hashed features of a word: itself and its beginnings."""
    return [zlib.crc32(x.encode()) % FEATURES
            for x in {"w" + word, *(f"{k}{word[:k]}" for k in STEMS if len(word) > k)}]


def distinct_words(text: str | None) -> set[str]:
    return set(words_in(text.lower())) if text else set()


class Packed:
    """Texts as one sparse matrix: feature, value and row of each entry."""

    def __init__(self, texts: list[tuple[np.ndarray, int]]):
        self.n = len(texts)
        lengths = [len(f) for f, _ in texts]
        self.feature = np.concatenate([f for f, _ in texts]) if texts else np.empty(0, np.int32)
        self.value = np.repeat([1 / np.sqrt(max(1, words)) for _, words in texts], lengths)
        self.row = np.repeat(np.arange(self.n), lengths)

    def logits(self, weights: np.ndarray, offset: float) -> np.ndarray:
        return offset + np.bincount(self.row, weights[self.feature] * self.value, minlength=self.n)

    def gradient(self, by_row: np.ndarray) -> np.ndarray:
        return np.bincount(self.feature, by_row[self.row] * self.value, minlength=FEATURES)


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(toxic: list, unlabelled: list, prior: float, seed: int) -> tuple[np.ndarray, float]:
    """Weights and offset that minimise the non-negative PU risk (logistic
    loss, Adam with a falling rate).  Both lists hold (feature array, number of
    words) a text."""
    held = np.bincount(np.concatenate([np.unique(f) for f, _ in toxic]), minlength=FEATURES) >= MIN_TOXIC
    toxic, unlabelled = ([(f[held[f]], words) for f, words in texts] for texts in (toxic, unlabelled))
    rng = np.random.default_rng(seed)
    theta = np.append(np.zeros(FEATURES), -1.0)
    mean, square, t = np.zeros_like(theta), np.zeros_like(theta), 0
    steps = -(-len(unlabelled) // BATCH)
    epochs = max(EPOCHS, -(-STEPS // steps))
    for _ in range(epochs):
        p_parts = np.array_split(rng.permutation(len(toxic)), steps)
        for p_rows, u_rows in zip(p_parts, np.array_split(rng.permutation(len(unlabelled)), steps)):
            p_rows = p_rows if len(p_rows) else rng.integers(len(toxic), size=1)
            p, u = Packed([toxic[i] for i in p_rows]), Packed([unlabelled[i] for i in u_rows])
            zp, zu = p.logits(theta[:-1], theta[-1]), u.logits(theta[:-1], theta[-1])
            clean = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            of_p, of_u = prior * sigmoid(zp) / p.n, sigmoid(zu) / u.n
            by_p, by_u = (-prior * sigmoid(-zp) / p.n - of_p, of_u) if clean >= 0 else (of_p, -of_u)
            step = np.append(p.gradient(by_p) + u.gradient(by_u), by_p.sum() + by_u.sum())
            step[:-1] += DECAY * theta[:-1]
            t += 1
            mean += 0.1 * (step - mean)
            square += 0.001 * (step * step - square)
            rate = RATE * (1 - (t - 1) / (steps * epochs))
            theta -= rate * mean / (1 - 0.9 ** t) / (np.sqrt(square / (1 - 0.999 ** t)) + 1e-6)
    return theta[:-1], float(theta[-1])


def train(docs: DataFrame, labels: DataFrame, text: str = "text") -> list[tuple[float, bytes]]:
    """(offset, float32 weights) of each member.

    ``docs``: doc_id and ``text``; ``labels``: doc_id and toxic.  Labels of the
    held-out quarter are never read.  Rows are sampled by a hash of their id so
    that about MAX_TOXIC toxic and MAX_UNLABELLED unlabelled ones, and MAX_BYTES
    of each, go to a member.  The unlabelled sample ignores labels.  Without a
    toxic example the list is empty.
    """
    known = (labels.where(~held_out("doc_id") & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    prior, n_toxic = known.agg(F.avg("toxic"), F.sum("toxic")).first()
    own = docs.select("doc_id", F.col(text).alias("text")).where(
        ~held_out("doc_id") & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    n, size = own.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    if not n_toxic or not n:
        return []
    chance = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(1 << 30)) / (1 << 30)
    per_text = size / n
    share = min(1.0, MAX_TOXIC / n_toxic, MAX_BYTES / (per_text * n_toxic))
    # At most about MAX_TOXIC ids of eight bytes.
    picked = F.broadcast(known.where((F.col("toxic") == 1) & (chance < share)).select("doc_id"))
    toxic = own.join(picked, "doc_id", "left_semi").select(
        F.sequence(F.lit(0), F.lit(MEMBERS - 1)).alias("members"), F.lit(1).alias("toxic"), "text")
    share = min(1.0, MEMBERS * MAX_UNLABELLED / n, MEMBERS * MAX_BYTES / size)
    unlabelled = own.where(chance < share).select(
        F.array(F.pmod(F.xxhash64(F.col("doc_id"), F.lit("member")), F.lit(MEMBERS)).cast("int")).alias("members"),
        F.lit(0).alias("toxic"), "text")

    def packed(texts: list) -> list:
        made = []
        for value in texts:
            words = sorted(distinct_words(value))
            found = np.array([f for w in words for f in word_features(w)], np.int32)
            made.append({"words": len(words), "features": found.tobytes()})
        return made

    def member(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        sets: tuple[list, list] = ([], [])
        # In an order of their own, whatever order the shuffle brought them in.
        for is_toxic, row in sorted(zip(rows["toxic"], rows["packed"]), key=lambda r: (r[0], r[1]["features"])):
            sets[is_toxic].append((np.frombuffer(row["features"], np.int32), row["words"]))
        if not all(sets):
            return pd.DataFrame({"offset": [], "weights": []})
        weights, offset = fit(sets[1], sets[0], prior, seed=key[0])
        return pd.DataFrame({"offset": [offset], "weights": [weights.astype(np.float32).tobytes()]})

    # Texts become feature lists in the tasks that read them; those are brought together.
    sample = append(toxic.unionByName(unlabelled), "text", "packed", PACKED, lambda: packed)
    return [tuple(r) for r in sample.select(F.explode("members").alias("member"), "toxic", "packed")
            .groupBy("member").applyInPandas(member, "offset double, weights binary").collect()]


def with_score(docs: DataFrame, members: list[tuple[float, bytes]], text: str = "text",
               out: str = "toxicity") -> DataFrame:
    """``docs`` plus ``out``: the probability that ``text`` is toxic.

    The whole text counts.  A null or empty text, or one without letters, gets
    the offset's score; without trained members every score is 0.  Other
    columns pass through; one named ``out`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(members)  # 1 MB a member

    def start():
        offset = float(np.mean([o for o, _ in shared.value])) if shared.value else -np.inf
        weights = (np.mean([np.frombuffer(w, np.float32) for _, w in shared.value], axis=0)
                   if shared.value else np.zeros(FEATURES)).tolist()
        known: dict[str, float] = {}

        def run(texts: list) -> list:
            logits = []
            for value in texts:
                words = distinct_words(value)
                if len(known) > CACHED_WORDS:
                    known.clear()
                for w in words.difference(known):
                    known[w] = sum(weights[f] for f in word_features(w))
                logits.append(offset + sum(sorted(map(known.__getitem__, words))) / max(1, len(words)) ** 0.5)
            return sigmoid(np.array(logits)).tolist() if np.isfinite(offset) else [0.0] * len(texts)

        return run

    return append(docs, text, out, DoubleType(), start)
