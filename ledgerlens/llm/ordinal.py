"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features gives a document's score s; ordered
thresholds t_0 < t_1 < ... turn it into P(grade <= k) = logistic(t_k - s).  From
these come the expected grade and the tail probability P(grade >= target), by
which documents are selected.

Features of a text are the distinct lower-case words (outer punctuation cut
off), and tokens for coarse shares: byte classes, distinct words, length.
They are hashed into ``2 ** BITS`` places.

Fitting uses at most ``SAMPLE_ROWS`` rated documents, those with the smallest hash
of their id -- a documented bound, so what reaches the driver (their feature
numbers, some MB) does not grow with the corpus.  Weights are learnt by
FTRL-proximal steps, whose L1 term sets the weights of chance words to 0.
Scoring is one row-parallel pass over all documents, without a shuffle; the
model that is broadcast has a fixed size.

Defined results: null text counts as empty text; rated rows with a null id or
grade are left out, and if a document is rated more than once its lowest grade
holds; with fewer than two grades in the sample there is no model: score,
expected grade and tail probability are null and every document is kept; equal
rows get equal results; other columns are not read; empty tables give empty
results.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

BITS = 18
SAMPLE_ROWS = 16_000
EPOCHS = 8
BATCH = 64
RATE, L1, L2 = 1.0, 12.0, 0.5
MEMO_WORDS = 300_000
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# classes of bytes: 0 other, 1 lower, 2 upper, 3 digit, 4 space, 5 symbol, 6 stop, 7 non-ASCII
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 7
_CLASS[[9, 10, 11, 12, 13, 32]] = 4
_CLASS[[ord(c) for c in "#*$%&|<>"]] = 5
_CLASS[[ord(c) for c in ".,!?;:"]] = 6


class Features:
    """Feature numbers of a text; words are remembered within a bound."""

    def __init__(self, bits: int = BITS):
        self.mask, self.memo = (1 << bits) - 1, {}

    def number(self, token: str) -> int:
        return zlib.crc32(token.encode("utf-8", "replace")) & self.mask

    def of(self, text: str | None) -> np.ndarray:
        text = text or ""
        words = text.lower().split()
        distinct, memo = set(words), self.memo
        if len(memo) > MEMO_WORDS:
            memo.clear()
        found = set()
        for w in distinct:
            k = memo.get(w)
            if k is None:
                k = self.number(w.strip(PUNCTUATION) or w[:8])
                if len(w) <= 64:
                    memo[w] = k
            found.add(k)
        n = max(1, len(words))
        tokens = [f"\0words:{len(words).bit_length()}",
                  f"\0distinct:{10 * len(distinct) // n}:{len(words).bit_length() // 2}"]
        raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        counts = np.bincount(_CLASS[raw], minlength=8)
        for k, c in enumerate(counts.tolist()):
            share = 1000 * c // max(1, len(raw))
            tokens.append(f"\0class:{k}:{share.bit_length()}")
        found.update(map(self.number, tokens))
        return np.fromiter(found, np.int32, len(found))


def logistic(x):
    return 0.5 * (1 + np.tanh(0.5 * np.asarray(x, dtype=np.float64)))


@dataclass
class Model:
    weights: np.ndarray      # float64, one per hashed feature
    thresholds: np.ndarray   # increasing, one fewer than grades
    bits: int = BITS

    def at_least(self, score: float) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..."""
        return 1 - logistic(self.thresholds - score)


def fit(rows: list[np.ndarray], grades: np.ndarray, bits: int = BITS, epochs: int = EPOCHS,
        seed: int = 1) -> Model | None:
    """Cumulative-link regression; grades are 0, 1, ..., the largest one present."""
    grades = np.asarray(grades, dtype=np.int64)
    if len(np.unique(grades)) < 2:
        return None
    top = int(grades.max())
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    # t_0 is free, each further threshold adds exp(step): they stay in order
    share = np.clip([(grades <= k).mean() for k in range(top)], 0.01, 0.99)
    start = np.log(share / (1 - share))
    free = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 0.05))])
    free_n = np.full(top, 1.0)
    rng = np.random.default_rng(seed)

    def thresholds():
        return free[0] + np.concatenate([[0.0], np.cumsum(np.exp(free[1:]))])

    def weights(at):
        zz = z[at]
        return np.where(np.abs(zz) <= L1, 0.0,
                        -(zz - np.sign(zz) * L1) / ((1 + np.sqrt(n[at])) / RATE + L2))

    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), BATCH):
            pick = order[lo:lo + BATCH]
            at = np.concatenate([rows[i] for i in pick])
            row = np.repeat(np.arange(len(pick)), [len(rows[i]) for i in pick])
            places, inverse = np.unique(at, return_inverse=True)
            w = weights(places)
            score = np.bincount(row, weights=w[inverse], minlength=len(pick))
            t, y = thresholds(), grades[pick]
            upper = np.where(y < top, logistic(t[np.minimum(y, top - 1)] - score), 1.0)
            lower = np.where(y > 0, logistic(t[np.maximum(y - 1, 0)] - score), 0.0)
            slope = 1 - upper - lower                       # of -log P(y) by the score
            g = np.bincount(inverse, weights=slope[row], minlength=len(places))
            step = (np.sqrt(n[places] + g * g) - np.sqrt(n[places])) / RATE
            z[places] += g - step * w
            n[places] += g * g
            p = np.maximum(upper - lower, 1e-9)
            by_t = np.zeros(top)
            np.add.at(by_t, np.minimum(y, top - 1),
                      np.where(y < top, -upper * (1 - upper) / p, 0.0))
            np.add.at(by_t, np.maximum(y - 1, 0), np.where(y > 0, lower * (1 - lower) / p, 0.0))
            # t_k holds free_0 and exp(free_j) for j <= k
            tail = np.cumsum(by_t[::-1])[::-1]
            by_free = tail * np.concatenate([[1.0], np.exp(free[1:])])
            free_n += by_free ** 2
            free -= 0.1 * by_free / np.sqrt(free_n)
    return Model(weights(np.arange(1 << bits)), thresholds(), bits)


def train(docs: DataFrame, ratings: DataFrame, doc_id: str = "doc_id", text: str = "text",
          grade: str = "grade", sample_rows: int = SAMPLE_ROWS, bits: int = BITS) -> Model | None:
    """Model from at most ``sample_rows`` rated documents."""
    rated = (ratings.select(F.col(doc_id).alias("doc_id"), F.col(grade).cast("int").alias("grade"))
             .filter("doc_id IS NOT NULL AND grade IS NOT NULL")
             .groupBy("doc_id").agg(F.min("grade").alias("grade"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    chosen = (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
              # the sample's size is bounded by its parameter
              .join(F.broadcast(rated), "doc_id"))

    def run(batches):
        features = Features(bits)
        for b in batches:
            rows = [(i.as_py(), features.of(t.as_py()).astype("<i4").tobytes(), g.as_py())
                    for i, t, g in zip(*b.columns)]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                    names=["doc_id", "features", "grade"])
    id_type = chosen.schema["doc_id"].dataType
    kinds = [to_arrow_type(id_type), pa.binary(), pa.int32()]
    schema = T.StructType([T.StructField("doc_id", id_type),
                           T.StructField("features", T.BinaryType()),
                           T.StructField("grade", T.IntegerType())])
    # repeated documents: one row each, so that the bound holds
    sample = (chosen.select("doc_id", "text", "grade").mapInArrow(run, schema)
              .groupBy("doc_id").agg(F.min("features").alias("features"),
                                     F.min("grade").alias("grade")))
    got = sorted((r["doc_id"], bytes(r["features"]), r["grade"]) for r in sample.collect())
    return fit([np.frombuffer(f, "<i4") for _, f, _ in got], np.array([g for *_, g in got]), bits)


def score(docs: DataFrame, model: Model | None, target: int = 2, text: str = "text",
          keep=("doc_id",), least: float = 0.5) -> DataFrame:
    """keep columns, score, expected_grade, tail_prob double, kept boolean."""
    keep = list(keep)
    source = docs.select(*keep, F.col(text).alias("__value"))
    if model is None:
        return source.select(*keep, *[F.lit(None).cast("double").alias(c) for c in
                                      ("score", "expected_grade", "tail_prob")],
                             F.lit(True).alias("kept"))
    shared = source.sparkSession.sparkContext.broadcast(
        (model.weights.astype(np.float32), model.thresholds, model.bits))
    schema = T.StructType([*(source.schema[c] for c in keep),
                           *(T.StructField(c, T.DoubleType())
                             for c in ("score", "expected_grade", "tail_prob")),
                           T.StructField("kept", T.BooleanType())])

    def run(batches):
        weights, thresholds, bits = shared.value
        m, features = Model(weights, thresholds, bits), Features(bits)
        for b in batches:
            s = np.array([weights[np.sort(features.of(v.as_py()))].sum(dtype=np.float64)
                          for v in b.columns[-1]], np.float64)
            upward = 1 - logistic(m.thresholds[None, :] - s[:, None])
            tail = upward[:, target - 1] if target <= upward.shape[1] else np.zeros(len(s))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(s), pa.array(upward.sum(axis=1)), pa.array(tail),
                 pa.array(tail >= least)], names=schema.names)
    return source.mapInArrow(run, schema)
