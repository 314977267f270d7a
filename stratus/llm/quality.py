"""Quality classifier: hashed word n-grams, logistic regression by FTRL-proximal.

Features of a text are its word uni- and bigrams hashed into 2**BITS buckets,
each weighted 1 + ln(count), the vector scaled to length 1.  The model is
fitted on at most `max_labelled` labelled rows (the ones with the smallest
hash of their id, so reruns agree); every text is scored, whole, as a sparse
dot product with the weights.

Defined results: NULL text is the empty text; a text without words has no
features but the bias and scores the same as any other such text.  Without
training rows every score is 0.5.  Labels that are NULL are left out; of several
labels of one id the smallest counts.  Repeated rows are scored each by itself,
rows with a NULL id too; an empty table gives no rows.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.llm.common import id_crc, use_cache, words

BITS = 18
MAX_LABELLED = 12_000
THRESHOLD = 0.3
_MIX = np.uint64(0x9E3779B97F4A7C15)
_cache: dict[bytes, int] = {}
_CACHE_MAX = 250_000


def features(text: bytes, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers and values of one text; bucket 2**bits is the bias."""
    ws = words(text)
    use_cache(_cache)
    if len(_cache) > _CACHE_MAX:
        _cache.clear()
    for w in set(ws).difference(_cache):
        _cache[w] = crc32(w) | 1 << 32
    h = np.fromiter(map(_cache.__getitem__, ws), np.uint64, len(ws))
    both = np.concatenate([h, h[1:] * np.uint64(31) + h[:-1] * _MIX])
    bucket, count = np.unique((both * _MIX) >> np.uint64(64 - bits), return_counts=True)
    value = 1 + np.log(count)
    if len(value):
        value /= np.sqrt(value @ value)
    return np.append(bucket.astype(np.int64), 1 << bits), np.append(value, 1.0)


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], bits: int = BITS, epochs: int = 4,
             alpha: float = 1.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1) -> np.ndarray:
    """Follow-the-regularised-leader (proximal, per-coordinate) logistic regression."""
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weight(i):
        zi = z[i]
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2)
        return np.where(np.abs(zi) <= l1, 0.0, w)

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for r in order.permutation(len(rows)):
            i, x, y = rows[r]
            w = weight(i)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - y) * x
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - sigma * w
            n[i] += g * g
    return weight(np.arange((1 << bits) + 1)).astype(np.float32)


def training_rows(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(text, label) of at most `max_labelled` labelled documents outside the
    held-out fifth.  The ids are chosen first, so few texts move."""
    chosen = (labels.select(F.col("doc_id").alias("lid"), F.col("quality").cast("int").alias("label"))
              .filter("lid IS NOT NULL AND label IN (0, 1)")
              .filter(id_crc(F.col("lid")) % 5 != 0)
              .groupBy("lid").agg(F.min("label").alias("label"))
              .orderBy(F.xxhash64("lid"), "lid").limit(max_labelled))
    texts = docs.select(F.col(id_col).alias("lid"), F.col(text_col).cast("binary").alias("text"))
    # `chosen` has max_labelled rows of 12 bytes at most: a proven bound.
    return texts.join(F.broadcast(chosen), "lid").select(
        "lid", F.coalesce("text", F.lit(b"")).alias("text"), "label")


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED,
          bits: int = BITS, **cols: str) -> np.ndarray:
    """Weights (2**bits + 1 float32).  The sample is bounded, so one task fits
    it; a repeated id counts once for each of `max_labelled` rows at most."""
    sample = (training_rows(docs, labels, max_labelled, **cols)
              .orderBy(F.xxhash64("lid"), "lid", F.xxhash64("text")).limit(max_labelled))

    def fit(batches):
        rows = []
        for pdf in batches:
            rows += [(*features(t, bits), y) for t, y in zip(pdf["text"], pdf["label"], strict=True)]
        yield pd.DataFrame({"w": [(fit_ftrl(rows, bits) if rows else np.zeros((1 << bits) + 1, np.float32)).tobytes()]})

    got = sample.coalesce(1).mapInPandas(fit, "w binary").collect()
    return (np.frombuffer(got[0]["w"], np.float32) if got
            else np.zeros((1 << bits) + 1, np.float32))


def score_udf(spark: SparkSession, weights: np.ndarray, bits: int = BITS):
    """Column function: text -> score in (0, 1)."""
    shared = spark.sparkContext.broadcast(weights)     # (2**bits + 1) * 4 bytes

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        w = shared.value
        out = np.empty(len(text))
        for k, t in enumerate(text):
            i, x = features(t, bits)
            out[k] = w[i] @ x
        return pd.Series(1 / (1 + np.exp(-np.clip(out, -30, 30))))

    def apply(text: Column) -> Column:
        return score(F.coalesce(text.cast("binary"), F.lit(b"")))

    return apply


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    score = score_udf(docs.sparkSession, train(docs, labels))
    return docs.select("doc_id", (id_crc(F.col("doc_id")) % 5 == 0).alias("held_out"),
                       score(F.col("text")).alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))
