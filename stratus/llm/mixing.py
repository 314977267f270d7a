"""Mixing sources to target weights by Sainte-Lague apportionment.

Targets are set per source (weights, a share of all words, a cap of `cap`
times the source's size, excess reshared).  Blocks of BLOCK words are given to
sources by highest quotients target / (2 * seats + 1), and each source's seats
go to its shards the same way.  A shard lays its documents end to end in a
seeded order and takes its quota as whole passes over the shard plus a run of
blocks that starts at a seeded block and wraps round, so a document is taken
whole `n` or `n + 1` times but for the two ends of the run.

Hot sources are split: a shard has about SHARD_DOCS documents, whatever its
source.  Only (id, source, size, hash) rows are shuffled.  The driver holds
one line per source, the recipe, and nothing per document.

Defined results: NULL text has size 0; a source of size 0 has target 0; a
NULL source is a source of its own, last in order; repeated rows are mixed
each by itself; an empty table gives no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratus.llm.common import WORD, materialize, text_of

BLOCK = 16
SHARD_DOCS = 4096
WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
SEED = 42


def targets(sizes: np.ndarray, weights: np.ndarray, share: float = SHARE, cap: float = CAP) -> np.ndarray:
    """min(cap * size, level * weight) with the level at which all targets sum
    to `share` of all sizes: what resharing the excess by weight arrives at."""
    sizes, weights = np.asarray(sizes, float), np.asarray(weights, float)
    limit, out = cap * sizes, np.zeros(len(sizes))
    left, open_ = share * sizes.sum(), np.ones(len(sizes), bool)
    while open_.any():
        given = left * weights / weights[open_].sum()
        over = open_ & (given >= limit)
        if not over.any():
            out[open_] = given[open_]
            break
        out[over] = limit[over]
        left -= limit[over].sum()
        open_ &= ~over
    return out


def sainte_lague(votes: np.ndarray, seats: int) -> np.ndarray:
    """Seats by highest quotients votes / 1, / 3, / 5, ...; ties to the earlier."""
    votes = np.asarray(votes, float)
    if not len(votes) or votes.sum() <= 0 or seats <= 0:
        return np.zeros(len(votes), np.int64)
    # Rounding votes / divisor is the same rule for the right divisor; start
    # near it, then give or take single seats by quotient.
    got = np.floor(votes / (votes.sum() / seats) + 0.5).astype(np.int64)
    while (more := seats - int(got.sum())) != 0:
        if more > 0:
            heap = [(-v / (2 * g + 1), i) for i, (v, g) in enumerate(zip(votes, got, strict=True))]
        else:
            heap = [(v / (2 * g - 1), -i) for i, (v, g) in enumerate(zip(votes, got, strict=True)) if g]
        heapq.heapify(heap)
        for _ in range(abs(more)):
            _, i = heap[0]
            i = abs(i)
            got[i] += 1 if more > 0 else -1
            if more > 0:
                heapq.heapreplace(heap, (-votes[i] / (2 * got[i] + 1), i))
            elif got[i]:
                heapq.heapreplace(heap, (votes[i] / (2 * got[i] - 1), -i))
            else:
                heapq.heappop(heap)
    return got


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple = WEIGHTS, share: float = SHARE, cap: float = CAP, block: int = BLOCK,
        shard_docs: int = SHARD_DOCS, seed: int = SEED) -> DataFrame:
    """One row per row of `docs`: doc_id, mark (hash of the text), size,
    source_size, target, taken."""
    spark = docs.sparkSession
    sized = materialize(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(text_of(text_col)).alias("mark")), "op5-sizes")

    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"),
                                      F.count(F.lit(1)).alias("n")).collect()
    per.sort(key=lambda r: (r.source is None, r.source or ""))
    size = np.array([r.source_size for r in per], np.int64)
    goal = targets(size, np.array([weights[k % len(weights)] for k in range(len(per))]), share, cap)
    seats = sainte_lague(goal, int(round(goal.sum() / block)))
    recipe = spark.createDataFrame(
        [(k, r.source, int(r.source_size), float(goal[k]), int(seats[k]), -(-int(r.n) // shard_docs))
         for k, r in enumerate(per)],
        "sid int, source string, source_size long, target double, seats long, shards int")

    rows = (sized.join(recipe, sized.source.eqNullSafe(recipe.source))
            .select("doc_id", "mark", "size", "sid", "source_size", "target",
                    F.xxhash64(F.lit(seed), "doc_id", "mark").alias("place"), "shards")
            .withColumn("shard", F.pmod(F.xxhash64("place"), F.col("shards")).cast("int")))
    shards = rows.groupBy("sid", "shard").agg(F.sum("size").alias("total"))

    def quotas(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("shard")
        return pd.DataFrame({"sid": pdf["sid"], "shard": pdf["shard"], "total": pdf["total"],
                             "quota": sainte_lague(pdf["total"].to_numpy(), int(pdf["seats"].iloc[0]))})

    # One line per shard here, of one source a group.
    quota = shards.join(recipe.select("sid", "seats"), "sid").groupBy("sid").applyInPandas(
        quotas, "sid int, shard int, total long, quota long")

    w = Window.partitionBy("sid", "shard").orderBy("place", "doc_id", "mark", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    words = F.least(F.col("quota") * block, F.floor(F.col("total") * F.lit(cap)))
    at = (rows.join(quota, ["sid", "shard"])
          .withColumn("end", F.sum("size").over(w)).withColumn("start", F.col("end") - F.col("size"))
          .withColumn("passes", F.when(F.col("total") > 0, F.floor(words / F.col("total"))).otherwise(0))
          .withColumn("run", words - F.col("passes") * F.col("total"))
          .withColumn("from", F.when(F.col("total") > 0, F.pmod(F.xxhash64(F.lit(seed), "sid", "shard"),
                                                                F.ceil(F.col("total") / block)) * block).otherwise(0)))
    overlap = lambda a, b: F.greatest(F.lit(0), F.least("end", b) - F.greatest("start", a))
    stop = F.col("from") + F.col("run")
    taken = (F.col("passes") * F.col("size") + overlap(F.col("from"), F.least(stop, F.col("total")))
             + overlap(F.lit(0), stop - F.col("total")))
    return at.select("doc_id", "mark", "size", "source_size", "target", taken.cast("long").alias("taken"))


def query(docs: DataFrame) -> DataFrame:
    return mix(docs).drop("mark")
