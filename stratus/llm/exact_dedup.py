"""Exact deduplication with a heavy-hitter split.

Misra-Gries summaries (one per task, `counters` entries at most) find digests
that may be frequent; one exact count over the table verifies them.  The
verified winners, `counters` rows at most, are broadcast, so their rows are
decided map-side and never shuffled.  All other digests take an ordinary
shuffle, in which no group holds more than rows / (counters + 1) rows.

Defined results: NULL text equals the empty text.  Of equal texts the row with
the largest id stays (NULL ids are smallest); of rows that share that id too,
exactly one stays.  An empty table gives no rows.  Only the id and text columns
are read, so other columns can have any name.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratus.llm.common import ascii_lower, map_batches, materialize, text_of

COUNTERS = 1023


def text_digest(text: str = "text") -> Column:
    """SHA-256 of the text with A-Z lower-cased, as 32 bytes."""
    return F.unhex(F.sha2(ascii_lower(text_of(text)).cast("binary"), 256))


def merge_counts(summary: Counter, more: Counter, counters: int) -> Counter:
    """Merge Misra-Gries summaries; no estimate is over, none is under by more
    than (rows seen) / (counters + 1)."""
    summary.update(more)
    if len(summary) > counters:
        cut = sorted(summary.values(), reverse=True)[counters]
        summary = Counter({k: v - cut for k, v in summary.items() if v > cut})
    return summary


def misra_gries(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(digest, estimate): a superset of the digests with more than
    2 * rows / (counters + 1) rows, `counters` + 1 rows at most."""
    def summarise(batches):
        summary: Counter = Counter()
        for b in batches:
            summary = merge_counts(summary, Counter(b.column(0).to_pylist()), counters)
        yield {"digest": list(summary), "estimate": list(summary.values())}

    per_task = map_batches(digests.select("digest"), summarise, "digest binary, estimate long")
    return (per_task.groupBy("digest").agg(F.sum("estimate").alias("estimate"))
            .orderBy(F.desc("estimate"), "digest").limit(counters + 1))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                counters: int = COUNTERS) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, digest."""
    digests = materialize(
        docs.select(F.col(id_col).alias("doc_id"), text_digest(text_col).alias("digest"),
                    F.monotonically_increasing_id().alias("rid")), "op1-digests")
    rows = digests.count()

    top = F.max(F.struct("doc_id", "rid")).alias("top")
    candidates = misra_gries(digests, counters).select("digest")
    winners = materialize(
        digests.join(F.broadcast(candidates), "digest")
        .groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), top)
        .filter(F.col("group_size") > max(1, rows // (counters + 1))), "op1-winners")

    split = digests.join(F.broadcast(winners), "digest", "left")
    heavy = split.filter("group_size IS NOT NULL")
    w = Window.partitionBy("digest")
    light = (split.filter("group_size IS NULL").select("doc_id", "digest", "rid")
             .withColumn("group_size", F.count(F.lit(1)).over(w))
             .withColumn("top", F.max(F.struct("doc_id", "rid")).over(w)))
    return heavy.unionByName(light).select(
        "doc_id", F.col("top.doc_id").alias("keep_id"), "group_size",
        (F.col("rid") == F.col("top.rid")).alias("kept"), "digest")


def query(docs: DataFrame) -> DataFrame:
    return exact_dedup(docs).select(
        "doc_id", "keep_id", "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE = """
WITH d AS (SELECT doc_id, translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, MAX(doc_id) OVER (PARTITION BY t) AS keep_id,
       COUNT(*) OVER (PARTITION BY t) AS group_size,
       doc_id = MAX(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM d"""
