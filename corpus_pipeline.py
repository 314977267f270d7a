"""The training-corpus pipeline: five stages over `documents`.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it
kept and returns a DataFrame; stages are written as Parquet and read again.

Defined results: NULL text is the empty text in every stage, and the mix, which
takes words, leaves texts without any out; a NULL source is a source of its own.
Rows that repeat an id and a text are one document to the exact stage, which
keeps one of them; ties go as the operators' docstrings say.  Other columns are
carried along as they are.  An empty table passes every stage and packs to no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratus.llm import exact_dedup, mixing, packing, quality, simhash
from stratus.llm.common import materialize, table, text_of


def _chosen(docs: DataFrame, keys: dict[str, Column], decided: DataFrame) -> DataFrame:
    """The rows of `docs` whose keys are in `decided` (keys, n: how many rows
    in all), n of each: repeated rows share it, copies are repeated."""
    names = list(keys)
    cols = docs.columns
    keyed = docs.select(F.struct(*[docs[f"`{c}`"] for c in cols]).alias("__row"),
                        *[v.alias(k) for k, v in keys.items()])
    right = decided.select(*[F.col(k).alias(f"{k}_r") for k in names], "n")
    on = [keyed[k].eqNullSafe(right[f"{k}_r"]) for k in names]
    first = Window.partitionBy(*names).orderBy("n")
    return (keyed.join(right, on, "inner").withColumn("__k", F.row_number().over(first))
            .filter("__k = 1").withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
            .select("__row.*"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents (predicted 0) go."""
    weights = quality.train(docs, table(spark, sf_dir, "labels"))
    score = quality.score_udf(spark, weights)
    return docs.filter(score(docs["text"]) >= quality.THRESHOLD)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    kept = exact_dedup.exact_dedup(docs).filter("kept").select(
        F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), F.lit(1).alias("n"))
    return _chosen(docs, {"__id": docs["doc_id"], "__digest": exact_dedup.text_digest()}, kept)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group stays."""
    mark = F.xxhash64(text_of())
    fps = simhash.fingerprints(docs, simhash.SHINGLE, extra=[mark.alias("mark")])
    groups = simhash.near_dedup(fps, simhash.MAX_BITS).groupBy("root").agg(
        F.min(F.struct("doc_id", "mark")).alias("low"))
    kept = groups.select(F.col("low.doc_id").alias("__id"), F.col("low.mark").alias("__mark"), F.lit(1).alias("n"))
    return _chosen(docs, {"__id": docs["doc_id"], "__mark": mark}, kept)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken, whole, as often as the mix takes their words
    (rounded); what it doesn't take, documents without words too, goes."""
    took = mixing.mix(docs)
    copies = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0)
    plan = (took.groupBy(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark"))
            .agg(F.sum(copies).alias("n")).filter("n > 0"))
    return _chosen(docs, {"__id": docs["doc_id"], "__mark": F.xxhash64(text_of())}, plan)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.query(docs)


STAGES = [
    ("quality_classifier", quality_stage),
    ("exact_dedup", exact_stage),
    ("simhash_near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("best_fit_packing", packing_stage),
]

# Trained weights, fingerprints and token ids aren't expressible in SQL;
# tests/llm holds the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
