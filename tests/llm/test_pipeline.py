"""The pipeline's stages, each against a plain version of its rule."""

import math
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline as P
from stratus.llm import mixing, quality, simhash
from tests.llm.test_operators import SF, brute_fingerprint, docs_of, texts_of


def rows(df):
    return Counter(tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect())


def test_stage_names():
    assert [n for n, _ in P.STAGES] == ["quality_classifier", "exact_dedup", "simhash_near_dedup", "mixing", "best_fit_packing"]


def test_quality_keeps_columns_and_rejects(spark):
    docs = docs_of(spark)
    kept = P.quality_stage(spark, docs, SF)
    assert kept.columns == docs.columns
    score = quality.score_udf(spark, quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet")))
    want = Counter(tuple(r)[:-1] for r in docs.withColumn("s", score(docs.text)).collect() if r.s >= 0.3)
    assert rows(kept) == want


def test_exact_and_near_stages(spark, odd):
    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = odd.select(*cols).unionByName(docs_of(spark).withColumn("doc_id", F.col("doc_id") + 100))
    kept = P.exact_stage(spark, docs, SF)
    got = texts_of(kept)
    norm = lambda t: t.encode().lower()
    best = {}
    for i, t in texts_of(docs):
        best[norm(t)] = max(best.get(norm(t), -1), -1 if i is None else i)
    assert sorted((norm(t), -1 if i is None else i) for i, t in got) == sorted(best.items())
    near = texts_of(P.near_stage(spark, kept, SF))
    fps = [brute_fingerprint(t) for _, t in near]
    assert not any((a ^ b).bit_count() <= simhash.MAX_BITS for k, a in enumerate(fps) for b in fps[:k])
    assert len(near) == len({r.component_id for r in simhash.query(kept).collect()})


def test_repeated_rows_leave_one(spark):
    docs = docs_of(spark)
    twice = docs.unionByName(docs)
    assert rows(P.exact_stage(spark, twice, SF)) == rows(P.exact_stage(spark, docs, SF))


def test_mixing_stage_takes_whole_documents(spark):
    docs = docs_of(spark)
    got = rows(P.mixing_stage(spark, docs, SF))
    took = {r.doc_id: (r.taken, r.size) for r in mixing.query(docs).collect()}
    want = {i: math.floor(t / s + 0.5) if s else 0 for i, (t, s) in took.items()}
    assert Counter({r[0]: n for r, n in got.items()}) == Counter({i: n for i, n in want.items() if n})


def test_run_and_empty(spark, tmp_path):
    out = P.run(spark, SF)
    assert out.count() > 0
    docs_of(spark).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert P.run(spark, str(tmp_path)).columns == out.columns
    assert P.run(spark, str(tmp_path)).count() == 0
