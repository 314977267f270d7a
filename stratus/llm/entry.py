"""Registered queries of the training-data operators, one per operator."""

from __future__ import annotations

from stratus.llm import (
    alignment,
    bpe_tree,
    exact_dedup,
    language_model,
    mixing,
    packing,
    pii,
    quality,
    repair,
    secrets,
    simhash,
    token_files,
    topk,
)
from stratus.llm.common import table


def queries():
    docs = lambda s, sf: table(s, sf, "documents")
    return {
        "op1_exact_dedup": lambda s, sf: exact_dedup.query(docs(s, sf)),
        "op2_secret_scan": lambda s, sf: secrets.query(docs(s, sf)),
        "op3_topk": lambda s, sf: topk.query(table(s, sf, "embeddings")),
        "op4_language_model": lambda s, sf: language_model.query(docs(s, sf)),
        "op5_mixing": lambda s, sf: mixing.query(docs(s, sf)),
        "op6_pii": lambda s, sf: pii.query(docs(s, sf)),
        "op7_token_files": lambda s, sf: token_files.query(docs(s, sf)),
        "op8_packing": lambda s, sf: packing.query(docs(s, sf)),
        "op9_quality_classifier": lambda s, sf: quality.query(docs(s, sf), table(s, sf, "labels")),
        "op10_simhash": lambda s, sf: simhash.query(docs(s, sf)),
        "op11_cross_align": lambda s, sf: alignment.query(docs(s, sf)),
        "op12_repair": lambda s, sf: repair.query(table(s, sf, "conversations")),
        "op13_bpe_tree": lambda s, sf: bpe_tree.query(docs(s, sf)),
    }


def oracle_sql():
    return {"op1_exact_dedup": exact_dedup.ORACLE, "op3_topk": topk.ORACLE}
