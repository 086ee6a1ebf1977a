"""Queries of the training-data operators and the pipeline, with their SQL."""

from __future__ import annotations

from . import common, conversations, decontamination, langid, licences, mixing, multiset_hash, near_dedup, pii, quality, ranked_search, substring_dedup, tokens, topk


def _query(fn):
    def run(spark, sf_dir):
        common.ship(spark)
        return fn(spark, sf_dir)

    return run


QUERIES = {name: _query(fn) for name, fn in {
    "op1_training_order": tokens.op1_training_order,
    "op2_licences": licences.op2_licences,
    "op3_substring_dedup": substring_dedup.op3_substring_dedup,
    "op4_minhash_near_dedup": near_dedup.op4_minhash_near_dedup,
    "op5_langid": langid.op5_langid,
    "op6_decontamination": decontamination.op6_decontamination,
    "op7_maxscore_topk": topk.op7_maxscore_topk,
    "op8_pareto_mix": mixing.op8_pareto_mix,
    "op9_pii": pii.op9_pii,
    "op10_quality": quality.op10_quality,
    "op11_conversations": conversations.op11_conversations,
    "op12_fingerprints": multiset_hash.op12_fingerprints,
    "op13_ranked_search": ranked_search.op13_ranked_search,
}.items()}

ORACLES = {
    "op2_licences": licences.ORACLE,
    "op3_substring_dedup": substring_dedup.ORACLE,
    "op4_minhash_near_dedup": near_dedup.ORACLE,
    "op7_maxscore_topk": topk.ORACLE,
    "op8_pareto_mix": mixing.ORACLE,
    "op13_ranked_search": ranked_search.ORACLE,
}
