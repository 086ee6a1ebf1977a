"""Pipeline stages: each on its predecessor's rows, against brute-force decisions."""

import corpus_pipeline as cp
from ferrule.llm import common, decontamination, quality, tokens

from .test_near_dedup import brute


def test_stages(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    columns, labels = docs.columns, {r.doc_id: r.quality for r in common.table(spark, sf_dir, "labels").collect()}
    items = [r.text for r in common.table(spark, sf_dir, "benchmark").collect()]
    seen = []
    for name, stage in cp.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = common.save(stage(spark, docs, sf_dir), f"test-{name}")
        rows = docs.collect()
        after = {r.doc_id for r in rows}
        seen.append(name)
        if name != "tokens":
            assert docs.columns == columns
        if name == "quality":
            known = [i for i in before if i in labels]
            assert sum((i in after) == (labels[i] == 1) for i in known) > 0.97 * len(known)
        elif name == "near_dedup":
            assert after == set(brute([(r.doc_id, r.text) for r in before.values()]).values())
        elif name == "decontam":
            assert after == {i for i, r in before.items() if not any(t in (r.text or "") for t in items)}
        elif name == "mix":
            assert after <= set(before) and max(sum(r.doc_id == i for r in rows) for i in list(after)[:20]) <= 2
            kept = rows
        else:
            assert sorted(r.slot for r in rows) == list(range(len(rows)))
            assert after == {r.doc_id for r in kept if r.text}
    assert seen == ["quality", "near_dedup", "decontam", "mix", "tokens"] and decontamination and quality and tokens
