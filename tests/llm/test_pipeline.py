import random

import corpus_pipeline
from credscope.llm import op01_mixing, op10_quality

from . import test_minhash, test_mixing, test_packing
from .conftest import invented


def test_stages_like_brute_force(spark, make_docs, tmp_path, odd_rows):
    rng = random.Random(8)
    base = [t for t in invented(90, seed=31, words=3000) if len(t.split()) > 40]
    rows = [(i, t, "abc"[i % 3]) for i, t in enumerate(base)]
    rows += [(200 + i, t, "a") for i, t in enumerate(base[:15])]
    rows += [(300 + i, test_minhash.edited(t, 1, rng), None) for i, t in enumerate(base[10:40])]
    junk = [(400 + i, "### $$$ %%% " * 30, "a") for i in range(40)]
    rows += junk + odd_rows
    docs = make_docs(rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(r[0], 0 if 400 <= r[0] < 500 else 1, 0) for r in rows if r[0] is not None and r[0] not in (5, 9)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    key = lambda frame: sorted(((r.doc_id, r.text, r.source) for r in frame.collect()), key=str)

    stages = dict(corpus_pipeline.STAGES)
    trees = op10_quality.train(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    good = stages["quality"](spark, docs, str(tmp_path)).cache()
    scores = trees.score(op10_quality.statistics([(r[1] or "").encode() for r in rows]))
    assert key(good) == sorted(((r[0], r[1], r[2]) for r, s in zip([(*r, "s")[:3] for r in rows], scores) if s >= op10_quality.CUT), key=str)
    assert good.where("doc_id BETWEEN 400 AND 499").count() == 0 and good.where("doc_id < 100").count() > 0.9 * len(base)

    unique = stages["exact_dedup"](spark, good, str(tmp_path)).cache()
    best = {}
    for i, t, _ in key(good):
        best[t or ""] = max(best.get(t or "", -1), -1 if i is None else i)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.text or "") for r in unique.collect()) == sorted((i, t) for t, i in best.items())

    near = stages["near_dedup"](spark, unique, str(tmp_path)).cache()
    kept = [r[0] for r in test_minhash.brute([(r[0], r[1]) for r in key(unique)], 5, 80) if r[3]]
    assert sorted(map(str, kept)) == sorted(str(r.doc_id) for r in near.collect()) and near.columns == docs.columns

    mixed = stages["mixing"](spark, near, str(tmp_path)).cache()
    plan = op01_mixing.mix(near).collect()
    test_mixing.check(plan, key(near))
    assert sorted(str(r.doc_id) for r in mixed.collect()) == sorted(str(r.doc_id) for r in plan for _ in range(r.copies))

    pieces = stages["packing"](spark, mixed, str(tmp_path)).collect()
    assert test_packing.check(pieces, key(mixed), test_packing.op.Limits()) == 0
    assert sum(p.length for p in corpus_pipeline.run(spark, str(tmp_path)).collect()) == sum(p.length for p in pieces)
