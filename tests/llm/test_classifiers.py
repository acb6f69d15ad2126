import numpy as np
import pytest

from credscope.llm import op03_toxicity, op10_quality, training

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize(("op", "label", "least"), [(op10_quality, "quality", 0.95), (op03_toxicity, "toxic", 0.9)])
def test_held_out_labels(spark, op, label, least):
    got = op.query(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").toPandas()
    y, rank = got[label].to_numpy(), got.score.rank().to_numpy()
    assert (rank[y == 1].mean() - rank[y == 0].mean()) / len(y) + 0.5 >= least  # area under the ROC curve
    assert got.score.between(0, 1).all()


def test_odd_rows_and_no_labels(spark, make_docs, odd_rows):
    none = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    docs = make_docs(odd_rows)
    for op in (op10_quality, op03_toxicity):
        got = op.score(docs, op.train(docs, none)).collect()
        assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 for r in got)
        assert len({r.score for r in got if r.doc_id in (1, 2)}) == 1
        assert op.score(make_docs([]), op.train(make_docs([]), none)).collect() == []


def test_label_model_outvotes_wrong_labels():
    rng = np.random.default_rng(3)
    truth = rng.random(3000) < 0.2
    votes = np.column_stack([truth & (rng.random(3000) < 0.7) for _ in range(6)]).astype(float)
    given = np.where(rng.random(3000) < 0.05, ~truth, truth).astype(float)
    posterior, _ = op03_toxicity.label_model(votes, given)
    assert ((posterior > 0.5) == truth).mean() > (given == truth).mean()


def test_sample_is_bounded_where_ids_repeat(spark, make_docs):
    docs = make_docs([(i % 50, f"text {i}") for i in range(2000)] + [(3, None)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(50)], "doc_id long, quality int, toxic int")
    got = training.labelled_sample(docs, labels, "quality", 10).collect()
    assert len(got) == len({r.doc_id for r in got}) == 10
    again = training.labelled_sample(docs.repartition(9), labels, "quality", 10).collect()
    assert sorted(got) == sorted(again)
