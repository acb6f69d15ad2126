import re
from collections import defaultdict

from credscope.llm import op01_mixing as op

from .conftest import invented


def targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(3 * sizes[s] for s in capped)
        out = {s: 3 * sizes[s] if s in capped else rest * weight[s] / sum(weight[x] for x in free) for s in names}
        over = {s for s in free if out[s] > 3 * sizes[s]}
        if not over:
            return out
        capped |= over


def check(rows, texts):
    size = defaultdict(int)
    for _, text, source in texts:
        size[source] += len(re.findall(op.WORD, text or ""))
    want, taken = targets(size), defaultdict(int)
    for r in rows:
        assert r.source_size == size[r.source]
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, r.target)
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    return want, taken


def test_targets_are_met_and_reruns_agree(make_docs):
    texts = invented(900, seed=1)
    rows = [(i, t, ["a", "b", "B", "é", None, "tiny"][min(5, i % 6 if i < 880 else 5)]) for i, t in enumerate(texts)]
    first = op.mix(make_docs(rows)).collect()
    want, taken = check(first, rows)
    for s in want:
        assert abs(taken[s] - want[s]) <= 110
    again = op.mix(make_docs(rows, 7)).collect()
    assert sorted((r.doc_id, r.taken) for r in first) == sorted((r.doc_id, r.taken) for r in again)


def test_larger_budget_takes_a_superset(make_docs):
    rows = [(i, t, "ab"[i % 2]) for i, t in enumerate(invented(300, seed=2))]
    less = {r.doc_id: r.copies for r in op.mix(make_docs(rows), weights=(1, 4)).collect() if r.source == "a"}
    more = {r.doc_id: r.copies for r in op.mix(make_docs(rows), weights=(3, 4)).collect() if r.source == "a"}
    assert all(more[d] >= n for d, n in less.items()) and sum(more.values()) > sum(less.values())


def test_odd_rows(make_docs, odd_rows):
    got = op.mix(make_docs(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    check(got, odd_rows)


def test_empty_and_wordless(make_docs):
    assert op.mix(make_docs([])).collect() == []
    got = op.mix(make_docs([(1, None, "a"), (2, " ", "b")])).collect()
    assert [(r.target, r.taken) for r in got] == [(0.0, 0), (0.0, 0)]


def test_rows_without_ids_are_told_apart(make_docs):
    texts = invented(600, seed=7)
    for doc_id in (None, 7):
        rows = [(doc_id, t, "abc"[i % 3]) for i, t in enumerate(texts)]
        want, taken = check(op.mix(make_docs(rows)).collect(), rows)
        for s in want:
            assert abs(taken[s] - want[s]) <= 110
