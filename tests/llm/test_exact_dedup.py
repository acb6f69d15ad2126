import hashlib
from collections import Counter, defaultdict

import pytest

from credscope.llm import op07_exact_dedup as op

from .conftest import invented


def brute(rows):
    group = defaultdict(list)
    for i, t, *_ in rows:
        group[t or ""].append(i)
    keep = {t: max((i for i in ids if i is not None), default=None) for t, ids in group.items()}
    return {(i, keep[t or ""], len(group[t or ""]), i == keep[t or ""], hashlib.sha256((t or "").encode()).hexdigest()) for i, t, *_ in rows}


@pytest.mark.parametrize("block", [7, op.BLOCK])
def test_like_brute_force(make_docs, odd_rows, block):
    base = invented(60, seed=5)
    rows = [(100 + i, t) for i, t in enumerate(base)]
    rows += [(300 + i, t) for i, t in enumerate(base[:30])] + [(500 + i, base[3]) for i in range(40)]
    # same length and edges, another middle: only the names tell them apart
    middle = "x" * 200
    rows += [(700 + i, middle[:100] + str(i % 4) + middle) for i in range(12)]
    rows += odd_rows
    if block == 7:
        rows = [(i, t[:2000] if t else t) for i, t, *_ in rows]
    got = op.exact_groups(make_docs(rows), block=block).collect()
    assert {tuple(r)[:5] for r in got} == brute(rows)
    assert len(got) == len({(i, t or "") for i, t, *_ in rows})
    assert max(Counter(r.keep_id for r in got if r.kept and r.keep_id is not None).values()) <= 2  # doc 5 has two texts


def test_keep_one(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    got = op.keep_one(docs)
    assert got.schema == docs.schema
    assert sorted((str(r.doc_id), r.text or "") for r in got.collect()) == sorted((str(i), t or "") for i, t in {(i, t or "") for i, t, *_ in odd_rows} if (i, t) not in {(1, ""), (2, ""), (4, "one"), (None, "one"), (7, odd_rows[9][1])} or (i, t) == (2, ""))


def test_empty_table(make_docs):
    assert op.exact_groups(make_docs([])).collect() == []
