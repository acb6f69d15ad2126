import hashlib
import random
from collections import defaultdict

import pytest

from credscope.llm import op05_substring as op

from .conftest import invented


def brute(rows, window=50):
    least = {}
    split = [(r[0], (r[1] or "").encode().split()) for r in rows]
    for i, w in split:
        for k in range(len(w) - window + 1) if i is not None else ():
            key = tuple(w[k : k + window])
            least[key] = min(i, least.get(key, i))
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - window + 1) if i is not None else ():
            if least[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("shard", "stream"), [(op.SHARD, op.STREAM), (40, 300)])
def test_like_brute_force(make_docs, odd_rows, shard, stream):
    rng = random.Random(2)
    texts = [t for t in invented(120, seed=21) if len(t.split()) > 80]
    rows = [(1000 + i, t) for i, t in enumerate(texts)]
    passage = " ".join(invented(40, seed=22)[5:6] * 2 + invented(3, seed=23))
    rows += [(2000 + i, " ".join(t.split()[:20]) + " " + passage + " " + " ".join(t.split()[:rng.randrange(30)])) for i, t in enumerate(texts[:25])]
    for i, t in enumerate(texts[:20]):  # near copies: later ones share more with each other than with the first
        w = t.split()
        w[len(w) // 2] = "edit"
        rows.append((500 + i, " ".join(w)))
        rows.append((3000 + i, " ".join(["before", *w, "after"])))
    rows += [(4000, "a b " * 200), (4001, "b a " * 100), (4002, texts[0]), (4003, texts[0])]
    rng.shuffle(rows)
    rows += odd_rows
    got = op.remove_repeats(make_docs(rows), shard=shard, stream=stream).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == brute(rows)
    for r in got:
        if r.kept_text is not None:
            assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256


def test_automaton_matching_statistics():
    a = op.Automaton()
    a.add("to be or not to be".split())
    a.add("that is the question".split())
    words = "x to be or that is the not to be that is".split()
    want = [max((k for k in range(i + 2) if any(" ".join(words[i + 1 - k : i + 1]) in p for p in (" to be or not to be ", " that is the question ")) ), default=0) for i in range(len(words))]
    for least in (1, 2, 3):
        assert a.matches(words, least).tolist() == [n >= least for n in want]


def test_empty(make_docs):
    assert op.remove_repeats(make_docs([])).collect() == []
