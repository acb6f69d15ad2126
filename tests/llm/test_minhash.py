import random
import re

import numpy as np
import pytest

from credscope.llm import op02_minhash as op
from credscope.llm.words import word_hashes

from .conftest import invented


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(rows, n, threshold):
    sets = [shingles(r[1], n) for r in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= threshold * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(root(i), []).append(r[0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return sorted(((r[0], len(sets[i]), least[root(i)], r[0] == least[root(i)]) for i, r in enumerate(rows)), key=str)


def edited(text, k, rng):
    w = text.split()
    for _ in range(k):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize(("n", "threshold"), [(3, 85), (5, 80)])
def test_like_brute_force(make_docs, odd_rows, n, threshold):
    rng = random.Random(4)
    base = [t for t in invented(80, seed=11, words=3000) if len(t.split()) > 60]
    rows = [(1000 + i, t) for i, t in enumerate(base)]
    for i, t in enumerate(base[:25]):
        rows += [(2000 + 10 * i + k, edited(t, 1 + k % 4, rng)) for k in range(6)]  # chains around the threshold
    rows += [(5000 + i, edited(base[30], rng.randrange(5), rng)) for i in range(90)]  # one large group
    rows += [(6000 + i, base[31].upper() if i % 2 else base[31]) for i in range(30)]
    passage = " ".join(invented(1, seed=12, words=3000)[0].split()[:40] or ["x"])
    rows += [(7000 + i, passage + " " + t[:150]) for i, t in enumerate(invented(60, seed=13, words=3000))]
    rng.shuffle(rows)
    rows += odd_rows
    got = op.near_groups(make_docs(rows), n, threshold).collect()
    assert sorted((tuple(r)[:4] for r in got), key=str) == brute(rows, n, threshold)


def test_empty(make_docs):
    assert op.near_groups(make_docs([])).collect() == []
    assert [tuple(r)[:4] for r in op.near_groups(make_docs([(1, None), (2, "")])).orderBy("doc_id").collect()] == [(1, 0, 1, True), (2, 0, 2, True)]


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    for size, shared in ((3, 2), (400, 300), (5000, 1000)):
        errors = []
        for _ in range(40):
            x = rng.integers(0, 2**63, 2 * size - shared).astype(np.uint64)
            element = np.concatenate((x[:size], x[size - shared :]))
            a, b = op.sketches(element, np.repeat([0, 1], size), 2, 96)
            assert (a != op._FULL).all()
            errors.append((a == b).mean() - shared / (2 * size - shared))
        assert abs(np.mean(errors)) < 0.03


def passage_rows(n, seed=6):
    passage = " ".join(f"p{i}" for i in range(120))
    rng = random.Random(seed)
    return [(i, passage + " " + " ".join(f"u{rng.randrange(10**9)}" for _ in range(60))) for i in range(n)], rng


def test_a_passage_that_many_documents_share(make_docs):
    rows, rng = passage_rows(70)
    rows += [(100 + i, edited(rows[i][1], 3, rng)) for i in range(20)]
    assert sorted((tuple(r)[:4] for r in op.near_groups(make_docs(rows), 3, 85).collect()), key=str) == brute(rows, 3, 85)


def family(n, words, edits, seed):
    rng = random.Random(seed)
    base = " ".join(f"w{i}" for i in range(words))
    return [(i, edited(base, edits(rng), rng)) for i in range(n)]


@pytest.mark.parametrize(("n", "words", "edits", "seed", "k", "t"), [(150, 60, lambda r: 3, 1, 3, 85), (200, 150, lambda r: r.randrange(16), 2, 5, 80)])
def test_families_of_near_copies_like_brute_force(make_docs, monkeypatch, n, words, edits, seed, k, t):
    monkeypatch.setattr(op, "SMALL", 3)
    rows = family(n, words, edits, seed)
    rows += [(1000 + i, edited(rows[i][1], 1, random.Random(i))) for i in range(0, 40)]
    assert sorted((tuple(r)[:4] for r in op.near_groups(make_docs(rows), k, t).collect()), key=str) == brute(rows, k, t)


def test_tested_pairs_are_bounded_by_the_rows(make_docs, monkeypatch):
    """Copies just under the threshold, which nothing links: all pairs would be
    n (n - 1) / 2, the bound is a pair for a node and band."""
    tested = []
    store = op.Workspace.store

    def counting(self, df, name="t"):
        kept = store(self, df, name)
        if name == "tested":
            tested[-1] += kept.count()
        return kept

    monkeypatch.setattr(op.Workspace, "store", counting)
    for n in (400, 1600):
        tested.append(0)
        op.near_groups(make_docs(family(n, 60, lambda r: 3, n)), 5, 80).count()
        assert tested[-1] <= op.BANDS * n, tested


@pytest.mark.parametrize(("few", "levels"), [(1, 16), (2, 1), (64, 3)])
def test_ranges_of_need_like_brute_force(make_docs, monkeypatch, few, levels):
    """Families of other lengths and with edits in common, settled in all rounds."""
    for name, value in (("SMALL", 2), ("FEW", few), ("LEVELS", levels)):
        monkeypatch.setattr(op, name, value)
    rng = random.Random(few)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(130):
        w = base[: 120 - rng.randrange(12)] + [f"x{k}" for k in range(rng.randrange(9))]
        for _ in range(rng.randrange(8)):
            at = rng.randrange(len(w))
            w[at] = f"v{at % 7}" if rng.random() < 0.7 else f"new{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    assert sorted((tuple(r)[:4] for r in op.near_groups(make_docs(rows), 3, 85).collect()), key=str) == brute(rows, 3, 85)


def test_a_family_is_not_taken_apart_again_for_each_element(make_docs, monkeypatch):
    """Rows of differences in all rounds follow the rows of the family, and
    aren't repeated for each element that some of its nodes share."""
    made = []
    store = op.Workspace.store

    def counting(self, df, name="t"):
        kept = store(self, df, name)
        if name == "differences":
            made.append(kept.count())
        return kept

    monkeypatch.setattr(op.Workspace, "store", counting)
    op.near_groups(make_docs(family(1200, 150, lambda r: r.randrange(16), 5)), 3, 85).count()
    assert made and sum(made[1:]) <= made[0] / 4, made


def test_word_hashes_over_slices(monkeypatch):
    buf = b" ab  c\tab \n" + b"x" * 50 + b" c ab"
    whole = word_hashes(buf)
    monkeypatch.setattr("credscope.llm.words.SLICE", 4)
    for a, b in zip(whole, word_hashes(buf)):
        assert (a == b).all()
    h = whole[0]
    assert h[0] == h[2] == h[5] and h[1] == h[4] and len({*h.tolist()}) == 3
