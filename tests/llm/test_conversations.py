import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from credscope.llm import op13_conversations as op

SCHEMA = "conv_id long, turn long, role string, text string, conv string, g long"
SPACES = " \t\n\v\f\r"


def repaired_by_hand(rows):
    """Brute force over one conversation's rows, damage done, in order."""
    seen, units, counts = set(), [], [0, 0, 0]
    for role, text in rows:
        words = text.strip(SPACES)
        kind = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else ""
        seen.add((role, text))
        if kind:
            counts[["blank", "duplicate", "truncated"].index(kind)] += 1
        units.append((role, text, kind))
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    @lru_cache(None)
    def best(i, state, inserts):
        options = []
        if i == len(units) and state in ("", "a"):
            options.append((0, "", ()))
        if inserts < 4:
            for role in ("user", "assistant"):
                if role[0] in step[state]:
                    options.append(add(5, "I", ((role, ""),), best(i, step[state][role[0]], inserts + 1)))
        if i < len(units):
            role, text, kind = units[i]
            options.append(add(2, "D", (), best(i + 1, state, 0)))
            if kind not in ("blank", "duplicate"):
                worse = 5 if kind == "truncated" else 0
                if role[:1] in step[state]:
                    options.append(add(worse, "K", ((role, text),), best(i + 1, step[state][role[:1]], 0)))
                for new in ("user", "assistant"):
                    if new[0] in step[state]:
                        options.append(add(worse + 1, "R", ((new, text),), best(i + 1, step[state][new[0]], 0)))
        return min(options, default=(10**9, "~", ()))

    def add(cost, letter, lines, rest):
        return cost + rest[0], letter + rest[1], lines + rest[2]

    cost, audit, lines = best(0, "", 0)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (*counts, illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest())


def by_hand(rows):
    """The query's rows for raw rows (conv_id, turn, role, text)."""
    out = {}
    for conv, turn, role, text in rows:
        held = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        held += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    result = []
    for conv, held in out.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
        turns = {r[0] for r in held if r[0] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        result.append((conv, gaps, *repaired_by_hand([r[1:] for r in held])))
    return sorted(result, key=str)


def by_query(spark, tmp_path, rows, partitions=3):
    spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA).repartition(partitions).write.parquet(str(tmp_path / "conversations.parquet"))
    got = op.query(spark, str(tmp_path))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def invented(seed, conversations, longest):
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for _ in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "User", "", None])
            text = rng.choice(["Yes.", "No!", "Why?", "and then", "", " \n", None, "é.  ", f"text {rng.random()}."])
            rows.append((conv, rng.choice([None, *range(longest)]), role, text))
    return rows


@pytest.mark.parametrize("block", [3, 8192])
def test_query_matches_brute_force(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(op, "BLOCK", block)
    rows = invented(1, 60, 12) + [(None, None, None, None), (None, 1, "user", "Hi."), (900, 2**40, "user", "A."), (900, -5, "user", "B.")]
    rows += [(901, 3, "user", "Same.")] * 7
    assert by_query(spark, tmp_path, rows) == by_hand(rows)


def test_one_conversation_over_many_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(op, "BLOCK", 5)
    rng = random.Random(5)
    rows = [(7, t, rng.choice(["user", "assistant", "system"]), rng.choice([f"Word {t}.", f"cut {t}", "Again."])) for t in range(160)]
    assert by_query(spark, tmp_path, rows) == by_hand(rows)


def test_all_rows_dropped_and_empty_table(spark, tmp_path):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    (tmp_path / "a").mkdir()
    assert by_query(spark, tmp_path / "a", [(gone, 0, "user", "Hi.")]) == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    (tmp_path / "b").mkdir()
    assert by_query(spark, tmp_path / "b", []) == []


def test_very_long_text_and_repaired_rows(spark):
    long = "word " * 300_000 + "end."
    df = spark.createDataFrame([(1, 0, "user", long), (1, 1, "user", "cut off"), (1, 2, "assistant", "Fine.")], "conv_id long, turn long, role string, text string")
    got = op.Repair(df).repaired().orderBy("g", "slot").collect()
    assert [(r["role"], r["text"]) for r in got] == [("user", long), ("assistant", "Fine.")]


def test_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted((tuple(r) for r in op.query(spark, "/root/testdata/sf0.01").collect()), key=str)
    assert got == by_hand(rows)
