import hashlib
import re

import pytest

from credscope.llm import op12_secrets as op

BASE = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile("[0-9a-f]+"), 0, 32),
]


def by_hand(text):
    spans = [(m.start(), i, kind, m.end()) for i, (kind, p, g, least) in enumerate(BASE) for m in p.finditer(text or "") if len(m.group(g)) >= least]
    return [sum(s[2] == k for s in spans) for k, *_ in BASE], ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(spans))


TEXTS = [
    None, "", " ", "nothing here", "password=short", 'é\U0001f600 PassWord" : "abcdefgh1 token=12345678',
    "token: token=abcdefgh", "AKIA0123456789AB AKIA123", "0" * 31 + "g" + "a" * 32, "api_key = " + "f" * 40,
    "paſſword=abcdefgh toKen=abcdefgh", "secret='x'secret=yyyyyyyy",
    "-----BEGIN RSA PRIVATE KEY-----", "Bearer abcdefghijklmnopqrstuvwxyz", "https://joe:hunter2@example.org/",
    "ghp_" + "A1" * 20, "eyJhbGciOi.eyJzdWIiOi.c2ln", "w " * 400_000 + "passwd=" + "z" * 9,
]


def test_spans_match_brute_force(spark, make_docs):
    docs = make_docs([(i, t) for i, t in enumerate(TEXTS)] + [(None, TEXTS[5]), (5, TEXTS[5]), (99, TEXTS[5])])
    ledger = op.Ledger(spark, op.Workspace(spark, "t").path)
    got = op.digest(ledger.findings(ledger.scan(docs))).collect()
    assert len(got) == len(TEXTS) + 3
    for r in got:
        text = TEXTS[r["doc_id"]] if r["doc_id"] is not None and r["doc_id"] < 90 else TEXTS[5]
        counts, listed = by_hand(text)
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == counts, r
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert set(listed.split(",")) - {""} <= set(r["spans"].split(","))
    more = {r["doc_id"]: r["spans"] for r in got}
    for i, kind in ((12, "private_key"), (13, "bearer"), (14, "url_password"), (15, "github"), (16, "jwt")):
        assert f"{kind}:" in more[i]


def test_only_unseen_pairs_are_scanned(spark, make_docs):
    ledger = op.Ledger(spark, op.Workspace(spark, "t").path)
    old, new = "AKIA0123456789AB", "Bearer abcdefghijklmnopqrstuvwxyz AKIA0123456789AB"
    ledger.scan(make_docs([(1, old), (2, old)]), rules=op.BASE_RULES)
    pairs = lambda: ledger.rows().where("start IS NULL").count()
    assert pairs() == len(op.BASE_RULES)  # copies are one blob
    paths = ledger.scan(make_docs([(1, old), (3, old), (4, new)]), rules=op.BASE_RULES)
    assert pairs() == 2 * len(op.BASE_RULES)
    assert {r["path"]: len(r["spans"]) for r in ledger.findings(paths, op.BASE_RULES).collect()} == {1: 1, 3: 1, 4: 1}
    paths = ledger.scan(make_docs([(1, old), (4, new)]))  # rules were added
    assert pairs() == 2 * len(op.RULES)
    assert {r["path"]: len(r["spans"]) for r in ledger.findings(paths).collect()} == {1: 1, 4: 2}
    before = ledger.rows().count()
    ledger.scan(make_docs([(8, new)]))
    assert ledger.rows().count() == before


def test_changed_rule_is_another_version():
    assert op.Rule("x", "a+").version != op.Rule("x", "a+", 0, 3).version
    assert op.Rule("x", "a+").version == op.Rule("y", "a+").version


def test_empty_table(spark, make_docs):
    ledger = op.Ledger(spark, op.Workspace(spark, "t").path)
    assert ledger.findings(ledger.scan(make_docs([]))).count() == 0


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_given_table_matches_sql(spark, sf):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('/root/testdata/{sf}/documents.parquet')")
    want = sorted(con.execute(op.ORACLE).fetchall())
    got = sorted(tuple(r) for r in op.query(spark, f"/root/testdata/{sf}").collect())
    assert got == want
    assert sum(r[1] + r[2] + r[3] for r in got) > 0
