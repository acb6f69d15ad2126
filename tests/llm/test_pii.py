import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from credscope.llm import op08_pii as op

KEY = "a key of these tests"


def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0


def with_check(body):
    return next(body + c for c in "0123456789" if luhn(body + c))


def replaced(spark, values, key=KEY, back=False):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, m string")
    return [r.p for r in rows.select("i", op.pseudonym(F.col("m"), key, back).alias("p")).orderBy("i").collect()]


VALID = {
    "card": [with_check("4" + "12345678901234"[:n] + str(n)) for n in range(11, 15)] + ["4111 1111 1111 1111", "5500-0000-0000-0004"],
    "phone": ["+1 (724) 555-7058", "724-555-7058", "1 212.555.0199", "(212) 5550199"],
    "ssn": ["078-05-1120", "667-01-0001", "899-99-9999", "001-01-0001"],
    "ip": ["0.0.0.0", "255.255.255.255", "43.203.110.141"],
    "date": ["1999-12-31", "2000-02-29", "1700-01-01", "2099-12-31", "29/02/2024", "31.12.1999"],
    "email": ["hsr.29@mail5.example.com", "a@b.co", "verylongname1234567890abcdefghijk_x@d.example.org"],
}


@pytest.mark.parametrize("kind", VALID)
def test_round_trip_within_the_format(spark, kind):
    values = VALID[kind]
    new = replaced(spark, values)
    assert replaced(spark, new, back=True) == values
    assert new != values and replaced(spark, values) == new and replaced(spark, values, "other key") != new
    for a, b in zip(values, new):
        assert len(a) == len(b) or kind == "ip"
        if kind == "card":
            assert luhn(b)
        if kind == "date":
            y, m, d = (int(x) for x in (re.split("[./-]", b) if b[4] == "-" else re.split("[./-]", b)[::-1]))
            assert datetime.date(1700, 1, 1) <= datetime.date(y, m, d) <= datetime.date(2099, 12, 31)
        if kind == "email":
            assert a.split("@")[1] == b.split("@")[1]
        else:
            assert re.sub(r"\d+", "0", a) == re.sub(r"\d+", "0", b)


def test_permutation_of_a_small_domain(spark):
    values = [f"1.2.{i}.{j}" for i in range(16) for j in range(256)]
    assert len(set(replaced(spark, values))) == len(values)


def test_invalid_values_stay(spark):
    bad = ["4111 1111 1111 1112", "2023-02-29", "2023-13-01", "1699-12-31", "256.1.1.1", "666-12-1234", "000-12-1234", "900-12-1234", "123-00-1234", "123-45-0000"]
    assert replaced(spark, bad) == bad


def test_texts(spark, make_docs, odd_rows):
    texts = ["Card 4111 1111 1111 1111, call +1 (724) 555-7058.", "x 4111 1111 1111 1111 y me@x.example.com at 10.0.0.1 on 2020-01-31", "version 1.2.3 and 12345 items; 99999999999999999999999", "4111111111111111"]
    rows = [(100 + i, t) for i, t in enumerate(texts)] + odd_rows
    docs = make_docs(rows)
    out = op.pseudonymize(docs, KEY)
    got = {r.doc_id: r for r in out.where("doc_id >= 100").collect()}
    assert [got[100 + i].n_replaced for i in range(4)] == [2, 4, 0, 1]
    assert got[100].pseudonyms[0] == got[101].pseudonyms[0] and got[100].found[0] == "4111 1111 1111 1111"
    assert got[102].text == texts[2]
    assert re.fullmatch(r"Card [0-9 ]{19}, call \+1 \(\d{3}\) \d{3}-\d{4}\.", got[100].text)
    back = op.pseudonymize(out.select("doc_id", "text"), KEY, back=True)
    assert sorted((str(r.doc_id), r.text) for r in back.collect()) == sorted((str(r[0]), r[1] or "") for r in rows)
    assert op.pseudonymize(make_docs([]), KEY).collect() == []


AREAS = [f"+1 ({a:03d}) 555-{7000 + a}" for a in (*range(200), 999)]
PLUS = ["+44 20 7946 0958", "+442079460958", "+44 (0)20 7946 0958", "+49 30 901820", "+49 30/901820-12", "+33 1 23 45 67 89", "+353-1-555-0199", "+7 (495) 123-45-67", "+290 2345"]


def test_phones_of_any_area_code_and_country(spark, make_docs):
    values = [*AREAS, "+10175557713", "+1 0175557713", "017.555.7713", "(136) 155-7479", "1-017-055-7713", *PLUS]
    out = op.pseudonymize(make_docs([(i, f"call {v}, now") for i, v in enumerate(values)]), KEY)
    got = {r.doc_id: r for r in out.collect()}
    assert [list(got[i].found) for i in range(len(values))] == [[v] for v in values]
    assert len({got[i].pseudonyms[0] for i in range(len(AREAS))}) == len(AREAS)
    for i, v in enumerate(values):
        assert re.sub(r"\d", "0", got[i].pseudonyms[0]) == re.sub(r"\d", "0", v) and got[i].text == f"call {got[i].pseudonyms[0]}, now"
    for v, n, same in zip(PLUS, replaced(spark, PLUS), ("+44", "+44", "+44", "+49", "+49", "+33", "+353", "+7", "+290")):
        assert n != v and n.startswith(same)
    assert {r.doc_id: r.text for r in op.pseudonymize(out.select("doc_id", "text"), KEY, back=True).collect()} == {i: f"call {v}, now" for i, v in enumerate(values)}


def test_plus_numbers_leave_the_next_value(spark, make_docs):
    number, after = "+49 30 901820", ["4111 1111 1111 1111", "4111111111111111", "2020-01-31", "192.168.100.100", "078-05-1120", "212-555-0199", "12ab@x.example.com"]
    got = {r.doc_id: r.found for r in op.pseudonymize(make_docs([(i, f"{number} {v}") for i, v in enumerate(after)]), KEY).collect()}
    assert [list(got[i]) for i in range(len(after))] == [[number, v] for v in after]


def test_cards_beside_numbers(spark, make_docs):
    plain, spaced = "4111111111111111", "4111 1111 1111 1111"
    texts = {
        f"{plain} 12/25": [plain], f"order 5 {plain}": [plain], f"{spaced} 737": [spaced], f"12345678 {spaced}": [spaced], f"5 {spaced} 12 2025": [spaced],
        f"{plain} 5500-0000-0000-0004 7": [plain, "5500-0000-0000-0004"], f"3782 822463 10005 1234": ["3782 822463 10005"], f"7 4111111 111111111": ["4111111 111111111"],
        f"{plain} 2020-01-31": [plain, "2020-01-31"], f"{plain} 10.0.0.1": [plain, "10.0.0.1"], f"{spaced} 212-555-0199": [spaced, "212-555-0199"], f"{plain} 12ab@x.example.com": [plain, "12ab@x.example.com"],
    }
    texts |= {f"{c} {n}": [c] for i in range(20) for c, n in [(with_check(f"4{i:014d}"), f"{i * 37 % 1000:03d}")] if not luhn(c + n)}
    out = op.pseudonymize(make_docs(list(enumerate(texts))), KEY)
    got = {r.doc_id: r for r in out.collect()}
    assert [list(got[i].found) for i in range(len(texts))] == list(texts.values())
    assert len({got[i].pseudonyms[0].replace(" ", "") for i, t in enumerate(texts) if t.replace(" ", "").find(plain) >= 0}) == 1
    assert {r.doc_id: r.text for r in op.pseudonymize(out.select("doc_id", "text"), KEY, back=True).collect()} == dict(enumerate(texts))
    assert got[2].text == got[2].pseudonyms[0] + " 737"


def test_long_run_of_numbers(spark, make_docs):
    text = "4111111111111111 " + "1 " * 20_000 + "4111111111111111"
    row = op.pseudonymize(make_docs([(1, text), (2, "0" + "1" * 200_000)]), KEY).where("doc_id = 1").first()
    assert row.found[0] == row.found[-1] == "4111111111111111" and len(row.text) == len(text)


def test_month_first_dates(spark):
    values = ["12/31/2020", "01/13/1700", "02/29/2000", "12/31/2099", *(f"10/{d}/2021" for d in range(13, 32))]
    new = replaced(spark, values)
    assert replaced(spark, new, back=True) == values and len(set(new)) == len(values) and all(a != b for a, b in zip(new, values))
    for t in new:
        m, d, y = map(int, t.split("/"))
        assert d > 12 and datetime.date(1700, 1, 1) <= datetime.date(y, m, d) <= datetime.date(2099, 12, 31)
    bad = ["13/31/2020", "02/30/2020", "12.31.2020", "12/31/1699"]
    assert replaced(spark, bad) == bad


def test_key_of_the_session(spark):
    before = spark.conf.get(op.KEY_SETTING, None)
    try:
        spark.conf.set(op.KEY_SETTING, "given")
        assert op.session_key(spark) == "given"
        spark.conf.unset(op.KEY_SETTING)
        drawn = op.session_key(spark)
        assert len(drawn) == 64 and op.session_key(spark) == drawn
    finally:
        spark.conf.set(op.KEY_SETTING, before) if before else spark.conf.unset(op.KEY_SETTING)


NUMBER = {"ssn": "ddd-dd-dddd", "ip": "dd.ddd.dd.ddd", "iso": "dddd-dd-dd"}


def _scanned(text):
    """SSNs, addresses and dates of blank-separated words, found without a pattern."""
    found = []
    for word in text.split(" "):
        form = "".join("d" if c in "0123456789" else c for c in word)
        if form == NUMBER["ssn"]:
            area, group, serial = word.split("-")
            valid = area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"
        elif form == NUMBER["ip"]:
            valid = all(int(part) <= 255 for part in word.split("."))
        elif form == NUMBER["iso"]:
            try:
                valid = 1700 <= datetime.date(*map(int, word.split("-"))).year <= 2099
            except ValueError:
                valid = False
        else:
            valid = False
        if valid:
            found.append(word)
    return found


def test_found_as_by_a_scan_of_words(spark, make_docs):
    rng = random.Random(8)
    texts = []
    for _ in range(600):
        forms = [rng.choice([*NUMBER.values(), "word", "d.d", "dd/d"]) for _ in range(rng.randint(0, 12))]
        numbers = ["".join(rng.choice("0011223456789") if c == "d" and f != "word" else c for c in f) for f in forms]
        texts.append(" and ".join(rng.choice(["2020-02-30", "666-12-1234", n, n, n]) for n in numbers))
    got = {r.doc_id: list(r.found) for r in op.pseudonymize(make_docs(list(enumerate(texts))), KEY).collect()}
    assert [got[i] for i in range(len(texts))] == [_scanned(t) for t in texts]
    assert sum(map(len, got.values())) > 300
