"""Format-preserving Feistel pseudonyms for personal data [native].

Values are found by one pattern, validated (Luhn check, calendar, number
ranges) and replaced by a keyed permutation of their own format, so the same
value gets the same pseudonym in every document, different values get
different ones, and the key's holder can turn them back.  The permutation is a
Feistel network on a pair (l, r) of numbers below (a, b), with addition modulo
a and b; a and b are chosen so that a * b counts the valid values exactly and
no value leaves its format:

    card    13 to 19 digits with a right check digit: the digits before it;
            looked for in runs of numbers, from border to border of groups
    phone   +1 and ten-digit forms: any area code x (exchange, line); the
            digits after the country code of other numbers with a plus
    ssn     (area, group) x serial, invalid numbers left out
    ip      two octets x two octets
    date    1700-01-01 to 2099-12-31: 146097 days = 189 x 773; slash dates
            that are valid month first only: 88497 days after a 12th = 9 x 9833
    email   the local part, runs of letters and digits in base 36
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table, text_of

ROUNDS = 8
#: Session setting that holds the key of the query.
KEY_SETTING = "spark.credscope.pii.key"

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9][A-Za-z0-9-]*(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
DATE = r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4})(?![0-9-])"
IP = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
TEN = r"[0-9]{3}[ .-][0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
PHONE = rf"(?<![0-9+])(?:\+1[ .-]?[0-9]{{10}}(?![0-9])|(?:\+?1[ .-]?)?(?:\([0-9]{{3}}\)[ .-]?[0-9]{{3}}[ .-]?[0-9]{{4}}(?![0-9])|{TEN}))"
#: What a number followed by a blank doesn't run into.
LAYOUT = r"[0-9]{13,19}(?![0-9])|[0-9]{4}[ -](?:[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}|[0-9]{6}[ -][0-9]{4,5})(?![0-9])"
OTHER = "|".join((EMAIL, DATE, IP, SSN))
ABROAD = rf"(?<![0-9+])\+[2-9](?:(?: (?!{OTHER}|{LAYOUT})|[./-])?\(?[0-9]\)?){{6}}(?:(?: (?!{OTHER}|{LAYOUT}|{TEN})|[./-])?\(?[0-9]\)?){{0,8}}(?![0-9])"
COUNTRY = "^(?:7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
#: A run of numbers with 13 digits or more, as long as it is.
CARD = rf"(?<![0-9])[0-9](?:(?:[ -](?!{OTHER}|{TEN}))?[0-9]){{12,}}+"
CARD_GROUPS = "^(?:1[3-9]|4-4-4-4(?:-3)?|4-6-[45])$"
PATTERN = "|".join((EMAIL, DATE, IP, SSN, PHONE, ABROAD, CARD))

FIRST_DAY, DAYS, LATE_DAYS, MONTHS = "1700-01-01", (189, 773), (9, 9833), 4800
BASE36 = "0123456789abcdefghijklmnopqrstuvwxyz"


def _feistel(left: Column, right: Column, a: Column, b: Column, key: str, tag: Column | str, back: bool) -> Column:
    """struct(l, r): the keyed permutation of pairs below (a, b)."""
    tag = F.lit(tag) if isinstance(tag, str) else tag

    def mixed(number: Column, other: Column, size: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", F.lit(key), tag, number.cast("string"), other.cast("string")), 256)
        return F.pmod(F.conv(F.substring(digest, 1, 13), 16, 10).cast("long"), size)

    def turn(acc: Column, number: Column) -> Column:
        sign = -1 if back else 1
        on_left = F.struct(F.pmod(acc["l"] + sign * mixed(number, acc["r"], a), a).alias("l"), acc["r"].alias("r"))
        on_right = F.struct(acc["l"].alias("l"), F.pmod(acc["r"] + sign * mixed(number, acc["l"], b), b).alias("r"))
        return F.when(number % 2 == 0, on_left).otherwise(on_right)

    order = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.array(*[F.lit(i) for i in order]), start, turn)


def _with(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def _long(n: int) -> Column:
    return F.lit(n).cast("long")


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _refill(m: Column, digits: Column) -> Column:
    """``m`` with its digits replaced by ``digits`` in turn."""

    def one(i: Column) -> Column:
        char = F.substring(m, i, F.lit(1))
        return F.when(char.rlike("[0-9]"), F.substring(digits, F.length(_digits(F.substring(m, F.lit(1), i))), F.lit(1))).otherwise(char)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(m)), one), "")


def _pad(n: Column, width: int | Column) -> Column:
    return F.lpad(n.cast("string"), width, "0")


def luhn_sum(digits: Column, doubled_last: bool) -> Column:
    """Luhn sum; ``doubled_last``: the last digit is doubled (no check digit yet)."""
    shift = 0 if doubled_last else 1

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return acc + F.when((i + shift) % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add)


def _card(d: Column, key: str, back: bool) -> Column:
    """The pseudonym of a card's digits."""
    half = F.floor((F.length(d) - 1) / 2).cast("int")
    rest = F.length(d) - 1 - half
    size = lambda n: F.pow(F.lit(10), n).cast("long")
    pair = _feistel(F.substring(d, F.lit(1), half), F.substring(d, half + 1, rest), size(half), size(rest), key, F.concat(F.lit("card"), F.length(d).cast("string")), back)
    body = _with(pair, lambda p: F.concat(_pad(p["l"], half), _pad(p["r"], rest)))
    return _with(body, lambda x: F.concat(x, F.pmod(-luhn_sum(x, True), F.lit(10)).cast("string")))


def _card_at(d: Column, i: Column, usual: bool, key: str, back: bool) -> Column:
    """Number of groups of the card that begins with the ``i``-th of the groups
    ``d``, 0 if none does.

    The longest is taken.  Its pseudonym can make a longer one valid, so on the
    way back the shortest is taken that can have been the longest.
    """
    counts = F.sequence(F.lit(1), F.least(F.lit(19), F.size(d) - i + 1))
    text = lambda at, n: F.array_join(F.slice(d, at, n), "")

    def valid(t: Column, n: Column) -> Column:
        ok = F.when(F.length(t).between(13, 19), luhn_sum(t, False) % 10 == 0).otherwise(False)
        return F.array_join(F.transform(F.slice(d, i, n), lambda x: F.length(x).cast("string")), "-").rlike(CARD_GROUPS) & ok if usual else ok

    def was_longest(n: Column) -> Column:
        longer = lambda t: F.exists(counts, lambda k: (k > n) & valid(F.concat(t, text(i + n, F.greatest(k - n, F.lit(0)))), k))
        return _with(_card(text(i, n), key, back), lambda t: ~longer(t))

    def pick(v: Column) -> Column:
        best = F.element_at(v, -1)
        return F.when(F.size(v) == 0, 0).otherwise(F.coalesce(F.try_element_at(F.filter(v, was_longest), F.lit(1)), best) if back else best)

    return _with(F.filter(counts, lambda n: valid(text(i, n), n)), pick)


def _split_cards(groups: Column, usual: bool, key: str, back: bool) -> Column:
    """array of (g, card): the groups as pieces that are one card or hold none."""
    digits = F.transform(groups, _digits)

    def step(acc: Column, i: Column, d: Column) -> Column:
        one = lambda n: F.struct((i + n).alias("free"), F.concat(acc["picks"], F.array(F.struct(i.alias("s"), n.alias("n")))).alias("picks"))
        return F.when(i < acc["free"], acc).otherwise(_with(_card_at(d, i, usual, key, back), lambda n: F.when(n == 0, acc).otherwise(one(n))))

    start = F.struct(F.lit(1).alias("free"), F.array().cast("array<struct<s:int,n:int>>").alias("picks"))
    picks = _with(digits, lambda d: F.aggregate(F.sequence(F.lit(1), F.size(d)), start, lambda acc, i: step(acc, i, d))["picks"])
    piece = lambda at, n, card: F.struct(F.slice(groups, at, n).alias("g"), F.lit(card).alias("card"))

    def pieces(p: Column) -> Column:
        ends = F.concat(F.array(F.lit(1)), F.transform(p, lambda x: x["s"] + x["n"]))
        both = F.transform(p, lambda x, k: _with(ends, lambda e: F.array(piece(e[k], x["s"] - e[k], False), piece(x["s"], x["n"], True))))
        last = _with(F.element_at(ends, -1), lambda e: piece(e, F.size(groups) - e + 1, False))
        return F.concat(F.flatten(both), F.array(last))

    return _with(picks, pieces)


def _run(m: Column, key: str, back: bool) -> Column:
    """A run of numbers as array of (old, new): its cards, and what is between.

    Cards in the usual groups come first, from left to right, then others in
    what is left.  Neighbouring groups that happen to pass the check together
    can hide the border of a card; that isn't told from a card.
    """
    usual = _with(F.regexp_extract_all(m, F.lit("[0-9]+[ -]?"), F.lit(0)), lambda g: _split_cards(g, True, key, back))
    others = lambda p: F.when(p["card"] | (F.size(p["g"]) == 0), F.array(p)).otherwise(_with(p["g"], lambda g: _split_cards(g, False, key, back)))

    def changed(p: Column) -> Column:
        old = F.array_join(p["g"], "")
        return F.struct(old.alias("old"), F.when(p["card"], _with(_digits(old), lambda d: _refill(old, _card(d, key, back)))).otherwise(old).alias("new"))

    return F.transform(F.flatten(F.transform(usual, others)), changed)


def _phone(m: Column, key: str, back: bool) -> Column:
    def of(d: Column) -> Column:
        n = F.length(d)
        area, line = F.substring(d, n - 9, F.lit(3)), F.substring(d, n - 6, F.lit(7))
        pair = _feistel(area, line, _long(1000), _long(10_000_000), key, "phone", back)
        return _with(pair, lambda p: F.concat(F.substring(d, F.lit(1), n - 10), _pad(p["l"], 3), _pad(p["r"], 7)))

    return _with(_digits(m), lambda d: _refill(m, of(d)))


def _abroad(m: Column, key: str, back: bool) -> Column:
    """A number with another country code, which stays."""
    size = lambda n: F.pow(F.lit(10), n).cast("long")

    def of(d: Column, code: Column) -> Column:
        n = F.length(d) - F.length(code)
        half = F.floor(n / 2).cast("int")
        left, right = F.substring(d, F.length(code) + 1, half), F.substring(d, F.length(code) + half + 1, n - half)
        pair = _feistel(left, right, size(half), size(n - half), key, F.concat(F.lit("phone"), code, F.lit("-"), n.cast("string")), back)
        return _with(pair, lambda p: F.concat(code, _pad(p["l"], half), _pad(p["r"], n - half)))

    return _with(_digits(m), lambda d: _refill(m, of(d, F.regexp_extract(d, COUNTRY, 0))))


def _ssn(m: Column, key: str, back: bool) -> Column:
    part = lambda i, n: F.substring(m, i, n).cast("long")
    area, group, serial = part(1, 3), part(5, 2), part(8, 4)
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    place = F.when(area > 666, area - 2).otherwise(area - 1)
    pair = _feistel(place * 99 + group - 1, serial - 1, _long(898 * 99), _long(9999), key, "ssn", back)

    def text(p: Column) -> Column:
        place = F.floor(p["l"] / 99)
        return F.concat_ws("-", _pad(F.when(place > 664, place + 2).otherwise(place + 1), 3), _pad(p["l"] % 99 + 1, 2), _pad(p["r"] + 1, 4))

    return F.when(valid, _with(pair, text)).otherwise(m)


def _ip(m: Column, key: str, back: bool) -> Column:
    o = F.transform(F.split(m, r"\."), lambda x: x.cast("long"))

    def of(x: Column) -> Column:
        pair = _feistel(x[0] * 256 + x[1], x[2] * 256 + x[3], _long(65536), _long(65536), key, "ip", back)
        text = lambda p: F.concat_ws(".", *[c.cast("string") for h in ("l", "r") for c in (F.floor(p[h] / 256), p[h] % 256)])
        return F.when(F.forall(x, lambda v: v < 256), _with(pair, text)).otherwise(m)

    return _with(o, of)


def _date(m: Column, key: str, back: bool) -> Column:
    """Dates with points or slashes are read day first, and with slashes month
    first where that isn't valid; such a date gets another of its kind."""
    iso = m.rlike("^[0-9]{4}-")
    part = lambda s, i, n: F.substring(s, i, n)
    first = F.lit(FIRST_DAY).cast("date")
    read = lambda s: F.datediff(F.try_to_timestamp(s, F.lit("yyyy-MM-dd")).cast("date"), first).cast("long")
    known = lambda n: n.between(0, DAYS[0] * DAYS[1] - 1)
    text = lambda n: F.date_add(first, n.cast("int")).cast("string")

    def moved(n: Column) -> Column:
        pair = _feistel(F.floor(n / DAYS[1]), n % DAYS[1], _long(DAYS[0]), _long(DAYS[1]), key, "date", back)
        new = _with(pair, lambda p: text(p["l"] * DAYS[1] + p["r"]))
        return _with(new, lambda t: F.when(iso, t).otherwise(F.concat(part(t, 9, 2), part(m, 3, 1), part(t, 6, 2), part(m, 6, 1), part(t, 1, 4))))

    def moved_late(n: Column) -> Column:
        """Of the days after the 12th of their months, counted through."""
        before = lambda month: F.datediff(F.add_months(first, month.cast("int")), first) - 12 * month
        count = n - 12 * ((part(m, 7, 4).cast("long") - 1700) * 12 + part(m, 1, 2).cast("long"))
        pair = _with(count, lambda c: _feistel(F.floor(c / LATE_DAYS[1]), c % LATE_DAYS[1], _long(LATE_DAYS[0]), _long(LATE_DAYS[1]), key, "date month first", back))

        def late(c: Column) -> Column:
            near = F.floor(c * MONTHS / (LATE_DAYS[0] * LATE_DAYS[1]))
            month = F.array_max(F.filter(F.sequence(near - 1, near + 1), lambda x: before(x) <= c))
            return _with(month, lambda x: text(c + 12 * (x + 1)))

        new = _with(_with(pair, lambda p: p["l"] * LATE_DAYS[1] + p["r"]), late)
        return _with(new, lambda t: F.concat_ws("/", part(t, 6, 2), part(t, 9, 2), part(t, 1, 4)))

    day_first = read(F.when(iso, m).otherwise(F.concat_ws("-", part(m, 7, 4), part(m, 4, 2), part(m, 1, 2))))
    month_first = read(F.when(m.rlike("^../../"), F.concat_ws("-", part(m, 7, 4), part(m, 1, 2), part(m, 4, 2))))
    either = F.struct(day_first.alias("n"), month_first.alias("late"))
    return _with(either, lambda d: F.when(known(d["n"]), moved(d["n"])).when(known(d["late"]), moved_late(d["late"])).otherwise(m))


def _email(m: Column, key: str, back: bool) -> Column:
    """Runs of letters and digits, in pieces of at most 18, as base 36 numbers;
    the domain and the marks between the runs stay.  Case is given up."""
    size = lambda n: F.pow(F.lit(36), n).cast("long")
    number = lambda s: F.when(s == "", 0).otherwise(F.conv(s, 36, 10).cast("long"))
    word = lambda n, width: F.when(width == 0, "").otherwise(F.lpad(F.lower(F.conv(n.cast("string"), 10, 36)), width, "0"))

    def run(s: Column) -> Column:
        half = F.floor(F.length(s) / 2).cast("int")
        rest = F.length(s) - half
        pair = _feistel(number(F.substring(s, F.lit(1), half)), number(F.substring(s, half + 1, rest)), size(half), size(rest), key, F.concat(F.lit("mail"), F.length(s).cast("string")), back)
        return F.when(s.rlike("[a-z0-9]"), _with(pair, lambda p: F.concat(word(p["l"], half), word(p["r"], rest)))).otherwise(s)

    runs = F.regexp_extract_all(F.lower(F.substring_index(m, "@", 1)), F.lit("[a-z0-9]{1,18}|[^a-z0-9]"), F.lit(0))
    return F.concat(F.array_join(F.transform(runs, run), ""), F.lit("@"), F.substring_index(m, "@", -1))


def _replaced(m: Column, key: str, back: bool) -> Column:
    """A match of ``PATTERN`` as array of (old, new): one, or those of a run of numbers."""
    whole = lambda p: m.rlike(f"^(?:{p})$")
    kinds = ((m.contains("@"), _email), (whole(DATE), _date), (whole(IP), _ip), (whole(SSN), _ssn), (whole(PHONE), _phone), (m.startswith("+"), _abroad))
    out = F
    for is_kind, of in kinds:
        out = out.when(is_kind, F.array(F.struct(m.alias("old"), of(m, key, back).alias("new"))))
    return out.otherwise(_run(m, key, back))


def _new(pieces: Column) -> Column:
    return F.array_join(F.transform(pieces, lambda p: p["new"]), "")


def pseudonym(m: Column, key: str, back: bool = False) -> Column:
    """The pseudonym of a match of ``PATTERN``; an invalid value stays as it is."""
    return _new(_replaced(m, key, back))


def pseudonymize(docs: DataFrame, key: str, back: bool = False) -> DataFrame:
    """doc_id, text (values replaced), n_replaced, found, pseudonyms: one row per row.

    ``found`` and ``pseudonyms`` list the replaced values and what stands for
    them, in text order.  ``key`` must be secret: whoever has it, or a plan or
    an event log, which hold it as a literal, can turn the values back.  ``back=True`` with the same key restores the values
    (e-mail local parts in lower case).

    Null text counts as empty.  Rows are independent, so repeated rows, ties
    and null doc_ids give their rows as they are; texts are read whole in
    linear time.  Other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select("doc_id", text_of().alias("text"))
    rows = rows.withColumn("all", F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)))
    rows = rows.withColumn("pieces", F.transform("all", lambda m: _replaced(m, key, back)))
    trimmed = lambda s: F.regexp_replace(s, "[ -]$", "")
    changed = F.filter(F.flatten("pieces"), lambda p: p["old"] != p["new"])
    between = F.split("text", PATTERN, -1)
    joined = F.array_join(F.zip_with(between, F.transform("pieces", _new), lambda s, n: F.concat(s, F.coalesce(n, F.lit("")))), "")
    return rows.select(
        "doc_id",
        F.when(F.size("all") == 0, F.col("text")).otherwise(joined).alias("text"),
        F.size(changed).cast("long").alias("n_replaced"),
        F.transform(changed, lambda p: trimmed(p["old"])).alias("found"),
        F.transform(changed, lambda p: trimmed(p["new"])).alias("pseudonyms"),
    )


def session_key(spark) -> str:
    """The key in ``KEY_SETTING``; unset, a random one for this session, whose
    pseudonyms agree within the session and can't be turned back after it."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        key = secrets.token_hex(32)
        spark.conf.set(KEY_SETTING, key)
    return key


def query(spark, sf_dir):
    return pseudonymize(table(spark, sf_dir, "documents"), session_key(spark))
