"""Column builders for lenient parsing and key derivation.

All builders map ``Column -> Column`` with native Spark expressions, so they
stay inside whole-stage codegen.  Raw inputs are strings, exactly as read
from a CSV with an all-string schema.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import MONTH_ABBREVIATIONS, UNKNOWN

# The characters Python's str.strip() removes: every code point whose
# str.isspace() is true (derived by rule, not listed).
_PY_WHITESPACE = "".join(chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace())

# Python float() grammar for finite decimals that contain '_' separators.
_PY_UNDERSCORE_DECIMAL = r"^[+-]?(\d+(_\d+)*(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def py_strip(col: Column | str) -> Column:
    """``str.strip()``: remove leading and trailing Unicode whitespace."""
    return F.btrim(_c(col), F.lit(_PY_WHITESPACE))


def lenient_float(col: Column | str) -> Column:
    """``float(text)`` that yields NULL instead of raising (P5).

    Common path (one cast, one ``translate``): Spark's cast already trims
    ASCII whitespace and reads signs, exponents, ``nan`` and ``inf`` like
    Python; a parsed value is accepted when the text holds nothing but digits,
    signs, ``.``, ``e``/``E`` and blanks (or parsed to NaN/infinity).  This
    rejects what only Java accepts (``1.5d``, ``2f``, hex floats).  The rare
    rest -- Python-only forms such as ``1_000`` or Unicode blanks -- goes
    through a strip and a strict regex of Python's float grammar.
    """
    raw = _c(col)
    v = raw.try_cast("double")
    plain = F.translate(raw, " \t\n\r\x0b\x0c0123456789+-.eE", "") == F.lit("")
    special = F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
    s = py_strip(raw)
    fallback = F.when(
        s.rlike(_PY_UNDERSCORE_DECIMAL), F.regexp_replace(s, "_", "").try_cast("double")
    )
    return F.when(v.isNotNull() & (plain | special), v).otherwise(fallback)


def percent_float(col: Column | str) -> Column:
    """Strip, drop every ``%``, parse; ``''``, ``.`` and junk become NULL.

    Stripping commutes with dropping ``%`` here (the parse strips again), so
    the strip is left to :func:`lenient_float`.
    """
    return lenient_float(F.replace(_c(col), F.lit("%"), F.lit("")))


def thousands_float(col: Column | str) -> Column:
    """Drop thousands separators, parse (P4): ``"88,072"`` -> 88072.0."""
    return lenient_float(F.replace(_c(col), F.lit(","), F.lit("")))


def unknown_if_blank(col: Column | str) -> Column:
    """``value or "Unknown"``: NULL and ``''`` map to ``Unknown``."""
    return F.coalesce(F.nullif(_c(col), F.lit("")), F.lit(UNKNOWN))


def stripped_unknown(col: Column | str) -> Column:
    """``(value or "Unknown").strip()`` (P7): all-blank becomes ``''``."""
    return py_strip(unknown_if_blank(col))


def midpoint(low: Column | str, high: Column | str) -> Column:
    """``(low + high) / 2``; NULL when either side is NULL."""
    return (_c(low) + _c(high)) / F.lit(2.0)


def _has_dash(c: Column) -> Column:
    return c.isNotNull() & c.contains("-")


def _month_number(abbrev: Column) -> Column:
    """Month abbreviation -> 1..12, NULL when unrecognised (case-sensitive)."""
    months = F.create_map(
        *[x for i, m in enumerate(MONTH_ABBREVIATIONS, 1) for x in (F.lit(m), F.lit(i))]
    )
    return months[abbrev]


def issue_year(col: Column | str) -> Column:
    """Text after the last ``-``; ``Unknown`` without a dash (P10)."""
    c = _c(col)
    return F.when(_has_dash(c), F.substring_index(c, "-", -1)).otherwise(F.lit(UNKNOWN))


def _split_first_dash(c: Column) -> tuple[Column, Column]:
    head = F.substring_index(c, "-", 1)
    tail = F.substr(c, F.instr(c, "-") + 1)
    return head, tail


def issue_month(col: Column | str) -> Column:
    """``YYYY-MM`` from ``Mon-YYYY``; unknown month gives ``YYYY-??``."""
    c = _c(col)
    head, tail = _split_first_dash(c)
    mm = F.lpad(_month_number(head).cast("string"), 2, "0")
    return F.when(
        _has_dash(c), F.concat(tail, F.lit("-"), F.coalesce(mm, F.lit("??")))
    ).otherwise(F.lit(UNKNOWN))


def _quarter_of(month: Column) -> Column:
    return F.floor((month - 1) / 3).cast("int") + 1


def issue_quarter(col: Column | str) -> Column:
    """``YYYY-Qn`` from ``Mon-YYYY``; NULL when not derivable."""
    c = _c(col)
    head, tail = _split_first_dash(c)
    m = _month_number(head)
    return F.when(
        _has_dash(c) & m.isNotNull(),
        F.concat(tail, F.lit("-Q"), _quarter_of(m).cast("string")),
    )


def observation_year(col: Column | str) -> Column:
    """First four characters of a ``YYYY-MM-DD`` date string."""
    return F.substring(_c(col), 1, 4)


def observation_quarter(col: Column | str) -> Column:
    """``YYYY-Qn`` of a ``YYYY-MM-DD`` date string; NULL if malformed."""
    parts = F.split(_c(col), "-")
    month = F.get(parts, 1).try_cast("int")
    ok = (F.size(parts) == 3) & month.between(1, 12)
    return F.when(ok, F.concat(F.get(parts, 0), F.lit("-Q"), _quarter_of(month).cast("string")))


def fips5(col: Column | str) -> Column:
    """``str.zfill(5)`` for digit strings: left-pad, never truncate."""
    c = _c(col)
    return F.lpad(c, F.greatest(F.length(c), F.lit(5)), "0")


def is_state_fips(col: Column | str) -> Column:
    """State-level FIPS: ends in ``000`` and is not the national ``00000``."""
    f = fips5(col)
    return f.endswith("000") & (f != F.lit("00000"))
