"""Numeric expressions: IEEE division, price clean-up, similarity rounding."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelflens.functions.text import unicode_trim

# Similarities are compared and ranked at this many decimals, so that the order of
# floating-point additions cannot change a result.
SCORE_DIGITS = 6

_DIGITS = [c for c in map(chr, range(128, sys.maxunicode + 1)) if unicodedata.category(c) == "Nd"]
_FOREIGN_DIGITS = "".join(_DIGITS)
_ASCII_DIGITS = "".join(str(unicodedata.decimal(c)) for c in _DIGITS)

# What most prices are: nothing to drop, to trim or to translate.
_PLAIN = r"^[0-9]+([.][0-9]+)?\z"
_RUN = r"\d+(_\d+)*"
_FLOAT = (
    rf"(?i)^[+-]?(({_RUN}([.]({_RUN})?)?|[.]{_RUN})(e[+-]?{_RUN})?|nan|inf|infinity)$"
)


def ieee_div(a: Column, b: Column) -> Column:
    """``a / b`` with x/0 = ±inf and 0/0 = NaN; NULL propagates."""
    a, b = a.cast("double"), b.cast("double")
    return (
        F.when((b != 0) | b.isNull() | a.isNull(), F.try_divide(a, b))
        .when((a == 0) | F.isnan(a), F.lit(float("nan")))
        .when(a > 0, F.lit(float("inf")))
        .otherwise(F.lit(float("-inf")))
    )


def clean_price_text(text: Column) -> Column:
    """Drop ``฿ $ , €`` anywhere, then trim Unicode white space."""
    cleaned = unicode_trim(F.regexp_replace(text, "[฿$,€]", ""))
    return F.when(text.rlike(_PLAIN), text).otherwise(cleaned)


def python_float(text: Column) -> Column:
    """The double that Python's ``float`` reads from ``text``; NULL where it refuses.

    Differs from a SQL cast: ``1_000`` and non-ASCII decimal digits are numbers,
    ``1.5d``, ``1.5f`` and ``0x1p3`` are not.
    """
    plain = F.translate(text, _FOREIGN_DIGITS, _ASCII_DIGITS)
    # The cast knows nan and inf in any case, but no sign before nan.
    castable = F.regexp_replace(plain, "(?i)_|^[+-](?=nan$)", "")
    return F.when(text.rlike(_PLAIN), text.try_cast("double")).when(
        plain.rlike(_FLOAT), castable.try_cast("double")
    )


def clean_price(text: Column) -> Column:
    """Price text to double, NULL where it is not a number."""
    return python_float(clean_price_text(text))
