"""Expressions over parsed JSON values (VARIANT)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _quoted_bare_numbers(text: Column) -> Column:
    """``text`` with quotes around bare ``NaN`` and ``Infinity``, in lists as well; strings stay.

    Between quotes that are not escaped every second stretch lies outside of strings. Escaped
    quotes and backslashes are put aside as control characters, which JSON has nowhere.
    """
    slash, quote = "\u0001", "\u0002"
    plain = F.replace(F.replace(text, F.lit("\\\\"), F.lit(slash)), F.lit('\\"'), F.lit(quote))
    bare = r"(?<![\w.+-])(NaN|-?Infinity)(?![\w.])"
    parts = F.transform(
        F.split(plain, '"'), lambda p, i: F.when(i % 2 == 0, F.regexp_replace(p, bare, '"$1"')).otherwise(p)
    )
    joined = F.array_join(parts, '"')
    back = F.replace(F.replace(joined, F.lit(quote), F.lit('\\"')), F.lit(slash), F.lit("\\\\"))
    return F.when(~F.contains(text, F.lit(slash)) & ~F.contains(text, F.lit(quote)), back)


def parse(text: Column) -> Column:
    """JSON text as a VARIANT, NULL when it is not JSON.

    Bare ``NaN`` and ``Infinity``, which many writers emit, are read as texts; a price
    cleaned from such a text is the same number.
    """
    return F.coalesce(F.try_parse_json(text), F.try_parse_json(_quoted_bare_numbers(text)))


def at(value: Column, path: str) -> Column:
    """The value at ``path``, or NULL when the path does not exist."""
    return F.try_variant_get(value, path, "variant")


def as_list(value: Column, path: str = "$") -> Column:
    return F.try_variant_get(value, path, "array<variant>")


def is_object(value: Column, path: str = "$") -> Column:
    return F.try_variant_get(value, path, "map<string,variant>").isNotNull()


def as_text(value: Column, path: str = "$") -> Column:
    return F.try_variant_get(value, path, "string")


# JSON texts of the falsy values: null, "", false, [], {} and any spelling of zero.
_FALSY = r'^(null|""|false|\[\]|\{\}|-?0(\.0*)?([eE][+-]?\d+)?)$'


def is_truthy(value: Column) -> Column:
    """False for a missing value, null, ``""``, zero, ``false``, ``[]`` and ``{}``.

    The JSON type decides: the number ``0`` is falsy, the string ``"0"`` is not.
    """
    return F.coalesce(~F.to_json(value).rlike(_FALSY), F.lit(False))


def first_truthy(values: list[Column]) -> Column:
    """The first truthy value; the last one when none is truthy."""
    if len(values) == 1:
        return values[0]
    chain = F.when(is_truthy(values[0]), values[0])
    for value in values[1:-1]:
        chain = chain.when(is_truthy(value), value)
    return chain.otherwise(values[-1])


# Code points that the text of a falsy value but the empty text may begin with; most texts begin with others.
_DOUBTFUL = [*map(ord, "-0fn[{")]


def is_truthy_text(text: Column, value: Column, path: str) -> Column:
    """``is_truthy`` of what lies at ``path`` of a parsed ``value``, with its ``text`` known.

    Missing values and nulls have no text, and only an empty string has an empty one. Only where a
    text's first character leaves it open whether it is a string or a falsy number, the value is
    looked up and written as JSON.
    """
    open_to_doubt = F.ascii(text).isin(_DOUBTFUL)
    return text.isNotNull() & (text != "") & (~open_to_doubt | is_truthy(at(value, path)))
