"""Text expressions: trimming, object names, tokens, character trigrams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPACE = r"[\s\x1c-\x1f]"
_CP = 1 << 21  # code points fit in 21 bits, so three of them fit in one bigint


def unicode_trim(text: Column) -> Column:
    """Strip all Unicode white space from both ends, not only ASCII blanks."""
    return F.regexp_replace(text, rf"(?U)^{_SPACE}+|{_SPACE}+\z", "")


def is_blank(text: Column) -> Column:
    return F.length(unicode_trim(text)) == 0


def safe_name(text: Column) -> Column:
    """Every character that is neither letter nor number becomes ``_``."""
    return F.regexp_replace(text, r"[^\p{L}\p{N}]", "_")


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text of a zone-less UTC time; the fraction is left out when it is zero."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(ts, ".SSSSSS")
    return F.concat(
        whole, F.when(fraction == ".000000", F.lit("")).otherwise(fraction), F.lit("+00:00")
    )


def day_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def object_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def report_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd_HH-mm-ss")


def object_name(shop: Column, query: Column, ts: Column, page: Column) -> Column:
    """Landing key of one response; the page keeps same-second responses apart."""
    tail = F.concat_ws("_", shop, safe_name(query), object_stamp(ts), page.cast("string"))
    return F.concat(F.lit("pre_landing/"), day_text(ts), F.lit("/"), tail, F.lit(".json"))


def tokens(text: Column) -> Column:
    """Distinct lower-case words."""
    return F.array_distinct(
        F.filter(F.split(F.lower(text), r"(?U)\s+"), lambda t: F.length(t) > 0)
    )


def number_tokens(text: Column) -> Column:
    """Numbers in the text, sorted, repeats kept."""
    return F.array_sort(F.regexp_extract_all(text, F.lit(r"\d+(?:\.\d+)?"), F.lit(0)))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    The optimizer may copy an alias into every place that uses it, also into a lambda
    that runs per element; a lambda variable stays one value.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def code_points(text: Column) -> Column:
    # Splitting at the empty text gives characters, but one empty text for no text.
    characters = F.filter(F.split(text, ""), lambda c: F.length(c) > 0)
    return F.transform(characters, lambda c: F.ascii(c).cast("bigint"))


def trigram_ids(points: Column) -> Column:
    """Overlapping trigrams of a code point array as exact bigints.

    A text of one or two characters is one gram of its own.
    """
    n = F.size(points)
    return (
        F.when(n == 0, F.array().cast("array<bigint>"))
        .when(
            n < 3,
            F.array(F.aggregate(points, F.lit(0).cast("bigint"), lambda a, p: a * _CP + p)),
        )
        .otherwise(
            F.transform(
                F.sequence(F.lit(0), n - 3),
                lambda i: (F.get(points, i) * _CP + F.get(points, i + 1)) * _CP
                + F.get(points, i + 2),
            )
        )
    )


def _runs(ids: Column) -> Column:
    """Start places of the runs of equal values in a sorted array."""
    n = F.size(ids)
    return F.when(n == 0, F.array().cast("array<int>")).otherwise(
        F.filter(
            F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))),
            lambda i: (i == 0) | (F.get(ids, i) != F.get(ids, i - 1)),
        )
    )


def trigram_counts(text: Column) -> Column:
    """The text's trigrams as ``struct(grams array<bigint>, tf array<int>)``.

    Equal grams are neighbours after sorting, so a count is the distance to the place
    where the gram changes: one sort, else linear in the text, and no shuffle.
    """

    def counted(ids: Column, starts: Column) -> Column:
        ends = F.filter(
            F.concat(starts, F.array(F.size(ids))), lambda i: i > 0
        )
        return F.struct(
            F.transform(starts, lambda i: F.get(ids, i)).alias("grams"),
            F.zip_with(ends, starts, lambda end, start: end - start).alias("tf"),
        )

    return let(
        code_points(text),
        lambda points: let(
            F.sort_array(trigram_ids(points)),
            lambda ids: let(_runs(ids), lambda starts: counted(ids, starts)),
        ),
    )


def bullet_list(items: Column) -> Column:
    return F.array_join(F.transform(items, lambda p: F.concat(F.lit("- "), p)), "\n")
