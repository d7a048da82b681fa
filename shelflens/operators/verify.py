"""Is one of the candidates the same product? A native rule, or a user's judge.

Both give a *reply* per query: the exact name of a candidate, or ``None``/``False``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelflens.functions.text import bullet_list, number_tokens, tokens, unicode_trim
from shelflens.operators.attempts import in_rounds
from shelflens.operators.keep import spread

MIN_JACCARD = 0.8
NO_MATCH = "None"
Judge = Callable[[str], str | None]


def same_product(a: Column, b: Column, min_jaccard: float = MIN_JACCARD) -> Column:
    """Equal numbers, each as often, and mostly the same words."""
    ta, tb = tokens(a), tokens(b)
    shared, either = F.size(F.array_intersect(ta, tb)), F.size(F.array_union(ta, tb))
    return (number_tokens(a) == number_tokens(b)) & (
        (either > 0) & (shared >= F.lit(min_jaccard) * either)
    )


def rule_reply(
    rows: DataFrame, query: str = "query_name", candidates: str = "names",
    min_jaccard: float = MIN_JACCARD,
) -> DataFrame:
    """Add ``reply``: the best-ranked candidate that the rule accepts."""
    accepted = F.filter(candidates, lambda c: same_product(F.col(query), c, min_jaccard))
    return rows.withColumn("reply", F.coalesce(F.get(accepted, F.lit(0)), F.lit(NO_MATCH)))


def verify_payload(
    rows: DataFrame, query: str = "query_name", candidates: str = "names"
) -> DataFrame:
    """Add ``payload``, the question a judge is asked."""
    return rows.withColumn(
        "payload",
        F.concat(
            F.lit("Base product: "), F.col(query),
            F.lit("\nCandidates:\n"), bullet_list(F.col(candidates)),
            F.lit("\nReply with the exact candidate name, or None."),
        ),
    )


def judge_reply(
    rows: DataFrame, judge: Judge, attempts: int = 3, pause: float = 5.0
) -> DataFrame:
    """Add ``reply`` by asking ``judge`` with each ``payload``; ``attempts`` says in which round
    it came, ``failed`` that all raised. Only rows that failed are asked again, see
    ``in_rounds``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            replies, failed = [], []
            for payload in frame["payload"]:
                try:
                    replies.append(judge(payload))
                    failed.append(False)
                except Exception:
                    replies.append(None)
                    failed.append(True)
            yield frame.assign(reply=pd.Series(replies, dtype="object", index=frame.index),
                               failed=failed)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    schema = f"{fields}, reply string, failed boolean"
    return in_rounds(rows, lambda some: spread(some).mapInPandas(run, schema), attempts, pause)


def resolve_reply(
    rows: DataFrame, reply: str = "reply", candidates: str = "names"
) -> DataFrame:
    """Add ``verified_name`` and ``verified_at`` (1-based place); NULL unless the reply
    is exactly one of the candidates. A repeated name resolves to its first place."""
    text = unicode_trim(F.col(reply))
    place = F.when(
        (text != NO_MATCH) & (F.lower(text) != "false") & F.array_contains(candidates, text),
        F.array_position(candidates, text),
    ).cast("int")
    return rows.withColumn("verified_at", place).withColumn(
        "verified_name", F.get(candidates, F.col("verified_at") - 1)
    )
