"""Review text: blanks, tokens and the word-list score."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The default sentiment word lists.
POSITIVE_WORDS = (
    "great", "good", "love", "excellent", "fast", "perfect", "best", "recommend",
    "amazing", "fresh", "happy", "quality",
)
NEGATIVE_WORDS = (
    "bad", "poor", "broken", "terrible", "slow", "damaged", "awful", "horrible",
    "defect", "worst", "hate", "issue", "expired", "delay",
)

# Every Unicode white-space character, plus the four ASCII separators that
# Java's class leaves out.
_SPACE = r"\p{IsWhite_Space}\x1c-\x1f"


def is_blank(text: Column) -> Column:
    return ~text.rlike(f"[^{_SPACE}]")


def tokens(text: Column) -> Column:
    """Lower-cased words between white space; punctuation stays attached."""
    return F.split(F.lower(text), f"[{_SPACE}]+")


def lexicon_score(
    text: Column,
    positive: Iterable[str] = POSITIVE_WORDS,
    negative: Iterable[str] = NEGATIVE_WORDS,
) -> Column:
    """(pos - neg) / (pos + neg) over distinct list words in the whole text.

    The text is split once; the fold runs over the few list words found.
    """
    pos, neg = sorted(set(positive)), sorted(set(negative))
    listed = F.array(*[F.lit(w) for w in sorted({*pos, *neg})])

    def count(acc: Column, word: Column) -> Column:
        good, bad = word.isin(pos).cast("int"), word.isin(neg).cast("int")
        return F.struct(
            (acc["net"] + good - bad).alias("net"), (acc["hits"] + good + bad).alias("hits")
        )

    return F.aggregate(
        F.array_intersect(tokens(text), listed),
        F.struct(F.lit(0).alias("net"), F.lit(0).alias("hits")),
        count,
        lambda acc: F.coalesce(F.try_divide(acc["net"], acc["hits"]), F.lit(0.0)),
    )


def truncate(text: Column, limit: int = 512) -> Column:
    """The model input limit: for a model scorer only, never for the word lists."""
    return F.substring(text, 1, limit)
