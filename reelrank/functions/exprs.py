"""Column expressions used across operators. All are built-in Spark
expressions, so they stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round6(c: str | Column) -> Column:
    """Metric values are reported rounded to 6 decimals."""
    return F.round(col(c).cast("double"), 6)


def ratio(num: str | Column, den: str | Column) -> Column:
    """num / den as double, NULL when den is 0 (ANSI-safe)."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def binary_label(rating: str | Column, threshold: float = 4.0) -> Column:
    """1 when rating >= threshold else 0."""
    return F.when(col(rating) >= threshold, F.lit(1)).otherwise(F.lit(0))


def ideal_gain(hits: str | Column) -> Column:
    """discounted gain of that many hits at ranks 1, 2, ...; 0 for none."""
    n = F.coalesce(col(hits), F.lit(0)).cast("int")
    ranks = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(ranks, F.lit(0.0), lambda total, r: total + 1 / F.log2(r + 1))


def ideal_dcg_of_ones(n: int) -> float:
    """DCG of n relevant items at the top: the fixed ideal of the sampled family."""
    import math
    return sum(1.0 / math.log2(i + 2) for i in range(n))


def left_pad(arr: str | Column, max_len: int, pad: Column | None = None) -> Column:
    """keep the last ``max_len`` elements and left-pad to ``max_len``."""
    a = col(arr)
    pad = F.lit(0) if pad is None else pad
    n = F.size(a)
    tail = F.slice(a, F.greatest(n - max_len + 1, F.lit(1)), max_len)
    fill = F.array_repeat(pad, F.greatest(F.lit(max_len) - n, F.lit(0)))
    return F.concat(fill, tail)


def multi_hot(genres: str | Column, vocabulary: Sequence[str], substring: bool = False) -> Column:
    """One 0/1 entry per vocabulary genre.

    Exact mode splits the pipe list and tests membership (the training rule);
    substring mode tests text containment (the serving rule, kept only to
    measure how the two disagree).
    """
    g = col(genres)
    if substring:
        flags = [F.contains(g, F.lit(v)).cast("int") for v in vocabulary]
    else:
        tokens = F.split(g, r"\|")
        flags = [F.array_contains(tokens, F.lit(v)).cast("int") for v in vocabulary]
    return F.array(*flags) if flags else F.array().cast("array<int>")


def jaccard(inter: str | Column, size_a: str | Column, size_b: str | Column) -> Column:
    """|A n B| / (|A| + |B| - |A n B|), NULL for two empty sets."""
    return ratio(inter, col(size_a) + col(size_b) - col(inter))
