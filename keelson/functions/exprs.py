"""Column expressions shared by the operators.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen and have a word-for-word SQL twin (see ``plans/queries.py``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Smallest positive double step used to guard MAPE against a zero label.
MAPE_EPS = 2.220446049250313e-16


def col_list(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def key_string(cols: Sequence[str | Column], salt: str = "") -> Column:
    """``salt|k1|k2…`` — the text hashed by the splits.

    Timestamps must be passed as epoch seconds (``unix_timestamp``) so the
    text does not depend on a time-zone or a print format.
    """
    parts = [F.lit(salt)] + [c.cast("string") for c in col_list(cols)]
    return F.concat_ws("|", *parts)


def hash32(cols: Sequence[str | Column], salt: str = "", part: int = 0) -> Column:
    """Unsigned 32-bit slice ``part`` (0..3) of md5 over the key text.

    Depends only on the row's key, never on partitioning or row order.
    """
    digest = F.md5(key_string(cols, salt))
    return F.conv(F.substring(digest, 1 + 8 * part, 8), 16, 10).cast("long")


def bucket1000(cols: Sequence[str | Column], salt: str = "") -> Column:
    """Per-mille bucket 0..999 of the row key (for fraction splits)."""
    return hash32(cols, salt) % F.lit(1000)


def safe_div(num: Column, den: Column) -> Column:
    """NULL instead of an error when the denominator is zero (ANSI mode)."""
    return F.try_divide(num, den)


def sq_err(label: Column, pred: Column) -> Column:
    d = label - pred
    return d * d


def abs_pct_err(label: Column, pred: Column) -> Column:
    return F.abs(label - pred) / F.greatest(F.abs(label), F.lit(MAPE_EPS))


def pearson(a: Column, b: Column) -> Column:
    """Pearson r that yields NULL (not an error) for a constant column.

    Aggregates skip rows where either side is NULL (pairwise complete)."""
    both = a.isNotNull() & b.isNotNull()
    aa = F.when(both, a)
    bb = F.when(both, b)
    return safe_div(F.covar_pop(aa, bb), F.stddev_pop(aa) * F.stddev_pop(bb))


def unit_interval(h32: Column) -> Column:
    """Map an unsigned 32-bit hash to [0, 1)."""
    return h32 / F.lit(4294967296.0)
