"""Null and sentinel logic as Catalyst expressions.

Pandas semantics to keep: ``isin`` on a missing value is False, so a NULL
counts as *usable*; ``between`` on NULL is False. Spark's ``IN``/``BETWEEN``
give NULL instead, hence the explicit ``coalesce``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_sentinel(c: str | Column, sentinels: Iterable[int]) -> Column:
    """True when the value is a sentinel code; False for NULL (never NULL)."""
    return F.coalesce(_c(c).isin(list(sentinels)), F.lit(False))


def is_usable(c: str | Column, sentinels: Iterable[int]) -> Column:
    """Not a sentinel; NULL counts as usable, as in the pandas pipeline."""
    return ~is_sentinel(c, sentinels)


def in_domain(c: str | Column, lower, upper) -> Column:
    """Inclusive domain test; False for NULL."""
    return F.coalesce(_c(c).between(lower, upper), F.lit(False))


def sentinel_null(c: str | Column, sentinels: Iterable[int]) -> Column:
    """``prj_sentinel_null``: sentinel -> NULL."""
    return F.when(is_usable(c, sentinels), _c(c))


def domain_null(c: str | Column, lower, upper) -> Column:
    """``prj_domain_null``: outside [lower, upper] -> NULL."""
    return F.when(in_domain(c, lower, upper), _c(c))


def positive_or_null(c: str | Column) -> Column:
    """``prj_positive_or_null``: keep a code only when > 0."""
    return F.when(_c(c) > 0, _c(c))


def any_not_null(cols: Iterable[str | Column]) -> Column:
    """``flt_any_notnull``: at least one non-null value among ``cols``."""
    # OR of isNotNull: coalesce would coerce mixed string/number columns.
    out = None
    for c in cols:
        t = _c(c).isNotNull()
        out = t if out is None else (out | t)
    return out


def fail_if(cond: Column, message: str, value: Column) -> Column:
    """Fail-fast inside the same job: raise when ``cond`` holds on a row,
    otherwise pass ``value`` through. No extra pass over the data."""
    return F.when(F.coalesce(cond, F.lit(False)), F.raise_error(F.lit(message))).otherwise(value)
