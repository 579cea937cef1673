"""Safe division, NULL-propagating least, and fixed-boundary banding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def div0(a: str | Column, b: str | Column) -> Column:
    """a / b as double, 0 when b is 0, NULL when either side is NULL."""
    a, b = _col(a), _col(b)
    return F.when(b.isNull() | a.isNull(), F.lit(None)).when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b)


def safe_div(a: str | Column, b: str | Column) -> Column:
    """a / nullif(b, 0) as double: NULL instead of an error when b is 0."""
    return _col(a).cast("double") / F.nullif(_col(b), F.lit(0))


def avg_exact(c: str | Column) -> Column:
    """Mean as the exact sum divided by the non-NULL count, in double.

    For decimal inputs Spark's ``avg`` rounds to a fixed scale first; dividing
    the exact decimal sum once avoids rounding twice when the result is rounded
    again for presentation. NULL when there is nothing to average."""
    x = _col(c)
    return F.sum(x).cast("double") / F.nullif(F.count(x), F.lit(0))


def least_strict(*cols: str | Column) -> Column:
    """least() that returns NULL when any input is NULL (Spark's least skips NULLs)."""
    cs = [_col(c) for c in cols]
    any_null = cs[0].isNull()
    for c in cs[1:]:
        any_null = any_null | c.isNull()
    return F.when(any_null, F.lit(None)).otherwise(F.least(*cs))


def band(c: str | Column, bounds: Sequence[tuple[float, str]], top_label: str,
         null_label: str | None = None, inclusive: bool = False) -> Column:
    """Fixed-boundary banding.

    ``bounds`` is ``[(upper, label), ...]`` in ascending order; a value lands in
    the first band whose upper bound it is below (``<``, or ``<=`` when
    ``inclusive``). Values above every bound get ``top_label``. With
    ``null_label`` a NULL gets its own band; without one a NULL falls through to
    ``top_label`` exactly like a SQL CASE whose conditions are all unknown.
    """
    x = _col(c)
    expr = None
    if null_label is not None:
        expr = F.when(x.isNull(), F.lit(null_label))
    for upper, label in bounds:
        cond = (x <= upper) if inclusive else (x < upper)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(top_label) if expr is None else expr.otherwise(F.lit(top_label))


def round_half_up(c: str | Column, places: int) -> Column:
    """Round to ``places`` half-up through DECIMAL(38,9), as double.

    Rounding a binary double directly decides exact ties (a mean of cents over
    8 or 24 rows) by representation noise; passing through a 9-place decimal
    first makes such ties exact and resolves them half-up."""
    x = _col(c)
    as_double = x.cast("double")
    special = F.isnan(as_double) | (F.abs(as_double) == F.lit(float("inf")))  # no decimal form: pass through
    return F.when(special, as_double).otherwise(F.round(x.cast("decimal(38,9)"), places).cast("double"))
