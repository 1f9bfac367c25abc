"""Column-expression helpers shared by the operators.

All helpers return JVM-side ``Column`` expressions, so they stay inside
whole-stage codegen and partial aggregation.
"""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zero_if_null(c: ColumnOrName) -> Column:
    return F.coalesce(col(c), F.lit(0.0))


def sum_of(cols: list[ColumnOrName], coalesce_nulls: bool = True) -> Column:
    """Row-wise sum; with ``coalesce_nulls`` a NULL term counts as 0."""
    terms = [zero_if_null(c) if coalesce_nulls else col(c) for c in cols]
    return reduce(add, terms)


def any_of(conds: list[Column]) -> Column:
    return reduce(or_, conds)


def guarded_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Daily ratio: ``num / den`` only where ``den > 0``, else NULL."""
    return F.when(col(den) > 0, col(num) / col(den))


def guarded_pct(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Daily share in percent: ``num / den * 100`` only where ``den > 0``."""
    return F.when(col(den) > 0, col(num) / col(den) * F.lit(100.0))


def ratio_of_sums(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Aggregate ``SUM(num) / NULLIF(SUM(den), 0)``.

    Never the mean of daily ratios: a day with a large census weighs more.
    """
    return F.sum(col(num)) / F.nullif(F.sum(col(den)), F.lit(0.0))


def pct_of_sums(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Aggregate ``100 * SUM(num) / NULLIF(SUM(den), 0)``."""
    return F.lit(100.0) * F.sum(col(num)) / F.nullif(F.sum(col(den)), F.lit(0.0))


def ratio_of_totals(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Ratio of two already-summed columns, NULL when the denominator is 0."""
    return col(num) / F.nullif(col(den), F.lit(0.0))


def pct_of_totals(num: ColumnOrName, den: ColumnOrName) -> Column:
    return F.lit(100.0) * col(num) / F.nullif(col(den), F.lit(0.0))


def safe_corr(x: ColumnOrName, y: ColumnOrName) -> Column:
    """Pearson correlation that yields NULL (not an error) on zero variance.

    ``corr`` raises DIVIDE_BY_ZERO under ANSI mode when one side is constant.
    Over the complete pairs, r = cov_pop(x, y) / (sd_pop(x) * sd_pop(y)); the
    standard deviations are restricted to the rows where both sides are set.
    All three are partial aggregates, so this is one pass with a map-side combine.
    """
    x, y = col(x), col(y)
    xp = F.when(y.isNotNull(), x)
    yp = F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(xp) * F.stddev_pop(yp))


def band(value: ColumnOrName, bands: list[tuple[float, str]], top_label: str) -> Column:
    """CASE WHEN v < b1 THEN l1 WHEN v < b2 THEN l2 ... ELSE top END.

    A NULL value falls through to the ELSE branch, as in the source query.
    """
    v = col(value)
    expr = None
    for bound, label in bands:
        cond = v < F.lit(bound)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(top_label)


def maybe_round(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits)
