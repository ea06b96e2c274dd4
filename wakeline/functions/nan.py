"""NaN-aware comparisons.

Spark orders NaN above every number (``NaN > 127`` is true), while the original
Python checks treat every comparison with NaN as false.  These helpers give the
Python behaviour: a NaN operand makes the comparison false.  Each references its
operand once (``nanvl``), which keeps generated code small when the operand is
a large parse expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NEG_INF = float("-inf")
_POS_INF = float("inf")


def gt(x: Column, c) -> Column:
    return F.nanvl(x, F.lit(_NEG_INF)) > c


def ge(x: Column, c) -> Column:
    return F.nanvl(x, F.lit(_NEG_INF)) >= c


def lt(x: Column, c) -> Column:
    return F.nanvl(x, F.lit(_POS_INF)) < c


def le(x: Column, c) -> Column:
    return F.nanvl(x, F.lit(_POS_INF)) <= c


def in_closed(x: Column, lo, hi) -> Column:
    """lo <= x <= hi, false for NaN and null (a stored-row range match)."""
    return F.coalesce(F.nanvl(x, F.lit(None).cast("double")).between(lo, hi), F.lit(False))
