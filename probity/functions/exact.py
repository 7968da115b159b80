"""Sums and means that do not depend on the order of the rows.

A double ``avg`` adds in task order, so its last bits change with the
partitioning.  These add decimals (exact) and divide once; the oracle SQL is
written the same way (``plans.catalog.exact_sql``).
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = "decimal(28,10)"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def total(c: Column | str) -> Column:
    """Exact sum as a double (null without a value)."""
    return F.sum(_c(c).cast(SCALE)).cast("double")


def mean(c: Column | str) -> Column:
    """Exact sum over the number of values (null without a value)."""
    return total(c) / F.nullif(F.count(_c(c)), F.lit(0))
