"""Sums of doubles that do not depend on the order of the rows.

A double is cut into two integers: ``hi`` counts units of ``2**-20``, ``lo`` what
is left in units of ``2**-54`` (rounded). Integer sums are the same in whatever
order partitions, retries or merges deliver the rows; the double made of the two
sums at the end is therefore the same too. Values may add up to about ``2**42``,
and one group may hold ``2**29`` values; beyond that Spark's integer sum raises
an error rather than wrapping (ANSI mode, the default).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HI_BITS, LO_BITS = 20, 54


def limbs_sql(value: str) -> tuple[str, str]:
    """SQL of the two integers of the double expression ``value``."""
    hi = f"floor(({value}) * {float(1 << HI_BITS)!r}D)"
    rest = f"(({value}) - {hi} * {2.0**-HI_BITS!r}D)"
    return hi, f"CAST(rint({rest} * {float(1 << LO_BITS)!r}D) AS BIGINT)"


def total_sql(hi: str, lo: str) -> str:
    """SQL of the double that the summed integers stand for."""
    return f"(CAST({hi} AS DOUBLE) * {2.0**-HI_BITS!r}D + CAST({lo} AS DOUBLE) * {2.0**-LO_BITS!r}D)"


def order_free_sum(value: str) -> Column:
    """Aggregate: the order-free sum of the double expression ``value`` (null
    without values)."""
    hi, lo = limbs_sql(value)
    return F.expr(total_sql(f"sum({hi})", f"sum({lo})"))
