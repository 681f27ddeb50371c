"""Order-independent sums of DOUBLE amounts, without rounding any row.

A plain DOUBLE running sum depends on the order of additions (so on
partitioning and task retries) and loses cents once totals pass ~1e13.
Here each amount is cut exactly into a multiple of 1/1024 and a small rest,
``x = k / 1024 + r``.  The multiples are summed as BIGINT, in a high and a
low part so that neither can overflow in practice, and the rests, at most
1/2048 each, as DOUBLE: their rounding errors are below 1e-10 for a billion
rows.  All of it stays inside whole-stage codegen.  Amounts from 2**43 on,
NaN and infinities take part as a plain DOUBLE sum.

A sum is a struct of these partial sums, so it can be summed again after a
join (``sum_partials``) and is turned into ``ROUND(SUM(x), 2)``, half up on
the decimal total, only at the end (``amount``).  A group without a value
is NULL, as for SUM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNIT = 1024.0          # cuts are multiples of 1 / UNIT
LOW_BITS = 20          # of k in the low part
LIMIT = float(2 ** 43)  # k stays below 2**53, where doubles are exact
PARTS = ("high", "low", "rest", "other")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sum_parts(c: Column | str) -> Column:
    """First-level SUM of an amount, as a struct of partial sums."""
    x = _c(c).cast(T.DoubleType())
    regular = F.abs(x) < LIMIT  # NULL and false for NaN and infinities alike
    k = F.when(regular, F.rint(x * UNIT)).cast(T.LongType())
    return F.struct(
        F.sum(F.shiftright(k, LOW_BITS)).alias("high"),
        F.sum(k.bitwiseAND(F.lit((1 << LOW_BITS) - 1))).alias("low"),
        F.sum(F.when(regular, x - F.rint(x * UNIT) / UNIT)).alias("rest"),
        F.sum(F.when(~regular, x)).alias("other"))


def sum_partials(c: Column | str) -> Column:
    """SUM of structs made by ``sum_parts``."""
    return F.struct(*[F.sum(_c(c)[p]).alias(p) for p in PARTS])


def amount(c: Column | str, digits: int = 2) -> Column:
    """ROUND(SUM, digits) as DOUBLE of a struct of partial sums."""
    s = _c(c)
    whole = (s["high"].cast(T.DecimalType(19, 0)) * F.lit(2 ** LOW_BITS // int(UNIT)).cast(T.DecimalType(4, 0))
             + F.shiftright(s["low"], 10).cast(T.DecimalType(19, 0)))
    rest = s["low"].bitwiseAND(F.lit(int(UNIT) - 1)).cast(T.DoubleType()) / UNIT + s["rest"]
    exact = F.round(whole + rest.cast(T.DecimalType(30, 10)), digits).cast(T.DoubleType())
    return F.when(s["other"].isNull(), exact).otherwise(
        F.round(s["other"] + F.coalesce(exact, F.lit(0.0)), digits))


def exact_sum(c: Column | str) -> Column:
    """One-level ROUND(SUM(x), 2) of an amount."""
    return amount(sum_parts(c))
