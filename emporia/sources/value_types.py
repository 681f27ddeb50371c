"""Types of text columns, folded over their values in one pass.

Every value has a narrowest type; types join upwards::

    int < bigint < decimal < double      date < timestamp      boolean

and any other mixture is text.  What a column needs is therefore a handful of
counts, which add up over any partitioning: they are observed while the texts
are written, and no pass over the files is made for types alone.  Nulls and
empty texts have no type.  The types are those Spark's CSV schema inference
gives, but for mixtures where its answer depends on the order of the rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGER = r"^[+-]?[0-9]+$"
_WHOLE = r"^[+-]?[0-9]+[.]?$"
_NUMBER = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?[fFdD]?\s*$"
_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_NAMED = ("NaN", "Inf", "-Inf", "Infinity", "-Infinity", "+Infinity")
KINDS = ("values", "ints", "longs", "wholes", "numbers", "days", "times", "flags", "digits")


def _double(text: Column) -> Column:
    return F.regexp_replace(F.trim(text), "(?<=[0-9.])[fFdD]$", "").try_cast("double")


def counts(column: str, prefix: str) -> list[Column]:
    """Aggregates, named ``prefix`` and a kind, that tell a text column's type."""
    text = F.nullif(F.col(f"`{column}`"), F.lit(""))
    whole = text.rlike(_WHOLE) & F.regexp_replace(text, "[.]$", "").try_cast("decimal(38,0)").isNotNull()
    found = {
        "values": text.isNotNull(),
        "ints": text.rlike(_INTEGER) & text.try_cast("int").isNotNull(),
        "longs": text.rlike(_INTEGER) & text.try_cast("long").isNotNull(),
        "wholes": whole,
        "numbers": text.rlike(_NUMBER) | text.isin(*_NAMED),
        "days": text.rlike(_DAY) & text.try_cast("date").isNotNull(),
        "times": ~text.rlike(_NUMBER) & text.try_cast("timestamp").isNotNull(),
        "flags": F.lower(text).isin("true", "false"),
    }
    digits = F.max(F.when(whole, F.length(F.regexp_replace(text, "^[+-]?0*|[.]$", ""))))
    return [F.count_if(c).alias(prefix + k) for k, c in found.items()] + [
        F.coalesce(digits, F.lit(0)).alias(prefix + "digits")]


def joined(a: Mapping[str, int], b: Mapping[str, int]) -> dict[str, int]:
    """What two parts of a column tell together."""
    return {k: max(a[k], b[k]) if k == "digits" else a[k] + b[k] for k in KINDS}


def type_of(told: Mapping[str, int]) -> T.DataType:
    """The narrowest type that holds all values counted."""
    n = told["values"]
    if not n:
        return T.StringType()
    if told["ints"] == n:
        return T.IntegerType()
    if told["longs"] == n:
        return T.LongType()
    if told["wholes"] == n:
        return T.DecimalType(max(told["digits"], 20 if told["longs"] else 1), 0)
    for kind, type_ in (("numbers", T.DoubleType()), ("days", T.DateType()), ("times", T.TimestampType()),
                        ("flags", T.BooleanType())):
        if told[kind] == n:
            return type_
    return T.StringType()


def cast(column: str, kind: T.DataType) -> Column:
    """A text column in the type found for it; empty texts become null."""
    if isinstance(kind, T.StringType):
        return F.col(f"`{column}`")
    text = F.nullif(F.col(f"`{column}`"), F.lit(""))
    if isinstance(kind, T.DoubleType):
        return _double(text)
    if isinstance(kind, T.DecimalType):
        return F.regexp_replace(text, "[.]$", "").try_cast(kind)
    return text.try_cast(kind)
