from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    """Accept a Column or a column name."""
    return c if isinstance(c, Column) else F.col(c)


def lit_array(values) -> Column:
    """A literal ``array<string>`` (empty arrays keep the string type)."""
    if not values:
        return F.array().cast("array<string>")
    return F.array(*[F.lit(v) for v in values])


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    Spark does not de-duplicate sub-expressions that contain higher-order
    functions (or anything inside a lambda), so an expensive value used
    several times is bound through a one-element ``transform`` instead.
    """
    return F.transform(F.array(value), lambda x: body(x))[0]
