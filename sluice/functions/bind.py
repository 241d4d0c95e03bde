"""A local name inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often it is referred to.

    Without this, a value used inside a lambda is evaluated again for every
    element, and filters pushed through chained projections copy it over and over.
    """
    return F.transform(F.array(value), use)[0]


def to_explode(array: Column) -> Column:
    """``array`` for ``explode`` or ``posexplode``, which leave null and empty arrays out.

    Given a bare column, Spark first filters on its being filled, and such a filter, pushed down to the
    scan, makes a computed array twice more.
    """
    return F.concat(array)
