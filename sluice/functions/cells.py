"""Typing of text cells."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a whole number and as any number.
WHOLE_NUMBER = r"^\s*[+-]?\d+\s*$"
ANY_NUMBER = r"(?i)^\s*[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|inf(inity)?|nan)\s*$"


def null_markers(cell: Column, markers: Iterable[str] = ()) -> Column:
    """Cells that spell a missing value (``NA``, ``null`` …) become null."""
    markers = list(markers)
    return F.when(~cell.isin(markers), cell) if markers else cell


def empty_as_null(cell: Column) -> Column:
    """The empty string becomes null."""
    return F.nullif(cell, F.lit(""))


def is_whole(cell: Column) -> Column:
    # nineteen digits can pass the range of a long
    return cell.rlike(WHOLE_NUMBER) & F.trim(cell).try_cast("long").isNotNull()


def is_number(cell: Column) -> Column:
    return cell.rlike(ANY_NUMBER)


def cell_number(cell: Column) -> Column:
    """The cell as a double, or null where it is not a number.

    The pattern is checked first because a plain cast also takes ``1d`` and ``1f``.
    """
    return F.when(is_number(cell), F.trim(cell).try_cast("double"))


def cell_kind(cell: Column, whole_numbers: bool = True) -> Column:
    """``long``, ``double`` or ``string`` for one cell; null stays null."""
    kind = F.when(cell.isNull(), F.lit(None).cast("string"))
    if whole_numbers:
        kind = kind.when(is_whole(cell), F.lit("long"))
    return kind.when(is_number(cell), F.lit("double")).otherwise(F.lit("string"))
