"""HTML pages as an element table, and the usual ways to pick elements from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.html import elements_of


def page_elements(pages: DataFrame, id_col: str = "page_id", html: str = "html") -> DataFrame:
    """One row per element: ``(id, pos, tag, attrs, text)``."""
    found = pages.select(id_col, F.posexplode(elements_of(F.col(html))).alias("pos", "e"))
    return found.select(id_col, "pos", "e.tag", "e.attrs", "e.text")


def has_class(name: str) -> Column:
    return F.array_contains(F.split(F.col("attrs")["class"], r"\s+"), name)


def select_elements(
    elements: DataFrame,
    tag: str | None = None,
    css_class: str | None = None,
    attribute: str | None = None,
    value: str | None = None,
) -> DataFrame:
    """Elements that meet every condition given, like ``tag.class[attribute=value]``."""
    if tag:
        elements = elements.filter(F.col("tag") == tag)
    if css_class:
        elements = elements.filter(has_class(css_class))
    if attribute:
        held = F.col("attrs")[attribute]
        elements = elements.filter(held.isNotNull() if value is None else held == value)
    return elements


def first_elements(elements: DataFrame, id_col: str = "page_id", **conditions: str) -> DataFrame:
    """The first element of each page that meets the conditions: ``(id, pos, text)``."""
    found = select_elements(elements, **conditions)
    first = F.min(F.struct("pos", "text"))
    return found.groupBy(id_col).agg(first.alias("e")).select(id_col, "e.pos", "e.text")


def attribute_values(
    elements: DataFrame, wanted: str, id_col: str = "page_id", **conditions: str
) -> DataFrame:
    """The value of one attribute of the elements that meet the conditions."""
    found = select_elements(elements, **conditions)
    return found.select(id_col, "pos", F.col("attrs")[wanted].alias("value")).filter(
        F.col("value").isNotNull()
    )
