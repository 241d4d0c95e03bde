"""HTML pages as arrays of elements, with regular expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.bind import bound

# What is not page content, a start tag with the text after it, and an attribute.
NOT_CONTENT = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
START_TAG = (
    r"<([a-zA-Z][a-zA-Z0-9]*)"
    r"""([^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*)>([^<]*)"""
)
ANY_TAG = r"""</?[a-zA-Z!](?:[^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*)>"""
ATTRIBUTE = r"""([a-zA-Z_:][-a-zA-Z0-9_:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?"""
QUOTES = r"""^["']|["']$"""

# The entities with a name that markup itself needs; & comes last.
ENTITIES = {
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&#39;": "'",
    "&nbsp;": " ",
    "&amp;": "&",
}


def content_of(html: Column) -> Column:
    """The page without scripts, styles and comments, which may hold tags as text."""
    return F.regexp_replace(html, NOT_CONTENT, "")


def decoded(text: Column) -> Column:
    """Text with the common entities replaced."""
    for entity, char in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def attributes(source: Column) -> Column:
    """The attributes of a start tag as a map; of a repeated attribute the last counts."""

    def pairs(text: Column) -> Column:
        names = F.transform(F.regexp_extract_all(text, F.lit(ATTRIBUTE), F.lit(1)), F.lower)
        values = F.transform(
            F.regexp_extract_all(text, F.lit(ATTRIBUTE), F.lit(2)),
            lambda v: decoded(F.regexp_replace(v, QUOTES, "")),
        )
        return F.arrays_zip(names.alias("name"), values.alias("value"))

    def last_of_each(found: Column) -> Column:
        kept = F.filter(
            found,
            lambda e, i: ~F.exists(
                F.slice(found, i + 2, F.size(found)), lambda other: other["name"] == e["name"]
            ),
        )
        return F.map_from_entries(kept)

    return bound(bound(source, pairs), last_of_each)


def elements_of(html: Column) -> Column:
    """Array of ``(tag, attrs, text)`` in page order.

    The text of an element is what stands between its start tag and the next tag,
    so an element that is never closed ends there too.
    """

    def parsed(content: Column) -> Column:
        starts = F.regexp_extract_all(content, F.lit(START_TAG), F.lit(0))
        return F.transform(
            starts,
            lambda start: F.struct(
                F.lower(F.regexp_extract(start, START_TAG, 1)).alias("tag"),
                attributes(F.regexp_extract(start, START_TAG, 2)).alias("attrs"),
                decoded(F.regexp_extract(start, START_TAG, 3)).alias("text"),
            ),
        )

    return bound(content_of(html), parsed)


def text_of(html: Column) -> Column:
    """The inner text of a page, tags replaced by a blank and blanks squeezed."""
    bare = F.regexp_replace(content_of(html), ANY_TAG, " ")
    return F.trim(F.regexp_replace(decoded(bare), r"\s+", " "))
