"""Saved JSON and XML responses in a text column."""

from __future__ import annotations

from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.xml import node_lists

CORRUPT = "_corrupt_record"


def with_json(df: DataFrame, payload: str, schema: str, into: str = "record") -> DataFrame:
    """Add the parsed record and ``ok``; a payload that cannot be read gives null fields."""
    return _with_record(df, F.from_json(payload, f"{schema}, {CORRUPT} string"), payload, into)


def with_xml(df: DataFrame, payload: str, schema: str, into: str = "record") -> DataFrame:
    """The same for XML; repeated tags are arrays in the schema."""
    return _with_record(df, F.from_xml(payload, f"{schema}, {CORRUPT} string"), payload, into)


def _with_record(df: DataFrame, parsed: Column, payload: str, into: str) -> DataFrame:
    ok = F.col(payload).isNotNull() & F.col(into)[CORRUPT].isNull()
    return df.withColumn(into, parsed).withColumn("ok", F.coalesce(ok, F.lit(False)))


def node_texts(payload: Column, path: str) -> Column:
    """Inner texts of the nodes on a path, in document order; null where XML is malformed.

    There is one entry for each node: an empty node gives an empty text, and a node with
    nodes inside gives the texts of all of them, joined.  ``path`` is ``/a/b`` from the root, which
    built-in expressions read, or ``//b`` from anywhere, for which no schema can be stated and a function
    of Python reads each payload.
    """
    anywhere, steps = path.startswith("//"), path.lstrip("/")
    if not anywhere and "/" in steps:
        return node_lists(payload, {"texts": path})["texts"]

    @F.pandas_udf("array<string>")
    def texts(payloads: pd.Series) -> pd.Series:
        return payloads.map(lambda p: inner_texts(p, steps, anywhere), na_action="ignore")

    return texts(payload)


def inner_texts(payload: str, steps: str, anywhere: bool) -> list[str] | None:
    """What ``node_texts`` gives for one payload."""
    try:
        root = ElementTree.fromstring(payload)
    except (ElementTree.ParseError, ValueError):
        return None
    document = ElementTree.Element("document")
    document.append(root)
    found = document.findall(f"{'.//' if anywhere else './'}{steps}")
    return ["".join(node.itertext()) for node in found]


def zipped_nodes(
    df: DataFrame, values: str, times: str, keep: list[str], suffix: str = "!"
) -> DataFrame:
    """Parallel node arrays as rows ``(keep…, pos, value, time, marked)``.

    There are as many rows as values; a missing time is null.  ``marked`` is the
    time with ``suffix`` behind it.
    """
    marked = F.transform(F.col(times), lambda t: F.concat(t, F.lit(suffix)))
    zipped = F.arrays_zip(
        F.col(values).alias("value"), F.col(times).alias("time"), marked.alias("marked")
    )
    rows = df.select(
        *keep, F.posexplode(F.slice(zipped, 1, F.size(values))).alias("pos", "node")
    )
    return rows.select(*keep, "pos", "node.value", "node.time", "node.marked")


def rows_with_failures(
    df: DataFrame, values: str, times: str, keep: list[str], suffix: str = "!"
) -> DataFrame:
    """Like ``zipped_nodes``, with one row of nulls and ``error`` for each failed input."""
    marked = F.transform(F.col(times), lambda t: F.concat(t, F.lit(suffix)))
    zipped = F.slice(
        F.arrays_zip(
            F.col(values).alias("value"), F.col(times).alias("time"), marked.alias("marked")
        ),
        1,
        F.size(values),
    )
    failed = F.col(values).isNull()
    rows = df.withColumn("error", failed).withColumn("nodes", zipped)
    rows = rows.filter(failed | (F.size(values) > 0))
    return rows.select(*keep, "error", F.posexplode_outer("nodes").alias("pos", "node")).select(
        *keep, "pos", "node.value", "node.time", "node.marked", "error"
    )


def enriched(params: DataFrame, responses: DataFrame, key: str) -> DataFrame:
    """Each parameter with its saved responses; parameters without one stay."""
    return params.join(responses, key, "left")
