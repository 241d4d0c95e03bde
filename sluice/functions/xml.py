"""Inner texts of the nodes of XML columns, with built-in expressions only.

``from_xml`` gives an entry for each node, and for a node with nodes inside its markup as text, from which tags are
cut.  References are kept from it: their ampersands are a private-use character until tags are gone.  What a CDATA
section holds is written with references first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.bind import bound
from sluice.functions.html import ANY_TAG

# The private-use character and the references that XML itself knows.
MARK = "\ue000"
NAMED = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "amp": "&"}
REFERENCE = MARK + r"(?:lt|gt|quot|apos|amp|#[0-9]{1,7}|#x[0-9a-fA-F]{1,6});"
NUMBERED = MARK + r"#(x?[0-9a-fA-F]+);"
ASIDE = r"(?s)<!--.*?-->|<\?.*?\?>"
ROOT = r"(?s)^\s*(?:<!DOCTYPE[^>\[]*(?:\[.*?\])?\s*>\s*)?<([^\s/>]+)"
CORRUPT = "_corrupt_record"

Tree = dict[str, "Tree"]


def _written_out(text: Column) -> Column:
    """What CDATA holds, with references instead of markup."""
    for char, name in (("&", "amp"), ("<", "lt"), (">", "gt")):
        text = F.replace(text, F.lit(char), F.lit(f"{MARK}{name};"))
    return text


def protected(payload: Column) -> Column:
    """The payload without CDATA sections and with marks for ampersands."""
    clear = F.replace(payload, F.lit(MARK), F.lit(f"&#{ord(MARK)};"))

    def section(part: Column) -> Column:
        inside = F.substring_index(part, "]]>", 1)
        after = F.substring(part, F.length(inside) + 4, F.length(part))
        whole = F.contains(part, F.lit("]]>"))
        return F.when(whole, F.concat(_written_out(inside), after)).otherwise(F.concat(F.lit("<![CDATA["), part))

    def joined(parts: Column) -> Column:
        later = F.transform(F.slice(parts, 2, F.size(parts)), section)
        return F.concat(parts[0], F.array_join(later, ""))

    return F.replace(bound(F.split(clear, r"<!\[CDATA\["), joined), F.lit("&"), F.lit(MARK))


def inner_text(markup: Column) -> Column:
    """The text of protected markup: no tags, references decoded."""

    def numbered(text: Column) -> Column:
        def one(done: Column, reference: Column) -> Column:
            digits = F.regexp_extract(reference, NUMBERED, 1)
            number = F.when(F.startswith(digits, F.lit("x")), F.substring(digits, 2, 8)).otherwise(F.conv(digits, 10, 16))
            char = F.decode(F.unhex(F.lpad(number, 8, "0")), "UTF-32")
            return F.replace(done, reference, char)

        found = F.array_distinct(F.regexp_extract_all(text, F.lit(NUMBERED), F.lit(0)))
        return F.when(F.contains(text, F.lit(MARK + "#")), F.aggregate(found, text, one)).otherwise(text)

    # Tags come first, as references may stand for what looks like one; numbers come last, as they may stand for the mark.
    bare = F.regexp_replace(markup, ANY_TAG, "")
    named = reduce(lambda t, pair: F.replace(t, F.lit(f"{MARK}{pair[0]};"), F.lit(pair[1])), NAMED.items(), bare)
    return bound(named, numbered)


def _fields(tree: Tree) -> list[str]:
    return [f"`{name}`: array<{'struct<' + ', '.join(_fields(sub)) + '>' if sub else 'string'}>" for name, sub in tree.items()]


def _tree(paths: list[list[str]]) -> Tree:
    out: Tree = {}
    for path in paths:
        at = out
        for step in path:
            at = at.setdefault(step, {})
    return out


def _values(record: Column, steps: list[str]) -> Column:
    """The markup of all nodes at the end of the steps."""
    here = F.coalesce(record[steps[0]], F.array())
    if len(steps) == 1:
        return here
    return F.flatten(F.transform(here, lambda node: _values(node, steps[1:])))


def node_lists(payload: Column, paths: dict[str, str]) -> Column:
    """A struct with the inner texts of the nodes on each path, in document order; null fields where XML is malformed.

    Paths go from one root on, as ``/root/a/b``, and none may go on where another ends.  There is one entry for
    each node: an empty one gives an empty text, one with nodes inside the texts of all of them, joined.  A payload with
    another root gives empty arrays.  Entities that a document type declares are not known, and below the root
    upper and lower case are one unless ``spark.sql.caseSensitive`` is set, as in all columns.
    """
    steps = {name: path.strip("/").split("/") for name, path in paths.items()}
    roots = {s[0] for s in steps.values()}
    below = [s[1:] for s in steps.values()]
    if len(roots) != 1 or any(len(s) < 2 for s in steps.values()):
        raise ValueError("paths start at one root and go below it")
    if any(a != b and b[: len(a)] == a for a in below for b in below):
        raise ValueError("a path goes on where another ends")
    root = roots.pop()
    schema = ", ".join(f.replace("`: ", "` ", 1) for f in _fields(_tree(below)))
    schema += f", {CORRUPT} string"

    def parsed(clear: Column) -> Column:
        bare = F.trim(F.regexp_replace(clear, ASIDE, ""))
        closed = F.rlike(bare, F.concat(F.lit(r"(?s)(?:</"), F.lit(root), F.lit(r"|^<[^>]*/)\s*>\s*$")))
        known = ~F.contains(F.regexp_replace(bare, REFERENCE, ""), F.lit(MARK))
        named = F.regexp_extract(bare, ROOT, 1) == root
        record = F.from_xml(clear, schema, {"ignoreSurroundingSpaces": "false"})

        def lists(read: Column) -> Column:
            ok = read[CORRUPT].isNull() & known & (closed | ~named)
            return F.struct(
                *[
                    F.when(ok & named, F.transform(_values(read, s[1:]), inner_text))
                    .when(ok, F.array().cast("array<string>")).alias(name)
                    for name, s in steps.items()
                ]
            )

        return bound(record, lists)

    return F.when(payload.isNotNull() & (F.trim(payload) != ""), bound(protected(payload), parsed))
