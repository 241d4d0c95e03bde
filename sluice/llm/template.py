"""Main text of web pages by equivalence classes of template tokens.

A token is the start or end of a tag with its path, or a text node with its path.  Tokens of a host with
the same occurrence vector, that is, as often on each page as each other, form a class.  The
vectors are never written out: the sum over pages of count x H(page), modulo 2^64, is equal for
equal vectors, and Spark adds it up per host and token with partial sums on the map
side.  Copies of a page count once.  A class needs LEAST_PAGES pages and is valid if its tags come in rounds of
one order, the same on each page, and its rounds and those of other classes lie inside each
other or apart.  The tags of a class that is not valid are classes of their own.

A text node belongs to the template if its vector is that of a valid class of tags, or if it
fills the slot of its tag on LEAST_SHARE of that tag's pages.  In an article or main element this takes
ARTICLE_PAGES pages, as its text may be repeated for other reasons.  What the template leaves are
slots.  Those labelled by their elements as menus, headers, footers,
sidebars, notices, adverts, forms, comments, scripts and styles are dropped; the
others are the main text, those below an article or main element alone if there is one.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.batches import slices, stored

LEAST_PAGES = 3
ARTICLE_PAGES = 8
LEAST_SHARE = 0.5
TOKENS = 400_000
MAX_BROADCAST_BYTES = 32 << 20

# Element names of HTML.
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed", "noframes")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
CLOSED_BY_BLOCK = frozenset(["p"])
SIBLINGS = {"li": "li", "dt": "dd dt", "dd": "dd dt", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
DROPPED = frozenset(
    "nav header footer aside form script style noscript template iframe button select textarea menu dialog "
    "head title svg canvas object audio video fieldset input".split()
)
MAIN = frozenset(["article", "main"])
DROPPED_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert|adverts|advertisement|advertisements|adbox|banner|sponsor|sponsored|promo|sidebar|side-bar|"
    r"widget|nav|navbar|navigation|menu|breadcrumb|breadcrumbs|footer|header|masthead|cookie|cookies|consent|notice|notices|"
    r"notification|alert|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|share|sharing|social|related|"
    r"recommended|comment|comments|commentlist|reply|replies|respond|disqus|pagination|pager|toolbar|skip|form)(?=$|[\s_-])",
    re.I,
)
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split()
)
TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
BLANK = re.compile(r"\s+")


@dataclass
class Node:
    """An open element: its name, its path, and whether its text is dropped or main."""

    name: str
    path: str
    dropped: bool
    main: bool


def _is_dropped(name: str, attributes: str) -> bool:
    if name in DROPPED:
        return True
    if "=" not in attributes and "hidden" not in attributes:
        return False
    found = {m[1].lower(): next((g for g in m.groups()[1:] if g is not None), "") for m in ATTRIBUTE.finditer(attributes)}
    if name not in ("html", "body", "article", "main") and any(
        DROPPED_NAMES.search(found.get(a, "")) for a in ("class", "id")
    ):
        return True
    style = found.get("style", "").replace(" ", "").lower()
    return (
        found.get("role", "").lower() in DROPPED_ROLES or "hidden" in found
        or found.get("aria-hidden", "").lower() == "true" or "display:none" in style or "visibility:hidden" in style
    )


@dataclass(frozen=True)
class Block:
    """Text between two block tags, with the path of its element."""

    path: str
    text: str
    dropped: bool
    main: bool


def parse_page(page: str) -> tuple[list[str], list[Block]]:
    """The page's tag tokens and its blocks of text, in page order.

    A tag's start is its path, and its end the path after a "\\0"; the page itself has the empty path.
    """
    root = Node("", "", False, False)
    stack, tokens, blocks, held = [root], [""], [], []

    def flush() -> None:
        if held:
            text = BLANK.sub(" ", html.unescape("".join(held))).strip()
            held.clear()
            if text:
                top = stack[-1]
                holder = next((n for n in reversed(stack) if n.name not in INLINE), top)
                blocks.append(Block(holder.path, text, top.dropped, top.main))

    def pop(index: int) -> None:
        flush()
        tokens.extend(f"\0{n.path}" for n in reversed(stack[index:]) if n.name not in INLINE)
        del stack[index:]

    at = 0
    while True:
        found = TAG.search(page, at)
        if not found:
            held.append(page[at:])
            break
        held.append(page[at : found.start()])
        at = found.end()
        name = (found[2] or found[5] or "").lower()
        if not name:
            continue
        closing, attributes = found[1] or found[4], (found[3] if found[2] else found[6]) or ""
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == name:
                    if name in INLINE and not stack[i].dropped:
                        del stack[i]
                    elif name in INLINE and any(n.name not in INLINE for n in stack[i:]):
                        pass
                    else:
                        pop(i)
                    break
            else:
                if name not in INLINE:
                    flush()
            continue
        if name == "br":
            held.append(" ")
            continue
        inline = name in INLINE
        # The header of an article holds its headline.
        dropped = _is_dropped("div" if name == "header" and stack[-1].main else name, attributes)
        if not inline or dropped != stack[-1].dropped:
            flush()
        if not inline:
            names = SIBLINGS.get(name, "p" if name not in VOID else "").split()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name in names:
                    pop(i)
                    break
                if stack[i].name not in INLINE and stack[i].name not in ("tbody", "thead"):
                    break
        top = stack[-1]
        path = top.path if inline else f"{top.path}/{name}"
        if not inline:
            tokens.append(path)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}[\s/>]|\Z", re.I).search(page, at)
            at = end.start()
        if name not in VOID:
            stack.append(Node(name, path, top.dropped or dropped, top.main or name in MAIN))
            if name in RAW:
                stop = TAG.match(page, at)
                at = stop.end() if stop else len(page)
                pop(len(stack) - 1)
    pop(0)
    return tokens, blocks


def token_hash(path: str, text: str | None = None) -> int:
    """Hash of a tag token, or of a text node."""
    return xxhash.xxh3_64_intdigest(path if text is None else f"{path}\0{text}")


def main_text(page: str, template: frozenset[int]) -> str:
    """The blocks of the main slots, joined by two line breaks.

    ``template`` has the hashes of the host's template texts; what they leave are slots.
    """
    _, blocks = parse_page(page)
    kept = [b for b in blocks if not b.dropped]
    if any(b.main for b in kept):
        kept = [b for b in kept if b.main]
    if template:
        kept = [b for b in kept if token_hash(b.path, b.text) not in template]
    return "\n\n".join(b.text for b in kept)


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, np.uint64).astype(np.int64)


def page_tokens(pages: DataFrame) -> DataFrame:
    """``(host, page_key, tags, texts, holders, main)``: the tokens of the different pages of a host.

    ``tags`` are in page order; ``texts`` are text nodes not dropped by label, each with the tag that holds it and
    whether that is in an article.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[str, int] = {}
        for batch in slices(batches):
            columns: list[list] = [[] for _ in names[1:]]
            for page in batch.column("html").to_pylist():
                tags, blocks = parse_page(page or "")
                if len(numbers) >= TOKENS:
                    numbers.clear()
                for path in tags:
                    if path not in numbers:
                        numbers[path] = token_hash(path)
                own = _signed([numbers[path] for path in tags])
                blocks = [b for b in blocks if not b.dropped]
                texts = _signed([token_hash(b.path, b.text) for b in blocks])
                columns[0].append(xxhash.xxh3_64_intdigest(own.tobytes() + texts.tobytes()))
                columns[1].append(own)
                columns[2].append(texts)
                columns[3].append(_signed([numbers.get(b.path) or token_hash(b.path) for b in blocks]))
                columns[4].append([b.main for b in blocks])
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("host"), pa.array(_signed(columns[0])), *(pa.array(c, longs) for c in columns[1:4]),
                    pa.array(columns[4], pa.list_(pa.bool_())),
                ],
                names,
            )

    names = ["host", "page_key", "tags", "texts", "holders", "main"]
    schema = "host string, page_key long, tags array<long>, texts array<long>, holders array<long>, main array<boolean>"
    return pages.select("host", "html").mapInArrow(run, schema).dropDuplicates(["host", "page_key"])


def occurrence_vectors(tokens: DataFrame) -> DataFrame:
    """``(host, token, holder, main, vector, pages)``: for each token of a host the fingerprint of its vector.

    ``tokens`` is from ``page_tokens``.  ``holder`` is null for tags.  Tasks add up what they have seen of a host
    before they send it.
    """

    def out(found: dict[tuple[str, int], list]) -> Iterator[pa.RecordBatch]:
        keys, values = list(found), list(found.values())
        for i in range(0, len(keys), 50_000):
            own, sums = keys[i : i + 50_000], values[i : i + 50_000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([h for h, _ in own], pa.string()),
                    pa.array([t for _, t in own], pa.int64()),
                    pa.array([v[2] for v in sums], pa.int64()),
                    pa.array([v[3] for v in sums], pa.bool_()),
                    pa.array(np.array([v[0] & 0xFFFFFFFF for v in sums], np.int64)),
                    pa.array(np.array([v[0] >> 32 & 0xFFFFFFFF for v in sums], np.int64)),
                    pa.array(np.array([v[1] for v in sums], np.int64)),
                ],
                ["host", "token", "holder", "main", "low", "high", "pages"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list] = {}
        for batch in slices(batches):
            columns = (batch.column(c).to_pylist() for c in ("host", "page_key", "tags", "texts", "holders", "main"))
            for host, key, tags, texts, holders, main in zip(*columns, strict=True):
                kinds = dict(zip(texts, zip(holders, main, strict=True), strict=True))
                counts = Counter(tags)
                counts.update(texts)
                for token, times in counts.items():
                    entry = found.get((host, token))
                    if entry is None:
                        entry = found[host, token] = [0, 0, *kinds.get(token, (None, False))]
                    entry[0] += times * (key & 0xFFFFFFFFFFFFFFFF)
                    entry[1] += 1
            if len(found) >= TOKENS:
                yield from out(found)
                found = {}
        yield from out(found)

    rows = tokens.mapInArrow(
        run, "host string, token long, holder long, main boolean, low long, high long, pages long"
    )
    # Both halves stay below 2^63 for 2^31 partial sums, so that no sum overflows; their own
    # sum is taken modulo 2^64, as tasks may cut the pages in other ways.
    sums = rows.groupBy("host", "token").agg(
        F.min("holder").alias("holder"), F.max("main").alias("main"), F.sum("low").alias("low"),
        F.sum("high").alias("high"), F.sum("pages").alias("pages"),
    )
    carry = F.shiftrightunsigned("low", 32)
    mask = F.lit(0xFFFFFFFF)
    vector = F.shiftleft((F.col("high") + carry).bitwiseAND(mask), 32).bitwiseOR(F.col("low").bitwiseAND(mask))
    return sums.select("host", "token", "holder", "main", vector.alias("vector"), "pages")


def rounds(tags: list[int], classes: dict[int, int]) -> dict[int, tuple[int, bool]]:
    """For each class on a page the hash of its tags' order, and whether its rounds have that order and nest.

    ``classes`` gives the vector of each tag.
    """
    own: dict[int, list[int]] = {}
    for tag in tags:
        if tag in classes:
            own.setdefault(classes[tag], []).append(tag)
    order, good = {}, {}
    for vector, found in own.items():
        first = list(dict.fromkeys(found))
        order[vector] = first
        good[vector] = first * (len(found) // len(first)) == found
    size = {v: len(o) for v, o in order.items()}
    held: list[list[int]] = []
    open_rounds: set[int] = set()
    for tag in tags:
        vector = classes.get(tag)
        if vector is None or not good[vector]:
            continue
        if vector in open_rounds:
            # Rounds that began inside of this one and are not over cross it.
            while held[-1][0] != vector:
                crossing = held.pop()[0]
                open_rounds.discard(crossing)
                good[crossing] = False
            held[-1][1] += 1
        else:
            held.append([vector, 1])
            open_rounds.add(vector)
        if held[-1][1] == size[vector]:
            held.pop()
            open_rounds.discard(vector)
    return {
        v: (xxhash.xxh3_64_intdigest(np.array(order[v], np.int64).tobytes()) & 0x7FFFFFFFFFFFFFFF, good[v])
        for v in order
    }


def _with_host(rows: DataFrame, found: DataFrame, column: str) -> DataFrame:
    """``rows`` with the list of their host, broadcast if all have under MAX_BROADCAST_BYTES."""
    size = found.agg(F.coalesce(F.sum(F.size(column)), F.lit(0))).first()[0] * 8
    return rows.join(F.broadcast(found) if size < MAX_BROADCAST_BYTES else found, "host", "left")


def valid_classes(tokens: DataFrame, tags: DataFrame) -> DataFrame:
    """``(host, vector)`` of the classes of ``tags`` (host, token, vector) that are valid on all pages."""
    listed = tags.groupBy("host").agg(
        F.flatten(F.collect_list(F.array("token", "vector"))).alias("classes")
    )
    listed = stored(listed, "classes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict[int, int]] = {}
        found: dict[tuple[str, int], list] = {}
        for batch in slices(batches, 64):
            listed = batch.column("classes")
            columns = (batch.column(c).to_pylist() for c in ("host", "tags"))
            for i, (host, own) in enumerate(zip(*columns, strict=True)):
                if host not in known:
                    if len(known) >= 1000:
                        known.clear()
                    pairs = listed[i].as_py() or []
                    known[host] = dict(zip(pairs[::2], pairs[1::2], strict=True))
                for vector, (order, good) in rounds(own, known[host]).items():
                    entry = found.setdefault((host, vector), [order, order, True])
                    entry[:] = min(entry[0], order), max(entry[1], order), entry[2] and good
            if len(found) >= TOKENS:
                yield out(found)
                found = {}
        yield out(found)

    def out(found: dict[tuple[str, int], list]) -> pa.RecordBatch:
        arrays = [
            pa.array([h for h, _ in found], pa.string()), pa.array([v for _, v in found], pa.int64()),
            *(pa.array([e[i] for e in found.values()], pa.int64()) for i in range(2)),
            pa.array([e[2] for e in found.values()], pa.bool_()),
        ]
        return pa.RecordBatch.from_arrays(arrays, ["host", "vector", "least", "most", "good"])

    rows = _with_host(tokens.select("host", "tags"), listed, "classes").mapInArrow(
        run, "host string, vector long, least long, most long, good boolean"
    )
    checked = rows.groupBy("host", "vector").agg(
        (F.min("good") & (F.min("least") == F.max("most"))).alias("valid")
    )
    return checked.filter("valid").select("host", "vector")


def templates(pages: DataFrame) -> DataFrame:
    """``(host, tokens)``: the template texts of each host of ``pages`` (host, html)."""
    tokens = stored(page_tokens(pages), "page-tokens")
    vectors = stored(occurrence_vectors(tokens).filter(F.col("pages") >= LEAST_PAGES), "vectors")
    tags = vectors.filter("holder is null")
    texts = vectors.filter("holder is not null").filter(~F.col("main") | (F.col("pages") >= ARTICLE_PAGES))
    valid = valid_classes(tokens, tags.select("host", "token", "vector")).withColumn("valid", F.lit(True))
    held = tags.select("host", F.col("token").alias("holder"), F.col("pages").alias("held"))
    return (
        texts.join(valid, ["host", "vector"], "left").join(held, ["host", "holder"], "left")
        .filter(F.col("valid") | (F.col("pages") >= F.col("held") * LEAST_SHARE))
        .groupBy("host").agg(F.collect_list("token").alias("tokens"))
    )


def extract_pages(
    pages: DataFrame, *, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """``(page_id, url, text, n_chars)``: the main text of each page.

    A null or empty page has an empty text.  Pages with a null url share the empty host.
    Null ids and repeated rows stay as they are, an empty table gives no rows, and other columns are
    not looked at.  Templates are broadcast if they have under 32 MB, and joined by host else.
    """
    url = F.col(f"`{url_column}`")
    host = F.lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))
    narrow = pages.select(
        F.col(f"`{id_column}`").cast("long").alias("page_id"), url.alias("url"),
        F.col(f"`{html_column}`").alias("html"), host.alias("host"),
    )
    joined = _with_host(narrow, stored(templates(narrow), "templates"), "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, frozenset[int]] = {}
        for batch in slices(batches, 64):
            texts = []
            tokens = batch.column("tokens")
            for i, (host, page) in enumerate(
                zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True)
            ):
                if host not in known:
                    if len(known) >= 1000:
                        known.clear()
                    own = tokens[i].as_py() or []
                    known[host] = frozenset(t & 0xFFFFFFFFFFFFFFFF for t in own)
                texts.append(main_text(page or "", known[host]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    columns = joined.select("page_id", "url", "host", "html", "tokens")
    return columns.mapInArrow(run, "page_id long, url string, text string, n_chars long")
