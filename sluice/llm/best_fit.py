"""Packs documents into token sequences by best-fit decreasing over a histogram of lengths.

Only the shorter first piece of a document leaves room in a sequence, and there are no
more different lengths than a sequence has places.  So the plan is made on the number of pieces of
each length, a table of bounded size whatever the corpus: best-fit decreasing places pieces
of one length at a time in runs of equally full sequences.  A segment tree over
the remaining capacities finds the tightest capacity that has an open run.  The plan is exactly
that of placing pieces one by one.  Spark numbers the pieces of each length, and each
piece looks up the run, sequence and offset of its number.
"""

from __future__ import annotations

import base64
import itertools
import re
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sluice.llm.batches import scan_partitions, slices, stored

CAPACITY = 2048
END_ID = 0
CACHED_WORDS = 300_000
LONGEST_CACHED = 40
SAFE_BLANK = re.compile(r"(?<=\S) (?=\S)")
GROUPS_PER_PARTITION = 8


def load_encoding(path: str) -> tiktoken.Encoding:
    """The byte-level BPE whose ranks lie in a tiktoken file."""
    with open(path) as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(str.split, lines)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


class Memo(dict):
    """Computed values of a bounded number of keys; what was used of late is kept longest."""

    def __init__(self, make: Callable[[str], bytes], size: int = CACHED_WORDS) -> None:
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > LONGEST_CACHED:
                return value
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class WordEncoder:
    """Encodes texts by their words, remembering the ids of a bounded number of words.

    White space all of which is single blanks and line breaks between words always begins a
    new token, and a stop or comma ends the letters before it.  So the ids of the
    parts are those of the whole text.
    """

    def __init__(self, path: str) -> None:
        self.encoding = load_encoding(path)
        self.bare = Memo(self._ids)
        self.after_blank = Memo(self._after_blank)
        self.line_end = self._ids("\n")

    def _ids(self, part: str) -> bytes:
        return array("I", self.encoding.encode_ordinary(part)).tobytes()

    def _after_blank(self, part: str) -> bytes:
        if part[-1] in ".," and part[-2:-1].isalpha():
            return self.after_blank[part[:-1]] + self.bare[part[-1]]
        return self._ids(" " + part)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        words = text.split()
        between = text.count(" ") + text.count("\n")
        if between != len(words) - 1 or sum(map(len, words)) + between != len(text):
            firsts = itertools.chain([True], itertools.repeat(False))
            return b"".join(map(self._odd, SAFE_BLANK.split(text), firsts))
        lines = []
        for line in text.split("\n"):
            first, *parts = line.split(" ")
            lines.append(self.bare[first] + b"".join(map(self.after_blank.__getitem__, parts)))
        return self.line_end.join(lines)

    def _odd(self, part: str, first: bool) -> bytes:
        """The ids of a part that may hold runs of white space."""
        return self._ids(part if first else " " + part)


def _pieces(ids: bytes, capacity: int) -> list[tuple[int, bytes]]:
    """(start, ids) of each piece; all but the first are full."""
    n = len(ids) // 4
    first = n % capacity or min(n, capacity)
    starts = [0, *range(first, n, capacity)]
    return [(a, ids[4 * a : 4 * b]) for a, b in zip(starts, [*starts[1:], n], strict=True)]


def token_pieces(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokenizer_path: str | None = None,
    end_id: int = END_ID,
    capacity: int = CAPACITY,
    with_ids: bool = True,
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids])``: the pieces of each document's ids.

    A document is the ids of its text and ``end_id``; ids are little-endian unsigned 32-bit numbers.
    A null text is an empty one: its piece holds the end alone.  A null id stays null, and
    repeated rows each give their pieces.
    """
    path = tokenizer_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 6 if with_ids else 5]
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(path)
        for batch in slices(batches):
            rows = [
                (doc, i, start, len(ids) // 4, zlib.crc32(ids), ids)
                for doc, text in zip(
                    batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True
                )
                for i, (start, ids) in enumerate(_pieces(encoder.encode(text or "") + end, capacity))
            ]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)][: len(names)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    narrow = docs.selectExpr(f"cast(`{id_column}` as long) as doc_id", f"`{text_column}` as text")
    return narrow.mapInArrow(run, schema)


class CapacityTree:
    """Segment tree over capacities 0 … n with the number of open runs of each."""

    def __init__(self, n: int) -> None:
        self.leaves = 1 << n.bit_length()
        self.counts = [0] * (2 * self.leaves)

    def add(self, capacity: int, change: int) -> None:
        node = capacity + self.leaves
        while node:
            self.counts[node] += change
            node >>= 1

    def tightest(self, least: int) -> int | None:
        """The smallest capacity of ``least`` or more that has a run."""
        node = least + self.leaves
        if self.counts[node]:
            return least
        while node > 1:
            if node % 2 == 0 and self.counts[node + 1]:
                node += 1
                break
            node >>= 1
        else:
            return None
        while node < self.leaves:
            node = 2 * node if self.counts[2 * node] else 2 * node + 1
        return node - self.leaves


@dataclass
class Plan:
    """For each length: first numbers, and (sequence, pieces a sequence, offset) of their runs."""

    length: dict[int, tuple[list[int], list[tuple[int, int, int]]]] = field(default_factory=dict)
    sequences: int = 0

    def find(self, length: int, number: int) -> tuple[int, int]:
        """Sequence and offset of a piece, by its number among those of its length."""
        firsts, runs = self.length[length]
        i = bisect_right(firsts, number) - 1
        sequence, each, offset = runs[i]
        k = number - firsts[i]
        return sequence + k // each, offset + k % each * length


def best_fit_plan(histogram: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing of ``histogram`` (length: pieces) into sequences of ``capacity``.

    A piece goes to the fullest open sequence that it fits.  As it leaves that the fullest, the next
    piece of this length follows it while there is room: a run of k sequences with room
    for q pieces each takes k q pieces at once.
    """
    tree, open_runs, plan = CapacityTree(capacity), [[] for _ in range(capacity + 1)], Plan()

    def put(room: int, first: int, count: int) -> None:
        if room and count:
            open_runs[room].append((first, count))
            tree.add(room, 1)

    for length in sorted(histogram, reverse=True):
        left, firsts, runs = histogram[length], [], []
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first, count = capacity, plan.sequences, -(-left // (capacity // length))
                plan.sequences += count
            else:
                first, count = open_runs[room].pop()
                tree.add(room, -1)
            each = room // length
            full = min(count, left // each)
            taken = histogram[length] - left
            if full:
                firsts.append(taken)
                runs.append((first, each, capacity - room))
                put(room - each * length, first, full)
                left -= full * each
            if full < count:
                if left:
                    firsts.append(histogram[length] - left)
                    runs.append((first + full, each, capacity - room))
                    put(room - left * length, first + full, 1)
                    full, left = full + 1, 0
                put(room, first + full, count - full)
        plan.length[length] = (firsts, runs)
    return plan


def numbered(pieces: DataFrame, groups: int) -> DataFrame:
    """Pieces with ``number`` from 0 among those of their length.

    Pieces are dealt to groups by a hash; each group numbers its own, and the groups of a
    length start where the ones before them end.  The table of starts has ``groups`` rows for a length.
    """
    dealt = pieces.withColumn(
        "group", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(groups)).cast("int")
    )
    sizes = dealt.groupBy("length", "group").count()
    before = Window.partitionBy("length").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "group", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("group", "length").orderBy("doc_id", "piece", "ids_crc32")
    ranked = dealt.withColumn("number", F.row_number().over(own) - 1)
    return (
        ranked.join(starts, ["length", "group"])
        .withColumn("number", F.col("number") + F.col("before"))
        .drop("before", "group")
    )


def place(pieces: DataFrame, *, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ids_crc32) with ``sequence_id`` and ``offset``.

    Sequences are numbered from 0, and each is filled from 0 without gaps.  Pieces of equal
    length are interchangeable; which of them comes where follows from their ids and not from the
    order of rows.  An empty table gives no rows.
    """
    pieces = stored(pieces, "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan = pieces.sparkSession.sparkContext.broadcast(best_fit_plan(histogram, capacity))
    names = [*pieces.columns, "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 10_000):
            places = [
                plan.value.find(n, k)
                for n, k in zip(
                    batch.column("length").to_pylist(), batch.column("number").to_pylist(), strict=True
                )
            ]
            added = [pa.array([p[i] for p in places], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.drop_columns(["number"]).columns, *added], names)

    rows = numbered(pieces, GROUPS_PER_PARTITION * scan_partitions(pieces))
    added = [StructField("sequence_id", LongType()), StructField("offset", LongType())]
    return rows.select(*pieces.columns, "number").mapInArrow(run, StructType([*pieces.schema.fields, *added]))


def pack_documents(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokenizer_path: str | None = None,
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """Tokenise and pack: a row per piece with its place, on request with its ids.

    Null and empty texts are one piece, the end token alone; long ones are cut in pieces.  Null ids stay null and repeated rows
    each have pieces of their own.  An empty table gives no rows, and other columns are not looked at.
    """
    pieces = token_pieces(
        docs, id_column=id_column, text_column=text_column, tokenizer_path=tokenizer_path,
        capacity=capacity, with_ids=with_ids,
    )
    return place(pieces, capacity=capacity)
