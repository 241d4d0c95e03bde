"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

A count c is kept as level 1 + floor(log_b c), and the filter holds the pairs
(n-gram, 1) … (n-gram, level): probing levels upwards until one is missing gives the
count to within a factor of b.  The filter is cut into segments by hash.  Each is built
where Spark has gathered its n-grams, and whole segments are broadcast to the workers,
as many at a time as stay under a fixed size; further segments take further passes
over the texts, each of which adds what its n-grams change.

P(w | h) = (c(hw) + m P(w)) / (c(h) + m) with P(w) = (c(w) + 1) / (N + V + 1).
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from sluice.llm.batches import scan_partitions, stored
from sluice.llm.words import Words, chunks, hashes

END = b"\n"  # no word holds a blank, so this cannot be one
BITS_PER_ENTRY, HASHES = 10, 7
LEVEL_BASE = 1.5
MAX_LEVEL = 200
FOLDS, HELD_OUT = 7, 2
CHUNK_BYTES = 16 << 20
SCORED_BYTES = 4 << 20
HOT_WORDS = 100_000
SEGMENTS_PER_PARTITION = 4
PASS_BYTES = 128 << 20
MASS = 8.0


class Tokens:
    """The tokens of many texts: words with A-Z lowered, and one end token after each text."""

    def __init__(self, texts: pa.Array) -> None:
        words = Words(texts)
        dictionary = words.dictionary.cast(pa.large_binary())
        self.dictionary = pa.concat_arrays([dictionary, pa.array([END], pa.large_binary())])
        self.sizes = np.bincount(words.text, minlength=len(texts)) + 1
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.ids = np.full(int(self.sizes.sum()), len(dictionary), np.int64)
        inside = np.ones(len(self.ids), bool)
        inside[self.starts + self.sizes - 1] = False
        self.ids[inside] = words.ids
        # Places of all tokens but the first of each text.
        follows = np.ones(len(self.ids), bool)
        follows[self.starts] = False
        self.follows = np.flatnonzero(follows)
        self.hashes = hashes(self.dictionary)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers; a bijection."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Keys of word pairs from the hashes of their words."""
    return _mixed(left * np.uint64(3) + _mixed(right))


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order that sorts ``keys``, where each distinct one starts in it, and the distinct ones."""
    order = np.argsort(keys)
    ordered = keys[order]
    starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[: len(keys)])
    return order, starts, ordered[starts]


@dataclass(frozen=True)
class Segments:
    """Some segments of a filter of ``total`` ones: their bits, one after another."""

    total: int
    first: bool
    empty: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    words: bytes

    def holds(self, segment: np.ndarray) -> np.ndarray:
        return self.sizes[segment] > 0

    def covers(self, segment: np.ndarray) -> np.ndarray:
        """Segments that this pass answers for: its own, on the first also those without n-grams."""
        return self.holds(segment) | (self.empty[segment] if self.first else False)

    def levels(self, keys: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """The level of each key; 0 where it is unknown or its segment is not here."""
        out = np.zeros(len(keys), np.int32)
        bits = np.frombuffer(self.words, np.uint8)
        left = np.flatnonzero(self.holds(segment))
        for level in range(1, MAX_LEVEL + 1):
            if not left.size:
                break
            a, b = hash_pair(keys[left], level)
            for i in range(HASHES):
                where = segment[left]
                at = self.starts[where] + place_of(a, b, i, self.sizes[where])
                hit = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
                left, a, b = left[hit], a[hit], b[hit]
            out[left] = level
        return out

    def counts(self, keys: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """Counts as the filter tells them: the middle of their level's range, 0 if unknown."""
        levels = self.levels(keys, segment)
        low = np.maximum(1, np.ceil(LEVEL_BASE ** (levels - 1) - 1e-9))
        high = np.maximum(low, np.ceil(LEVEL_BASE**levels - 1e-9) - 1)
        return np.where(levels > 0, (low + high) / 2, 0.0)


def level_of(counts: np.ndarray) -> np.ndarray:
    """1 + floor(log_b count)."""
    return 1 + np.floor(np.log(counts) / math.log(LEVEL_BASE) + 1e-9).astype(np.int64)


def hash_pair(keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of (key, level), which give all its places."""
    a = _mixed(keys + np.uint64(level * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    return a, (a * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)


def place_of(a: np.ndarray, b: np.ndarray, i: int, size: np.ndarray) -> np.ndarray:
    """The i-th bit number in a segment of ``size`` bits, which is under 2^32."""
    high = (a + np.uint64(i) * b) >> np.uint64(32)
    return ((high * size.astype(np.uint64)) >> np.uint64(32)).astype(np.int64)


def segment_bits(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """The filter of one segment."""
    levels = level_of(counts)
    size = max(64, (BITS_PER_ENTRY * int(levels.sum()) + 7) // 8 * 8)
    bits = np.zeros(size, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        own = keys[levels >= level]
        a, b = hash_pair(own, level)
        for i in range(HASHES):
            bits[place_of(a, b, i, np.full(len(own), size))] = True
    return np.packbits(bits, bitorder="little").tobytes()


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word binary, c)`` over all texts of ``docs``; tasks count before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches, "text", CHUNK_BYTES):
            tokens = Tokens(table.column("text").chunk(0))
            counts = np.bincount(tokens.ids, minlength=len(tokens.dictionary))
            for i in range(0, len(counts), 50_000):
                words = tokens.dictionary[i : i + 50_000].cast(pa.binary())
                yield pa.RecordBatch.from_arrays([words, pa.array(counts[i : i + 50_000])], ["word", "c"])

    return docs.mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _packed(segment: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    if not len(keys):
        return
    order = np.argsort(segment, kind="stable")
    segment, keys, counts = segment[order], keys[order], counts[order]
    numbers, starts = np.unique(segment, return_index=True)
    ends = np.append(starts[1:], len(segment))
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(numbers.astype(np.int32)),
            pa.array([keys[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()),
            pa.array([counts[a:b].astype("<u4").tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()),
        ],
        ["segment", "keys", "counts"],
    )


@dataclass(frozen=True)
class Frequent:
    """Exact counts of the most frequent words."""

    words: pa.Array
    counts: np.ndarray

    def find(self, words: pa.Array) -> np.ndarray:
        """The count of each word; 0 for words that are not frequent."""
        at = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False)
        return np.append(self.counts, 0)[at]


def frequent_words(counts: DataFrame) -> Frequent:
    """The HOT_WORDS words with the largest counts: a table of bounded size."""
    rows = counts.orderBy(F.desc("c"), "word").limit(HOT_WORDS).collect()
    words = pa.array([bytes(r["word"]) for r in rows], pa.large_binary())
    return Frequent(words, np.array([r["c"] for r in rows], np.int64))


def _pair_segments(frequent: np.ndarray, pairs: np.ndarray, second: np.ndarray, total: int) -> np.ndarray:
    """A pair lies with its second word; pairs with a frequent one are dealt out."""
    by = np.where(frequent > 0, pairs, second)
    return (by % np.uint64(total)).astype(np.int64)


def ngram_segments(docs: DataFrame, frequent: Broadcast, total: int) -> DataFrame:
    """``(segment, bits)``: the filter of the words and pairs of words of ``docs``.

    Tasks sum equal n-grams of some million tokens before they send them, as packed
    arrays, to their segment.  A frequent n-gram is one entry of each such chunk, and the
    pairs of a frequent word are dealt out over all segments.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches, "text", CHUNK_BYTES):
            tokens = Tokens(table.column("text").chunk(0))
            counts = np.bincount(tokens.ids, minlength=len(tokens.dictionary))
            used = np.flatnonzero(counts)
            keys = tokens.hashes[used]
            yield from _packed((keys % np.uint64(total)).astype(np.int64), keys, counts[used])
            second = tokens.ids[tokens.follows]
            if not len(second):
                continue
            hot = frequent.value.find(tokens.dictionary)
            pairs = pair_keys(tokens.hashes[tokens.ids[tokens.follows - 1]], tokens.hashes[second])
            order, starts, keys = distinct(pairs)
            second = second[order[starts]]
            segment = _pair_segments(hot[second], keys, tokens.hashes[second], total)
            yield from _packed(segment, keys, np.diff(np.append(starts, len(order))))

    def merge(key: tuple, rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = [], []
        for batch in rows:
            keys += [np.frombuffer(x, "<u8") for x in batch.column("keys").to_pylist()]
            counts += [np.frombuffer(x, "<u4") for x in batch.column("counts").to_pylist()]
        order, starts, every = distinct(np.concatenate(keys))
        sums = np.add.reduceat(np.concatenate(counts).astype(np.int64)[order], starts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.int32()), pa.array([segment_bits(every, sums)], pa.binary())],
            ["segment", "bits"],
        )

    packed = docs.mapInArrow(run, "segment int, keys binary, counts binary")
    return packed.groupBy("segment").applyInArrow(merge, "segment int, bits binary")


def passes(segments: DataFrame, total: int, limit: int) -> Iterator[Segments]:
    """Groups of whole segments of up to ``limit`` bytes; the driver holds one at a time."""
    sizes = segments.select("segment", F.length("bits").alias("n")).collect()
    groups: list[list[int]] = [[]]
    held = 0
    empty = np.ones(total, bool)
    empty[[r["segment"] for r in sizes]] = False
    for number, n in sorted((r["segment"], r["n"]) for r in sizes):
        if groups[-1] and held + n > limit:
            groups.append([])
            held = 0
        groups[-1].append(number)
        held += n
    for i, group in enumerate(groups):
        starts, lengths, parts, at = np.zeros(total, np.int64), np.zeros(total, np.int64), [], 0
        for row in segments.filter(F.col("segment").isin(group)).toLocalIterator() if group else []:
            starts[row["segment"]], lengths[row["segment"]] = 8 * at, 8 * len(row["bits"])
            parts.append(bytes(row["bits"]))
            at += len(parts[-1])
        yield Segments(total, i == 0, empty, starts, lengths, b"".join(parts))


def part_scores(tokens: Tokens, exact: np.ndarray, held: Segments, n: int, v: int) -> np.ndarray:
    """What the segments of one pass say about each text: log10 terms that add up over the passes.

    ``exact`` has the counts of the frequent words of the dictionary, 0 for others.  A pair is not looked
    for where one of its words is known to be unseen, and counts at most as often as its words.
    """
    words = tokens.hashes
    segment = (words % np.uint64(held.total)).astype(np.int64)
    rare = np.flatnonzero(exact == 0)
    counts = exact.astype(float)
    counts[rare] = held.counts(words[rare], segment[rare])
    covered = held.covers(segment)
    here = np.where(exact > 0, held.first, covered)
    # A word whose segment another pass holds may have any count.
    most = np.where((exact > 0) | covered, counts, np.inf)
    terms = np.where(here, np.log10(MASS * (counts + 1) / (n + v + 1)), 0.0)[tokens.ids]
    history, second = tokens.ids[tokens.follows - 1], tokens.ids[tokens.follows]
    terms[tokens.follows] += np.where(here, -np.log10(counts + MASS), 0.0)[history]
    if held.first:
        terms[tokens.starts] -= math.log10(MASS)
    bound = np.minimum(most[history], most[second])
    at = np.flatnonzero(bound > 0)
    order, starts, pairs = distinct(pair_keys(words[history[at]], words[second[at]]))
    one = at[order[starts]]
    own = _pair_segments(exact[second[one]], pairs, words[second[one]], held.total)
    pair_counts = np.minimum(held.counts(pairs, own), bound[one])
    share = np.log10(1 + pair_counts * (n + v + 1) / (MASS * (counts[second[one]] + 1)))
    terms[tokens.follows[at[order]]] += np.repeat(share, np.diff(np.append(starts, len(order))))
    return np.add.reduceat(terms, tokens.starts)


def _scored(docs: DataFrame, frequent: Broadcast, held: Broadcast, n: int, v: int) -> DataFrame:
    """``docs`` with their ``part`` from the segments of one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches, "text", SCORED_BYTES):
            tokens = Tokens(table.column("text").chunk(0))
            part = part_scores(tokens, frequent.value.find(tokens.dictionary), held.value, n, v)
            yield from table.drop_columns("text").append_column("part", pa.array(part)).to_batches()

    fields = [f for f in docs.schema.fields if f.name != "text"]
    return docs.mapInArrow(run, StructType([*fields, StructField("part", DoubleType())]))


def _with_scores(
    docs: DataFrame, segments: DataFrame, frequent: Broadcast, total: int, n: int, v: int, limit: int
) -> tuple[DataFrame, Broadcast | None]:
    """``docs`` (row_id, doc_id, held_out, text) with ``score``, and what is still to be added to it.

    A single pass is left to the step that sends the words.  Where the filter takes several, each is a
    job of its own that leaves its parts in the shared folder, by number of row, and the next one
    finds the former filter gone from memory.
    """
    context = docs.sparkSession.sparkContext
    pending = passes(segments, total, limit)
    first = next(pending)
    second = next(pending, None)
    if second is None:
        return docs.withColumn("score", F.lit(0.0)), context.broadcast(first)
    parts = []
    for group in itertools.chain([first, second], pending):
        held = context.broadcast(group)
        parts.append(stored(_scored(docs, frequent, held, n, v).select("row_id", "part"), "lm-part"))
        held.destroy()
    every = functools.reduce(DataFrame.unionAll, parts)
    return docs.join(every.groupBy("row_id").agg(F.sum("part").alias("score")), "row_id", "left"), None


def lm_scores(
    docs: DataFrame,
    training: Column | None = None,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """Token figures, add-one unigram score and n-gram model score of each document.

    The model learns from the rows for which ``training`` holds, by default those whose
    crc32 of the id, as text, has not the remainder 2 by 7.  ``base_score`` uses exact
    counts of all words: those of the HOT_WORDS most frequent ones go to every task, and
    occurrences of the others are joined with the table of counts.

    A null text is an empty one, which has the end token alone.  A null id trains and stays
    null.  Repeated rows each count and each give a row, by their number in the scan; ``docs`` must
    give the same rows in the same order whenever it is read, as tables do.  An empty table gives none.
    Other columns are not looked at.
    """
    spark = docs.sparkSession
    out = F.coalesce(F.pmod(F.crc32(F.col(f"`{id_column}`").cast("string")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))
    if training is not None:
        out = ~F.coalesce(training, F.lit(False))
    docs = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        out.alias("held_out"),
        F.col(f"`{text_column}`").alias("text"),
        F.monotonically_increasing_id().alias("row_id"),
    )
    train = docs.filter("not held_out").select("text")
    total = SEGMENTS_PER_PARTITION * scan_partitions(docs)
    counts = stored(word_counts(train), "lm-words")
    row = counts.agg(F.count("*").alias("v"), F.coalesce(F.sum("c"), F.lit(0)).alias("n")).first()
    n, v = row["n"], row["v"]
    frequent = spark.sparkContext.broadcast(frequent_words(counts))
    segments = stored(ngram_segments(train, frequent, total), "lm-filter")
    scored, held = _with_scores(docs, segments, frequent, total, n, v, pass_bytes)
    return _with_base(scored, held, counts, frequent, n, v)


def _with_base(scored: DataFrame, held: Broadcast | None, counts: DataFrame, frequent: Broadcast, n: int, v: int) -> DataFrame:
    """Join the less frequent words with their counts and sum per document.

    A document sends one row for all its frequent words, under a word of its own that
    no count has, and one for each distinct other word.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches, "text", SCORED_BYTES):
            tokens = Tokens(table.column("text").chunk(0))
            exact = frequent.value.find(tokens.dictionary)
            ids = table.column("row_id").to_numpy()
            score = table.column("score")
            if held is not None:
                score = pa.array(part_scores(tokens, exact, held.value, n, v))
            text = np.repeat(np.arange(len(ids)), tokens.sizes)
            known = exact[tokens.ids] > 0
            logs = np.where(known, np.log10(exact + 1.0)[tokens.ids], 0.0)
            frequent_rows = pa.table(
                {
                    "row_id": ids, "doc_id": table.column("doc_id"), "held_out": table.column("held_out"), "score": score,
                    "n_tokens": tokens.sizes, "n_known": np.bincount(text[known], minlength=len(ids)),
                    "logs": np.add.reduceat(logs, tokens.starts),
                    "word": pa.array([END + i.to_bytes(8, "big") for i in ids.tolist()], pa.binary()),
                    "times": np.zeros(len(ids), np.int64),
                }
            )
            yield from frequent_rows.cast(kinds).to_batches()
            pairs, times = np.unique(text[~known] * len(exact) + tokens.ids[~known], return_counts=True)
            rest = pa.table(
                {
                    "row_id": ids[pairs // len(exact)], **{name: pa.nulls(len(pairs), kinds.field(name).type) for name in kinds.names[1:7]},
                    "word": tokens.dictionary.take(pa.array(pairs % len(exact))), "times": times,
                }
            )
            yield from rest.cast(kinds).to_batches(50_000)

    schema = (
        "row_id long, doc_id long, held_out boolean, score double, n_tokens long, "
        "n_known long, logs double, word binary, times long"
    )
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.float64(), pa.int64(), pa.int64(), pa.float64(), pa.binary(), pa.int64()]
    kinds = pa.schema([(f.split()[0], kind) for f, kind in zip(schema.split(", "), types, strict=True)])
    joined = scored.mapInArrow(run, schema).join(counts, "word", "left")
    zero = F.lit(0)
    sums = joined.groupBy("row_id").agg(
        F.max(F.struct(F.col("n_tokens").isNotNull(), "doc_id", "held_out", "score")).alias("own"),
        F.sum("n_tokens").alias("n_tokens"),
        (F.sum(F.coalesce("n_known", zero)) + F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0))).alias("n_known"),
        (F.sum(F.coalesce("logs", zero)) + F.sum(F.coalesce(F.col("times") * F.log10(F.col("c") + 1), zero))).alias("logs"),
    )
    return sums.select(
        "own.doc_id", "own.held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * math.log10(n + v + 1)).alias("base_score"), "own.score",
    )
