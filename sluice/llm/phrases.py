"""Collocations: phrases that occur far more often than their parts would have it.

Phrases of each length are the prefixes of suffixes of the pieces of a text.  Each task holds the words of a
bounded chunk of text as numbers, and pointers to the suffixes; multikey three-way quicksort
orders the pointers by their words up to the length looked at, and the sizes of its equal partitions are the counts of
phrases.  All partitions of a round are split at once, by sums over arrays.

Lengths are taken one after another.  The phrases of a chunk go with their counts to a bucket by a hash of all
their words, where the same sort adds the counts up and abandons partitions that are too small.  A phrase can only be
frequent if its leading and its closing words are, so the phrases left of one length are what suffixes are routed by in
the next: a bit field of bounded size, in which the frequent ones are marked, tells tasks which suffixes to leave out.
Marks may be shared by chance, which lets some through; counts stay exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.batches import slices, stored
from sluice.llm.words import Words

LEAST = 10
LONGEST = 3
INSIDE_PCT = 50
FIRST = 2000
CHUNK_BYTES = 12 << 20
BUCKET_BYTES = 6 << 20
FIELD_BITS = 28
SMALL = 2048
SALTS = 64
BLANKS, BREAKS = b" \t", b".,;:!?\n\x0b\x0c\r"

BLOB_SCHEMA = "bucket long, lang string, phrases binary, counts binary"
COUNT_SCHEMA = "lang string, phrase string, n long"


def equal_partitions(keys: np.ndarray, weights: np.ndarray, least: int = 1, small: int = SMALL) -> tuple[np.ndarray, np.ndarray]:
    """Multikey three-way quicksort of pointers; ``keys`` has a row for each depth and a column for each pointer.

    Gives a pointer of each partition whose keys are equal at all depths, and the weight of the partition.  Partitions with
    a weight under ``least`` are abandoned.  Those of up to ``small`` pointers are finished by one plain sort of all of them.
    """
    depths = len(keys)
    order = np.arange(keys.shape[1])
    starts, depth = np.zeros(1, np.int64), np.zeros(1, np.int64)
    found, sums, rest, parts = [], [], [], 0
    rng = np.random.default_rng(0)
    while len(order):
        ends = np.append(starts[1:], len(order))
        sizes = ends - starts
        weight = np.add.reduceat(weights[order], starts)
        done = (depth == depths) & (weight >= least)
        found.append(order[starts[done]])
        sums.append(weight[done])
        live = (depth < depths) & (weight >= least)
        little = live & (sizes <= small)
        if little.any():
            pick = np.repeat(little, sizes)
            number = np.repeat(np.arange(parts, parts + little.sum()), sizes[little])
            rest.append((number, order[pick]))
            parts += int(little.sum())
        live &= ~little
        if not live.any():
            break
        order, sizes, depth = order[np.repeat(live, sizes)], sizes[live], depth[live]
        starts = np.cumsum(sizes) - sizes
        # The middle one of three pointers is the pivot of its partition.
        at = starts + (rng.random((3, len(starts))) * sizes).astype(np.int64)
        pivot = np.sort(keys[depth, order[at]], axis=0)[1]
        of = np.repeat(np.arange(len(starts)), sizes)
        own = keys[depth[of], order]
        side = np.sign(own - pivot[of]).astype(np.int8)
        counts = np.stack([np.add.reduceat(side == s, starts, dtype=np.int64) for s in (-1, 0, 1)], axis=1)
        begins = (np.cumsum(counts.ravel()) - counts.ravel()).reshape(counts.shape)
        moved = np.empty_like(order)
        for s in (-1, 0, 1):
            # Pointers of a side keep their order: partitions lie one after another, and so do their targets.
            mine = np.flatnonzero(side == s)
            n = counts[:, s + 1]
            moved[np.repeat(begins[:, s + 1] - (np.cumsum(n) - n), n) + np.arange(len(mine))] = order[mine]
        order = moved
        filled = counts.ravel() > 0
        starts = begins.ravel()[filled]
        depth = np.stack([depth, depth + 1, depth], axis=1).ravel()[filled]
    if rest:
        number, left = (np.concatenate(x) for x in zip(*rest, strict=True))
        by = np.lexsort([*keys[::-1, left], number])
        left, number = left[by], number[by]
        change = np.flatnonzero(np.append(True, (number[1:] != number[:-1]) | (keys[:, left[1:]] != keys[:, left[:-1]]).any(axis=0)))
        weight = np.add.reduceat(weights[left], change)
        found.append(left[change][weight >= least])
        sums.append(weight[weight >= least])
    return (
        np.concatenate([*found, np.zeros(0, np.int64)]).astype(np.int64),
        np.concatenate([*sums, np.zeros(0, np.int64)]).astype(np.int64),
    )


class Field:
    """Marks of frequent phrases in a bit field of a bounded size."""

    def __init__(self, packed: np.ndarray) -> None:
        self.packed = packed

    def has(self, numbers: np.ndarray) -> np.ndarray:
        places = (numbers % np.uint64(8 * len(self.packed))).astype(np.int64)
        return (self.packed[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1


def marked_field(frequent: DataFrame, length: int) -> Field:
    """The bit field of a table of frequent phrases of ``length`` words: 16 bits a phrase, 2 ** FIELD_BITS at most.

    Tasks set the bits, each of a range of places, and send packed ranges.
    """
    bits = 1 << min(FIELD_BITS, max(13, (16 * frequent.count()).bit_length()))
    width = max(1024, bits >> 8)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, phrases in _by_lang(batch.column("lang"), batch.column("phrase")):
                words = Words(phrases, BLANKS, BREAKS)
                numbers = words.numbers(np.arange(len(phrases)) * length, length, lang)
                spot = (numbers % np.uint64(bits)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(spot // width), pa.array(spot % width)], ["part", "place"])

    def packed(table: pa.Table) -> pa.Table:
        field = np.zeros(width, bool)
        field[table.column("place").to_numpy()] = True
        blob = np.packbits(field, bitorder="little").tobytes()
        return pa.table({"part": table.column("part")[:1], "bits": pa.array([blob], pa.binary())})

    out = np.zeros(bits // 8, np.uint8)
    spots = frequent.select("lang", "phrase").mapInArrow(places, "part long, place long").distinct()
    for row in spots.groupBy("part").applyInArrow(packed, "part long, bits binary").toLocalIterator():
        start = row["part"] * width // 8
        out[start : start + width // 8] = np.frombuffer(row["bits"], np.uint8)
    return Field(out)


def _by_lang(langs: pa.Array, values: pa.Array) -> Iterator[tuple[str, pa.Array]]:
    """Values of each language that occurs, as large binaries."""
    coded = langs.dictionary_encode()
    numbers = coded.indices.to_numpy(zero_copy_only=False)
    for i, lang in enumerate(coded.dictionary.to_pylist()):
        yield lang, values.filter(pa.array(numbers == i)).cast(pa.large_binary())


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array]]:
    """Texts of one language, about CHUNK_BYTES of them or a single longer one."""
    held: dict[str, list[pa.Array]] = {}
    sizes: dict[str, int] = {}
    for batch in slices(batches):
        for lang, texts in _by_lang(batch.column("lang"), batch.column("text")):
            held.setdefault(lang, []).append(texts)
            sizes[lang] = sizes.get(lang, 0) + texts.nbytes
        while sizes and sum(sizes.values()) > CHUNK_BYTES:
            largest = max(sizes, key=sizes.__getitem__)
            sizes.pop(largest)
            yield largest, pa.concat_arrays(held.pop(largest))
    for lang, texts in held.items():
        yield lang, pa.concat_arrays(texts)


def _blobs(words: Words, lang: str, at: np.ndarray, length: int, counts: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """The phrases at the given places and their counts, one row for each bucket of phrases."""
    if not len(at):
        return
    bucket = (words.numbers(at, length, lang) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    numbers, starts = np.unique(bucket[order], return_index=True)
    ends = np.append(starts[1:], len(order))
    line = pa.scalar(b"\n", pa.large_binary()), pa.scalar(b"", pa.large_binary())
    joined = pc.binary_join_element_wise(words.phrases(at[order], length), *line)
    joined = pc.binary_join_element_wise(joined, line[0], line[1])
    offsets = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset : joined.offset + len(joined) + 1]
    raw, counts = memoryview(joined.buffers()[2]), counts[order]
    for low in range(0, len(numbers), 4096):
        cut = list(zip(starts[low : low + 4096], ends[low : low + 4096], strict=True))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(numbers[low : low + 4096]), pa.array([lang] * len(cut), pa.string()),
                pa.array([bytes(raw[offsets[a] : offsets[b]]) for a, b in cut], pa.binary()),
                pa.array([counts[a:b].tobytes() for a, b in cut], pa.binary()),
            ],
            ["bucket", "lang", "phrases", "counts"],
        )


def _sent(texts: DataFrame, length: int, buckets: int, field: Field | None) -> DataFrame:
    """Phrases of ``length`` words with their counts in each chunk, but those whose leading or closing words are unmarked."""
    held = texts.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, chunk in _chunks(batches):
            words = Words(chunk, BLANKS, BREAKS)
            at = np.flatnonzero(words.piece[: max(0, len(words.ids) - length + 1)] == words.piece[length - 1 :])
            if length == 1:
                # The dictionary has equal words in one partition already.
                _, at = np.unique(words.ids, return_index=True)
                counts = np.bincount(words.ids)
            else:
                for side in (0, 1):
                    at = at[held.value.has(words.numbers(at + side, length - 1, lang))]
                keys = np.stack([words.ids[at + i] for i in range(length)])
                first, counts = equal_partitions(keys, np.ones(len(at), np.int64))
                at = at[first]
            yield from _blobs(words, lang, at, length, counts, buckets)

    return texts.mapInArrow(run, BLOB_SCHEMA)


def _added(blobs: DataFrame, length: int, least: int) -> DataFrame:
    """``(lang, phrase, n)`` of phrases that occur ``least`` times or more, and a row without phrase that counts all."""

    def run(table: pa.Table) -> pa.Table:
        parts = []
        coded = table.column("lang").combine_chunks().dictionary_encode()
        numbers = coded.indices.to_numpy(zero_copy_only=False)
        for i, lang in enumerate(coded.dictionary.to_pylist()):
            own = table.filter(pa.array(numbers == i))
            words = Words(own.column("phrases").combine_chunks().cast(pa.large_binary()), BLANKS, BREAKS)
            weights = np.concatenate([np.frombuffer(c, np.int64) for c in own.column("counts").to_pylist()])
            at = np.arange(len(weights)) * length
            first, sums = equal_partitions(np.stack([words.ids[at + d] for d in range(length)]), weights, least)
            phrases = words.phrases(at[first], length).cast(pa.large_string()).cast(pa.string())
            phrases = pa.concat_arrays([phrases, pa.nulls(1, pa.string())])
            counts = np.append(sums, weights.sum())
            parts.append(pa.table({"lang": pa.array([lang] * len(counts), pa.string()), "phrase": phrases, "n": counts}))
        return pa.concat_tables(parts)

    return blobs.groupBy("bucket").applyInArrow(run, COUNT_SCHEMA)


def phrase_counts(texts: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[list[DataFrame], DataFrame]:
    """Stored ``(lang, phrase, n)`` of the frequent phrases of each length, and ``(lang, n)`` of all words.

    ``texts`` has columns lang and text without nulls.
    """
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = -(-size // BUCKET_BYTES) or 1
    counts, field, totals = [], None, None
    for length in range(1, longest + 1):
        found = stored(_added(_sent(texts, length, buckets, field), length, least), f"phrases-{length}")
        if length == 1:
            totals = found.filter("phrase IS NULL").groupBy("lang").agg(F.sum("n").alias("n"))
        counts.append(found.filter("phrase IS NOT NULL"))
        if length < longest:
            field = marked_field(counts[-1], length)
    return counts, totals


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def _scored(counts: list[DataFrame]) -> DataFrame:
    """Phrases of two words or more, with the counts and the score of their lowest-scoring cut."""
    cuts = _union(
        [
            counts[length - 1].select(
                "lang", "phrase", F.col("n").alias("a"), F.lit(k).alias("k"),
                F.substring_index("phrase", " ", k).alias("head"), F.substring_index("phrase", " ", k - length).alias("tail"),
            )
            for length in range(2, len(counts) + 1)
            for k in range(1, length)
        ]
    )
    parts = _union(counts[:-1])
    heads = parts.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    tails = parts.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r"))
    # Products stay under 10 ** 38 for counts under 10 ** 16.
    wide = {c: F.col(c).cast("decimal(38,0)") for c in "alr"}
    scored = (
        cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
        .withColumn("over", (F.lit(1_000_000).cast("decimal(38,0)") * wide["a"] * wide["a"]).cast("decimal(38,0)"))
        .withColumn("under", (wide["l"] * wide["r"]).cast("decimal(38,0)"))
        .withColumn("score", F.expr("over div under"))
    )
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def _covered(counts: list[DataFrame]) -> DataFrame:
    """``(lang, phrase, around)``: the largest count of a longer phrase around each phrase."""
    around = _union(
        [
            counts[length - 1].select(
                "lang", F.col("n").alias("around"),
                F.explode(F.array(*[
                    F.substring_index(F.substring_index("phrase", " ", start + size), " ", -size)
                    for size in range(2, length) for start in range(length - size + 1)
                ])).alias("phrase"),
            )
            for length in range(3, len(counts) + 1)
        ]
    )
    return around.groupBy("lang", "phrase").agg(F.max("around").alias("around"))


def collocations(
    docs: DataFrame,
    *,
    text_column: str = "text",
    lang_column: str = "lang",
    least: int = LEAST,
    longest: int = LONGEST,
    inside_pct: int = INSIDE_PCT,
    first: int = FIRST,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the first phrases of each language by score.

    ``a`` counts a phrase of 2 to ``longest`` words (at least ``least`` times), ``l`` and ``r`` the parts of its
    lowest-scoring cut, ``n`` all words of the language; the score is floor(1000000 a a / (l r)).  Phrases of which
    a longer frequent one holds ``inside_pct`` per cent of the occurrences are left out.  Ties go to the larger
    ``a``, then to the phrase that comes first by its bytes.

    Null texts are empty; a null language is ``und``.  Texts are counted whole, repeated rows as often as they
    come.  Languages without frequent phrases, and an empty table, give no rows; other columns are not looked at.
    """
    texts = docs.select(
        F.coalesce(F.col(f"`{lang_column}`").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text"),
    )
    counts, totals = phrase_counts(texts, least, longest)
    found = _scored(counts)
    if longest > 2:
        found = found.join(_covered(counts), ["lang", "phrase"], "left").filter(
            F.col("around").isNull() | (100 * F.col("around") < inside_pct * F.col("a"))
        )
    order = F.desc("score"), F.desc("a"), F.asc("phrase")
    # A language may hold most phrases: each of its parts sends its first ones only.
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    found = found.withColumn("rank", F.row_number().over(salted)).filter(F.col("rank") <= first)
    whole = Window.partitionBy("lang").orderBy(*order)
    found = found.withColumn("rank", F.row_number().over(whole).cast("long")).filter(F.col("rank") <= first)
    return found.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
