"""Exact duplicates: counting quotient filters find repeated fingerprints, and bytes decide.

Each task puts the fingerprints of its texts in counting quotient filters, one for each section of the
fingerprint space.  A filter splits a fingerprint in a quotient, which is an address, and a remainder, which is
stored; a bit says for each quotient whether it has a run of remainders, and a bit for each
remainder whether its run ends there.  Remainders lie in order, so that filters decode to sorted fingerprints and
merge without loss by adding the counts of equal ones, whatever the number of quotients of each.

Fingerprints that were counted more than once route their texts to a grouping by the bytes of the texts, which alone
decides.  Texts that share a fingerprint by chance are told apart there, and their rows are joined by text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.batches import stored

BITS = 64
SECTION_ROWS = 1 << 20
HELD = 1 << 22
BROADCAST_BYTES = 64 << 20
HOT_SHARE = 1000

FILTER_SCHEMA = "section long, filter binary"
REPEATED_SCHEMA = "fingerprint long, n long"
_COLUMNS = {"fingerprint": "_copy_fingerprint", "text": "_copy_text"}


def pack(values: np.ndarray, counts: np.ndarray, width: int) -> bytes:
    """A counting quotient filter of sorted different ``values`` of ``width`` bits and their counts."""
    quotient_bits = min(width, max(0, int(len(values)).bit_length()))
    left = width - quotient_bits
    quotients = (values >> np.uint64(left)).astype(np.int64) if left < 64 else np.zeros(len(values), np.int64)
    occupied = np.zeros(1 << quotient_bits, bool)
    occupied[quotients] = True
    ends = np.append(quotients[1:] != quotients[:-1], True) if len(values) else np.zeros(0, bool)
    mask = np.uint64((1 << left) - 1)
    remainders = values & mask
    size = next(s for s in (1, 2, 4, 8) if left <= 8 * s)
    often = np.flatnonzero(counts > 1)
    return b"".join(
        [
            np.array([len(values), quotient_bits, len(often)], "<i8").tobytes(),
            np.packbits(occupied).tobytes(),
            np.packbits(ends).tobytes(),
            remainders.astype(f"<u{size}").tobytes(),
            often.astype("<i4").tobytes(),
            counts[often].astype("<i8").tobytes(),
        ]
    )


def unpack(blob: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted values and counts of a filter."""
    size, quotient_bits, n_often = np.frombuffer(blob, "<i8", 3).tolist()
    left = width - quotient_bits
    at = 24

    def take(dtype: str, n: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(blob, dtype, n, at)
        at += out.nbytes
        return out

    occupied = np.unpackbits(take("u1", -(-(1 << quotient_bits) // 8)), count=1 << quotient_bits)
    ends = np.unpackbits(take("u1", -(-size // 8)), count=size)
    remainders = take(f"<u{next(s for s in (1, 2, 4, 8) if left <= 8 * s)}", size).astype(np.uint64)
    often, more = take("<i4", n_often), take("<i8", n_often)
    runs = np.concatenate([[0], np.cumsum(ends)[:-1]]).astype(np.int64) if size else np.zeros(0, np.int64)
    quotients = np.flatnonzero(occupied).astype(np.uint64)[runs]
    counts = np.ones(size, np.int64)
    counts[often] = more
    return (quotients << np.uint64(left) if left < 64 else np.uint64(0)) | remainders, counts


def merge(blobs: list[bytes], width: int) -> bytes:
    """One filter that counts what all of ``blobs`` count."""
    parts = [unpack(b, width) for b in blobs]
    values, where = np.unique(np.concatenate([v for v, _ in parts]), return_inverse=True)
    counts = np.zeros(len(values), np.int64)
    np.add.at(counts, where, np.concatenate([c for _, c in parts]))
    return pack(values, counts, width)


def section_bits(rows: int, bits: int, section_rows: int = SECTION_ROWS) -> int:
    """Leading bits that number the sections, such that one holds about ``section_rows`` fingerprints at most."""
    return min(bits, max(0, -(-rows // section_rows) - 1).bit_length())


def quotient_filters(fingerprints: DataFrame, bits: int, lead: int) -> DataFrame:
    """``(section, filter)``: a merged filter for each section of a table with one column of fingerprints.

    Tasks hold at most HELD fingerprints at a time; a fingerprint that they meet often is sent once.  The sections
    of one table hold parts of like size, as fingerprints are hashes.
    """
    width = bits - lead

    def sections(held: list[np.ndarray]) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        own = (values >> np.uint64(width)).astype(np.int64) if width < 64 else np.zeros(len(values), np.int64)
        numbers, starts = np.unique(own, return_index=True)
        rest = values & np.uint64((1 << width) - 1)
        ends = np.append(starts[1:], len(values))
        blobs = [pack(rest[a:b], counts[a:b], width) for a, b in zip(starts, ends, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(blobs, pa.binary())], ["section", "filter"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy().view(np.uint64))
            size += batch.num_rows
            if size >= HELD:
                yield sections(held)
                held, size = [], 0
        if size:
            yield sections(held)

    def merged(table: pa.Table) -> pa.Table:
        blob = merge(table.column("filter").to_pylist(), width)
        return pa.table({"section": table.column("section")[:1], "filter": pa.array([blob], pa.binary())})

    return fingerprints.mapInArrow(build, FILTER_SCHEMA).groupBy("section").applyInArrow(merged, FILTER_SCHEMA)


def repeated(filters: DataFrame, bits: int, lead: int) -> DataFrame:
    """``(fingerprint, n)`` of the fingerprints that filters have counted more than once."""
    width = bits - lead

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for section, blob in zip(batch.column("section").to_pylist(), batch.column("filter").to_pylist(), strict=True):
                values, counts = unpack(blob, width)
                often = counts > 1
                whole = values[often] | (np.uint64(section << width) if width < 64 else np.uint64(0))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(whole.view(np.int64)), pa.array(counts[often])], ["fingerprint", "n"]
                )

    return filters.mapInArrow(run, REPEATED_SCHEMA)


def _matched(rows: DataFrame, table: DataFrame, key: str, own_id: Column, n_rows: int, limit: int) -> DataFrame:
    """``rows`` with the columns of ``table`` for their fingerprint, null where it has none.

    ``table`` has one row for each fingerprint, with the number ``n`` of rows that have it.  It is broadcast if it
    is small by count.  Else the fingerprints of a thousandth of the rows or more, of which there are a thousand at
    most, are broadcast, and the others joined by shuffle; hot rows are then dealt by their ids.
    """
    names = [c for c in table.columns if c != "fingerprint"]
    if table.count() * 8 * (len(names) + 1) <= limit:
        return rows.join(F.broadcast(table), rows[key] == table["fingerprint"], "left").drop(table["fingerprint"])
    hot = table.filter(F.col("n") * HOT_SHARE >= n_rows)
    hot = hot.select(F.col("fingerprint").alias("_hot"), *[F.col(c).alias(f"_hot_{c}") for c in names])
    cold = table.filter(F.col("n") * HOT_SHARE < n_rows)
    cold = cold.select(
        F.col("fingerprint").alias("_cold"), F.lit(False).alias("_cold_flag"), *[F.col(c).alias(f"_cold_{c}") for c in names]
    )
    dealt = rows.join(F.broadcast(hot), rows[key] == hot["_hot"], "left")
    dealt = dealt.withColumns(
        {"_flag": F.col("_hot").isNotNull(), "_by": F.when(F.col("_hot").isNull(), F.col(key)).otherwise(F.xxhash64(own_id))}
    )
    found = dealt.join(cold, (dealt["_by"] == cold["_cold"]) & (dealt["_flag"] == cold["_cold_flag"]), "left")
    return found.select(
        *[rows[c] for c in rows.columns], *[F.coalesce(f"_hot_{c}", f"_cold_{c}").alias(c) for c in names]
    )


def marked(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    bits: int = BITS,
    normalise: Callable[[Column], Column] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    section_rows: int = SECTION_ROWS,
) -> DataFrame:
    """``docs`` with a struct ``_copies`` of keep_id, group_size, kept and the normalised text.

    Two rows are copies if their texts, a null one taken as empty, have the same bytes after ``normalise``.  Of
    copies the row with the largest id stays; a null id counts as smaller than any.  Rows that agree in
    id and text cannot be told apart and stay or go together.
    """
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    text = normalise(text) if normalise else text
    rows = docs.withColumn(_COLUMNS["text"], text)
    hashed = F.shiftrightunsigned(F.xxhash64(_COLUMNS["text"]), 64 - bits)
    rows = rows.withColumn(_COLUMNS["fingerprint"], hashed)
    key, own_id = _COLUMNS["fingerprint"], F.col(f"`{id_column}`")
    n_rows = docs.count()
    lead = section_bits(n_rows, bits, section_rows)
    filters = quotient_filters(rows.select(key), bits, lead)
    often = stored(repeated(filters, bits, lead), "repeated-fingerprints")
    slim = rows.select(own_id.alias("id"), F.col(key).alias("fp"), F.col(_COLUMNS["text"]).alias("body"))
    groups = (
        _matched(slim, often, "fp", F.col("id"), n_rows, broadcast_bytes)
        .filter("n IS NOT NULL").groupBy("fp", "body").agg(F.max("id").alias("keep_id"), F.count("*").alias("size"))
    )
    groups = stored(groups, "equal-texts")
    by_chance = groups.groupBy(F.col("fp").alias("chance")).agg(F.count("*").alias("texts")).filter("texts > 1").select("chance")
    by_chance = stored(by_chance, "chance-fingerprints")
    alone = groups.join(by_chance, groups["fp"] == by_chance["chance"], "left_anti")
    alone = alone.select(F.col("fp").alias("fingerprint"), "keep_id", F.col("size").alias("n"))
    found = _matched(rows.withColumnRenamed(key, "_copy_fp"), alone, "_copy_fp", own_id, n_rows, broadcast_bytes)
    keep_id, size = F.col("keep_id"), F.col("n")
    if not by_chance.isEmpty():
        shared = groups.join(by_chance, groups["fp"] == by_chance["chance"], "left_semi")
        shared = shared.select(
            F.col("fp").alias("_s_fp"), F.col("body").alias("_s_body"), F.col("keep_id").alias("_s_keep"), F.col("size").alias("_s_n")
        )
        found = found.join(shared, (F.col("_copy_fp") == F.col("_s_fp")) & (F.col(_COLUMNS["text"]) == F.col("_s_body")), "left")
        keep_id, size = F.coalesce(F.col("_s_keep"), keep_id), F.coalesce(F.col("_s_n"), size)
    keep_id = F.when(size.isNull(), own_id).otherwise(keep_id)
    copies = F.struct(
        keep_id.alias("keep_id"), F.coalesce(size, F.lit(1)).alias("group_size"), own_id.eqNullSafe(keep_id).alias("kept"),
        F.col(_COLUMNS["text"]).alias("text"),
    )
    return found.withColumn("_copies", copies)


def exact_copies(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``: a row for each row of ``docs``.

    Null texts are empty texts and copies of each other.  A null id counts as smaller than any; rows that agree in id and text
    stay or go together.  Very long texts are compared whole.  An empty table gives no rows, and other columns are
    not looked at.  Options are those of ``marked``.
    """
    slim = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
    return marked(slim, **options).select(
        "doc_id", "_copies.keep_id", "_copies.group_size", "_copies.kept", F.sha2("_copies.text", 256).alias("text_sha256")
    )


def drop_copies(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, with its columns, whatever their names; cases as in ``exact_copies``."""
    whole = docs.select(
        F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").alias("text"), F.struct("*").alias("_row")
    )
    return marked(whole, **options).filter("_copies.kept").select("_row.*")
