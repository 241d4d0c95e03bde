"""Joins texts whose sets of word shingles are similar, by parity sketches.

Each shingle is a 64-bit hash that flips one bit of a wide sketch: two sets differ in at least as
many shingles as their sketches differ in bits.  Sets of a Jaccard similarity of s or more
differ in at most d = (1 - s) / (1 + s) of their total size.

Candidates.  In a band of sizes the sketch is cut into m = 2 (d + 1) blocks by the high bits of
the hashes.  d differences spoil d blocks at most, so m - d blocks are equal, and by
the pigeonhole principle it is enough to look at d + 1 blocks of each set, provided that all sets prefer
blocks in the same order: those with many shingles that are not widespread come
first, as other sets seldom have them.  A block is compared as the xor of its hashes, which is
a fingerprint of its parity bits.  Sets of a band meet those of the next one as
well, so each set is sent with the blocks of its own band and of the one above.

Groups.  Equal sets are one node, whatever the number of their texts.  In a small group of
equal blocks all pairs are candidates; in a large one all sets are paired with one of them
that is drawn by the block.  Candidates are dropped if their folded sketches are too far apart, and
else verified on the whole sets.  Verified links give components.  Large groups
that then still hold several components are compared across components, with the sketches, and what is
left is verified too.  Of two nodes of different components one at least is outside the group's largest
component, so that only those nodes meet the others, in blocks of bounded size.  Thus no link between
two components is lost, and a group costs its size times its nodes outside the largest component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.batches import scan_partitions, slices, stored, texts_of, words_of

SHINGLE = 5
SIMILARITY_PCT = 80
BUCKETS_PER_PARTITION = 2
PAIRED_GROUP = 6
CENTRES = 8
SEEN = 1_000_000
CHUNK = 1_000_000
HINT_SHARE, HINT_LEAST, HINT_ONE_IN = 1000, 4, 32
MAX_BROADCAST_IDS = 2_000_000
BLOCK_NODES = 1000
KEY_BYTES = 5
NODE_BYTES = 12


def shingles_of(text: str, width: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct word shingles of a text, A-Z lowered.

    Fewer words than ``width`` are one shingle; no words give none.
    """
    words = words_of(text, lower=True)
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64)
    # A shingle's hash is a polynomial of its words' hashes, mixed at the end.
    one = {w: xxhash.xxh3_64_intdigest(w) for w in set(words)}
    h = np.fromiter(map(one.__getitem__, words), np.uint64, count=len(words))
    n = len(words) - width + 1
    total = np.zeros(n, np.uint64)
    for i in range(width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + (h[i : i + n] ^ (h[i : i + n] >> np.uint64(29)))
    return np.unique(_mixed(total))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(hashes: np.ndarray) -> bytes:
    """96 bits that stand for a set, as every block it is sent with repeats them."""
    return xxhash.xxh3_128_digest(hashes.tobytes())[:NODE_BYTES]


def sketch_of(hashes: np.ndarray) -> bytes:
    """Parity sketch of about a bit per shingle; its length is a power of two, 64 bits at least."""
    bits = max(64, 1 << int(len(hashes) - 1).bit_length())
    odd = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def sketch_distance(a: bytes, b: bytes) -> int:
    """Hamming distance after folding the longer sketch to the length of the other."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if len(x) < len(y):
        x, y = y, x
    x = np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


class Bands:
    """Bands of sizes: a set can only be similar to sets of its own band or a neighbouring one."""

    def __init__(self, pct: int) -> None:
        self.pct, self.tops = pct, [1]

    def of(self, size: int) -> int:
        while self.tops[-1] < size:
            self.tops.append((self.tops[-1] + 1) * 100 // self.pct)
        return int(np.searchsorted(self.tops, size))

    def differences(self, band: int) -> int:
        """Most shingles in which two similar sets up to the top of the band can differ."""
        while len(self.tops) <= band:
            self.tops.append((self.tops[-1] + 1) * 100 // self.pct)
        return 2 * self.tops[band] * (100 - self.pct) // (100 + self.pct)


def block_keys(hashes: np.ndarray, mixed: np.ndarray, rare: np.ndarray, band: int, differences: int) -> np.ndarray:
    """Keys of the d + 1 preferred blocks of a set in a band, in no order.

    ``mixed`` are the hashes as blocks sum them up, ``rare`` is 1 for those that are not widespread.
    """
    blocks = 2 * (differences + 1)
    number = ((hashes >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    starts = np.flatnonzero(np.append(True, number[1:] != number[:-1]))
    filled = number[starts]
    salt = np.uint64(band * 0xC2B2AE3D27D4EB4F & 0xFFFFFFFFFFFFFFFF)
    content = np.bitwise_xor.reduceat(mixed, starts)
    wanted = differences + 1
    keys = _mixed(content + (filled + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + salt)
    if len(filled) < wanted:
        empty = np.setdiff1d(np.arange(blocks, dtype=np.uint64), filled)
        extra = _mixed((empty + np.uint64(1)) * np.uint64(0xA0761D6478BD642F) + salt)
        # Empty blocks come last, in the order of their keys.
        return np.concatenate([keys, np.sort(extra)[: wanted - len(filled)]])
    if len(filled) == wanted:
        return keys
    # Most rare shingles first, then most shingles, then the least key: one number that only depends on the block.
    few = np.uint64(255) - np.minimum(np.add.reduceat(rare, starts), 255).astype(np.uint64)
    small = np.uint64(255) - np.minimum(np.diff(np.append(starts, len(hashes))), 255).astype(np.uint64)
    place = (few << np.uint64(56)) | (small << np.uint64(48)) | (keys >> np.uint64(16))
    return keys[np.argpartition(place, wanted - 1)[:wanted]]


def text_sets(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """``(doc_id, n_shingles, node, sketch)`` of documents (doc_id, text); equal sets share their node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingles_of(t, width) for t in texts_of(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([fingerprint(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([sketch_of(s) if len(s) else None for s in sets], pa.binary()),
                ],
                ["doc_id", "n_shingles", "node", "sketch"],
            )

    return docs.mapInArrow(run, "doc_id long, n_shingles long, node binary, sketch binary")


def widespread_shingles(docs: DataFrame, width: int = SHINGLE) -> np.ndarray:
    """Shingles of over a thousandth of a sample of texts.

    They only say which blocks are looked at first, so the sample changes no result.  As a
    text of n words has n shingles at most, there are a thousand times the mean
    length of the sampled texts of them at most.
    """
    sample = docs.filter(F.pmod(F.xxhash64("text"), F.lit(HINT_ONE_IN)) == 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for text in texts_of(batch, "text"):
                found = shingles_of(text, width)
                yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64))], ["shingle"])

    sample_size = max(1, sample.count())
    counts = sample.mapInArrow(run, "shingle long").groupBy("shingle").count()
    frequent = counts.filter((F.col("count") >= HINT_LEAST) & (F.col("count") * HINT_SHARE >= sample_size))
    found = frequent.select("shingle").toPandas()["shingle"].to_numpy(np.int64)
    return np.sort(found.astype(np.uint64))


def _known(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return sorted_keys[at] == keys


NODE = np.dtype([("a", "<u8"), ("b", "<u4")])
ENTRY = np.dtype([("key", "<u8"), *NODE.descr])
PAIR = np.dtype([("la", "<u8"), ("lb", "<u4"), ("ra", "<u8"), ("rb", "<u4")])


def block_entries(docs: DataFrame, hint: Broadcast, buckets: int, pct: int, width: int) -> DataFrame:
    """The blocks of all sets, packed in rows by a hash of the block."""

    def packed(keys: list[np.ndarray], nodes: list[bytes]) -> Iterator[pa.RecordBatch]:
        """A row per bucket: its nodes, the number of blocks of each, and the low bytes of the blocks' keys.

        The bucket is drawn from the other bytes.  Keys that share what is left are compared in vain at times.
        """
        every = np.concatenate(keys)
        owner = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
        bucket = ((every >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        every, owner, bucket = every[order], owner[order], bucket[order]
        numbers, starts = np.unique(bucket, return_index=True)
        rows: list[list[bytes]] = [[], [], []]
        for start, end in zip(starts, np.append(starts[1:], len(bucket)), strict=True):
            own, counts = np.unique(owner[start:end], return_counts=True)
            rows[0].append(b"".join(nodes[i] for i in own))
            rows[1].append(counts.astype("<u4").tobytes())
            rows[2].append(every[start:end].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES].tobytes())
        arrays = [pa.array(numbers.astype(np.int32)), *(pa.array(r, pa.binary()) for r in rows)]
        yield pa.RecordBatch.from_arrays(arrays, ["bucket", "nodes", "counts", "keys"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layout, seen = Bands(pct), set()
        keys, nodes, size = [], [], 0
        for batch in slices(batches):
            for text in texts_of(batch, "text"):
                hashes = shingles_of(text, width)
                if not len(hashes):
                    continue
                node = fingerprint(hashes)
                if node in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(node)
                rare, band = (~_known(hint.value, hashes)).astype(np.int64), layout.of(len(hashes))
                mixed = _mixed(hashes ^ np.uint64(0xD6E8FEB86659FD93))
                for k in (band, band + 1):
                    keys.append(block_keys(hashes, mixed, rare, k, layout.differences(k)))
                    nodes.append(node)
                    size += len(keys[-1])
            if size >= CHUNK:
                yield from packed(keys, nodes)
                keys, nodes, size = [], [], 0
        if size:
            yield from packed(keys, nodes)

    return docs.mapInArrow(run, "bucket int, nodes binary, counts binary, keys binary")


def _unpacked(batch: pa.RecordBatch, row: int) -> np.ndarray:
    """The entries of a row, with keys that are the bucket's own."""
    nodes, counts, keys = (batch.column(c)[row].as_py() for c in ("nodes", "counts", "keys"))
    node = np.repeat(np.frombuffer(nodes, NODE), np.frombuffer(counts, "<u4"))
    entries = np.empty(len(node), ENTRY)
    whole = np.zeros((len(node), 8), np.uint8)
    whole[:, :KEY_BYTES] = np.frombuffer(keys, np.uint8).reshape(-1, KEY_BYTES)
    bucket = np.uint64(batch.column("bucket")[row].as_py() << 8 * KEY_BYTES & 0xFFFFFFFFFFFFFFFF)
    entries["key"], entries["a"], entries["b"] = whole.view("<u8")[:, 0] | bucket, node["a"], node["b"]
    return entries


def _as_binary(nodes: np.ndarray) -> pa.Array:
    flat = np.empty(len(nodes), NODE)
    flat["a"], flat["b"] = nodes["a"], nodes["b"]
    raw = flat.tobytes()
    return pa.array([raw[i : i + NODE_BYTES] for i in range(0, len(raw), NODE_BYTES)], pa.binary())


def block_groups(entries: DataFrame) -> DataFrame:
    """``(left, right, key)``: candidate pairs, and the members of large groups as (node, null, key).

    A group has its sets once.  Up to PAIRED_GROUP of them are paired with each other.  In a larger
    one the centre is the set with the least of CENTRES hashes, of which the block
    picks one, so that the blocks of a cluster share few centres.
    """

    def run(key: tuple, rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = np.concatenate([_unpacked(b, i) for b in rows for i in range(b.num_rows)])
        entries = entries[np.argsort(entries["key"])]
        new = np.append(True, entries["key"][1:] != entries["key"][:-1])
        entries = entries[~(new & np.append(new[1:], True))]
        entries = entries[np.lexsort((entries["b"], entries["a"], entries["key"]))]
        entries = entries[np.append(True, entries[1:] != entries[:-1])[: len(entries)]]
        if not len(entries):
            return
        starts = np.flatnonzero(np.append(True, entries["key"][1:] != entries["key"][:-1]))
        sizes = np.diff(np.append(starts, len(entries)))
        left, right = [], []
        for n in range(2, PAIRED_GROUP + 1):
            first = starts[sizes == n]
            for i in range(n):
                for j in range(i + 1, n):
                    left.append(first + i)
                    right.append(first + j)
        large = np.flatnonzero(sizes > PAIRED_GROUP)
        members = [np.arange(starts[g], starts[g] + sizes[g]) for g in large]
        for group in members:
            turn = np.uint64(int(entries["key"][group[0]]) % CENTRES * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
            centre = group[np.argmin(_mixed(entries["a"][group] + turn))]
            others = group[group != centre]
            left.append(np.minimum(others, centre))
            right.append(np.maximum(others, centre))
        if left:
            pairs = np.unique(
                np.stack([entries[c][np.concatenate(x)] for x in (left, right) for c in ("a", "b")], axis=1), axis=0
            )
            for i in range(0, len(pairs), 50_000):
                part = pairs[i : i + 50_000]
                flat = np.empty(len(part), PAIR)
                for column, name in enumerate(PAIR.names):
                    flat[name] = part[:, column]
                raw = flat.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([raw[j : j + NODE_BYTES] for j in range(0, len(raw), PAIR.itemsize)], pa.binary()),
                        pa.array([raw[j + NODE_BYTES : j + PAIR.itemsize] for j in range(0, len(raw), PAIR.itemsize)], pa.binary()),
                        pa.nulls(len(part), pa.int64()),
                    ],
                    ["left", "right", "key"],
                )
        for group in members:
            for i in range(0, len(group), 50_000):
                part = entries[group[i : i + 50_000]]
                yield pa.RecordBatch.from_arrays(
                    [_as_binary(part), pa.nulls(len(part), pa.binary()), pa.array(part["key"].astype(np.int64))],
                    ["left", "right", "key"],
                )

    return entries.groupBy("bucket").applyInArrow(run, "left binary, right binary, key long")


def near_enough(pairs: DataFrame, nodes: DataFrame, pct: int) -> DataFrame:
    """The pairs (left, right) whose sizes and folded sketches allow a similarity of ``pct`` %."""
    a = nodes.select(F.col("node").alias("left"), F.col("n_shingles").alias("n"), F.col("sketch").alias("s"))
    b = nodes.select(F.col("node").alias("right"), F.col("n_shingles").alias("m"), F.col("sketch").alias("t"))
    sized = pairs.join(a, "left").join(b, "right").filter(
        (F.col("n") * 100 >= F.col("m") * pct) & (F.col("m") * 100 >= F.col("n") * pct)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            n, m, s, t = (batch.column(c).to_pylist() for c in ("n", "m", "s", "t"))
            mask = [
                sketch_distance(x, y) * (100 + pct) <= (i + j) * (100 - pct)
                for i, j, x, y in zip(n, m, s, t, strict=True)
            ]
            yield batch.filter(pa.array(mask, pa.bool_())).select(["left", "right"])

    return sized.select("left", "right", "n", "m", "s", "t").mapInArrow(run, "left binary, right binary")


def verified(pairs: DataFrame, owners: DataFrame, docs: DataFrame, pct: int, width: int) -> DataFrame:
    """The pairs whose whole sets are similar enough.

    ``owners`` (node, doc_id) names one document for each node, whose text is fetched.
    Documents in no pair are left out first, by their ids where these are few enough to be
    broadcast.
    """
    ids = (
        pairs.select(F.col("left").alias("node")).union(pairs.select("right")).distinct().join(owners, "node")
    )
    ids = stored(ids, "pair-owners")
    small = ids.count() <= MAX_BROADCAST_IDS
    wanted = F.broadcast(ids) if small else ids

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # An id may stand on several rows with unlike texts.
        for batch in slices(batches):
            nodes = [fingerprint(shingles_of(t, width)) for t in texts_of(batch, "text")]
            mask = [x == y for x, y in zip(nodes, batch.column("node").to_pylist(), strict=True)]
            yield batch.filter(pa.array(mask, pa.bool_())).select(["node", "text"])

    texts = docs.join(wanted, "doc_id").select("node", "text").mapInArrow(own, "node binary, text string")
    texts = stored(texts, "pair-texts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[str, np.ndarray] = ("", np.zeros(0, np.uint64))
        for batch in slices(batches):
            mask = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                if last[0] != x:
                    last = (x, shingles_of(x, width))
                other = shingles_of(y, width)
                both = len(np.intersect1d(last[1], other, assume_unique=True))
                mask.append(100 * both >= pct * (len(last[1]) + len(other) - both))
            yield batch.filter(pa.array(mask, pa.bool_())).select(["left", "right"])

    a = texts.select(F.col("node").alias("left"), F.col("text").alias("x"))
    b = texts.select(F.col("node").alias("right"), F.col("text").alias("y"))
    joined = pairs.join(b, "right").join(a, "left").select("left", "right", "x", "y")
    return joined.mapInArrow(run, "left binary, right binary")


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for the nodes of ``links`` (left, right): the least node that links reach.

    Links are pointed at ever smaller nodes, alternately from larger neighbours and
    from the node itself, until nothing changes; each round is left in the shared folder.
    A node of very many links only takes part in sums and joins on its key.
    """
    edges = stored(
        links.select(F.greatest("left", "right").alias("u"), F.least("left", "right").alias("v"))
        .filter("u <> v").distinct(), "links",
    )
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = (
            joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v"))).distinct()
        )
        new = stored(small, "links")
        if new.count() == edges.count() and new.join(edges, ["u", "v"], "left_anti").isEmpty():
            break
        edges = new
    return new.select(F.col("u").alias("node"), F.col("v").alias("root"))


def compared_blocks(merged: DataFrame) -> DataFrame:
    """``(leader, i, j, minor, main, node, root)``: the rows that are compared, in blocks (leader, i, j).

    ``merged`` has the groups (leader, node, root).  A block has about BLOCK_NODES nodes outside the
    group's largest component (minor) and as many of all its nodes; ``main`` says that a node is in that component.
    """
    counts = merged.groupBy("leader", "root").count()
    sizes = counts.groupBy("leader").agg(
        F.max(F.struct("count", "root")).alias("top"), F.sum("count").alias("every")
    ).select(
        "leader", F.col("top.root").alias("largest"),
        F.ceil(F.col("every") / BLOCK_NODES).cast("int").alias("columns"),
        F.ceil((F.col("every") - F.col("top.count")) / BLOCK_NODES).cast("int").alias("lines"),
    ).filter("lines > 0")
    sized = merged.join(sizes, "leader").withColumn("main", F.col("root") == F.col("largest"))
    dealt = F.xxhash64("node")
    minor = sized.filter("not main").select(
        "leader", F.pmod(dealt, "lines").cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("columns") - 1)).alias("j"), F.lit(True).alias("minor"), "main", "node", "root",
    )
    every = sized.select(
        "leader", F.explode(F.sequence(F.lit(0), F.col("lines") - 1)).alias("i"),
        F.pmod(dealt, "columns").cast("int").alias("j"), F.lit(False).alias("minor"), "main", "node", "root",
    )
    return minor.union(every)


def across(members: DataFrame, roots: DataFrame, nodes: DataFrame, pct: int) -> DataFrame:
    """Pairs of different components within the large groups ``members`` (key, node), near enough by sketch.

    Groups with the same least node, as the many blocks of one cluster have, are compared as one, and
    so are those that share a node with the group of a lesser one.
    """
    known = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    keys = known.groupBy("key").agg((F.min("root") != F.max("root")).alias("mixed"), F.min("node").alias("leader"))
    led = known.join(keys.filter("mixed").select("key", "leader"), "key")
    groups = stored(led.select("leader", "node", "root").distinct(), "mixed-groups")
    low = groups.groupBy("node").agg(F.min("leader").alias("low"))
    to = groups.join(low, "node").groupBy("leader").agg(F.min("low").alias("to"))
    merged = groups.join(to, "leader").select(F.col("to").alias("leader"), "node", "root").distinct()
    rows = compared_blocks(stored(merged, "merged-groups")).join(nodes, "node")
    rows = rows.select("leader", "i", "j", "minor", "main", "node", "root", "n_shingles", "sketch")

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        minor = rows.column("minor").to_numpy()
        node, root = (np.array(rows.column(c).to_pylist(), object) for c in ("node", "root"))
        main, n = rows.column("main").to_numpy(), rows.column("n_shingles").to_numpy()
        sketch = [np.frombuffer(s, np.uint64) for s in rows.column("sketch").to_pylist()]
        words = np.array([len(s) for s in sketch])
        every = {
            w: (at := np.flatnonzero(~minor & (words == w)), np.stack([sketch[k] for k in at]))
            for w in np.unique(words[~minor]).tolist()
        }
        left, right = [], []
        for i in np.flatnonzero(minor):
            for w, (at, wide) in every.items():
                # Pairs outside the largest component stand in two blocks, or twice in one.
                ok = (root[at] != root[i]) & (main[at] | (node[at] > node[i]))
                near = np.flatnonzero(ok & (n[at] * 100 >= n[i] * pct) & (n[i] * 100 >= n[at] * pct))
                if not len(near):
                    continue
                fold = min(w, words[i])
                own = np.bitwise_xor.reduce(sketch[i].reshape(-1, fold), axis=0)
                short = np.bitwise_xor.reduce(wide[near].reshape(len(near), -1, fold), axis=1)
                far = np.bitwise_count(short ^ own).sum(axis=1, dtype=np.int64)
                for k in at[near[far * (100 + pct) <= (n[i] + n[at[near]]) * (100 - pct)]]:
                    left.append(min(node[i], node[k]))
                    right.append(max(node[i], node[k]))
        return pa.table([pa.array(left, pa.binary()), pa.array(right, pa.binary())], ["left", "right"])

    return rows.groupBy("leader", "i", "j").applyInArrow(run, "left binary, right binary").distinct()


def _placed(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", similarity_pct: int = SIMILARITY_PCT, width: int = SHINGLE
) -> DataFrame:
    """``(doc_id, n_shingles, node, component_id, first)``; ``first`` marks the set that stands for its component."""
    if not 50 <= similarity_pct <= 100:
        raise ValueError("a similarity from 50 to 100 is expected")
    pct = similarity_pct
    docs = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
    sets = stored(text_sets(docs, width), "text-sets")
    nodes = stored(
        sets.filter("node is not null and doc_id is not null").groupBy("node")
        .agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")),
        "nodes",
    )
    owners = nodes.select("node", "doc_id")
    named = docs.filter("doc_id is not null")
    hint = docs.sparkSession.sparkContext.broadcast(widespread_shingles(named, width))
    entries = block_entries(named, hint, BUCKETS_PER_PARTITION * scan_partitions(docs), pct, width)
    groups = stored(block_groups(entries), "block-groups")
    pairs = groups.filter("key is null").select("left", "right").distinct()
    pairs = stored(near_enough(pairs, nodes, pct), "near-pairs")
    links = stored(verified(pairs, owners, named, pct, width), "similar-pairs")
    roots = components(links)
    members = groups.filter("key is not null").select("key", F.col("left").alias("node"))
    rest = stored(across(members, roots, nodes, pct).join(pairs, ["left", "right"], "left_anti"), "rest-pairs")
    if not rest.isEmpty():
        links = links.union(stored(verified(rest, owners, named, pct, width), "similar-pairs"))
        roots = components(links)
    rooted = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min(F.struct("doc_id", "node")).alias("least"))
    placed = rooted.join(least, "root").select(
        "node", F.col("least.doc_id").alias("component_id"), (F.col("node") == F.col("least.node")).alias("first")
    )
    alone = F.col("node").isNull() | F.col("doc_id").isNull()
    return sets.join(placed, "node", "left").select(
        "doc_id", "n_shingles", "node", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "first"
    )


def similar_texts(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    similarity_pct: int = SIMILARITY_PCT,
    width: int = SHINGLE,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, a row for each row of ``docs``.

    ``component_id`` is the least id that links of ``similarity_pct`` % or more reach.  A null text
    or one without words has no shingles, is linked with nothing and has its own id.  A row
    with a null id is linked with nothing and has a null component.  Repeated rows each give
    a row, an empty table gives none, and other columns are not looked at.
    """
    options = {"id_column": id_column, "text_column": text_column, "similarity_pct": similarity_pct, "width": width}
    return _placed(docs, **options).select("doc_id", "n_shingles", "component_id")


def keep_one_of_each(docs: DataFrame, **options: object) -> DataFrame:
    """One document of each component, that with the least id, with all its columns, whatever their names.

    Documents without words and rows with a null id all stay.  Rows with the same id are judged by their own texts: of rows
    that agree in id and set of shingles one stays, and of unlike texts of the least id of a component one.  An empty
    table stays empty.
    """
    found = stored(_placed(docs, **options), "components")
    key = F.col(f"`{options.get('id_column', 'doc_id')}`").cast("long")
    names = docs.columns
    if found.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").isEmpty():
        drop = found.filter("doc_id <> component_id").select(F.col("doc_id").alias("_parity_id"))
        keyed = docs.withColumn("_parity_key", key)
        return keyed.join(drop, keyed["_parity_key"] == drop["_parity_id"], "left_anti").select(*[f"`{c}`" for c in names])
    text, width = options.get("text_column", "text"), options.get("width", SHINGLE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingles_of(t, width) for t in texts_of(batch, text)]
            yield batch.append_column("_parity_node", pa.array([fingerprint(x) if len(x) else None for x in sets], pa.binary()))

    noded = docs.mapInArrow(run, docs.withColumn("_parity_node", F.lit(None).cast("binary")).schema).withColumn("_parity_key", key)
    stay = found.filter("first and doc_id = component_id").select(
        F.col("doc_id").alias("_parity_id"), F.col("node").alias("_parity_first")
    ).distinct()
    free = noded.filter("_parity_node is null or _parity_key is null")
    same = (F.col("_parity_key") == F.col("_parity_id")) & (F.col("_parity_node") == F.col("_parity_first"))
    named = noded.filter("_parity_node is not null and _parity_key is not null").join(stay, same, "left_semi")
    every = free.unionByName(named.dropDuplicates(["_parity_key", "_parity_node"]))
    return every.select(*[f"`{c}`" for c in names])
