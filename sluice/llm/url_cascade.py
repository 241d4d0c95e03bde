"""URL filters by cascades of Bloom filters, exact over all keys of a corpus.

Level 0 of a cascade encodes the listed keys.  Level 1 encodes the keys of the
corpus that level 0 takes for listed although they are not, level 2 the listed keys
that level 1 takes for those, and so on until no key is left.  The first level
that does not know a key decides it: on an odd level it is listed, on an even
one it is not.  As the levels were made against every key of the corpus, the answer
is exact for each of them, and no page is joined with a list.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.batches import slices, stored

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIRST_BITS, LATER_BITS = 12, 3
MAX_BROADCAST_BYTES = 64 << 20
MAX_LEVELS = 64
MEMO = 100_000


def url_host(url: Column) -> Column:
    """What lies between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lowered."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, CAPITALS, SMALL), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_keys(host: str, path: str, lengths: list[int]) -> Iterator[str]:
    """Every rule that could fit: the host's suffixes with the path's prefixes, longest first."""
    if not host:
        return
    labels = host.split(".")
    found = {
        ".".join(labels[i:]) + path[:n]
        for i in range(len(labels))
        for n in lengths
        if n <= len(path)
    }
    yield from sorted(found, key=lambda k: (-len(k), k))


@dataclass(frozen=True)
class Level:
    """A Bloom filter; ``seed`` gives each level hashes of its own."""

    seed: int
    size: int
    hashes: int
    words: bytes

    def places(self, key: bytes) -> list[int]:
        h = xxhash.xxh3_128_intdigest(key, self.seed)
        a, b = h & 0xFFFFFFFFFFFFFFFF, h >> 64 | 1
        return [(a + i * b) % self.size for i in range(self.hashes)]

    def __contains__(self, key: bytes) -> bool:
        return all(self.words[p >> 3] >> (p & 7) & 1 for p in self.places(key))


def _level(keys: DataFrame, count: int, seed: int) -> Level:
    """A filter of ``keys``: tasks make pairs of byte and bits, which Spark ors together."""
    per_key = LATER_BITS if seed else FIRST_BITS
    size = max(64, per_key * count)
    empty = Level(seed, size, max(1, round(per_key * 0.69)), b"")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 10_000):
            at = [p for k in batch.column(0).to_pylist() for p in empty.places(k.encode())]
            places = np.unique(np.array(at, np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(places >> 3), pa.array((1 << (places & 7)).astype(np.int32))],
                ["place", "bits"],
            )

    bits = keys.mapInArrow(run, "place long, bits int").groupBy("place")
    rows = bits.agg(F.expr("bit_or(bits)").alias("bits")).toPandas()
    words = np.zeros((size + 7) // 8, np.uint8)
    words[rows["place"].to_numpy()] = rows["bits"].to_numpy()
    return Level(seed, size, empty.hashes, words.tobytes())


def in_levels(levels: list[Level], key: str) -> bool:
    """Whether a key of the corpus is listed."""
    raw = key.encode()
    for level in levels:
        if raw not in level:
            return level.seed % 2 == 1
    return len(levels) % 2 == 1


def _passing(keys: DataFrame, level: Level) -> DataFrame:
    held = keys.sparkSession.sparkContext.broadcast(level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 10_000):
            mask = [k.encode() in held.value for k in batch.column(0).to_pylist()]
            yield batch.filter(pa.array(mask, pa.bool_()))

    return keys.mapInArrow(run, "key string")


def build_cascade(universe: DataFrame, listed: DataFrame) -> list[Level] | None:
    """The levels for ``listed`` (key) against all keys of ``universe`` (key).

    Both are taken without nulls and repeats.  The first level has 12 bits for a listed
    key and the later ones 3 for each of their far fewer keys; where the first would
    be over 64 MB the answer is None, and the caller joins the keys instead.
    """
    universe = universe.filter("key is not null").distinct()
    inside = stored(
        listed.filter("key is not null").distinct().join(universe, "key", "left_semi"), "listed-keys"
    )
    outside = stored(universe.join(inside, "key", "left_anti"), "other-keys")
    levels: list[Level] = []
    encoded, others, count = inside, outside, inside.count()
    while count and len(levels) < MAX_LEVELS:
        if max(FIRST_BITS * count // 8, sum(len(x.words) for x in levels)) > MAX_BROADCAST_BYTES:
            return None
        levels.append(_level(encoded, count, len(levels)))
        encoded, others = stored(_passing(others, levels[-1]), "level-keys"), encoded
        count = encoded.count()
    if count:
        return None
    return levels


def corpus_keys(pages: DataFrame, lengths: list[int]) -> DataFrame:
    """The complete key universe: each host, and every rule that could fit some page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 10_000):
            pairs = set(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            keys = {k for host, start in pairs for k in (host, *rule_keys(host, start, lengths))}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(keys), pa.string())], ["key"])

    longest = max(lengths, default=0)
    starts = pages.select("host", F.substring("path", 1, longest).alias("start")).distinct()
    return starts.mapInArrow(run, "key string").distinct()


def filter_urls(
    pages: DataFrame,
    rules: list[tuple[str, str, str]] | DataFrame,
    listed_hosts: DataFrame | None = None,
    *,
    id_column: str = "page_id",
    url_column: str = "url",
) -> DataFrame:
    """``(page_id, host, path, rule, verdict)``, a row for each page.

    ``rules`` has (verdict, host, path) with the verdicts allow and block.  A rule fits its host and
    all subdomains if the path starts with the rule's; the longest decides, and of equally
    long ones the first by letters.  Where none fits, hosts among
    ``listed_hosts`` (host) are blocked and others allowed.  One cascade says which keys
    are rules, one which of these block and one which hosts are listed.

    A null url or one without ``://`` has an empty host and path, no rule and is
    allowed.  Null ids and repeated rows stay as they are, an empty table gives no rows, and
    other columns are not looked at.
    """
    spark = pages.sparkSession
    frame = rules if isinstance(rules, DataFrame) else _rule_frame(spark, rules)
    frame = frame.select("verdict", F.concat("host", "path").alias("key"), F.length("path").alias("n"))
    lengths = sorted(r["n"] for r in frame.select("n").distinct().collect())
    narrow = pages.select(
        F.col(f"`{id_column}`").cast("long").alias("page_id"),
        url_host(F.col(f"`{url_column}`")).alias("host"),
        url_path(F.col(f"`{url_column}`")).alias("path"),
    )
    universe = stored(corpus_keys(narrow, lengths), "corpus-keys")
    known = build_cascade(universe, frame.select("key"))
    blocking = build_cascade(universe, frame.filter("verdict = 'block'").select("key"))
    hosts = listed_hosts or spark.createDataFrame([], "host string")
    listed = build_cascade(universe, hosts.select(F.col("host").alias("key")))
    if known is None or blocking is None or listed is None:
        return _joined(narrow, universe, frame, hosts, lengths)
    held = spark.sparkContext.broadcast((known, blocking, listed))

    def decide(host: str, start: str) -> tuple[str | None, str]:
        is_rule, blocks, is_listed = held.value
        for key in rule_keys(host, start, lengths):
            if in_levels(is_rule, key):
                return key, "block" if in_levels(blocks, key) else "allow"
        return None, "block" if host and in_levels(is_listed, host) else "allow"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[tuple[str, str], tuple[str | None, str]] = {}
        longest = max(lengths, default=0)
        for batch in slices(batches, 10_000):
            found = []
            for host, path in zip(
                batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True
            ):
                at = (host, path[:longest])
                if at not in memo:
                    if len(memo) >= MEMO:
                        memo.clear()
                    memo[at] = decide(*at)
                found.append(memo[at])
            added = [pa.array([x[i] for x in found], pa.string()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "rule", "verdict"])

    return narrow.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")


def _rule_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def _joined(
    pages: DataFrame, universe: DataFrame, rules: DataFrame, hosts: DataFrame, lengths: list[int]
) -> DataFrame:
    """The same answer by joins, for lists whose cascade is too large to broadcast."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    sizes = F.array(*map(F.lit, lengths)) if lengths else F.array().cast("array<int>")
    fits = F.flatten(
        F.transform(
            F.filter(sizes, lambda n: n <= F.length("path")),
            lambda n: F.transform(suffixes, lambda s: F.concat(s, F.substr("path", F.lit(1), n))),
        )
    )
    kinds = pages.select("host", F.substring("path", 1, max(lengths, default=0)).alias("path")).distinct()
    tried = kinds.filter("host <> ''").select("host", "path", F.explode(fits).alias("key"))
    best = (
        tried.join(rules.select("key", "verdict").distinct(), "key")
        .groupBy("host", F.col("path").alias("start"))
        .agg(F.min(F.struct(-F.length("key"), "key", "verdict")).alias("best"))
    )
    listed = hosts.select("host").distinct().withColumn("listed", F.lit(True))
    out = pages.withColumn("start", F.substring("path", 1, max(lengths, default=0)))
    out = out.join(best, ["host", "start"], "left").join(listed, "host", "left")
    other = F.when(F.col("listed"), "block").otherwise("allow")
    return out.select(
        "page_id", "host", "path", F.col("best.key").alias("rule"),
        F.coalesce("best.verdict", other).alias("verdict"),
    )
