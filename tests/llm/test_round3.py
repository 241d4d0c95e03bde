"""Hard negatives, exact copies and collocations against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sluice.llm import cover_tree, lm_bloom, parity_join, phrases, pii_anchors, quotient_dedup, repetition, toxicity

LONG = " ".join(f"word{i % 977}" for i in range(30_000))


def best(rows, k):
    return sorted(rows, key=lambda r: (-r[1], r[0]))[:k]


def mined(rows, positives=5, negatives=10):
    """Rows (id, label, integer vector) to the expected result."""
    out = []
    for a, label, x in rows:
        if a % 10:
            continue
        near = best([(i, int(x @ y)) for i, g, y in rows if g == label and i != a], positives)
        for p, score in near:
            fit = [(i, int(x @ y)) for i, g, y in rows if g != label and 30 * score <= 100 * int(x @ y) <= 90 * score]
            out += [(a, p, r, i, score, s) for r, (i, s) in enumerate(best(fit, negatives), 1)]
    return sorted(out)


@pytest.mark.parametrize("spread", [1.0, 0.05])
def test_hard_negatives_equal_brute_force(spark, spread):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    points = centres[rng.integers(0, 6, 400)] + spread * rng.normal(size=(400, 8))
    points[50:80] = points[50]
    points[90] = 0.0
    labels = np.where(np.arange(400) % 3 == 0, 1, rng.integers(0, 4, 400))
    want = mined([(i, int(labels[i]), np.floor(points[i] * 256).astype(int)) for i in range(400)])
    table = spark.createDataFrame(
        [(i, points[i].tolist(), int(labels[i]), 0.0, 1) for i in range(400)],
        "vec_id long, embedding array<double>, label int, score double, rank int",
    )
    found = cover_tree.hard_negatives(table.repartition(3), F.col("vec_id") % 10 == 0)
    assert sorted(tuple(r) for r in found.collect()) == want and want


def test_cover_tree_bounds_and_skips():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 3)) * 5000
    points = np.unique((centres[rng.integers(0, 20, 1500)] + rng.normal(size=(1500, 3)) * 60).astype(np.int64), axis=0)
    tree = cover_tree.Tree.build(points, np.arange(len(points) + 1), np.arange(len(points)))
    leaves = tree.children[:, 0] == tree.children[:, 1]
    assert sorted(tree.centres[leaves]) == list(range(len(points)))
    scored = 0
    for anchor in points[::100]:
        scores = points @ anchor
        for low, high in [(-np.inf, np.inf), (int(np.median(scores)), int(np.quantile(scores, 0.8)))]:
            window = cover_tree.Best(low, high, 7)
            scored += cover_tree.search(tree, anchor, [window])
            inside = np.flatnonzero((scores >= low) & (scores <= high))
            want = best([(i, int(scores[i])) for i in inside], 7)
            assert list(zip(window.ids.tolist(), window.scores.tolist(), strict=True)) == want
    assert scored < len(points) * 2 * len(points[::100]) / 2
    again = cover_tree.Tree.of_row(*tree.row(4)[1:])
    assert (again.points == tree.points).all() and (again.children == tree.children).all() and again.length2 == tree.length2


def test_hard_negatives_on_odd_rows(spark):
    vectors = [
        (0, [1.0, 0.0], 1), (1, [2.0, 0.0], 1), (2, [1.0, 0.5], 2), (2, [1.0, 0.5], 2), (3, None, 2), (4, [1.0, None], 2),
        (5, [float("nan"), 1.0], 2), (6, [float("inf"), 1.0], 2), (7, [1.0, 0.0], None), (8, [1.0], 2), (9, [], 2),
        (None, [1.0, 0.0], 2), (11, [1e30, 0.0], 2), (12, [0.0, 0.0], 2), (13, [0.7, 9.0], 3),
    ]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label long")
    found = cover_tree.hard_negatives(table, F.col("vec_id") == 0)
    kept = [(0, 1, np.array([256, 0])), (1, 1, np.array([512, 0])), (2, 2, np.array([256, 128])), (13, 3, np.array([179, 2304]))]
    assert sorted(tuple(r) for r in found.collect()) == [r for r in mined(kept) if r[0] == 0] != []
    assert cover_tree.hard_negatives(table.limit(0), F.col("vec_id") == 0).count() == 0
    assert cover_tree.hard_negatives(table.filter("vec_id = 9"), F.col("vec_id") == 9).count() == 0


def test_quotient_filters_are_lossless():
    rng = np.random.default_rng(1)
    for width in (1, 5, 20, 44, 64):
        parts, total = [], Counter()
        for n in (0, 1, 500):
            drawn = rng.integers(0, 2**64 - 1, n, dtype=np.uint64) >> np.uint64(64 - width)
            drawn = np.concatenate([drawn, drawn[: n // 3], drawn[: n // 5]])
            values, counts = np.unique(drawn, return_counts=True)
            blob = quotient_dedup.pack(values, counts, width)
            assert all((a == b).all() for a, b in zip(quotient_dedup.unpack(blob, width), (values, counts), strict=True))
            parts.append(blob)
            total.update(drawn.tolist())
        values, counts = quotient_dedup.unpack(quotient_dedup.merge(parts, width), width)
        assert dict(zip(values.tolist(), counts.tolist(), strict=True)) == total


@pytest.fixture(scope="module")
def copies(spark):
    rng = np.random.default_rng(2)
    texts = [None, "", " ", "A", "a", "é", LONG, LONG + " "] + [f"text {i}" for i in range(60)]
    rows = [(int(i), texts[rng.integers(len(texts))] if i % 3 else "hot text", "f", "k", 2) for i in range(300)]
    rows += [(None, "hot text", "f", "k", 2), (None, "alone", "f", "k", 2), (7, "twice", "f", "k", 2), (7, "twice", "f", "k", 2)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, fp string, keep_id string, n int").repartition(4)


OPTIONS = [{}, {"bits": 4}, {"bits": 4, "broadcast_bytes": 0, "section_rows": 3}, {"broadcast_bytes": 0, "section_rows": 50}]


@pytest.mark.parametrize("options", OPTIONS)
def test_exact_copies_equal_brute_force(copies, options):
    rows, table = copies
    groups = defaultdict(list)
    for i, text, *_ in rows:
        groups[text or ""].append(i)
    want = []
    for i, text, *_ in rows:
        keep = max((j for j in groups[text or ""] if j is not None), default=None)
        want.append((i, keep, len(groups[text or ""]), i == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    found = quotient_dedup.exact_copies(table, **options)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == sorted(want, key=repr)
    kept = quotient_dedup.drop_copies(table, **options)
    assert kept.columns == table.columns and kept.count() == sum(w[3] for w in want)


def test_exact_copies_after_normalising_and_empty(copies):
    _, table = copies
    found = quotient_dedup.exact_copies(table, normalise=lambda c: F.lower(F.trim(c)))
    assert found.select("text_sha256").distinct().count() == found.filter("kept").select("keep_id", "text_sha256").distinct().count()
    assert quotient_dedup.exact_copies(table.limit(0)).count() == 0


def test_equal_partitions_equal_counts():
    rng = np.random.default_rng(4)
    for depths, n, values, small in [(1, 1, 1, 0), (2, 5000, 40, 8), (3, 20_000, 12, 500), (3, 20_000, 3, 1), (2, 3000, 3000, 0)]:
        keys = (rng.random((depths, n)) ** 2 * values).astype(np.int64)
        weights = rng.integers(1, 5, n)
        want = Counter()
        for column, weight in zip(keys.T.tolist(), weights.tolist(), strict=True):
            want[tuple(column)] += weight
        for least in (1, 10):
            first, sums = phrases.equal_partitions(keys, weights, least, small)
            found = dict(zip(map(tuple, keys[:, first].T.tolist()), sums.tolist(), strict=True))
            assert len(found) == len(first) and found == {k: n for k, n in want.items() if n >= least}
    assert [len(x) for x in phrases.equal_partitions(np.zeros((2, 0), int), np.zeros(0, int))] == [0, 0]


def collocated(rows, least, longest, first):
    """Brute force over (lang, text) rows."""
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        kept = []
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        for p, a in candidates.items():
            around = [
                b for q, b in candidates.items()
                if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            ]
            if not any(100 * b >= 50 * a for b in around):
                score, _, left, right = min(
                    (10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))
                )
                kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:first], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


@pytest.mark.parametrize(("least", "longest", "first"), [(10, 3, 2000), (4, 3, 15), (5, 4, 2000), (6, 2, 2000)])
def test_collocations_equal_brute_force(spark, monkeypatch, least, longest, first):
    monkeypatch.setattr(phrases, "BUCKET_BYTES", 3000)
    rng = np.random.default_rng(6)
    words = ["a", "B", "é", "dd", "E,", "f.", "g\th", "i\nj", "k\x0bl", "longer-than-eight", "m n", "o?"]
    rows = []
    for i in range(250):
        drawn = (rng.random(rng.integers(0, 60)) ** 2 * len(words)).astype(int)
        rows.append((["en", "fr", None, "x y"][i % 4 if i % 5 else 0], "  ".join(words[j] for j in drawn)))
    rows += [("en", None), ("fr", ""), ("en", LONG), ("lonely", "one"), (None, " \n ")] + [("en", "Same text here!")] * 30
    table = spark.createDataFrame([(*r, 1, "p") for r in rows], "lang string, text string, n int, phrase string").repartition(5)
    found = phrases.collocations(table, least=least, longest=longest, first=first)
    assert sorted(tuple(r) for r in found.collect()) == collocated(rows, least, longest, first)


def test_collocations_of_an_empty_table(spark):
    table = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(table).count() == 0


def test_texts_that_only_repeats_reject(spark):
    words = [f"w{i}" for i in range(1000)]
    rows = {
        1: words,
        2: words + words[100:160],
        3: words + words[100:149],
        4: words[:200] + [w for k in range(4) for w in [f"x{k}", *words[20 * k : 20 * k + 12]]],
        5: words[:200] + [w for k in range(2) for w in [f"x{k}", *words[20 * k : 20 * k + 10]]],
    }
    table = spark.createDataFrame([(i, " ".join(w)) for i, w in rows.items()], "doc_id long, text string")
    found = {r.doc_id: r for r in repetition.repetition_figures(table).collect()}
    assert not any(r.base_failed for r in found.values())
    assert {i for i, r in found.items() if r.kept} == {1, 3, 5}
    assert found[2].longest_repeat == 60 and 100 * found[4].covered_words > 20 * found[4].n_words


def test_one_of_each_of_repeated_ids(spark):
    base = " ".join(f"w{i}" for i in range(60))
    near, other = base + " end", " ".join(f"v{i}" for i in range(40))
    rows = [(1, base), (5, near), (5, None), (5, ""), (5, other), (5, other), (None, base), (7, other + " x"), (8, None), (9, base)]
    table = spark.createDataFrame([(i, t, i, t, "p") for i, t in rows], "doc_id long, text string, node long, _n string, key string")
    kept = parity_join.keep_one_of_each(table)
    assert kept.columns == table.columns
    want = [(1, base), (5, None), (5, ""), (5, other), (8, None), (None, base)]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(want, key=repr)
    unique = table.filter("doc_id <> 5 or text is null or doc_id is null")
    assert sorted(((r.doc_id, r.text) for r in parity_join.keep_one_of_each(unique).collect()), key=repr) == sorted(
        [(1, base), (5, None), (7, other + " x"), (8, None), (None, base)], key=repr
    )


def test_columns_that_clash(spark):
    texts = ["You awful idiot, I hate you" if i % 3 == 0 else f"a calm text number {i} on rivers" for i in range(60)]
    docs = spark.createDataFrame(
        [(i, t, "x", i, None) for i, t in enumerate(texts)], "doc_id long, text string, n_chars string, toxic int, label string"
    )
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(0, 60, 2)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    assert toxicity.keep_civil(docs, model).columns == docs.columns
    masked = pii_anchors.mask_documents(docs.withColumn("text", F.lit("mail a.b@c.org")))
    assert {r.n_chars for r in masked.collect()} == {"x"} and masked.filter("text like '%@%'").isEmpty()


ODD = [(1, None), (2, ""), (None, "w " * 80), (4, "tiny")] + [(10 + i, " ".join(f"t{i}w{j}" for j in range(70))) for i in range(6)]
ODD += [(12, ODD[6][1]), (50, " ".join(f"long{j}" for j in range(30_000))), (51, ODD[6][1] + " tail")]


def test_pipeline_on_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, toxic string, node int"
    docs = spark.createDataFrame([(i, t, None, "s", 0, "q", 1) for i, t in ODD], schema).repartition(3)
    labels = "/root/testdata/sf0.001"
    for table in (docs, docs.limit(0)):
        before = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, before, labels)
            assert after.columns == docs.columns
            before = after.checkpoint()
        ids = sorted(r.doc_id for r in before.collect())
        assert ids == ([10, 11, 12, 13, 14, 15, 50] if table is docs else [])
        packed = corpus_pipeline.packing(spark, before, labels)
        assert {r.doc_id for r in packed.collect()} == set(ids)


def test_lm_score_against_exact_counts(spark):
    """Scores differ from those of the same formula with exact counts by less than 0.02 a token in the mean."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    lists = {r.doc_id: [w.lower() for w in re.findall(r"[^\x20\x09-\x0D]+", r.text or "")] + ["\n"] for r in docs.collect()}
    held = {r.doc_id for r in docs.filter("pmod(crc32(cast(doc_id as string)), 7) = 2").collect()}
    ones, twos = Counter(), Counter()
    for i, words in lists.items():
        if i not in held:
            ones.update(words)
            twos.update(zip(words, words[1:], strict=False))
    n, v, m = sum(ones.values()), len(ones), lm_bloom.MASS

    def exact(words):
        total = 0.0
        for k, w in enumerate(words):
            p = (ones[w] + 1) / (n + v + 1)
            total += np.log10((twos[words[k - 1], w] + m * p) / (ones[words[k - 1]] + m) if k else p)
        return total

    errors = [abs(r.score - exact(lists[r.doc_id])) / len(lists[r.doc_id]) for r in lm_bloom.lm_scores(docs).collect()]
    assert np.mean(errors) < 0.02 and max(errors) < 0.3
