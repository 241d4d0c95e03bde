"""Quality rules on repetition inside a text, found with suffix arrays over its words.

Texts of a batch are joined to one sequence of word numbers.  Prefix doubling
sorts its suffixes, each text apart, and keeps the ranks of every doubling; they
give the longest common prefix of neighbours in the suffix array without
walking the words.  A suffix's longest interval of common prefixes is the longest
substring that starts there and occurs a second time; it is a maximal repeat if it
does not continue the one that starts a word earlier.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sluice.llm.batches import BLANKS, slices, texts_of, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 3
MIN_WORDS = 50
CHUNK_WORDS = 200_000
# Clean labelled texts of the given table of 10,000 have up to 18.2 % of their words in repeats, of 13 words at most.
REPEAT_WORDS, MAX_COVERED_PCT, MAX_REPEAT = 10, 20, 50

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, n_repeats long, covered_words long, "
    "longest_repeat long, kept boolean"
)


def repeat_lengths(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each word the length of the longest substring starting there that its text has twice.

    ``ids`` holds the word numbers of several texts one after another, ``sizes`` the
    words of each text.
    """
    n = len(ids)
    if n == 0:
        return np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    end = np.repeat(np.cumsum(sizes), sizes)
    key = doc * (int(ids.max()) + 1) + ids
    order = np.argsort(key)
    new = np.ones(n, bool)
    new[1:] = key[order][1:] != key[order][:-1]
    place = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, place, 0))
    active = order[~(new & np.append(new[1:], True))]
    ranks, step = [rank.astype(np.int32)], 1
    while active.size:
        ahead = active + step
        inside = ahead < end[active]
        second = np.where(inside, rank[np.minimum(ahead, n - 1)], -1)
        first = rank[active]
        order = np.argsort(first * (n + 1) + second + 1)
        active, first, second = active[order], first[order], second[order]
        new_first = np.ones(len(active), bool)
        new_first[1:] = first[1:] != first[:-1]
        new = new_first.copy()
        new[1:] |= second[1:] != second[:-1]
        place = np.arange(len(active))
        in_group = np.maximum.accumulate(np.where(new, place, 0))
        in_first = np.maximum.accumulate(np.where(new_first, place, 0))
        rank[active] = first + in_group - in_first
        ranks.append(rank.astype(np.int32))
        active = active[~(new & np.append(new[1:], True))]
        step *= 2
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    left, right = suffixes[:-1], suffixes[1:]
    room = np.minimum(end[left] - left, end[right] - right)
    common = np.zeros(n - 1, np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        step = 1 << level
        a, b = np.minimum(left + common, n - 1), np.minimum(right + common, n - 1)
        same = (common + step <= room) & (ranks[level][a] == ranks[level][b])
        common[same] += step
    longest = np.zeros(n, np.int64)
    longest[left] = common
    longest[right] = np.maximum(longest[right], common)
    return longest


def covered(longest: np.ndarray, least: int) -> np.ndarray:
    """Words inside the union of the repeats of ``least`` words or more."""
    n = len(longest)
    starts = np.flatnonzero(longest >= least)
    change = np.bincount(starts, minlength=n + 1) - np.bincount(
        starts + longest[starts], minlength=n + 1
    )
    return np.cumsum(change[:n]) > 0


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    total = np.concatenate(([0], np.cumsum(values)))
    return total[ends] - total[ends - sizes]


def _figures(texts: list[str], words: list[list[bytes]], rules: dict) -> dict[str, np.ndarray]:
    numbers: dict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    sizes = np.array([len(w) for w in words], np.int64)
    ids = np.fromiter(
        (numbers[w] for doc in words for w in doc), np.int64, count=int(sizes.sum())
    )
    longest = repeat_lengths(ids, sizes)
    repeats = longest >= rules["repeat_words"]
    starts = np.cumsum(sizes) - sizes
    goes_on = np.zeros(len(ids), bool)
    goes_on[1:] = longest[:-1] == longest[1:] + 1
    goes_on[starts[sizes > 0]] = False
    top = np.zeros(len(sizes), np.int64)
    if len(ids):
        top[sizes > 0] = np.maximum.reduceat(longest, starts[sizes > 0])
    lines = [[x for x in t.split("\n") if x.strip(BLANKS)] for t in texts]
    out = {
        "n_words": sizes,
        "word_chars": np.array([len(t) - sum(map(t.count, BLANKS)) for t in texts], np.int64),
        "n_symbols": np.array([sum(map(t.count, SYMBOLS)) for t in texts], np.int64),
        "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], np.int64),
        "n_repeat_words": _sums(covered(longest, WINDOW), sizes),
    }
    out["base_failed"] = (sizes < MIN_WORDS) | (100 * out["n_repeat_words"] > 50 * sizes)
    out["n_repeats"] = _sums(repeats & ~goes_on, sizes)
    out["covered_words"] = _sums(covered(longest, rules["repeat_words"]), sizes)
    out["longest_repeat"] = top
    out["kept"] = (
        ~out["base_failed"]
        & (100 * out["covered_words"] <= rules["max_covered_pct"] * sizes)
        & (top <= rules["max_repeat"])
    )
    return out


def _chunks(texts: list[str]) -> Iterator[tuple[list[str], list[list[bytes]]]]:
    held, words, size = [], [], 0
    for text in texts:
        held.append(text)
        words.append(words_of(text))
        size += len(words[-1])
        if size >= CHUNK_WORDS:
            yield held, words
            held, words, size = [], [], 0
    if held:
        yield held, words


def _judge(texts: list[str], rules: dict) -> dict[str, np.ndarray]:
    parts = [_figures(t, w, rules) for t, w in _chunks(texts)]
    return {name: np.concatenate([p[name] for p in parts]) for name in parts[0]}


def _rules(repeat_words: int, max_covered_pct: int, max_repeat: int) -> dict:
    if repeat_words < 1:
        raise ValueError("a repeat has one word at least")
    return {
        "repeat_words": repeat_words,
        "max_covered_pct": max_covered_pct,
        "max_repeat": max_repeat,
    }


def repetition_figures(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    repeat_words: int = REPEAT_WORDS,
    max_covered_pct: int = MAX_COVERED_PCT,
    max_repeat: int = MAX_REPEAT,
) -> DataFrame:
    """A row per document: word, symbol and line counts, its repeats and the verdict.

    Rejected are texts of under 50 words, texts of which over half the words lie in
    3-word windows found twice, texts of which more than ``max_covered_pct`` % lie in
    repeats of ``repeat_words`` words or more, and texts with a repeat of over
    ``max_repeat`` words.  A null text counts as empty: no words, rejected.  A null id
    stays null, repeated rows each give a row, an empty table gives none, and other
    columns are not looked at.  No document meets another, so nothing is shuffled.
    """
    rules = _rules(repeat_words, max_covered_pct, max_repeat)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = _judge(texts_of(batch, "text"), rules)
            arrays = [batch.column("doc_id"), *(pa.array(found[c]) for c in names[1:])]
            yield pa.RecordBatch.from_arrays(arrays, names)

    names = [c.split()[0] for c in SCHEMA.split(", ")]
    narrow = docs.selectExpr(
        f"cast(`{id_column}` as long) as doc_id", f"`{text_column}` as text"
    )
    return narrow.mapInArrow(run, SCHEMA)


def keep_unrepeated(
    docs: DataFrame,
    *,
    text_column: str = "text",
    repeat_words: int = REPEAT_WORDS,
    max_covered_pct: int = MAX_COVERED_PCT,
    max_repeat: int = MAX_REPEAT,
) -> DataFrame:
    """The documents that ``repetition_figures`` keeps, with all their columns.

    Null and empty texts go, as they have too few words.  Null ids stay as they are, repeated rows stay or go together, an
    empty table stays empty, and columns of any other name are passed on.
    """
    rules = _rules(repeat_words, max_covered_pct, max_repeat)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array(_judge(texts_of(batch, text_column), rules)["kept"]))

    return docs.mapInArrow(run, docs.schema)
