"""Text expressions: cleaning, word tokens, stop words and word n-grams."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.bind import bound

# The usual English stop-word list, in its published order.
ENGLISH_STOP_WORDS = tuple(
    """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves
he him his himself she she's her hers herself it it's its itself they them their theirs themselves
what which who whom this that that'll these those am is are was were be been being have has had
having do does did doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in out on off over
under again further then once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don don't should should've
now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn
hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn
shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()
)

# Fused words that the word tokeniser splits in two.
FUSED = ("cannot", "gimme", "lemme", "gonna", "wanna", "gotta")
FUSED_WORDS = r"\b(?:(can)(not)|(gim|lem)(me)|(gon|wan)(na)|(got)(ta))\b"
FUSED_WORDS_SPLIT = "$1$3$5$7 $2$4$6$8"


def clean_text(
    text: Column,
    drop_words: Iterable[str] = (),
    unicode_space: bool = False,
    keep_letters: str = "a-zA-Z",
) -> Column:
    """Lower-case, delete all but letters, blanks and ``:``, then delete ``drop_words``.

    Characters are deleted, not blanked (``a,b`` becomes ``ab``), and the drop
    words go wherever they occur, inside longer words too.  ``unicode_space``
    keeps blanks beyond ASCII; ``keep_letters=r"\\p{L}"`` keeps accented letters.
    """
    flag = "(?U)" if unicode_space else ""
    # the runs that stay are picked and joined: deleting the others by pattern takes over ten times as long
    kept = F.regexp_extract_all(F.lower(text), F.lit(rf"{flag}[{keep_letters}\s:]+"), F.lit(0))
    cleaned = F.array_join(kept, "")
    drop_words = list(drop_words)
    if not drop_words:
        return cleaned
    pattern = "|".join(re.escape(word) for word in drop_words)
    return _where_found(cleaned, drop_words, lambda t: F.regexp_replace(t, pattern, ""))


def _where_found(
    text: Column, words: Iterable[str], change: Callable[[Column], Column]
) -> Column:
    """``change`` only the texts that hold one of the words: a search is far cheaper."""
    return bound(
        text,
        lambda t: F.when(reduce(or_, [t.contains(w) for w in words]), change(t)).otherwise(t),
    )


def word_tokens(text: Column, split_fused: bool = True, unicode_words: bool = False) -> Column:
    """Words of a text, in order; everything outside word characters separates."""
    return F.filter(_pieces(text, split_fused, unicode_words), lambda word: word != "")


def _pieces(text: Column, split_fused: bool, unicode_words: bool) -> Column:
    """The text cut at its separators, empty pieces included."""
    if split_fused:
        text = _where_found(
            text, FUSED, lambda t: F.regexp_replace(t, FUSED_WORDS, FUSED_WORDS_SPLIT)
        )
    return F.split(text, rf"{'(?U)' if unicode_words else ''}\W+")


def without_stop_words(tokens: Column, stop_words: Iterable[str] = ENGLISH_STOP_WORDS) -> Column:
    """Drop stop words from a token array and keep the order and repeats of the rest."""
    stop_words = list(stop_words)
    return F.filter(tokens, lambda word: ~word.isin(stop_words)) if stop_words else tokens


def text_words(
    text: Column,
    drop_words: Iterable[str] = (),
    stop_words: Iterable[str] = ENGLISH_STOP_WORDS,
) -> Column:
    """Clean, split into words and drop stop words in one expression."""
    # the empty piece before a leading separator goes out with the stop words
    pieces = _pieces(clean_text(text, drop_words), True, False)
    return without_stop_words(pieces, ["", *stop_words])


def word_ngrams(tokens: Column, n_min: int = 1, n_max: int = 3, min_length: int = 2) -> Column:
    """All runs of ``n_min`` to ``n_max`` neighbouring words, joined by a blank.

    Words shorter than ``min_length`` are dropped first, so the words around
    them become neighbours.
    """
    long_words = F.filter(tokens, lambda word: F.length(word) >= min_length)
    if n_min == n_max == 1:
        return long_words
    return bound(long_words, lambda words: _runs(words, words, 1, n_min, n_max, []))


def _runs(words: Column, runs: Column, n: int, n_min: int, n_max: int, kept: list[Column]) -> Column:
    """``runs`` of ``n`` words and all longer ones, each made from the run that is one word shorter."""
    kept = [*kept, runs] if n >= n_min else kept
    if n == n_max:
        every = F.concat(*kept)
        return every if n_min == 1 else F.coalesce(every, F.array().cast("array<string>"))
    left = F.greatest(F.size(words) - n, F.lit(0))
    longer = F.zip_with(
        F.slice(runs, 1, left), F.slice(words, n + 1, left), lambda run, word: F.concat(run, F.lit(" "), word)
    )
    return bound(longer, lambda found: _runs(words, found, n + 1, n_min, n_max, kept))


def counted(terms: Column) -> Column:
    """The different terms of an array, each with its occurrences: an array of ``(term, tf)``."""

    def runs(ordered: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(ordered) - 1)
        begins = F.filter(places, lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)))
        return bound(begins, lambda at: F.transform(at, lambda i, j: F.struct(
            F.get(ordered, i).alias("term"),
            (F.coalesce(F.get(at, j + 1), F.size(ordered)) - i).cast("long").alias("tf"),
        )))

    return F.when(F.size(terms) > 0, bound(F.sort_array(terms), runs))


def iso_to_timestamp(text: Column) -> Column:
    """``2020-01-02T03:04:05`` as a timestamp; what cannot be read becomes null."""
    return F.try_to_timestamp(F.replace(text, F.lit("T"), F.lit(" ")))
