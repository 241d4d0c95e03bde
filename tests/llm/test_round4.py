"""What the parity join sends of each set."""

from __future__ import annotations

import numpy as np
import pytest

from sluice.llm import parity_join
from sluice.llm.batches import words_of


def keys_of(hashes: np.ndarray, band: int, differences: int) -> np.ndarray:
    rare = (hashes % np.uint64(3) > 0).astype(np.int64)
    return parity_join.block_keys(hashes, parity_join._mixed(hashes), rare, band, differences)


@pytest.mark.parametrize("size", [1, 2, 9, 60, 400, 3000])
def test_similar_sets_share_a_preferred_block(size):
    rng = np.random.default_rng(size)
    layout = parity_join.Bands(80)
    band = layout.of(size)
    differences = layout.differences(band)
    for _ in range(20):
        base = rng.integers(0, 1 << 64, size, np.uint64)
        gone = differences // 2
        other = np.append(base[gone:], rng.integers(0, 1 << 64, differences - gone, np.uint64))[:size]
        keys = [keys_of(np.unique(x), band, differences) for x in (base, other)]
        assert [len(k) for k in keys] == [differences + 1] * 2
        assert np.intersect1d(*keys).size


def test_a_set_is_sent_with_few_bytes_for_each_block():
    names = {parity_join.fingerprint(np.arange(n, dtype=np.uint64)) for n in range(1, 2000)}
    assert len(names) == 1999 and {len(n) for n in names} == {12}
    assert parity_join.ENTRY.itemsize == 8 + 12


def test_words_are_lowered_as_ascii_only():
    assert words_of("AbÄ İX\x0bz Q", lower=True) == [w.lower() for w in words_of("AbÄ İX\x0bz Q")]
    assert words_of("Ab c") == [b"Ab", b"c"]
