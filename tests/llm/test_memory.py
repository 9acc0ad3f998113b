"""Memory of the workers' own sorts, against plain ones."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pytest

from chemprobe.llm import suffix_dedup


def _amid(count: int, phrase: bytes, side: int, rng: np.random.Generator) -> list[bytes]:
    """Texts with one phrase amid others; each third shares what comes before it with some more."""
    letters = lambda n: rng.integers(97, 101, n, dtype=np.uint8).tobytes()
    pool = [letters(side) for _ in range(5)]
    return [(pool[i % 5] if i % 3 == 0 else letters(side)) + phrase + letters(side) for i in range(count)]


def _repeated(texts: list[bytes], length: int) -> list[np.ndarray]:
    n = np.array([len(x) for x in texts])
    starts = n - length + 1
    return suffix_dedup.repeated_starts(texts, starts, n, np.ones(len(texts), bool), np.ones(len(texts), np.int64), length)


def test_sort_holds_no_copy_of_all_passages():
    texts = _amid(4000, b"the same phrase in many texts...", 140, np.random.default_rng(3))
    n = sum(map(len, texts))
    tracemalloc.start()
    try:
        _repeated(texts, 200)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 90 * n


@pytest.mark.parametrize("most", [1, 7, 1 << 14])
def test_sort_by_parts_finds_what_counting_finds(monkeypatch, most):
    monkeypatch.setattr(suffix_dedup, "SORTED", most, raising=False)
    length = 43
    texts = _amid(60, b"phrase" * 4, 30, np.random.default_rng(4)) + [b"\0" * 70, b"ab" * 40, b"\xff" * 44, b"\0" * 50]
    seen: dict[bytes, int] = {}
    for x in texts:
        for i in range(len(x) - length + 1):
            seen[x[i : i + length]] = seen.get(x[i : i + length], 0) + 1
    for x, flags in zip(texts, _repeated(texts, length)):
        want = [seen[x[i : i + length]] > 1 for i in range(len(x) - length + 1)]
        assert flags[: len(want)].tolist() == want
