"""Sets of hashed word shingles of whole texts, many texts at a time in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, np.uint64)
_INVERSES = np.ones(1, np.uint64)
_PLACES = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x2127599BF4325C37], np.uint64)


def _byte_values() -> np.ndarray:
    """A random 64-bit number for each byte; A-Z share those of a-z."""
    values = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    values[65:91] = values[97:123]
    return values


_VALUES = _byte_values()


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n``."""
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        size = 1 << (n - 1).bit_length()
        inverse = pow(int(_BASE), -1, 1 << 64)
        _POWERS = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, _BASE)]).astype(np.uint64))
        _INVERSES = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, np.uint64(inverse))]).astype(np.uint64))
    return _POWERS, _INVERSES


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word of all texts, first word of each text and the end)."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    space = _SPACES[data]
    edge = np.flatnonzero(np.diff(space, prepend=True))
    starts, ends = edge[0::2], edge[1::2]
    powers, inverses = _powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * powers[: len(data)], out=sums[1:])
    words = mixed((sums[ends] - sums[starts]) * inverses[starts])
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    text_starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    return words, np.searchsorted(starts, text_starts)


def shingle_sets(texts: list[str | None], width: int) -> Iterator[np.ndarray]:
    """The sorted distinct hashes of each text's runs of ``width`` words.

    A text of fewer words has one, over the whole sequence; a text without words has none.
    """
    words, firsts = word_hashes([(t or "").encode() for t in texts])
    places = _PLACES[:width] if width <= len(_PLACES) else mixed(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    with np.errstate(over="ignore"):
        if len(words) >= width:
            runs = words[: len(words) - width + 1] * places[0]
            for i in range(1, width):
                runs = runs + words[i : len(words) - width + 1 + i] * places[i]
            runs = mixed(runs)
        for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
            n = b - a
            if n >= width:
                own = np.sort(runs[a : b - width + 1])
                yield own[np.concatenate([[True], own[1:] != own[:-1]])]
            elif n:
                total = (words[a:b] * places[:n]).sum(dtype=np.uint64) + np.uint64(n) * np.uint64(0xF1357AEA2E62A9C5)
                yield mixed(np.array([total]))
            else:
                yield words[:0]
