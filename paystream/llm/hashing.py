"""Hashes of words and of runs of words, for whole batches of texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Space, tab, line feed, vertical tab, form feed, carriage return, as in ``bytes.split()``.
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_TABLE = np.random.default_rng(20240229).integers(0, 1 << 64, 256, "u8")
_ODD = np.random.default_rng(20240301).integers(0, 1 << 63, 64, "u8") * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 3
_INVERSE = pow(_BASE, -1, 1 << 64)
_CHUNK = 1 << 18
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """``base`` to the 0, 1, ... modulo 2 ** 64, at least ``n`` of them."""
    held = _POWERS.get(base, np.ones(1, "u8"))
    while len(held) < n:
        held = np.concatenate([held, held * np.uint64(pow(base, len(held), 1 << 64))])
    _POWERS[base] = held
    return held


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; a bijection."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash_chunk(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of some bytes."""
    blank = _BLANK[data]
    edge = np.diff(blank.view("i1"), prepend=1, append=1)
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return starts, np.zeros(0, "u8")
    sums = np.zeros(len(data) + 1, "u8")
    np.cumsum(_TABLE[data] * _powers(_BASE, len(data))[:len(data)], out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * _powers(_INVERSE, len(data))[starts])


def _pieces(text: bytes) -> Iterator[bytes]:
    """Parts of a text of about a chunk, cut at blanks only."""
    at = 0
    while len(text) - at > _CHUNK:
        end = max(text.rfind(c, at, at + _CHUNK) for c in (b" ", b"\n", b"\t"))
        if end < at:
            end = min((e for c in (b" ", b"\n", b"\t") if (e := text.find(c, at + _CHUNK)) >= 0), default=len(text))
        yield text[at:end]
        at = end
    yield text[at:]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of ``texts`` in order, and where each text starts in them.

    The second array has one more entry, the number of words.
    """
    hashes: list[np.ndarray] = []
    counts = np.zeros(len(texts) + 1, "i8")
    held: list[tuple[int, bytes]] = []
    size = 0

    def flush() -> None:
        data = np.frombuffer(b" ".join(x for _, x in held), "u1")
        starts, found = _hash_chunk(data)
        hashes.append(found)
        ends = np.cumsum([len(x) + 1 for _, x in held])
        np.add.at(counts, [k + 1 for k, _ in held], np.diff(np.searchsorted(starts, ends), prepend=0))

    for k, text in enumerate(texts):
        for piece in _pieces(text):
            held.append((k, piece))
            size += len(piece)
            if size >= _CHUNK:
                flush()
                held, size = [], 0
    if held:
        flush()
    return np.concatenate(hashes) if hashes else np.zeros(0, "u8"), np.cumsum(counts)


def run_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words; one for every word that starts such a run."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, "u8")
    total = np.zeros(n, "u8")
    for k in range(width):
        total += words[k:k + n] * _ODD[k % 64] ^ np.uint64(k)
    return mix(total)
