"""Vectorised hashes of words and word shingles for batches of texts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
CHUNK_BYTES = 4_000_000


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit hashes over all bits."""
    h = (h ^ (h >> np.uint64(32))) * _STEP
    h = (h ^ (h >> np.uint64(29))) * _STEP
    return h ^ (h >> np.uint64(32))


def word_hashes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of every text, and the number of the text it stands in.

    Words are runs without ``[\\x20\\x09-\\x0D]``, by their UTF-8 bytes.
    """
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    at = np.flatnonzero(inside)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1] + 1)))
    lengths = np.diff(np.append(starts, len(at)))
    place = np.arange(len(at)) - np.repeat(starts, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), _PRIME))
    hashes = np.add.reduceat((data[at].astype(np.uint64) + np.uint64(1)) * powers[place], starts)
    ends = np.cumsum([len(r) + 1 for r in raw])
    return mix(hashes + lengths.astype(np.uint64)), np.searchsorted(ends, at[starts], side="right")


def shingles(hashes: np.ndarray, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words within a text; a shorter text is one run of all its words."""
    n = len(hashes)
    out = hashes[: max(0, n - size + 1)].copy()
    for k in range(1, size):
        out = mix(out) + hashes[k: n - size + 1 + k] if len(out) else out
    of = text[: len(out)]
    whole = of == text[size - 1:] if len(out) else np.zeros(0, bool)
    out, of = mix(out[whole]), of[whole]
    numbers, first, count = np.unique(text, return_index=True, return_counts=True)
    extra, extra_of = [], []
    for number, a, c in zip(numbers, first, count):
        if c < size:
            h = hashes[a:a + 1]
            for k in range(1, c):
                h = mix(h) + hashes[a + k: a + k + 1]
            extra.append(mix(h + np.uint64(c)))
            extra_of.append(number)
    if extra:
        out, of = np.concatenate([out, *extra]), np.concatenate([of, extra_of])
        order = np.argsort(of, kind="stable")
        out, of = out[order], of[order]
    return out, of


def chunks(texts: Sequence[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``CHUNK_BYTES`` characters, to bound the arrays above."""
    a, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t)
        if size >= CHUNK_BYTES:
            yield a, k + 1
            a, size = k + 1, 0
    if a < len(texts):
        yield a, len(texts)
