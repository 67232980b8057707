"""Fast encoding with a public tokenizer: every word is encoded once per worker.

A tokenizer first cuts a text into words and marks and then encodes each by itself. For
texts of Latin letters, digits, ASCII marks and blanks that cut is made here, by the pattern
the vocabulary comes with, and the ids of a word are remembered. Any other text goes to the
tokenizer as a whole, so the result is the same.
"""

from __future__ import annotations

import os
import re
from collections.abc import Sequence

import numpy as np

CACHE_ENTRIES = 800_000  # words a worker remembers for one tokenizer
GROUP_CHARS = 2_000_000  # texts of about this size are cut together

# fixed values: the public patterns of the two vocabularies, for the characters named above
_LETTERS = "a-zA-ZÀ-ÖØ-öø-ÿ"
_MARKS = r"!-/:-@\[-`{-~"
BYTE_LEVEL = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[{_MARKS}]+|[ \n\t\r]+(?![^ \n\t\r])|[ \n\t\r]+")
WORD_LEVEL = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[{_MARKS}]+")  # drops blanks


class Encoder:
    """Ids of texts as little-endian bytes of ``dtype``."""

    def __init__(self, path: str, pattern: re.Pattern, dtype: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # their strings in a text become ids of their own, so such a text goes to the tokenizer as a whole
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pattern, self.dtype = pattern, dtype
        self.lower = pattern is WORD_LEVEL
        # what can stand before a word without a space, and whether it has ids of its own
        self.gap, self.gap_counts = (" ", 0) if self.lower else ("\n", 1)
        self.known: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in found]

    def _learn(self, parts: set[str]) -> None:
        words = [p for p in parts if p.removeprefix(" ").isalpha()]
        others = [p for p in parts if not p.removeprefix(" ").isalpha()]
        self.known.update(zip(others, self._whole(others)))
        texts, places, k = [], [], 0
        for w in words:
            if w[0] != " ":
                texts.append(self.gap)
                k += self.gap_counts
            texts.append(w)
            places.append(k)
            k += 1
        if words:
            e = self.tokenizer.encode("".join(texts), add_special_tokens=False)
            of, ids = np.array(e.word_ids), np.array(e.ids, dtype=self.dtype)
            starts, ends = np.searchsorted(of, places).tolist(), np.searchsorted(of, places, "right").tolist()
            self.known.update((w, ids[a:b].tobytes()) for w, a, b in zip(words, starts, ends))

    def _group(self, texts: list[str]) -> list[bytes]:
        flat = [t.lower() for t in texts] if self.lower else texts
        cut = [self.pattern.findall(t) for t in flat]
        blanks = (lambda t: sum(map(t.count, " \n\t\r"))) if self.lower else (lambda t: 0)
        plain = [sum(map(len, parts)) + blanks(t) == len(t) and not any(x in t or x in raw for x in self.special)
                 for parts, t, raw in zip(cut, flat, texts)]
        new = set().union(*[parts for parts, ok in zip(cut, plain) if ok]).difference(self.known)
        full = len(self.known) + len(new) > CACHE_ENTRIES
        self._learn(new)
        get = self.known.__getitem__
        out = [b"".join(map(get, parts)) if ok else self._whole([t])[0] for parts, ok, t in zip(cut, plain, texts)]
        if full:  # the words met first are mostly the frequent ones; later ones are not kept
            for part in new:
                del self.known[part]
        return out

    def __call__(self, texts: Sequence) -> list[bytes]:
        """The ids of each text; anything but a string counts as an empty text."""
        out: list[bytes] = []
        held, size = [], 0
        for t in texts:
            held.append(t if isinstance(t, str) else "")
            size += len(held[-1])
            if size >= GROUP_CHARS:
                out += self._group(held)
                held, size = [], 0
        return out + self._group(held) if held else out


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str, pattern: re.Pattern, dtype: str) -> Encoder:
    """This worker's encoder; what it has learnt lasts from task to task."""
    key = (path, pattern.pattern, dtype)
    if key not in _encoders:
        _encoders[key] = Encoder(path, BYTE_LEVEL if pattern.pattern == BYTE_LEVEL.pattern else WORD_LEVEL, dtype)
    return _encoders[key]
