"""Byte n-grams within words, for the language and toxicity models.

A text becomes `` word word ... `` (see ``ALNUM``), one space around each
word. Every byte after the first space is predicted from the bytes before it
back to the space that starts its word, ``order - 1`` at most; the space that
ends a word is predicted too. A gram is packed into an integer, the predicted
byte lowest: ``gram >> 8`` is its context, without its top byte it is the
next shorter gram. Grams cut off at a word's start have the space on top.
"""

from __future__ import annotations

import numpy as np

from .common import ALNUM, U64, mix


class Grams:
    """Grams of a block of texts laid end to end.

    ``first[d]:first[d + 1]`` are the grams of text ``d``; ``word`` is the
    running number of each gram's word, ``words[d]`` the first of text ``d``.
    """

    def __init__(self, items: list[bytes | None], order: int):
        plain = [b" ".join((t or b"").translate(ALNUM).split()) for t in items]
        raw = np.frombuffer(b" " + b" ".join(p + b" " if p else b"" for p in plain), np.uint8)
        # a text's part is its words, each with the space after it; the extra
        # space that join() puts between texts starts the next one
        size = np.array([len(p) + 1 if p else 0 for p in plain], np.int64)
        at = 1 + np.concatenate(([0], np.cumsum(size + 1)))[:-1]
        keep = np.ones(len(raw), bool)
        keep[0] = False
        keep[(at[1:] - 1)] = False
        space = raw == 32
        last = np.maximum.accumulate(np.where(space, np.arange(len(raw)), 0))
        before = np.concatenate(([0], last[:-1]))  # the space that starts the word
        depth = np.minimum(np.arange(len(raw)) - before + 1, order)
        code = raw.astype(U64)
        for k in range(1, order):
            shifted = np.zeros(len(raw), U64)
            shifted[k:] = raw[:-k].astype(U64) << U64(8 * k)
            code |= np.where(depth > k, shifted, U64(0))
        self.code, self.order = code[keep], depth[keep]
        self.first = np.concatenate(([0], np.cumsum(size)))
        ends = space[keep]
        self.word = np.cumsum(ends) - ends
        total = np.concatenate(([0], np.cumsum(ends)))
        self.words = total[self.first]

    def sums(self, value: np.ndarray) -> np.ndarray:
        """Sum of ``value`` (one per gram) over each word."""
        starts = np.flatnonzero(np.concatenate(([True], self.word[1:] != self.word[:-1]))) if len(self.word) else []
        return np.add.reduceat(value, starts, axis=0) if len(starts) else value


def slots(code: np.ndarray, bits: int) -> np.ndarray:
    """Place of each gram in a table of ``2 ** bits``."""
    return (mix(code) >> U64(64 - bits)).astype(np.int64)
