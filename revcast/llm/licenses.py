"""Fuzzy search for short licence notices.

Exact phrases give the base labels. Each further notice (below) may differ
from its wording by a few characters: split into ``errors + 1`` pieces, at
least one piece must stand unchanged (pigeonhole), so only texts holding a
piece are looked at, and only around it; the ``regex`` library then matches
the notice with at most ``errors`` edits and reports the span and its edits.

Defined results: a null text is an empty one, with no words and no labels;
rows with null or repeated ids are judged one by one; other columns are
ignored. Texts are scanned whole, where they are read, with no shuffle.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, prepare, texts

#: Phrases of the base labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Notices found with edits: normalised wording, label. The number of edits
#: allowed is one per ``LETTERS_PER_EDIT`` letters.
NOTICES = {
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "licensed under the apache license version 2 0": "apache",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "licensed under cc by sa": "cc-by-sa",
    "licensed under cc by nc": "cc-by-nc",
    "creative commons attribution": "cc-by",
    "mozilla public license": "mpl",
    "all rights reserved": "all-rights-reserved",
    "this work is in the public domain": "public-domain",
}
LETTERS_PER_EDIT = 9

SPAN = "array<struct<label:string,first_char:long,last_char:long,edits:long>>"
SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
    f"labels string, score double, notices {SPAN}"
)


def pieces(notice: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` consecutive pieces of near-equal length with their start."""
    cut = [round(i * len(notice) / (errors + 1)) for i in range(errors + 2)]
    return [(a, notice[a:b]) for a, b in zip(cut, cut[1:])]


class Notice:
    def __init__(self, wording: str, label: str):
        self.label, self.wording = label, wording
        self.errors = max(1, len(wording.replace(" ", "")) // LETTERS_PER_EDIT)
        self.seeds = [(at, p.encode()) for at, p in pieces(wording, self.errors)]
        # whole words only: edits may not run into the neighbouring word
        self.pattern = regex.compile(rf"(?b)(?<= )(?:{regex.escape(wording)}){{e<={self.errors}}}(?= )".encode())

    def find(self, plain: bytes) -> list[tuple[int, int, int]]:
        """(start, end, edits) in a normalised text: the best match around
        each place of a seed, so that a damaged copy beside a clean one is
        found too. Finds may overlap."""
        reach, places = len(self.wording) + self.errors + 2, set()
        for at, seed in self.seeds:
            i = plain.find(seed)
            while i >= 0:
                places.add((max(0, i - at - self.errors - 1), i + reach - at))
                i = plain.find(seed, i + 1)
        out = set()
        for a, b in places:
            m = self.pattern.search(plain, pos=a, endpos=min(b, len(plain)))
            if m:
                out.add((m.start(), m.end(), sum(m.fuzzy_counts)))
        return sorted(out)


def base_places(plain: bytes) -> list[tuple[int, str]]:
    """(first word, label) of every place where a base phrase stands."""
    out = []
    for phrase, label in BASE.items():
        probe = b" " + phrase.encode() + b" "
        i, seen, word = plain.find(probe), 0, 0
        while i >= 0:
            word += plain.count(b" ", seen, i)
            out.append((word, label))
            seen, i = i, plain.find(probe, i + 1)
    return out


def closest(found: list[tuple]) -> list[tuple]:
    """Of overlapping finds the one with fewest edits, then the longest, then
    the first by label; left to right."""
    kept: list[tuple] = []  # by start; they don't overlap, so ends are in order too
    for f in sorted(found, key=lambda f: (f[3], f[1] - f[2], f[0].label, f[1])):
        i = bisect.bisect_left(kept, f[1], key=lambda k: k[1])
        if (i == 0 or kept[i - 1][2] <= f[1]) and (i == len(kept) or f[2] <= kept[i][1]):
            kept.insert(i, f)
    return kept


def char_ranges(text: bytes, plain: bytes, places: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character ranges in ``text`` of the words at ``plain[a:b]`` of each
    place; both texts are gone through once."""
    if not places:
        return []
    words = [m.span() for m in regex.finditer(rb"[^ ]+", text.translate(ALNUM))]
    blanks = np.flatnonzero(np.frombuffer(plain, np.uint8) == 32)
    chars = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    out = []
    for at, end in places:
        first = int(np.searchsorted(blanks, at)) - 1
        last = first + plain[at:end].strip().count(b" ")
        out.append((int(chars[words[first][0]]), int(chars[words[last][1]])))
    return out


def judge(text: bytes | None, notices: list[Notice]) -> tuple:
    text = text or b""
    plain = b" " + b" ".join(text.translate(ALNUM).split()) + b" "
    n_words = 0 if plain == b"  " else plain.count(b" ") - 1
    base = base_places(plain)
    found = []
    for notice in notices:
        for a, b, edits in notice.find(plain):
            found.append((notice, a, b, edits))
    found = closest(found)
    spans = [
        {"label": notice.label, "first_char": c, "last_char": d, "edits": edits}
        for (notice, _, _, edits), (c, d) in zip(found, char_ranges(text, plain, [(a, b) for _, a, b, _ in found]))
    ]
    base_labels = {label for _, label in base}
    labels = base_labels | {s["label"] for s in spans}
    if base:
        score = 1.0
    else:
        score = max((1 - edits / len(n.wording) for n, _, _, edits in found), default=0.0)
    at = [p for p, _ in base]
    return (
        n_words, len(base), min(at, default=None), max(at, default=None), ",".join(sorted(base_labels)),
        ",".join(sorted(labels)), score, spans,
    )


def search(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", notices: dict[str, str] = NOTICES) -> DataFrame:
    """One row per document row: counts and labels of base phrases, labels
    with the fuzzy notices', and every notice with its span in the original
    text and its number of edits."""
    prepare(documents.sparkSession)
    kinds = SCHEMA

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [Notice(w, label) for w, label in notices.items()]
        span = pa.list_(pa.struct([("label", pa.string()), *((k, pa.int64()) for k in ("first_char", "last_char", "edits"))]))
        types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), span]
        names = [c.split()[0] for c in kinds.split(", ")]
        for batch in batches:
            rows = [judge(t, known) for t in texts(batch.column(1))]
            cols = [pa.array([r[i] for r in rows], k) for i, k in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names)

    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, kinds)
