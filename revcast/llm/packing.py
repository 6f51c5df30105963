"""Packing token sequences by Karmarkar-Karp multiway differencing.

A document's ids (ending with the separator id) are cut into pieces: whole
windows first, what is left into pieces of at most ``PIECE`` ids, so that the
differencing has enough small parts to level with. Pieces gather until they
fill ``GROUP`` windows; the differencing then deals them to that many
windows, always merging the two partial partitions whose imbalance is
largest, the fullest windows of one with the emptiest of the other. Where a
window would exceed the capacity, the number of windows rises by one and the
group is dealt again, until all fit.

Defined results: a null or empty text is the separator alone; rows with null
or repeated ids are packed one by one; other columns are ignored; an empty
table gives no pieces.

Scale: tokenising and packing happen in one pass where the documents are
read; a group is ``GROUP`` windows, so a task holds some 500,000 ids at a
time besides one text. Only the last group of an input partition is not full.
``sequence_id`` is the partition number times 2^40 plus a running number.
"""

from __future__ import annotations

import heapq
import itertools
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare

WINDOW = 2048
#: Separator that ends every document.
END = 1
#: Windows dealt together.
GROUP = 256
#: Largest piece of what a document has beyond whole windows.
PIECE = 512
#: Ids that a group leaves free for each window, so that near-equal ones fit.
SLACK = 1

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def deal(sizes: list[int], windows: int) -> list[tuple[int, list[int]]]:
    """Multiway differencing: ``windows`` lists of positions in ``sizes`` with
    near-equal sums, as (sum, positions). Ties go to the smaller position."""
    heap = [(-s, i, [(s, [i])]) for i, s in enumerate(sizes)]
    if windows == 1:
        return [(sum(sizes), list(range(len(sizes))))]
    heapq.heapify(heap)
    order = itertools.count(len(sizes))
    while len(heap) > 1:
        # partial partitions, fullest window first; empty windows aren't listed
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        both = len(a) + len(b) - windows
        if both <= 0:
            merged = a + b
        else:
            apart = windows - len(b)  # the fullest of a meet empty windows of b
            merged = a[:apart] + b[: windows - len(a)]
            merged += [(x[0] + y[0], x[1] + y[1]) for x, y in zip(a[apart:], reversed(b[windows - len(a) :]))]
        merged.sort(key=lambda w: -w[0])
        spread = merged[0][0] - (merged[-1][0] if len(merged) == windows else 0)
        heapq.heappush(heap, (-spread, next(order), merged))
    return heap[0][2] if heap else []


def pack(sizes: list[int], capacity: int) -> list[tuple[int, list[int]]]:
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        dealt = deal(sizes, windows)
        if max((w[0] for w in dealt), default=0) <= capacity:
            return dealt
        windows += 1


def cut(n: int, window: int, piece: int) -> tuple[int, list[tuple[int, int]]]:
    """(whole windows, further pieces as (start, length)) of ``n`` ids."""
    whole, rest = divmod(n, window)
    return whole, [(a, min(piece, n - a)) for a in range(n - rest, n, piece)]


def encoder(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a ``tokenizers`` file as merge ranks: the same
    ids, several times as fast. Added tokens keep their ids and meaning."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    byte_of = {chr(c): b for b, c in _byte_chars().items()}
    added = {t["content"]: t["id"] for t in model["added_tokens"]}
    ranks = {
        bytes(byte_of[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in added
    }
    return tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)


#: Fixed value: how byte-level BPE splits text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


#: White space in a row that the fast encoder's pattern can't step back over;
#: such a text goes through ``tokenizers`` itself.
LONG_SPACE = 20_000
_LONG_SPACE = re.compile(rf"\s{{{LONG_SPACE}}}")


def _byte_chars() -> dict[int, int]:
    """Byte to code point as byte-level vocabularies write it: printable ones
    as themselves, the others from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 256 + i for i, b in enumerate(rest)}


def pack_documents(
    documents: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
    window: int = WINDOW, end: int = END, group: int = GROUP, piece: int = PIECE, with_ids: bool = False,
) -> DataFrame:
    """One row per piece: its place in the document and in a sequence; with
    ``with_ids`` the ids too."""
    prepare(documents.sparkSession)
    schema = SCHEMA + (", ids array<int>" if with_ids else "")
    limit = group * (window - SLACK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoder(tokenizer)
        plain = None
        special = encoding.special_tokens_set
        context = TaskContext.get()
        sequence = itertools.count((context.partitionId() if context else 0) << 40)
        pending: list[tuple] = []
        held = 0

        def row(doc, ids, start, length, seq, offset):
            part = ids[start : start + length]
            out = (doc, start, length, zlib.crc32(part.tobytes()), len(ids), seq, offset)
            return (*out, part) if with_ids else out

        def flush() -> Iterator[tuple]:
            nonlocal pending, held
            for _, own in pack([p[3] for p in pending], window) if pending else []:
                seq, offset = next(sequence), 0
                for i in sorted(own):
                    yield row(*pending[i], seq, offset)
                    offset += pending[i][3]
            pending, held = [], 0

        def encoded(t: str) -> np.ndarray:
            nonlocal plain
            if len(t) > LONG_SPACE and _LONG_SPACE.search(t):
                plain = plain or tokenizers.Tokenizer.from_file(tokenizer)
                return np.array(plain.encode(t, add_special_tokens=False).ids, np.uint32)
            return encoding.encode_to_numpy(t, allowed_special=special)

        def pieces(batch: pa.RecordBatch) -> Iterator[tuple]:
            nonlocal held
            for doc, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.append(encoded(t or ""), end).astype("<u4")
                whole, rest = cut(len(ids), window, piece)
                for i in range(whole):
                    yield row(doc, ids, i * window, window, next(sequence), 0)
                for start, length in rest:
                    while held + length > limit:  # fill the group to the brim
                        room = limit - held
                        if room:
                            pending.append((doc, ids, start, room))
                        start, length = start + room, length - room
                        yield from flush()
                    if length:
                        pending.append((doc, ids, start, length))
                        held += length

        kinds = [pa.int64()] * 7 + [pa.list_(pa.int32())] * with_ids
        names = [c.split()[0] for c in schema.split(", ")]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

        for batch in batches:
            yield out(list(pieces(batch)))
        yield out(list(flush()))

    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, schema)
