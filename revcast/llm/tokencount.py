"""Token counts of a SentencePiece BPE model by rank-synchronous merging.

A text (blanks written as the model writes them, one more in front) falls into
pre-tokens that no piece of the model crosses: blanks with the letters after
them, and single characters that no longer piece holds. Pre-tokens of a batch
of texts that aren't known yet are laid end to end as one ragged array of
symbols. In each round every sequence applies its lowest-rank pair at all its
places at once, the leftmost of overlapping ones; sequences without a pair
leave. What survives is counted: one token a symbol, one a byte for a
character the model doesn't know.

Applying all places at once equals one at a time, leftmost first, unless a new
symbol forms a pair of the same or a lower rank at once (runs of blanks, whose
pieces share one rank). Such a sequence, and one of over ``LONG`` symbols, is
finished with a queue of pairs: the same merges in n log n steps.

Defined results: a null or empty text has no bytes and no tokens; repeated and
null ids get a row each; an empty table gives none; other columns are ignored.
Special strings inside a text are plain text. A text is never cut: it is read
in blocks that end between pre-tokens.

Scale: one Arrow pass where the documents are read, no shuffle. A task holds
one batch of texts, the model's pairs and ``KNOWN`` counts of pre-tokens, which
are dropped when full.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare

#: A blank inside the model.
BLANK = "▁"
#: Pre-token counts that a task remembers.
KNOWN = 400_000
#: Characters of text whose pre-tokens are merged together.
BLOCK = 1 << 21
#: Symbols from which a sequence has a queue of its own.
LONG = 512

NONE = np.iinfo(np.int32).max


class Pairs:
    """The merges of a model: rank and result of each pair of symbols. Equal
    scores have equal ranks. Symbol 0 is any character outside the model."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        score = {
            model.id_to_piece(i): model.get_score(i)
            for i in range(model.get_piece_size())
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        }
        symbols = ["", *sorted(score.keys() | set("".join(score)))]
        number = {s: i for i, s in enumerate(symbols)}
        level = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        merges = sorted(
            (number[p[:k]] * len(symbols) + number[p[k:]], level[s], number[p])
            for p, s in score.items()
            for k in range(1, len(p))
            if p[:k] in number and p[k:] in number
        )
        self.size = len(symbols)
        self.key, rank, result = (np.array(c, np.int64) for c in zip(*merges))
        self.rank, self.result = rank.astype(np.int32), result.astype(np.int32)
        self.of = {k: (r, p) for k, r, p in merges}
        #: Tokens that a symbol counts if it stays.
        self.tokens = np.array([0] + [1 if s in score else len(s.encode()) for s in symbols[1:]], np.int64)
        singles = [s for s in symbols if len(s) == 1]
        self.char = np.array([ord(s) for s in singles], np.uint32)
        self.symbol = np.array([number[s] for s in singles], np.int32)
        letters = re.escape("".join(sorted(set("".join(p for p in score if len(p) > 1)) - {BLANK})))
        if any(BLANK in p.lstrip(BLANK) for p in score):
            raise ValueError("a piece holds a blank behind a letter")
        self.pretokens = re.compile(f"{BLANK}*[{letters}]+|{BLANK}+|[^{letters}{BLANK}]")

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, result) of each pair; rank NONE where there is none."""
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        found = self.key[at] == key
        return np.where(found, self.rank[at], NONE), self.result[at]

    def counts(self, pretokens: list[str]) -> np.ndarray:
        """Tokens of each pre-token."""
        out = np.zeros(len(pretokens), np.int64)
        length = np.fromiter(map(len, pretokens), np.int64, len(pretokens))
        code = np.frombuffer("".join(pretokens).encode("utf-32-le"), np.uint32)
        at = np.minimum(np.searchsorted(self.char, code), len(self.char) - 1)
        known = self.char[at] == code
        symbol = np.where(known, self.symbol[at], 0).astype(np.int32)
        owner = np.repeat(np.arange(len(pretokens)), length)
        width = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
        np.add.at(out, owner[~known], width[~known])
        long = length > LONG
        for i in np.flatnonzero(long):
            out[i] += self.queued(symbol[owner == i].tolist())
        keep = ~long[owner]
        symbol, owner = symbol[keep], owner[keep]
        while len(symbol):
            symbol, owner = self.step(symbol, owner, out)
        return out

    def step(self, symbol: np.ndarray, owner: np.ndarray, out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One round over all sequences; finished ones are added to ``out``
        and left away."""
        n = len(symbol)
        rank = np.full(n, NONE, np.int32)
        inside = owner[1:] == owner[:-1]
        ranks, results = self.lookup(symbol[:-1], symbol[1:])
        rank[:-1] = np.where(inside, ranks, NONE)
        first = np.flatnonzero(np.concatenate(([True], ~inside)))
        size = np.diff(np.append(first, n))
        least = np.repeat(np.minimum.reduceat(rank, first), size)
        chosen = (rank == least) & (rank != NONE)
        # overlapping places: every second one of a run, from its first
        place = np.arange(n)
        start = np.maximum.accumulate(np.where(chosen & ~np.concatenate(([False], chosen[:-1])), place, 0))
        spots = np.flatnonzero(chosen & ((place - start) % 2 == 0))
        merged = symbol.copy()
        merged[spots] = results[spots]
        gone = np.zeros(n, bool)
        gone[spots + 1] = True
        # a new symbol that pairs at once, at this rank or a lower one, needs the queue
        clash = np.zeros(n, bool)
        after = spots + 2
        ok = (after < n) & (owner[np.minimum(after, n - 1)] == owner[spots])
        near, _ = self.lookup(merged[spots[ok]], symbol[after[ok]])
        clash[spots[ok]] = near <= rank[spots[ok]]
        before = spots - 1
        ok = (before >= 0) & (owner[before] == owner[spots])
        before = np.where(gone[before], before - 1, before)
        near, _ = self.lookup(merged[before[ok]], merged[spots[ok]])
        clash[spots[ok]] |= near <= rank[spots[ok]]
        done = least == NONE
        if clash.any():
            clashing = np.unique(owner[clash])
            for i in clashing:
                a, b = np.searchsorted(owner, [i, i + 1])
                out[i] += self.queued(symbol[a:b].tolist())
            gone |= np.isin(owner, clashing)
        np.add.at(out, owner[done], self.tokens[symbol[done]])
        keep = ~(done | gone)
        return merged[keep], owner[keep]

    def queued(self, symbol: list[int]) -> int:
        """Tokens of one sequence, merged pair by pair, leftmost first."""
        n = len(symbol)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(a: int, b: int) -> None:
            found = self.of.get(symbol[a] * self.size + symbol[b])
            if found:
                heap.append((found[0], a, symbol[a], symbol[b]))

        for i in range(n - 1):
            offer(i, i + 1)
        heapq.heapify(heap)
        while heap:
            _, a, left, right = heapq.heappop(heap)
            b = after[a]
            if symbol[a] != left or b >= n or symbol[b] != right:
                continue  # one of them was merged since
            symbol[a], symbol[b] = self.of[left * self.size + right][1], -1
            after[a] = after[b]
            if after[b] < n:
                before[after[b]] = a
            for x, y in ((before[a], a), (a, after[a])):
                if 0 <= x and y < n:
                    found = self.of.get(symbol[x] * self.size + symbol[y])
                    if found:
                        heapq.heappush(heap, (found[0], x, symbol[x], symbol[y]))
        return int(self.tokens[[s for s in symbol if s >= 0]].sum())


@lru_cache(1)
def loaded(path: str) -> Pairs:
    """A worker reads a model once for all its tasks."""
    return Pairs(path)


_WORD_START = re.compile(f"[^{BLANK}]{BLANK}")


def parts(text: str) -> Iterator[str]:
    """The text as the model sees it, in blocks that end before a blank."""
    if not text:
        return
    text = BLANK + text.replace(" ", BLANK)
    start = 0
    while len(text) - start > BLOCK:
        cut = _WORD_START.search(text, start + BLOCK)
        if not cut:
            break
        yield text[start : cut.start() + 1]
        start = cut.start() + 1
    yield text[start:]


def count(
    documents: DataFrame, model: str, limit: int = 4096, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row a document: doc_id, n_bytes (UTF-8), n_tokens, over_limit."""
    prepare(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = loaded(model)
        known: dict[str, int] = {}
        for batch in batches:
            n_tokens = np.zeros(batch.num_rows, np.int64)
            held: list[tuple[int, list[str]]] = []
            size = 0

            def settle() -> None:
                if len(known) > KNOWN:
                    known.clear()
                new = list({t for _, ts in held for t in ts} - known.keys())
                if new:
                    known.update(zip(new, pairs.counts(new).tolist()))
                for i, ts in held:
                    n_tokens[i] += sum(map(known.__getitem__, ts))

            for i, t in enumerate(batch.column(2).to_pylist()):
                for part in parts(t or ""):
                    held.append((i, pairs.pretokens.findall(part)))
                    size += len(part)
                    if size > BLOCK:
                        settle()
                        held, size = [], 0
            settle()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n_tokens), pa.array(n_tokens > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    body = F.coalesce(F.col(text), F.lit(""))
    rows = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.octet_length(body).cast("long").alias("n_bytes"), body.alias("text")
    )
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
