"""Token counts against the library itself."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from revcast.llm import tokencount

from .fixtures import AWKWARD, SCHEMA, collected, frame

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def counted(text: str) -> int:
    pairs = tokencount.loaded(MODEL)
    tokens = [t for part in tokencount.parts(text) for t in pairs.pretokens.findall(part)]
    return int(pairs.counts(tokens).sum()) if tokens else 0


def test_random_texts(library):
    rng = random.Random(4)
    alphabet = " " * 6 + "aabetnoishr.\n\t,-_=#/éß漢　😀▁0123\0"
    for _ in range(4000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(80)))
        assert counted(text) == len(library.encode(text)), repr(text)


@pytest.mark.parametrize(
    "text",
    ["<s> </s> <unk> <0x0A>", " " * 1001, "\n" * 700, "a" * 5000, "the" * 900, "=-" * 2000, "ab" * 511 + " " * 33 + "x", "漢字" * 600],
)
def test_special_strings_and_long_runs(library, text):
    assert counted(text) == len(library.encode(text))


def test_rounds_agree_with_the_queue():
    pairs, rng = tokencount.loaded(MODEL), random.Random(5)
    tokens = ["".join(rng.choice("▁▁aeinrst.=-") for _ in range(rng.randrange(1, 60))) for _ in range(800)]
    number = {chr(c): s for c, s in zip(pairs.char.tolist(), pairs.symbol.tolist())}
    assert pairs.counts(tokens).tolist() == [pairs.queued([number[c] for c in t]) for t in tokens]


def test_blocks_and_forgetting_change_nothing(spark, library, monkeypatch):
    monkeypatch.setattr(tokencount, "BLOCK", 50)
    text = "Some words, and  more\nwords; " * 40
    assert "".join(tokencount.parts(text)) == "▁" + text.replace(" ", "▁")
    assert len(list(tokencount.parts(text))) > 10
    assert counted(text) == len(library.encode(text))


def test_awkward_rows(spark, library):
    got = collected(tokencount.count(frame(spark, AWKWARD), MODEL, limit=3), "doc_id", "n_bytes", "n_tokens", "over_limit")
    want = []
    for i, t in AWKWARD:
        n = len(library.encode(t or ""))
        want.append((i, len((t or "").encode()), n, n > 3))
    assert got == sorted(want, key=repr)


def test_empty_table(spark):
    assert tokencount.count(spark.createDataFrame([], SCHEMA), MODEL).collect() == []


def test_whole_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r.n_tokens for r in tokencount.count(docs, MODEL).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert got == {r.doc_id: len(library.encode(r.text or "")) for r in rows}


def test_very_long_text(spark, library):
    text = " " * 200_000 + "x" * 100_000 + " and so on" * 100_000
    got = tokencount.count(frame(spark, [(1, text)]), MODEL).collect()[0]
    assert got.n_tokens == len(library.encode(text)) and got.over_limit
    assert np.int64(got.n_bytes) == len(text)
