import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from revcast.llm import packing as P

from .fixtures import AWKWARD, SCHEMA, frame, prose

FILE = public_tokenizers.path("byte_bpe_50k.json")


def documents():
    rng = random.Random(5)
    docs = AWKWARD + [(100 + i, prose(rng, rng.choice([1, 3, 10, 60, 200, 900]))) for i in range(120)]
    return docs + [(90, "a <|endoftext|> b\r\n  　x'll 12 ½ 👍🏽"), (91, prose(rng, 6000))]


def test_pieces_are_the_documents(spark):
    docs = documents()
    tok = Tokenizer.from_file(FILE)
    want = sorted(tok.encode(t or "", add_special_tokens=False).ids + [1] for _, t in docs)
    rows = P.pack_documents(frame(spark, docs).repartition(3), FILE, with_ids=True).collect()
    sequences, by_doc = {}, {}
    for r in rows:
        assert r["length"] == len(r["ids"]) > 0
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append((r["start"], r["doc_tokens"], r["ids"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= P.WINDOW
    # documents of unique id: the pieces in order are their ids
    tokens = {i: tok.encode(t or "", add_special_tokens=False).ids + [1] for i, t in docs if i and i != 7}
    for i, ids in tokens.items():
        parts = sorted(by_doc[i])
        assert [x for _, _, p in parts for x in p] == ids and {n for _, n, _ in parts} == {len(ids)}
        assert [s for s, _, _ in parts] == list(np.cumsum([0] + [len(p) for _, _, p in parts[:-1]]))
    assert sum(r["length"] for r in rows) == sum(map(len, want))


def test_little_padding(spark):
    rng = random.Random(6)
    docs = [(i, prose(rng, rng.randrange(1, 1200))) for i in range(400)]
    rows = P.pack_documents(frame(spark, docs).coalesce(1), FILE).collect()
    used = sum(r["length"] for r in rows)
    assert used > 0.98 * P.WINDOW * len({r["sequence_id"] for r in rows})


def test_same_ids_as_the_tokenizer_on_real_texts(spark):
    texts = [r[0] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    tok, own = Tokenizer.from_file(FILE), P.encoder(FILE)
    for t, e in zip(texts, tok.encode_batch(texts, add_special_tokens=False)):
        assert own.encode(t, allowed_special="all") == e.ids


def test_differencing_levels_and_counts_windows_up():
    rng = random.Random(7)
    for _ in range(50):
        sizes = [rng.randrange(1, 60) for _ in range(rng.randrange(1, 80))]
        windows = rng.randrange(1, 12)
        dealt = P.deal(sizes, windows)
        assert sorted(i for _, own in dealt for i in own) == list(range(len(sizes)))
        assert all(s == sum(sizes[i] for i in own) for s, own in dealt) and len(dealt) <= windows
        packed = P.pack(sizes, 64)
        assert max(s for s, _ in packed) <= 64 and len(packed) >= -(-sum(sizes) // 64)
    assert sorted(s for s, _ in P.deal([8, 7, 6, 5, 4], 2)) == [14, 16]
    assert len(P.pack([5, 5, 5], 8)) == 3  # 15 ids would need 2 windows


def test_empty_table(spark):
    assert P.pack_documents(spark.createDataFrame([], SCHEMA), FILE).count() == 0


def test_long_white_space(spark):
    texts = ["a" + " " * 2_000_000 + "b", "\n" * 1_000_000, "x" + "\t \n" * 20_000 + "<|endoftext|> y"]
    tok = Tokenizer.from_file(FILE)
    got = {r["doc_id"]: r["doc_tokens"] for r in P.pack_documents(frame(spark, list(enumerate(texts))), FILE).collect()}
    assert got == {i: len(tok.encode(t, add_special_tokens=False).ids) + 1 for i, t in enumerate(texts)}
