import random
import re
import time

from revcast.llm import licenses as L

from .fixtures import AWKWARD, SCHEMA, collected, frame
from .test_decontaminate import WORD, lower


def brute_base(t):
    w = WORD.findall(lower(t))
    at = []
    for phrase, label in L.BASE.items():
        p = phrase.split()
        at += [(i, label) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    places = [i for i, _ in at]
    return len(w), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at}))


DOCS = AWKWARD + [
    (30, "The MIT-License! and mit license, MIT\nLICENSE; cc by cc by"),
    (31, "Licenced under the Apache Licence, Version 2.0."),
    (32, "GNU General Public License twice: gnu general public license"),
    (33, "permitted mit licenses; submit license"),
    (34, ("filler words go on and on " * 3000) + "cc by cc by"),
    (35, "Licensed under CC BY-NC 4.0."),
]


def test_base_places_against_brute_force(spark):
    got = collected(L.search(frame(spark, DOCS)), "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert got == sorted([(i, *brute_base(t)) for i, t in DOCS], key=repr)


def test_fuzzy_notices_have_spans_and_edits(spark):
    rows = {r["doc_id"]: r for r in L.search(frame(spark, DOCS)).collect() if r["doc_id"]}
    text = dict(DOCS)[31]
    (notice,) = rows[31]["notices"]
    assert notice["label"] == "apache" and notice["edits"] == 2
    assert text[notice["first_char"] : notice["last_char"]] == "Licenced under the Apache Licence, Version 2.0"
    assert rows[31]["base_labels"] == "" and rows[31]["labels"] == "apache" and 0 < rows[31]["score"] < 1
    assert rows[35]["labels"] == "cc-by,cc-by-nc" and rows[30]["score"] == 1.0
    assert rows[33]["n_base"] == 0 and rows[1]["labels"] == "" and rows[1]["score"] == 0.0


def test_pieces_keep_one_unchanged():
    for wording in L.NOTICES:
        n = L.Notice(wording, "x")
        assert "".join(p.decode() for _, p in n.seeds) == wording and len(n.seeds) == n.errors + 1


def test_notice_found_with_every_allowed_edit():
    notice = L.Notice("all rights reserved", "x")
    for i in range(len(notice.wording)):
        for text in (notice.wording[:i] + notice.wording[i + 1 :], notice.wording[:i] + "q" + notice.wording[i:], notice.wording[:i] + "q" + notice.wording[i + 1 :]):
            if re.search("  |^ | $", text):
                continue
            found = notice.find(f" some {text} words ".encode())
            assert found and found[0][2] <= 1, text


def test_empty_table(spark):
    assert L.search(spark.createDataFrame([], SCHEMA)).count() == 0


def by_hand(wording, errors, text):
    """Whole-word stretches within ``errors`` edits of the wording."""
    words, out = text.split(), []
    for i in range(len(words)):
        for j in range(i + 1, min(len(words), i + 9) + 1):
            a, row = " ".join(words[i:j]), list(range(len(wording) + 1))
            for x in a:
                new = [row[0] + 1]
                for k, y in enumerate(wording):
                    new.append(min(row[k] + (x != y), row[k + 1] + 1, new[k] + 1))
                row = new
            if row[-1] <= errors:
                out.append((i, j, row[-1]))
    return out


def test_every_damaged_copy_is_found():
    notice, rng = L.Notice("mozilla public license", "mpl"), random.Random(3)
    for _ in range(300):
        copies = []
        for _ in range(rng.randrange(1, 4)):
            c = list(notice.wording)
            for _ in range(rng.randrange(0, 4)):
                at = rng.randrange(len(c))
                c[at : at + rng.randrange(2)] = rng.choice(["", "q", "z"])
            copies.append(" ".join("".join(c).split()))
        text = f" {rng.choice(['', 'and '])}" + rng.choice([" ", " and "]).join(copies) + " end "
        plain = " " + " ".join(text.split()) + " "
        found = L.closest([(notice, *f) for f in notice.find(plain.encode())])
        want = L.closest([
            (notice, sum(map(len, plain.split()[:i])) + i + 1, sum(map(len, plain.split()[:j])) + j, e)
            for i, j, e in by_hand(notice.wording, notice.errors, plain)
        ])
        assert [f[3] for f in found] == [f[3] for f in want] and len(found) == len(want), (plain, found, want)


def test_ten_thousand_notices_in_one_text():
    text = "Mozila Public License and mozilla public license. Größe: all rights reserved!\n" * 5_000
    start = time.monotonic()
    spans = L.judge(text.encode(), [L.Notice(w, x) for w, x in L.NOTICES.items()])[-1]
    assert time.monotonic() - start < 60
    assert [s["label"] for s in spans[:3]] == ["mpl", "mpl", "all-rights-reserved"] and len(spans) == 15_000
    assert [s["edits"] for s in spans[:3]] == [1, 0, 0]
    assert text[spans[-1]["first_char"] : spans[-1]["last_char"]] == "all rights reserved"
