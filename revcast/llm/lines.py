"""Line deduplication with a deletion-neighbourhood join, DataFrame only.

Lines are compared lower-cased, as words between white space. Two lines are
near if one word inserted, deleted or replaced turns one into the other. A
line goes if an earlier line (smaller document id, then position) equals it
and it has ``EXACT_WORDS`` words or more, or is near it and both have
``NEAR_WORDS`` or more; the earliest stays.

1. Lines with equal words are grouped by a 128-bit hash; the earliest is kept.
2. Of two near lines either the first half or the rest is unchanged. Each
   different line of enough words posts the hash of both parts, as the longer
   and as the shorter line of a pair; only lines whose part another one has
   go on. (This loses nothing, and spares most lines the next step.)
3. The neighbourhood: each such line emits itself with one word left out, for
   every word, as hashed keys (128 bits), and itself whole. A key is the
   exclusive or of the hashes of each word with its place, so it is made from
   the sum of the words before, not from a copy of the line. Equal keys meet: a
   line with word i left out meets others without their word i (a word was
   replaced), and whole lines (a word was inserted or deleted). Every line is
   paired with the earliest it meets in either way, not with all.
4. For each such pair the edit is verified on the words themselves.
5. The lines found go from their documents.

Defined results: a null text stays null, with no lines; empty lines and lines
of fewer words than ``EXACT_WORDS`` always stay; equal lines inside one
document are duplicates like others; repeated rows of one id and text are
given the same result, so the earliest stays in each; a row without id stays
as it is; other columns are returned as they are.

Scale: lines are reduced to hashes before the shuffle; minima are combined
first, so a line that a third of all documents hold reaches a reducer once
for each task. No group is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

EXACT_WORDS = 3
NEAR_WORDS = 8

BREAK = "\n"
_WORDS = "[ \\t\\x0B\\f\\r]+"


#: White space that isn't one blank alone.
_UNEVEN = "[ \\t\\x0B\\f\\r]{2,}|[\\t\\x0B\\f\\r]"


def words_of(line: Column) -> Column:
    return F.filter(F.split(F.lower(line), _WORDS), lambda w: w != "")


def plain_lines(text: Column) -> Column:
    """The lines of a text with the words of ``words_of`` one blank apart; there
    may be one more at either end. No word is copied, and a text without other
    white space isn't searched for it place by place."""
    uneven = F.lit(False)
    for blank in ("  ", "\t", "\x0b", "\f", "\r"):
        uneven = uneven | F.contains(text, F.lit(blank))
    lower = F.lower(text)
    return F.split(F.when(uneven, F.regexp_replace(lower, _UNEVEN, " ")).otherwise(lower), BREAK)


def _two(joined: Column) -> list[Column]:
    """128 bits of a word sequence, given as its words with a blank between."""
    return [F.xxhash64(joined).alias("h1"), F.xxhash64(joined, F.lit(7)).alias("h2")]


def _parts(joined: Column, n: Column) -> Column:
    """Hashes of the halves by which near lines find each other: for pairs of
    equal length and as the shorter one (n), and as the longer one (n - 1).
    Halves are cut out of the joined words, so nothing is copied word by word."""

    def words(count: Column) -> Column:
        return F.call_function("substring_index", joined, F.lit(" "), count)

    def post(length: Column) -> list[Column]:
        half = F.floor(length / 2).cast("int")
        return [
            F.xxhash64(F.lit(0), length, words(half)),
            F.xxhash64(F.lit(1), length, words(half - length)),
        ]

    return F.array(*post(n), *post(n - 1))


def _left_out(words: Column) -> Column:
    """Every deletion variant with the place of the word left out, and the
    whole line (place -1), as sums (exclusive or) of the hashes of each word
    with its place."""
    none = F.struct(F.lit(0).cast("long").alias("h1"), F.lit(0).cast("long").alias("h2"))

    def placed(w: Column, i: Column) -> Column:
        return F.struct(F.xxhash64(w, i).alias("h1"), F.xxhash64(F.lit(7), w, i).alias("h2"))

    def plus(a: Column, b: Column) -> Column:
        return F.struct(*(a[h].bitwiseXOR(b[h]).alias(h) for h in ("h1", "h2")))

    def total(items: Column, of) -> Column:
        return F.aggregate(items, none, lambda s, x: plus(s, of(x)))

    def word(w: Column, i: Column) -> Column:
        # at its place, moved back by a word left out before it, and what
        # moving the gap from before it to behind it changes
        here, back = placed(w, i), placed(w, i - 1)
        return F.struct(here.alias("here"), back.alias("back"), plus(here, back).alias("step"))

    def chunked(x: Column) -> Column:
        # words whose keys are made from one sum of the words before them: so
        # many that the sums over chunks and inside them are fewest together
        length = F.ceil(F.cbrt(2 * F.size(x))).cast("int")
        starts = F.sequence(F.lit(0), F.size(x) - 1, length)
        chunks = F.transform(starts, lambda at: F.struct(at.alias("at"), F.slice(x, at + 1, length).alias("c")))
        return F.transform(chunks, lambda d: F.struct(d["at"], d["c"], total(d["c"], lambda w: w["step"]).alias("sum")))

    def of_chunk(chunk: Column, before: Column, at: Column) -> Column:
        def one(w: Column, i: Column) -> Column:
            own = plus(plus(before, w["back"]), total(F.slice(chunk, F.lit(1), i), lambda v: v["step"]))
            return F.struct((at + i).alias("place"), own["h1"].alias("h1"), own["h2"].alias("h2"))

        return F.transform(chunk, one)

    def variants(chunks: Column, whole: Column, back: Column) -> Column:
        def before(c: Column, k: Column) -> Column:
            sums = F.aggregate(F.slice(chunks, F.lit(1), k), back, lambda s, d: plus(s, d["sum"]))
            return F.struct(c["c"].alias("c"), sums.alias("before"), c["at"].alias("at"))

        first = F.struct(F.lit(-1).alias("place"), whole["h1"].alias("h1"), whole["h2"].alias("h2"))
        rest = F.transform(F.transform(chunks, before), lambda b: of_chunk(b["c"], b["before"], b["at"]))
        return F.concat(F.array(first), F.flatten(rest))

    # one-element arrays name what is used often, so that it's made once
    sums = F.transform(
        F.array(F.transform(words, word)),
        lambda x: F.struct(
            chunked(x).alias("chunks"), total(x, lambda w: w["here"]).alias("whole"), total(x, lambda w: w["back"]).alias("back")
        ),
    )
    return F.flatten(F.transform(sums, lambda n: variants(n["chunks"], n["whole"], n["back"])))


def found_lines(documents: DataFrame) -> DataFrame:
    """(doc_id, version, pos): lines to remove from rows (doc_id, version, text)."""
    # a repeated row's lines have the same place, so they aren't copies
    line = documents.filter(F.col("doc_id").isNotNull()).select(
        "doc_id", "version", F.posexplode(plain_lines(F.col("text"))).alias("pos", "line")
    )
    line = line.withColumn("joined", F.trim("line"))
    # there are words behind the first so many; nothing else is made for others
    front = F.call_function("substring_index", F.col("joined"), F.lit(" "), F.lit(EXACT_WORDS - 1))
    line = line.filter(F.octet_length(front) < F.octet_length("joined"))
    line = line.withColumn("n", F.octet_length("joined") - F.octet_length(F.replace("joined", F.lit(" "), F.lit(""))) + 1)
    parts = F.when(F.col("n") >= NEAR_WORDS, _parts(F.col("joined"), F.col("n")))
    lines = written(line.select("doc_id", "version", "pos", *_two(F.col("joined")), parts.alias("parts")), "lines-hashed")
    place = ["doc_id", "version", "pos"]
    first = lines.groupBy("h1", "h2").agg(F.min(F.struct(*place)).alias("first"), F.count("*").alias("copies"))
    first = written(first.select("h1", "h2", "first.*", "copies"), "lines-first")
    copies = (
        lines.join(first.filter("copies > 1").select("h1", "h2", *(F.col(c).alias(f"{c}_1") for c in place)), ["h1", "h2"])
        .filter(F.struct(*place) != F.struct(*(f"{c}_1" for c in place)))
        .select(*place)
    )
    near = written(near_lines(documents, lines.select("h1", "parts"), first), "lines-near")
    # a line near an earlier one goes wherever it stands
    all_near = lines.join(near, ["h1", "h2"]).select(*place)
    return copies.unionByName(all_near).distinct()


def near_lines(documents: DataFrame, parts: DataFrame, first: DataFrame) -> DataFrame:
    """(h1, h2): the lines of ``first`` (hash, place of the earliest copy) that
    are near an earlier one; ``parts``: the part hashes of all lines."""
    place = ["doc_id", "version", "pos"]
    part = parts.select("h1", F.explode("parts").alias("part"))
    # a part of two different lines, not of copies of one; written, so that a
    # part that half of all lines have can be split below
    shared = part.groupBy("part").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi")).filter("lo < hi")
    shared = written(shared.select("part"), "lines-parts")
    wanted = part.join(shared, "part").select("h1").distinct()
    wanted = written(first.join(wanted, "h1").select("h1", "h2", *place), "lines-wanted")
    hashes = F.map_from_entries(F.collect_list(F.struct("pos", F.struct("h1", "h2"))))
    by_doc = wanted.groupBy("doc_id", "version").agg(hashes.alias("wanted"))
    line = written(
        among(documents, wanted)
        .join(by_doc, ["doc_id", "version"])
        .select("doc_id", "version", "wanted", F.posexplode(F.split("text", BREAK)).alias("pos", "line"))
        .filter(F.map_contains_key("wanted", F.col("pos")))
        .select(F.col("wanted")[F.col("pos")].alias("h"), *place, words_of(F.col("line")).alias("w"))
        .select("h.*", *place, "w")
        .dropDuplicates(["h1", "h2"]),
        "lines-candidates",
    )
    # a line is known by its first hash here and ordered by its place; the
    # words decide in the end
    order = ["doc_id", "pos", "l1"]
    key = written(
        line.select(F.col("h1").alias("l1"), "doc_id", "pos", F.explode(_left_out(F.col("w"))).alias("v")).select(*order, "v.*"),
        "lines-variants",
    )
    me, earliest = F.struct(*order), F.min(F.struct(*order))
    replaced = key.filter("place >= 0").groupBy("h1", "h2", "place").agg(earliest.alias("by"), F.count("*").alias("n")).filter("n > 1")
    met = key.join(replaced.select("h1", "h2", "place", "by"), ["h1", "h2", "place"])
    whole = key.filter("place < 0").groupBy("h1", "h2").agg(earliest.alias("by"))
    met_whole = key.filter("place >= 0").join(whole, ["h1", "h2"])
    longer = key.filter("place >= 0").groupBy("h1", "h2").agg(earliest.alias("by"))
    met_longer = key.filter("place < 0").join(longer, ["h1", "h2"])
    pair = None
    for m in (met, met_whole, met_longer):
        m = m.filter(F.col("by") < me).select("l1", F.col("by.l1").alias("e1"))
        pair = m if pair is None else pair.unionByName(m)
    words = line.select("h1", "h2", "w")
    checked = (
        pair.distinct()
        .join(words.select(F.col("h1").alias("l1"), "h2", F.col("w").alias("a")), "l1")
        .join(words.select(F.col("h1").alias("e1"), F.col("w").alias("b")), "e1")
        .filter(within_one(F.col("a"), F.col("b")))
    )
    return checked.select(F.col("l1").alias("h1"), "h2").distinct()


#: Bits of the filter of rows (1 MB in all).
BITS = 1 << 23


def among(rows: DataFrame, some: DataFrame, wanted: bool = True) -> DataFrame:
    """The rows of ``rows`` whose (doc_id, version) may be in ``some``, or
    those that certainly aren't: a bitmap of hashes of ``BITS`` bits, whatever
    the input, is broadcast, so texts that a join would drop aren't shuffled
    for it. Beyond some ten million texts it lets more of them through, which
    the join then drops."""

    def place(df: DataFrame) -> DataFrame:
        at = F.pmod(F.xxhash64("doc_id", "version"), F.lit(BITS)) + 1
        return df.withColumns({"__bucket": F.bitmap_bucket_number(at), "__bit": F.bitmap_bit_position(at)})

    maps = place(some.select("doc_id", "version")).groupBy("__bucket").agg(F.bitmap_construct_agg("__bit").alias("__map"))
    byte = F.hex(F.substr("__map", F.floor(F.col("__bit") / 8).cast("int") + 1, F.lit(1)))
    bit = F.expr("shiftright(cast(conv(__byte, 16, 10) as int), cast(__bit % 8 as int)) & 1")
    held = place(rows).join(F.broadcast(maps), "__bucket", "left").withColumn("__byte", byte)
    held = held.withColumn("__in", F.coalesce(bit == 1, F.lit(False)))
    return held.filter(F.col("__in") if wanted else ~F.col("__in")).select(*rows.columns)


def within_one(a: Column, b: Column) -> Column:
    """Whether one word inserted, deleted or replaced makes the two equal: the
    words before the first difference and behind the last leave one at most."""
    short = F.least(F.size(a), F.size(b))
    upto = F.sequence(F.lit(0), short - 1)
    same = F.coalesce(F.array_min(F.filter(upto, lambda i: F.get(a, i) != F.get(b, i))), short)
    back = F.coalesce(
        F.array_min(F.filter(upto, lambda i: F.get(a, F.size(a) - 1 - i) != F.get(b, F.size(b) - 1 - i))), short
    )
    return (F.abs(F.size(a) - F.size(b)) <= 1) & (F.greatest(F.size(a), F.size(b)) - same - back <= 1)


def dedup(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``documents`` with their text's lines that go taken out, and the number
    of lines (``n_lines``) and of those gone (``n_removed``); input columns of
    these names are replaced."""
    rows = documents.drop("n_lines", "n_removed")
    keyed = rows.select(F.struct(*rows.columns).alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    keyed = keyed.withColumn("version", F.xxhash64("text"))
    gone = found_lines(keyed.select("doc_id", "version", "text").filter(F.col("text").isNotNull()))
    gone = written(gone.groupBy("doc_id", "version").agg(F.collect_list("pos").alias("gone")), "lines-gone")
    split = F.split("text", BREAK)
    kept = F.filter(F.transform(split, lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda s: ~F.array_contains("gone", s["i"]))
    new = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(kept, lambda s: s["x"]), BREAK))
    changed = among(keyed, gone).join(gone, ["doc_id", "version"], "left")
    whole = among(keyed, gone, wanted=False).withColumn("gone", F.lit(None).cast("array<int>"))
    return (
        changed.select("row", "text", "gone")
        .unionByName(whole.select("row", "text", "gone"))
        .select(
            "row",
            new.alias("text"),
            F.coalesce(F.size(split), F.lit(0)).cast("long").alias("n_lines"),
            F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        )
        .select(
            *(F.col("text") if c == text else F.col(f"row.`{c}`").alias(c) for c in rows.columns), "n_lines", "n_removed"
        )
    )
