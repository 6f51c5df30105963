"""Format-preserving pseudonyms for personal numbers and dates, DataFrame only.

A value found and validated is permuted within its own format by a keyed
Feistel network, so equal values become equal pseudonyms in every document,
different ones stay different, and the text keeps its shape:

* card numbers (13 to 19 digits, Luhn): all digits but the last are permuted,
  the check digit is made anew;
* IBANs (mod 97; whole or in groups of four): the account part is permuted,
  the check digits made anew;
* IPv4 addresses (octets to 255): permuted as 32-bit numbers;
* phone numbers and social security numbers: digits are permuted;
* dates (valid days of 1900-01-01 to 2102-07-25, 272 * 272 days, as
  yyyy-mm-dd, dd/mm/yyyy or dd.mm.yyyy): permuted as day numbers;
* e-mail addresses (local part to 64 characters, 128 labels to 63 in the
  domain): letters and digits of the local part are permuted, the domain stays.

The network works on two halves: in each round the characters of one half
are moved, digits among digits and letters among letters, by amounts hashed
(SHA-256) from the key, the kind, the round, and the other half.

Numbers that stand side by side are one area; it is read from the left, and
at each number the first kind that is valid counts, in the order of ``TRIED``
(16 digits in fours before longer ones; a card in other groups only if no
other value stands in it). What isn't valid stays, and reading goes on at the
next number.

Defined results: a null text stays null with no finds; a text without finds
stays as it is; numbers that look like a kind but fail its validation stay;
other columns are returned as they are.

Scale: a map over rows, in whole-stage code and higher-order functions; no
shuffle, nothing is kept between rows, so the key alone links documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Days of the date domain: a square, so that the network maps it to itself.
SIDE = 272
EPOCH = "1900-01-01"

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: Kind and pattern; of several that match at a place the first counts.
KINDS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+@[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+){0,126}\.[A-Za-z]{2,63}",
    "date": r"(?:19|20|21)\d\d-(?:0\d|1[0-2])-[0-3]\d|[0-3]\d([./])(?:0\d|1[0-2])\1(?:19|20|21)\d\d",
    "ipv4": rf"{_OCTET}(?:\.{_OCTET}){{3}}",
    "iban": r"[A-Z]{2}\d\d(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)",
    "card": r"\d(?:[ -]?\d){12,18}",
    "ssn": r"\d{3}-\d\d-\d{4}",
    "phone": r"(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}",
}
#: Not inside a longer word or number.
_BEFORE, _AFTER = r"(?<![A-Za-z0-9_+@.-])", r"(?![A-Za-z0-9_@]|[.-]\d)"


#: Numbers side by side, perhaps behind the groups of an IBAN; ends with one of
#: them, and not within an e-mail address.
_AREA = (
    r"(?:[+(]?\d[\d ().+/-]{5,}|[A-Z]{2}\d\d(?: [A-Z0-9]{4}){2}[A-Z0-9 ().+/-]*)(?<=[A-Z0-9])"
    r"(?![A-Za-z0-9_@]|[.-]\d|[A-Za-z0-9._%+-]{0,64}+@)"
)
PATTERN = _BEFORE + "(?:" + KINDS["email"] + _AFTER + "|" + r"[A-Z]{2}\d\d[A-Z0-9]{11,30}" + _AFTER + "|" + _AREA + ")"
_FOURS = r"\d{4}([ -])\d{4}\1\d{4}\1\d{4}"
#: Kinds tried at a number of an area, in order.
TRIED = [
    ("date", KINDS["date"]),
    ("ipv4", KINDS["ipv4"]),
    ("ssn", KINDS["ssn"]),
    ("phone", KINDS["phone"]),
    ("card", r"\d{13,19}"),
    ("card", _FOURS),
    ("card", r"\d{4}([ -])\d{6}\1\d{5}"),
    ("card", r"\d{4}([ -])\d{6}\1\d{4}"),
    ("card", _FOURS + r"\1\d{1,3}"),
    *(("card in groups", rf"\d(?:[ -]?\d){{{n - 1}}}") for n in range(19, 12, -1)),
    ("iban", r"[A-Z]{2}\d\d[A-Z0-9]{11,30}"),
    *(("iban", rf"[A-Z]{{2}}\d\d(?: [A-Z0-9]{{4}}){{{n}}}{end}") for n in range(7, 1, -1) for end in (" [A-Z0-9]{1,3}", "")),
]
#: Longer than any value and what tells its end.
_WINDOW = 48
#: Characters of an area that are looked through at once.
_PART = 256
_INNER = _BEFORE + "(?:" + "|".join(
    [KINDS["date"], KINDS["ssn"], KINDS["phone"], r"\d{13,19}", _FOURS.replace(r"\1", r"\2"), r"\d{4}([ -])\d{6}\3\d{4,5}"]
) + ")" + _AFTER
#: What every find holds: an @, a number of six characters, or an IBAN's front.
HINT = r"@|\d[\d ().+/-]{5}|[A-Z]{2}\d\d(?: ?[A-Z0-9]){8}"


def _digest(key: str, kind: Column, round_: Column, half: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), kind, round_.cast("string"), half), 256)


def _moved(half: Column, digest: Column) -> Column:
    """Each digit and letter of ``half`` moved within its class."""

    def move(i: Column) -> Column:
        c = F.ascii(F.substr(half, i + 1, F.lit(1)))
        by = F.conv(F.substr(digest, F.pmod(i, F.lit(32)) * 2 + 1, F.lit(2)), 16, 10).cast("int")

        def within(first: int, n: int) -> Column:
            return F.char(F.pmod(c - first + by, F.lit(n)) + first)

        return (
            F.when(c.between(48, 57), within(48, 10))
            .when(c.between(65, 90), within(65, 26))
            .when(c.between(97, 122), within(97, 26))
            .otherwise(F.substr(half, i + 1, F.lit(1)))
        )

    return F.when(F.length(half) == 0, half).otherwise(
        F.array_join(F.transform(F.sequence(F.lit(0), F.length(half) - 1), move), "")
    )


def permuted(value: Column, kind: Column, key: str) -> Column:
    """Feistel network over the characters of ``value`` (ASCII); what is
    neither digit nor letter stays in place."""
    half = F.floor(F.length(value) / 2).cast("int")
    start = F.struct(
        F.substr(value, F.lit(1), half).alias("a"), F.substr(value, half + 1, F.length(value)).alias("b")
    )

    def step(s: Column, r: Column) -> Column:
        left = F.pmod(r, F.lit(2)) == 0
        return F.struct(
            F.when(left, _moved(s["a"], _digest(key, kind, r, s["b"]))).otherwise(s["a"]).alias("a"),
            F.when(left, s["b"]).otherwise(_moved(s["b"], _digest(key, kind, r, s["a"]))).alias("b"),
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: F.concat(s["a"], s["b"]))


def permuted_number(value: Column, side: int, kind: Column, key: str) -> Column:
    """Feistel network over ``side * side`` numbers."""

    def step(s: Column, r: Column) -> Column:
        by = F.conv(F.substr(_digest(key, kind, r, s["b"].cast("string")), F.lit(1), F.lit(12)), 16, 10).cast("long")
        return F.struct(s["b"].alias("a"), F.pmod(s["a"] + by, F.lit(side).cast("long")).alias("b"))

    start = F.struct(F.floor(value / side).cast("long").alias("a"), F.pmod(value, F.lit(side)).cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: s["a"] * side + s["b"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn_sum(digits: Column) -> Column:
    """Sum with every second digit from the right doubled, the last one not."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, n - i, F.lit(1)).cast("int") * F.when(F.pmod(i, F.lit(2)) == 1, 2).otherwise(1)
        return total + d - F.when(d > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add)


def mod97(value: Column) -> Column:
    """IBAN remainder: the first four characters go to the end, letters count
    from ten."""
    turned = F.concat(F.substr(value, F.lit(5), F.length(value)), F.substr(value, F.lit(1), F.lit(4)))

    def add(rest: Column, i: Column) -> Column:
        c = F.ascii(F.substr(turned, i + 1, F.lit(1)))
        return F.when(c < 58, F.pmod(rest * 10 + c - 48, F.lit(97))).otherwise(F.pmod(rest * 100 + c - 55, F.lit(97)))

    return F.aggregate(F.sequence(F.lit(0), F.length(turned) - 1), F.lit(0), add)


def _refill(value: Column, digits: Column, which: str = "[0-9]") -> Column:
    """``value`` with its digits (or what ``which`` says) replaced in order."""

    def put(s: Column, i: Column) -> Column:
        c = F.substr(value, i + 1, F.lit(1))
        digit = c.rlike(which)
        return F.struct(
            F.concat(s["out"], F.when(digit, F.substr(digits, s["n"] + 1, F.lit(1))).otherwise(c)).alias("out"),
            (s["n"] + F.when(digit, 1).otherwise(0)).alias("n"),
        )

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("n"))
    return F.aggregate(F.sequence(F.lit(0), F.length(value) - 1), start, put, lambda s: s["out"])


def _date_of(value: Column) -> Column:
    iso = value.rlike("^[0-9]{4}-")
    text = F.when(iso, value).otherwise(
        F.concat_ws("-", F.substr(value, F.lit(7), F.lit(4)), F.substr(value, F.lit(4), F.lit(2)), F.substr(value, F.lit(1), F.lit(2)))
    )
    return F.try_to_date(text, "yyyy-MM-dd")


def day_number(value: Column) -> Column:
    """Days since 1900-01-01, null for no valid date of the domain."""
    n = F.datediff(_date_of(value), F.lit(EPOCH).cast("date")).cast("long")
    return F.when(n.between(0, SIDE * SIDE - 1), n)


def _date_like(value: Column, number: Column) -> Column:
    day = F.date_add(F.lit(EPOCH).cast("date"), number.cast("int"))
    mark = F.substr(value, F.lit(3), F.lit(1))
    return F.when(value.rlike("^[0-9]{4}-"), F.date_format(day, "yyyy-MM-dd")).otherwise(
        F.concat_ws("", F.date_format(day, "dd"), mark, F.date_format(day, "MM"), mark, F.date_format(day, "yyyy"))
    )


def _valid(value: Column, kind: Column) -> Column:
    """Whether a text of the kind's pattern passes its validation."""
    blank_free = F.regexp_replace(value, " ", "")
    return (
        F.when(kind == "date", day_number(value).isNotNull())
        .when(kind == "iban", F.length(blank_free).between(15, 34) & (mod97(blank_free) == 1))
        .when(kind == "card", F.pmod(luhn_sum(_digits(value)), F.lit(10)) == 0)
        .when(kind == "ssn", ~value.rlike("^(000|666|9)") & ~value.rlike("-00-") & ~value.rlike("-0000$"))
        .otherwise(True)
    )


def kind_of(value: Column) -> Column:
    """Kind of a find, null if it fails the kind's validation."""
    kind = F.lit(None).cast("string")
    for name in reversed(KINDS):
        kind = F.when(value.rlike("^(?:" + KINDS[name] + ")$"), F.when(_valid(value, F.lit(name)), name)).otherwise(kind)
    return kind


def _value_at(rest: Column) -> Column:
    """First valid (value, kind) at the start of ``rest``, null if none."""
    tried = []
    for kind, pattern in TRIED:
        value = F.regexp_extract(rest, "^(?:" + pattern + ")" + _AFTER, 0)
        if kind == "card in groups":
            kind, value = "card", F.when(value.rlike(_INNER), "").otherwise(value)
        tried.append(F.struct(value.alias("value"), F.lit(kind).alias("kind")))
    some = F.filter(F.array(*tried), lambda c: c["value"] != "")
    return F.get(F.filter(some, lambda c: _valid(c["value"], c["kind"])), F.lit(0))


def pieces(find: Column) -> Column:
    """A find as (value, kind) pieces, end to end; kind null for what stays."""
    piece = "array<struct<value:string,kind:string>>"
    email = F.array(F.struct(find.alias("value"), F.lit("email").alias("kind")))
    n = F.length(find)
    start = F.struct(F.lit(1).alias("at"), F.array().cast(piece).alias("out"))

    def stays(a: Column, b: Column) -> Column:
        kept = F.struct(F.substr(find, a, b - a).alias("value"), F.lit(None).cast("string").alias("kind"))
        return F.when(b > a, F.array(kept)).otherwise(F.array().cast(piece))

    def read(s: Column, start: Column) -> Column:
        p = start["at"]

        def take(c: Column) -> Column:
            new = F.struct(
                (p + F.length(c["value"])).alias("at"), F.concat(s["out"], stays(s["at"], p), F.array(c)).alias("out")
            )
            return F.when(c.isNull(), s).otherwise(new)

        # a one-element array names the value, so that it's looked for once
        some = F.transform(F.array(_value_at(start["rest"])), take)
        return F.when(p < s["at"], s).otherwise(F.get(some, F.lit(0)))

    def starts_of(part: Column, b: Column) -> Column:
        # the part has the character before it, and a window behind it
        at = F.sequence(F.lit(1), F.least(F.lit(_PART), n - b + 1))
        at = F.filter(at, lambda i: F.substr(part, i, F.lit(2)).rlike("^[^A-Za-z0-9_+@.-][0-9A-Z+(]"))
        return F.transform(at, lambda i: F.struct((b + i - 1).alias("at"), F.substr(part, i + 1, F.lit(_WINDOW)).alias("rest")))

    # in parts, as reaching a place takes as long as there is text before it
    padded = F.concat(F.lit(" "), find)
    parts = F.transform(
        F.sequence(F.lit(1), n, F.lit(_PART)),
        lambda b: F.struct(b.alias("b"), F.substr(padded, b, F.lit(_PART + 1 + _WINDOW)).alias("text")),
    )
    starts = F.flatten(F.transform(parts, lambda x: starts_of(x["text"], x["b"])))
    area = F.aggregate(starts, start, read, lambda s: F.concat(s["out"], stays(s["at"], n + 1)))
    return F.when(F.contains(find, F.lit("@")), email).otherwise(area)


def pseudonym(value: Column, kind: Column, key: str) -> Column:
    """The value's pseudonym; ``kind`` as of ``kind_of``, null leaves it."""
    digits = _digits(value)
    body = permuted(F.substr(digits, F.lit(1), F.length(digits) - 1), kind, key)
    card = F.concat(body, F.pmod(10 - F.pmod(luhn_sum(F.concat(body, F.lit("0"))), F.lit(10)), F.lit(10)).cast("string"))
    account = permuted(F.substr(F.regexp_replace(value, " ", ""), F.lit(5), F.length(value)), kind, key)
    blank = F.concat(F.substr(value, F.lit(1), F.lit(2)), F.lit("00"), account)
    iban = F.concat(F.substr(value, F.lit(1), F.lit(2)), F.lpad((98 - mod97(blank)).cast("string"), 2, "0"), account)
    octets = F.split(value, r"\.")
    number = F.aggregate(octets, F.lit(0).cast("long"), lambda n, o: n * 256 + o.cast("long"))
    moved = permuted_number(number, 65536, kind, key)
    ipv4 = F.concat_ws(".", *(F.pmod(F.shiftright(moved, s), F.lit(256)).cast("string") for s in (24, 16, 8, 0)))
    at = F.instr(value, "@")
    email = F.concat(permuted(F.substr(value, F.lit(1), at - 1), kind, key), F.substr(value, at, F.length(value)))
    return (
        F.when(kind == "card", _refill(value, card))
        .when(kind == "iban", _refill(value, iban, "[A-Z0-9]"))
        .when(kind == "ipv4", ipv4)
        .when(kind == "date", _date_like(value, permuted_number(day_number(value), SIDE, kind, key)))
        .when(kind == "email", email)
        .when(kind.isin("phone", "ssn"), _refill(value, permuted(digits, kind, key)))
        .otherwise(value)
    )


def pseudonymise(documents: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``documents`` with finds in ``text`` replaced and ``finds`` added: kind
    and number of finds of each kind present. An input column of that name is
    replaced."""
    rows = documents.drop("finds")
    value = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    found = F.when(F.col(text).rlike(HINT), value)
    read = F.transform("__found", pieces)
    new = F.transform("__read", lambda find: F.array_join(F.transform(find, lambda f: pseudonym(f["value"], f["kind"], key)), ""))
    between = F.split(text, PATTERN, -1)
    joined = F.array_join(
        F.zip_with(between, F.concat("__new", F.array(F.lit(""))), lambda a, b: F.concat(a, b)), ""
    )
    names = F.array_distinct(F.filter(F.transform("__kinds", lambda f: f["kind"]), lambda k: k.isNotNull()))
    counted = F.transform(
        F.array_sort(names),
        lambda k: F.struct(k.alias("kind"), F.size(F.filter("__kinds", lambda f: f["kind"] == k)).alias("n")),
    )
    some = F.coalesce(F.size("__found") > 0, F.lit(False))
    return (
        rows.withColumn("__found", found)
        .withColumn("__read", F.when(F.coalesce(F.size("__found"), F.lit(0)) > 0, read))
        .withColumn("__kinds", F.flatten("__read"))
        .withColumn("__new", F.when(F.col("__read").isNotNull(), new))
        .withColumn("finds", F.coalesce(counted, F.array().cast("array<struct<kind:string,n:int>>")))
        .withColumn(text, F.when(some, joined).otherwise(F.col(text)))
        .drop("__found", "__read", "__kinds", "__new")
    )
