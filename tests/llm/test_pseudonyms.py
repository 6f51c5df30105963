import datetime as dt
import ipaddress
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from revcast.llm import pseudonyms as P

from .fixtures import AWKWARD, SCHEMA, frame


def luhn(digits):
    d = [int(c) for c in digits[::-1]]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def card(rng, n=16):
    body = "".join(rng.choice("0123456789") for _ in range(n - 1))
    return next(body + c for c in "0123456789" if luhn(body + c))


def iban(rng):
    body = "".join(rng.choice("0123456789") for _ in range(18))
    number = int("".join(str(int(c, 36)) for c in body + "DE00"))
    return f"DE{98 - number % 97:02d}{body}"


def iban_ok(v):
    return int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1


def mapped(spark, values, key="k"):
    rows = spark.createDataFrame([(v,) for v in values], "v string").select("v", P.kind_of(F.col("v")).alias("kind"))
    rows = rows.select("v", "kind", P.pseudonym(F.col("v"), F.col("kind"), key).alias("new"))
    return {r["v"]: (r["kind"], r["new"]) for r in rows.collect()}


def test_formats_and_validity_are_kept_and_values_stay_apart(spark):
    rng = random.Random(41)
    cards = [card(rng, n) for n in (13, 15, 16, 16, 19) for _ in range(20)] + ["4111 1111 1111 1111", "4111-1111-1111-1111"]
    ibans = [iban(rng) for _ in range(30)]
    ips = [str(ipaddress.ip_address(rng.randrange(2**32))) for _ in range(60)]
    days = [dt.date(1900, 1, 1) + dt.timedelta(rng.randrange(P.SIDE**2)) for _ in range(60)]
    dates = [d.isoformat() for d in days[:30]] + [d.strftime("%d/%m/%Y") for d in days[30:45]] + [d.strftime("%d.%m.%Y") for d in days[45:]]
    phones = ["+1 (017) 555-7713", "555-123-4567", "(212) 555 0000", "+44 212.555.0001"]
    ssns = ["123-45-6789", "001-01-0001"]
    mails = ["the.72@mail3.example.com", "A_b+c9@x.org"]
    got = mapped(spark, cards + ibans + ips + dates + phones + ssns + mails)
    shape = lambda v: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "0", v)))
    for group, kind in ((cards, "card"), (ibans, "iban"), (dates, "date"), (phones, "phone"), (ssns, "ssn"), (mails, "email")):
        assert all(got[v][0] == kind and shape(got[v][1]) == shape(v) for v in group), kind
        assert len({got[v][1] for v in group}) == len(set(group))
    assert sum(got[v][1] != v for v in got) > 0.98 * len(got)
    assert all(luhn(re.sub("[^0-9]", "", got[v][1])) for v in cards)
    assert all(iban_ok(got[v][1]) and got[v][1][:2] == "DE" for v in ibans)
    assert all(got[v][0] == "ipv4" and ipaddress.ip_address(got[v][1]) for v in ips)
    for d, v in zip(days, dates):
        text = got[v][1]
        new = dt.date.fromisoformat(text) if text[4] == "-" else dt.datetime.strptime(text, "%d/%m/%Y" if "/" in text else "%d.%m.%Y").date()
        assert dt.date(1900, 1, 1) <= new < dt.date(1900, 1, 1) + dt.timedelta(P.SIDE**2)
    assert all(got[v][1].split("@")[1] == v.split("@")[1] for v in mails)


@pytest.mark.parametrize("n", [1, 2, 3])
def test_network_is_a_permutation(spark, n):
    values = spark.range(10**n).select(F.lpad(F.col("id").cast("string"), n, "0").alias("v"))
    got = [r[0] for r in values.select(P.permuted(F.col("v"), F.lit("x"), "k")).collect()]
    assert sorted(got) == [f"{i:0{n}d}" for i in range(10**n)]


def test_number_network_is_a_permutation(spark):
    got = [r[0] for r in spark.range(400).select(P.permuted_number(F.col("id"), 20, F.lit("x"), "k")).collect()]
    assert sorted(got) == list(range(400))


def test_keys_differ(spark):
    a, b = (mapped(spark, ["4111111111111111", "1.2.3.4"], k) for k in "ab")
    assert a["1.2.3.4"] != b["1.2.3.4"] and a["4111111111111111"] != b["4111111111111111"]


def test_texts(spark):
    docs = AWKWARD + [
        (40, "Card 4111111111111111, again 4111111111111111; not 4111111111111112. Mail a.b7@x.example.com!"),
        (41, "Elsewhere: 4111111111111111 at 10.0.0.1 on 2024-02-29, not 2023-02-29 nor 10.0.0.256 nor 1.2.3.4.5."),
        (42, "x" * 200000 + " 4111111111111111"),
        (43, "call +1 (017) 555-7713 or 123-45-6789 or 000-45-6789"),
    ]
    out = P.pseudonymise(frame(spark, docs), "k")
    assert out.columns == [*frame(spark, docs).columns, "finds"]
    rows = {r["doc_id"]: r for r in out.collect() if r["doc_id"] and r["doc_id"] != 7}
    (new,) = set(re.findall(r"\b\d{16}\b", rows[40]["text"])) - {"4111111111111112"}
    assert new != "4111111111111111" and luhn(new) and rows[40]["text"].count(new) == 2
    assert new in rows[41]["text"] and rows[42]["text"] == "x" * 200000 + " " + new
    assert "not 2023-02-29 nor 10.0.0.256 nor 1.2.3.4.5." in rows[41]["text"] and "4111111111111112" in rows[40]["text"]
    assert rows[40]["text"].startswith("Card ") and rows[40]["text"].endswith("@x.example.com!")
    assert {f["kind"]: f["n"] for f in rows[40]["finds"]} == {"card": 2, "email": 1}
    assert {f["kind"]: f["n"] for f in rows[41]["finds"]} == {"card": 1, "date": 1, "ipv4": 1}
    assert "000-45-6789" in rows[43]["text"] and "123-45-6789" not in rows[43]["text"] and "555-7713" not in rows[43]["text"]
    assert rows[1]["text"] is None and rows[2]["text"] == "" and rows[6]["text"] == dict(docs)[6]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    assert P.pseudonymise(spark.createDataFrame([], SCHEMA), "k").count() == 0 and json.dumps([])


VALUES = {
    "card": ["4111 1111 1111 1111", "4111111111111111", "3782 822463 10005", "4111-1111-1111-1111"],
    "ssn": ["123-45-6789"],
    "phone": ["555-123-4567", "+1 (017) 555-7713", "(212) 555 0000", "555.123.4567"],
    "iban": ["DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "BE68 5390 0754 7034"],
    "date": ["2024-02-29", "29/02/2024"],
    "ipv4": ["10.0.0.1"],
    "email": ["55.a@x.org"],
}


def test_values_side_by_side_are_all_found(spark):
    known = [(k, v) for k, vs in VALUES.items() for v in vs]
    texts = [(f"card {v} 12/25 end", [(k, v)]) for k, v in known if k != "iban"]
    texts += [(f"no 2024 {v} 123", [(k, v)]) for k, v in known if k not in ("iban", "phone")]
    texts += [(f"no 2024 {v}, then", [(k, v)]) for k, v in known]
    texts += [(f"{a} {b}", [(j, a), (k, b)]) for j, a in known for k, b in known]
    out = P.pseudonymise(frame(spark, [(i, t) for i, (t, _) in enumerate(texts)]), "k")
    pseudo = {v: new for v, (_, new) in mapped(spark, [v for _, v in known]).items()}
    wrong = []
    for r in out.collect():
        text, values = texts[r["doc_id"]]
        for _, v in values:
            text = text.replace(v, pseudo[v], 1)
        n = {k: sum(k == x for x, _ in values) for k, _ in values}
        if r["text"] != text or {f["kind"]: f["n"] for f in r["finds"]} != n:
            wrong.append((texts[r["doc_id"]][0], r["text"], r["finds"]))
    assert not wrong, (len(wrong), wrong[:12])
    assert iban_ok(pseudo["DE89 3704 0044 0532 0130 00"].replace(" ", ""))


def test_long_area(spark):
    text = "12 " * 5_000 + "4111 1111 1111 1111 " + "7 " * 5_000
    (r,) = P.pseudonymise(frame(spark, [(1, text)]), "k").collect()
    assert "4111 1111 1111 1111" not in r["text"] and len(r["text"]) == len(text)


def test_long_texts_without_an_end_in_sight(spark):
    """No stack overflow, no scan that starts over at every character."""
    texts = ["x@" + "a." * 10_000 + "com 12", "a%" * 100_000 + " 4111 1111 1111 1111", "1234567%" * 30_000 + "x@y.org",
             "1" * 200_000 + "@", "a.b" * 50_000 + "@x.org", "x@" + "-" * 100_000 + ".org jo@ex.org"]
    rows = {r["doc_id"]: r for r in P.pseudonymise(frame(spark, list(enumerate(texts))), "k").collect()}
    assert all(len(rows[i]["text"]) == len(t) for i, t in enumerate(texts))
    assert "4111 1111 1111 1111" not in rows[1]["text"] and "jo@ex.org" not in rows[5]["text"]
