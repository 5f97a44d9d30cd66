"""Personal data against plain patterns, SQL and hand-made spans."""

import collections
import hashlib
import random
import re
import time

import duckdb
import oracle
import pytest

from daystrata.llm import pii, queries

SF = "/root/testdata/sf0.01"


def checked(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(x) <= 255 for x in hit.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(digits[::-1])]
        return 14 <= len(digits) <= 19 and sum(x // 10 + x % 10 for x in doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base(text):
    found = [
        (m.start(), i, kind, m.end())
        for i, (kind, pattern) in enumerate(PLAIN.items())
        for m in re.finditer(pattern, text)
        if checked(kind, m.group())
    ]
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found)]


ODD = [
    (None, None), (1, ""), (2, " \n"), (3, "mail a@b.c@d.e now"), (3, "mail a@b.c@d.e now"), (4, "@x.y@z.w a@b"),
    (5, "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.4 1.2.3"), (6, "é😀 +1 (017) 555-7713 x +49-30-1234567890123456"),
    (7, "4111 1111 1111 1111 4111-1111-1111-1112 00000000000000"), (8, "IBAN GB82 WEST 1234 5698 7654 32, "
     "GB82 WEST 1234 5698 7654 33 DE89370400440532013000 AND"), (9, "my SSN 123-45-6789 order 123-45-6789 000-12-3456 "
     + "." * 60 + " 123-45-6780"), (10, "call (555) 123-4567 " + "." * 90 + " 555-123-4567"),
    (None, "a@b.c"), (11, "ip 10.0.0.1 " + "." * 60 + " version 1.2.3.4"), (12, "x@y.z-1.2.3.4@q.r"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(*row, i, "k", "s") for i, row in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, start int, kind string, spans string")


def expected(text):
    spans = base(text or "")
    kinds = collections.Counter(s.split(":")[0] for s in spans)
    return (*(kinds[k] for k in PLAIN), hashlib.sha256(",".join(spans).encode()).hexdigest())


def test_base_spans_are_the_patterns(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for frame in (docs, odd):
        want = collections.Counter((r["doc_id"], *expected(r["text"])) for r in frame.collect())
        found = pii.digests(pii.find(frame)).collect()
        got = collections.Counter(tuple(r)[:6] for r in found)
        assert got == want
    assert pii.find(odd.where("false")).count() == 0


def test_random_texts():
    rng, finder = random.Random(4), pii.Finder()
    for alphabet in ("a@.-", "12.", "1 -4", "+1 ()a-", "a1@. +-9", "123-45678 -"):
        for _ in range(3000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(40)))
            spans = finder.spans(text)
            assert [f"{k}:{a}:{b}" for k, a, b, _, kept in spans if kept] == base(text)
            taken = [(a, b) for _, a, b, _, kept in spans if kept]
            assert not any(a < y and b > x for _, a, b, _, kept in spans if not kept for x, y in taken)


def test_added_spans():
    def told(text):
        return [(k, text[a:b], s) for k, a, b, s, kept in pii.Finder().spans(text) if not kept]

    of = dict(ODD)
    assert told(of[8]) == [("iban", "GB82 WEST 1234 5698 7654 32", 1.0), ("iban", "DE89370400440532013000", 0.8)]
    assert told("pay GB82 WEST 1234 5698 7654 321") == []
    assert told(of[9]) == []
    assert told("SSN 123-45-6789") == [("ssn", "123-45-6789", 0.7)]
    assert told("SSN 666-45-6789, 123-00-6789, 123-45-0000, 123-45-67890") == []
    assert told("123-45-6789") == [] and told("order, SSN 123-45-6789") == []
    assert told(of[10]) == [("tel", "(555) 123-4567", 0.7)]
    scores = {k: s for k, _, _, s, _ in pii.Finder().spans("ip 10.0.0.1")}
    assert scores == {"ip": 0.9}
    assert pii.Finder().spans("release 10.0.0.1")[0][3] == 0.4


def test_check_digits():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("GB82WEST12345698765432") and not pii.mod97("GB28WEST12345698765432")


def test_equals_its_sql(spark, odd):
    con = duckdb.connect()
    table = odd.select("doc_id", "text").toArrow()
    con.register("documents", table)
    assert oracle.compare(pii.digests(pii.find(odd)), pii.find_sql(), con) == len(ODD)
    found = queries.QUERIES["op12_pii"](spark, SF)
    assert oracle.compare(found, pii.find_sql(), oracle.connection(SF)) > 0


@pytest.mark.parametrize("text", ["x" * 400_000, "1" * 400_000, "a." * 200_000, "+1 " * 130_000, "a@" * 200_000, "1.2." * 100_000])
def test_time_in_proportion_to_the_text(text):
    start = time.perf_counter()
    pii.Finder().spans(text)
    assert time.perf_counter() - start < 5
