"""Alignment against both libraries on whole texts."""

import collections
import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from daystrata.llm import alignment, queries

SF = "/root/testdata/sf0.001"
BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

ODD = [
    (None, None), (1, ""), (2, " "), (3, "a b"), (3, "a b"), (4, "a b"), (5, "x<|endoftext|> y <s> <0x41>"),
    (6, "  a  b\n\n c it's 'll\t\tq "), (7, "á é ́x İΣ\x1c\x1dq \x00 z\x00y"), (8, "é" * 9000), (9, "a ▁ b"),
    (10, "x" * 20000 + " " + "ß " * 3000), (None, "a b"), (11, "\na\nb \n c\n"), (12, "\n"), (13, "ﬁ ① \U0010ffff😀​"),
    (14, "x\ny"), (15, "\ta\r\nb c  d"), (16, "x\n\n\n\ny     z"),
]


def byte_of():
    plain = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
    out, n = {chr(b): b for b in plain}, 0
    for b in range(256):
        if b not in plain:
            out[chr(256 + n)] = b
            n += 1
    return out


def by_library(rows):
    first = Tokenizer.from_file(BYTES)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    letters, docs = byte_of(), []
    for doc_id, text in rows:
        one = first.encode(" " + (text or ""), add_special_tokens=False).ids
        two = second.encode(text or "")
        a = [bytes(letters[c] for c in first.id_to_token(i)) for i in one]
        b = [
            bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i)
            else second.id_to_piece(i).replace("▁", " ").encode() for i in two
        ]
        if not text or b"".join(a) != (" " + text).encode() or b"".join(b) != (" " + text).encode():
            docs.append((doc_id, [], [], [], []))
            continue
        spans = []
        for tokens in (a, b):
            at, mine = 0, []
            for token in tokens:
                mine.append((at, at + len(token)))
                at += len(token)
            spans.append(mine)
        cuts = {end for _, end in spans[0]} & {end for _, end in spans[1]}
        groups, i, j = [], 0, 0
        for cut in sorted(cuts):
            g, h = [], []
            while i < len(one) and spans[0][i][1] <= cut:
                g.append(one[i])
                i += 1
            while j < len(two) and spans[1][j][1] <= cut:
                h.append(two[j])
                j += 1
            groups.append(f"{','.join(map(str, g))}|{','.join(map(str, h))}")
        links, low = [], 0
        for x, (start, end) in zip(one, spans[0]):
            while spans[1][low][1] <= start:
                low += 1
            k = low
            while k < len(two) and spans[1][k][0] < end:
                links.append((x, two[k]))
                k += 1
        docs.append((doc_id, one, two, groups, links))
    count = collections.Counter(link for doc in docs for link in doc[4])
    most = collections.Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return collections.Counter(
        (
            doc_id, len(one), len(two), len(groups), len(links), sum(count[x] == most[x[1]] for x in links),
            sum(count[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        )
        for doc_id, one, two, groups, links in docs
    )


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(*row, i, "k", b"x") for i, row in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, block int, unit string, packed binary")


@pytest.mark.parametrize("block", [alignment.BLOCK_BYTES, 300])
def test_equals_the_libraries(spark, odd, block):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for frame in (docs, odd):
        want = by_library([(r["doc_id"], r["text"]) for r in frame.collect()])
        found = alignment.digests(alignment.align(frame, BYTES, PIECES, block, hashed=True))
        assert collections.Counter(map(tuple, found.collect())) == want
        spelled = alignment.align(frame, BYTES, PIECES, block).collect()
        again = collections.Counter(
            (*r[:-1], hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else "") for r in spelled
        )
        assert again == want
    assert alignment.align(odd.where("false"), BYTES, PIECES).count() == 0


def test_query(spark):
    found = queries.QUERIES["op11_alignment"](spark, SF)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert collections.Counter(map(tuple, found.collect())) == by_library(rows)


def test_units_join_to_the_librarys_ids():
    pair, rng = alignment.Pair(BYTES, PIECES), random.Random(8)
    for _ in range(3000):
        text = "".join(rng.choice("ab1 \n\t'.sÉ \x1c  <x|>") for _ in range(rng.randrange(1, 40)))
        units = alignment.units_of(text)
        assert "".join(units) == " " + text
        one, two = pair.ids(units)
        assert [i for ids in one for i in ids] == pair.first.encode(" " + text, add_special_tokens=False).ids
        assert [i for ids in two for i in ids] == pair.second.encode(text)


def test_groups_lie_between_shared_ends():
    rng = random.Random(6)
    for near in (alignment._NEAR, 1):
        for _ in range(1500):
            a, b, after, at = [], [], [], 0
            for _ in range(rng.randrange(1, 5)):
                size = rng.randrange(1, 60)
                for ends in (a, b):
                    ends += [at + x for x in sorted({*rng.sample(range(1, size + 1), rng.randrange(size + 1)), size})]
                after.append(len(a))
                at += size
            found = alignment.shared_ends(np.array(a), np.array(b), np.array(after))
            assert [a[k] for k in found] == sorted({*a} & {*b})


@pytest.mark.parametrize("b", [range(1, 200_001), [200_000], [*range(1, 1000), 200_000], range(2, 200_001, 2)])
def test_time_in_proportion_to_the_tokens(b):
    start = time.perf_counter()
    alignment.shared_ends(np.arange(1, 200_001), np.array(b), np.array([200_000]))
    assert time.perf_counter() - start < 5
