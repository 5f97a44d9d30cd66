"""Each operator against a brute-force version, SQL, the library it mirrors or held-out labels."""

import collections
import hashlib
import random
import time
import zlib

import duckdb
import numpy as np
import oracle
import public_tokenizers
import pytest
from brute import edited, groups, without_repeats
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daystrata.llm import (
    bpe,
    convnet,
    fingerprints,
    packing,
    paths,
    queries,
    quotes,
    repeats,
    rules,
    toxicity,
)
from daystrata.llm.words import WordCoder

SF = "/root/testdata/sf0.001"
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
# Null, empty, blank and very long texts, special tokens, odd white space, ties and repeated rows.
ODD = [
    (None, None), (1, ""), (2, " \n"), (3, "a b"), (3, "a b"), (4, "a b"), (5, "x<|endoftext|> y"),
    (6, "  a  b\n\n c it's 'll\t\tq "), (7, "á é ́x İΣ\x1c\x1dq"), (8, "é" * 9000),
    (9, "x" * 20000 + " " + "ß " * 3000), (10, " ".join(["ab"] * 5000)), (None, "a b"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def odd(spark):
    """With columns whose names the operators use inside."""
    rows = [(*row, i, b"x", "k") for i, row in enumerate(ODD)]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, first int, tokens binary, doc_key string"
    )


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def rows_of(frame):
    return [tuple(r) for r in frame.select("doc_id", "text").collect()]


def counted(frame, *names):
    return collections.Counter(tuple(r) for r in frame.select(*names).collect())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, name):
    assert oracle.compare(queries.QUERIES[name](spark, SF), queries.SQL[name], oracle.connection(SF)) > 0


def test_encoding_is_the_librarys(docs, odd):
    library = Tokenizer.from_file(WORD_BPE)

    def expected(text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        return (
            len(ids),
            hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest(),
        )

    for frame in (docs, odd):
        want = collections.Counter((d, *expected(t)) for d, t in rows_of(frame))
        got = bpe.encode(frame, WORD_BPE)
        assert counted(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want
    assert bpe.encode(odd.where("false"), WORD_BPE).count() == 0


def test_chunks_follow_content():
    rng = random.Random(5)
    shared = "".join(rng.choice("abcdé ") for _ in range(30000)).encode()
    one, two = bpe.chunks_of([b"xyz" * 100 + shared, shared + b"tail"])
    assert b"".join(one).endswith(shared) and len(set(one) & set(two)) > len(two) // 2
    assert bpe.chunks_of([b""]) == [[]]


@pytest.mark.parametrize("path,bytelevel", [(WORD_BPE, False), (BYTE_BPE, True)])
def test_word_coder(path, bytelevel):
    code, rng = WordCoder(path, bytelevel), random.Random(3)
    texts = [t or "" for _, t in ODD[:8]]
    texts += ["".join(rng.choice("ab1 \n\t'.sÉ ") for _ in range(60)) for _ in range(300)]
    for text in texts:
        assert code.ids(text).tolist() == code.library.encode(text, add_special_tokens=False).ids


def test_packing_loses_no_token(docs, odd):
    library = Tokenizer.from_file(BYTE_BPE)
    for frame in (docs, odd.where("doc_id is not null").dropDuplicates(["doc_id"])):
        texts = dict(rows_of(frame))
        pieces = packing.pack(frame, BYTE_BPE, pool=40).collect()
        of, lengths = collections.defaultdict(list), collections.defaultdict(list)
        for p in pieces:
            of[p["doc_id"]].append(p)
            lengths[p["sequence_id"]].append((p["offset"], p["length"]))
        assert of.keys() == texts.keys()
        for doc_id, mine in of.items():
            ids = library.encode(texts[doc_id] or "", add_special_tokens=False).ids + [1]
            at = 0
            for p in sorted(mine, key=lambda p: p["start"]):
                part = np.array(ids[at : at + p["length"]], "<u4")
                assert (p["start"], p["doc_tokens"]) == (at, len(ids))
                assert p["ids_crc32"] == zlib.crc32(part.tobytes())
                at += p["length"]
            assert at == len(ids)
        padded = 0
        for spans in lengths.values():
            at = 0
            for offset, length in sorted(spans):
                assert offset == at
                at += length
            assert at <= 2048
            padded += bool(at & (at - 1))
        assert padded <= frame.rdd.getNumPartitions()
    assert packing.pack(odd.where("false"), BYTE_BPE).count() == 0


@pytest.mark.parametrize("pool", [8, 4096])
def test_tiers_and_step_groups(pool):
    """Sequences of one context and equal token counts form a group; only the last one pads."""
    rng, sizes, step = random.Random(4), packing.CONTEXTS, packing.STEP_TOKENS
    packer = packing.Packer(sizes, step, pool, 7 << 36)
    docs = [np.arange(rng.choice([1, 5, 63, 64, 65, 700, 2048, 5000]) + rng.randrange(40), dtype="<u4") for _ in range(400)]
    pieces = [p for i, tokens in enumerate(docs) for p in packer.add(i, tokens)] + list(packer.close())
    lengths, contexts, groups = collections.Counter(), {}, collections.defaultdict(set)
    for _, _, tokens, _, sequence, offset, context, group in pieces:
        assert offset == lengths[sequence] and sequence >> 36 == 7 and group >> 36 == 7
        lengths[sequence] += len(tokens)
        assert contexts.setdefault(sequence, context) == context
        groups[group].add(sequence)
    assert sum(lengths.values()) == sum(map(len, docs))
    short = [s for s, n in lengths.items() if n != contexts[s]]
    assert all(lengths[s] <= contexts[s] == min(x for x in sizes if x >= lengths[s]) for s in lengths) and len(short) <= 1
    open_ = collections.Counter()
    for mine in groups.values():
        (context,) = {contexts[s] for s in mine}
        assert len(mine) * context <= step
        open_[context] += len(mine) * context < step
    assert sum(map(len, groups.values())) == len(lengths) and all(n <= 1 for n in open_.values())
    # A document's remainder goes to the smallest context that holds it, unless it fills a longer one's gap.
    alone = packing.Packer(sizes, step, pool, 0)
    for n, context in ((60, 64), (65, 128), (2000, 2048)):
        list(alone.add(0, np.zeros(n, "<u4")))
        assert [len(tier) for tier in alone.tiers] == [int(size == context) for size in sizes]
        alone = packing.Packer(sizes, step, pool, 0)


def test_toxic_segments_are_maximal():
    def by_definition(scores, low, high):
        best = None
        for i in range(low, high):
            total = 0
            for j in range(i, high):
                total += scores[j]
                if total > 1e-12 and (best is None or total > best[2] + 1e-12):
                    best = (i, j, total)
        if best is None:
            return []
        left, right = by_definition(scores, low, best[0]), by_definition(scores, best[1] + 1, high)
        return [*left, best, *right]

    rng = random.Random(3)
    for _ in range(500):
        lexicon = toxicity.Lexicon({"a": 3.0, "b": 1.37}, -0.613)
        text = [rng.choice("abxxxxx") for _ in range(rng.randrange(25))]
        scores = [lexicon.scores.get(w, -0.613) for w in text]
        want = [(i, j, round(s, 6)) for i, j, s in by_definition(scores, 0, len(text))]
        assert [(i, j, round(s, 6)) for i, j, s in lexicon.segments(text)] == want


def test_toxicity_on_held_out_labels(spark, odd):
    sf = "/root/testdata/sf0.01"
    scored = queries.QUERIES["op3_toxicity"](spark, sf).where("held_out")
    known = scored.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    right, n = known.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int")), F.count("*")).first()
    assert n > 50 and right > 0.9
    model = toxicity.train(odd, spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert toxicity.score(odd, model).where("score between 0 and 1").count() == len(ODD)
    assert toxicity.score(odd.where("false"), model).count() == 0


def test_quality_on_held_out_labels(spark, odd):
    sf = "/root/testdata/sf0.01"
    scored = queries.QUERIES["op9_quality_classifier"](spark, sf).where("held_out")
    known = scored.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    right, n = known.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert n > 50 and right > 0.9
    network = convnet.train(odd, spark.createDataFrame([], "doc_id bigint, quality int"))
    assert convnet.score(odd, network).where("score between 0 and 1").count() == len(ODD)
    assert convnet.score(odd.where("false"), network).count() == 0


def test_network_sees_every_byte():
    rng = np.random.default_rng(1)
    network = convnet._network(
        {
            "filters": rng.normal(0, 1, (convnet.WIDTH * 16, convnet.FILTERS)),
            "filter_bias": np.zeros(convnet.FILTERS),
            "hidden": rng.normal(0, 1, (2 * convnet.FILTERS, convnet.HIDDEN)),
            "hidden_bias": np.zeros(convnet.HIDDEN),
            "out": np.full(convnet.HIDDEN, 0.01),
            "out_bias": np.zeros(1),
        }
    )
    tables = network.tables()
    plain = b"the cat sat on the mat. " * 400
    for at in (0, 4000, len(plain) - 40):
        changed = plain[:at] + b"#|!!#|!!" * 5 + plain[at + 40 :]
        a, b = network.probabilities([plain, changed], tables)
        assert a != b
        assert abs(network.probabilities([changed], tables)[0] - b) < 1e-6


def test_rules_on_odd_rows(odd):
    con = duckdb.connect()
    table = odd.select("doc_id", "text").toArrow()
    con.register("documents", table)
    assert oracle.compare(rules.judge(odd), rules.judge_sql(), con) == len(ODD)
    assert rules.judge(odd.where("false")).count() == 0


def test_fingerprints(docs, odd):
    want = edited(rows_of(docs))
    found = fingerprints.edited_pairs(docs).collect()
    got = {r[0]: (r[1], r[2], round(r[5], 9), round(r[6], 9)) for r in found}
    assert got == want and len(found) == len(want)
    rows = fingerprints.edited_pairs(odd).collect()
    assert len(rows) == len(ODD)
    of = collections.defaultdict(set)
    for r in rows:
        of[r["n_chars"], r["doc_id"]].add((r["fingerprint"], r["near_edited"]))
    assert all(len(v) == 1 for v in of.values())
    alike = {r["fingerprint"] for r in rows if r["doc_id"] in (3, 4)}
    assert len(alike) == 1
    assert fingerprints.edited_pairs(odd.where("false")).count() == 0
    plan = fingerprints.edited_pairs(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("bucket,block", [(48, 1024), (2, 3)])
def test_jaccard_groups(docs, monkeypatch, bucket, block):
    monkeypatch.setattr(paths, "BUCKET", bucket)
    found = counted(paths.groups(docs, block=block), "doc_id", "class_id", "n_links")
    assert found == groups(rows_of(docs))


def test_jaccard_recall_inside_large_buckets(spark):
    """Linked pairs whose every token lies in a bucket of some hundred unlike classes."""
    rng, n, recall = np.random.default_rng(7), 2000, 0.999
    one = rng.integers(0, 20, (n, paths.TOKENS))
    same = np.argsort(rng.random((n, paths.TOKENS)), 1) < paths.TOKENS * 4 // 5
    other = np.where(same, one, rng.integers(0, 20, one.shape))
    rows = [
        (f"{i}{side}".encode(), values.astype("<u4").tobytes())
        for side, table in (("a", one), ("b", other))
        for i, values in enumerate(table)
    ]
    edges = paths.candidates(spark.createDataFrame(rows, "node binary, tokens binary"), recall)
    # Large buckets followed by the same token again are joined whole; they say nothing here.
    found = {frozenset((bytes(a), bytes(b))) for a, b in edges.collect()}
    root = {node: node for node, _ in rows}

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for a, b in map(tuple, found):
        root[find(a)] = find(b)
    lost = sum(find(f"{i}a".encode()) != find(f"{i}b".encode()) for i in range(n))
    assert lost <= 3 * n * (1 - recall)


def test_jaccard_runs_cover_every_level():
    assert paths.missed(paths.runs_for(paths.RECALL)) <= 1 - paths.RECALL


def test_jaccard_on_odd_rows(odd):
    rows = paths.groups(odd).collect()
    assert len(rows) == len(ODD)
    assert {r["n_links"] for r in rows if r["doc_id"] in (3, 4)} == {3}
    assert {r["n_links"] for r in rows if r["doc_id"] in (1, 2)} == {0}
    kept = paths.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sum(r["text"] == "a b" for r in kept.collect()) == 1
    assert paths.groups(odd.where("false")).count() == 0


@pytest.mark.parametrize("group", [256, 2])
def test_repeats(docs, odd, group):
    names = ("doc_id", "n_words", "n_removed", "kept_sha256")
    for frame in (docs, odd):
        assert counted(repeats.remove(frame, group=group), *names) == without_repeats(rows_of(frame))
    assert repeats.remove(odd.where("false")).count() == 0
    assert repeats.cut(odd).columns == odd.columns


def test_quotes(spark):
    rows = [
        (1, 0, "user", "Hello there\nHow are you?\n\nSecond  para"),
        (1, 1, "assistant", "> how ARE you?\nFine.\n> second para\nok"),
        (1, 2, "user", "> > How are you?\n> Fine.\nGood"), (1, 3, "x", ">> a\n> b"),
        (1, 4, "u", "> Hello there\n> How are you?\n> \n> Second para\nyes"), (2, 0, None, None),
        (2, 1, "a", ""), (2, 1, "a", ""), (None, 0, "q", "> x"), (3, None, "q", "> x\ny"),
        (4, 0, "u", "ok"), (4, 1, "a", "ok"), (4, 2, "u", "> ok\nq"), (4, 3, "u", "\t> q\n\x01a"),
    ]
    said = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    found = {(r["conv_id"], r["turn"]): r for r in quotes.linked(said).collect()}
    assert [found[1, i]["reply_to"] for i in range(5)] == [None, 0, 1, None, 0]
    assert [found[1, i]["thread"] for i in range(5)] == [0, 0, 0, 3, 0]
    assert found[1, 2]["body"] == "Good" and found[1, 2]["depth"] == 2
    assert found[4, 2]["reply_to"] == 1
    con = duckdb.connect()
    table = said.toArrow()
    con.register("conversations", table)
    assert oracle.compare(quotes.linked(said), quotes.linked_sql(), con) == len(rows)
    assert quotes.linked(said.where("false")).count() == 0
    chats = {r["conv_id"]: [m["turn"] for m in r["messages"]] for r in quotes.conversations(said).collect()}
    assert chats[1] == [0, 1, 2, 4, 3]


def test_quotes_of_parts_of_a_message(spark):
    long = "First one\nsecond line\nthird line\n\nA paragraph\nof two\n\nThe end\nof it\n\nBye"
    rows = [
        (1, 0, "u", long), (1, 1, "a", "The end\nof it"),
        (1, 2, "u", "> A paragraph of\n> two\n>\n> the end\n> of it\nyes"),
        (1, 3, "a", "> first one\n> Second line\nno"), (1, 4, "a", "> second line\n> else\nno"),
        (1, 5, "a", "> second line\n>\n> Bye\nso\n> First one\n> third line\nthen\n> nowhere"),
        (1, 6, "a", ">> First one\n>> third line\n> no\nwell"), (2, 0, "a", "> First one\n> third line"),
        (1, 3, "a", "> first one\n> Second line\nno"), (1, 7, "u", long), (1, 8, "a", "> The end\n> of it\n> Bye"),
    ]
    said = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    found = quotes.linked(said).collect()
    assert len(found) == len(rows)
    at = {(r["conv_id"], r["turn"]): r for r in found}
    assert [at[1, i]["reply_to"] for i in range(9)] == [None, None, 0, 0, None, 0, 4, None, 7]
    assert [at[1, i]["n_linked"] for i in range(9)] == [0, 0, 1, 2, 0, 2, 2, 0, 1]
    assert [at[1, i]["thread"] for i in (2, 3, 4, 5, 8)] == [0, 0, 4, 0, 7]
    assert at[2, 0]["reply_to"] is None and at[1, 5]["n_quotes"] == 3


def test_quotes_with_a_common_line(spark):
    """Each message quotes a line that all hold and one of its own: the work must not go by their product."""
    n = 1500
    rows = [(1, 0, "u", "line 0\nyes\nno")] + [
        (1, i, "u", f"> line {i - 1}\n> yes\nsays\n\nline {i}\nyes\nno") for i in range(1, n)
    ]
    said = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    start = time.perf_counter()
    found = {r["turn"]: r["reply_to"] for r in quotes.linked(said).collect()}
    assert time.perf_counter() - start < 120
    assert found == {0: None, **{i: i - 1 for i in range(1, n)}}


def test_quotes_put_in_by_rule_are_linked(spark):
    found = queries.QUERIES["op8_quotes_put_in"](spark, "/root/testdata/sf0.01")
    assert found.where("n_linked > 0 and reply_to is not null").count() > 20
    assert found.where("depth = 2").count() > 5
