"""Clusters of more than a block are split by rare shingles, and only clustered documents' sets are shuffled."""

import collections
import random
import time

import brute
import numpy as np
from pyspark.sql import functions as F

from daystrata.llm import paths
from daystrata.sources.files import checkpointed


def word(rng):
    return "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8))


def line(rng, n):
    return [word(rng) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def found(spark, rows, **sizes):
    out = paths.groups(frame(spark, rows), **sizes).select("doc_id", "class_id", "n_links").collect()
    return collections.Counter(map(tuple, out))


def test_a_common_line_does_not_pair_every_block_with_every_other(spark, monkeypatch):
    rng = random.Random(3)
    common = line(rng, 20)
    rows = [(i, " ".join(common + line(rng, 5))) for i in range(200)]
    # Two real pairs among them, one with one word changed at the end of a long text.
    long = line(rng, 60)
    rows += [(200, " ".join(common + long)), (201, " ".join(common + long[:-1] + ["other"]))]
    rows += [(202, rows[0][1] + " more"), (7, rows[7][1])]
    dealt, blocks = [], paths._blocks

    def counted(sets):
        dealt.append(sets.count())
        return blocks(sets)

    monkeypatch.setattr(paths, "_blocks", counted)
    assert found(spark, rows, block=10) == brute.groups(rows)
    # 20 blocks and more took each set 20 times before.
    assert dealt[0] < 2 * len(rows)


def test_links_inside_large_clusters_are_all_found(spark, monkeypatch):
    rng = random.Random(4)
    rows = []
    for base in range(3):
        common = line(rng, 25)
        for _ in range(60):
            words = list(common)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 6])):
                words[rng.choice([0, 1, 12, 23, 24, rng.randrange(25)])] = word(rng)
            rows.append((len(rows), " ".join(words + line(rng, rng.choice([0, 0, 1, 3])))))
    rows += [(rng.randrange(180), rows[k][1]) for k in range(0, 180, 9)] + [(None, ""), (500, None), (501, rows[3][1])]
    rows = [(i if i is not None else 502, t) for i, t in rows]
    expected = brute.groups(rows)
    assert max(n for _, _, n in expected) > 20
    for block, frequent, most in ((5, 250_000, 3), (16, 3, 48), (5, 0, 1)):
        monkeypatch.setattr(paths, "FREQUENT", frequent)
        monkeypatch.setattr(paths, "BUCKET", most)
        assert found(spark, rows, block=block) == expected, (block, frequent, most)


def test_linked_sets_share_one_of_their_rarest_keys():
    rng = np.random.default_rng(5)
    p, q = paths.SIMILAR
    linked = 0
    for _ in range(3000):
        every = rng.choice(10**6, rng.integers(1, 40), replace=False).astype(np.uint64)
        one, two = (every[rng.random(len(every)) < 0.92] for _ in range(2))
        if not len(one) or not len(two):
            continue
        often = np.sort(every[rng.random(len(every)) < 0.5])
        counts = rng.integers(1, 5, len(often))
        common = len(np.intersect1d(one, two))
        if (p + q) * common >= p * (len(one) + len(two)):
            linked += 1
            firsts = [paths.prefix(keys, often, counts) for keys in (one, two)]
            assert len(np.intersect1d(*firsts)), (one, two)
    assert linked > 500
    # Rare ones first, and of five keys two.
    keys = np.arange(5, dtype=np.uint64)
    assert paths.prefix(keys, keys[:4], np.array([9, 7, 8, 9])).tolist() == [4, 1]
    assert len(paths.prefix(keys[:1], keys[:0], np.zeros(0, int))) == 1


def test_sets_are_made_of_all_wanted_documents_and_few_others(spark):
    rng = random.Random(6)
    docs = frame(spark, [(i, " ".join(line(rng, 9))) for i in range(3000)] + [(None, None), (7, None)])
    keys = paths.keyed_texts(docs).select("doc_key", "text_key")
    wanted = keys.where("doc_key % 100 = 7 or doc_key < 0")
    got = paths._sets_of(docs, wanted)
    assert got.join(wanted, ["doc_key", "text_key"]).count() == wanted.count() == 32
    assert got.count() < 500
    text = docs.where("doc_id = 107").first()["text"]
    held = got.where("doc_key = 107").select(F.col("set").alias("s")).first()["s"]
    assert np.frombuffer(held, "<u8").tolist() == paths.shingles(text.encode().split()).tolist()
    assert paths._sets_of(docs, wanted.where("false")).count() == 0


def test_shuffles_go_once_their_rows_are_checkpointed(spark):
    def written():
        env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
        names = env.blockManager().diskBlockManager().getAllFiles().mkString(" ")
        return {name for name in names.split() if "shuffle_" in name}

    before = written()
    counted = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    kept = checkpointed(counted)
    for _ in range(50):
        if not written() - before:
            break
        time.sleep(0.1)
    assert not written() - before
    assert kept.join(counted, ["k", "count"]).count() == 10
    assert checkpointed(counted).count() == 10
