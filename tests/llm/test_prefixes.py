"""The prefix tree against a plain one, and its brackets against a plain stack."""

import collections
import hashlib
import random
import zlib

import duckdb
import numpy as np
import oracle
import pytest

from daystrata.llm import prefixes, queries

SF = "/root/testdata/sf0.01"


def mixed(rows):
    """Turns by conversation, rebuilt by the rule."""
    said = collections.defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            said[conv_id].append(((turn is not None, turn or 0, role, digest), (role, text)))
    said = {c: [turn for _, turn in sorted(turns)] for c, turns in said.items()}
    out = {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = said.get(base, [])[:h] + own[h:]
    return out


def plain_tree(paths):
    members = collections.defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children, leaves, saved = collections.Counter(), collections.Counter(), collections.Counter()
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, mine in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(mine) - 1) * len(node[-1][1]) if node else 0
    return collections.Counter(
        (
            min(mine), len(node), min(members[node[:-1]]) if node else None, len(mine), children[node],
            leaves[node], saved[node],
            hashlib.sha256(",".join(str(c) for c in sorted(mine) if len(paths[c]) == len(node)).encode()).hexdigest(),
        )
        for node, mine in members.items()
    )


def told(frame):
    assert frame.columns == list(prefixes.COLUMNS)
    return collections.Counter(map(tuple, frame.collect()))


def random_rows(seed, conversations=260):
    rng = random.Random(seed)
    rows = []
    for c in range(-30, conversations):
        alike = rng.random() < 0.35
        for turn in range(rng.randrange(1, 9)):
            text = "same" if alike else rng.choice(["", "a", "bé", "ccc"])
            rows.append((c, turn if rng.random() < 0.9 else None, rng.choice(["u", None]) if not alike else "u", text))
    rows += [(None, 0, "u", "x"), (7, 1, "u", "again"), (7, 1, "u", "again"), (500, None, None, None)]
    rows += [(601, 0, "u", "q"), (10**15, 3, "u", "long " * 3000)]
    return rows


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize("shard,block", [(200_000, 5_000), (40, 3), (1, 1)])
def test_equals_a_plain_tree(spark, shard, block):
    rows = random_rows(shard)
    said = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "role as path", "text as lens", "turn as depth")
    want = plain_tree(mixed(rows))
    for frame in (said, said.repartition(3)):
        paths = prefixes.rebuilt(prefixes.turn_paths(frame))
        assert told(prefixes.tree(paths, shard, block)) == want
    assert prefixes.tree(prefixes.turn_paths(said.where("false"))).count() == 0


def test_one_path_over_many_shards(spark):
    """Copies of one conversation, more than any block or shard holds, among others that extend it."""
    turns = [("u", "hello"), ("a", "yes"), ("u", "so")]
    paths = {c: turns[: 1 + (c % 7 > 0) + (c % 7 > 1)] for c in range(3000)}
    paths |= {c: [*turns, ("a", f"{c % 5}")] for c in range(3000, 3100)} | {9000: [], 9001: []}
    frame = spark.createDataFrame(
        [
            (c, [hashlib.md5(f"{len(r)}:{r}{t}".encode()).hexdigest() for r, t in path], [len(t) for _, t in path])
            for c, path in paths.items()
        ],
        "conv_id bigint, digests array<string>, lens array<bigint>",
    )
    for shard, block in ((2, 100), (200_000, 50), (200_000, 5_000)):
        assert told(prefixes.tree(frame, shard, block)) == plain_tree(paths)


def test_brackets():
    rng = random.Random(2)
    for n in (1, 2, 3, 50, 700, 5000):
        depths = [0]
        while len(depths) < n:
            depths.append(rng.randrange(1, min(depths[-1] + 1, rng.choice([2, 5, 4000])) + 1))
        closes, stack, place = [0] * n, [], 0
        for k, depth in enumerate(depths):
            while len(stack) > depth:
                closes[stack.pop()] = place
                place += 1
            stack.append(k)
            place += 1
        while stack:
            closes[stack.pop()] = place
            place += 1
        tree = prefixes.Parentheses(np.array(depths))
        found = tree.closes()
        assert found.tolist() == closes
        last = [k + (closes[k] - tree.opens[k] + 1) // 2 for k in range(n)]
        leaf = [k + 1 == last[k] for k in range(n)]
        assert tree.leaves(found).tolist() == [sum(leaf[k : last[k]]) for k in range(n)]


def test_long_path_takes_little_time():
    """A path of very many turns costs time in proportion to them."""
    shard = prefixes.Shard()
    path = np.random.default_rng(1).bytes(16 * 300_000)
    shard.add(path, np.ones(300_000, np.int64))
    shard.add(path[:-16] + bytes(16), np.ones(300_000, np.int64))
    shard.built()
    members, least = shard.over_paths(np.array([1, 2]), np.array([5, 3]))
    assert members[0] == 3 and least[0] == 3 and shard.sums(shard.chars)[0] == 300_001
    assert len(shard.keys(range(300_001), path)) == 300_001


def test_equals_its_sql(spark):
    con = duckdb.connect()
    rows = random_rows(9)
    frame = spark.createDataFrame(rows, SCHEMA)
    table = frame.toArrow()
    con.register("conversations", table)
    paths = prefixes.rebuilt(prefixes.turn_paths(frame))
    assert oracle.compare(prefixes.tree(paths), prefixes.tree_sql(), con) > 300
    found = queries.QUERIES["op13_prefix_trie"](spark, SF)
    assert oracle.compare(found, queries.SQL["op13_prefix_trie"], oracle.connection(SF)) > 0
    want = plain_tree(mixed([tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]))
    assert told(found) == want
