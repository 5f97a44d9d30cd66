"""Prefix tree of conversations, as balanced parentheses by shard.

Each conversation is a path of turn digests. Paths are range-partitioned and sorted, so every task sees
neighbouring ones, and cuts them into shards of bounded size. A shard writes its part of the tree as
parentheses in preorder; range minima of the excess over blocks find each opening's close, so a node's
subtree is a range, in which counting ``()`` pairs gives its leaves and differences of running sums give
members and savings. Only nodes on a shard's first and last path can go on in another shard. These
spines are put together once more by the same means, and what hangs between them is final already.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daystrata.llm.words import shipped
from daystrata.sources.files import fits_broadcast, scratch_dir

#: Nodes after which a shard ends; bounds a task's memory. A single longer path is a shard of its own.
SHARD_NODES = 200_000
#: Ids of one node that are held before they are handed on as a block of text.
BLOCK_IDS = 5_000
#: Bytes of a turn's digest.
WIDTH = 16
_BLOCK = 64

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
_NONE = hashlib.sha256(b"").hexdigest()
_FAR = np.iinfo(np.int64).max

# One table holds what shards give: nodes (0), spines (1), and ids or their hash for nodes on spines (2).
_PARTS = (
    "kind int, conv_id bigint, depth bigint, parent_conv_id bigint, parent_key binary, n_convs bigint, "
    "n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string, node_key binary, "
    "path binary, lens array<bigint>, members array<bigint>, least array<bigint>, children array<bigint>, "
    "leaves array<bigint>, saved array<bigint>, block string"
)
_LISTS = ("lens", "members", "least", "children", "leaves", "saved")
_ARROW = pa.schema(
    [
        (name, pa.list_(pa.int64()) if kind.startswith("array") else
         {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "string": pa.string()}[kind])
        for name, kind in (part.split(" ") for part in _PARTS.split(", "))
    ]
)


class Parentheses:
    """A tree, given by its nodes' depths in preorder, as one bit per bracket."""

    def __init__(self, depths: np.ndarray):
        n = len(depths)
        # Before node k opens, k nodes have opened, and all but its ``depth`` ancestors have closed.
        self.opens = 2 * np.arange(n) - depths
        bits = np.zeros(2 * n, bool)
        bits[self.opens] = True
        self.excess = np.cumsum(np.where(bits, 1, -1))
        blocks = -(-2 * n // _BLOCK)
        self.blocks = np.full(blocks * _BLOCK, _FAR)
        self.blocks[: 2 * n] = self.excess
        self.blocks = self.blocks.reshape(blocks, _BLOCK)
        # Least excess of blocks, of pairs of blocks, and so on up to one.
        self.size = 1 << max(blocks - 1, 0).bit_length()
        self.least = np.full(2 * self.size, _FAR)
        self.least[self.size : self.size + blocks] = self.blocks.min(1)
        at = self.size
        while at > 1:
            level = self.least[at : 2 * at]
            self.least[at // 2 : at] = np.minimum(level[::2], level[1::2])
            at //= 2
        # Pairs that open and close at once are the leaves; how many there are before each place.
        pair = bits & ~np.append(bits[1:], True)
        self.pairs = np.concatenate([[0], np.cumsum(pair)])
        self.is_leaf = pair[self.opens]

    def closes(self) -> np.ndarray:
        """Each node's closing place: the first after its opening with less excess."""
        out = np.empty(len(self.opens), np.int64)
        for at in range(0, len(out), 1 << 14):
            out[at : at + (1 << 14)] = self._closes(self.opens[at : at + (1 << 14)])
        return out

    def _closes(self, opens: np.ndarray) -> np.ndarray:
        wanted = self.excess[opens] - 1
        block = opens // _BLOCK
        hit = (self.blocks[block] <= wanted[:, None]) & (np.arange(_BLOCK) > (opens % _BLOCK)[:, None])
        out = block * _BLOCK + hit.argmax(1)
        rest = np.flatnonzero(~hit.any(1))
        node, wanted = block[rest] + self.size, wanted[rest]
        climbing = np.ones(len(rest), bool)
        while climbing.any():
            beside = climbing & (node % 2 == 0)
            beside[beside] = self.least[node[beside] + 1] <= wanted[beside]
            climbing &= ~beside
            node = np.where(beside, node + 1, np.where(climbing, node // 2, node))
        while (node < self.size).any():
            inner = node < self.size
            left = np.where(inner, 2 * node, node)
            node = np.where(inner & (self.least[left] > wanted), left + 1, left)
        block = node - self.size
        out[rest] = block * _BLOCK + (self.blocks[block] <= wanted[:, None]).argmax(1)
        return out

    def leaves(self, closes: np.ndarray) -> np.ndarray:
        """How many ``()`` pairs lie in each node's range."""
        return self.pairs[closes + 1] - self.pairs[self.opens]


class Shard:
    """Sorted distinct paths and the tree they span."""

    def __init__(self):
        self.paths: list[bytes] = []
        self.lens: list[np.ndarray] = []
        self.shared: list[int] = []
        self.above: list[int] = []
        self.stack: list[int] = []
        self.nodes = 0

    def add(self, path: bytes, lens) -> None:
        depth = len(path) // WIDTH
        if self.paths:
            shared = _shared(self.paths[-1], path)
            self.above.append(self.stack[shared])
            del self.stack[shared + 1 :]
            self.shared.append(shared)
        else:
            self.above.append(0)
            self.shared.append(-1)
        new = depth - self.shared[-1]
        self.stack.extend(range(self.nodes, self.nodes + new))
        self.nodes += new
        self.paths.append(path)
        self.lens.append(np.asarray(lens, np.int64))

    def built(self) -> None:
        """The tree: arrays by node, in preorder."""
        depth = np.array([len(path) // WIDTH for path in self.paths])
        shared = np.array(self.shared)
        new = depth - shared
        end = np.cumsum(new)
        self.owner = np.repeat(np.arange(len(new)), new)
        within = np.arange(self.nodes) - np.repeat(end - new, new)
        self.depth = within + np.repeat(shared + 1, new)
        self.parent = np.where(within == 0, np.repeat(np.array(self.above), new), np.arange(self.nodes) - 1)
        self.parent[0] = 0
        self.ends = end - 1
        parts = [lens[max(s, 0) :] for lens, s in zip(self.lens, self.shared)]
        self.chars = np.concatenate([np.zeros(1, np.int64), *parts])
        self.tree = Parentheses(self.depth)
        self.close = self.tree.closes()
        self.last = np.arange(self.nodes) + (self.close - self.tree.opens + 1) // 2

    def sums(self, values: np.ndarray) -> np.ndarray:
        """The values' sums over each node's subtree."""
        running = np.concatenate([[0], np.cumsum(values)])
        return running[self.last] - running[:-1]

    def over_paths(self, count: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Members and least member of each node, its paths being neighbours."""
        low, high = self.owner, self.owner[self.last - 1] + 1
        running = np.concatenate([[0], np.cumsum(count)])
        ranges = np.empty(2 * self.nodes, np.int64)
        ranges[::2], ranges[1::2] = low, high
        least = np.minimum.reduceat(np.append(first, _FAR), ranges)[::2]
        return running[high] - running[low], least

    def keys(self, nodes, path: bytes) -> dict[int, bytes]:
        """Names of the nodes along one path, equal in every shard."""
        out, state = {}, hashlib.md5()
        for d, node in enumerate(nodes):
            out[node] = state.copy().digest()
            state.update(path[d * WIDTH : (d + 1) * WIDTH])
        return out


def _shared(one: bytes, two: bytes) -> int:
    """The depth down to which two paths are the same."""
    n = min(len(one), len(two))
    if one[:n] == two[:n]:
        return n // WIDTH
    differ = np.frombuffer(one, np.uint8, n) != np.frombuffer(two, np.uint8, n)
    return int(differ.argmax()) // WIDTH


def _key(path: bytes) -> bytes:
    return hashlib.md5(path).digest()


class _Members:
    """The ids that end on the path at hand, and what they leave behind."""

    def __init__(self):
        self.held: list[str] = []
        self.from_id = 0
        self.blocks = 0
        self.count = 0
        self.first = 0

    def add(self, conv_id: int) -> None:
        if not self.count:
            self.first = conv_id
        if not self.held:
            self.from_id = conv_id
        self.held.append(str(conv_id))
        self.count += 1

    def block(self, path: bytes) -> dict:
        self.blocks += 1
        row = {"kind": 2, "node_key": _key(path), "conv_id": self.from_id, "block": ",".join(self.held)}
        self.held = []
        return row


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_ARROW)


def _shards(size: int, block: int):
    """Over sorted ``(path, lens, conv_id)``: final nodes, spines and blocks of ids."""

    def closed(shard: Shard, told: list, last: _Members):
        """``told`` has count, first id and hash of ends by path; the last path's ids are still held."""
        path = shard.paths[-1]
        if last.held:
            yield _batch([last.block(path)])
        shard.built()
        count = np.array([c for c, _, _ in told] + [last.count])
        first = np.array([f for _, f, _ in told] + [last.first])
        members, least = shard.over_paths(count, first)
        top, bottom = np.arange(len(shard.paths[0]) // WIDTH + 1), np.array(shard.stack)
        inner = np.ones(shard.nodes, bool)
        inner[top] = inner[bottom] = False
        keys = {**shard.keys(bottom.tolist(), path), **shard.keys(top.tolist(), shard.paths[0])}
        children = np.bincount(shard.parent[inner], minlength=shard.nodes)
        leaves = shard.sums(shard.tree.is_leaf & inner)
        saved = shard.sums(np.where(inner, (members - 1) * shard.chars, 0))
        # What hangs on a spine node itself, not on the spine below it.
        spine = np.flatnonzero(~inner)[1:]
        own = {"leaves": leaves.copy(), "saved": saved.copy()}
        for name, total in (("leaves", leaves), ("saved", saved)):
            np.subtract.at(own[name], shard.parent[spine], total[spine])
        values = {"members": members, "least": least, "children": children, **own}
        below = bottom[bottom > top[-1]]
        rows = []
        for line, mine, lens in ((shard.paths[0], top, shard.lens[0]), (path, below, shard.lens[-1])):
            if not len(mine):
                continue
            skipped = len(line) // WIDTH + 1 - len(mine)
            row = {"kind": 1, "path": line, "lens": lens.tolist()}
            for name, array in values.items():
                nothing = _FAR if name == "least" else 0
                row[name] = [nothing] * skipped + array[mine].tolist()
            rows.append(row)
        yield _batch(rows)
        at = np.flatnonzero(inner)
        ends: dict[int, str | None] = {}
        names: dict[int, bytes] = {}
        for i, (_, _, digest) in enumerate(told):
            node = int(shard.ends[i])
            if inner[node]:
                ends[node] = digest
                if digest is None:
                    names[node] = _key(shard.paths[i])
            elif digest is not None:
                # The last path goes on from here.
                yield _batch([{"kind": 2, "node_key": keys[node], "ends_sha256": digest}])
        for low in range(0, len(at), 20_000):
            some = at[low : low + 20_000]
            up = shard.parent[some]
            known = inner[up]
            listed = some.tolist()
            columns = {
                "kind": pa.array(np.zeros(len(some), np.int32)),
                "conv_id": pa.array(least[some]),
                "depth": pa.array(shard.depth[some]),
                "parent_conv_id": pa.array(least[up], mask=~known),
                "parent_key": pa.array([None if k else keys[u] for k, u in zip(known, up.tolist())], pa.binary()),
                "n_convs": pa.array(members[some]),
                "n_children": pa.array(children[some]),
                "n_leaves": pa.array(leaves[some]),
                "saved_tokens": pa.array(saved[some]),
                "ends_sha256": pa.array([ends.get(node) for node in listed], pa.string()),
                "node_key": pa.array([names.get(node) for node in listed], pa.binary()),
            }
            yield pa.RecordBatch.from_arrays(
                [columns.get(f.name, pa.nulls(len(some), f.type)).cast(f.type) for f in _ARROW], schema=_ARROW
            )

    def run(batches):
        shard, told, mine = Shard(), [], _Members()
        for batch in batches:
            ids = batch.column(2).to_pylist()
            for path, lens, conv_id in zip(batch.column(0).to_pylist(), batch.column(1), ids):
                if not shard.paths or path != shard.paths[-1]:
                    if shard.nodes >= size:
                        yield from closed(shard, told, mine)
                        shard, told = Shard(), []
                    elif shard.paths:
                        # The first path may have begun in another shard, so its ids are handed on too.
                        if mine.held and (mine.blocks or not told):
                            yield _batch([mine.block(shard.paths[-1])])
                        whole = None if mine.blocks else hashlib.sha256(",".join(mine.held).encode()).hexdigest()
                        told.append((mine.count, mine.first, whole))
                    mine = _Members()
                    shard.add(path, lens.values.to_numpy() if lens.values is not None else [])
                mine.add(conv_id)
                if len(mine.held) >= block:
                    yield _batch([mine.block(path)])
        if shard.paths:
            yield from closed(shard, told, mine)

    return run


def _merged(batches):
    """Over sorted spines: the nodes on them, whole."""
    shard, added = Shard(), []
    for batch in batches:
        for row in batch.to_pylist():
            if not shard.paths or row["path"] != shard.paths[-1]:
                shard.add(row["path"], row["lens"])
            added.append((len(shard.paths) - 1, np.array(shard.stack), {n: row[n] for n in _LISTS[1:]}))
    if not shard.paths:
        return
    shard.built()
    values = {name: np.zeros(shard.nodes, np.int64) for name in _LISTS[1:]}
    values["least"] += _FAR
    names: list[bytes] = [b""] * shard.nodes
    before = -1
    for number, nodes, arrays in added:
        for name, array in arrays.items():
            if name == "least":
                values[name][nodes] = np.minimum(values[name][nodes], array)
            else:
                values[name][nodes] += np.array(array)
        if number != before:
            before = number
            for node, key in shard.keys(nodes.tolist(), shard.paths[number]).items():
                names[node] = key
    members, least = values["members"], values["least"]
    hung = values["children"]
    children = hung + np.bincount(shard.parent[1:], minlength=shard.nodes)
    leaf = shard.tree.is_leaf & (hung == 0)
    leaves = shard.sums(values["leaves"] + leaf)
    saved = shard.sums(values["saved"] + (members - 1) * shard.chars)
    up = np.arange(shard.nodes) > 0
    columns = {
        "kind": pa.array(np.zeros(shard.nodes, np.int32)),
        "conv_id": pa.array(least),
        "depth": pa.array(shard.depth),
        "parent_conv_id": pa.array(least[shard.parent], mask=~up),
        "n_convs": pa.array(members),
        "n_children": pa.array(children),
        "n_leaves": pa.array(leaves),
        "saved_tokens": pa.array(saved),
        "node_key": pa.array(names, pa.binary()),
    }
    table = pa.table(
        [columns.get(f.name, pa.nulls(shard.nodes, f.type)).cast(f.type) for f in _ARROW], schema=_ARROW
    )
    yield from table.to_batches(max_chunksize=20_000)


def _ended(batches):
    """Over blocks sorted by node and first id: the hash of all ids of a node, held one block at a time."""
    key, state = None, None
    done: list[tuple[bytes, str]] = []
    for batch in batches:
        for node, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if node != key:
                if key is not None:
                    done.append((key, state.hexdigest()))
                key, state = node, hashlib.sha256()
            else:
                state.update(b",")
            state.update(block.encode())
        if len(done) >= 5_000:
            yield _ends_batch(done)
            done = []
    if key is not None:
        done.append((key, state.hexdigest()))
        yield _ends_batch(done)


def _ends_batch(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    keys, digests = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.binary()), pa.array(digests, pa.string())], names=["end_key", "all_ends"]
    )


def turn_paths(conversations: DataFrame) -> DataFrame:
    """``(conv_id, digests, lens)``: each conversation's turns in order, as hex digests and code points.

    Turns go by ``turn``, null first, ties by role and then digest; null role and text count as empty;
    repeated rows are turns of their own; rows without ``conv_id`` belong to no conversation. Only
    digests are gathered, some 50 bytes a turn, never texts, so a conversation of a million turns is a row of
    that many small entries.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    turn = F.struct(
        F.col("turn").isNotNull().alias("known"), F.coalesce(F.col("turn").cast("bigint"), F.lit(0)).alias("turn"),
        role.alias("role"), digest.alias("digest"), F.length(text).cast("bigint").alias("chars"),
    )
    said = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), turn.alias("said")
    )
    ordered = said.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("said"))
    return ordered.select("conv_id", F.col("said.digest").alias("digests"), F.col("said.chars").alias("lens"))


def rebuilt(paths: DataFrame, group: int = 100, most: int = 5) -> DataFrame:
    """``turn_paths`` with the first turns of each conversation taken from the first of its ``group``.

    Conversation c gets the first h turns of c - c % group (all if it has fewer, none if it is not
    there), then its own after its first h, h being crc32 of c in decimal modulo ``most`` + 1.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    beginnings = paths.where(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("base"),
        F.slice("digests", 1, most).alias("base_digests"),
        F.slice("lens", 1, most).alias("base_lens"),
    )
    joined = paths.withColumn("base", F.col("conv_id") - F.col("conv_id") % group).join(beginnings, "base", "left")

    def mixed(name: str, kind: str):
        first = F.coalesce(F.slice(f"base_{name}", 1, h), F.array().cast(f"array<{kind}>"))
        own = F.slice(name, h + 1, F.greatest(F.size(name) - h, F.lit(0)))
        return F.concat(first, own).alias(name)

    return joined.select("conv_id", mixed("digests", "string"), mixed("lens", "bigint"))


def tree(paths: DataFrame, shard: int = SHARD_NODES, block: int = BLOCK_IDS) -> DataFrame:
    """One row per distinct beginning of the conversations in ``paths``, as ``turn_paths`` gives them.

    ``conv_id`` (least member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``,
    ``n_children``, ``n_leaves`` (nodes without children in the subtree), ``saved_tokens`` (code points
    that the subtree's members share beyond their first) and ``ends_sha256`` (of the decimal ids, ascending
    and comma-joined, of conversations that end there). A conversation without turns is a member of the
    root; without conversations there is no row. Turns are taken for equal by 128 bits of hash.

    A beginning that a third of all conversations share goes over as many tasks as their rows need: range
    bounds go through equal paths by id. Spines, two paths a shard, are merged by one task; its
    rows are fewer than the nodes by the shard size over twice the depth.
    """
    spark = paths.sparkSession
    place = scratch_dir(spark, "prefixes")
    lines = shipped(paths).select(
        F.unhex(F.array_join("digests", "")).alias("path"), F.col("lens").cast("array<bigint>").alias("lens"), "conv_id"
    )
    spread = lines.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    spread.mapInArrow(_shards(shard, block), _PARTS).write.partitionBy("kind").parquet(f"{place}/shards")
    found = spark.read.schema(_PARTS).parquet(f"{place}/shards")
    spines = found.where("kind = 1").select("path", *_LISTS).coalesce(1).sortWithinPartitions("path")
    spines.mapInArrow(_merged, _PARTS).write.parquet(f"{place}/spines")
    spine = spark.read.schema(_PARTS).parquet(f"{place}/spines")
    blocks = found.where("kind = 2 and block is not null").select("node_key", "block", "conv_id")
    in_order = blocks.repartition("node_key").sortWithinPartitions("node_key", "conv_id")
    in_order.select("node_key", "block").mapInArrow(_ended, "end_key binary, all_ends string").write.parquet(
        f"{place}/ends"
    )
    ends = spark.read.schema("end_key binary, all_ends string").parquet(f"{place}/ends")
    ends = ends.unionAll(found.where("kind = 2 and block is null").select("node_key", "ends_sha256"))
    tops = spine.select(F.col("node_key").alias("top_key"), F.col("conv_id").alias("top_conv_id"))
    # One row per spine node or shared end; broadcast when measured small, else an ordinary join.
    if fits_broadcast(tops, "top_key"):
        tops = F.broadcast(tops)
    if fits_broadcast(ends, "all_ends"):
        ends = F.broadcast(ends)
    nodes = found.where("kind = 0").unionByName(spine)
    # Most nodes ask for neither: a key of another width, different for each, keeps them spread and apart.
    apart = F.unhex(F.hex("conv_id"))
    joined = nodes.join(tops, F.coalesce("parent_key", apart) == F.col("top_key"), "left")
    joined = joined.join(ends, F.coalesce("node_key", apart) == F.col("end_key"), "left")
    return joined.select(
        "conv_id",
        "depth",
        F.coalesce("parent_conv_id", "top_conv_id").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", "all_ends", F.lit(_NONE)).alias("ends_sha256"),
    )


def tree_sql(group: int = 100, most: int = 5) -> str:
    """DuckDB SQL for the tree of the rebuilt conversations."""
    digest = "md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))"
    return f"""with steps as (select i, list_reduce([i::bigint, 0, 1, 2, 3, 4, 5, 6, 7],
        lambda a, k: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) as c from range(256) r(i)),
      crc as (select list(c order by i) as t from steps),
      own as (select conv_id, list({digest} order by turn is not null, turn, coalesce(role, ''), {digest}) as p,
          list(length(coalesce(text, '')) order by turn is not null, turn, coalesce(role, ''), {digest}) as n
        from conversations where conv_id is not null group by conv_id),
      cut as (select own.*, (xor(list_reduce(list_concat([4294967295::bigint],
            list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)),
          lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % {most + 1}) as h from own, crc),
      mixed as (select c.conv_id, list_concat(coalesce(b.p[1:c.h], []), c.p[c.h + 1:]) as p,
          list_concat(coalesce(b.n[1:c.h], []), c.n[c.h + 1:]) as n
        from cut c left join own b on b.conv_id = c.conv_id - c.conv_id % {group}),
      steps_of as (select conv_id, p, n, unnest(range(len(p) + 1)) as d from mixed),
      nodes as (select d as depth, array_to_string(p[1:d], '') as k, any_value(p[1:d]) as path,
          min(conv_id) as conv_id, count(*) as n_convs, any_value(case when d > 0 then n[d] else 0 end) as chars,
          string_agg(conv_id::varchar, ',' order by conv_id) filter (where d = len(p)) as ended
        from steps_of group by all),
      below as (select array_to_string(path[1:depth - 1], '') as k, count(*) as n from nodes where depth > 0 group by 1),
      counted as (select nodes.*, coalesce(below.n, 0) as n_children from nodes left join below using (k)),
      above as (select unnest(range(depth + 1)) as a, path, (n_convs - 1) * chars as saves, n_children = 0 as leaf
        from counted),
      whole as (select array_to_string(path[1:a], '') as k, sum(saves)::bigint as saved_tokens,
          count(*) filter (where leaf) as n_leaves from above group by 1)
    select c.conv_id, c.depth::bigint as depth, up.conv_id as parent_conv_id, c.n_convs, c.n_children, w.n_leaves,
      w.saved_tokens, sha256(coalesce(c.ended, '')) as ends_sha256
    from counted c join whole w using (k)
      left join nodes up on c.depth > 0 and up.k = array_to_string(c.path[1:c.depth - 1], '')"""
