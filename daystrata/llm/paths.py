"""Near-duplicate documents by a chosen-path join on sets of five-word shingles.

Documents with equal shingle sets form one class, found by a hash of the set; the join runs between
classes. A class's minhash values are its tokens. In each run a class follows the tokens that a hash
of the path so far selects, so similar classes tend to follow the same ones; classes on one path
share a bucket. Small buckets are compared pair by pair, large ones are split again by further
tokens, and runs repeat until the target recall. What passes forms clusters. One of more than a block is
split first: linked sets share one of their rarest shingles, so members without such a shingle in common
part. Inside a cluster every pair is then checked exactly, block against block, so links are neither missed
within a cluster nor ever listed: a block pair gives its members' link counts and a spanning forest.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daystrata.llm.words import (
    doc_id_of,
    joined_apart,
    keyed_texts,
    mixed,
    raw_texts,
    rolling,
    shipped,
    slices,
    unused,
    word_hashes,
)
from daystrata.sources.files import checkpointed

#: Words of a shingle; similarity from which documents link, as a fraction of whole numbers.
SHINGLE = 5
SIMILAR = (4, 5)
#: Share of the links that the candidate search must find.
RECALL = 0.99999
#: Minhash values per class, and the share of them by which candidates may fall short.
TOKENS, SLACK = 64, 0.3
#: Largest bucket compared pair by pair, levels of splitting, and linked tokens followed on deeper levels.
BUCKET, LEVELS, FOLLOW = 48, 2, 2.0
#: Share of tokens that agree with a bucket's centre from which a member is split no further: at 0.95 a
#: linked pair has to differ in 30 tokens (chance 1.2e-6) for the other one not to be joined to the centre.
RETIRED = 0.95
#: Classes of one block in the exact check.
BLOCK = 900
#: Frequent shingles of large clusters that are told apart from rare ones, 16 bytes each for every worker.
FREQUENT = 250_000
#: Bits for each document whose set is asked for, and their most.
SPARSE, MOST_BITS = 16, 1 << 26

_KEYS = ["doc_key", "text_key"]


def shingles(words: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """Distinct shingles of a text as sorted 64-bit hashes; a shorter text is one shingle."""
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(rolling(word_hashes(words), min(size, len(words))))


def _coefficients() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240607)
    whole = np.iinfo(np.uint64).max
    return (
        rng.integers(1, whole, TOKENS, np.uint64) | np.uint64(1),
        rng.integers(0, whole, TOKENS, np.uint64),
    )


def tokens(shingled: np.ndarray) -> np.ndarray:
    """The minhash values of a set."""
    a, b = _coefficients()
    best = np.full(TOKENS, np.iinfo(np.uint64).max)
    for at in range(0, len(shingled), 4096):
        part = shingled[at : at + 4096, None] * a + b
        best = np.minimum(best, (part ^ (part >> np.uint64(31))).min(0))
    return (best >> np.uint64(32)).astype("<u4")


def _sketched(docs: DataFrame) -> DataFrame:
    def run(batches):
        for batch in slices(batches):
            sets = [shingles(text.split()) for text in raw_texts(batch)]
            keys = [hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets]
            marks = [tokens(s).tobytes() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(keys, pa.binary()), pa.array(marks, pa.binary())],
                names=[*_KEYS, "node", "tokens"],
            )

    ddl = "doc_key bigint, text_key bigint, node binary, tokens binary"
    return keyed_texts(shipped(docs)).mapInArrow(run, ddl)


def _followed(classes: DataFrame, runs: int, share: float) -> DataFrame:
    """``(path, node)``: the tokens each class follows, from ``path`` where it has one, else from the
    start of every run. A token is followed with chance ``share / TOKENS``."""
    limit = np.uint64(min(1.0, share / TOKENS) * float(2**64 - 2**11))
    start = "path" not in classes.columns

    def run(batches):
        place = mixed(np.arange(1, TOKENS + 1, dtype=np.uint64))
        for batch in batches:
            nodes = batch.column(0).to_pylist()
            marks = batch.column(1).to_pylist()
            values = np.frombuffer(b"".join(marks), "<u4").reshape(len(marks), TOKENS)
            named = mixed(values.astype(np.uint64) + place)
            before = (
                [np.uint64(r + 1) for r in range(runs)]
                if start
                else [batch.column(2).to_numpy().astype(np.int64).view(np.uint64)[:, None]]
            )
            for path in before:
                code = mixed(named ^ mixed(path + np.zeros_like(named)))
                row, _ = np.nonzero(mixed(code) < limit)
                chosen = code[mixed(code) < limit]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(chosen.view(np.int64)),
                        pa.array([nodes[i] for i in row], pa.binary()),
                    ],
                    names=["path", "node"],
                )

    columns = ["node", "tokens"] if start else ["node", "tokens", "path"]
    return classes.select(columns).mapInArrow(run, "path bigint, node binary")


def _compared(buckets: DataFrame) -> DataFrame:
    """``(a, b)`` spanning the likely pairs of each small bucket."""
    least = (SIMILAR[0] / SIMILAR[1] - SLACK) * TOKENS

    def run(batches):
        for batch in batches:
            pairs = set()
            for members in batch.column(0):
                nodes = [m["node"].as_py() for m in members]
                marks = b"".join(m["marks"].as_py() for m in members)
                values = np.frombuffer(marks, "u1").reshape(len(nodes), TOKENS)
                # Some rows at a time, as each takes 64 bytes against every member.
                alike = [
                    (values[at : at + 256, None] == values[None]).sum(2, dtype=np.uint8) >= least
                    for at in range(0, len(nodes), 256)
                ]
                pairs.update(_forest(nodes, np.concatenate(alike)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)], names=["a", "b"]
            )

    return buckets.mapInArrow(run, "a binary, b binary")


def _bucketed(rows: DataFrame, marked: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Edges ``(a, b)`` from buckets of up to ``most`` members, and the ``(path, node)`` of larger ones."""
    rows = checkpointed(rows)
    sizes = rows.groupBy("path").agg(F.count("*").alias("n")).where("n > 1")
    shared = checkpointed(rows.join(sizes, "path"))
    small = shared.where(F.col("n") <= most).join(marked, "node")
    buckets = small.groupBy("path").agg(F.collect_list(F.struct("node", "marks")).alias("m"))
    return _compared(buckets.select("m")), shared.where(F.col("n") > most).select("path", "node")


def _joined(large: DataFrame) -> DataFrame:
    """``(a, b)`` that joins all members of a bucket, unseen."""
    centre = large.groupBy("path").agg(F.min("node").alias("b"))
    joined = large.join(centre, "path").where("node <> b")
    return joined.select(F.col("node").alias("a"), "b")


def _marked(classes: DataFrame) -> DataFrame:
    """``(node, marks)``: a byte of each token tells members of a bucket apart, as others agree in it by one
    chance in 256."""
    return classes.select("node", F.unhex(F.regexp_replace(F.hex("tokens"), "(..)......", "$1")).alias("marks"))


def _forest(nodes: list[bytes], linked: np.ndarray) -> list[tuple[bytes, bytes]]:
    """Pairs that join each connected part of a small graph to its least member."""
    label = np.arange(len(nodes), dtype=np.int32)
    order = np.argsort(np.array(nodes, dtype=object))
    rank = np.empty(len(nodes), np.int32)
    rank[order] = label
    label = rank.copy()
    np.fill_diagonal(linked, True)
    while True:
        near = np.where(linked, label[None], np.int32(len(nodes))).min(1)
        if (near == label).all():
            break
        label = near
    return [(nodes[i], nodes[order[label[i]]]) for i in range(len(nodes)) if label[i] != rank[i]]


def _centred(large: DataFrame, classes: DataFrame) -> DataFrame:
    """``(path, node, centre, alike)``: each member of a large bucket against one member picked by hash,
    and the share of their tokens that agree."""
    marked = checkpointed(large.join(classes, "node").select("path", "node", "marks"))
    pick = F.min_by(F.struct("node", "marks"), F.xxhash64("path", "node"))
    centres = marked.groupBy("path").agg(pick.alias("c"), F.count("*").alias("n"))
    centres = checkpointed(
        centres.select("path", F.col("c.node").alias("centre"), F.col("c.marks").alias("central"), "n")
    )

    def run(batches):
        for batch in batches:
            sides = [
                np.frombuffer(b"".join(batch.column(k).to_pylist()), "u1").reshape(-1, TOKENS)
                for k in (2, 4)
            ]
            alike = (sides[0] == sides[1]).mean(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), pa.array(alike, pa.float64())],
                names=["path", "node", "centre", "alike"],
            )

    # A path that a third of all classes are on has one centre for all of them.
    joined = joined_apart(marked, centres, "path").select("path", "node", "marks", "centre", "central")
    return joined.mapInArrow(run, "path bigint, node binary, centre binary, alike double")


def missed(runs: int, similar: float = SIMILAR[0] / SIMILAR[1]) -> float:
    """Chance that no run joins a pair at the threshold whose shared tokens all lie in large buckets, the
    worst case: a token must be followed, and on its path one more on each deeper level."""
    first, deeper = min(1.0, 1 / similar / TOKENS), min(1.0, FOLLOW / similar / TOKENS)
    total = 0.0
    for k in range(TOKENS + 1):
        shared = math.comb(TOKENS, k) * similar**k * (1 - similar) ** (TOKENS - k)
        found = 1.0
        for _ in range(LEVELS - 1):
            found = 1 - (1 - deeper * found) ** k
        total += shared * (1 - first * found) ** (k * runs)
    return total


def runs_for(recall: float) -> int:
    """The fewest runs that miss at most ``1 - recall`` over all levels."""
    runs = 1
    # With no shared token at all, about 1e-45, more runs do not help.
    while missed(runs) > max(1 - recall, 1e-30):
        runs += 1
    return runs


def candidates(classes: DataFrame, recall: float = RECALL) -> DataFrame:
    """``(a, b)`` whose connected parts hold, but for a chance of ``1 - recall`` each, every pair of
    classes that links. ``classes``: ``(node, tokens)``.

    In a large bucket all members alike to one of them are joined to it. Those nearly equal to it then
    leave the bucket, as whatever links with them is alike to it too; the others are split further.
    """
    similar = SIMILAR[0] / SIMILAR[1]
    marked = _marked(classes)
    # On average one shared token of a linked pair is followed in a run.
    rows = _followed(classes, runs_for(recall), 1 / similar)
    edges = None
    for level in range(LEVELS):
        found, large = _bucketed(rows, marked, BUCKET)
        edges = found if edges is None else edges.unionAll(found)
        if level == LEVELS - 1:
            # Still large: alike in many tokens. All its members go on together, to be split if they are many.
            return edges.unionAll(_joined(large)).distinct()
        centred = checkpointed(_centred(large, marked))
        near = centred.where(F.col("alike") >= similar - SLACK).where("node <> centre")
        edges = edges.unionAll(near.select(F.col("node").alias("a"), F.col("centre").alias("b")))
        rest = centred.where(F.col("alike") < RETIRED).select("path", "node")
        rows = _followed(rest.join(classes, "node"), 1, FOLLOW / similar)
    return edges


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of an edge, ``root`` being the least of its connected part.

    Large-star and small-star steps in turn: each shrinks the edge table, and their number grows with
    the logarithm of the longest path.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    pairs = checkpointed(pairs.where("a <> b").distinct())
    while True:
        both = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = checkpointed(large.where("a <> b").distinct())
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(
            F.col("b")).alias("a"), F.col("m").alias("b"))
        small = checkpointed(small.where("a <> b").distinct())
        same = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        if pairs.agg(F.count("*"), same).first() == small.agg(F.count("*"), same).first():
            break
        pairs = small
    roots = pairs.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)


def prefix(keys: np.ndarray, often: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The rarest of a set's distinct keys, so many that linked sets have one of theirs in common.

    Sets that link share all but ``q - p`` in ``q`` of either's members, so under any one order of all keys
    each has a shared one among its first that many and one more. Keys that ``often`` (sorted) lacks come first.
    """
    p, q = SIMILAR
    size = len(keys) - -(-p * len(keys) // q) + 1
    n = np.zeros(len(keys), np.int64)
    if len(often):
        at = np.minimum(np.searchsorted(often, keys), len(often) - 1)
        n = np.where(often[at] == keys, counts[at], 0)
    return keys[np.lexsort((keys, n))[:size]]


def _parted(sets: DataFrame, marked: DataFrame) -> DataFrame:
    """``(node, root)`` of large clusters split, with linked members in one part; ``sets``: ``(root, node,
    set)``. Members without links may be left out.

    Members that share one of their rarest shingles are compared by marks, as in ``candidates``, or joined
    if they are more than a block. Which shingles count as rare decides on the parts, never on the links.
    """

    def named(batch):
        for root, node, held in zip(*(column.to_pylist() for column in batch.columns)):
            start = mixed(np.frombuffer(root[:8], "<u8"))
            yield node, mixed(np.frombuffer(held, "<u8") ^ start)

    def repeated(batches):
        for batch in slices(batches):
            keys, n = np.unique(np.concatenate([k for _, k in named(batch)]), return_counts=True)
            # What is frequent is there more than once in some of the slices.
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[n > 1].view(np.int64)), pa.array(n[n > 1])], names=["path", "n"]
            )

    counts = sets.mapInArrow(repeated, "path bigint, n bigint").groupBy("path").agg(F.sum("n").alias("n"))
    found = counts.where(F.col("n") > BUCKET).orderBy(F.desc("n"), "path").limit(FREQUENT).toArrow()
    often = found["path"].to_numpy().view(np.uint64)
    order = np.argsort(often)
    known = sets.sparkSession.sparkContext.broadcast((often[order], found["n"].to_numpy()[order]))

    def rarest(batches):
        for batch in slices(batches):
            nodes, firsts = zip(*((node, prefix(keys, *known.value)) for node, keys in named(batch)))
            names = [node for node, first in zip(nodes, firsts) for _ in range(len(first))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(firsts).view(np.int64)), pa.array(names, pa.binary())],
                names=["path", "node"],
            )

    # A repeated document's set is there twice.
    rows = sets.mapInArrow(rarest, "path bigint, node binary").distinct()
    edges, large = _bucketed(rows, marked, BLOCK)
    return components(edges.unionAll(_joined(large)).distinct())


def _sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(doc_key, text_key, set)`` of the documents that ``wanted`` has by its keys, and by chance of some more,
    which a join leaves out: most documents are in no cluster, and their texts are not shuffled."""
    size = 1 << max(wanted.count() * SPARSE, 64).bit_length()
    top = np.uint64(64 - (min(size, MOST_BITS).bit_length() - 1))

    def places(batch):
        doc, text = (batch.column(k).to_numpy().view(np.uint64) for k in (0, 1))
        return mixed(doc ^ mixed(text)) >> top

    def bits(batches):
        for batch in batches:
            at = places(batch)
            bit = np.uint64(1) << (at & np.uint64(63))
            yield pa.RecordBatch.from_arrays(
                [pa.array((at >> np.uint64(6)).view(np.int64)), pa.array(bit.view(np.int64))],
                names=["word", "bits"],
            )

    found = wanted.select(*_KEYS).mapInArrow(bits, "word bigint, bits bigint")
    found = found.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(min(size, MOST_BITS) >> 6, np.uint64)
    words[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    held = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches):
        for batch in slices(batches):
            at = places(batch)
            bit = held.value[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)
            batch = batch.filter(pa.array(bit.astype(bool)))
            sets = [shingles(text.split()).astype("<u8").tobytes() for text in raw_texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(sets, pa.binary())], names=[*_KEYS, "set"]
            )

    return keyed_texts(docs).mapInArrow(run, "doc_key bigint, text_key bigint, set binary")


def _blocks(sets: DataFrame) -> DataFrame:
    """``(node, links, other)``: per block pair, links of each node, and the node that spans with it.

    ``sets``: ``(root, i, j, own, node, n_docs, set)``, each group of ``(root, i, j)`` being two blocks.
    """

    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if held and held[-1][:3] != row[:3]:
                    yield from out(held)
                    held = []
                held.append(row)
        yield from out(held)

    def out(rows):
        # A row that a rerun or a repeated document gives twice counts once.
        rows = list({(row[3], row[4]): row for row in rows}.values())
        if not rows or len({row[4] for row in rows}) < 2:
            return
        left = [row for row in rows if row[3] == row[1]]
        right = left if rows[0][1] == rows[0][2] else [row for row in rows if row[3] == row[2]]
        linked = links([np.frombuffer(r[6], "<u8") for r in left],
                       [np.frombuffer(r[6], "<u8") for r in right])
        nodes = [r[4] for r in left]
        weight = [np.array([r[5] for r in side], np.int64) for side in (left, right)]
        if right is left:
            np.fill_diagonal(linked, False)
            counts = linked @ weight[1]
            graph = linked
        else:
            nodes = nodes + [r[4] for r in right]
            counts = np.concatenate([linked @ weight[1], linked.T @ weight[0]])
            n = len(left)
            graph = np.zeros((len(nodes), len(nodes)), bool)
            graph[:n, n:], graph[n:, :n] = linked, linked.T
        span = dict(_forest(nodes, graph))
        some = [k for k in range(len(nodes)) if counts[k]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([nodes[k] for k in some], pa.binary()),
                pa.array([int(counts[k]) for k in some], pa.int64()),
                pa.array([span.get(nodes[k], nodes[k]) for k in some], pa.binary()),
            ],
            names=["node", "links", "other"],
        )

    return sets.mapInArrow(run, "node binary, links bigint, other binary")


def links(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Which sets of the left link with which of the right, by exact Jaccard similarity."""
    every = left if right is left else left + right
    values, at = np.unique(np.concatenate(every), return_inverse=True)
    owner = np.repeat(np.arange(len(every)), [len(s) for s in every])
    # Only values in two sets or more can be common; they are taken some columns at a time.
    shared = np.bincount(at, minlength=len(values)) > 1
    column = np.cumsum(shared) - 1
    keep = shared[at]
    owner, at = owner[keep], column[at[keep]]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    n = len(left)
    common = np.zeros((n, len(right)), np.float32)
    width = 2048
    for begin in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(at, [begin, begin + width])
        dense = np.zeros((len(every), width), np.float32)
        dense[owner[a:b], at[a:b] - begin] = 1
        common += dense[:n] @ (dense if right is left else dense[n:]).T
    sizes = [np.array([len(s) for s in side]) for side in (left, right)]
    p, q = SIMILAR
    # common / union >= p / q in whole numbers.
    return (p + q) * common.astype(np.int64) >= p * (sizes[0][:, None] + sizes[1][None])


def groups(docs: DataFrame, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """``(doc_id, class_id, n_links, doc_key, text_key, first)`` for every row.

    ``n_links`` counts the other rows whose shingle sets have a Jaccard similarity of 0.8 or more,
    copies included; ``class_id`` is the least ``doc_id`` of the connected part of linked rows, and
    ``first`` marks rows with the least keys there. Words are runs of anything but ASCII white space,
    unchanged; a text below five words is one shingle; texts without words link to nothing and are
    classes of their own. Null text counts as empty; null ids sort first and give a null class;
    repeated rows are copies of each other; an empty table gives no rows; other columns are ignored.
    """
    rows = checkpointed(_sketched(docs))
    classes = checkpointed(
        rows.where("node is not null")
        .groupBy("node")
        .agg(
            F.count("*").alias("n_docs"),
            F.min(F.struct(*_KEYS)).alias("least"),
            F.first("tokens").alias("tokens"),
        )
    )
    clusters = checkpointed(components(candidates(classes.select("node", "tokens"), recall)))
    sizes = clusters.groupBy("root").agg((F.count("*") > block).alias("large"))
    placed = (
        clusters.join(sizes, "root")
        .join(classes.select("node", "n_docs", "least"), "node")
        .select("root", "large", "node", "n_docs", "least.doc_key", "least.text_key")
    )

    placed = checkpointed(placed)
    sets = _sets_of(docs, placed).join(placed, _KEYS)
    sets = checkpointed(sets.select("root", "large", "node", "n_docs", "set"))
    large = sets.where("large")
    parts = checkpointed(_parted(large.select("root", "node", "set"), _marked(classes)))
    sizes = parts.groupBy("root").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("own")
    parted = large.drop("root").join(parts.join(sizes, "root"), "node")
    whole = sets.where("not large").withColumn("blocks", F.lit(1))
    columns = ["root", "blocks", "node", "n_docs", "set"]
    sets = whole.select(columns).unionAll(parted.select(columns)).withColumn("own", own)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    paired = sets.select("*", other).select(
        "root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        "own", "node", "n_docs", "set",
    )
    dealt = paired.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j")
    checked = checkpointed(_blocks(dealt))
    counted = checked.groupBy("node").agg(F.sum("links").alias("links"))
    spans = checked.select(F.col("node").alias("a"), F.col("other").alias("b"))
    joined = components(spans)
    known = (
        classes.select("node", "n_docs", "least")
        .join(counted, "node", "left")
        .join(joined, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    known = checkpointed(known)
    heads = known.groupBy("root").agg(F.min("least").alias("head"))
    named = known.join(heads, "root").select(
        "node", "head", (F.coalesce("links", F.lit(0)) + F.col("n_docs") - 1).alias("n_links")
    )
    alone = F.col("head").isNull()
    own = (F.col("doc_key") == F.col("head.doc_key")) & (F.col("text_key") == F.col("head.text_key"))
    rows = rows.join(named, "node", "left").withColumn(
        "class_key", F.coalesce("head.doc_key", "doc_key")
    )
    return rows.select(
        doc_id_of("doc_key"),
        doc_id_of("class_key").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        *_KEYS,
        (alone | own).alias("first"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one of each group of linked ones, the least by id; all columns stay.

    Texts without words link to nothing and stay; of rows with one id and text one stays, a null id
    counting as an id; an empty table stays empty.
    """
    kept = groups(docs).where("first").select(*_KEYS).distinct()
    doc_key, text_key = (unused(name, docs.columns) for name in _KEYS)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    named = docs.withColumns(
        {
            doc_key: F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))),
            text_key: F.xxhash64(text),
        }
    )
    kept = kept.select(F.col("doc_key").alias(doc_key), F.col("text_key").alias(text_key))
    left = named.join(kept, [doc_key, text_key], "left_semi")
    # Rows repeated whole lie in one partition already.
    return left.dropDuplicates([doc_key, text_key]).drop(doc_key, text_key)
