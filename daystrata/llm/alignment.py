"""Alignment of two tokenizers' tokens: which tokens of one stand for which of the other.

Both tokenizers cut a text between any character and a space or line end behind it, so a text falls
into units that can be aligned alone, each different one once in a block of neighbouring texts. A unit's
tokens are aligned by divide and conquer: a byte offset near the middle where tokens of both end is
found by bisection and both sides are split in turn; what holds no such offset is one group.

A block is aligned in one task. It leaves its texts as numbers of units, its units as numbers of id pairs,
and its different pairs with their counts. Only the pairs are summed over the corpus; each block then gets
back the counts of its own, however often they stand in it.
"""

from __future__ import annotations

import hashlib
import re
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daystrata.llm.words import in_batches, shipped
from daystrata.sources.files import scratch_dir

#: Bytes of text after which a block ends; a longer text is a block of its own.
BLOCK_BYTES = 4 << 20
#: Units that are encoded and aligned together.
_AT_ONCE = 5_000
#: Tokens on each side of the middle that are tried before all of an interval are looked at.
_NEAR = 32

# A token of the second vocabulary in the low half of a link, one of the first in the high half.
_HALF = 32
_SLOW = re.compile(r"\s\s|[^\S \n]|\x00")
_CUT = re.compile(r"(?<=\S)(?=[ \n])")
_SPACE = "▁"
_TOTALS = ("n_a", "n_b", "n_groups", "n_links")
_SUMS = (*_TOTALS, "n_best", "count_sum")
# What a block leaves: texts (0), its units and pairs as arrays (1), and pairs with counts (2).
_LEFT = (
    "kind int, block bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
    "groups string, units binary, sizes binary, links binary, pairs binary, pair bigint, n bigint"
)
_LEFT_ARROW = pa.schema(
    [
        (name, {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[kind])
        for name, kind in (part.split(" ") for part in _LEFT.split(", "))
    ]
)
_RESULT = "doc_id bigint, " + ", ".join(f"{name} bigint" for name in _SUMS) + ", groups string"


def units_of(text: str) -> list[str]:
    """A space and the text, cut before each space or line end that follows a character."""
    if _SLOW.search(text) or text[:1] in " \n":
        return _CUT.split(" " + text)
    return ("\0 " + text.replace(" ", "\0 ").replace("\n", "\0\n")).split("\0")[1:]


def shared_ends(a: np.ndarray, b: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Which tokens of the first end where one of the second ends, given the offsets where tokens end.

    ``after`` cuts the first's tokens into intervals, whose last ends are shared. Divide and conquer, all
    intervals of a level at once: the shared end nearest an interval's middle, found by bisection of the
    other's ends, splits it, and an interval without one is left as it is.
    """
    found = [after - 1]
    low, high = np.concatenate([[0], after[:-1]]), after
    while len(low):
        wide = high - low > 1
        low, high = low[wide], high[wide]
        middle, cut = (low + high - 2) // 2, np.full(len(low), -1)
        todo, away = np.arange(len(low)), 0
        while len(todo) and away < 2 * _NEAR:
            k = middle[todo] + (away + 1) // 2 * (1 if away % 2 else -1)
            inside = (k >= low[todo]) & (k < high[todo] - 1)
            k = np.where(inside, k, low[todo])
            hit = inside & (b[np.searchsorted(b, a[k])] == a[k])
            cut[todo[hit]] = k[hit]
            away += 1
            reach = (away + 1) // 2
            todo = todo[~hit & ((middle[todo] + reach < high[todo] - 1) | (middle[todo] - reach >= low[todo]))]
        for t in todo.tolist():
            span = np.arange(low[t], high[t] - 1)
            span = span[b[np.searchsorted(b, a[span])] == a[span]]
            if len(span):
                cut[t] = span[np.abs(span - middle[t]).argmin()]
        split = cut >= 0
        found.append(cut[split])
        low, high = np.concatenate([low[split], cut[split] + 1]), np.concatenate([cut[split] + 1, high[split]])
    return np.sort(np.concatenate(found))


class Pair:
    """Two tokenizers: a byte-level one (``tokenizers`` file) and a piece model that puts a space first."""

    def __init__(self, bytes_path: str, pieces_path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_file(bytes_path)
        self.first.no_truncation()
        self.first.no_padding()
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        letters = _byte_letters()
        self.bytes_a = {
            i: bytes(letters[c] for c in token) for token, i in self.first.get_vocab().items()
            if all(c in letters for c in token)
        }
        pieces = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        self.bytes_b = [
            bytes([int(piece[3:5], 16)]) if self.second.is_byte(i) else piece.replace(_SPACE, " ").encode()
            for i, piece in enumerate(pieces)
        ]
        self.lengths_a = np.zeros(self.first.get_vocab_size(), np.int64)
        self.lengths_a[list(self.bytes_a)] = list(map(len, self.bytes_a.values()))
        self.lengths_b = np.array(list(map(len, self.bytes_b)))
        # An id as it is told within a group, and at the end of its tokenizer's part of it.
        self.told_a, self.last_a = _told(len(self.lengths_a), ",", "|")
        self.told_b, self.last_b = _told(len(pieces), ",", ";")
        for i, piece in enumerate(pieces):
            if not self.second.is_byte(i) and (re.search(f"[^{_SPACE}]{_SPACE}", piece) or "\n" in piece):
                raise ValueError(f"piece {piece!r} goes over the end of a unit")

    def ids(self, units: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Both tokenizers' ids of units."""
        one = [x.ids for x in self.first.encode_batch_fast(units, add_special_tokens=False)]
        # The model puts a space first; a letter behind it, taken off again, keeps it from the unit.
        two = self.second.encode(["x" + unit for unit in units], num_threads=1)
        lone = self.second.encode("x")
        if any(ids[: len(lone)] != lone for ids in two):
            raise ValueError("the piece model joins a letter to a space or line end")
        two = [ids[len(lone) :] for ids in two]
        return one, two

    def aligned(self, units: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """For each unit its groups as text, each with ``;`` behind it, and its totals; and all their links."""
        one, two = self.ids(units)
        sizes = np.array([[len(x), len(y)] for x, y in zip(one, two)])
        one, two = (np.fromiter(chain.from_iterable(ids), np.int64) for ids in (one, two))
        text = "".join(units).encode()
        for ids, spelling in ((one, self.bytes_a), (two, self.bytes_b)):
            if b"".join(map(spelling.__getitem__, ids.tolist())) != text:
                raise ValueError("tokens do not spell their text")
        a, b = np.cumsum(self.lengths_a[one]), np.cumsum(self.lengths_b[two])
        after_a, after_b = np.cumsum(sizes, 0).T
        cut_a = shared_ends(a, b, after_a)
        cut_b = np.searchsorted(b, a[cut_a])
        # A link is a stretch between neighbouring ends of either.
        ends = np.union1d(a, b)
        links = one[np.searchsorted(a, ends)] << _HALF | two[np.searchsorted(b, ends)]
        group_a, group_b = np.searchsorted(cut_a, np.arange(len(a))), np.searchsorted(cut_b, np.arange(len(b)))
        told = [self.told_a[one], self.told_b[two]]
        told[0][cut_a], told[1][cut_b] = self.last_a[one[cut_a]], self.last_b[two[cut_b]]
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        words = np.concatenate(told)[order].tolist()
        bounds = [0, *(after_a + after_b).tolist()]
        texts = ["".join(words[i:j]) for i, j in pairwise(bounds)]
        groups = np.diff(np.searchsorted(cut_a, after_a - 1, "right"), prepend=0)
        return texts, np.column_stack([sizes, groups, sizes.sum(1) - groups]), links


def _told(n: int, *marks: str) -> list[np.ndarray]:
    return [np.array([f"{i}{mark}" for i in range(n)], object) for mark in marks]


def _byte_letters() -> dict[str, int]:
    """Which byte a letter of a byte-level vocabulary stands for: printable ones for themselves, the
    others for letters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


_PAIRS: dict[tuple[str, str], Pair] = {}


def _pair(*paths: str) -> Pair:
    if paths not in _PAIRS:
        _PAIRS[paths] = Pair(*paths)
    return _PAIRS[paths]


def _spelled(text: str | None) -> bool:
    """Whether the text has tokens: the piece model writes spaces as a letter that a text may also hold."""
    return bool(text) and _SPACE not in text


class _Block:
    """Neighbouring texts, aligned together."""

    def __init__(self, number: int):
        self.number = number
        self.doc_ids: list[int | None] = []
        self.texts: list[list[str]] = []
        self.bytes = 0

    def add(self, doc_id: int | None, text: str | None) -> None:
        self.doc_ids.append(doc_id)
        self.texts.append(units_of(text) if _spelled(text) else [])
        self.bytes += len(text or "")

    def rows(self, pair: Pair, hashed: bool):
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=1).compress
        place: dict[str, int] = {}
        texts = []
        for units in self.texts:
            for unit in set(units).difference(place):
                place[unit] = len(place)
            texts.append(np.fromiter(map(place.__getitem__, units), np.uint32, len(units)))
        self.texts = []
        names = list(place)
        told: list[str] = []
        totals, links = [np.zeros((0, len(_TOTALS)), np.int64)], []
        for at in range(0, len(names), _AT_ONCE):
            some, sums, found = pair.aligned(names[at : at + _AT_ONCE])
            told += some
            totals.append(sums)
            links.append(found)
        totals = np.concatenate(totals)
        times = np.zeros(len(names), np.int64)
        for doc_id, units in zip(self.doc_ids, texts):
            np.add.at(times, units, 1)
            groups = "".join(map(told.__getitem__, units.tolist()))[:-1]
            if hashed and groups:
                groups = hashlib.sha256(groups.encode()).hexdigest()
            sums = dict(zip(_TOTALS, totals[units].sum(0).tolist()))
            yield {"kind": 0, "doc_id": doc_id, **sums, "groups": groups, "units": squeeze(units.tobytes())}
        if not names:
            return
        pairs, which = np.unique(np.concatenate(links), return_inverse=True)
        sizes = totals[:, 3].astype(np.uint32)
        count = np.bincount(which, np.repeat(times, sizes), len(pairs)).astype(np.int64)
        arrays = {"sizes": sizes, "links": which.astype(np.uint32), "pairs": pairs}
        yield {"kind": 1, **{name: squeeze(array.tobytes()) for name, array in arrays.items()}}
        for code, n in zip(pairs.tolist(), count.tolist()):
            yield {"kind": 2, "pair": code, "n": n}


def _blocks(size: int, hashed: bool, *paths: str):
    def run(batches):
        from pyspark import TaskContext

        # Written before it is read again, so a task that runs twice may number its blocks anew.
        block = _Block(TaskContext.get().partitionId() << 32)
        pair = _pair(*paths)

        def rows():
            nonlocal block
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    block.add(doc_id, text.as_py())
                    if block.bytes >= size:
                        yield from done(block)
                        block = _Block(block.number + 1)
            yield from done(block)

        def done(block):
            for row in block.rows(pair, hashed):
                yield tuple({"block": block.number, **row}.get(name) for name in _LEFT_ARROW.names)

        yield from in_batches(rows(), _LEFT_ARROW)

    return run


def _summed(left: pa.Table, counts: pa.Table) -> pa.Table:
    """A block's texts with the counts of their links: pairs' counts summed by unit, then by text."""
    import zstandard

    restore = zstandard.ZstdDecompressor().decompress
    texts = left.filter(pa.compute.equal(left.column("kind"), 0))
    sums = np.zeros((texts.num_rows, 2), np.int64)
    for row in left.filter(pa.compute.equal(left.column("kind"), 1)).to_pylist():
        pairs = np.frombuffer(restore(row["pairs"]), np.int64)
        weights = np.zeros((len(pairs), 2), np.int64)
        at = np.searchsorted(pairs, counts.column("pair").to_numpy())
        for i, name in enumerate(("best", "count")):
            weights[at, i] = counts.column(name).to_numpy()
        sizes = np.frombuffer(restore(row["sizes"]), np.uint32)
        running = np.zeros((int(sizes.sum()) + 1, 2), np.int64)
        np.cumsum(weights[np.frombuffer(restore(row["links"]), np.uint32)], 0, out=running[1:])
        ends = np.cumsum(sizes)
        by_unit = running[ends] - running[ends - sizes]
        for i, units in enumerate(texts.column("units").to_pylist()):
            sums[i] = by_unit[np.frombuffer(restore(units), np.uint32)].sum(0)
    arrays = [texts.column(name) for name in ("doc_id", *_TOTALS)]
    arrays += [pa.array(sums[:, 0]), pa.array(sums[:, 1]), texts.column("groups")]
    return pa.table(arrays, names=["doc_id", *_SUMS, "groups"])


def align(
    docs: DataFrame, bytes_path: str, pieces_path: str, block: int = BLOCK_BYTES, hashed: bool = False
) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)`` for every row.

    The text behind a space, as tokens of a byte-level vocabulary (a) and of a piece model (b).
    ``groups`` is ``a1,a2|b1;a3|b2,b3``: ids between offsets where tokens of both end; with ``hashed``
    its SHA-256 instead, so that the ids of all texts need not be written. Links are pairs of tokens that
    share bytes. ``count_sum`` adds up how often each link's pair of ids is linked in the whole corpus,
    ``n_best`` counts links whose pair is the commonest of its b id, ties included.

    Null and empty texts, and texts that hold U+2581, which the piece model writes for a space, have no
    tokens: zeros and an empty ``groups``. Null ids and repeated rows stay, each a row of its own; an
    empty table gives no rows; other columns are ignored, whatever their names. A very long text is
    a block of its own, which one task holds. A piece model that rewrites texts otherwise, or joins over
    spaces, is an error.
    """
    spark = docs.sparkSession
    place = scratch_dir(spark, "alignment")
    chosen = shipped(docs).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    cut = _blocks(block, hashed, bytes_path, pieces_path)
    chosen.mapInArrow(cut, _LEFT).write.partitionBy("kind").parquet(place)
    left = spark.read.schema(_LEFT)
    named = left.parquet(place).where("kind = 2").select("block", "pair", "n")
    counted = named.groupBy("pair").agg(F.sum("n").alias("count"))
    second = F.expr(f"pair & {(1 << _HALF) - 1}")
    most = counted.groupBy(second.alias("b")).agg(F.max("count").alias("most"))
    weights = counted.withColumn("b", second).join(most, "b").select(
        "pair", "count", (F.col("count") == F.col("most")).cast("bigint").alias("best")
    )
    # A pair stands at most once in a block, so the commonest is as rare here as blocks are.
    asked = named.select("block", "pair").join(weights, "pair")
    texts = left.parquet(place).where("kind < 2").drop("pair", "n")
    return texts.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(_summed, _RESULT)


def digests(aligned: DataFrame) -> DataFrame:
    """``align(hashed=True)`` with the hash under its name; empty where there are no tokens."""
    return aligned.withColumnRenamed("groups", "groups_sha256")
