"""Packing of tokenised documents into sequences of several context sizes.

Full windows of the longest context leave a document at once. What remains of it is routed to the
smallest context that holds it. Within a task each context is packed on its own, longest remainder
first; the gap that a remainder leaves in its window is filled from the shorter contexts, the last
filler being cut to fit, so a window of any context comes out full. Windows of one context then
form step groups of equal token counts.

It is one narrow pass: nothing is shuffled, and a task holds at most ``POOL`` remainders. A
sequence's number is the task's plus a running one, and a task run again sees the same rows in the
same order, so the numbers survive lost executors.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daystrata.llm.words import coder, in_batches, shipped, slices, string_texts, text_of

#: Context sizes, shortest first; sequences of these lengths need no padding.
CONTEXTS = (64, 128, 256, 512, 1024, 2048)
#: Tokens that one step group holds.
STEP_TOKENS = 16_384
#: Remainders that a task gathers before it packs them.
POOL = 4096

_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("context", pa.int32()),
        ("step_group", pa.int64()),
    ]
)
_DDL = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, context int, step_group bigint"
)


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    contexts: Sequence[int] = CONTEXTS,
    step_tokens: int = STEP_TOKENS,
    pool: int = POOL,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece of a document: where it lies in the document and in which sequence.

    Every document ends with ``end_id``. Each id lies in exactly one piece. Null text counts as
    empty, giving one piece with the end alone; repeated rows and repeated ids are packed as rows
    of their own; an empty table gives no rows; other columns are ignored. Ties are taken in the
    order read. Per task at most one sequence, below the shortest context, is left to be padded.
    ``with_ids`` adds the piece's ids.
    """
    sizes = tuple(sorted(contexts))
    if not sizes or any(size & (size - 1) for size in sizes):
        raise ValueError("contexts must be powers of two")
    schema = _SCHEMA.append(pa.field("ids", pa.list_(pa.int32()))) if with_ids else _SCHEMA
    ddl = _DDL + (", ids array<int>" if with_ids else "")

    def run(batches):
        from pyspark import TaskContext

        packer = Packer(sizes, step_tokens, pool, TaskContext.get().partitionId() << 36)

        def rows():
            code = coder(tokenizer, True)
            for batch in slices(batches):
                ids, texts = batch.column(0).to_pylist(), string_texts(batch)
                code.learn(texts)
                for doc_id, text in zip(ids, texts):
                    tokens = np.append(code.ids(text), [end_id]).astype("<u4")
                    yield from packer.add(doc_id, tokens)
            yield from packer.close()

        def out():
            for doc_id, start, tokens, total, sequence, offset, context, step in rows():
                row = (
                    doc_id, start, len(tokens), zlib.crc32(tokens), total, sequence, offset,
                    context, step,
                )
                yield row + (tokens.astype("i4"),) if with_ids else row

        yield from in_batches(out(), schema, 256 if with_ids else 2000)

    chosen = shipped(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of())
    return chosen.mapInArrow(run, ddl)


def _length(piece: tuple) -> int:
    return len(piece[2])


class Packer:
    """Packs one task's documents; yields pieces as tuples."""

    def __init__(self, sizes: tuple[int, ...], step_tokens: int, pool: int, base: int):
        self.sizes, self.step_tokens, self.pool, self.base = sizes, step_tokens, pool, base
        self.tiers: list[list[tuple]] = [[] for _ in sizes]
        self.held = self.sequences = self.groups = 0
        #: Per context: the open step group and the sequences it holds.
        self.open: dict[int, list[int]] = {}

    def add(self, doc_id, tokens: np.ndarray):
        """Full windows at once; the remainder waits in its tier."""
        longest, total = self.sizes[-1], len(tokens)
        full = total - total % longest
        for start in range(0, full, longest):
            yield from self._sequence([(doc_id, start, tokens[start : start + longest], total)])
        if full < total:
            self._put((doc_id, full, tokens[full:], total))
        if self.held >= self.pool:
            yield from self._drain(False)

    def close(self):
        yield from self._drain(True)

    def _put(self, piece: tuple) -> None:
        """Tiers are kept by length, shortest first."""
        tier = next(i for i, size in enumerate(self.sizes) if len(piece[2]) <= size)
        insort(self.tiers[tier], piece, key=_length)
        self.held += 1

    def _take(self, tier: int, at: int) -> tuple:
        self.held -= 1
        return self.tiers[tier].pop(at)

    def _drain(self, last: bool):
        """Packs the tiers from the longest down; what cannot fill a window stays, or at the end
        goes out in the largest windows that it fills."""
        for at in range(len(self.sizes) - 1, -1, -1):
            while self.tiers[at]:
                window, room = [], self.sizes[at]
                while room and (found := self._filler(at, room)):
                    doc_id, start, tokens, total = self._take(*found)
                    window.append((doc_id, start, tokens[:room], total))
                    if len(tokens) > room:
                        self._put((doc_id, start + room, tokens[room:], total))
                    room -= min(room, len(tokens))
                if not room:
                    yield from self._sequence(window)
                    continue
                # Everything at or below this tier is in the window, and does not fill it.
                if last:
                    yield from self._tail(window)
                for piece in () if last else window:
                    self._put(piece)
                return

    def _filler(self, at: int, room: int) -> tuple[int, int] | None:
        """The longest remainder that fits, else the shortest, which will be cut."""
        for tier in range(at, -1, -1):
            if fitting := bisect_right(self.tiers[tier], room, key=_length):
                return tier, fitting - 1
        return next(((tier, 0) for tier in range(at + 1) if self.tiers[tier]), None)

    def _tail(self, window: list[tuple]):
        left = sum(len(piece[2]) for piece in window)
        while left:
            size = next((s for s in reversed(self.sizes) if s <= left), left)
            part, room = [], size
            while room:
                doc_id, start, tokens, total = window.pop(0)
                part.append((doc_id, start, tokens[:room], total))
                if len(tokens) > room:
                    window.insert(0, (doc_id, start + room, tokens[room:], total))
                room -= min(room, len(tokens))
            left -= size
            yield from self._sequence(part)

    def _sequence(self, pieces: list[tuple]):
        length = sum(len(piece[2]) for piece in pieces)
        context = next(size for size in self.sizes if length <= size)
        group = self.open.get(context)
        if group is None or (group[1] + 1) * context > self.step_tokens:
            group = self.open[context] = [self.base + self.groups, 0]
            self.groups += 1
        group[1] += 1
        sequence, offset = self.base + self.sequences, 0
        self.sequences += 1
        for doc_id, start, tokens, total in pieces:
            tokens = np.ascontiguousarray(tokens)
            yield doc_id, start, tokens, total, sequence, offset, context, group[0]
            offset += len(tokens)
