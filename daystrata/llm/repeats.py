"""Removal of word passages that occur more than once anywhere in a corpus.

A suffix is the rest of a document from one word on; a passage is repeated when two suffixes share
their first ``WINDOW`` words, that is, when a node of the corpus's suffix tree lies that deep with two
leaves below it. The tree is never built whole. Suffixes are split into groups by a prefix gram that
both suffixes of a repeat are sure to have: the least-hashed ``GRAM`` words within the first ``WINDOW``.
A group with one member holds no repeat and is dropped before any text moves. Others get a subtree of
their own: suffixes sorted by their words, where neighbours that agree to the full depth mark a deep
node. Where a prefix has more than ``GROUP`` places its group would outgrow memory; its suffixes
are split by a longer prefix, all ``WINDOW`` words, and counted by Spark with partial sums.

Text is shuffled once, by document; both the search and the removal read that one exchange.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daystrata.llm.words import (
    doc_id_of,
    joined_apart,
    keyed_texts,
    mixed,
    packed_texts,
    raw_texts,
    rolling,
    shipped,
    slices,
    unpacked,
    unused,
    word_hashes,
)
from daystrata.sources.files import checkpointed

#: Words of a passage that must not repeat, and of the gram that splits suffixes into groups.
WINDOW, GRAM = 35, 8
#: Places of a gram up to which its suffixes form one subtree.
GROUP = 256
#: Places whose subtrees are sorted at a time.
_AT_ONCE = 8192
#: Bytes kept of a word's hash; passages are equal when all their words are.
_SYMBOL = 5

_KEYS = ["doc_key", "text_key"]


def passages(hashes: np.ndarray, window: int, gram: int, piece: int = 1 << 23):
    """``(grams, first, last)``: the splitting grams of a document's windows, in order, each with the
    first and last window that it splits off.

    Where words go round (one word over and over), a gram follows upon itself at every turn. Behind the
    first such place, which ends what differs before it, its windows are taken together, as many at a time as
    one place can have; so a span with equal windows within it always has another of its gram beside it.

    Places share a word with the hash, so windows are taken ``piece`` at a time, which cuts spans but
    changes no window's gram.
    """
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams = rolling(hashes, gram)
    low, width = np.uint64((1 << 24) - 1), window - gram + 1
    parts = []
    for begin in range(0, n, piece):
        count = min(piece, n - begin)
        some = grams[begin : begin + count + width - 1]
        # Hash above, place below: the least is the leftmost of the least-hashed.
        least = (mixed(some) & ~low) | np.arange(len(some), dtype=np.uint64)
        span = 1
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        least = np.minimum(least[:count], least[width - span : width - span + count])
        owner = (least & low).astype(np.int64)
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        again = np.r_[False, some[owner[starts[1:]]] == some[owner[starts[:-1]]]]
        if again.any():
            starts = _joined(starts, again, count, width)
        parts.append((some[owner[starts]], begin + starts, begin + np.r_[starts[1:], count] - 1))
    return tuple(np.concatenate(column) for column in zip(*parts))


def _joined(starts: np.ndarray, again: np.ndarray, count: int, width: int) -> np.ndarray:
    """``starts`` of spans where those from the second of a gram in a row on make spans of ``width`` windows;
    ``again`` says that a span has the gram of the one before it."""
    second = again & ~np.r_[False, again[:-1]]
    apart = starts[~again | second]
    ends = np.r_[apart[1:], count]
    # Spans that stand alone are no longer than ``width`` and get one start each.
    more = -(-(ends - apart) // width)
    turn = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more)
    return np.repeat(apart, more) + turn * width


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def repeated(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """``(doc_key, text_key, found)``: for documents with repeated windows, where they start.

    ``found`` is a list of ``(first, bits)``: bit k says that the window from word ``first + k`` on
    starts elsewhere too.
    """
    def grams_of(batches):
        for batch in slices(batches):
            rows = [
                _signed(passages(word_hashes(text.split()), window, gram)[0])
                for text in raw_texts(batch)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), _lists(rows, pa.int64())],
                names=[*_KEYS, "grams"],
            )

    placed = checkpointed(
        keyed_texts(shipped(docs)).mapInArrow(grams_of, "doc_key bigint, text_key bigint, grams array<bigint>")
    )
    places = placed.select(*_KEYS, F.explode("grams").alias("gram"))
    counted = checkpointed(places.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1"))
    shared = joined_apart(places, counted, "gram").groupBy(*_KEYS)
    hot = F.col("n") > group
    wanted = checkpointed(
        shared.agg(
            F.collect_set(F.when(~hot, F.col("gram"))).alias("cold"),
            F.collect_set(F.when(hot, F.col("gram"))).alias("hot"),
        )
    )
    searched = packed_texts(docs).join(wanted, _KEYS)
    cold = _subtrees(searched.select(*_KEYS, "packed", "cold"), window, gram)
    long = _long_prefixes(searched.select(*_KEYS, "packed", "hot"), window, gram)
    bits = cold.unionAll(long)
    return bits.groupBy(*_KEYS).agg(F.collect_list(F.struct("first", "bits")).alias("found"))


def _spans(batch, column: int, window: int, gram: int):
    """Row, word hashes and wanted spans ``(gram, first, last)`` of a batch's documents."""
    wanted = batch.column(column)
    for i, text in enumerate(unpacked(batch)):
        keys = wanted[i].values.to_numpy(zero_copy_only=False)
        if not len(keys):
            continue
        hashes = word_hashes(text.split())
        grams, first, last = passages(hashes, window, gram)
        grams = _signed(grams)
        take = np.isin(grams, keys)
        yield i, hashes, list(zip(grams[take].tolist(), first[take].tolist(), last[take].tolist()))


def _symbols(hashes: np.ndarray) -> bytes:
    return np.ascontiguousarray(mixed(hashes).view(np.uint8).reshape(-1, 8)[:, :_SYMBOL]).tobytes()


def _subtrees(searched: DataFrame, window: int, gram: int) -> DataFrame:
    """Sorts each small group's suffixes, whole words by whole words."""

    def spans(batches):
        for batch in batches:
            docs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows = []
            for i, hashes, found in _spans(batch, 3, window, gram):
                data = _symbols(hashes)
                for key, first, last in found:
                    piece = data[first * _SYMBOL : (last + window) * _SYMBOL]
                    rows.append((key, docs[i], texts[i], first, piece))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), _SPAN_TYPES)], names=_SPAN_NAMES
                )

    def trees(batches):
        held: list[tuple] = []
        for batch in batches:
            held.extend(zip(*(column.to_pylist() for column in batch.columns)))
            if len(held) >= _AT_ONCE:
                # The last group may go on in the next batch.
                last = held[-1][0]
                at = next((i for i in range(len(held) - 1, -1, -1) if held[i][0] != last), -1) + 1
                yield from _marks(held[:at], window)
                held = held[at:]
        yield from _marks(held, window)

    rows = searched.mapInArrow(
        spans, "gram bigint, doc_key bigint, text_key bigint, first int, words binary"
    )
    grouped = rows.repartition("gram").sortWithinPartitions("gram")
    return grouped.mapInArrow(trees, _BITS)


_SPAN_NAMES = ["gram", *_KEYS, "first", "words"]
_SPAN_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
_BITS = "doc_key bigint, text_key bigint, first int, bits bigint"


def _marks(rows: list[tuple], window: int) -> Iterator[pa.RecordBatch]:
    """Deep nodes of the subtrees of some whole groups."""
    if len(rows) < 2:
        return
    size = window * _SYMBOL
    grams = np.array([row[0] for row in rows])
    group = np.cumsum(np.r_[0, grams[1:] != grams[:-1]]).astype(">u4")
    pieces = [row[4] for row in rows]
    counts = np.array([len(piece) // _SYMBOL - window + 1 for piece in pieces])
    buffer = np.frombuffer(b"".join(pieces), np.uint8)
    begins = np.cumsum([0, *map(len, pieces)])[:-1]
    owner = np.repeat(np.arange(len(rows)), counts)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = begins[owner] + step * _SYMBOL
    leaves = np.empty((len(owner), 4 + size), np.uint8)
    leaves[:, :4] = group.view(np.uint8).reshape(-1, 4)[owner]
    leaves[:, 4:] = np.lib.stride_tricks.sliding_window_view(buffer, size)[starts]
    order = np.argsort(leaves.view(f"S{4 + size}").ravel(), kind="stable")
    equal = (leaves[order[1:]] == leaves[order[:-1]]).all(1)
    deep = np.zeros(len(owner), bool)
    deep[order[1:][equal]] = True
    deep[order[:-1][equal]] = True
    bits = np.zeros(len(rows), np.int64)
    np.bitwise_or.at(bits, owner[deep], np.int64(1) << step[deep])
    found = np.flatnonzero(bits)
    if len(found):
        columns = [[rows[i][c] for i in found] for c in (1, 2, 3)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(columns[0], pa.int64()),
                pa.array(columns[1], pa.int64()),
                pa.array(columns[2], pa.int32()),
                pa.array(bits[found], pa.int64()),
            ],
            names=[*_KEYS, "first", "bits"],
        )


def _long_prefixes(searched: DataFrame, window: int, gram: int) -> DataFrame:
    """Counts the windows behind frequent grams, first run by run, then window by window.

    Copies have equal runs of windows, so a run found twice settles all its windows; only runs that
    stand alone are taken apart, and then set against the windows of all different runs.
    """

    def runs(batches):
        for batch in batches:
            docs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows = []
            for i, hashes, found in _spans(batch, 3, window, gram):
                labels = _signed(rolling(hashes, window))
                for _, first, last in found:
                    own = labels[first : last + 1]
                    run = int.from_bytes(
                        hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True
                    )
                    rows.append((docs[i], texts[i], first, run, own.tolist()))
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                    names=[*_KEYS, "first", "run", "labels"],
                )

    # Each action of its own would shuffle the texts again.
    rows = checkpointed(
        searched.where(F.size("hot") > 0).mapInArrow(
            runs, "doc_key bigint, text_key bigint, first int, run bigint, labels array<bigint>"
        )
    )
    different = checkpointed(rows.groupBy("run").agg(F.count("*").alias("n"), F.first("labels").alias("labels")))
    windows = different.select("run", "n", F.posexplode("labels").alias("k", "label"))
    twice = windows.groupBy("label").agg(F.sum("n").alias("n")).where("n > 1").select("label")
    alone = windows.where("n = 1").join(twice, "label")
    one = F.expr("shiftleft(1L, k)")
    found = alone.groupBy("run").agg(F.bit_or(one).alias("bits")).withColumn("n", F.lit(1).cast("bigint"))
    every = F.expr("shiftleft(1L, size(labels)) - 1")
    settled = different.where("n > 1").select("run", every.alias("bits"), "n")
    bits = checkpointed(settled.unionAll(found))
    return joined_apart(rows.select(*_KEYS, "first", "run"), bits, "run").select(*_KEYS, "first", "bits")


def remove(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_text, kept_sha256)`` for every row.

    Words are runs of anything but ASCII white space. A word goes if it lies in a window of ``window``
    words whose like also starts elsewhere in the table, in the same document too; the first of
    several goes as well. Kept words are joined by one space. Null text counts as empty; texts
    shorter than a window are kept whole; repeated rows are repeats of each other, and each stays as a
    row; an empty table gives no rows; other columns are ignored.
    """
    found = repeated(docs, window, gram, group)
    def cut(batches):
        for batch in slices(batches):
            rows = []
            marks = batch.column(2).to_pylist()
            for doc_id, text, mark in zip(batch.column(0).to_pylist(), unpacked(batch), marks):
                words = text.split()
                gone = covered(len(words), mark, window)
                kept = b" ".join(w for w, g in zip(words, gone) if not g) if mark else b" ".join(words)
                sha = hashlib.sha256(kept).hexdigest()
                rows.append((doc_id, len(words), int(gone.sum()), kept.decode(), sha))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            columns = zip(*rows) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)],
                names=["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256"],
            )

    marked = packed_texts(docs).join(found, _KEYS, "left")
    return marked.select(doc_id_of("doc_key"), "packed", "found").mapInArrow(
        cut,
        "doc_id bigint, n_words bigint, n_removed bigint, kept_text string, kept_sha256 string",
    )


def cut(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """``docs`` with repeated words gone from ``text``, all columns kept.

    As ``remove``; a text that loses nothing stays as it is, white space and null too, any other
    becomes its kept words joined by one space.
    """
    found = repeated(docs, window, gram, group)
    doc_key, text_key, marks = (unused(name, docs.columns) for name in (*_KEYS, "found"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63)))
    named = docs.withColumns({doc_key: key, text_key: F.xxhash64(text)})
    found = found.select(
        F.col("doc_key").alias(doc_key), F.col("text_key").alias(text_key), F.col("found").alias(marks)
    )
    marked = named.join(found, [doc_key, text_key], "left").drop(doc_key, text_key)

    def shorten(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = batch.column(at).to_pylist()
            marks = batch.column(batch.num_columns - 1)
            for i in np.flatnonzero(marks.is_valid().to_numpy(zero_copy_only=False)):
                words = texts[i].encode().split()
                gone = covered(len(words), marks[int(i)].as_py(), window)
                texts[i] = b" ".join(w for w, g in zip(words, gone) if not g).decode()
            shorter = batch.set_column(at, "text", pa.array(texts, pa.string()))
            yield shorter.select(range(batch.num_columns - 1))

    return shipped(marked).mapInArrow(shorten, docs.schema)


def covered(n: int, marks: list[dict] | None, window: int) -> np.ndarray:
    """Which of ``n`` words lie in a marked window."""
    starts = np.zeros(n + 1, np.int64)
    if marks:
        bits = np.array([mark["bits"] for mark in marks], "<i8").view(np.uint8).reshape(-1, 8)
        which, place = np.nonzero(np.unpackbits(bits, 1, bitorder="little"))
        starts[np.array([mark["first"] for mark in marks])[which] + place] = 1
    total = np.cumsum(starts)
    before = np.r_[np.zeros(window, np.int64), total[:-window]] if n >= window else 0
    return (total - before)[:n] > 0
