"""BPE encoding and decoding of whole documents with chunks that documents share encoded once.

A rolling hash over bytes cuts texts where their content says so, so copied passages fall into the same
chunks wherever they stand. Chunks found more than once are encoded at one of their places only and
their ids brought to the others; all other chunks are encoded where they are. A cut may fall inside a
word. So each join is encoded again in a window that reaches a whole word into both chunks; if
the ids of those words agree with the chunks' own, the ids between them replace the chunks' torn ends,
else the window grows by a word on both sides until they do.

Text is shuffled once, by document: the places that encode shared chunks and the final pass both read
that exchange. What else moves is chunk names, and ids of shared chunks only.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daystrata.llm.words import (
    coder,
    doc_id_of,
    keyed_texts,
    packed_texts,
    raw_texts,
    shipped,
    slices,
    unpacked,
)
from daystrata.sources.files import checkpointed

#: Bytes of a chunk: least, most, and one cut in about so many bytes between.
LEAST, MOST, ABOUT = 512, 8192, 1536
#: Whole words that a chunk's ends can lend to a join's window.
EDGE_WORDS = 8
#: Characters of chunks whose new words are encoded together.
TOGETHER = 4 << 20

_KEYS = ["doc_key", "text_key"]
_ENCODED = "ids binary, ends string"


def cuts(data: np.ndarray, begin: int, end: int, marks: np.ndarray) -> list[int]:
    """Where the chunks of the bytes from ``begin`` to ``end`` end; never inside a character."""
    found, at = [], begin
    k = int(np.searchsorted(marks, begin))
    while end - at > MOST or (k < len(marks) and marks[k] < end):
        k += int(np.searchsorted(marks[k:], at + LEAST))
        cut = min(int(marks[k]) if k < len(marks) else end, at + MOST)
        while cut < end and data[cut] & 0xC0 == 0x80:
            cut += 1
        if cut >= end:
            break
        found.append(cut)
        at = cut
    return [*found, end]


def marks_of(data: np.ndarray) -> np.ndarray:
    """Places where the rolling hash of the bytes before allows a cut, 32 bytes from the start on."""
    # A byte's part moves up by a bit a place: 16 places on, it has left the bits that are looked at.
    table = np.random.default_rng(99).integers(0, 1 << 32, 256, np.uint64).astype(np.uint16)
    h = table[data]
    for k in range(4):
        step = 1 << k
        older = h[:-step] << np.uint16(step)
        h = h[step:] + older
    return np.flatnonzero(h[16:] % np.uint16(ABOUT - LEAST) == 7) + 32


def chunks_of(texts: list[bytes]) -> list[list[bytes]]:
    """Each text's chunks; an empty text has none."""
    whole = b"".join(texts)
    data = np.frombuffer(whole, np.uint8)
    marks = marks_of(data) if len(data) >= 64 else np.zeros(0, np.int64)
    out, at = [], 0
    for text in texts:
        end, pieces, start = at + len(text), [], at
        for cut in cuts(data, at, end, marks) if text else ():
            pieces.append(whole[start:cut])
            start = cut
        out.append(pieces)
        at = end
    return out


def name_of(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


def encode_chunk(code, chunk: str) -> tuple[bytes, list]:
    """Ids of the whole words of a chunk, and its two torn ends with the words next to them.

    ``[head, tail, first words, last words]``; a chunk without a separator is all head, and its
    tail is null.
    """
    return encode_chunks(code, [chunk])[0]


def encode_chunks(code, chunks: list[str]) -> list[tuple[bytes, list]]:
    """``encode_chunk`` of each, the words that are new in some megabytes being encoded together."""
    bodies, ends = [], []
    for chunk in chunks:
        spaced = chunk.replace("\n", " ")
        at, last = spaced.find(" "), spaced.rfind(" ")
        if at < 0:
            bodies.append("")
            ends.append([chunk, None, [], []])
            continue
        body = spaced[at + 1 : last] if last > at else ""
        bodies.append(body)
        ends.append([chunk[:at], chunk[last + 1 :], *edges(body)])
    return list(zip(_packed(code, bodies), ends))


def _packed(code, bodies: list[str]) -> list[bytes]:
    found, some, size = [], [], 0
    for body in bodies:
        some.append(body)
        size += len(body)
        if size > TOGETHER:
            found += code.packed_all(some)
            some, size = [], 0
    return found + code.packed_all(some)


def edges(body: str) -> tuple[list[str], list[str]]:
    """The first and the last few words."""
    first = [w for w in body.split(" ", EDGE_WORDS)[:EDGE_WORDS] if w]
    final = [w for w in body.rsplit(" ", EDGE_WORDS)[-EDGE_WORDS:] if w]
    if min(len(first), len(final)) < EDGE_WORDS:
        words = [w for w in body.split(" ") if w]
        first, final = words[:EDGE_WORDS], words[-EDGE_WORDS:]
    return first, final


class Joiner:
    """Puts a document's encoded chunks together."""

    def __init__(self, code):
        self.code, self.size = code, code.size
        self.parts: list[bytes] = []
        self.torn, self.before = "", []

    def add(self, ids: bytes, ends: list) -> None:
        head, tail, first, final = ends
        if tail is None:
            self.torn += head
            return
        self._join(head, first, ids)
        self.parts.append(ids)
        self.torn, self.before = tail, final

    def close(self) -> bytes:
        self._join("", [], b"")
        return b"".join(self.parts)

    def _join(self, head: str, after: list[str], ids: bytes) -> None:
        """Encodes the torn word with whole words around it, more until both sides agree."""
        word = self.torn + head
        if not word:
            return
        done = self.parts[-1] if self.parts else b""
        for reach in range(1, EDGE_WORDS + 1):
            left, right = self.before[-reach:], after[:reach]
            counts = self.code.counts([*left, *right])
            old, new = sum(counts[: len(left)]) * self.size, sum(counts[len(left) :]) * self.size
            # As one text: only the library itself can tell whether words look at each other.
            window = self.code.whole(" ".join([*left, word, *right]))
            if window[:old] == done[len(done) - old :] and window[len(window) - new :] == ids[:new]:
                self.parts.append(window[old : len(window) - new])
                return
            if reach >= max(len(self.before), len(after)):
                break
        raise ValueError("a chunk join did not come to agree; this tokenizer looks across words")


def _shared(keyed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Places ``(doc_key, text_key, name)`` of chunks found in two documents or twice in one, and of
    each the one place that encodes it."""

    def name_all(batches):
        for batch in slices(batches):
            rows = [[name_of(c) for c in chunks] for chunks in chunks_of(raw_texts(batch))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.binary()))],
                names=[*_KEYS, "names"],
            )

    named = checkpointed(keyed.mapInArrow(name_all, "doc_key bigint, text_key bigint, names array<binary>"))
    places = named.select(*_KEYS, F.explode("names").alias("name"))
    owner = F.min(F.struct(*_KEYS)).alias("owner")
    common = places.groupBy("name").agg(F.count("*").alias("n"), owner).where("n > 1")
    common = checkpointed(common.select("name", "owner"))
    every = places.join(common.select("name"), "name").distinct()
    return every, common.select("owner.*", "name")


def encode(docs: DataFrame, tokenizer: str, with_ids: bool = False) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` for every row, by its whole text.

    Ids are those of the tokenizers library for the file ``tokenizer``, whose words must not depend on
    the words around them (else an error, never other ids). Digests are of the decimal ids joined by
    a space, and of the decoded text. ``with_ids`` adds ``ids`` and ``decoded``. Null text counts as
    empty and gives no ids; a text of any length is one row of work; repeated rows stay; an empty
    table gives no rows; other columns are ignored.
    """
    every, owners = _shared(keyed_texts(shipped(docs)))
    texts = packed_texts(docs)
    wanted = owners.groupBy(*_KEYS).agg(F.collect_list("name").alias("names"))

    def encode_shared(batches):
        code = coder(tokenizer, False)
        for batch in batches:
            rows = []
            names = batch.column(1).to_pylist()
            for chunks, mine in zip(chunks_of(unpacked(batch)), names):
                left = set(mine)
                for chunk in chunks:
                    if (name := name_of(chunk)) in left:
                        left.discard(name)
                        rows.append((name, chunk.decode()))
            if rows:
                coded = encode_chunks(code, [chunk for _, chunk in rows])
                rows = [(name, ids, json.dumps(ends)) for (name, _), (ids, ends) in zip(rows, coded)]
                kinds = [pa.binary(), pa.binary(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                    names=["name", "ids", "ends"],
                )

    once = texts.join(wanted, _KEYS).select("packed", "names")
    shared = once.mapInArrow(encode_shared, f"name binary, {_ENCODED}")
    # A repeated document encodes its chunks twice; one answer is enough.
    shared = shared.dropDuplicates(["name"])
    brought = every.join(shared, "name").groupBy(*_KEYS).agg(
        F.collect_list(F.struct("name", "ids", "ends")).alias("known")
    )

    def assemble(batches):
        code = coder(tokenizer, False)
        for batch in slices(batches):
            out = []
            known = batch.column(2)
            texts_ = unpacked(batch)
            places = []
            for i, chunks in enumerate(chunks_of(texts_)):
                held = {k["name"]: (k["ids"], json.loads(k["ends"])) for k in known[i].as_py() or ()}
                places.append([held.get(name_of(c)) or c for c in chunks] if held else chunks)
            own = [place.decode() for row in places for place in row if isinstance(place, bytes)]
            coded = iter(encode_chunks(code, own))
            for row in places:
                joiner = Joiner(code)
                for place in row:
                    joiner.add(*(next(coded) if isinstance(place, bytes) else place))
                ids = np.frombuffer(joiner.close(), code.dtype).tolist()
                decoded = decode(code, ids)
                row = (
                    len(ids),
                    hashlib.sha256(b" ".join(map(_decimals(code).__getitem__, ids))).hexdigest(),
                    hashlib.sha256(decoded.encode()).hexdigest(),
                )
                out.append(row + (ids, decoded) if with_ids else row)
            kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string()]
            columns = list(zip(*out)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, kinds)]],
                names=["doc_id", *names],
            )

    names = ["n_tokens", "ids_sha256", "decoded_sha256", *(["ids", "decoded"] if with_ids else [])]
    ddl = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    ddl += ", ids array<int>, decoded string" if with_ids else ""
    whole = texts.join(brought, _KEYS, "left").select(doc_id_of("doc_key"), "packed", "known")
    return whole.mapInArrow(assemble, ddl)


def decode(code, ids: list[int]) -> str:
    """The library's text of ids, special tokens included."""
    if code.library.decoder is not None:
        return code.library.decode(ids, skip_special_tokens=False)
    # Without a decoder the library joins the tokens themselves by spaces.
    if not hasattr(code, "tokens"):
        code.tokens = [code.library.id_to_token(i) for i in range(code.library.get_vocab_size())]
    return " ".join(map(code.tokens.__getitem__, ids))


def _decimals(code) -> list[bytes]:
    if not hasattr(code, "decimals"):
        code.decimals = [b"%d" % i for i in range(code.library.get_vocab_size())]
    return code.decimals
