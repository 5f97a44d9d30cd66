"""Small helpers that the corpus operators share: text out of Arrow batches, words, word memos."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Entries that a worker's memo holds before it starts afresh; bounds its memory.
MEMO_ENTRIES = 150_000
#: Bytes of words and token ids, with what Python needs around them, that a coder holds before it starts
#: afresh.
CODED_BYTES = 128 << 20
_ENTRY_BYTES = 200

#: Rules of a tokenizer file under which letters are a unit of their own and case does not count.
_LETTERS_APART = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
#: The lower-case letters of Latin-1 that a line begins with, and what follows them. In Latin-1 nothing
#: composes, and lower case does not depend on neighbours.
_LETTERS = re.compile("^([a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u00ff]*)(.*)$", re.MULTILINE)
_BEYOND_LATIN = re.compile("[^\0-\u00ff]")

#: A key with one of so many parts of all rows is joined apart.
HOT = 200

_HASHES: dict[bytes, int] = {}
_NO_ID = -(1 << 63)


def shipped(df: DataFrame) -> DataFrame:
    """The frame, its executors' Python being given this package as a zip, once per context."""
    import os
    import shutil
    import tempfile

    context = df.sparkSession.sparkContext
    if not getattr(context, "_daystrata_shipped", False):
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        folder = os.path.realpath(tempfile.mkdtemp(prefix="daystrata-"))
        at, name = os.path.split(package)
        context.addPyFile(shutil.make_archive(f"{folder}/{name}", "zip", at, name))
        context._daystrata_shipped = True
    return df


def text_of(name: str = "text") -> Column:
    """The text, null taken as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias("text")


def keyed_texts(docs: DataFrame) -> DataFrame:
    """``(doc_key, text_key, text)``: rows named by id and hash of the text, so that joins back to them
    hold for null and repeated ids. All readers of one shuffle of texts take just these columns."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NO_ID)).alias("doc_key"),
        F.xxhash64(text_of()).alias("text_key"),
        text_of(),
    )


def packed_texts(docs: DataFrame) -> DataFrame:
    """``keyed_texts`` with the text compressed, as ``packed``, for shuffles that carry all texts."""

    def pack(batches):
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            small = [squeeze(text) for text in raw_texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(small, pa.binary())],
                names=["doc_key", "text_key", "packed"],
            )

    packed = keyed_texts(docs).mapInArrow(pack, "doc_key bigint, text_key bigint, packed binary")
    # Always true, but an inner join asks for it; stated here, every join finds the same shuffle.
    return packed.where("doc_key is not null and text_key is not null")


def unpacked(batch: pa.RecordBatch) -> list[bytes]:
    """The texts of a ``packed`` column."""
    import zstandard

    column = batch.column(batch.schema.get_field_index("packed")).to_pylist()
    restore = zstandard.ZstdDecompressor().decompress
    return [restore(value) for value in column]


def doc_id_of(key: str) -> Column:
    """The id behind a ``doc_key``; the least bigint stands for null."""
    return F.when(F.col(key) != _NO_ID, F.col(key)).alias("doc_id")


def joined_apart(rows: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """``rows`` joined to ``found`` on the key, ``found`` having one row per key and ``n``, its number of rows.

    A key that many rows share would send them all to one task. At most ``HOT`` keys can hold that share
    of the rows; only these are broadcast, and what remains of the rows joins as usual. Reads ``found`` at once.
    """
    total = found.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") * HOT >= total
    few = F.broadcast(found.where(hot))
    apart = rows.join(few, key)
    rest = rows.join(few.select(key), key, "left_anti").join(found.where(~hot), key)
    return apart.unionByName(rest)


def unused(name: str, columns: list[str]) -> str:
    """A name like this one that none of the columns has."""
    taken = {column.lower() for column in columns}
    while name.lower() in taken:
        name += "_"
    return name


def raw_texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """A text column as UTF-8 bytes, null taken as empty."""
    column = batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary())
    return [value or b"" for value in column.to_pylist()]


def string_texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    column = batch.column(batch.schema.get_field_index(name))
    return [value or "" for value in column.to_pylist()]


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words, equal in every process."""
    import xxhash

    if len(_HASHES) > MEMO_ENTRIES:
        _HASHES.clear()
    try:
        return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    except KeyError:
        digest = xxhash.xxh3_64_intdigest
        for word in set(words).difference(_HASHES):
            _HASHES[word] = digest(word)
        return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """One 64-bit hash for every ``width`` consecutive words, by position."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + n]
    return mixed(out)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the whole word."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


class WordCoder:
    """Token ids of texts from a tokenizer file, one library call per new word.

    ``bytelevel``: a byte-level vocabulary whose words carry their leading space. Its split rule
    always begins a token at a space that a non-space follows, and always cuts on both sides of a
    line end between non-spaces, so ids of such units joined are the ids of the text.
    Otherwise: a vocabulary with word ends that drops white space, where any space or line end
    separates words. If the file's rules are those of ``_LETTERS_APART``, the letters a word begins with are
    looked up in lower case, apart from what follows them; new ones are encoded many in one text.
    """

    _doubled = re.compile(r"\s\s")

    def __init__(self, path: str, bytelevel: bool):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.bytelevel = bytelevel
        self.dtype = "<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4"
        self.size = int(self.dtype[-1])
        self.code = "H" if self.size == 2 else "I"
        # Whole documents of ids stand beside the memo where words are encoded for joining.
        self.limit = CODED_BYTES if bytelevel else CODED_BYTES // 2
        self.held = 0
        self._spaced: np.ndarray | None = None
        self._first: dict[str, bytes] = {}
        self._later: dict[str, bytes] = {}
        self._letters: dict[str, bytes] = {"": b""}
        self.letters_held = 0
        self._line_end = self._exact(["\n"])[0]
        self._lower = None if bytelevel else self._of_lower(path)

    def _exact(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.code, x.ids).tobytes() for x in found]

    def ids(self, text: str) -> np.ndarray:
        """What the library gives for the whole text without added special tokens."""
        return np.frombuffer(self.packed(text), self.dtype)

    def packed(self, text: str) -> bytes:
        if not self.bytelevel:
            return self.packed_all([text])[0]
        if self._doubled.search(text):
            return b"".join(self._known(self._first, self._units(text), False))
        words = text.replace("\n", " \n").split(" ")
        first = self._known(self._first, words[:1], False)
        return b"".join(first + self._known(self._later, words[1:], True))

    def packed_all(self, texts: list[str]) -> list[bytes]:
        """``packed`` of some texts, their new words being encoded together."""
        if self.bytelevel:
            return [self.packed(text) for text in texts]
        split = [text.replace("\n", " ").split(" ") for text in texts]
        self._forget()
        memo = self._first
        new = list(set().union(*split).difference(memo))
        if self._lower is not None:
            new = self._add_apart(new)
        self._add(memo, set(new), False)
        return [b"".join(map(memo.__getitem__, words)) for words in split]

    def whole(self, text: str) -> bytes:
        """The library's ids of a text taken as one, whatever is known of its words."""
        return self._exact([text])[0]

    def counts(self, words: list[str]) -> list[int]:
        """Ids per word, for words that stand alone."""
        if self.bytelevel:
            return [len(x) // self.size for x in self._known(self._first, words, False)]
        try:
            return [len(self._first[word]) // self.size for word in words]
        except KeyError:
            return [len(x) // self.size for x in self.packed_all(words)]

    @staticmethod
    def _units(text: str) -> list[str]:
        units: list[str] = []
        for i, part in enumerate(text.split(" ")):
            if i and (not part or part[0].isspace()):
                units[-1] += " " + part
            else:
                units.append(" " + part if i else part)
        return units

    def learn(self, texts: list[str]) -> None:
        """Finds the ids of all words of some texts that are not known yet, in one library call."""
        first: set[str] = set()
        later: set[str] = set()
        if not self.bytelevel:
            self.packed_all(texts)
            return
        for text in texts:
            if self._doubled.search(text):
                first.update(self._units(text))
            else:
                words = text.replace("\n", " \n").split(" ")
                first.add(words[0])
                later.update(words[1:])
        self._forget()
        self._add(self._first, first.difference(self._first), False)
        self._add(self._later, later.difference(self._later), True)

    def _known(self, memo: dict[str, bytes], words: list[str], spaced: bool) -> list[bytes]:
        """``spaced``: each word stands behind a space, or begins with the line end before it."""
        try:
            return [memo[word] for word in words]
        except KeyError:
            self._forget()
            self._add(memo, set(words).difference(memo), spaced)
            return [memo[word] for word in words]

    def _forget(self) -> None:
        if self.held > self.limit:
            self._first.clear()
            self._later.clear()
            self.held = 0
        if self.letters_held > self.limit:
            self._letters = {"": b""}
            self.letters_held = 0

    def _add(self, memo: dict[str, bytes], words: set[str], spaced: bool) -> None:
        held = len(memo)
        new = list(words)
        if spaced:
            plain = [w for w in new if w and w[0] != "\n" and "<|" not in w]
            self._add_joined(memo, plain)
            new = list(words.difference(memo))
            ended = [word[:1] == "\n" for word in new]
            exact = self._exact([w[1:] if end else " " + w for w, end in zip(new, ended)])
            exact = [self._line_end + ids if end else ids for ids, end in zip(exact, ended)]
        else:
            exact = self._exact(new)
        memo.update(zip(new, exact))
        self.held += _ENTRY_BYTES * (len(memo) - held) + sum(map(len, words))

    def _of_lower(self, path: str):
        """The library's tokenizer of words in lower case, if its file's rules set letters apart."""
        import json

        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        if any(rules[name] != rule for name, rule in _LETTERS_APART.items()):
            return None
        suffix = rules["model"].get("end_of_word_suffix")
        if not suffix:
            return None
        tokens = map(self.library.id_to_token, range(self.library.get_vocab_size()))
        self._ends = np.array([(token or "").endswith(suffix) for token in tokens])
        self._added = [token["content"] for token in rules["added_tokens"]]
        # The model itself, without the normalizer that would leave such words as they are.
        lower = Tokenizer(self.library.model)
        lower.pre_tokenizer = self.library.pre_tokenizer
        return lower

    def _add_apart(self, words: list[str]) -> list[str]:
        """Puts the ids of words together from their letters' and those of what follows; gives the words that
        this is not known to be right for."""
        every = "\n".join(words)
        lower = every.lower()
        # An added token is found before any rule is applied, also behind or in letters.
        added = [token for token in self._added if token in every or token in lower]
        left = []
        if added or _BEYOND_LATIN.search(every):
            for word in words:
                if _BEYOND_LATIN.search(word) or any(t in word or t in word.lower() for t in added):
                    left.append(word)
            words = list(set(words).difference(left))
            lower = "\n".join(words).lower()
        parts = _LETTERS.findall(lower) if words else []
        letters, first = self._letters, self._first
        self._add_letters({head for head, _ in parts}.difference(letters))
        self._add(first, {rest for _, rest in parts}.difference(first), False)
        first.update((w, letters[h] + first[r]) for w, (h, r) in zip(words, parts, strict=True))
        self.held += _ENTRY_BYTES * len(words) + len(lower)
        return left

    def _add_letters(self, words: set[str]) -> None:
        """Encodes many words of lower-case letters as one text, and cuts its ids behind each token that ends a
        word. Words of a text that gives another number of such tokens are encoded one by one."""
        new, memo = list(words), self._letters
        chunks = [new[at : at + 200] for at in range(0, len(new), 200)]
        found = self._lower.encode_batch_fast([" ".join(c) for c in chunks], add_special_tokens=False)
        for chunk, one in zip(chunks, found):
            ids = np.array(one.ids, self.dtype)
            ends = ((np.flatnonzero(self._ends[ids]) + 1) * self.size).tolist()
            if len(ends) == len(chunk):
                data = ids.tobytes()
                memo.update(zip(chunk, map(data.__getitem__, map(slice, [0, *ends[:-1]], ends))))
            else:
                memo.update(zip(chunk, self._exact(chunk)))
        self.letters_held += _ENTRY_BYTES * len(new) + sum(map(len, new))

    def _add_joined(self, memo: dict[str, bytes], words: list[str]) -> None:
        """Encodes many words as one text, and cuts its ids where a token begins with a space, as none but the
        first of each word does. Words of a text that gives another number of such tokens are left out."""
        if self._spaced is None:
            tokens = map(self.library.id_to_token, range(self.library.get_vocab_size()))
            self._spaced = np.array([(token or "").startswith("Ġ") for token in tokens])
        chunks = [words[at : at + 1000] for at in range(0, len(words), 1000)]
        found = self.library.encode_batch_fast([" " + " ".join(c) for c in chunks], add_special_tokens=False)
        for chunk, one in zip(chunks, found):
            ids = np.array(one.ids, self.dtype)
            starts = (np.flatnonzero(self._spaced[ids]) * self.size).tolist()
            if len(starts) == len(chunk):
                data = ids.tobytes()
                memo.update(zip(chunk, map(data.__getitem__, map(slice, starts, [*starts[1:], len(data)]))))


_CODERS: dict[tuple[str, bool], WordCoder] = {}


def coder(path: str, bytelevel: bool) -> WordCoder:
    """The worker's coder for a tokenizer file, kept between tasks."""
    key = (path, bytelevel)
    if key not in _CODERS:
        _CODERS[key] = WordCoder(*key)
    return _CODERS[key]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Batches of fewer rows, for work that holds several times the text it looks at."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def in_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    """Rows as record batches."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    arrays = [pa.array(column, field.type) for column, field in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
