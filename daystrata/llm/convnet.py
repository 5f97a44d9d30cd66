"""Document quality from a byte-level convolutional network, in numpy.

A document is cut into overlapping chunks that cover all of it. Learned filters run over the bytes of
each chunk; their mean and largest responses there pass through a small layer, whose units are
max-pooled over the chunks and combined into one probability. Learning takes a bounded sample of
labelled documents on the driver; scoring is one narrow pass over whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daystrata.llm.labelled import held_out, sample
from daystrata.llm.words import raw_texts, shipped, text_of, unused

#: Labelled documents to learn from at most, and chunks of each at most (spread over its length).
SAMPLE_DOCS = 3000
SAMPLE_CHUNKS = 16
#: Bytes from one filter position to the next, of a filter, and of a chunk; chunks overlap by half.
STRIDE, WIDTH, CHUNK = 4, 8, 256
FILTERS, HIDDEN, EPOCHS = 16, 24, 14
#: Probability from which a document counts as good.
THRESHOLD = 0.3

_HALF = CHUNK // 2
_SPOTS = CHUNK // STRIDE
_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64())]
)


def byte_features() -> np.ndarray:
    """What a filter sees of a byte: its class, and a few fixed random directions."""
    code = np.arange(256)
    char = [chr(i) for i in code]
    groups = [
        [c.isascii() and c.islower() for c in char],
        [c.isascii() and c.isupper() for c in char],
        [c.isascii() and c.isdigit() for c in char],
        [c == " " for c in char],
        [c in "\n\r\t" for c in char],
        [c in ".,;:?'\"()-" for c in char],
        [c == "!" for c in char],
        [c == "|" for c in char],
        [c in "#*$%&<>@" for c in char],
        [c in "aeiou" for c in char],
        list(code >= 192),
        list((code >= 128) & (code < 192)),
    ]
    directions = np.random.default_rng(7).normal(0, 0.5, (256, 4))
    directions[0] = 0
    return np.hstack([np.array(groups, float).T, directions]).astype(np.float32)


@dataclass(frozen=True)
class Network:
    filters: np.ndarray
    filter_bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: float

    def tables(self) -> list[np.ndarray]:
        """Responses by pair of neighbouring bytes, so that a filter is a sum of look-ups."""
        seen = byte_features()
        parts = self.filters.reshape(WIDTH, seen.shape[1], -1)
        each = [seen @ parts[j] for j in range(WIDTH)]
        pairs = [
            (each[j + 1][:, None] + each[j][None]).reshape(1 << 16, -1) for j in range(0, WIDTH, 2)
        ]
        pairs[0] = pairs[0] + self.filter_bias
        return [np.ascontiguousarray(p, np.float32) for p in pairs]

    def probabilities(self, texts: list[bytes], tables: list[np.ndarray]) -> np.ndarray:
        """One per text. The work is cut into pieces of bounded size, also within a text."""
        out = np.zeros(len(texts))
        group: list[int] = []
        held = 0
        for i, text in enumerate(texts):
            group.append(i)
            held += len(text)
            if held > 1 << 20 or i == len(texts) - 1:
                out[group] = self._group([texts[k] for k in group], tables)
                group, held = [], 0
        return out

    def _group(self, texts: list[bytes], tables: list[np.ndarray]) -> np.ndarray:
        halves = [max(1, -(-len(text) // _HALF)) for text in texts]
        pad = b"".join(text.ljust(n * _HALF, b"\0") for text, n in zip(texts, halves))
        data = np.frombuffer(pad + bytes(WIDTH), np.uint8)
        total = sum(halves)
        spots = _SPOTS // 2
        sums = np.empty((total, len(self.filter_bias)), np.float32)
        tops = np.empty_like(sums)
        step = 4096
        pairs = data[:-1:2].astype(np.int32) | (data[1::2].astype(np.int32) << 8)
        ends = np.cumsum(halves)
        length = np.array([len(text) for text in texts])
        first = np.repeat(ends - halves, halves)
        own = np.repeat(length, halves)
        left = own - (np.arange(total) - first) * _HALF
        valid = np.clip(-(-left // STRIDE), 0, spots)
        final = np.zeros(total, bool)
        final[ends - 1] = True
        for at in range(0, total, step):
            n = min(step, total - at)
            begin = at * _HALF // 2
            count = n * spots
            response = np.zeros((count, sums.shape[1]), np.float32)
            for j, table in enumerate(tables):
                response += table[pairs[begin + j : begin + j + count * STRIDE // 2 : STRIDE // 2]]
            response = response.reshape(n, spots, -1)
            # The last place of a text's last half looks past its end, where another text begins.
            over = np.flatnonzero(final[at : at + n])
            if len(over):
                place = (at + over + 1) * _HALF // 2 - STRIDE // 2
                response[over, -1] = sum(
                    table[pairs[place + j]] if j < STRIDE // 2 else table[0] for j, table in enumerate(tables)
                )
            np.maximum(response, 0, out=response)
            short = np.flatnonzero(valid[at : at + n] < spots)
            for k in short:
                response[k, valid[at + k] :] = 0
            sums[at : at + n] = response.sum(1)
            tops[at : at + n] = response.max(1)
        # A chunk is two halves; the last half of a text stands with the one before it.
        follow = np.minimum(np.arange(total) + 1, np.repeat(ends - 1, halves))
        alone = follow == np.arange(total)
        count = valid + np.where(alone, 0, valid[follow])
        mean = (sums + np.where(alone[:, None], 0, sums[follow])) / np.maximum(count, 1)[:, None]
        top = np.maximum(tops, tops[follow])
        units = np.maximum(np.hstack([mean, top]) @ self.hidden + self.hidden_bias, 0)
        # The lone last half of a longer text is already in the chunk before it.
        units[alone & (np.repeat(halves, halves) > 1)] = 0
        pooled = np.maximum.reduceat(units, ends - halves, axis=0)
        return _sigmoid(pooled @ self.out + self.out_bias)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def chunks_of(text: bytes, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``most`` chunks, evenly spread, with the filters' overhang, and their valid spots."""
    starts = list(range(0, max(1, len(text) - _HALF), _HALF))
    if len(starts) > most:
        starts = [starts[k * len(starts) // most] for k in range(most)]
    size = CHUNK + WIDTH
    pieces = b"".join(text[s : s + size].ljust(size, b"\0") for s in starts)
    valid = [min(_SPOTS, -(-(len(text) - s) // STRIDE)) for s in starts]
    return np.frombuffer(pieces, np.uint8).reshape(-1, size), np.array(valid)


def fit(texts: list[bytes], labels: np.ndarray) -> Network:
    """The network for labelled texts."""
    return fit_bags([chunks_of(text, SAMPLE_CHUNKS) for text in texts], labels)


def fit_bags(bags: list[tuple], labels: np.ndarray, seed: int = 11) -> Network:
    """The network for labelled chunks. With one class only, or none, it gives the share of ones,
    one half where nothing is known."""
    rng = np.random.default_rng(seed)
    seen = byte_features()
    d = seen.shape[1]
    weights = {
        "filters": rng.normal(0, 1 / np.sqrt(WIDTH * 3), (WIDTH * d, FILTERS)),
        "filter_bias": np.zeros(FILTERS),
        "hidden": rng.normal(0, 1 / np.sqrt(FILTERS), (2 * FILTERS, HIDDEN)),
        "hidden_bias": np.zeros(HIDDEN),
        "out": rng.normal(0, 0.3, HIDDEN),
        "out_bias": np.zeros(1),
    }
    weights = {k: v.astype(np.float32) for k, v in weights.items()}
    share = float(np.clip(labels.mean(), 0.02, 0.98)) if len(labels) else 0.5
    weights["out_bias"][0] = np.log(share / (1 - share))
    if len(set(labels.tolist())) < 2:
        weights["out"][:] = 0
        return _network(weights)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in weights.items()}
    step, size = 0, 48
    steps = EPOCHS * -(-len(bags) // size)
    for _ in range(EPOCHS):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), size):
            pick = order[at : at + size]
            step += 1
            gradient = _gradient(weights, [bags[k] for k in pick], labels[pick], seen)
            rate = 0.01 * (1 - step / (steps + 1)) + 1e-4
            for k, g in gradient.items():
                first, second = moments[k]
                first += 0.1 * (g - first)
                second += 0.002 * (g * g - second)
                scale = np.sqrt(second / (1 - 0.998**step)) + 1e-7
                weights[k] -= rate * (first / (1 - 0.9**step)) / scale
    return _network(weights)


def _network(weights) -> Network:
    return Network(**{**weights, "out_bias": float(weights["out_bias"][0])})


def _gradient(weights, bags, labels, seen):
    data = np.concatenate([bag[0] for bag in bags])
    valid = np.concatenate([bag[1] for bag in bags])
    sizes = np.array([len(bag[0]) for bag in bags])
    starts = np.cumsum(sizes) - sizes
    n, d = len(data), seen.shape[1]
    spots = np.arange(_SPOTS)[:, None] * STRIDE + np.arange(WIDTH)
    x = seen[data[:, spots]].reshape(n * _SPOTS, WIDTH * d)
    response = (x @ weights["filters"] + weights["filter_bias"]).reshape(n, _SPOTS, -1)
    live = (response > 0) & (np.arange(_SPOTS)[:, None] < valid[:, None, None])
    response = np.where(live, response, 0)
    count = np.maximum(valid, 1)[:, None]
    best = response.argmax(1)
    features = np.hstack([response.sum(1) / count, response.max(1)])
    before = features @ weights["hidden"] + weights["hidden_bias"]
    units = np.maximum(before, 0)
    pooled = np.maximum.reduceat(units, starts, axis=0)
    error = (_sigmoid(pooled @ weights["out"] + weights["out_bias"][0]) - labels) / len(bags)
    # Back: only the chunk that won a unit answers for it.
    d_pooled = error[:, None] * weights["out"]
    owner = np.repeat(np.arange(len(bags)), sizes)
    won = (units == pooled[owner]) & (before > 0)
    d_units = np.where(won, d_pooled[owner], 0).astype(np.float32)
    d_features = d_units @ weights["hidden"].T
    d_response = np.repeat((d_features[:, :FILTERS] / count)[:, None, :], _SPOTS, 1)
    rows = np.arange(n)[:, None]
    d_response[rows, best, np.arange(FILTERS)] += d_features[:, FILTERS:]
    d_response = np.where(live, d_response, 0).reshape(n * _SPOTS, -1).astype(np.float32)
    decay = 1e-5
    return {
        "filters": x.T @ d_response + decay * weights["filters"],
        "filter_bias": d_response.sum(0),
        "hidden": features.T @ d_units + decay * weights["hidden"],
        "hidden_bias": d_units.sum(0),
        "out": pooled.T @ error.astype(np.float32) + decay * weights["out"],
        "out_bias": np.array([error.sum()], np.float32),
    }


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_DOCS,
          modulus: int = 5, remainder: int = 0) -> Network:
    """Fits on at most ``rows`` labelled documents, ``SAMPLE_CHUNKS`` chunks of each: a few tens of
    MB on the driver, whatever the tables hold."""
    size = SAMPLE_CHUNKS

    def shrink(batches):
        for batch in batches:
            texts, marks = raw_texts(batch), batch.column(1).to_pylist()
            found = [chunks_of(text, size) for text in texts]
            yield pa.RecordBatch.from_pydict(
                {
                    "bytes": pa.array([x[0].tobytes() for x in found], pa.binary()),
                    "valid": pa.array([x[1].tolist() for x in found], pa.list_(pa.int32())),
                    "label": pa.array(marks, pa.int32()),
                }
            )

    known = sample(shipped(docs), labels, label, rows, modulus, remainder)
    table = known.mapInArrow(shrink, "bytes binary, valid array<int>, label int").toArrow()
    rows_ = sorted(zip(*(table.column(i).to_pylist() for i in range(3))))
    bags = [(np.frombuffer(b, np.uint8).reshape(len(v), -1), np.array(v)) for b, v, _ in rows_]
    return fit_bags(bags, np.array([mark for _, _, mark in rows_], float))


def score(docs: DataFrame, network: Network, modulus: int = 5, remainder: int = 0) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row, by its whole text.

    Null text counts as empty; empty texts get the network's answer to no bytes; repeated rows are
    scored alike, each as its own row; equal texts get equal scores up to rounding; an empty table
    gives no rows; other columns are ignored.
    """

    def run(batches):
        tables = network.tables()
        for batch in batches:
            texts = raw_texts(batch, "text")
            scores = network.probabilities(texts, tables)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64())], schema=_SCHEMA
            )

    chosen = shipped(docs).select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        held_out(modulus, remainder).alias("held_out"),
        text_of(),
    )
    scored = chosen.mapInArrow(run, "doc_id bigint, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def kept(docs: DataFrame, network: Network) -> DataFrame:
    """The rows that count as good, with all their columns, whatever their names.

    Null and empty texts are judged by the network's answer to no bytes; equal texts are judged alike,
    so repeated rows stay or go together; an empty table stays empty.
    """
    name = unused("score", docs.columns)
    return _judged(docs, network, name).where(F.col(name) >= THRESHOLD).drop(name)


def _judged(docs: DataFrame, network: Network, name: str) -> DataFrame:
    """Every column of every row, and its score; rows go through as they are, without a join."""

    def run(batches):
        tables = network.tables()
        for batch in batches:
            scores = network.probabilities(raw_texts(batch), tables)
            yield batch.append_column(name, pa.array(scores, pa.float64()))

    return shipped(docs).mapInArrow(run, T.StructType(list(docs.schema.fields)).add(name, "double"))
