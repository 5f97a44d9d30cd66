"""Toxic passages as maximum-scoring segments, and documents by their extreme values.

Words carry log-odds of standing in a toxic document, with a Dirichlet prior from the whole sample;
the lower bound of each is its score, and only clear ones count. All other words share one small
negative score. A linear-time scan finds every maximal segment of a text's scores. Under the clean
model the largest segment of n words follows an extreme-value law, which turns scores of short and
long texts into one scale; a logistic curve over it, fitted on the sample, gives the probability.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daystrata.llm.labelled import held_out, sample
from daystrata.llm.words import MEMO_ENTRIES, shipped, string_texts, text_of, unused
from daystrata.sources.files import checkpointed

#: Labelled documents to learn from at most.
SAMPLE_DOCS = 6000
#: Weight of the prior, as a share of the sample's words.
PRIOR_SHARE = 0.01
#: Standard deviations taken off a word's log-odds, and the least that is then left of a word that counts.
CAUTION, LEAST = 1.5, 3.0
#: Expected chance finds in a clean text, below which a passage is significant.
E_VALUE = 0.05
#: Probability from which a document counts as toxic.
THRESHOLD = 0.3
#: Beginnings of words that stand for all words with them, where the whole word is not known.
STEMS = (5, 4)

_WORD = re.compile(r"[^\W\d_]+")
_PASSAGES = "array<struct<first_word:int,last_word:int,score:double>>"


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def names_of(word: str) -> list[str]:
    """The entries a word may be listed under, most specific first; stems end in a star."""
    return [word] + [word[:n] + "*" for n in STEMS if len(word) >= n]


@dataclass
class Lexicon:
    """Scores of words that count, and of all others; the clean model's two constants."""

    scores: dict[str, float]
    other: float
    decay: float = 1.0
    scale: float = 1.0

    def __post_init__(self):
        self._memo: dict[str, float] = {}

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_memo"}

    def __setstate__(self, state):
        self.__dict__.update(state, _memo={})

    def hits(self, words: list[str]) -> list[tuple[int, float]]:
        memo = self._memo
        try:
            return [(i, s) for i, w in enumerate(words) if (s := memo[w])]
        except KeyError:
            if len(memo) > MEMO_ENTRIES:
                memo.clear()
            for word in set(words).difference(memo):
                listed = (self.scores[n] for n in names_of(word) if n in self.scores)
                memo[word] = next(listed, 0.0)
            return [(i, s) for i, w in enumerate(words) if (s := memo[w])]

    def segments(self, words: list[str]) -> list[tuple[int, int, float]]:
        """All maximal segments ``(first word, last word, score)``, in linear time.

        Words that do not count only lower a running total, so the scan steps from hit to hit.
        """
        kept: list[list] = []
        total, after = 0.0, 0
        for at, gain in self.hits(words):
            total += self.other * (at - after)
            # A segment: first, last, total before it, total with it.
            new = [at, at, total, total + gain]
            total += gain
            after = at + 1
            while True:
                # The last earlier segment that began at a lower total.
                j = len(kept) - 1
                while j >= 0 and kept[j][2] >= new[2]:
                    j = kept[j][4]
                if j < 0 or kept[j][3] >= new[3]:
                    kept.append([*new, j])
                    break
                new = [kept[j][0], new[1], kept[j][2], new[3]]
                del kept[j:]
        return [(first, last, end - begin) for first, last, begin, end, _ in kept]

    def expected(self, score: float, n: int) -> float:
        """Segments at least as good that chance gives in a clean text of ``n`` words."""
        return self.scale * max(n, 1) * math.exp(-self.decay * score)

    def measures(self, words: list[str]) -> tuple[list[float], list[tuple[int, int, float]]]:
        """What the curve sees of a text, and its significant passages."""
        found = self.segments(words)
        passages = [s for s in found if self.expected(s[2], len(words)) <= E_VALUE]
        best = max((s[2] for s in found), default=0.0)
        whole = sum(s[2] for s in found)
        level = math.log(self.scale * max(len(words), 1))
        rise = [min(20.0, max(-20.0, self.decay * s - level)) if s else -20.0 for s in (best, whole)]
        return [1.0, *rise, float(bool(passages))], passages


def log_odds(toxic: float, clean: float, toxic_all: float, clean_all: float, prior_all: float):
    """A word's log-odds ratio and its standard deviation, with the prior from both classes."""
    prior = prior_all * (toxic + clean) / (toxic_all + clean_all)
    inside, outside = toxic + prior, clean + prior
    ratio = math.log(inside / max(toxic_all + prior_all - inside, 1e-9)) - math.log(
        outside / max(clean_all + prior_all - outside, 1e-9)
    )
    return ratio, math.sqrt(1 / inside + 1 / outside)


def lexicon_of(counts: list[tuple[str, int, int]], toxic_all: int, clean_all: int) -> Lexicon:
    """From counts per entry and class. Without both classes nothing counts."""
    if not toxic_all or not clean_all:
        return Lexicon({}, -0.01)
    prior = PRIOR_SHARE * (toxic_all + clean_all)
    scores, listed = {}, [0.0, 0.0]
    null: list[tuple[float, float]] = []
    for entry, toxic, clean in counts:
        ratio, spread = log_odds(toxic, clean, toxic_all, clean_all, prior)
        if ratio - CAUTION * spread >= LEAST:
            scores[entry] = ratio - CAUTION * spread
    for entry, toxic, clean in counts:
        if entry in scores and not entry.endswith("*"):
            share = prior * (toxic + clean) / (toxic_all + clean_all)
            null.append(((clean + share) / (clean_all + prior), scores[entry]))
            listed[0] += toxic / toxic_all
            listed[1] += clean / clean_all
    other = math.log(max(1 - listed[0], 0.05) / max(1 - listed[1], 0.05)) - 0.005
    rest = 1 - sum(p for p, _ in null)
    low, high = 0.01, 3.0
    for _ in range(60):
        mid = (low + high) / 2
        rise = sum(p * math.exp(mid * s) for p, s in null) + rest * math.exp(mid * other)
        low, high = (low, mid) if rise > 1 else (mid, high)
    return Lexicon(scores, other, decay=max(low, 0.05))


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    curve: tuple[float, ...]

    def judge(self, text: str):
        measures, passages = self.lexicon.measures(words_of(text))
        x = sum(a * b for a, b in zip(self.curve, measures))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x)))), passages


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = SAMPLE_DOCS,
          modulus: int = 4, remainder: int = 2) -> Model:
    """Fits on at most ``rows`` labelled documents; the driver gets entries that count and four numbers
    per document.

    A word is counted once for each pair of neighbours it has, so passages that are copied between
    documents do not pass for evidence.
    """
    known = checkpointed(sample(shipped(docs), labels, label, rows, modulus, remainder))

    def entries(batches):
        for batch in batches:
            seen: set[tuple] = set()
            for text, mark in zip(string_texts(batch), batch.column(1).to_pylist()):
                words = words_of(text)
                for before, word, after in zip(["", *words], words, [*words[1:], ""]):
                    seen.add((word, f"{before} {after}", mark))
            yield pa.RecordBatch.from_pydict(
                {
                    "word": pa.array([x[0] for x in seen], pa.string()),
                    "around": pa.array([x[1] for x in seen], pa.string()),
                    "label": pa.array([x[2] for x in seen], pa.int32()),
                }
            )

    placed = known.mapInArrow(entries, "word string, around string, label int")
    once = placed.groupBy("word", F.xxhash64("around").alias("around"), "label").agg(F.lit(1))
    words = checkpointed(
        once.groupBy("word").agg(
            F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")
        )
    )
    toxic_all, clean_all = words.agg(F.sum("toxic"), F.sum("clean")).first()
    stems = [
        F.when(F.length("word") >= n, F.concat(F.substring("word", 1, n), F.lit("*"))) for n in STEMS
    ]
    named = words.select(F.explode(F.array("word", *stems)).alias("entry"), "toxic", "clean")
    counted = named.where("entry is not null").groupBy("entry").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
    )
    # Only entries many times as frequent among the toxic can pass the bound on the log-odds.
    rare = (F.col("toxic") * float(clean_all or 0) >= 10.0 * F.col("clean") * float(toxic_all or 0)) & (
        F.col("toxic") >= 3
    )
    counts = [tuple(row) for row in counted.where(rare).orderBy("entry").collect()]
    lexicon = lexicon_of(counts, toxic_all or 0, clean_all or 0)

    def heights(batches):
        for batch in batches:
            texts = [words_of(text) for text in string_texts(batch)]
            best = [max((s[2] for s in lexicon.segments(w)), default=0.0) for w in texts]
            yield pa.RecordBatch.from_pydict(
                {"n": pa.array(map(len, texts), pa.int64()), "best": best, "label": batch.column(1)}
            )

    clean = known.where("label = 0").mapInArrow(heights, "n bigint, best double, label int")
    sums = clean.agg(
        F.count("*"), F.sum(F.greatest("n", F.lit(1)) * F.exp(-lexicon.decay * F.col("best")))
    ).first()
    lexicon.scale = sums[0] / sums[1] if sums[1] else 1.0

    def measured(batches):
        for batch in batches:
            rows_ = [lexicon.measures(words_of(text))[0] for text in string_texts(batch)]
            yield pa.RecordBatch.from_pydict(
                {"x": pa.array(rows_, pa.list_(pa.float64())), "label": batch.column(1)}
            )

    table = known.mapInArrow(measured, "x array<double>, label int").toArrow().to_pydict()
    pairs = sorted(zip(table["x"], table["label"]))
    return Model(lexicon, logistic([x for x, _ in pairs], [y for _, y in pairs]))


def logistic(x: list[list[float]], y: list[int]) -> tuple[float, ...]:
    """Logistic weights by Newton steps with a slight ridge; the class share where there is one class."""
    if len(set(y)) < 2:
        share = 0.5 if not y else min(0.99, max(0.01, float(y[0])))
        return (math.log(share / (1 - share)), 0.0, 0.0, 0.0)
    a, b = np.array(x), np.array(y, float)
    a[:, 1:3] /= 10
    w = np.zeros(a.shape[1])
    ridge = 0.05 * np.eye(len(w))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + ridge
        w = w + np.linalg.solve(h, a.T @ (b - p) - ridge @ w)
    w[1:3] /= 10
    return tuple(float(v) for v in w)


def score(docs: DataFrame, model: Model, modulus: int = 4, remainder: int = 2) -> DataFrame:
    """``(doc_id, held_out, score, predicted, passages)`` for every row, by its whole text.

    ``passages`` are the significant segments, by word from 0. Null text counts as empty; a text
    without words gets the curve's answer to no hit; equal texts get equal scores; repeated rows
    stay; an empty table gives no rows; other columns are ignored.
    """

    def run(batches):
        for batch in batches:
            found = [model.judge(text) for text in string_texts(batch, "text")]
            passages = [
                [{"first_word": a, "last_word": b, "score": s} for a, b, s in p] for _, p in found
            ]
            kind = pa.list_(
                pa.struct(
                    [("first_word", pa.int32()), ("last_word", pa.int32()), ("score", pa.float64())]
                )
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([s for s, _ in found], pa.float64()),
                    pa.array(passages, kind),
                ],
                names=["doc_id", "held_out", "score", "passages"],
            )

    chosen = shipped(docs).select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        held_out(modulus, remainder).alias("held_out"),
        text_of(),
    )
    ddl = f"doc_id bigint, held_out boolean, score double, passages {_PASSAGES}"
    scored = chosen.mapInArrow(run, ddl)
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def kept(docs: DataFrame, model: Model) -> DataFrame:
    """The rows that do not count as toxic, with all their columns, whatever their names; no join.

    Null and empty texts hold no segment and are scored as such; equal texts are judged alike, so repeated
    rows stay or go together; an empty table stays empty.
    """
    name = unused("score", docs.columns)

    def run(batches):
        for batch in batches:
            scores = [model.judge(text)[0] for text in string_texts(batch)]
            yield batch.append_column(name, pa.array(scores, pa.float64()))

    schema = T.StructType(list(docs.schema.fields)).add(name, "double")
    return shipped(docs).mapInArrow(run, schema).where(F.col(name) < THRESHOLD).drop(name)
