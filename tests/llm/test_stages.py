"""Defined results of the pipeline's stages on odd rows, and the network against a plain forward pass."""

import collections
import dataclasses

import numpy as np
import pytest
from brute import without_repeats

import corpus_pipeline
from daystrata.llm import convnet, paths, repeats, toxicity
from daystrata.llm.labelled import sample

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SF = "/root/testdata/sf0.001"


def network(seed=1):
    rng = np.random.default_rng(seed)
    return convnet._network(
        {
            "filters": rng.normal(0, 1, (convnet.WIDTH * 16, convnet.FILTERS)),
            "filter_bias": rng.normal(0, 1, convnet.FILTERS),
            "hidden": rng.normal(0, 1, (2 * convnet.FILTERS, convnet.HIDDEN)),
            "hidden_bias": rng.normal(0, 1, convnet.HIDDEN),
            "out": rng.normal(0, 0.02, convnet.HIDDEN),
            "out_bias": np.zeros(1),
        }
    )


def forward(net, text):
    """Chunk by chunk and place by place, zeros behind the text."""
    seen, best = convnet.byte_features(), None
    for start in range(0, max(1, len(text) - convnet.CHUNK // 2), convnet.CHUNK // 2):
        responses = []
        for at in range(start, min(start + convnet.CHUNK, len(text)), convnet.STRIDE):
            part = text[at : at + convnet.WIDTH].ljust(convnet.WIDTH, b"\0")
            responses.append(np.maximum(seen[list(part)].ravel() @ net.filters + net.filter_bias, 0))
        if responses:
            features = np.concatenate([np.mean(responses, 0), np.max(responses, 0)])
        else:
            features = np.zeros(2 * convnet.FILTERS)
        units = np.maximum(features @ net.hidden + net.hidden_bias, 0)
        best = units if best is None else np.maximum(best, units)
    return 1 / (1 + np.exp(-(best @ net.out + net.out_bias)))


def test_a_score_is_of_the_text_alone():
    net = network()
    tables, rng = net.tables(), np.random.default_rng(3)
    texts = [bytes(rng.integers(32, 250, n, np.uint8)) for n in [*range(301), 1020, 1024, 1025, 5000, 40_000]]
    want = np.array([forward(net, text) for text in texts])
    alone = np.array([net.probabilities([text], tables)[0] for text in texts])
    assert np.abs(alone - want).max() < 1e-5
    for neighbour in (b"#!|" * 60, "é".encode() * 100):
        mixed = [x for text in texts for x in (text, neighbour)]
        assert np.abs(net.probabilities(mixed, tables)[::2] - want).max() < 1e-5
    order = rng.permutation(len(texts))
    assert np.abs(net.probabilities([texts[i] for i in order], tables) - want[order]).max() < 1e-5


def test_one_row_stands_for_an_id(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (2, "c"), (None, "d")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (None, 1), (3, 1)], "doc_id bigint, quality int")
    found = sample(docs, labels, "quality", 10, 1000, 999)
    assert sorted(tuple(r) for r in found.collect()) == [("", 1), ("c", 0)]


LONG = " ".join(f"w{i}" for i in range(120))
ROWS = [
    (None, None, "en", None, None), (1, "", None, "s", 0), (2, "a b c", "en", "s", 5), (2, "a b c", "en", "s", 5),
    (3, LONG, "en", "s", 1), (4, "x\n" + LONG, "de", "t", None), (None, LONG, "de", "t", 2), (5, "z " * 40_000, "en", "s", 9),
    (6, "plain words here", None, None, 16),
]
NAMES = ["score", "doc_key", "text_key", "_doc_key", "_text_key", "found", "_found", "score_"]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, DOCUMENTS)


@pytest.fixture(scope="module")
def clashing(odd):
    return odd.selectExpr("*", *[f"n_chars as {name}" for name in NAMES])


def rows_of(frame):
    return collections.Counter(map(tuple, frame.collect()))


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_odd_rows(spark, odd, name, stage):
    got = stage(spark, odd, SF)
    empty = stage(spark, odd.where("false"), SF)
    assert empty.count() == 0 and empty.columns == got.columns
    if name == "packing":
        assert {r["doc_id"] for r in got.collect()} == {row[0] for row in ROWS}
        return
    assert got.columns == odd.columns
    left, before = rows_of(got), collections.Counter(ROWS)
    if name in ("quality classifier", "toxicity"):
        assert not left - before
        # Equal texts, null and empty among them, go one way.
        verdicts = collections.defaultdict(set)
        for row, n in before.items():
            verdicts[row[1] or ""].add(left[row] == n)
            assert left[row] in (0, n)
        assert all(len(v) == 1 for v in verdicts.values())
    elif name == "n-gram Jaccard join":
        assert left == collections.Counter({**{row: 1 for row in before}, ROWS[4]: 0, ROWS[5]: 0}) + collections.Counter()
    else:
        gone = {(d, n): r for d, n, r, _ in without_repeats([row[:2] for row in ROWS])}
        assert sum(left.values()) == len(ROWS)
        for doc_id, text, *_ in left:
            words = (text or "").split()
            assert any(d == doc_id and n - r == len(words) for (d, n), r in gone.items())
        assert left[ROWS[0]] == 1 and left[ROWS[2]] == 2


def test_columns_of_any_name_stay(clashing):
    certain = dataclasses.replace(network(), out_bias=50.0)
    # Without labels nothing is known, and one half counts as toxic.
    model = toxicity.train(clashing, clashing.sparkSession.createDataFrame([], "doc_id bigint, toxic int"))
    for got, n in (
        (convnet.kept(clashing, certain), len(ROWS)), (toxicity.kept(clashing, model), 0),
        (paths.one_of_each(clashing), 6), (repeats.cut(clashing), len(ROWS)),
    ):
        assert got.columns == clashing.columns and got.count() == n


def test_passages_in_pieces():
    """Cut into pieces, windows keep their grams; long texts need that."""
    hashes = np.random.default_rng(5).integers(0, 50, 4000).astype(np.uint64)

    def grams(piece):
        found = {}
        for gram, first, last in zip(*repeats.passages(hashes, 35, 8, piece)):
            found.update({k: gram for k in range(first, last + 1)})
        return found

    whole = grams(1 << 23)
    assert len(whole) == 4000 - 34 and grams(100) == whole and grams(1) == whole


def test_words_that_go_round():
    """A gram that follows upon itself gives a span for many windows, not for each; none is lost."""
    rng = np.random.default_rng(7)
    for period in (1, 2, 3, 13, 28, 40):
        turn, other = rng.integers(0, 1 << 60, (2, period)).astype(np.uint64)
        hashes = np.r_[other, np.tile(turn, 700 // period), other]
        for piece in (1 << 23, 100):
            grams, first, last = repeats.passages(hashes, 35, 8, piece)
            assert first[0] == 0 and last[-1] == len(hashes) - 35 and (first[1:] == last[:-1] + 1).all()
            assert (last - first).max() < 28 and len(grams) < len(hashes) / 10
            for gram, a, b in zip(grams, first, last):
                held = {hashes[k : k + 35].tobytes() for k in range(a, b + 1)}
                assert len(held) == b - a + 1 or (grams == gram).sum() > 1


@pytest.mark.parametrize("group", [256, 2])
def test_repeats_where_words_go_round(spark, group):
    texts = [
        "na " * 36, "ho " * 35, "a b " * 30, "x y z " * 40 + "end", "start " + "x y z " * 40, "go " * 3000,
        "c " * 34 + "d " + "c " * 80, "e f " * 18 + "g", "e f " * 17 + "h", "i " * 64, "j " + "i " * 70 + "k",
    ]
    frame = spark.createDataFrame([(i, x, None, None, None) for i, x in enumerate(texts)], DOCUMENTS)
    names = ("doc_id", "n_words", "n_removed", "kept_sha256")
    got = repeats.remove(frame, group=group).select(*names).collect()
    assert collections.Counter(map(tuple, got)) == without_repeats(list(enumerate(texts)))
