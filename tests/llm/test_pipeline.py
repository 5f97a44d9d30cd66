"""The stages in turn, each against the operator it stands for."""

import collections

import corpus_pipeline
from brute import groups, without_repeats

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    before = None
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / str(number)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(number)))
        old = {r["doc_id"]: r["text"] for r in before.collect()}
        if name == "packing":
            assert {r["doc_id"] for r in docs.collect()} == old.keys()
            break
        assert docs.columns == columns
        new = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name == "n-gram Jaccard join":
            assert len(new) == len({g for _, g, _ in groups(list(old.items()))})
        if name == "substring dedup":
            gone = {d: n for d, _, n, _ in without_repeats(list(old.items()))}
            assert new.keys() == old.keys()
            for doc_id, text in new.items():
                assert (len(text.split()) == len(old[doc_id].split()) - gone[doc_id])
                assert gone[doc_id] or text == old[doc_id]
        else:
            assert new.items() <= old.items() and len(new) > 0.5 * len(old)


def test_run(spark):
    found = corpus_pipeline.run(spark, SF).collect()
    spans = collections.defaultdict(list)
    for r in found:
        spans[r["doc_id"]].append((r["start"], r["length"]))
    for mine in spans.values():
        at = 0
        for start, length in sorted(mine):
            assert start == at
            at += length
