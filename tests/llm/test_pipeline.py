"""The pipeline against a plain version of each stage, over the smallest tables."""

import os
import random

import pytest

import corpus_pipeline
from mergestone.llm import pieces, quality, toxicity
from mergestone.llm.components import UnionFind
from mergestone.llm.words import alnum_words

FOLDER = "/root/testdata/sf0.001"


def same_groups(rows):
    """Smallest id of each group linked by five-word shingles at 0.8, pair by pair."""
    sets = []
    for i, t in rows:
        w = t.encode().lower().split()
        sets.append((i, {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()))
    union = UnionFind()
    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                union.union(i, j)
    return {i: union.find(i) for i, _ in sets}


def leaks(t, windows):
    words = alnum_words(t.encode())
    return any(tuple(words[i : i + n]) in windows for n in {len(w) for w in windows} for i in range(len(words) - n + 1))


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the test tables are not here")
def test_pipeline_against_plain_stages(spark):
    sentencepiece = pytest.importorskip("sentencepiece")
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())

    chain = toxicity.train(docs, labels)
    p = chain.predict([t.encode() for _, t in rows])[:, -1]
    rows = [r for r, x in zip(rows, p) if x < chain.threshold]

    scorer = quality.train(spark.createDataFrame(rows, "doc_id long, text string"))
    shapes = quality.Shapes()
    rows = [r for r in rows if quality.score_of(*shapes.of(r[1].encode()), scorer.weights) >= 0.5]

    group = same_groups(rows)
    rows = [r for r in rows if group[r[0]] == r[0]]

    windows = set()
    for item in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect():
        words = alnum_words(item["text"].encode())
        n = min(10, len(words))
        windows |= {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
    rows = [r for r in rows if not leaks(r[1], windows)]

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    want = {i: library.encode(t) for i, t in rows}
    got = {r["doc_id"]: list(r["ids"]) for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert got == want and len(want) > 50


def test_every_stage_takes_odd_rows(spark, tmp_path):
    rng = random.Random(0)
    rows = [(i, " ".join(rng.choice(["the", "of", "and", "river", "stone", f"w{rng.randrange(99)}"]) for _ in range(30)) + ".", "en", "s", 9) for i in range(40)]
    rows += [(50, None, None, None, None), (51, "", "en", "s", 0), (None, "nameless text of the river and the stone", "en", "s", 1), (3, rows[3][1], "en", "s", 9), (52, "word " * 30_000, "en", "s", 1)]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    for name, made in (("some", rows), ("none", [])):
        folder = f"{tmp_path}/{name}"
        spark.createDataFrame(made, kind).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(20)] if made else [], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([(1, "alpha beta gamma")] if made else [], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs_after = stage(spark, docs, folder)
            if number < len(corpus_pipeline.STAGES) - 1:
                assert docs_after.columns == docs.columns
            assert docs_after.count() <= len(made)
        out = corpus_pipeline.run(spark, folder)
        assert out.columns == ["doc_id", "ids", "n_pieces"]
        assert out.count() == 0 if not made else out.count() > 20
