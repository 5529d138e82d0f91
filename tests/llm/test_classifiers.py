import itertools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tripflow.llm import quality_crf as q
from tripflow.llm import toxicity as x
from tripflow.llm.text import blocks

SF = "/root/testdata/sf0.01"


def test_marginals_match_all_labelings():
    rng = np.random.default_rng(4)
    sizes = [3, 0, 1, 6]
    first = np.concatenate([[0], np.cumsum(sizes)])
    potential, step = rng.normal(0, 2, first[-1]), rng.normal(0, 1, (2, 2))
    got, pairs = q.marginals(potential, first, step)
    total = np.zeros((2, 2))
    for a, z in zip(first[:-1], first[1:], strict=True):
        weight, good, moved = 0.0, np.zeros(z - a), np.zeros((2, 2))
        for y in itertools.product([0, 1], repeat=int(z - a)):
            w = np.exp(sum(p * v for p, v in zip(potential[a:z], y, strict=True)) + sum(step[i, j] for i, j in itertools.pairwise(y)))
            weight, good = weight + w, good + w * np.array(y)
            for i, j in itertools.pairwise(y):
                moved[i, j] += w
        if z > a:
            assert np.allclose(got[a:z, 1], good / weight)
            total += moved / weight
    assert np.allclose(pairs, total)


def test_line_features():
    b = next(blocks(pa.array([None, "", "a b c\n\nX## 12 é\na b c", "w w w w"])))
    lines = q.lines_of(b)
    f = {name: lines.x[:, k] for k, name in enumerate(q.FEATURES)}
    assert lines.first.tolist() == [0, 0, 0, 3, 4] and lines.weight.tolist() == [5, 9, 5, 7]
    assert f["repeated_line"].tolist() == [0, 0, 1, 0] and np.allclose(f["marked_words"], [0, 1 / 3, 0, 0])
    assert np.allclose(f["digits"], [0, 2 / 9, 0, 0]) and np.allclose(f["same_as_last"], [0, 0, 0, 0.75])
    near = q.with_neighbours(lines.x, lines.first)
    n = len(q.FEATURES)
    assert (near[1, n:2 * n] == lines.x[0]).all() and (near[3, n:3 * n] == 0).all() and (near[:, -1] == 1).all()


@pytest.mark.parametrize(("run", "label"), [(q.op7_quality_classifier, "quality"), (x.op10_toxicity, "toxic")])
def test_held_out_rows(spark, run, label):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = run(spark, SF).join(labels, "doc_id").collect()
    assert run(spark, SF).count() == docs.count()
    held = [r for r in got if r.held_out]
    good = [r for r in held if r.score is not None and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)]
    assert len(good) == len(held) > 50
    assert sum(r.predicted == r[label] for r in held) >= 0.9 * len(held)


def mixed_docs(spark):
    rows = [(None, "you idiot"), (1, None), (2, ""), (3, " \n"), (4, "good words in a row. " * 20_000), (5, "### $$$ ***"), (5, "### $$$ ***")]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash")).withColumn("raw", F.lit(1))


def test_quality_of_odd_rows_and_without_labels(spark):
    docs = mixed_docs(spark)
    none = q.fit(docs.select("text", F.lit(None).cast("int").alias("label")))
    assert {r.s.score for r in docs.select(q.score(docs, none).alias("s")).collect()} == {0.0, 0.5}
    train = [("the words of a plain line, as they come.\nAnd another one, as plain as that.", 1)] * 30
    train += [("$$$ ### *** $$$ ###\n!!! ### $$$ AAA ###", 0)] * 30
    model = q.fit(spark.createDataFrame(train, "text string, label int"))
    got = docs.select("doc_id", q.score(docs, model).alias("s")).collect()
    score = {r.doc_id: r.s.score for r in got}
    assert len(got) == 7 and score[1] == score[2] == score[3] == 0 and score[5] < 0.3
    assert docs.limit(0).select(q.score(docs, model).alias("s")).count() == 0


def test_toxicity_of_odd_rows_and_without_labels(spark):
    docs = mixed_docs(spark)
    none = spark.createDataFrame([], "doc_id long, label int")
    assert {r.score for r in x.score(docs, none).collect()} == {0.0}
    assert x.score(docs.limit(0), none).count() == 0
    words = [f"w{chr(97 + a)}{chr(97 + b)}" for a in range(26) for b in range(26)]
    rng = np.random.default_rng(1)
    rows = []
    for k in range(600):
        text = list(rng.choice(words, 40))
        if k % 3 == 0:
            text[5], text[20] = "grumpfling", "you"
        rows.append((k, " ".join(text), int(k % 3 == 0)))
    labelled = spark.createDataFrame(rows, "doc_id long, text string, label int")
    more = [(1000, " ".join(words[:40]) + " you grumpflings"), (1001, " ".join(words[40:80])), (1002, " ".join(words[:60]) + " gr.ump.fl1ng you"), (1003, None)]
    both = labelled.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    got = {r.doc_id: r for r in x.score(both, labelled.select("doc_id", "label")).collect()}
    assert got[1000].score >= 0.7 and got[1001].score < 0.3 and got[1002].obfuscated_hits == 1 and 0 <= got[1003].score <= 1
