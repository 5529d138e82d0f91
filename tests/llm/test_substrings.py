"""Substring dedup against all windows held in a dictionary."""
import re
from hashlib import sha256

import numpy as np
import pytest

from tripflow.llm import substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    least = {}
    for i, text in rows:
        words = WORD.findall(text or "")
        for p in range(len(words) - 49) if i is not None else ():
            g = tuple(words[p:p + 50])
            least[g] = min(least.get(g, i), i)
    out = []
    for i, text in rows:
        words = WORD.findall(text or "")
        gone = set()
        for p in range(len(words) - 49) if i is not None else ():
            if least[tuple(words[p:p + 50])] < i:
                gone.update(range(p, p + 50))
        kept = [w for p, w in enumerate(words) if p not in gone]
        out.append((i, len(words), len(gone), " ".join(kept)))
    return out


def check(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, path string, start long")
    want = brute(rows)
    got = [tuple(r) for r in substrings.report(docs.repartition(3)).collect()]
    assert sorted(got, key=str) == sorted(((i, n, m, sha256(t.encode()).hexdigest()) for i, n, m, t in want), key=str)
    texts = [(r.doc_id, r.text) for r in substrings.dedup(docs).collect()]
    old = {i: t for i, t in rows}
    full = [(i, t if m else o) for (i, _, m, t), (_, o) in zip(want, rows)]
    assert sorted(texts, key=str) == sorted(full, key=str) and old
    return want


@pytest.mark.parametrize("seed", range(3))
def test_shared_stretches(spark, seed):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{k}" for k in range(30)] if seed else ["a", "b", "c"]
    shared = [[vocabulary[k] for k in rng.integers(0, len(vocabulary), n)] for n in (49, 50, 51, 70, 120, 300)]
    rows = []
    for i in rng.permutation(40).tolist():
        words = []
        for _ in range(rng.integers(0, 6)):
            part = list(shared[rng.integers(0, len(shared))])
            lo = int(rng.integers(0, 30))
            part = part[lo:] if rng.random() < 0.5 else part
            if rng.random() < 0.4 and part:
                part[int(rng.integers(0, len(part)))] = "changed"
            words += part + [vocabulary[k] for k in rng.integers(0, len(vocabulary), rng.integers(0, 20))]
        rows.append((i, (" " if i % 2 else "\n ").join(words)))
    want = check(spark, rows)
    assert any(0 < m < n for _, n, m, _ in want)


def test_odd_rows(spark):
    text = " ".join(f"w{k % 80}" for k in range(5_000))
    other = " ".join(f"v{k}" for k in range(60))
    check(spark, [(1, None), (2, ""), (None, other), (3, other), (3, text), (3, text), (4, text), (4, other + " " + text),
                  (None, text), (5, "\x00 é " + other), (6, "a " * 200), (7, "a " * 49), (8, "a " * 50)])
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.report(empty).collect() == [] and substrings.dedup(empty).collect() == []


def test_hot_path(spark):
    """One passage in every document, each with its own surroundings."""
    passage = " ".join(f"p{k}" for k in range(60))
    check(spark, [(i, f"a{i} b{i} {passage} c{i} d{i}") for i in range(300)])
