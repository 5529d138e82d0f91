"""Runs against brute force over every period."""
import re
import zlib
from hashlib import sha256

import numpy as np
import pytest

from tripflow.llm import periodic
from tripflow.llm.text import table

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words):
    """All runs, period by period, of a list of words."""
    n, out = len(words), []
    code = {w: k for k, w in enumerate(dict.fromkeys(words))}
    v = np.array([code[w] for w in words], np.int64)
    for q in range(1, n // 4 + 1):
        same = np.concatenate([[False], v[:-q] == v[q:], [False]])
        edge = np.flatnonzero(same[1:] != same[:-1])
        for lo, hi in zip(edge[::2].tolist(), edge[1::2].tolist()):
            length = hi - lo + q
            x = v[lo:lo + length]
            smaller = any(q % d == 0 and (x[:-d] == x[d:]).all() for d in range(1, q))
            if length >= max(6, 4 * q) and not smaller:
                out.append((lo, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def changed(words, h):
    if h is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def brute_row(doc_id, text, seeded=True):
    words = WORD.findall(text or "")
    if seeded:
        words = changed(words, None if doc_id is None else zlib.crc32(str(doc_id).encode()))
    runs = brute_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha256(lines.encode()).hexdigest(), sha256(kept.encode()).hexdigest())


def found(rows):
    first = np.cumsum([0, *(len(r) for r in rows)])
    value = np.array([zlib.crc32(str(w).encode()) * 0x9E3779B97F4A7C15 % 2 ** 64 for r in rows for w in r], np.uint64)
    row, start, length, period = periodic.find_runs(value, first)
    return [[(s - first[r], n, q) for k, s, n, q in zip(row.tolist(), start.tolist(), length.tolist(), period.tolist())
             if k == r] for r in range(len(rows))]


@pytest.mark.parametrize("seed", range(12))
def test_random_words(seed):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(20):
        parts = []
        for _ in range(rng.integers(0, 6)):
            unit = rng.integers(0, rng.integers(1, 5) + 1, rng.integers(1, 70)).tolist()
            parts += (unit * int(rng.integers(1, 9)))[:int(rng.integers(1, 400))]
        rows.append(parts)
    assert found(rows) == [brute_runs(r) for r in rows]


def test_nested_periods():
    unit = [0] * 90 + [1]
    inner = ([0, 1] * 40 + [2] * 17) * 5
    fibonacci = [0]
    other = [0, 1]
    while len(other) < 600:
        fibonacci, other = other, other + fibonacci
    rows = [unit * 6, inner, unit * 3 + [0] * 50 + inner, other, [7] * 5000, [], [3] * 5, [3] * 6]
    assert found(rows) == [brute_runs(r) for r in rows]


def test_query_against_brute_force(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text").collect()
    want = sorted(brute_row(r.doc_id, r.text) for r in docs)
    out = periodic.op13_periodic_runs(spark, SF)
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                           "collapsed_sha256"]
    assert sorted(tuple(r) for r in out.collect()) == want
    assert any(r[1] for r in want)


def test_odd_rows_and_columns(spark):
    long = "ab cd " * 30_000
    rows = [(1, None, "x"), (2, "", None), (None, "a a a a a a a b", "y"), (3, "a a a a a", None), (4, long, "z"),
            (4, long, "z"), (5, "                   ", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string")
    got = periodic.collapse(docs.withColumnRenamed("start", "seed")).collect()
    key = lambda r: (r[0] is not None, r)
    assert sorted((tuple(r) for r in got), key=key) == sorted((brute_row(i, t, False) for i, t, _ in rows), key=key)
    listed = sorted((tuple(r) for r in periodic.runs(docs).collect()), key=key)
    assert listed == sorted(((i, *r) for i, t, _ in rows for r in brute_runs(WORD.findall(t or ""))), key=key)
    assert periodic.collapse(docs.limit(0)).collect() == []
