"""The manifest against a plain recomputation of the contract."""
import zlib
from hashlib import sha256

import pytest

from pyspark.sql import functions as F
from tripflow.llm import merkle
from tripflow.llm.text import table

SF = "/root/testdata/sf0.001"


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf(values):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def up(nodes):
    """(top digest, levels) by the rule: eight at a time while several remain."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest("".join(last[k:k + 8])) for k in range(0, len(last), 8)])
    return levels[-1][0], levels


def climb(levels, at, new):
    """(digest at the top with ``new`` at a place, siblings)."""
    siblings = []
    for level in levels[:-1]:
        run = level[at // 8 * 8:at // 8 * 8 + 8]
        siblings += run[:at % 8] + run[at % 8 + 1:]
        new = digest("".join(run[:at % 8] + [new] + run[at % 8 + 1:]))
        at //= 8
    return new, siblings


def brute(rows, tamper):
    """(id, leaf, subroot, root, proof, folded, verified) of rows of FIELDS."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        members = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = (members, *up([leaf(r) for r in members]))
    root, tops = up([trees[g][1] for g in names])
    out = []
    for k, g in enumerate(names):
        members, subroot, levels = trees[g]
        for at, r in enumerate(members):
            mine, low = climb(levels, at, leaf(tamper(r)))
            folded, high = climb(tops, k, mine)
            out.append((r[0], leaf(r), subroot, root, digest("".join(low + high)), folded, folded == root))
    return out


def tamper(r):
    if r[0] is None or zlib.crc32(str(r[0]).encode()) % 3 or r[4] is None:
        return r
    return (*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=str)


def test_query(spark):
    docs = [tuple(r) for r in table(spark, SF, "documents").select(*merkle.FIELDS).collect()]
    out = merkle.op11_merkle_manifest(spark, SF)
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = ordered(out.collect())
    assert got == ordered(brute(docs, tamper))
    assert {r[6] for r in got} == {True, False}


@pytest.mark.parametrize("height", [1, 2])
def test_many_blocks_and_groups(spark, height):
    """Several blocks a tree, levels of blocks over them, more groups than a run."""
    rows = [(k, f"s{k % 7}", None if k % 3 == 0 else f"l{k % 13}é" if k % 3 == 1 else "ä", k % 5, f"Text {k} Ω")
            for k in range(700)]
    rows += [(5, "a", "one", 1, "X"), (None, None, "ä", None, None), (3, "s", None, 0, ""), (3, "s", None, 0, "")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    changed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lower("text")).otherwise(F.col("text"))
    got = merkle.manifest(docs, replaced={"text": changed}, proofs=True, height=height)
    want = brute(rows, lambda r: r if r[0] is None or zlib.crc32(str(r[0]).encode()) % 3 or r[4] is None
                 else (*r[:4], r[4].lower()))
    rows_got = got.collect()
    assert ordered(tuple(r)[:6] + (r.verified,) for r in rows_got) == ordered(want)
    assert all(digest("".join(r.proof)) == r.proof_sha256 for r in rows_got)


def test_odd_tables(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string, tree string, at long"
    one = spark.createDataFrame([(None, None, None, None, None, "x", 1)], schema)
    row = merkle.manifest(one).first()
    assert row.leaf == row.subroot == row.root == row.folded_root == digest("-----")
    assert row.proof_sha256 == digest("") and row.verified
    assert merkle.manifest(one.limit(0)).collect() == []
    long = spark.createDataFrame([(1, "s", "en", 9, "Long text " * 200_000, "t", 0)], schema)
    text = long.first().text
    assert merkle.manifest(long).first().leaf == leaf((1, "s", "en", 9, text))
