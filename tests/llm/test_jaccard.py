import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tripflow.llm import jaccard as j
from tripflow.llm.components import components


def shingles(text):
    w = re.sub("[A-Z]", lambda m: m.group().lower(), text or "").encode().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """(size, component) by row, from all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(k)] = min(doc, least.get(find(k), doc))
    return [(doc, len(sets[k]), least.get(find(k)) if sets[k] else doc) for k, (doc, _) in enumerate(rows)]


def corpus(seed, groups=25, copies=12):
    """Groups of edited copies, with a passage that many texts share."""
    rng = random.Random(seed)
    word = lambda: rng.choice("ab") + str(rng.randrange(3000))
    passage = [word() for _ in range(12)]
    rows, doc = [(1_000_000, None), (1_000_001, ""), (1_000_002, " \n"), (1_000_003, "One Two"), (1_000_004, "one\ttwo"),
                 (1_000_005, "one two three"), (None, "one two"), (None, "alone here")], 0
    for _ in range(groups):
        base = [word() for _ in range(rng.choice([3, 8, 30, 90]))] + (passage if rng.random() < 0.5 else [])
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 12)):
                text[rng.randrange(len(text))] = word()
            if rng.random() < 0.2:
                text = text[rng.randrange(3):]
            rows.append((doc, " ".join(text)))
            doc += 1
    rng.shuffle(rows)
    return rows + rows[:5]


@pytest.mark.parametrize(("seed", "long", "outer", "members"), [(1, 128, 512, 2048), (2, 3, 512, 2048), (3, 2, 2, 3)])
def test_components_match_all_pairs(spark, monkeypatch, seed, long, outer, members):
    """Also where nearly all lists are long, and their chunks tiny."""
    for name, value in (("LONG", long), ("CLUSTER_ITEMS", 4_000_000 if seed == 1 else 300 if seed == 2 else 0), ("OUTER", outer), ("MEMBERS", members), ("COLUMNS", 16), ("LEADERS", 1 if seed == 3 else 4)):
        monkeypatch.setattr(j, name, value)
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("set", F.lit("clash"))
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in j.join_documents(docs).collect()]
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_clusters_of_many_sets_leave_the_one_task(spark, monkeypatch):
    """The bound is on sets too: no task gets a cluster of more than CLUSTER_SETS."""
    monkeypatch.setattr(j, "CLUSTER_SETS", 2)
    monkeypatch.setattr(j, "LONG", 3)
    sizes, large = spark.sparkContext.accumulator(0), []
    compare, path = j._cluster_labels, j._links_of_large_clusters

    def counted(cluster):
        if cluster.num_rows > 2:
            sizes.add(1)
        return compare(cluster)

    def counted_path(*args):
        large.append(1)
        return path(*args)
    monkeypatch.setattr(j, "_cluster_labels", lambda cluster: counted(cluster))
    monkeypatch.setattr(j, "_links_of_large_clusters", counted_path)
    rows = corpus(5, groups=12)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in
           j.join_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
    assert sizes.value == 0 and large


def test_labels_of_a_cluster_are_its_components_smallest():
    rng = random.Random(6)
    sets = [sorted(set(base) - {rng.choice(base)}) for base in ([list(range(k * 100, k * 100 + 20)) for k in range(5)]) for _ in range(80)]
    sets.append(list(range(900, 920)))      # links with none
    ids = rng.sample(range(-1000, 1000), 401)
    got = j._cluster_labels(pa.table({"label": [0] * 401, "set": ids, "n": [len(s) for s in sets], "items": sets}))
    label = dict(zip(got.column("node").to_pylist(), got.column("label").to_pylist(), strict=True))
    assert label == {x: min(ids[k // 80 * 80:k // 80 * 80 + 80]) for k, x in enumerate(ids[:400])}


def test_one_of_each_group_stays(spark):
    rows = [r for r in corpus(4, groups=10) if r[0] is not None]
    docs = spark.createDataFrame(rows, "doc_id long, text string").dropDuplicates(["doc_id"])
    kept = j.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in brute(rows)})


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert j.join_documents(docs).count() == 0 and j.keep_one(docs).count() == 0


def test_matches_all_pairs_on_the_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(tuple(r) for r in j.op6_ngram_jaccard_join(spark, "/root/testdata/sf0.001").collect()) == sorted(want)


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(200, 260)] + [(300, 300)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert {got[k] for k in range(100, 161)} == {100} and {got[k] for k in range(200, 260)} == {7}


def test_components_of_random_edges_in_chunks(spark, monkeypatch):
    import tripflow.llm.components as c
    rng = random.Random(8)
    edges = [(rng.randrange(-400, 400), rng.randrange(-400, 400)) for _ in range(330)]
    label = {x: x for e in edges for x in e}
    for _ in range(len(label)):
        for x, y in edges:
            label[x] = label[y] = min(label[x], label[y])
    df = spark.createDataFrame(edges * 2, "a long, b long")
    assert dict(tuple(r) for r in components(df).collect()) == label
    node, root = c._contract(*(np.array(x) for x in zip(*edges)))
    assert dict(zip(node.tolist(), root.tolist())) == label
    assert components(df.limit(0)).count() == 0
