import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tripflow.llm import mixing as m


def test_shares_and_deviation_of_a_period():
    rng = random.Random(1)
    for _ in range(200):
        n = rng.randint(1, 9)
        period = rng.randint(n, 70)
        share = m.shares([rng.random() + 0.01 for _ in range(n)], period)
        assert sum(share) == period and min(share) >= 1
        done = Counter()
        for t, s in enumerate(m.edf_slots(share, period)):
            done[s] += 1
            assert all(abs(done[k] - (t + 1) * share[k] / period) < 1 for k in range(n))
        assert [done[k] for k in range(n)] == share


def test_every_block_has_one_slot():
    rng = random.Random(2)
    for _ in range(200):
        blocks = [rng.randint(0, 60) for _ in range(rng.randint(1, 7))]
        slots = {}
        for s, phases in enumerate(m.plan(blocks, [rng.random() + 0.05 for _ in blocks], rng.choice([7, 20, 50]))):
            nxt = 0
            for first, last, period, own in phases:
                assert first == nxt
                nxt = last + 1
                for b in range(first, last + 1):
                    slots.setdefault(own[(b - first) % len(own)] + (b - first) // len(own) * period, []).append((s, b))
            assert nxt == blocks[s]
        assert sorted(slots) == list(range(sum(blocks))) and all(len(x) == 1 for x in slots.values())


def test_documents(spark, monkeypatch):
    monkeypatch.setattr(m, "RANGE", 50)
    rows = [(k, f"t{k}", "hot") for k in range(700)] + [(1000 + k, None, "b") for k in range(300)] + [(2000 + k, "", None) for k in range(50)]
    rows += [(3000, "x", "zero")] * 7 + [(None, "y", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("slot", F.lit(1))
    weights = {"hot": 2.0, "b": 1.0, None: 1.0}
    got = m.mix(docs, weights, block_size=5, period=40).orderBy("_position").collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in got) == sorted((r[0] is not None, r[0] or 0) for r in rows)
    assert len({r._position for r in got}) == len(rows)
    of_slot = defaultdict(set)
    for r in got:
        of_slot[r._slot].add((r.source, r._block))
    assert sorted(of_slot) == list(range(140 + 61 + 10 + 2)) and all(len(x) == 1 for x in of_slot.values())
    order = [next(iter(of_slot[k]))[0] for k in range(len(of_slot))]
    target = {"hot": 0.5, "b": 0.25, None: 0.25}
    done = Counter()
    for t in range(40):                     # no source is used up so early
        done[order[t]] += 1
        assert all(abs(done[s] - (t + 1) * w) < 1 for s, w in target.items())
    assert order[-2:] == ["zero", "zero"]
    mixed = m.in_mixed_order(docs, weights)
    assert mixed.columns == docs.columns and mixed.count() == len(rows)


def test_two_thousand_sources(spark):
    """Sources of one class take turns: each stays within one block of its share, however many there are."""
    rows = [(k, None if k % 2000 == 0 else f"s{k % 2000}") for k in range(2000 * 9)]
    rows += [(100_000 + k, f"t{k % 50}") for k in range(50 * 30)] + [(200_000 + k, "hot") for k in range(6000)]
    rows += [(300_000 + k, "zero") for k in range(7)] + [(None, "hot")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    weights = {r[1]: 1.0 for r in rows} | {f"t{k}": 4.0 for k in range(50)} | {"hot": 1800.0, "zero": 0.0}
    got = m.mix(docs, weights, block_size=3, period=4000).orderBy("_position").collect()
    assert sorted(Counter((r.doc_id, r.source) for r in got).items(), key=str) == sorted(Counter(rows).items(), key=str)
    assert len({r._position for r in got}) == len(rows)
    of_slot = defaultdict(set)
    for r in got:
        of_slot[r._slot].add((r.source, r._block))
    blocks = 2000 * 3 + 50 * 10 + 2001 + 3
    assert sorted(of_slot) == list(range(blocks)) and all(len(x) == 1 for x in of_slot.values())
    order = [next(iter(of_slot[k]))[0] for k in range(blocks)]
    assert order[-3:] == ["zero"] * 3
    slots = defaultdict(list)
    for t, s in enumerate(order[:4000]):    # no source is used up so early
        slots[s].append(t)
    for s, at in slots.items():
        share = weights[s] / 4000
        for done, t in enumerate(at):       # the largest deviations are before and after a source's slots
            assert abs(done - t * share) < 1 and abs(done + 1 - (t + 1) * share) < 1
        assert abs(len(at) - 4000 * share) < 1
    assert len(slots) == 2051
    assert m.mix(docs).count() == m.in_mixed_order(docs).count() == len(rows)


def test_weights_from_the_table(spark):
    """Without weights, blocks to a power below 1: until the small source is used up, it has more than its rows' share."""
    docs = spark.createDataFrame([(k, "big") for k in range(3200)] + [(9000 + k, "small") for k in range(320)],
                                 "doc_id long, source string")
    order = [r.source for r in m.mix(docs, block_size=1, period=1000).orderBy("_slot").collect()]
    share = 320 ** m.POWER / (320 ** m.POWER + 3200 ** m.POWER)
    done = 0
    for t, s in enumerate(order[:1000]):
        done += s == "small"
        assert abs(done - (t + 1) * share) < 2      # one block, and shares are whole slots of a period


def test_order_depends_on_the_rows_only(spark, monkeypatch):
    """More rows of another source, other partitions and other ranges leave a source's order as it is."""
    monkeypatch.setattr(m, "RANGE", 40)
    rows = [(k % 400, f"t{k}", "a") for k in range(500)] + [(5, "same", "a")] * 3
    more = rows + [(k, "x", "b") for k in range(5000)]
    order = lambda r, n: [x.text for x in m.mix(spark.createDataFrame(r, "doc_id long, text string, source string")
                                                .repartition(n)).where("source = 'a'").orderBy("_block", "_position").collect()]
    assert order(rows, 1) == order(more[::-1], 7)


def test_clashing_columns(spark):
    own = ["_row", "_group", "_hash", "_tie", "_id", "_k", "_range", "_number", "_before", "n", "_block", "_slot",
           "_position", "_phases", "_class", "_members", "_turn", "_source", "a.b"]
    docs = spark.createDataFrame([(k, "s") for k in range(40)], "doc_id long, source string")
    docs = docs.select("*", *[F.lit(k).alias(c) for k, c in enumerate(own)], F.create_map(F.lit(1), F.lit(2)).alias("map"))
    mixed = m.in_mixed_order(docs)
    assert mixed.columns == docs.columns and sorted(mixed.collect()) == sorted(docs.collect())
    got = m.mix(docs)
    assert got.columns == [c for c in docs.columns if c not in m.ADDED] + list(m.ADDED)
    assert sorted(r._position for r in got.collect()) == sorted({r._position for r in got.collect()})
    assert {r._block for r in got.collect()} == {0, 1}


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert m.mix(docs).count() == 0 and m.in_mixed_order(docs).count() == 0


def test_small_tables_start_no_python_worker(spark, monkeypatch):
    docs = spark.range(300).selectExpr("id AS doc_id", "concat('s', id % 7) AS source")
    made, create = [], type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda *a, **k: made.append(create(*a, **k)) or made[-1])
    assert m.mix(docs, {"s1": 2.0, "s3": 1.0}).count() == 300 and len(made) == 3
    m.mix(docs.limit(0), {}).collect()
    assert len(made) == 6
    for df in made:
        assert "PythonRDD" not in df._jdf.queryExecution().toRdd().toDebugString()
