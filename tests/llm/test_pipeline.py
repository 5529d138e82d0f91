from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from tripflow.llm import jaccard, language, quality_rules

SF = "/root/testdata/sf0.001"


def test_registered():
    names = __spark_entry__.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 14)} and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = lambda d: sorted(r.doc_id for r in d.select("doc_id").collect())
    stages = [f for _, f in corpus_pipeline.STAGES]
    one = stages[0](spark, docs, SF)
    assert one.columns == docs.columns and ids(one) == ids(quality_rules.judge(docs).where("kept"))
    two = stages[1](spark, one, SF)
    assert two.columns == docs.columns and ids(two) == ids(one)     # no text here is without a language
    model = language.fit(language.training_rows(one))
    assert ids(two) == ids(one.withColumn("p", language.predict(one, model)).where("p.lang_pred <> 'und' AND p.score >= 0.5"))
    three = stages[2](spark, two, SF)
    assert three.columns == docs.columns and ids(three) == ids(jaccard.join_documents(two).where("doc_id = component_id"))
    four = stages[3](spark, three, SF)
    assert four.columns == docs.columns and ids(four) == ids(three)
    five = stages[4](spark, four, SF)
    assert ids(five) == ids(three) and five.where(~F.col("same")).count() == 0
    assert ids(corpus_pipeline.run(spark, SF)) == ids(three)


def test_no_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_odd_rows(spark):
    """Nulls, an empty and a very long text, repeated rows and clashing names through every stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = docs.where("doc_id = 1").first().text
    base = docs.select(*docs.columns, *[F.lit(k).alias(c) for k, c in enumerate(
        ["_bad_host", "_dropped", "_block", "_row", "position", "_position", "ids", "n"])])
    row = lambda **kw: base.where("doc_id = 1").select(*[F.lit(kw[c]).cast(base.schema[c].dataType).alias(c) if c in kw
                                                        else F.col(c) for c in base.columns])
    odd = [row(doc_id=900_001, text=None), row(doc_id=900_002, text=""), row(doc_id=None), row(doc_id=900_003, source=None),
           row(doc_id=900_004, lang=None, n_chars=None), row(doc_id=900_005, text=" ".join(f"w{k} the" for k in range(100_000)))]
    for d in odd:
        base = base.union(d)
    base = base.union(base.where("doc_id in (2, 3)"))
    rows = base
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        last, rows = rows, stage(spark, rows, SF)
        if k < 4:
            assert rows.columns == base.columns, name
        if name == "quality_rules":
            assert not {900_001, 900_002} & {r.doc_id for r in rows.select("doc_id").collect()}
        if name == "near_duplicates":       # copies of document 1 go, rows under a null id and repeated rows stay
            kept = [r.doc_id for r in rows.select("doc_id").collect()]
            assert 1 in kept and not {900_003, 900_004} & set(kept) and None in kept and kept.count(2) == kept.count(3) == 2
    got = rows.collect()
    assert len(got) == last.count() and len({r.position for r in got}) == len(got) and all(r.same for r in got)
    order = {r.doc_id: k for k, r in enumerate(last.select("doc_id").collect()) if r.doc_id not in (2, 3)}
    places = sorted((r.position, order[r.doc_id]) for r in got if r.doc_id in order)
    assert [k for _, k in places] == sorted(order.values()) and text is not None
