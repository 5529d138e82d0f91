import numpy as np
import pyarrow as pa

from tripflow.llm import language as g
from tripflow.llm.text import blocks

EN = "the quick brown fox jumps over the lazy dog and then it runs away from them all day long"
DE = "der schnelle braune fuchs springt über den faulen hund und läuft dann vor ihnen allen weg"
RU = "быстрая коричневая лиса прыгает через ленивую собаку и потом убегает от них весь день"


def plain_viterbi(score):
    v, back = score[0].astype(float), []
    for s in score[1:]:
        best = v.argmax()
        stay = v >= v.max() - g.SWITCH
        back.append(np.where(stay, np.arange(len(v)), best))
        v = np.maximum(v, v.max() - g.SWITCH) + s
    out = [int(v.argmax())]
    for b in back[::-1]:
        out.append(int(b[out[-1]]))
    return out[::-1]


def total(score, path):
    return sum(s[p] for s, p in zip(score, path, strict=True)) - g.SWITCH * sum(a != b for a, b in zip(path, path[1:], strict=False))


def test_block_viterbi_is_as_good_as_a_plain_one():
    rng = np.random.default_rng(1)
    sizes = [0, 1, 5, g.STEP, g.STEP + 1, 3 * g.STEP, 0, 500]
    first = np.concatenate([[0], np.cumsum(sizes)])
    score = rng.normal(0, 9, (first[-1], 4)).astype(np.float32)
    got = g.viterbi(score, first)
    for a, z in zip(first[:-1], first[1:], strict=True):
        if z > a:
            assert abs(total(score[a:z], got[a:z]) - total(score[a:z], plain_viterbi(score[a:z]))) < 0.05


def model(spark):
    rows = [(k, t, n) for k, (t, n) in enumerate([(EN, "en"), (DE, "de"), (RU, "ru")] * 5)]
    return g.fit(spark.createDataFrame([*rows, (99, EN, None), (98, None, "xx")], "doc_id long, text string, lang string"))


def test_spans_and_documents(spark):
    m = model(spark)
    assert m.languages == ["de", "en", "ru"]
    mixed = f"{EN} {EN} 123 {RU} {RU} {RU}"
    docs = spark.createDataFrame([(0, EN, 1), (1, DE, 1), (2, RU, 1), (3, mixed, 1), (4, None, 1), (5, "", 1), (6, "12 -- !", 1),
                                  (7, (DE + " ") * 500, 1), (7, (DE + " ") * 500, 1), (None, EN, 1)],
                                 "doc_id long, text string, lang_pred int")
    got = {r.doc_id: r.p for r in docs.select("doc_id", g.predict(docs, m).alias("p")).collect()}
    assert [got[k].lang_pred for k in (0, 1, 2, 3, 4, 5, 6, 7, None)] == ["en", "de", "ru", "ru", "und", "und", "und", "de", "en"]
    assert got[4].score == got[6].score == 0 and got[3].n_spans == 2 and 0.5 < got[3].score < 0.8 and got[7].score == 1
    spans = {r.doc_id: r.spans for r in g.label_spans(docs, m).collect()}
    assert [(s.first_word, s.lang) for s in spans[3]] == [(0, "en"), (2 * len(EN.split()) + 1, "ru")]
    assert spans[4] == [] and spans[6] == []
    kept = g.keep_identified(docs, m)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {0, 1, 2, 3, 7, None}


def test_scripts_rule_languages_out(spark):
    m = model(spark)
    b = next(blocks(pa.array(["лиса fox"])))
    w = g.words_of(b)
    assert [g.SCRIPTS[k] for k in w.script] == ["cyrillic", "latin"]
    assert m.allowed[w.script].tolist() == [[False, False, True], [True, True, False]]


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, EN, None)], "doc_id long, text string, lang string")
    m = g.fit(docs)
    assert docs.select(g.predict(docs, m).alias("p")).first().p.lang_pred == "und"
    assert docs.limit(0).select(g.predict(docs, m).alias("p")).count() == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = g.op4_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 100 and sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)


def test_working_arrays_stay_small():
    """A batch of 6 MB is counted in blocks: what a worker holds at once is a
    few machine words per byte of a block, not of the batch."""
    import tracemalloc

    text = "Some words of a text with a few more words in it. " * 40
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 3000), pa.array([text] * 3000)], names=["lang", "text"])
    whole = {(r["lang"], r["kind"], r["slot"]): r["n"] for b in g._count(iter([batch])) for r in b.to_pylist()}
    tracemalloc.start()
    list(g._count(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(n for (_, kind, _), n in whole.items() if kind == 1) == 3000 * sum(c.isalpha() for c in text)
    assert peak < 90_000_000
