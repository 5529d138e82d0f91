from collections import Counter

from pyspark.sql import functions as F

from tripflow.llm import quality_rules as q

LONG = " ".join(f"w{k}" for k in range(200))


def brute(text):
    w = (text or "").encode().split()
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    seen = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {p for i in range(len(w) - 7) if seen[tuple(w[i:i + 8])] > 1 for p in range(i, i + 8)}
    return (len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(covered))


def rows(spark):
    texts = [None, "", " \n ", "a b", LONG, LONG + "\n" + LONG, "x " * 30, "é# *日 |\n\nsame\nsame\n same\nsame", (LONG + " ") * 40,
             "a b c d e f g h a b c d e f g h i"]
    return spark.createDataFrame([(k, t, "s") for k, t in enumerate(texts)] + [(3, "a b", None)],
                                 "doc_id long, text string, source string"), texts


def test_counts_match_brute_force(spark):
    docs, texts = rows(spark)
    got = {r.doc_id: r for r in q.judge(docs.withColumn("n_words", F.lit("clash"))).collect()}
    assert len(got) == len(texts) and q.judge(docs).count() == len(texts) + 1
    for k, t in enumerate(texts):
        assert tuple(got[k][c] for c in q.COUNTS.names) == brute(t), k
        n, repeated = brute(t)[0], brute(t)[4]
        assert got[k].base_failed == (n < 20 or 100 * repeated > 30 * n)


def test_hosts_with_many_failures_are_rejected_with_their_good_documents(spark):
    bad = [(k, "short", "spam.example") for k in range(60)] + [(60, LONG, "spam.example")]
    good = [(100 + k, LONG, "fine.example") for k in range(300)] + [(500, "short", "fine.example")]
    few = [(600, "short", "new.example"), (601, LONG, None)]
    docs = spark.createDataFrame(bad + good + few, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in q.judge(docs).collect()}
    assert got[60].host_failed and not got[60].kept
    assert got[100].kept and not got[500].kept and not got[500].host_failed
    assert got[601].kept and not got[601].host_failed
    kept = {r.doc_id for r in q.keep_good(docs).collect()}
    assert kept == {k for k, r in got.items() if r.kept}


def test_one_failure_of_one_document_is_shrunk(spark):
    failed = [(f"h{k}", k % 10 == 0) for k in range(100) for _ in range(50)] + [("new", True)]
    judged = spark.createDataFrame(failed, "host string, base_failed boolean")
    got = {r.host: r for r in q.host_verdicts(judged).collect()}
    assert got["new"].shrunk_rate < 1 and got["h0"].host_failed and not got["h1"].host_failed


def test_no_rows(spark):
    docs, _ = rows(spark)
    assert q.judge(docs.limit(0)).count() == 0 and q.keep_good(docs.limit(0)).columns == docs.columns
