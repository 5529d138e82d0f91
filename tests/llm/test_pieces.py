import random

import pytest
import sentencepiece
from pyspark.sql import functions as F

from tripflow.llm import pieces as p

ODD = ["", " ", "  a  b\n\tc ", "日本語 テスト 🤗🤗", "x" * 300, "1234 5.6e7", "é̀ñ ß", "nul\x00 zwsp\u200b", "Hello, world!", "<s> </s> <0x41>"]


@pytest.fixture(scope="module")
def model():
    return p.model_bytes()


def test_ids_are_the_librarys_and_decode_to_the_text(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(10_000 + k, t) for k, t in enumerate([*ODD, None, ODD[2]])], docs.schema)) \
        .withColumn("ids", F.lit("clash"))
    text = {r.doc_id: r.text for r in docs.collect()}
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    got = p.encode_documents(docs, model).collect()
    assert len(got) == len(text)
    for r in got:
        t = text[r.doc_id]
        if t is None:
            assert r.ids is None and r.n_ids is None and r.same is None
        else:
            assert r.ids == sp.encode(t), t
            assert r.same and r.n_ids == len(r.ids)
    assert p.encode_documents(docs.limit(0), model).count() == 0


def best_sum(word, vocabulary):
    if not word:
        return 0.0
    found = [best_sum(word[:-k], vocabulary) + vocabulary[word[-k:]] for k in range(1, len(word) + 1) if word[-k:] in vocabulary]
    return max(found, default=-1e9)


def test_unigram_scores_are_the_best_of_all_segmentations():
    rng = random.Random(5)
    words = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(150)}
    vocabulary = {c: -rng.uniform(3, 6) for c in "abc"} | {w: -rng.uniform(2, 9) for w in list(words)[:40] if len(w) > 1}
    names = ["<unk>", *vocabulary]
    v = p.Pieces(names, [0.0, *vocabulary.values()], "unigram")
    for w, ids in v.encode_words(words).items():
        assert "".join(names[k] for k in ids) == w
        assert abs(sum(vocabulary[names[k]] for k in ids) - best_sum(w, vocabulary)) < 1e-9
    assert v.encode_words(["azb"])["azb"][1] == 0


def test_prefixes_are_scored_once(model):
    v = p.load(model)
    calls = []
    plain = v.last_piece
    v.last_piece = lambda word, end, state: calls.append(word[:end]) or plain(word, end, state)
    v.encode_words(["▁under", "▁understand", "▁understands", "▁undo"])
    assert len(calls) == len(set(calls)) == len("▁understands") + 1


def test_batches_change_nothing(model):
    v = p.load(model)
    texts = [f"word{k} and more {k * k}" for k in range(300)] + [None, ""]
    want = [None if x is None else list(x) for x in p.encode_texts(texts, v)]
    one = [x for t in texts for x in p.encode_texts([t], v)]
    assert [None if x is None else list(x) for x in one] == want
    assert [v.decode(x) for x in want[:300]] == texts[:300] and want[300:] == [None, []]
