"""Toxicity: gradient-boosted trees over dense features, calibrated by
isotonic regression.

The features of a text are densities of lexicon words (a fixed list and stems
learned from the training rows), how close they stand to words for the second
person, and rates of capitals, punctuation and obfuscation (letters replaced
or separated within a word; such words are read without their disguise).

The labelled rows used for fitting are a bounded sample (``MAX_TRAIN_DOCS``),
split by id hash into three: one part gives the stems, one grows the trees,
one calibrates. Features are computed for every row, over the whole text.
Neither features nor model see labels, lang, source or doc_id.

A stem is a word's first 4 to 7 bytes. It is learned if it is ``MIN_LIFT``
times as frequent in toxic texts and at least ``MIN_SHARE`` of them have it;
near copies count once (one text for each smallest shingle hash).

Defined cases: a null or empty text has zero features and is scored from
them; a null id is neither training nor held out; a repeated row is scored
like any other; without labels of both classes every score is the share of
label 1 among the sample (0 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.jaccard import shingles
from tripflow.llm.text import Block, blocks, checkpoint, crc_mod, label_sample, span_hash, table, text_udf

MAX_TRAIN_DOCS = 20_000
MAX_STEMS = 400             # learned stems that are kept
MIN_LIFT, MIN_SHARE, MIN_DOCS = 20.0, 0.02, 8
TREES, DEPTH, RATE = 20, 4, 0.2
THRESHOLD = 0.7
FOLDS, HELD_OUT = 3, 1
STEM_BYTES = (4, 5, 6, 7)
NEAR, WINDOW = 5, 20        # words

# fixed values: insults, and words for the second person
INSULTS = """idiot moron stupid dumb fool trash garbage scum pathetic loser clown worthless disgusting imbecile
jerk filth vermin coward liar freak ugly hate idiota estupido basura imbecil idiote stupide ordure dumm abschaum
trottel""".split()
SECOND_PERSON = """you your yours yourself u ur du dich dir dein deine ihr euch vous votre vos toi usted ustedes
tienes eres""".split()

FEATURES = ("stem_density", "insult_density", "log_hits", "distinct_stems", "densest_window", "near_second_person",
            "second_person", "capitals", "exclamations", "punctuation", "symbols", "obfuscated_hits", "mixed_words",
            "single_letters", "log_words")
SCHEMA = pa.struct([(f, pa.float64()) for f in FEATURES])

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[128:] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[list(b".,;:?'\"()-")] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>@^~_=+")] = True
# fixed values: letters that digits and signs stand for
DISGUISE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
_REVEAL = np.zeros(256, np.uint8)
for _a, _b in DISGUISE.items():
    _REVEAL[ord(_a)] = ord(_b)
_REVEAL[_LETTER] = np.arange(256, dtype=np.uint8)[_LETTER]


def _plain_block(words: list[str]) -> Block:
    data = [w.encode() for w in words]
    return Block(0, len(data), np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))


def _hashes(words: list[str]) -> np.ndarray:
    b = _plain_block(words)
    return np.unique(span_hash(b.prefix_hash(), b.off[:-1], b.off[1:]))


def _among(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(known, x), len(known) - 1)
    return known[at] == x


def _stem_hits(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which words begin with a known stem, and the hash of the shortest such."""
    hit, which = np.zeros(len(start), bool), np.zeros(len(start), np.uint64)
    for n in STEM_BYTES:
        at = np.flatnonzero(~hit & (end - start >= n))
        h = span_hash(prefix, start[at], start[at] + n)
        ok = _among(h, known)
        hit[at[ok]], which[at[ok]] = True, h[ok]
    return hit, which


def _reveal(b: Block) -> tuple[Block, np.ndarray, np.ndarray, np.ndarray]:
    """Words with other characters between their letters, without their
    disguise: a block of these letters, the words' starts, ends and rows."""
    start, end, first = b.words()
    row = np.repeat(np.arange(b.rows), np.diff(first))
    letter = _LETTER[b.buf]
    where = np.flatnonzero(letter)
    lo, hi = np.searchsorted(where, start), np.searchsorted(where, end)
    has = hi > lo
    begin, stop = where[lo[has]], where[hi[has] - 1] + 1
    begin = begin - ((begin > start[has]) & (_REVEAL[b.buf[np.maximum(begin - 1, 0)]] > 0))
    mixed = (hi - lo)[has] < stop - begin
    begin, stop, row = begin[mixed], stop[mixed], row[has][mixed]
    inside = np.zeros(len(b.buf) + 1, np.int64)
    np.add.at(inside, begin, 1)
    np.subtract.at(inside, stop, 1)
    keep = (np.cumsum(inside[:-1]) > 0) & (_REVEAL[b.buf] > 0)
    place = np.concatenate([[0], np.cumsum(keep)])
    out = Block(0, 1, _REVEAL[b.buf[keep]], np.array([0, int(place[-1])]))
    return out, place[begin], place[stop], row


def features_of(b: Block, stems: np.ndarray, insults: np.ndarray, second: np.ndarray) -> dict:
    low = b.lower()
    start, end, first = low.runs(_LETTER[low.buf])
    prefix = low.prefix_hash()
    row = np.repeat(np.arange(b.rows), np.diff(first))
    n = np.diff(first).astype(float)
    per_word = 1 / np.maximum(n, 1)
    size = np.maximum(np.diff(b.off), 1)
    per_row = lambda flags, of: np.bincount(of[flags], minlength=b.rows)[:b.rows].astype(float)
    def count(table):
        sums = np.concatenate([[0], np.cumsum(table[b.buf])])
        return (sums[b.off[1:]] - sums[b.off[:-1]]).astype(float)
    whole = span_hash(prefix, start, end)
    stem, which = _stem_hits(prefix, start, end, stems)
    insult, you = _among(whole, insults), _among(whole, second)
    hit = stem | insult
    # distinct stems of a row
    pairs = np.unique(np.stack([row[stem].astype(np.uint64), which[stem]]), axis=1)[0] if stem.any() else np.zeros(0, np.uint64)
    # hits in the window from each hit, and second person around it
    sums, people = np.concatenate([[0], np.cumsum(hit)]), np.concatenate([[0], np.cumsum(you)])
    at = np.flatnonzero(hit)
    r = row[at]
    dense = np.zeros(b.rows)
    np.maximum.at(dense, r, sums[np.minimum(at + WINDOW, first[1:][r])] - sums[at])
    near = people[np.minimum(at + NEAR + 1, first[1:][r])] > people[np.maximum(at - NEAR, first[:-1][r])]
    # disguised words
    shown, s, e, shown_row = _reveal(low)
    shown_prefix = shown.prefix_hash()
    caught = _stem_hits(shown_prefix, s, e, stems)[0] | _among(span_hash(shown_prefix, s, e), insults)
    hits = per_row(hit, row)
    mark = np.zeros(256, bool)
    mark[ord("!")] = True
    letters = count(_LETTER) + count(_UPPER)
    out = (per_row(stem, row) * per_word, per_row(insult, row) * per_word, np.log1p(hits),
           np.bincount(pairs.astype(np.int64), minlength=b.rows).astype(float), dense, np.bincount(r[near], minlength=b.rows) * per_word,
           per_row(you, row) * per_word, count(_UPPER) / np.maximum(letters, 1), count(mark) / size,
           count(_PUNCTUATION) / size, count(_SYMBOL) / size, per_row(caught, shown_row),
           np.bincount(shown_row, minlength=b.rows) * per_word, per_row(end - start == 1, row) * per_word, np.log1p(n))
    return dict(zip(FEATURES, out, strict=True))


def _stem_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(stem, toxic, clean): texts with each stem, per batch."""
    for batch in batches:
        label = np.asarray(batch.column(1)) == 1
        stems, toxic = [], []
        for b in blocks(batch.column(0)):
            low = b.lower()
            start, end, first = low.runs(_LETTER[low.buf])
            prefix, row = low.prefix_hash(), np.repeat(np.arange(b.rows), np.diff(first))
            h, r = [], []
            for n in STEM_BYTES:
                at = np.flatnonzero(end - start >= n)
                h.append(span_hash(prefix, start[at], start[at] + n))
                r.append(row[at])
            h, r = np.concatenate(h), np.concatenate(r)
            order = np.lexsort((h, r))
            h, r = h[order], r[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
            stems.append(h[new])
            toxic.append(label[b.lo:b.hi][r[new]])
        if stems:
            found, of = np.unique(np.concatenate(stems), return_inverse=True)
            t = np.concatenate(toxic)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), pa.array(np.bincount(of, t, len(found)).astype(np.int64)),
                 pa.array(np.bincount(of, ~t, len(found)).astype(np.int64))], names=["stem", "toxic", "clean"])


def _text_key(column: pa.Array) -> pa.Array:
    """The smallest shingle hash of each text: near copies mostly share it."""
    out = []
    for b in blocks(column):
        _, h, first = shingles(b)
        least = np.zeros(b.rows, np.uint64)
        full = np.diff(first) > 0
        if full.any():
            least[full] = np.minimum.reduceat(h, first[:-1][full])
        out.append(least.view(np.int64))
    return pa.array(np.concatenate(out) if out else np.zeros(0, np.int64))


_text_key.__annotations__ = {"column": pa.Array, "return": pa.Array}


def learn_stems(rows: DataFrame) -> np.ndarray:
    """Hashes of at most ``MAX_STEMS`` stems, from ``rows`` (text, label)."""
    key = F.arrow_udf(_text_key, "long")(F.col("text"))
    once = checkpoint(rows.where("text IS NOT NULL").withColumn("_key", key).dropDuplicates(["_key", "label"])
                      .select("text", "label"))
    total = {r.label: r.n for r in once.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = total.get(1, 0), total.get(0, 0)
    if not toxic or not clean:
        return np.zeros(0, np.uint64)
    counts = (once.mapInArrow(_stem_counts, "stem long, toxic long, clean long")
              .groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    lift = ((F.col("toxic") + 0.5) / (toxic + 1)) / ((F.col("clean") + 0.5) / (clean + 1))
    best = (counts.where((F.col("toxic") >= max(MIN_DOCS, MIN_SHARE * toxic)) & (lift >= MIN_LIFT))
            .orderBy(F.desc("toxic"), "stem").limit(MAX_STEMS).select("stem").toArrow())
    return np.sort(np.asarray(best.column(0)).astype(np.int64).view(np.uint64))


def features(docs: DataFrame, stems: np.ndarray, text_col: str = "text") -> F.Column:
    """Struct column of FEATURES."""
    shared = docs.sparkSession.sparkContext.broadcast((stems, _hashes(INSULTS), _hashes(SECOND_PERSON)))
    return text_udf(lambda b: features_of(b, *shared.value), SCHEMA)(F.col(text_col))


def score(docs: DataFrame, sample: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, FEATURES) for each row of ``docs``; ``sample``:
    (doc_id, label) of bounded size."""
    sample = checkpoint(sample.select("doc_id", "label", F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(20)).alias("part")))
    found = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "doc_id")
    stems = learn_stems(found.where("part < 9").select("text", "label"))
    rows = checkpoint(docs.select(F.col(id_col).alias("doc_id"), features(docs, stems, text_col).alias("f"))
                      .select("doc_id", "f.*"))
    pack = VectorAssembler(inputCols=list(FEATURES), outputCol="x")
    known = checkpoint(pack.transform(rows.join(F.broadcast(sample.where("part >= 9")), "doc_id"))
                       .select("x", F.col("label").cast("double").alias("label"), "part").limit(MAX_TRAIN_DOCS).coalesce(4))
    share = sample.agg(F.avg("label")).first()[0] or 0.0
    grow, tune = known.where("part < 16"), known.where("part >= 16")
    if any(part.select("label").distinct().count() < 2 for part in (grow, tune)):
        return rows.withColumn("score", F.lit(float(share)))
    trees = GBTClassifier(featuresCol="x", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=RATE, seed=7,
                          maxBins=64).fit(grow)
    chance = vector_to_array(F.col("probability"))[1]
    level = IsotonicRegression(featuresCol="chance", labelCol="label", predictionCol="score").fit(
        trees.transform(tune).select("label", chance.alias("chance")))
    scored = level.transform(trees.transform(pack.transform(rows)).withColumn("chance", chance))
    return scored.select("doc_id", F.least(F.lit(1.0), F.greatest(F.lit(0.0), "score")).alias("score"), *FEATURES)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sample = label_sample(table(spark, sf_dir, "labels"), "toxic", FOLDS, HELD_OUT, MAX_TRAIN_DOCS)
    held_out = F.coalesce(crc_mod("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return score(docs, sample).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "log_hits", "obfuscated_hits")
