"""Language ID: script ranges narrow the candidates, then Viterbi over
per-word scores with a switching penalty labels spans of mixed text.

Training counts the letter trigrams (hashed to ``SLOTS`` slots) and the
scripts of every training document per language. The model is one table of
log probabilities, ``SLOTS`` x languages, whatever the size of the corpus.

A word's score for a language is the sum of its trigrams' log probabilities;
languages of which the training text hardly ever uses the word's script are
ruled out for that word. Along the words of a text, changing the language
costs ``SWITCH`` nats. Runs of words with one label are the spans; the
language with the most letters in its spans is the document's, its share of
all letters the score.

Defined cases: a null text, or one without letters, is ``und`` with score 0;
ties go to the language that sorts first; a null id counts as neither
training nor held out; rows with a null language are only predicted; without
any training row every text is ``und``. A word in a script that no language
uses keeps all candidates.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.text import Block, blocks, by_block, checkpoint, crc_mod, filter_rows, table, text_udf

SLOTS = 1 << 16
SWITCH = 12.0               # nats that a change of language costs
SMOOTH = 0.5                # added to each slot's count
MIN_SCRIPT_SHARE = 0.001    # of a language's letters, below which it isn't written in a script
STEP = 48                   # words of a Viterbi block
MAX_LANGUAGES = 1000        # bound of the model kept by the driver
FOLDS, HELD_OUT = 5, 0

# fixed values: scripts by first code point of their ranges (Unicode blocks)
SCRIPT_RANGES = [
    (0x0041, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"),
    (0x0980, "bengali"), (0x0A00, "indic"), (0x0E00, "thai"), (0x0E80, "lao"),
    (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"),
    (0x1200, "ethiopic"), (0x1380, "other"), (0x1E00, "latin"), (0x1F00, "greek"),
    (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3130, "hangul"),
    (0x3190, "other"), (0x31F0, "kana"), (0x3200, "other"), (0x3400, "han"),
    (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"),
    (0xFB00, "latin"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"),
    (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0x10000, "other"),
    (0x20000, "han"), (0x32000, "other"),
]
SCRIPTS = sorted({name for _, name in SCRIPT_RANGES})

PREDICTION = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("n_spans", pa.int64())])
SPANS = pa.struct([("spans", pa.list_(pa.struct([("first_word", pa.int64()), ("n_words", pa.int64()),
                                                 ("lang", pa.string())])))])

_points: dict[str, np.ndarray] = {}


def _point_tables() -> dict[str, np.ndarray]:
    """By code point: letter or not, lower-case form, script number."""
    if not _points:
        n = 0x110000
        letter, lower = np.zeros(n, bool), np.arange(n, dtype=np.uint32)
        for c in range(0x33480):
            if c < 0xD800 or c > 0xDFFF:
                if unicodedata.category(chr(c))[0] == "L":
                    letter[c] = True
                    low = chr(c).lower()
                    if len(low) == 1:
                        lower[c] = ord(low)
        first = np.array([a for a, _ in SCRIPT_RANGES])
        number = np.array([SCRIPTS.index("other")] + [SCRIPTS.index(s) for _, s in SCRIPT_RANGES], np.int16)
        script = number[np.searchsorted(first, np.arange(n), side="right")]
        _points.update(letter=letter, lower=lower, script=script)
    return _points


@dataclass
class Words:
    """The words with a letter of a block: row, position among all words of
    the row, number of letters, script; their trigrams: word and slot."""

    row: np.ndarray
    place: np.ndarray
    letters: np.ndarray
    script: np.ndarray
    gram_word: np.ndarray
    gram_slot: np.ndarray


def words_of(b: Block) -> Words:
    """Letter trigrams see a word's lower-cased letters, all other characters
    of the word as one mark, and a mark on either side."""
    t = _point_tables()
    start, end, first = b.words()
    lead = (b.buf & 0xC0) != 0x80
    index = np.cumsum(lead) - 1                     # code point number of each byte
    points = np.frombuffer(b.buf.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    if len(points) != int(lead.sum()):              # not UTF-8: read it byte by byte
        points, index = b.buf.astype(np.uint32), np.arange(len(b.buf))
    cs = index[start] if len(start) else start
    ce = index[end - 1] + 1 if len(end) else end
    letter = t["letter"][points]
    sums = np.concatenate([[0], np.cumsum(letter)])
    n_letters = sums[ce] - sums[cs]
    has = n_letters > 0
    row = np.repeat(np.arange(b.rows), np.diff(first))
    place = np.arange(len(start)) - first[:-1][row]
    # the script of a word is that of its first letter
    where = np.flatnonzero(letter)
    script = t["script"][points[where[np.searchsorted(where, cs[has])]]] if has.any() else np.zeros(0, np.int16)
    # trigrams, one for each code point of the words with a letter
    size = (ce - cs)[has]
    word = np.repeat(np.arange(len(size)), size)
    at = np.arange(int(size.sum())) + np.repeat(cs[has] - (np.cumsum(size) - size), size)
    value = np.where(letter, t["lower"][points], np.uint32(1)).astype(np.uint64)
    mid = value[at]
    left, right = np.ones(len(at), np.uint64), np.ones(len(at), np.uint64)
    inner = word[1:] == word[:-1]
    left[1:][inner] = mid[:-1][inner]
    right[:-1][inner] = mid[1:][inner]
    h = (left * np.uint64(0x9E3779B1) + mid) * np.uint64(0x85EBCA6B) + right
    h = (h ^ (h >> np.uint64(15))) * np.uint64(0xC2B2AE35)
    slot = ((h >> np.uint64(13)) & np.uint64(SLOTS - 1)).astype(np.int64)
    return Words(row[has], place[has], n_letters[has], script, word, slot)


@dataclass
class Model:
    languages: list[str]
    logp: np.ndarray        # SLOTS x languages
    allowed: np.ndarray     # scripts x languages


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: (lang, kind, slot, n) with kind 0 for trigrams, 1 for letters by script."""
    total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        codes = batch.column(0).dictionary_encode()
        names, of = codes.dictionary.to_pylist(), np.asarray(codes.indices)
        for b in blocks(batch.column(1)):
            w, lang = words_of(b), of[b.lo:b.hi]
            for k in np.unique(lang):
                grams, scripts = total.setdefault(names[k], (np.zeros(SLOTS, np.int64), np.zeros(len(SCRIPTS), np.int64)))
                mine = lang[w.row] == k
                grams += np.bincount(w.gram_slot[mine[w.gram_word]], minlength=SLOTS)
                scripts += np.bincount(w.script[mine], w.letters[mine], len(SCRIPTS)).astype(np.int64)
    for name, pair in total.items():
        for kind, counts in enumerate(pair):
            slot = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(slot), pa.string()), pa.array(np.full(len(slot), kind, np.int32)),
                 pa.array(slot.astype(np.int32)), pa.array(counts[slot])], names=["lang", "kind", "slot", "n"])


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Count over all rows of ``docs`` with a language. What reaches the driver
    is at most (SLOTS + scripts) numbers a language, ``MAX_LANGUAGES`` at most."""
    counts = (docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
              .select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
              .mapInArrow(_count, "lang string, kind int, slot int, n long")
              .groupBy("lang", "kind", "slot").agg(F.sum("n").alias("n")))
    counts = checkpoint(counts)
    languages = sorted(r.lang for r in counts.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    grams = np.zeros((SLOTS, len(languages)))
    scripts = np.zeros((len(SCRIPTS), len(languages)))
    for k, lang in enumerate(languages):
        got = counts.where(F.col("lang") == lang).select("kind", "slot", "n").toArrow()
        kind, slot, n = (np.asarray(got.column(c)) for c in ("kind", "slot", "n"))
        grams[slot[kind == 0], k] = n[kind == 0]
        scripts[slot[kind == 1], k] = n[kind == 1]
    grams += SMOOTH
    allowed = scripts >= MIN_SCRIPT_SHARE * np.maximum(scripts.sum(0), 1)
    allowed[~allowed.any(1)] = True
    return Model(languages, np.log(grams / grams.sum(0)).astype(np.float32), allowed)


def _advance(v: np.ndarray, score: np.ndarray) -> np.ndarray:
    """One word further: stay, or come from the best state at the cost of a switch."""
    return np.maximum(v, v.max(-1, keepdims=True) - SWITCH) + score


def viterbi(score: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The best label of each word. ``score``: words x languages; ``first``:
    each row's first word (rows + 1 values).

    Rows are cut into blocks of STEP words. A block's best scores from each
    entry label to each exit label are found for all blocks at once and
    chained per row; then the blocks are traced back, again all at once. The
    result is that of a plain Viterbi over each row's words.
    """
    n, k = score.shape
    length = np.diff(first)
    per_row = -(-length // STEP)
    row = np.repeat(np.arange(len(length)), per_row)
    block_first = np.concatenate([[0], np.cumsum(per_row)])
    inner = np.arange(len(row)) - block_first[:-1][row]
    at = first[:-1][row] + inner * STEP
    size = np.minimum(STEP, first[1:][row] - at)
    step_scores = np.zeros((STEP, len(row), k), np.float32)     # 0 beyond a block's end
    for t in range(STEP):
        on = t < size
        step_scores[t, on] = score[at[on] + t]
    through = np.full((len(row), k, k), -np.float32(np.inf))
    through[:, np.arange(k), np.arange(k)] = 0
    for t in range(STEP):
        on = t < size
        through[on] = _advance(through[on], step_scores[t, on][:, None, :])
    # what enters each block, then the label in which each block ends
    enter = np.zeros((len(row), k), np.float64)
    leave = np.zeros((len(row), k), np.float64)
    deepest = int(per_row.max()) if len(per_row) else 0
    for d in range(deepest):
        now = block_first[:-1][per_row > d] + d
        if d:
            enter[now] = leave[now - 1]
        leave[now] = (enter[now][:, :, None] + through[now]).max(1)
    choice = np.zeros((STEP, len(row), k), np.int16)            # label before each word's label
    v = enter.copy()
    for t in range(STEP):
        on = t < size
        best = v.argmax(1)
        stay = v >= v.max(1, keepdims=True) - SWITCH
        choice[t] = np.where(stay, np.arange(k), best[:, None])
        v[on] = _advance(v[on], step_scores[t, on])
    # trace back each block from each exit label, to chain the blocks
    back = np.broadcast_to(np.arange(k), (len(row), k)).copy()
    for t in range(STEP - 1, -1, -1):
        on = t < size
        back[on] = np.take_along_axis(choice[t, on], back[on], 1)
    exit_label = np.zeros(len(row), np.int64)
    for d in range(deepest - 1, -1, -1):
        last = block_first[:-1][per_row == d + 1] + d
        exit_label[last] = leave[last].argmax(1)
        inside = block_first[:-1][per_row > d + 1] + d
        exit_label[inside] = back[inside + 1, exit_label[inside + 1]]
    out = np.zeros(n, np.int64)
    label = exit_label
    for t in range(STEP - 1, -1, -1):
        on = t < size
        out[at[on] + t] = label[on]
        label = np.where(on, choice[t, np.arange(len(row)), label], label)
    return out


def label_words(w: Words, rows: int, model: Model) -> np.ndarray:
    k = len(model.languages)
    score = np.empty((len(w.row), k), np.float32)
    edge = np.flatnonzero(np.diff(w.gram_word, prepend=-1))
    for c in range(k):
        score[:, c] = np.add.reduceat(model.logp[:, c][w.gram_slot], edge) if len(edge) else 0
    score[~model.allowed[w.script]] = -np.float32(1e4)
    return viterbi(score, np.searchsorted(w.row, np.arange(rows + 1)))


def predict_block(b: Block, model: Model) -> dict:
    w, k = words_of(b), len(model.languages)
    if not k or not len(w.row):
        return {"lang_pred": ["und"] * b.rows, "score": np.zeros(b.rows), "n_spans": np.zeros(b.rows, np.int64)}
    label = label_words(w, b.rows, model)
    weight = np.bincount(w.row * k + label, w.letters, b.rows * k).reshape(b.rows, k)
    total, best = weight.sum(1), weight.argmax(1)
    names = np.array([*model.languages, "und"], object)
    change = np.ones(len(label), np.int64)
    change[1:] = (label[1:] != label[:-1]) | (w.row[1:] != w.row[:-1])
    return {"lang_pred": names[np.where(total > 0, best, k)],
            "score": np.where(total > 0, weight.max(1) / np.maximum(total, 1), 0.0),
            "n_spans": np.bincount(w.row, change, b.rows).astype(np.int64)}


def span_block(b: Block, model: Model) -> dict:
    w = words_of(b)
    if not len(model.languages) or not len(w.row):
        return {"spans": pa.array([[]] * b.rows, SPANS.field("spans").type)}
    label = label_words(w, b.rows, model)
    change = np.ones(len(label), bool)
    change[1:] = (label[1:] != label[:-1]) | (w.row[1:] != w.row[:-1])
    at = np.flatnonzero(change)
    last = np.append(at[1:], len(label)) - 1
    items = pa.StructArray.from_arrays(
        [pa.array(w.place[at]), pa.array(w.place[last] - w.place[at] + 1),
         pa.array(np.array(model.languages, object)[label[at]], pa.string())],
        names=["first_word", "n_words", "lang"])
    offsets = np.searchsorted(w.row[at], np.arange(b.rows + 1)).astype(np.int32)
    return {"spans": pa.ListArray.from_arrays(pa.array(offsets), items)}


def _with_model(spark: SparkSession, per_block, model: Model, schema: pa.StructType):
    """The model is SLOTS x languages numbers: a broadcast of bounded size."""
    shared = spark.sparkContext.broadcast(model)
    return text_udf(lambda b: per_block(b, shared.value), schema)


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> F.Column:
    """Column struct(lang_pred, score, n_spans) of ``docs``."""
    return _with_model(docs.sparkSession, predict_block, model, PREDICTION)(F.col(text_col))


def label_spans(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): spans are (first_word, n_words, lang) in order; words
    without letters between two of a span's words are in it."""
    spans = _with_model(docs.sparkSession, span_block, model, SPANS)(F.col(text_col))
    return docs.select(F.col(id_col).alias("doc_id"), spans.alias("s")).select("doc_id", "s.spans")


def training_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return docs.where(crc_mod(id_col, FOLDS) != HELD_OUT)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(training_rows(docs))
    held_out = F.coalesce(crc_mod("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return (docs.select("doc_id", held_out.alias("held_out"), predict(docs, model).alias("p"))
            .select("doc_id", "held_out", "p.*"))


def keep_identified(docs: DataFrame, model: Model, min_score: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows whose language is known with at least ``min_score``; others go."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def known(b: Block) -> np.ndarray:
        p = predict_block(b, shared.value)
        return (np.asarray(p["lang_pred"], object) != "und") & (p["score"] >= min_score)

    return filter_rows(docs, text_col, lambda column: by_block(column, known))
