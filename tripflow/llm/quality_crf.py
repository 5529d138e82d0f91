"""Quality classifier: a linear-chain conditional random field labels every
line of a text good or bad; the length-weighted mean of its lines' marginals
for good, calibrated, is the document's quality.

The field has two states. A line's potential is linear in its own features
and those of the lines before and after it; transitions have a weight for
each pair of states. Line labels aren't given: they start as their document's
label, and after each fit the lines of bad documents that look good are
relabelled (the worst line of a bad document stays bad).

Features, weights and calibration never see labels, lang, source or doc_id.

Fitting uses at most ``MAX_TRAIN_DOCS`` labelled documents (those with the
smallest id hashes, so a bounded sample of the driver's size), of at most
``MAX_TRAIN_LINES`` lines with a word each. Scoring reads all lines of all
documents.

Defined cases: a null text, or one without words, has score 0; a null id is
neither training nor held out; a repeated row is scored like any other; with
no labelled rows, or one class only, every text with words gets the share of
label 1 (0.5 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.text import Block, blocks, crc_mod, label_sample, sequence_hash, span_hash, table, text_udf

MAX_TRAIN_DOCS = 4000
MAX_TRAIN_LINES = 400
ROUNDS, STEPS, RATE, RIDGE = 3, 120, 0.1, 1e-4
THRESHOLD = 0.7
FOLDS, HELD_OUT = 4, 2
WINDOW = 6                  # words of a window whose repetition is a feature
FEATURES = ("words", "upper", "symbols", "digits", "punctuation", "marked_words", "same_as_last",
            "word_length", "repeated_line", "repeated_window", "short", "long_words")

_CLASS = np.zeros((5, 256), bool)
_CLASS[0, 65:91] = True
_CLASS[1, list(b"#*$%&|<>!")] = True
_CLASS[2, 48:58] = True
_CLASS[3, list(b".,;:?'\"()-_/\\[]{}=+~^@`")] = True
_CLASS[4, 97:123] = _CLASS[4, 65:91] = True
_CLASS[4, 128:] = True

SCORE = pa.struct([("raw", pa.float64()), ("score", pa.float64())])


@dataclass
class Lines:
    """The lines with a word of a block: features, lengths, first line per row."""

    x: np.ndarray
    weight: np.ndarray
    first: np.ndarray


def _seen(row: np.ndarray, value: np.ndarray, both: bool) -> np.ndarray:
    """Entries equal to an earlier (``both``: any other) one of their row."""
    order = np.lexsort((value, row))
    same = (row[order][1:] == row[order][:-1]) & (value[order][1:] == value[order][:-1])
    out = np.zeros(len(row), bool)
    out[order[1:][same]] = True
    if both:
        out[order[:-1][same]] = True
    return out


def lines_of(b: Block) -> Lines:
    start, end, first = b.words()
    prefix = b.prefix_hash()
    word = span_hash(prefix, start, end)
    word_row = np.repeat(np.arange(b.rows), np.diff(first))
    ls, le, _ = b.lines()
    w0, w1 = np.searchsorted(start, ls), np.searchsorted(start, le)
    keep = w1 > w0
    ls, le, w0, w1 = ls[keep], le[keep], w0[keep], w1[keep]
    row = b.row_of(ls)
    n_words, n_bytes = (w1 - w0).astype(float), np.maximum(le - ls, 1).astype(float)

    def in_line(flags, lo, hi):
        sums = np.concatenate([[0], np.cumsum(flags)])
        return (sums[hi] - sums[lo]).astype(float)

    count = [in_line(_CLASS[k][b.buf], ls, le) for k in range(5)]
    marks = np.concatenate([[0], np.cumsum(_CLASS[1][b.buf])])
    marked = in_line(marks[end] > marks[start], w0, w1)
    same = np.zeros(len(word), bool)
    same[1:] = (word[1:] == word[:-1]) & (word_row[1:] == word_row[:-1])
    at = np.arange(len(word))
    at = at[at + WINDOW <= first[1:][word_row]]
    twice = at[_seen(word_row[at], sequence_hash(word, at, WINDOW), both=True)]
    cover = np.bincount(twice, minlength=len(word) + 1) - np.bincount(twice + WINDOW, minlength=len(word) + 1)[:len(word) + 1]
    x = np.stack([
        np.log1p(n_words) / 3, count[0] / np.maximum(count[4], 1), count[1] / n_bytes, count[2] / n_bytes,
        count[3] / n_bytes, marked / n_words, in_line(same, w0, w1) / n_words,
        in_line(end - start, w0, w1) / n_words / 10, _seen(row, span_hash(prefix, ls, le), both=False).astype(float),
        in_line(np.cumsum(cover[:-1]) > 0, w0, w1) / n_words, (n_words < 4).astype(float),
        in_line(end - start > 25, w0, w1) / n_words], 1).astype(np.float32)
    return Lines(x, n_bytes, np.searchsorted(row, np.arange(b.rows + 1)))


def with_neighbours(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and after (0, the mean, at the ends), and 1."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    starts = first[:-1][np.diff(first) > 0]
    before[starts] = 0
    after[first[1:][np.diff(first) > 0] - 1] = 0
    return np.concatenate([x, before, after, np.ones((len(x), 1), x.dtype)], 1)


def marginals(potential: np.ndarray, first: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over all rows at once. ``potential``: each line's log
    potential of good (that of bad is 0); ``step``: 2 x 2 log weights of a
    transition. Returns each line's marginals (bad, good) and the sum of the
    marginals of transitions."""
    n, length = len(potential), np.diff(first)
    order = np.argsort(-length, kind="stable")
    begin, size = first[:-1][order], length[order]
    move = np.exp(step)
    clipped = np.clip(potential, -30, 30)
    own = np.stack([1 / (1 + np.exp(clipped)), 1 / (1 + np.exp(-clipped))], 1)
    ahead, behind = np.zeros((n, 2)), np.ones((n, 2))
    live = np.searchsorted(-size, -np.arange(1, (size[0] if len(size) else 0) + 1), side="right")
    for t, m in enumerate(live):
        at = begin[:m] + t
        v = own[at] if t == 0 else (ahead[at - 1] @ move) * own[at]
        ahead[at] = v / v.sum(1, keepdims=True)
    pairs = np.zeros((2, 2))
    for t in range(len(live) - 1, 0, -1):
        at = begin[:live[t]] + t
        v = own[at] * behind[at]
        joint = ahead[at - 1][:, :, None] * move * v[:, None, :]
        pairs += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
        u = v @ move.T
        behind[at - 1] = u / u.sum(1, keepdims=True)
    p = ahead * behind
    return p / p.sum(1, keepdims=True), pairs


@dataclass
class Model:
    centre: np.ndarray      # of the features
    scale: np.ndarray
    weight: np.ndarray
    step: np.ndarray
    slope: float
    offset: float


def _fit_field(x: np.ndarray, first: np.ndarray, good: np.ndarray, balance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximum likelihood by Adam; ``balance`` weighs the lines."""
    w, step = np.zeros(x.shape[1]), np.zeros((2, 2))
    inner = np.ones(len(x), bool)
    inner[first[:-1][np.diff(first) > 0]] = False
    at = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (good[at - 1], good[at]), 1)
    total, m, v = balance.sum(), np.zeros(len(w) + 4), np.zeros(len(w) + 4)
    for k in range(1, STEPS + 1):
        p, pairs = marginals(x @ w, first, step)
        g = np.concatenate([x.T @ ((good - p[:, 1]) * balance) / total - RIDGE * w, (seen - pairs).ravel() / len(x)])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        delta = RATE * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-8)
        w, step = w + delta[:-4], step + delta[-4:].reshape(2, 2)
    return w, step


def document_mean(p_good: np.ndarray, weight: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Length-weighted mean per row; nan for rows without lines."""
    sums = np.concatenate([[0], np.cumsum(p_good * weight)])
    total = np.concatenate([[0], np.cumsum(weight)])
    size = total[first[1:]] - total[first[:-1]]
    with np.errstate(invalid="ignore"):
        return np.where(size > 0, (sums[first[1:]] - sums[first[:-1]]) / size, np.nan)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def train(x: np.ndarray, weight: np.ndarray, first: np.ndarray, label: np.ndarray) -> Model:
    """``label``: 0 or 1 for each row; ``first``: its first line."""
    share = float(label.mean()) if len(label) else 0.5
    width = 3 * len(FEATURES) + 1
    if not len(label) or not 0 < share < 1:
        return Model(np.zeros(len(FEATURES)), np.ones(len(FEATURES)), np.zeros(width), np.zeros((2, 2)), 0.0,
                     float(_logit(np.array(share))))
    row = np.repeat(np.arange(len(label)), np.diff(first))
    centre, scale = x.mean(0, dtype=float), np.maximum(x.std(0, dtype=float), 1e-3)
    full = with_neighbours((x - centre) / scale, first)
    good = label[row].astype(np.int64)
    for k in range(ROUNDS):
        each = np.bincount(good, minlength=2)
        w, step = _fit_field(full, first, good, np.where(good == 1, 0.5 / max(each[1], 1), 0.5 / max(each[0], 1)))
        p = marginals(full @ w, first, step)[0][:, 1]
        if k + 1 < ROUNDS:
            worst = np.full(len(label), np.inf)
            np.minimum.at(worst, row, p)
            good = np.where(label[row] == 1, 1, (p > 0.5) & (p > worst[row])).astype(np.int64)
    mean = document_mean(p, weight, first)
    z, y = _logit(mean[~np.isnan(mean)]), label[~np.isnan(mean)].astype(float)
    slope, offset = 1.0, 0.0
    for _ in range(50):                             # Newton's method with a small prior on the slope
        q = 1 / (1 + np.exp(-np.clip(slope * z + offset, -30, 30)))
        r = q * (1 - q) + 1e-9
        g = np.array([((y - q) * z).sum() - 0.1 * (slope - 1), (y - q).sum() - 0.01 * offset])
        h = np.array([[(r * z * z).sum() + 0.1, (r * z).sum()], [(r * z).sum(), r.sum() + 0.01]])
        d = np.linalg.solve(h, g)
        slope, offset = slope + d[0], offset + d[1]
        if np.abs(d).max() < 1e-8:
            break
    return Model(centre, scale, w, step, max(float(slope), 0.0), float(offset))


def score_block(b: Block, model: Model) -> dict:
    lines = lines_of(b)
    x = with_neighbours((lines.x - model.centre) / model.scale, lines.first)
    p = marginals(x @ model.weight, lines.first, model.step)[0][:, 1]
    raw = document_mean(p, lines.weight, lines.first)
    none = np.isnan(raw)
    z = np.clip(model.slope * _logit(np.where(none, 0.5, raw)) + model.offset, -30, 30)
    return {"raw": np.where(none, 0.0, raw), "score": np.where(none, 0.0, 1 / (1 + np.exp(-z)))}


def _line_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, n_lines, weights, features) for each labelled row that fits the sample's bound."""
    for batch in batches:
        label = np.asarray(batch.column(1))
        for b in blocks(batch.column(0)):
            lines = lines_of(b)
            size = np.diff(lines.first)
            for k in np.flatnonzero((size > 0) & (size <= MAX_TRAIN_LINES)):
                s = slice(lines.first[k], lines.first[k + 1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(label[b.lo + k])], pa.int32()), pa.array([lines.weight[s]], pa.list_(pa.float64())),
                     pa.array([lines.x[s].ravel()], pa.list_(pa.float32()))], names=["label", "weight", "x"])


def fit(labelled: DataFrame, text_col: str = "text", label_col: str = "label",
        max_docs: int = MAX_TRAIN_DOCS) -> Model:
    """Fit on ``labelled``, of which at most ``max_docs`` rows are used."""
    got = (labelled.select(F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label"))
           .where("text IS NOT NULL AND label IS NOT NULL")
           .mapInArrow(_line_rows, "label int, weight array<double>, x array<float>").limit(max_docs).toArrow())
    lists = got.column("weight").combine_chunks()
    if got.num_rows == 0:
        return train(np.zeros((0, len(FEATURES))), np.zeros(0), np.zeros(1, np.int64), np.zeros(0))
    first = np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths()))]).astype(np.int64)
    x = np.asarray(got.column("x").combine_chunks().flatten()).reshape(-1, len(FEATURES))
    return train(x, np.asarray(lists.flatten()), first, np.asarray(got.column("label")))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> F.Column:
    """Column struct(raw, score): the mean marginal and the calibrated score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)   # some dozens of numbers
    return text_udf(lambda b: score_block(b, shared.value), SCORE)(F.col(text_col))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chosen = label_sample(table(spark, sf_dir, "labels"), "quality", FOLDS, HELD_OUT, MAX_TRAIN_DOCS)
    model = fit(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))
    held_out = F.coalesce(crc_mod("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return (docs.select("doc_id", held_out.alias("held_out"), score(docs, model).alias("s"))
            .select("doc_id", "held_out", F.col("s.score").alias("score"),
                    (F.col("s.score") >= THRESHOLD).cast("int").alias("predicted"), F.col("s.raw").alias("mean_good")))
