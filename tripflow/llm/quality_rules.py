"""Quality rules: per-document rules, then host-level verdicts.

Base rules read the whole text of each document. Failures are then counted
per host (one partially aggregated row per host and task, however many
documents a host has), each host's failure rate is shrunk towards the corpus
by an empirical beta prior, and hosts whose shrunk rate reaches
``max_host_rate`` are rejected with all their documents.

Defined cases: a null or empty text has no words and fails the base rules; a
null host gets no verdict (its documents stand or fall alone) and takes no
part in the prior; a repeated row is judged like any other row; with no rows
there is no prior and nothing to judge. Columns other than id, text and host
are not read by ``judge``, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.text import Block, by_block, checkpoint, filter_rows, fresh, sequence_hash, span_hash, table, text_udf


# fixed values: the characters that count as symbols
SYMBOLS = b"#*$%&|<>"
WINDOW = 8                  # words of a window that must not repeat
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MAX_HOST_RATE = 0.5         # hosts failing at least this (shrunk) share are rejected
MAX_BROADCAST_HOSTS = 100_000   # rejected hosts up to this number are broadcast, more are joined
MIN_PRIOR, MAX_PRIOR = 1.0, 1_000_000.0   # bounds of the prior's weight, in documents

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True

COUNTS = pa.struct([(name, pa.int64()) for name in
                    ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")])


def _later_equal(row: np.ndarray, value: np.ndarray) -> np.ndarray:
    """True for each entry that equals an earlier one of its row (entries in row order)."""
    order = np.lexsort((value, row))
    r, v = row[order], value[order]
    out = np.zeros(len(row), bool)
    out[order[1:]] = (r[1:] == r[:-1]) & (v[1:] == v[:-1])
    return out


def count_block(b: Block) -> dict:
    start, end, first = b.words()
    per_row = lambda at: np.bincount(b.row_of(at), minlength=b.rows)[:b.rows]
    in_word = np.zeros(len(b.buf) + 1, np.int64)
    np.add.at(in_word, start, 1)
    np.subtract.at(in_word, end, 1)
    solid = np.cumsum(in_word[:-1]) > 0
    prefix = b.prefix_hash()
    words = span_hash(prefix, start, end)
    # lines with a word that equal an earlier line of the text
    ls, le, _ = b.lines()
    has_word = np.searchsorted(start, le) > np.searchsorted(start, ls)
    ls, le = ls[has_word], le[has_word]
    dup = _later_equal(b.row_of(ls), span_hash(prefix, ls, le))
    # words that some repeated window covers
    at = np.arange(len(start))
    word_row = np.repeat(np.arange(b.rows), np.diff(first))
    at = at[at + WINDOW <= first[1:][word_row]]
    seq, row = sequence_hash(words, at, WINDOW), word_row[at]
    order = np.lexsort((seq, row))
    same = (row[order][1:] == row[order][:-1]) & (seq[order][1:] == seq[order][:-1])
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(start) + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.subtract.at(cover, at[twice] + WINDOW, 1)
    repeated = np.cumsum(cover[:-1]) > 0
    return {
        "n_words": np.diff(first),
        "word_chars": per_row(np.flatnonzero(solid & ((b.buf & 0xC0) != 0x80))),
        "n_symbols": per_row(np.flatnonzero(_IS_SYMBOL[b.buf])),
        "n_dup_lines": per_row(ls[dup]),
        "n_repeat_words": np.bincount(word_row[repeated], minlength=b.rows)[:b.rows],
    }


def text_counts(text):
    """Struct column of the five counts of a text column."""
    return text_udf(count_block, COUNTS)(text)


def _passes(b: Block) -> np.ndarray:
    c = count_block(b)
    return ~((c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"]))


def base_failed(counts: str = "") -> F.Column:
    c = lambda name: F.col(f"{counts}{name}")
    return (c("n_words") < MIN_WORDS) | (100 * c("n_repeat_words") > MAX_REPEAT_PERCENT * c("n_words"))


def host_verdicts(judged: DataFrame, host: str = "host", failed: str = "base_failed",
                  max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """(host, n_docs, n_failed, shrunk_rate, host_failed), one row per host.

    The prior Beta(m s, (1 - m) s) has the corpus failure rate m as its mean;
    its weight s matches the variance v of the hosts' rates: m (1 - m) / v - 1,
    kept within MIN_PRIOR..MAX_PRIOR (MAX_PRIOR where v is 0).
    """
    by_host = checkpoint(
        judged.where(F.col(host).isNotNull()).groupBy(F.col(host).alias("host"))
        .agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.col(failed).cast("long")).alias("n_failed")))
    rate = F.col("n_failed") / F.col("n_docs")
    total = by_host.agg(F.sum("n_failed").alias("k"), F.sum("n_docs").alias("n"),
                        F.var_pop(rate).alias("v")).first()
    mean = (total.k or 0) / total.n if total.n else 0.0
    weight = MAX_PRIOR
    if total.v:
        weight = min(MAX_PRIOR, max(MIN_PRIOR, mean * (1 - mean) / total.v - 1))
    shrunk = (F.col("n_failed") + F.lit(mean * weight)) / (F.col("n_docs") + F.lit(weight))
    return by_host.select("*", shrunk.alias("shrunk_rate"), (shrunk >= F.lit(max_rate)).alias("host_failed"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per input row: id, the five counts, ``base_failed``,
    ``host_failed`` and ``kept``."""
    judged = checkpoint(
        docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"),
                    text_counts(F.col(text_col)).alias("c"))
        .select("doc_id", "host", "c.*").withColumn("base_failed", base_failed()))
    hosts = host_verdicts(judged, max_rate=max_rate).select("host", "host_failed")
    return (judged.join(hosts, "host", "left")
            .withColumn("host_failed", F.coalesce("host_failed", F.lit(False)))
            .withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed"))
            .select("doc_id", *COUNTS.names, "base_failed", "host_failed", "kept"))


def keep_good(docs: DataFrame, text_col: str = "text", host_col: str = "source",
              max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their columns.

    Texts are read twice (once for the host rates) rather than shuffled.
    Columns may have any names.
    """
    counted = docs.select(F.col(host_col).alias("host"), text_counts(F.col(text_col)).alias("c"))
    hosts = host_verdicts(counted.select("host", base_failed("c.").alias("base_failed")), max_rate=max_rate)
    name = fresh("_bad_host", docs)
    bad = checkpoint(hosts.where("host_failed").select(F.col("host").alias(name)))
    if bad.count() <= MAX_BROADCAST_HOSTS:
        bad = F.broadcast(bad)
    ok = filter_rows(docs, text_col, lambda column: by_block(column, _passes))
    return (ok.join(bad, F.col(host_col) == F.col(name), "left_anti").select(*docs.columns))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge(table(spark, sf_dir, "documents"))
    return out.select("doc_id", *COUNTS.names, "base_failed", "kept", "host_failed")


ORACLE_SQL = r"""
WITH doc AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
numbered AS (SELECT row_number() OVER () AS k, * FROM doc),
win AS (
  SELECT k, i, array_to_string(list_slice(w, i, i + 7), ' ') AS g
  FROM (SELECT k, w, unnest(range(1, len(w) - 6)) AS i FROM numbered WHERE len(w) >= 8)),
twice AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS n FROM win) WHERE n > 1),
rep AS (
  SELECT k, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT k, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY k),
line AS (
  SELECT k, unnest(string_split(text, chr(10))) AS line FROM numbered),
dup AS (
  SELECT k, sum(n - 1) AS n_dup_lines
  FROM (SELECT k, line, count(*) AS n FROM line WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY k, line)
  GROUP BY k),
base AS (
  SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM numbered LEFT JOIN rep USING (k) LEFT JOIN dup USING (k)),
failed AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base),
host AS (
  SELECT source, count(*) AS n, sum(base_failed::INT) AS f FROM failed WHERE source IS NOT NULL GROUP BY source),
prior AS (
  SELECT sum(f) / sum(n) AS m, var_pop(f / n) AS v FROM host),
shrunk AS (
  SELECT source, (f + m * s) / (n + s) >= 0.5 AS host_failed
  FROM host, (SELECT m, CASE WHEN v > 0 THEN least(1000000.0, greatest(1.0, m * (1 - m) / v - 1))
                             ELSE 1000000.0 END AS s FROM prior))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(host_failed, false) AS kept,
       coalesce(host_failed, false) AS host_failed
FROM failed LEFT JOIN shrunk USING (source)
"""
