"""License scans by sentence rules.

A text is cut into sentences, each is normalised (A-Z lower-cased, every run
of other characters than a-z and 0-9 made one space) and mapped to known
licence sentences: by its whole normalised text where that is known (titles,
lines of SPDX identifiers), else to those that it holds, whose places in it
order them. The identifiers of a text, in its order, form a sequence like
``<apache-grant><all-rights>``; ordered
rules (sequences of identifiers) are matched against it, each taking what it
matches away from the rules after it. Everything is a column expression over
the whole text of each row; nothing is shuffled.

Defined cases: a null or empty text has no sentences and no licence; a
repeated row is scanned like any other; two rules for the same sequence: the
first wins; known sentences that start at one place go in the order of
``SENTENCES``; sentences that no rule takes are counted as unmatched; an SPDX
line names one licence, so one with an expression (``MIT OR ISC``) or an unknown
name is no known sentence; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.text import table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# fixed values: known sentences, as patterns of their normalised form
SENTENCES = [
    ("apache-grant", "licensed under the apache license version 2 0"),
    ("apache-copy", "you may obtain a copy of the license at( http www apache org licenses license 2 0)?"),
    ("apache-asis", "distributed under the license is distributed on an as is basis"),
    ("mit-grant", "released under the mit license|licensed under the mit license"),
    ("mit-permission", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit-notice", "the above copyright notice and this permission notice shall be included"),
    ("asis-warranty", "the software is provided as is without warranty of any kind"),
    ("bsd-grant", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-source", "redistributions of source code must retain the above copyright notice"),
    ("bsd-binary", "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-names", "neither the name of .* may be used to endorse or promote products"),
    ("bsd-warranty", "this software is provided by the copyright holders and contributors as is"),
    ("isc-permission", "permission to use copy modify and or distribute this software for any purpose"),
    ("gpl3-grant", "licensed under the gnu general public license version 3"),
    ("gpl2-grant", "licensed under the gnu general public license version 2"),
    ("gpl-redistribute", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl3-later", "either version 3 of the license or at your option any later version"),
    ("gpl2-later", "either version 2 of the license or at your option any later version"),
    ("gpl-warranty", "is distributed in the hope that it will be useful but without any warranty"),
    ("lgpl-redistribute", "under the terms of the gnu lesser general public license"),
    ("mpl-grant", "subject to the terms of the mozilla public license v 2 0"),
    ("cc0", "cc0 1 0 universal|dedicated .* to the public domain under cc0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "licensed under cc by 4 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("all-rights", "all rights reserved"),
]
# fixed values: whole sentences that are titles
TITLES = [("mit-title", "the mit license mit"), ("mit-title", "the mit license"), ("mit-title", "mit license"),
          ("isc-title", "isc license"), ("bsd3-title", "bsd 3 clause license"), ("bsd2-title", "bsd 2 clause license")]
# fixed values: names that an SPDX line may give
SPDX = ["MIT", "ISC", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only",
        "GPL-3.0-or-later", "MPL-2.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "Unlicense"]
# fixed values: rules in the order in which they are tried
RULES = [
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names", "bsd-warranty"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-warranty"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("MIT", ["mit-title", "mit-permission", "mit-notice", "asis-warranty"]),
    ("MIT", ["mit-permission", "mit-notice", "asis-warranty"]),
    ("MIT", ["mit-permission", "mit-notice"]),
    ("MIT", ["mit-grant"]),
    ("ISC", ["isc-title", "isc-permission"]),
    ("ISC", ["isc-permission"]),
    ("LGPL", ["lgpl-redistribute", "gpl3-later"]),
    ("LGPL", ["lgpl-redistribute"]),
    ("GPL-3.0-or-later", ["gpl-redistribute", "gpl3-later", "gpl-warranty"]),
    ("GPL-3.0-or-later", ["gpl-redistribute", "gpl3-later"]),
    ("GPL-2.0-or-later", ["gpl-redistribute", "gpl2-later", "gpl-warranty"]),
    ("GPL-2.0-or-later", ["gpl-redistribute", "gpl2-later"]),
    ("GPL-3.0-only", ["gpl3-grant"]),
    ("GPL-2.0-only", ["gpl2-grant"]),
    ("Apache-2.0", ["apache-grant", "apache-copy", "apache-asis"]),
    ("Apache-2.0", ["apache-grant", "apache-copy"]),
    ("Apache-2.0", ["apache-grant"]),
    ("MPL-2.0", ["mpl-grant"]),
    ("CC0-1.0", ["cc0"]),
    ("CC-BY-NC-4.0", ["cc-by-nc"]),
    ("CC-BY-SA-4.0", ["cc-by-sa"]),
    ("CC-BY-4.0", ["cc-by"]),
    ("Unlicense", ["unlicense"]),
    *((name, [f"spdx-{name.lower()}"]) for name in SPDX),
    ("MIT", ["mit-title"]),
    ("ISC", ["isc-title"]),
    ("BSD-3-Clause", ["bsd3-title"]),
    ("BSD-2-Clause", ["bsd2-title"]),
    ("all-rights-reserved", ["all-rights"]),
]

# Sentences without one of these can't be known; they are not looked at further.
HINT = ("licen[sc]e|warrant|redistribut|permission|rights reserved|cc0|public domain|copyright|"
        "under the terms|to endorse or promote|under cc ")
# A sentence ends at .!?; or : before white space, or at a blank line.
_END = r"([.!?;:])[ \t\n\x0B\f\r]+|\n[ \t\r]*\n"
_CUT = "\u0001"
# An SPDX line's value is a sentence with its label, up to the end of the line or of a comment.
_SPDX = r"spdx-license-identifier:[ \t]*([^\n\r*<]*)"
WHOLE = dict((s, f"<{name}>") for name, s in TITLES) | {
    "spdx license identifier " + name.lower().replace("-", " ").replace(".", " "): f"<spdx-{name.lower()}>" for name in SPDX}


def sentences(text: Column) -> Column:
    """Array of the normalised sentences that have a hint."""
    low = F.translate(text, UPPER, LOWER)
    low = F.regexp_replace(low, _SPDX, f"{_CUT}spdx license identifier $1{_CUT}")
    cut = F.split(F.regexp_replace(low, _END, f"$1{_CUT}"), _CUT)
    normal = F.transform(cut, lambda s: F.trim(F.regexp_replace(s, "[^a-z0-9]+", " ")))
    return F.filter(normal, lambda s: s.rlike(HINT))


def identifiers(normal: Column) -> Column:
    """The identifiers of all sentences of an array, as ``<a><b>``."""
    whole = F.create_map(*[F.lit(x) for kv in WHOLE.items() for x in kv])
    # a sentence holds at most a few; only those are placed
    held = lambda s: F.filter(F.array(*[
        F.when(s.rlike(f"(^| )({p})( |$)"), F.struct(F.regexp_instr(s, F.lit(f"(^| )({p})( |$)")).alias("at"),
                                                     F.lit(k).alias("k"), F.lit(f"<{name}>").alias("id")))
        for k, (name, p) in enumerate(SENTENCES)]), lambda x: x.isNotNull())
    placed = lambda s: F.array_join(F.transform(F.array_sort(held(s)), lambda x: x["id"]), "")
    return F.array_join(F.transform(normal, lambda s: F.coalesce(F.try_element_at(whole, s), placed(s))), "")


def match_rules(sequence: Column) -> Column:
    """Struct(rest, found) after all rules: what no rule took, and the names found, in rule order."""
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("".join(f"<{x}>" for x in ids)).alias("ids"))
                      for name, ids in RULES])
    empty = F.struct(sequence.alias("rest"), F.lit("").alias("found"))

    def step(state, rule):
        hit = F.contains(state["rest"], rule["ids"])
        return F.struct(
            F.when(hit, F.replace(state["rest"], rule["ids"], F.lit("|"))).otherwise(state["rest"]).alias("rest"),
            F.when(hit, F.concat(state["found"], F.lit(","), rule["name"])).otherwise(state["found"]).alias("found"))

    return F.aggregate(rules, empty, step)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, sentence_ids, licences, n_unmatched) for each row; licences are
    distinct names joined by commas, in rule order."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    ids = F.when(F.translate(text, UPPER, LOWER).rlike(_text_hint()), identifiers(sentences(text))).otherwise("")
    out = docs.select(F.col(id_col).alias("doc_id"), ids.alias("sentence_ids"))
    out = out.withColumn("_m", F.when(F.col("sentence_ids") != "", match_rules(F.col("sentence_ids"))))
    names = F.array_distinct(F.filter(F.split(F.coalesce("_m.found", F.lit("")), ","), lambda x: x != ""))
    left = F.length(F.regexp_replace(F.coalesce("_m.rest", F.lit("")), "[^<]", ""))
    return out.select("doc_id", "sentence_ids", F.array_join(names, ",").alias("licences"),
                      left.cast("long").alias("n_unmatched"))


def _text_hint() -> str:
    """HINT before normalisation: any other characters may stand for its spaces."""
    return HINT.replace(" ", "[^a-z0-9]+")


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    listed = ", ".join(f"({k}, '{name}', '{p}')" for k, (name, p) in enumerate(SENTENCES))
    whole = ", ".join(f"('{s}', '{name}')" for s, name in WHOLE.items())
    steps, last = [], "seq"
    for k, (name, ids) in enumerate(RULES):
        pattern = "".join(f"<{x}>" for x in ids)
        steps.append(f"""r{k} AS (
  SELECT k, doc_id, sentence_ids, replace(rest, '{pattern}', '|') AS rest,
         CASE WHEN contains(rest, '{pattern}') THEN list_append(found, '{name}') ELSE found END AS found FROM {last})""")
        last = f"r{k}"
    return rf"""
WITH doc AS (SELECT row_number() OVER () AS k, doc_id,
  regexp_replace(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), 'spdx-license-identifier:[ \t]*([^\n\r*<]*)',
                 chr(1) || 'spdx license identifier \1' || chr(1), 'g') AS t FROM documents),
known(k2, name, p) AS (VALUES {listed}),
whole(s, ids) AS (VALUES {whole}),
cut AS (
  SELECT k, unnest(string_split(regexp_replace(t, '([.!?;:])[ \t\n\x0B\f\r]+|\n[ \t\r]*\n', '\1' || chr(1), 'g'), chr(1))) AS s,
         generate_subscripts(string_split(regexp_replace(t, '([.!?;:])[ \t\n\x0B\f\r]+|\n[ \t\r]*\n', '\1' || chr(1), 'g'), chr(1)), 1) AS i
  FROM doc),
norm AS (SELECT k, i, trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g')) AS s FROM cut),
hinted AS (SELECT k, i, s FROM norm WHERE regexp_matches(s, '{HINT}')),
distinct_s AS (SELECT DISTINCT s FROM hinted),
parts AS (
  SELECT s, string_agg('<' || name || '>', '' ORDER BY length(regexp_extract(s, '^(.*?)(?:^| )(?:' || p || ')(?: |$)', 1)), k2) AS ids
  FROM distinct_s, known WHERE regexp_matches(s, '(^| )(' || p || ')( |$)') GROUP BY s),
ids AS (
  SELECT k, string_agg(coalesce(whole.ids, parts.ids, ''), '' ORDER BY i) AS sentence_ids
  FROM hinted LEFT JOIN whole USING (s) LEFT JOIN parts USING (s) GROUP BY k),
seq AS (
  SELECT doc.k, doc_id, coalesce(sentence_ids, '') AS sentence_ids, coalesce(sentence_ids, '') AS rest,
         CAST([] AS VARCHAR[]) AS found FROM doc LEFT JOIN ids USING (k)),
{", ".join(steps)}
SELECT doc_id, sentence_ids,
       coalesce(array_to_string(list_filter(found, lambda x, i: list_position(found, x) = i), ','), '') AS licences,
       CAST(length(regexp_replace(rest, '[^<]', '', 'g')) AS BIGINT) AS n_unmatched
FROM {last}
"""


ORACLE_SQL = _oracle()
