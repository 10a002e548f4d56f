"""Licence notices by Dice coefficient over word bigrams. Built-in functions only."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm.common import ascii_lower, documents

# Common licence notices, as their authors ask for them to be given.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
    "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "BSD": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
THRESHOLD = 0.7


def _words_of(text: str) -> list[str]:
    return [w for w in re.sub(r"[^a-z0-9]+", " ", text.lower()).split(" ") if w]


def _bigrams_of(text: str) -> list[str]:
    tokens = _words_of(text)
    return sorted({f"{a} {b}" for a, b in zip(tokens, tokens[1:])})


def bigrams(text: Column) -> Column:
    """Distinct pairs of neighbouring words, A-Z in lower case, only letters and digits kept."""
    tokens = F.filter(F.split(ascii_lower(text), "[^a-z0-9]+"), lambda w: w != "")

    def pairs(t: Column) -> Column:
        heads = F.slice(t, 1, F.greatest(F.size(t) - 1, F.lit(0)))
        return F.zip_with(heads, F.slice(t, 2, F.greatest(F.size(t) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))

    return F.array_distinct(F.get(F.transform(F.array(tokens), pairs), F.lit(0)))


def best_template(grams: Column, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> Column:
    """The template of the highest Dice coefficient, from ``threshold`` on, as
    struct<dice, license>, else null; ties go to the larger name.

    With sizes a and b the coefficient is at most 2 min(a, b) / (a + b), so only
    templates within these bounds are compared, and only for texts that share a
    bigram with some template.
    """
    sets = {name: _bigrams_of(text) for name, text in templates.items()}
    ratio = threshold / (2 - threshold)
    table = F.from_json(
        F.lit(json.dumps([{"name": k, "grams": v, "low": ratio * len(v), "high": len(v) / ratio} for k, v in sets.items() if v])),
        "array<struct<name:string,grams:array<string>,low:double,high:double>>",
    )
    every = F.from_json(F.lit(json.dumps(sorted({g for v in sets.values() for g in v}))), "array<string>")
    least, most = (f(x) for f, x in ((min, [ratio * len(v) for v in sets.values()]), (max, [len(v) / ratio for v in sets.values()])))

    def dice(t: Column) -> Column:
        shared = F.size(F.array_intersect(grams, t["grams"]))
        return F.struct((2.0 * shared / (F.size(grams) + F.size(t["grams"]))).alias("dice"), t["name"].alias("license"))

    near = F.filter(table, lambda t: (F.size(grams) >= t["low"]) & (F.size(grams) <= t["high"]))
    found = F.filter(F.transform(near, dice), lambda d: d["dice"] >= threshold)
    possible = (F.size(grams) >= least) & (F.size(grams) <= most) & F.arrays_overlap(grams, every)
    return F.when(possible, F.array_max(found))


def scan(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``matches``: array<struct<line, license, dice>> of the lines that
    are licence notices, lines from 0, and -1 for a text that is one as a whole over
    several lines. A null text is an empty one. A column named matches is replaced.
    """
    text = F.coalesce("text", F.lit(""))
    lines = F.split(text, "\n", -1)
    units = F.concat(
        F.transform(lines, lambda line, i: F.struct(i.alias("line"), line.alias("unit"))),
        F.when(F.size(lines) > 1, F.array(F.struct(F.lit(-1).alias("line"), text.alias("unit")))).otherwise(F.array()),
    )
    grams = F.transform(units, lambda u: F.struct(u["line"].alias("line"), bigrams(u["unit"]).alias("grams")))
    judged = F.transform(grams, lambda u: F.struct(u["line"].alias("line"), best_template(u["grams"], threshold=threshold).alias("best")))
    kept = F.filter(judged, lambda u: u["best"].isNotNull())
    return docs.withColumn("matches", F.array_sort(F.transform(kept, lambda u: F.struct(
        u["line"].alias("line"), u["best"]["license"].alias("license"), u["best"]["dice"].alias("dice")
    ))))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(documents(spark, sf_dir).select("doc_id", "text"))
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"])))
    return found.select(
        "doc_id", F.size("matches").cast("bigint").alias("n_matches"), F.array_join(names, ",").alias("licenses"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["dice"])), F.lit(0.0)).alias("best_dice"),
        F.array_join(F.transform("matches", lambda m: m["line"].cast("string")), ",").alias("lines"),
    )


def _values() -> str:
    rows = ((k, g) for k, v in TEMPLATES.items() for g in _bigrams_of(v))
    return ", ".join(f"('{k}', '{g}')" for k, g in rows)


SQL = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
units AS (
    SELECT doc_id, generate_subscripts(lines, 1) - 1 AS line, unnest(lines) AS unit FROM docs
    UNION ALL SELECT doc_id, -1, text FROM docs WHERE len(lines) > 1
),
words AS (
    SELECT doc_id, line, list_filter(regexp_split_to_array(translate(unit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+'), lambda w: w <> '') AS w
    FROM units
),
grams AS (SELECT doc_id, line, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM words),
templates AS (SELECT name, list(gram) AS g FROM (VALUES {_values()}) t(name, gram) GROUP BY name),
scored AS (
    SELECT doc_id, line, name, 2.0::DOUBLE * len(list_intersect(u.g, t.g)) / (len(u.g) + len(t.g)) AS dice
    FROM grams u JOIN templates t ON len(u.g) BETWEEN len(t.g) * {THRESHOLD} / (2 - {THRESHOLD}) AND len(t.g) * (2 - {THRESHOLD}) / {THRESHOLD}
),
best AS (SELECT doc_id, line, max(struct_pack(dice := dice, name := name)) AS b FROM scored WHERE dice >= {THRESHOLD} GROUP BY doc_id, line),
found AS (
    SELECT doc_id, count(*) AS n, string_agg(DISTINCT b.name, ',' ORDER BY b.name) AS licenses, max(b.dice) AS dice,
           string_agg(line::VARCHAR, ',' ORDER BY line) AS lines
    FROM best GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_matches, coalesce(licenses, '') AS licenses, coalesce(dice, 0)::DOUBLE AS best_dice, coalesce(f.lines, '') AS lines
FROM docs d LEFT JOIN found f USING (doc_id)
"""
