"""Licence scan: lines and whole texts compared with licence templates by the Dice coefficient over word bigrams.

Both sides are lower-cased and every run of other characters than letters and digits becomes one space. A text unit
with n distinct bigrams can only reach the coefficient t with a template of m bigrams if n lies between m * t / (2 - t)
and m * (2 - t) / t; templates are joined on n by these bounds and all others are never compared. Column expressions
only; the template table is fixed and small, so it is broadcast.

Units are the lines of a text (numbered from 0) and, if it has several lines with words, the whole text (unit -1).
Null and empty texts and units of fewer than two words have no bigram and match nothing. Repeated rows give one row.
Ties go to the first template by name. An empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_text, table

THRESHOLD = 0.8

# Short notices and texts of public licences, by SPDX identifier.
TEMPLATES = [
    ("Apache-2.0/notice", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0/header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("MIT/notice", "Released under the MIT License."),
    ("MIT/text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("GPL-3.0/notice", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0/header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0/header", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("BSD-3-Clause/notice", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("ISC/text", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0/header", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0/notice", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0/notice", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0/notice", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0/sentence", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0/notice", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense/text", "This is free and unencumbered software released into the public domain."),
]


def words(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), " ")


def bigrams(tokens: Column) -> Column:
    """Distinct word bigrams as 64-bit hashes; empty for fewer than two words."""
    pairs = F.transform(F.sequence(F.lit(1), F.size(tokens) - 1), lambda i: F.xxhash64(F.get(tokens, i - 1), F.get(tokens, i)))
    return F.when(F.size(tokens) >= 2, F.array_distinct(pairs)).otherwise(F.array().cast("array<bigint>"))


def _once(value: Column, then) -> Column:
    """then(value) with the value computed once, however often `then` names it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def bounds(size: int, threshold: float) -> tuple[int, int]:
    """Numbers of bigrams that can reach the threshold with a template of that size."""
    low, high = math.ceil(size * threshold / (2 - threshold) - 1e-9), math.floor(size * (2 - threshold) / threshold + 1e-9)
    return max(1, low), high


def template_table(spark: SparkSession, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """A row for each template and each number of bigrams that it can match."""
    t = F.lit(threshold)
    size = F.size("grams")
    made = spark.createDataFrame(templates, "licence string, body string").select("licence", _once(words(F.col("body")), bigrams).alias("grams"))
    low = F.greatest(F.lit(1), F.ceil(size * t / (2 - t) - F.lit(1e-9)).cast("int"))
    high = F.floor(size * (2 - t) / t + F.lit(1e-9)).cast("int")
    return made.where(size > 0).select("licence", "grams", F.explode(F.sequence(low, high)).alias("n_bigrams"))


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, unit, licence, dice of every unit whose best template reaches the threshold."""
    sizes = [len(set(zip(w[:-1], w[1:], strict=True))) for _, body in templates if len(w := _plain(body)) > 1]
    if not sizes:
        raise ValueError("no template has two words")
    least, most = bounds(min(sizes), threshold)[0], bounds(max(sizes), threshold)[1]
    lines = F.split(F.col("text"), "\n", -1)
    # A word takes at least two characters with what parts it from the next, so shorter units are out at once.
    worded = F.filter(F.transform(lines, lambda x, i: F.struct(i.alias("unit"), x.alias("body"))), lambda x: F.length(x["body"]) > 2 * least)
    many = F.size(F.filter(lines, lambda x: F.length(F.trim(x)) > 0)) > 1
    whole = F.when(many, F.array(F.struct(F.lit(-1).alias("unit"), F.col("text").alias("body")))).otherwise(F.array().cast("array<struct<unit:int,body:string>>"))
    # One expression up to the generator, with the words bound by a lambda: each unit is normalised once.
    counted = F.transform(F.concat(whole, worded), lambda u: F.struct(u["unit"].alias("unit"), _once(words(u["body"]), bigrams).alias("unit_grams")))
    units = id_text(docs).select("doc_id", F.inline(F.filter(counted, lambda u: F.size(u["unit_grams"]).between(least, most))))
    units = units.select("doc_id", "unit", "unit_grams", F.coalesce(F.size("unit_grams"), F.lit(0)).alias("n_bigrams"))
    pairs = units.join(F.broadcast(template_table(docs.sparkSession, templates, threshold)), "n_bigrams")
    dice = 2.0 * F.size(F.array_intersect("unit_grams", "grams")) / (F.col("n_bigrams") + F.size("grams"))
    found = pairs.select("doc_id", "unit", "licence", dice.alias("dice")).where(F.col("dice") >= threshold)
    best = found.groupBy("doc_id", "unit").agg(F.min(F.struct((-F.col("dice")).alias("less"), "licence")).alias("best"))
    return best.select("doc_id", "unit", F.col("best.licence").alias("licence"), (-F.col("best.less")).alias("dice"))


def _plain(text: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    quoted = ", ".join("('{}', '{}')".format(a, b.replace("'", "''")) for a, b in TEMPLATES)
    split = r"list_filter(string_split(trim(regexp_replace(lower({}), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' '), lambda x: x <> '')"
    grams = "list_distinct(list_transform(range(1, len({0})), lambda i: {0}[i] || ' ' || {0}[i + 1]))"
    return f"""
WITH templates AS (SELECT licence, {grams.format('w')} AS grams FROM (SELECT licence, {split.format('body')} AS w FROM (VALUES {quoted}) t(licence, body))),
lines AS (SELECT doc_id, string_split(text, chr(10)) AS parts, text FROM documents WHERE text IS NOT NULL),
units AS (
  SELECT doc_id, i - 1 AS unit, parts[i] AS body FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM lines)
  UNION ALL
  SELECT doc_id, -1, text FROM lines WHERE len(list_filter(parts, lambda x: trim(x) <> '')) > 1),
counted AS (SELECT doc_id, unit, {grams.format('w')} AS grams FROM (SELECT doc_id, unit, {split.format('body')} AS w FROM units) WHERE len(w) > 1),
scored AS (
  SELECT doc_id, unit, licence, 2.0::DOUBLE * len(list_intersect(c.grams, t.grams)) / (len(c.grams) + len(t.grams)) AS dice
  FROM counted c JOIN templates t ON len(c.grams) * (2 - {THRESHOLD}::DOUBLE) + 1e-6 >= len(t.grams) * {THRESHOLD}::DOUBLE AND len(t.grams) * (2 - {THRESHOLD}::DOUBLE) + 1e-6 >= len(c.grams) * {THRESHOLD}::DOUBLE),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id, unit ORDER BY dice DESC, licence) AS place FROM scored WHERE dice >= {THRESHOLD}::DOUBLE)
SELECT doc_id, unit::INTEGER AS unit, licence, dice FROM ranked WHERE place = 1"""


QUERIES = {"op9_licences": op9_licences}
ORACLES = {"op9_licences": _oracle()}
