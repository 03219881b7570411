"""License scans: text units against licence notices by the Dice coefficient over word bigrams. Native throughout."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

#: Notices by which licences are recognised, fixed values: (licence, text).
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MIT", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("CC0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


@dataclass(frozen=True)
class Licenses:
    """threshold: Dice coefficient of a match, as a fraction."""

    threshold: tuple[int, int] = (8, 10)


def _words(text: str) -> list[str]:
    return re.sub("[^a-z0-9]+", " ", text.lower()).split()


def bigrams(text: str) -> list[str]:
    """The distinct word bigrams of a notice, normalised as the scan does; of one word that word."""
    words = _words(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:]))) or words


def _notice_rows(notices, config: Licenses) -> list[tuple]:
    """(notice, licence, size, least and most bigrams of a text unit that can match, bigram): the Dice
    coefficient of sets of sizes a and b is at most 2 min(a, b) / (a + b)."""
    num, den = config.threshold
    out = []
    for i, (licence, text) in enumerate(notices):
        found = bigrams(text)
        b = len(found)
        out += [(i, licence, b, -(-num * b // (2 * den - num)), (2 * den - num) * b // num, x) for x in found]
    return out


def key_words(rows: list[tuple]) -> list[str]:
    """Words of which any text that matches a notice has one: enough of each notice's bigrams hold one that
    the others alone are fewer than a match needs. Of words that are left the longest come first, as
    the likeliest to be rare."""
    notices: dict[int, tuple[int, set[str]]] = {}
    for notice, _, _, least, _, bigram, *_ in rows:
        notices.setdefault(notice, (least, set()))[1].add(bigram)
    out: list[str] = []
    for word in sorted({w for r in rows for w in r[5].split(" ")}, key=lambda w: (-len(w), w)):
        short = [b for least, b in notices.values() if len(b) >= least]
        if any(word in x.split(" ") for b in short for x in b):
            out.append(word)
            for _, b in notices.values():
                b -= {x for x in b if word in x.split(" ")}
    return out


def scan(spark: SparkSession, docs: DataFrame, notices=NOTICES, config: Licenses = Licenses()) -> DataFrame:
    """docs: doc_id (long), text. One row per document and licence found: doc_id, license, dice (of its
    best unit, or window if no unit matches), n_units (units that match a notice of it, 0 if only
    windows do).

    A unit is a line, a paragraph (lines between blank ones) or the whole text, each counted once if
    equal. Units and notices are lower-cased, runs of other than a-z and 0-9 made one space, and compared
    by sets of word bigrams (a single word stands for itself). A notice is a candidate only for units
    whose number of bigrams its size allows. A notice inside a larger unit, be it wrapped, unwrapped or
    in a comment, is found by windows of as many words as it has over the words of the whole text; a
    window's bigrams that are not the notice's count each time. Of the licences that one unit matches, or
    windows whose middles are closer than the shortest notice is long, only those with the highest
    coefficient count, all of them if tied. The notices' bigrams are a parameter's size, so they are
    broadcast; texts without a word that every match needs go no further. Nulls: a null or empty text
    matches nothing; a null doc_id is kept as it is. Repeated rows each give their own. Very long texts
    are one row until their bigrams are. No documents or notices give no rows. Other columns are ignored,
    whatever their names.
    """
    num, den = config.threshold
    rows = [(*r, max(len(_words(notices[r[0]][1])) - 1, 1)) for r in _notice_rows(notices, config)]
    index = spark.createDataFrame(rows, "notice int, license string, size long, least long, most long, bigram string, length long")
    least, most = min((r[3] for r in rows), default=0), max((r[4] for r in rows), default=-1)
    text = F.regexp_replace(F.col("text").cast("string"), "\r\n", "\n")
    units = F.array_distinct(F.concat(F.split(text, "\n"), F.split(text, "\n[ \t]*\n"), F.array(text)))
    units = F.concat(F.transform(units, lambda u: F.struct(u.alias("text"), F.lit(False).alias("wide"))), F.array(F.struct(text.alias("text"), F.lit(True).alias("wide"))))
    needed = F.array(*map(F.lit, key_words(rows))).cast("array<string>")
    docs = docs.where(F.arrays_overlap(F.split(F.regexp_replace(F.lower(F.col("text").cast("string")), "[^a-z0-9]+", " "), " "), needed))
    docs = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), units.alias("units"))
    docs = docs.select("row", "doc_id", F.explode("units").alias("unit"))
    plain = F.trim(F.regexp_replace(F.lower("unit.text"), "[^a-z0-9]+", " "))
    # A unit of so many bigrams, repeats included, has a space less than words; a longer one may hold
    # fewer distinct ones, so only the lower bound is known before they are made.
    docs = docs.select("row", "doc_id", "unit.wide", F.monotonically_increasing_id().alias("unit"), plain.alias("plain")).where(F.length("plain") >= 2 * least - 1)
    words = docs.select("row", "doc_id", "wide", "unit", F.split("plain", " ").alias("w")).where(F.size("w") > least - 1)
    pairs = F.zip_with(F.slice("w", 1, F.size("w") - 1), F.slice("w", 2, F.size("w") - 1), lambda a, b: F.concat(a, F.lit(" "), b))
    pairs = F.when(F.size("w") < 2, F.col("w")).when(F.col("wide"), pairs).otherwise(F.array_distinct(pairs))
    pairs = words.select("row", "doc_id", "wide", "unit", pairs.alias("b"))
    pairs = pairs.withColumn("n", F.size("b").cast("long")).where(F.col("wide") | F.col("n").between(least, most))
    hits = pairs.select("row", "doc_id", "wide", "unit", "n", F.posexplode("b").alias("pos", "bigram")).join(F.broadcast(index), "bigram").where("wide or n between least and most")
    # Windows go by the stretch of the notice's length that they begin in, with all that they may reach.
    stretch = F.floor(F.col("pos") / F.col("length"))
    hits = hits.withColumn("at", F.explode(F.when(F.col("wide"), F.array(stretch, stretch - 1)).otherwise(F.array(F.lit(0).cast("long"))))).where("at >= 0")
    keys = ["row", "doc_id", "wide", "unit", "n", "notice", "license", "size", "least", "length", "at"]
    both = hits.groupBy(*keys).agg(F.count("*").alias("common"), F.collect_list(F.when(F.col("wide"), F.struct("pos", "bigram"))).alias("hits"))
    both = both.where("not wide or common >= least").where("not wide or size(array_distinct(hits.bigram)) >= least")

    def window(start) -> Column:
        """The Dice coefficient, null below the threshold, and twice the middle of the window that begins with this hit."""
        pos = start["pos"]
        inside = F.filter("hits", lambda h: (h["pos"] >= pos) & (h["pos"] < pos + F.col("length")))
        common = F.size(F.array_distinct(F.transform(inside, lambda h: h["bigram"])))
        total = common + F.least("length", F.col("n") - pos) - F.size(inside) + F.col("size")
        return F.struct(F.when(2 * den * common >= num * total, F.round(2.0 * common / total, 6)).alias("dice"), (2 * pos + F.col("length")).cast("long").alias("middle"))

    begins = F.filter("hits", lambda h: F.floor(h["pos"] / F.col("length")) == F.col("at"))
    own = F.when(2 * den * F.col("common") >= num * (F.col("n") + F.col("size")), F.round(2.0 * F.col("common") / (F.col("n") + F.col("size")), 6))
    alone = F.struct(own.alias("dice"), F.lit(0).cast("long").alias("middle"))
    found = both.withColumn("m", F.when(F.col("wide"), F.array_max(F.transform(begins, window))).otherwise(alone)).where("m.dice is not null")
    reach = 2 * min((r[6] for r in rows), default=0)
    here = Window.partitionBy("row", "wide", "unit").orderBy("m.middle").rangeBetween(-reach, reach)
    found = found.withColumn("dice", F.col("m.dice")).withColumn("top", F.max("dice").over(here)).where("dice = top")
    of_units = F.when(~F.col("wide"), F.col("dice"))
    out = found.groupBy("row", "doc_id", "license").agg(F.coalesce(F.max(of_units), F.max("dice")).alias("dice"), F.count_distinct(F.when(~F.col("wide"), F.col("unit"))).alias("n_units"))
    return out.drop("row")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, table(spark, sf_dir, "documents"))


def sql(notices=NOTICES, config: Licenses = Licenses()) -> str:
    num, den = config.threshold
    values = ", ".join("({}, '{}', {}, '{}')".format(i, licence, size, b) for i, licence, size, _, _, b in _notice_rows(notices, config))
    return f"""
WITH idx(notice, license, size, bigram) AS (VALUES {values}),
d AS (SELECT row_number() OVER () AS r, doc_id, replace(text, chr(13) || chr(10), chr(10)) AS t FROM documents WHERE text IS NOT NULL),
u AS (SELECT r, doc_id, unnest(list_distinct(list_concat(list_concat(string_split(t, chr(10)), regexp_split_to_array(t, '\\n[ \\t]*\\n')), [t]))) AS unit FROM d),
w AS (SELECT r, doc_id, row_number() OVER () AS k, string_split(trim(regexp_replace(lower(unit), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM u),
b AS (SELECT r, doc_id, k, CASE WHEN len(w) > 1 THEN list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) ELSE w END AS b FROM w),
e AS (SELECT r, doc_id, k, len(b) AS n, unnest(b) AS bigram FROM b),
c AS (SELECT r, doc_id, k, n, notice, license, size, count(*) AS common FROM e JOIN idx USING (bigram) GROUP BY ALL),
m AS (SELECT r, doc_id, k, license, round(2.0 * common / (n + size), 6) AS dice FROM c WHERE 2 * {den} * common >= {num} * (n + size)),
t AS (SELECT *, max(dice) OVER (PARTITION BY k) AS top FROM m)
SELECT doc_id, license, max(dice) AS dice, count(DISTINCT k) AS n_units FROM t WHERE dice = top GROUP BY r, doc_id, license"""
