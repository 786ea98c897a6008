"""Licence scan: sparse TF-IDF cosine of lines to licence templates, then inheritance from the nearest directory.

A line's terms are its runs of ASCII letters and digits, lower-cased, each counted once. Weights come from the template
collection: idf(t) = ln((1 + templates) / (1 + templates with t)) + 1; a term of no template has the largest idf. Every
line of a text is compared. A file with a line similar enough has that licence. Other files take over the licence of the
nearest directory above them that holds a licence file (LICENSE, LICENCE, COPYING, NOTICE) with one. All of it is
DataFrame functions.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewake.llm.frames import column, store
from tradewake.llm.line_dedup import LOWER, UPPER

#: Customary licence lines.
TEMPLATES = {
    "AGPL-3.0": "This program is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Redistributed under the two-clause BSD License.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work. CC0 1.0 Universal.",
    "EPL-2.0": "This program is made available under the terms of the Eclipse Public License 2.0.",
    "GPL-2.0": "This program is free software under the terms of the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Permission to use, copy, modify, and distribute this software is granted under the ISC License.",
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
LICENCE_FILE = r"(?i)^(license|licence|copying|notice)([.-].*)?$"
SCALE = 1_000_000


def terms(text: str) -> list[str]:
    return sorted(set(re.findall("[a-z0-9]+", text.lower())))


def weights() -> tuple[dict[str, int], int]:
    """Squared idf of the templates' terms, and that of any other term, as integers of SCALE so that sums are exact."""
    n = len(TEMPLATES)
    held = [terms(t) for t in TEMPLATES.values()]
    idf = lambda k: round(SCALE * (math.log((1 + n) / (1 + k)) + 1) ** 2)
    return {t: idf(sum(t in h for h in held)) for t in sorted(set().union(*held))}, idf(0)


def _sum(items: F.Column, weight) -> F.Column:
    return F.aggregate(items, F.lit(0).cast("long"), lambda a, t: a + weight(t))


def detect(files: DataFrame, key: list[str], text_col: str, least: float) -> DataFrame:
    """(key, license, score): the template most similar to any line of a file, if ``least`` similar; ties go by name."""
    known, other = weights()
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    weight = lambda t: F.coalesce(F.element_at(table, t), F.lit(other)).cast("long")
    mass = {name: sum(known[t] for t in terms(text)) for name, text in TEMPLATES.items()}
    vocabulary = F.array(*[F.lit(t) for t in known])
    lines = (
        files.select(*key, F.explode(F.split(column(text_col), "\n")).alias("line"))
        .select(*key, F.array_distinct(F.array_remove(F.split(F.translate("line", UPPER, LOWER), "[^a-z0-9]+"), "")).alias("terms"))
        .withColumn("hits", F.array_intersect("terms", vocabulary))
        # cosine >= least needs a shared mass of least ** 2 times the template's
        .withColumn("shared", _sum(F.col("hits"), weight)).where(F.col("shared") >= least * least * min(mass.values()))
        .withColumn("whole", F.col("shared") + (F.size("terms") - F.size("hits")).cast("long") * F.lit(other))
        .where("shared >= whole * %r" % (least * least))
    )
    scored = [
        F.struct(
            F.round(_sum(F.array_intersect("hits", F.array(*[F.lit(t) for t in terms(text)])), weight) / F.sqrt(F.col("whole") * F.lit(float(mass[name]))), 6).alias("score"),
            F.lit(-k).alias("order"), F.lit(name).alias("license"))
        for k, (name, text) in enumerate(sorted(TEMPLATES.items()))
    ]
    best = lines.select(*key, F.greatest(*scored).alias("best")).where(F.col("best.score") >= least)
    return best.groupBy(*key).agg(F.max("best").alias("best")).select(*key, "best.license", "best.score")


def scan(files: DataFrame, id_col: str = "id", path_col: str = "path", text_col: str = "text", least: float = 0.8) -> DataFrame:
    """(id, path, license, score, origin, origin_dir), a row for each distinct (id, path).

    origin is 'own' for a licence line in the file itself, 'inherited' for one from ``origin_dir``, the nearest directory
    above (or of) the file with a licence file in which a line was found, else null with a null licence. Of several licence
    files in one directory the most similar counts, then the first by name of licence. Null texts hold no line; files
    with a null path inherit nothing. Empty input gives an empty result.

    Lines that cannot reach ``least`` are left out before anything is shuffled. Inheritance is looked up once for each
    directory, not for each file.
    """
    rows = files.select(column(id_col).alias("id"), column(path_col).alias("path"), column(text_col).alias("text"))
    found = store(detect(rows, ["id", "path"], "text", least), "license-lines")
    names = rows.select("id", "path").distinct()
    # ids and paths may be null, and a null must meet a null
    both = F.struct(F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("id").isNull(), F.coalesce("path", F.lit("")), F.col("path").isNull())
    keyed = found.select(both.alias("k"), "license", "score")
    names = names.withColumn("k", both)
    folder = F.regexp_replace(F.regexp_extract("path", "^(.*)/[^/]*$", 1), "/+$", "")
    own = store(names.join(keyed, "k", "left").drop("k").withColumn("dir", folder), "license-files")
    base = F.regexp_extract("path", "([^/]*)$", 1)
    holders = (
        own.where(F.col("license").isNotNull() & base.rlike(LICENCE_FILE))
        .groupBy(F.col("dir").alias("origin_dir")).agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("license").alias("name"))).alias("top"))
        .select("origin_dir", F.col("top.name").alias("given"), (-F.col("top.s")).alias("given_score"))
    )
    dirs = own.where("license IS NULL AND dir IS NOT NULL").select("dir").distinct()
    parts = F.split("dir", "/")
    above = dirs.select("dir", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))).alias("origin_dir"))
    nearest = (
        above.distinct().join(holders, "origin_dir")
        .groupBy("dir").agg(F.max(F.struct(F.length("origin_dir").alias("n"), "origin_dir", "given", "given_score")).alias("from"))
        .select("dir", "from.origin_dir", "from.given", "from.given_score")
    )
    mine = F.col("license").isNotNull()
    return own.join(nearest, "dir", "left").select(
        "id", "path", F.coalesce("license", "given").alias("license"), F.when(mine, F.col("score")).otherwise(F.col("given_score")).alias("score"),
        F.when(mine, "own").when(F.col("given").isNotNull(), "inherited").alias("origin"), F.when(~mine, F.col("origin_dir")).alias("origin_dir"),
    )
