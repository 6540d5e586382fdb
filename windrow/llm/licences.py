"""Licence scans: sparse TF-IDF cosine to templates, and inheritance by directory.

Licence tags and the wording of known headers, titles and conditions count wherever they stand,
across comment signs and line ends. Besides, every line of a file and every sentence of it is a
candidate header for the cosine, a licence file's whole text is one more. Terms are
weighed by how few templates have them; a term that no template has weighs most. A file whose
best candidate is near enough to a template has that licence. A file without one takes that of
the nearest directory above it, or its own, that a licensed file declares.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from windrow.llm import common
from windrow.session import materialise

#: Least cosine of a candidate to a template.
LEAST = 0.6

#: Headers by which licences are declared; a parameter of the scan.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "MIT": "Released under the MIT License.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD 3-Clause License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Proprietary": "All rights reserved.",
}

#: Further wordings, found as these words in a row.
_LATER = "as published by the Free Software Foundation, either version"
WORDINGS = {
    "Apache-2.0": ["Apache License Version 2.0, January 2004"],
    "CC-BY-4.0": ["Creative Commons Attribution 4.0 International"],
    "CC-BY-NC-4.0": ["Creative Commons Attribution-NonCommercial 4.0 International"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International"],
    "CC0-1.0": ["CC0 1.0 Universal", "Licensed under CC0 1.0"],
    "GPL-2.0": ["GNU General Public License Version 2, June 1991", f"GNU General Public License {_LATER} 2"],
    "GPL-3.0": ["GNU General Public License Version 3, 29 June 2007", f"GNU General Public License {_LATER} 3"],
    "LGPL-2.1": ["GNU Lesser General Public License Version 2.1", f"GNU Lesser General Public License {_LATER} 2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License Version 3", f"GNU Lesser General Public License {_LATER} 3"],
    "AGPL-3.0": ["GNU Affero General Public License Version 3, 19 November 2007", f"GNU Affero General Public License {_LATER} 3"],
    "MIT": [
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted",
    ],
    "BSD-3-Clause": ["may be used to endorse or promote products derived from this software without specific prior written permission"],
    "MPL-2.0": ["Mozilla Public License Version 2.0"],
}

#: Wordings that count when nothing of the above is found: titles without a version, as whole
#: lines, and conditions that a longer licence has too.
TITLES = {
    "GPL": "GNU General Public License",
    "LGPL": "GNU Lesser General Public License",
    "AGPL": "GNU Affero General Public License",
    "MIT": "(The )?MIT License",
    "ISC": "ISC License",
}
SHARED = {
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met"
}

#: What a candidate must have to declare the version, and the licence that it declares without.
VERSIONS = {"GPL-2.0": ("2", "GPL"), "GPL-3.0": ("3", "GPL"), "BSD-3-Clause": ("3", "BSD")}

#: A notice that other licences have too counts last.
LAST = "Proprietary"

_TAG = r"(?i)SPDX-License-Identifier:\s*(\(?[a-z0-9.+-]*[a-z0-9+]\)*(?:\s+(?:AND|OR|WITH)\s+\(*[a-z0-9.+-]*[a-z0-9+]\)*)*)"

#: Names of files whose whole text is a candidate too.
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)([.-].*)?$"

_TERM = r"[a-z0-9]+(?:[.][0-9]+)*"


def _terms(text: str) -> Counter:
    return Counter(re.findall(_TERM, text.lower()))


class Templates:
    """Weights of terms, unit vectors of templates, and the terms that decide.

    By Cauchy's inequality a cosine of ``least`` needs shared terms with that share of a
    template's length. ``deciding`` holds each template's longest terms, which texts rarely have,
    as many as leave less than that to all others: a candidate without any of them is not near.
    """

    def __init__(self, templates: dict[str, str], least: float):
        counts = {name: _terms(t) for name, t in templates.items()}
        seen = Counter(t for c in counts.values() for t in c)
        n = len(templates)
        self.idf = {t: math.log((1 + n) / (1 + k)) + 1 for t, k in seen.items()}
        self.unseen = math.log(1 + n) + 1
        self.rows, self.deciding = [], set()
        for name, c in counts.items():
            weights = {t: k * self.idf[t] for t, k in c.items()}
            size = math.sqrt(sum(w * w for w in weights.values()))
            self.rows += [(name, t, w / size) for t, w in weights.items()]
            rest = 1.0
            for t, w in sorted(weights.items(), key=lambda x: (-len(x[0]), -x[1], x[0])):
                if rest < least * least:
                    break
                self.deciding.add(t)
                rest -= (w / size) ** 2

    def may_be_near(self, terms: str, least: float) -> Column:
        """Do the shared terms of some template have the share of its length that a cosine needs?"""

        def near(held: Column) -> Column:
            return self._near(held, least)

        # As a lambda's argument the terms are worked out once, not once for each term.
        return F.exists(F.array(terms), near)

    def _near(self, held: Column, least: float) -> Column:
        near = F.lit(False)
        for name in sorted({n for n, _, _ in self.rows}):
            shared = [F.when(F.array_contains(held, t), w * w).otherwise(0.0) for n, t, w in self.rows if n == name]
            total = shared[0]
            for x in shared[1:]:
                total = total + x
            # Rounding must not lose one that just reaches it.
            near |= total >= least * least - 1e-9
        return near

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(n, t, share, n not in VERSIONS or VERSIONS[n][0] == t) for n, t, share in self.rows]
        return spark.createDataFrame(rows, "licence string, term string, share double, sure boolean")


def _terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({_TERM})"), F.lit(1))


def _in_a_row(wording: str) -> str:
    """A pattern of these words with anything but letters and digits between them."""
    return "[^a-z0-9]+".join(re.escape(t) for t in re.findall(_TERM, wording.lower()))


def worded(files: DataFrame, templates: dict[str, str]) -> DataFrame:
    """(path, licence, similarity, rank) of the tags, wordings and titles in files (path, text)."""
    low = F.lower("text")
    rows = files.where(low.rlike("licen[cs]e|permission|redistribution|rights|creative|cc0"))
    rows = rows.select("path", "text", low.alias("low"))
    found = []
    for name in sorted({*templates, *WORDINGS}):
        ways = [templates[name]] if name in templates else []
        ways = "|".join(_in_a_row(w) for w in [*ways, *WORDINGS.get(name, [])])
        found.append((name, f"(?<![a-z0-9])({ways})(?![a-z0-9]|[.][0-9])", 3 if name == LAST else 1))
    for name, title in TITLES.items():
        found.append((name, "(?m)^[^a-z0-9\n]*" + title.lower().replace(" ", "[^a-z0-9\n]+") + "[^a-z0-9\n]*$", 2))
    found += [(name, _in_a_row(wording), 2) for name, wording in SHARED.items()]
    marks = [F.when(F.col("low").rlike(p), F.struct(F.lit(n).alias("licence"), F.lit(r).alias("rank"))) for n, p, r in found]
    tag = F.regexp_replace(F.regexp_extract("text", _TAG, 1), r"(?i)(-only|-or-later|\+)(?=$|[\s)])", "")
    marks.append(F.when(tag != "", F.struct(tag.alias("licence"), F.lit(0).alias("rank"))))
    return rows.select("path", F.explode(F.array_compact(F.array(*marks))).alias("m")).select(
        "path", "m.licence", F.lit(1.0).alias("similarity"), "m.rank"
    )


def own_licences(files: DataFrame, templates: dict[str, str] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """(path, licence, similarity) of the files (path, text) that declare one; the nearest template's.

    Only candidates with a deciding term are taken apart, which loses none. The vectors are
    rows of candidate and term; the cosine is a join on the term and a sum.
    """
    known = Templates(templates, least)
    spark = files.sparkSession
    sign = r"(?i)(^|[^a-z0-9])(" + "|".join(sorted(re.escape(t) for t in known.deciding)) + r")($|[^a-z0-9])"
    name = F.substring_index("path", "/", -1)
    whole = F.when(name.rlike(LICENCE_FILE), F.array("text")).otherwise(F.array().cast("array<string>"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(sign))
    sentences = F.filter(F.flatten(F.transform(lines, lambda x: F.split(x, r"(?<=[.;!?])\s+"))), lambda x: x.rlike(sign))
    lines = F.concat(lines, sentences, whole)
    # Copies of a file at one path are one file to the directories, so equal rows may meet here.
    found = files.where(F.col("text").rlike(sign)).select("path", F.explode(F.array_distinct(lines)).alias("line"))
    # What can't be near goes before anything is shuffled.
    found = found.select("path", F.xxhash64("path", "line").alias("unit"), _terms_of(F.col("line")).alias("terms"))
    found = found.withColumn("kinds", F.array_distinct("terms")).where(known.may_be_near("kinds", least))
    terms = found.select("path", "unit", F.explode("terms").alias("term"))
    vectors = terms.groupBy("path", "unit", "term").agg(F.count("*").alias("n"))
    weights = F.broadcast(spark.createDataFrame(sorted(known.idf.items()), "term string, idf double"))
    vectors = vectors.join(weights, "term", "left")
    vectors = vectors.withColumn("w", F.col("n") * F.coalesce("idf", F.lit(known.unseen)))
    sizes = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("path", "unit")))
    vectors = vectors.withColumn("share_here", F.col("w") / sizes)
    # One row for each term of a template; the templates are a parameter.
    near = vectors.join(F.broadcast(known.frame(spark)), "term").groupBy("path", "unit", "licence")
    near = near.agg(
        F.round(F.sum(F.col("share_here") * F.col("share")), 6).alias("similarity"), F.max("sure").alias("sure")
    )
    without = F.coalesce(*[F.when(F.col("licence") == n, F.lit(w)) for n, (_, w) in VERSIONS.items()], "licence")
    rank = F.when(F.col("licence") == LAST, 3).when(F.col("sure"), 1).otherwise(2)
    near = near.where(F.col("similarity") >= least).select(
        "path", F.when(F.col("sure"), F.col("licence")).otherwise(without).alias("licence"), "similarity", rank.alias("rank")
    )
    best = F.min_by(F.struct("licence", "similarity"), F.struct("rank", -F.col("similarity"), F.col("licence")))
    near = near.unionByName(worded(files, templates)).groupBy("path").agg(best.alias("b"))
    return near.select("path", "b.licence", "b.similarity")


def _above(path: Column) -> Column:
    """The directories above a path, each with its depth; the top is ''."""
    parts = F.split(path, "/")
    return F.transform(
        F.sequence(F.lit(0), F.size(parts) - 1),
        lambda k: F.struct(F.array_join(F.slice(parts, 1, k), "/").alias("directory"), k.alias("depth")),
    )


def scan(
    files: DataFrame, path: str, text: str, templates: dict[str, str] = TEMPLATES, least: float = LEAST
) -> DataFrame:
    """path, licence, similarity, declared_by, inherited; one row for each row of ``files``.

    A file that declares a licence declares it for its directory too; of several in a
    directory the most similar counts, then the smallest path. A file without one inherits from
    the nearest directory above it that has one, else its licence is null. A null path stands
    by itself: it declares for nobody and inherits nothing. Null and empty texts declare
    nothing. Repeated rows get equal results; an empty table gives an empty result.
    """
    rows = files.select(F.col(path).alias("path"), F.col(text).alias("text"))
    named = rows.where("path IS NOT NULL AND text IS NOT NULL")
    own = materialise(own_licences(named, templates, least), "licences")
    own = own.select("path", F.struct("licence", "similarity", F.col("path").alias("declared_by")).alias("own"))
    home = F.regexp_replace("path", "/?[^/]*$", "")
    declared = own.groupBy(home.alias("directory")).agg(
        F.min_by("own", F.struct(-F.col("own.similarity"), F.col("path"))).alias("from")
    )
    # Narrow rows: paths only. A directory that holds a third of all files is a hot key of this
    # join, on the side that adaptive execution can split; its other side has it once.
    paths = rows.where("path IS NOT NULL").select("path")
    homes = paths.select(home.alias("home")).distinct()
    climbs = homes.select("home", F.explode(_above(F.concat(F.col("home"), F.lit("/x")))).alias("a"))
    heirs = climbs.join(declared, F.col("a.directory") == F.col("directory")).groupBy("home")
    heirs = heirs.agg(F.max_by("from", "a.depth").alias("above"))
    out = rows.select("path", home.alias("_home")).join(own.withColumnRenamed("path", "_path"), F.col("path") == F.col("_path"), "left")
    out = out.join(heirs, F.col("_home") == F.col("home"), "left")
    given = F.coalesce("own", "above")
    return out.select(
        "path",
        given["licence"].alias("licence"),
        given["similarity"].alias("similarity"),
        given["declared_by"].alias("declared_by"),
        (F.col("own").isNull() & F.col("above").isNotNull()).alias("inherited"),
    )
