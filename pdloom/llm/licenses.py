"""License scan by sparse TF-IDF cosine to templates, then inheritance by path joins (operator 6),
with Spark expressions only.

Headers of a text are its lines, sentences and blocks of adjacent lines that speak of licensing;
each, and the whole text without its copyright lines, becomes a bag of terms weighted by inverse
document frequency over the headers of all files, and is joined with the terms of the templates:
declaring sentences, whole licence texts and their paragraphs. A file whose whole text is near
a template is a licence file; files without a licence of their own take the one of the licence
file in the nearest directory above them.
"""

from __future__ import annotations

import re
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pdloom.llm.common import counted_broadcast, stored

# Sentences by which licences are declared.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, version 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("Proprietary", "All rights reserved."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file"
        " except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed"
        " to in writing, software distributed under the License is distributed on an AS IS BASIS,"
        " WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License"
        " for the specific language governing permissions and limitations under the License.",
    ),
    ("ISC", "Released under the ISC License."),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
]
#: Whole texts of licences, one file each named by the licence.
TEXTS = Path(__file__).with_name("license_texts")
#: Words up to which the paragraphs of a whole text are templates too, as headers hold them.
HEADER_TEXT = 400
#: A sentence with one of these in lower case is a header.
TRIGGERS = (
    "licen", "copyright", "rights reserved", "spdx", "permission is hereby", "redistribution and",
    "public domain", "permission to use",
)
COSINE = 0.75
#: Cosine of a file's whole text that makes it a licence file.
FILE_COSINE = 0.75
#: A line that names a holder only, up to an "all rights reserved".
_HOLDER = r"(?im)^[\s/*#;%>-]*(?:copyright\b|\(c\)|©).*?(?=all rights reserved|$)"


@cache
def templates() -> tuple[tuple[str, str], ...]:
    """Licence and words of every template."""
    found = list(TEMPLATES)
    for path in sorted(TEXTS.glob("*.txt")):
        text = path.read_text(encoding="utf-8")
        found.append((path.stem, text))
        if len(text.split()) <= HEADER_TEXT:
            parts = [p for p in re.split(r"\n[ \t]*\n", text) if len(p.split()) > 9]
            found += [(path.stem, p) for p in parts if any(t in p.lower() for t in TRIGGERS)]
    return tuple((name, " ".join(re.findall(r"[^\W_]+", text))) for name, text in found)


def _triggered(text: Column) -> Column:
    low = F.lower(text)
    found = low.contains(TRIGGERS[0])
    for trigger in TRIGGERS[1:]:
        found = found | low.contains(trigger)
    return found


def _terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def _weights(units: DataFrame, keys: list[str]) -> DataFrame:
    """A row per unit and term with the number of times it is there."""
    return units.select(*keys, F.explode(_terms(F.col("unit"))).alias("term")).groupBy(
        *keys, "term"
    ).agg(F.count("*").alias("tf"))


def _units(text: Column) -> Column:
    """(kind, unit) of a text: its headers by line, by block of lines, and the whole of it, each
    as its terms with a space between."""

    def pieces(of: Column, pattern: str) -> Column:
        return F.filter(F.split(of, pattern), lambda s: _triggered(s))

    def plain(units: Column) -> Column:
        told = F.transform(units, lambda u: F.array_join(_terms(u), " "))
        return F.array_distinct(F.filter(told, lambda u: u != ""))

    def kind(name: str, units: Column) -> Column:
        return F.transform(units, lambda u: F.struct(F.lit(name).alias("kind"), u.alias("unit")))

    sentence = r"(?<=[.!?])[ \t]+"
    blocks = F.transform(
        pieces(text, r"\n[ \t\r]*\n"),
        lambda s: F.regexp_replace(s, r"\s*\n[\s/*#;%>-]*", " "),
    )
    wrapped = F.flatten(F.transform(blocks, lambda s: pieces(s, sentence)))
    lines = plain(pieces(text, r"\n|" + sentence))
    whole = plain(F.array(F.regexp_replace(text, _HOLDER, " ")))
    # What is there as a line or as the whole gives nothing more as a block.
    block = F.array_except(plain(F.concat(wrapped, blocks)), F.concat(lines, whole))
    return F.concat(kind("line", lines), kind("block", block), kind("whole", whole))


def scan_headers(files: DataFrame, id_column: str = "file_id") -> DataFrame:
    """Best template per file with headers: license, cosine, and is_file where the whole text is
    that near; a whole text counts before a header."""
    spark = files.sparkSession
    headers = stored(
        files.where(_triggered(F.col("text")))
        .select(id_column, F.inline(_units(F.col("text"))))
        .withColumn("key", F.unhex(F.md5("unit"))),
        "license-headers",
    )
    # Equal units are weighed once, however many files hold them; frequencies are those of lines.
    of_line = headers.where("kind = 'line'").groupBy("key").agg(
        F.countDistinct(id_column).alias("files")
    )
    units = headers.groupBy("key").agg(F.max("unit").alias("unit"))
    units = units.join(of_line, "key", "left").na.fill(0, ["files"])
    rows = stored(_weights(units, ["key", "files"]), "license-terms")
    n_files = headers.select(id_column).distinct().count()
    frequency = rows.where("files > 0").groupBy("term").agg(F.sum("files").alias("df"))
    idf = F.log(F.lit(n_files + 1) / (F.least(F.coalesce("df", F.lit(0)), F.lit(n_files)) + 1)) + 1
    frequency = counted_broadcast(frequency, frequency.count())
    values = ", ".join(f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(templates()))
    known = spark.sql(f"select * from values {values} as t(template, license, unit)")
    known = _weights(known, ["template", "license"]).join(frequency, "term", "left")
    known = known.withColumn("weight", F.col("tf") * idf)
    whole = Window.partitionBy("template")
    # As many rows as the templates have terms, a number fixed above.
    known = F.broadcast(
        known.withColumn("norm", F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(whole)))
        .select("template", "license", "term", (F.col("weight") / F.col("norm")).alias("share"))
    )
    weighed = rows.join(frequency, "term", "left").withColumn("weight", F.col("tf") * idf)
    norms = weighed.groupBy("key").agg(
        F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm")
    )
    best = (
        weighed.join(known, "term")
        .groupBy("key", "template", "license")
        .agg(F.sum(F.col("weight") * F.col("share")).alias("dot"))
        .join(norms, "key")
        .select("key", "license", F.round(F.col("dot") / F.col("norm"), 9).alias("cosine"))
        .groupBy("key")
        .agg(F.min(F.struct((-F.col("cosine")).alias("less"), "license")).alias("best"))
        .select(F.col("key").alias("_key"), (-F.col("best.less")).alias("cosine"), "best.license")
        .where(F.col("cosine") >= min(COSINE, FILE_COSINE))
    )
    part = F.col("kind") != "whole"
    return (
        headers.join(counted_broadcast(best, best.count()), F.col("key") == F.col("_key"))
        .where(F.col("cosine") >= F.when(part, COSINE).otherwise(FILE_COSINE))
        .groupBy(id_column)
        .agg(F.min(F.struct(part.alias("part"), (-F.col("cosine")).alias("less"), "license")).alias("best"))
        .select(
            id_column,
            F.col("best.license").alias("license"),
            (-F.col("best.less")).alias("cosine"),
            (~F.col("best.part")).alias("is_file"),
        )
    )


def _directories(path: Column) -> Column:
    """Directories above a path from the top one, which is empty, downwards."""
    parts = F.split(path, "/")
    return F.transform(
        F.sequence(F.lit(0), F.size(parts) - 1),
        lambda n: F.array_join(F.slice(parts, 1, n), "/"),
    )


def license_scan(files: DataFrame) -> DataFrame:
    """One row per row of ``files``: file_id, path, license, basis, cosine and license_path.

    ``files`` has file_id, path and text; other columns are ignored. basis is ``header`` or
    ``file`` for a licence of the file's own, ``directory`` for an inherited one, else ``none``.
    Null or empty texts have no header; a null path has no directory and inherits nothing; of
    equal cosines the first name counts; of several licence files in a directory the one with
    the highest cosine, then the first path. Rows that repeat a file_id share their headers. An
    empty table gives no row.
    """
    found = stored(scan_headers(files), "license-found")
    own = files.select("file_id", "path").join(
        counted_broadcast(found, found.count()), "file_id", "left"
    )
    scanned = stored(
        own.select(
            "file_id",
            "path",
            "license",
            "cosine",
            F.coalesce("is_file", F.lit(False)).alias("is_file"),
        ),
        "license-scanned",
    )
    above = F.element_at(_directories(F.col("path")), -1)
    sources = (
        scanned.where("is_file and path is not null")
        .groupBy(above.alias("directory"))
        .agg(F.min(F.struct((-F.col("cosine")).alias("less"), "path", "license")).alias("top"))
    )
    n_sources = sources.count()
    lacking = scanned.where("license is null and path is not null").select("path").distinct()
    nearest = (
        lacking.select("path", F.posexplode(_directories(F.col("path"))).alias("depth", "directory"))
        .join(counted_broadcast(sources, n_sources), "directory")
        .groupBy("path")
        .agg(F.max(F.struct("depth", "top")).alias("near"))
        .select(
            F.col("path").alias("_path"),
            F.col("near.top.license").alias("_license"),
            F.col("near.top.path").alias("_from"),
        )
    )
    inherits = F.col("license").isNull() & F.col("_license").isNotNull()
    return scanned.join(nearest, F.col("path") == F.col("_path"), "left").select(
        "file_id",
        "path",
        F.coalesce("license", "_license").alias("license"),
        F.when(F.col("is_file"), "file")
        .when(F.col("license").isNotNull(), "header")
        .when(inherits, "directory")
        .otherwise("none")
        .alias("basis"),
        "cosine",
        F.when(inherits, F.col("_from")).when(F.col("license").isNotNull(), F.col("path")).alias(
            "license_path"
        ),
    )
