"""Operator 5: find licences by TF-IDF cosine to templates, and inherit them along directories (DataFrame functions only).

A text's segments are each of its lines and the whole text. A segment's vector has the counts of its words times their
inverse document frequency ``ln((documents + 1) / (documents with the word + 1)) + 1``, taken over all documents for the
words of the templates; a word of no template weighs as one that no document has. A file's own licence is the template
with the largest cosine over its segments, at ``header_cosine`` or more. A file whose whole text reaches
``file_cosine`` is a licence file of its directory. A file without a licence of its own inherits from the nearest
directory above it (its own first) that has a licence file.

Templates are a parameter: notices, and whole licence texts, of which ``read_templates`` reads more from a folder. Their
size is bounded (``MAX_TEMPLATE_WORDS`` distinct words, summed over the templates; checked), so their weights may be
broadcast.

Only texts and lines that can reach the cosine are vectorised. By Cauchy-Schwarz the words that a segment shares with a
template carry at least the squared threshold of the template's squared length, and the words of a line are words of its
text; so texts are chosen by joining their template words with the squared weights, and lines by anchors: the words that
are left when the most common ones, together below that share, are taken out. Both are exact. Directories are joined
once each, and a directory may hold any share of all files.

Defined cases: null or empty texts have no licence of their own and may inherit; a null path is in no directory; equal
cosines go to the alphabetically first licence; of licence files in one directory the largest cosine, then the first
licence, then the first path counts; repeated rows are judged alike. Other columns are kept, whatever their names;
license, cosine and license_from are replaced."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm.scratch import Scratch

MAX_TEMPLATE_WORDS = 20_000
WORD_GAP = "[^a-z0-9]+"

#: Licence id and the text of its usual notice, or of its licence file.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MIT", """MIT License. Copyright (c). Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("BSD-3-Clause", """Copyright (c). All rights reserved. Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("ISC", """ISC License. Copyright (c). Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), WORD_GAP), lambda w: w != "")


def _template_counts(templates) -> list[dict[str, int]]:
    import re
    out = []
    for _, text in templates:
        counts: dict[str, int] = {}
        for w in re.split(WORD_GAP, text.lower()):
            if w:
                counts[w] = counts.get(w, 0) + 1
        out.append(counts)
    return out


def read_templates(spark: SparkSession, *paths: str) -> list[tuple[str, str]]:
    """(licence id, text) of whole licence files: the id is the file's name without ``.txt``. Add them to TEMPLATES."""
    rows = spark.read.text(list(paths), wholetext=True).select(F.regexp_extract(F.input_file_name(), "([^/]+?)([.]txt)?$", 1).alias("name"), "value")
    return sorted((r["name"], r["value"]) for r in rows.collect())  # templates; their size is checked where they are used


def _anchors(counts: list[dict[str, int]], idf: dict[str, float], least: float) -> list[str]:
    """Words of which a segment at cosine ``least`` to any template has one: of each template all but its most common
    words that together carry less than ``least`` squared of its squared length."""
    out = set()
    for c in counts:
        spare = least * least * sum((n * idf[w]) ** 2 for w, n in c.items()) * (1 - 1e-9)
        for w in sorted(c, key=lambda w: (idf[w], w)):
            spare -= (c[w] * idf[w]) ** 2
            if spare <= 0:
                out.add(w)
    return sorted(out)


def segment_cosines(files: DataFrame, scratch: Scratch, templates=TEMPLATES, least: float = 0.6) -> DataFrame:
    """(_id, segment, license, cosine) of segments at ``least`` or more; segment 0 is the whole text, lines count from
    1. ``files`` has _id, which names a text, and text; rows may repeat."""
    spark = files.sparkSession
    counts = _template_counts(templates)
    vocabulary = sorted({w for c in counts for w in c})
    if sum(map(len, counts)) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"{sum(map(len, counts))} words in all templates; at most {MAX_TEMPLATE_WORDS}")
    files = files.where("text is not null")
    have = F.array_intersect(_words(F.col("text")), F.array(*map(F.lit, vocabulary))) if vocabulary else F.array().cast("array<string>")
    have = scratch.save(files.select("_id", have.alias("have")).groupBy("_id").agg(F.first("have").alias("have")), "have")
    documents = have.count()
    found = have.select("_id", F.explode("have").alias("w"))
    df = {r["w"]: r["n"] for r in found.groupBy("w").agg(F.count("*").alias("n")).collect()}  # one row a template word
    weight = lambda n: math.log((documents + 1) / (n + 1)) + 1
    idf = {w: weight(df.get(w, 0)) for w in vocabulary}
    lengths = {i: math.sqrt(sum((n * idf[w]) ** 2 for w, n in c.items())) for i, c in enumerate(counts)}
    weights = spark.createDataFrame([(w, i, n * idf[w] / lengths[i]) for i, c in enumerate(counts) for w, n in c.items()], "w string, template int, y double")
    can = found.join(F.broadcast(weights), "w").groupBy("_id", "template").agg(F.sum(F.col("y") * F.col("y")).alias("shared"))
    can = scratch.save(can.where(F.col("shared") >= least * least * (1 - 1e-9)).select("_id").distinct(), "can")
    anchors = _anchors(counts, idf, least)
    has_anchor = lambda c: F.arrays_overlap(_words(c), F.array(*map(F.lit, anchors)))

    hit = files.join(can, "_id", "left_semi").groupBy("_id").agg(F.first("text").alias("text")) if anchors else files.limit(0)
    segments = hit.select("_id", F.posexplode(F.concat(F.array("text"), F.split("text", "\n"))).alias("segment", "part")).where(has_anchor(F.col("part")))
    terms = segments.select("_id", "segment", F.explode(_words(F.col("part"))).alias("w")).groupBy("_id", "segment", "w").agg(F.count("*").alias("tf"))
    words = spark.createDataFrame([(w, x) for w, x in idf.items()], "w string, idf double")
    terms = terms.join(F.broadcast(words), "w", "left").withColumn("x", F.col("tf") * F.coalesce("idf", F.lit(weight(0))))
    products = terms.join(F.broadcast(weights), "w").groupBy("_id", "segment", "template").agg(F.sum(F.col("x") * F.col("y")).alias("dot"))
    norms = terms.groupBy("_id", "segment").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    names = F.element_at(F.array(*(F.lit(n) for n, _ in templates)), F.col("template") + 1)
    return products.join(norms, ["_id", "segment"]).select("_id", "segment", names.alias("license"), F.round(F.col("dot") / F.col("norm"), 6).alias("cosine")).where(F.col("cosine") >= least)


def _parent(path: str) -> Column:
    """The directory of a path; the root is the empty string."""
    return F.regexp_replace(F.col(path), "/?[^/]*$", "")


def scan_licenses(files: DataFrame, templates=TEMPLATES, header_cosine: float = 0.6, file_cosine: float = 0.6) -> DataFrame:
    """``files`` (path, text and others) with license, cosine, and license_from: the path of the file it is from, which
    is the file's own path, or that of the licence file it inherits from, or null."""
    scratch = Scratch(files.sparkSession, "licenses")
    others = [c for c in files.columns if c.lower() not in ("license", "cosine", "license_from")]
    key = F.struct(*(F.xxhash64(F.lit(k), F.col("path").isNull(), "path", F.col("text").isNull(), "text").alias(f"h{k}") for k in (1, 2)))
    files = files.select(F.struct(*(F.col(f"`{c}`") for c in others)).alias("_row"), "path", "text", key.alias("_id"))
    scored = scratch.save(segment_cosines(files.select("_id", "text"), scratch, templates, min(header_cosine, file_cosine)), "cosines")
    first = lambda: F.min_by(F.struct("license", "cosine"), F.struct(-F.col("cosine"), F.col("license"))).alias("_own")
    own = scored.where(F.col("cosine") >= header_cosine).groupBy("_id").agg(first())
    whole = scored.where((F.col("segment") == 0) & (F.col("cosine") >= file_cosine)).groupBy("_id").agg(first())
    paths = files.select("_id", "path", _parent("path").alias("_dir")).where("path is not null")
    notices = paths.join(whole, "_id").select("_dir", F.struct("_own.license", "_own.cosine", "path").alias("_notice"))
    notices = notices.groupBy("_dir").agg(F.min_by("_notice", F.struct(-F.col("_notice.cosine"), F.col("_notice.license"), F.col("_notice.path"))).alias("_notice"))

    directories = paths.select("_dir").distinct()
    levels = F.split("_dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(levels)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(levels, 1, n), "/").alias("_above")))
    above = directories.select("_dir", F.explode(above).alias("at")).select("_dir", "at.depth", "at._above")
    nearest = above.join(notices.withColumnRenamed("_dir", "_above"), "_above").groupBy("_dir").agg(F.max_by("_notice", "depth").alias("_notice"))
    out = files.drop("text").withColumn("_dir", _parent("path")).join(own, "_id", "left").join(nearest, "_dir", "left")
    return out.select(*(F.col(f"_row.`{c}`") for c in others), F.coalesce("_own.license", "_notice.license").alias("license"),
                      F.coalesce("_own.cosine", "_notice.cosine").alias("cosine"),
                      F.when(F.col("_own").isNotNull(), F.col("path")).otherwise(F.col("_notice.path")).alias("license_from"))


def document_path() -> Column:
    """Documents carry no path; theirs is source, language, hundred and id."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("none"))
    return F.concat_ws("/", name("source"), name("lang"), F.floor(F.col("doc_id") / 100).cast("string"), F.col("doc_id").cast("string"))


def oracle_sql(templates=TEMPLATES, header_cosine: float = 0.6, file_cosine: float = 0.6) -> str:
    """The same result in DuckDB SQL, every line against every template."""
    rows = ",\n".join(f"({i}, '{name}', '{w}', {n})" for i, ((name, _), c) in enumerate(zip(templates, _template_counts(templates), strict=True)) for w, n in c.items())
    return f"""WITH t(template, license, w, n) AS (VALUES {rows}),
d AS (SELECT doc_id, text, concat_ws('/', coalesce(source, 'none'), coalesce(lang, 'none'), CAST(doc_id // 100 AS VARCHAR), CAST(doc_id AS VARCHAR)) AS path FROM documents),
df AS (SELECT w, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(string_split_regex(lower(text), '{WORD_GAP}')) AS w FROM d) WHERE w IN (SELECT w FROM t) GROUP BY w),
idf AS (SELECT v.w, ln(((SELECT count(text) FROM d) + 1) / (coalesce(df.n, 0) + 1)) + 1 AS idf FROM (SELECT DISTINCT w FROM t) v LEFT JOIN df ON v.w = df.w),
s AS (SELECT doc_id, 0 AS segment, text AS part FROM d WHERE text IS NOT NULL
  UNION ALL SELECT doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)), unnest(string_split(text, chr(10))) FROM d),
tf AS (SELECT doc_id, segment, w, count(*) AS tf FROM (SELECT doc_id, segment, unnest(string_split_regex(lower(part), '{WORD_GAP}')) AS w FROM s) WHERE w <> '' GROUP BY ALL),
x AS (SELECT doc_id, segment, tf.w, tf * coalesce(idf, ln((SELECT count(text) FROM d) + 1) + 1) AS x FROM tf LEFT JOIN idf USING (w)),
y AS (SELECT template, license, t.w, n * idf AS y, sqrt(sum(n * idf * n * idf) OVER (PARTITION BY template)) AS len FROM t JOIN idf USING (w)),
norms AS (SELECT doc_id, segment, sqrt(sum(x * x)) AS norm FROM x GROUP BY ALL),
c AS (SELECT doc_id, segment, license, cosine FROM (SELECT x.doc_id, x.segment, template, license, round(sum(x * y / len) / any_value(norm), 6) AS cosine
  FROM x JOIN y USING (w) JOIN norms ON norms.doc_id = x.doc_id AND norms.segment = x.segment GROUP BY ALL) WHERE cosine >= {min(header_cosine, file_cosine)}),
own AS (SELECT * FROM (SELECT doc_id, license, cosine, row_number() OVER (PARTITION BY doc_id ORDER BY cosine DESC, license) AS r FROM c WHERE cosine >= {header_cosine}) WHERE r = 1),
whole AS (SELECT * FROM (SELECT doc_id, license, cosine, row_number() OVER (PARTITION BY doc_id ORDER BY cosine DESC, license) AS r FROM c WHERE segment = 0 AND cosine >= {file_cosine}) WHERE r = 1),
notice AS (SELECT * FROM (SELECT regexp_replace(path, '/?[^/]*$', '') AS dir, license, cosine, path,
  row_number() OVER (PARTITION BY regexp_replace(path, '/?[^/]*$', '') ORDER BY cosine DESC, license, path) AS r FROM whole JOIN d USING (doc_id)) WHERE r = 1),
near AS (SELECT * FROM (SELECT d.doc_id, n.*, row_number() OVER (PARTITION BY d.doc_id ORDER BY length(dir) DESC) AS q FROM d JOIN notice n ON dir = '' OR starts_with(d.path, dir || '/')) WHERE q = 1)
SELECT d.doc_id, d.path, coalesce(own.license, near.license) AS license, coalesce(own.cosine, near.cosine) AS cosine,
  CASE WHEN own.license IS NOT NULL THEN d.path ELSE near.path END AS license_from
FROM d LEFT JOIN own ON own.doc_id = d.doc_id LEFT JOIN near ON near.doc_id = d.doc_id"""
