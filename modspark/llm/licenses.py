"""License scan: TF-IDF cosine of header lines to notices, then inheritance along directories.

DataFrame operations only. Lines that hold a term without which no notice can be near enough
become sparse TF-IDF vectors and are joined with the notices on their terms; the best cosine above the limit is the file's
license. Files that are mostly notice, or are named like one, declare it for their
directory; a file without a license of its own takes that of the nearest directory above.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modspark.llm.store import saved

TERM = r"[a-z0-9]+(?:[.+-][a-z0-9]+)*"
CUE = r"(?i)licen[cs]e|copyright|copying|copyleft|public domain|spdx|warrant|redistribut"
"""Every notice below has one of these. The SQL twin looks at no other lines; the operator does."""
NAMED = r"(?i)(^|/)(licen[cs]e|copying|unlicense|notice)(\.[^/]*)?$"

# fixed values: short notices as their licenses give them
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC0-1.0", "This work is dedicated to the public domain under the CC0 1.0 Universal license"),
)


@dataclass(frozen=True)
class LicenseScan:
    """Least cosine of a match; share of a file's terms (hundredths) that makes it a license file."""

    least_cosine: float = 0.6
    file_share: int = 30


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TERM), F.lit(0))


def notice_table(spark: SparkSession) -> DataFrame:
    rows = [(i, name, text) for i, (name, text) in enumerate(NOTICES)]
    return spark.createDataFrame(rows, "notice int, license string, text string")


def term_weights(files: DataFrame, notices: DataFrame) -> tuple[DataFrame, Column]:
    """(term, idf) of the notices' terms, counted over all files, and the idf of any other term.

    The table has the terms of the notices only, whatever the number of files.
    """
    vocabulary = saved(notices.select(F.explode(F.array_distinct(terms(F.col("text")))).alias("term")).distinct())
    each = files.select(F.explode(F.array_distinct(terms(F.col("text")))).alias("term"))
    seen = each.join(F.broadcast(vocabulary), "term").groupBy("term").agg(F.count("*").alias("files"))
    n = F.lit(files.count())
    idf = F.log((n + 1) / (F.coalesce("files", F.lit(0)) + 1)) + 1
    return saved(vocabulary.join(seen, "term", "left").select("term", idf.alias("idf"))), F.log(n + 1) + 1


def telling_terms(idf: DataFrame, least_cosine: float) -> list[str]:
    """Terms of which every line holds one whose cosine with some notice reaches the limit.

    A cosine is at most the length of the notice's unit vector on the shared terms. So of
    every notice those terms are taken, from the heaviest on, whose remainder is too short.
    """
    weight = dict(idf.collect())
    least = max(0.0, least_cosine - 1e-6) ** 2  # cosines are rounded to six places
    chosen: set[str] = set()
    for _, text in NOTICES:
        square = {t: (n * weight[t]) ** 2 for t, n in Counter(re.findall(TERM, text.lower())).items()}
        heaviest = sorted(square, key=lambda t: (-square[t], t))
        total = math.fsum(square.values())
        for i, term in enumerate(heaviest):
            if math.fsum(square[t] for t in heaviest[i:]) < least * total:
                break
            chosen.add(term)
    return sorted(chosen)


def cosines(lines: DataFrame, notices: DataFrame, idf: DataFrame, other: Column) -> DataFrame:
    """path_key, text_key, line, license, cosine, n_terms: the best notice of every line."""
    keys = ["path_key", "text_key", "line"]
    vector = lines.select(*keys, F.explode("terms").alias("term")).groupBy(*keys, "term").agg(F.count("*").alias("tf"))
    vector = vector.join(F.broadcast(idf), "term", "left").withColumn("w", F.col("tf") * F.coalesce("idf", other))
    size = vector.groupBy(*keys).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("size"), F.sum("tf").alias("n_terms"))
    model = notices.select("notice", "license", F.explode(terms(F.col("text"))).alias("term"))
    model = model.groupBy("notice", "license", "term").agg(F.count("*").alias("n")).join(idf, "term")
    model = model.select("notice", "license", "term", (F.col("n") * F.col("idf")).alias("v"))
    norm = model.groupBy("notice").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"))
    model = saved(model.join(norm, "notice").select("notice", "license", "term", (F.col("v") / F.col("norm")).alias("v")))
    dots = (
        vector.filter("idf is not null")
        .join(F.broadcast(model), "term")
        .groupBy(*keys, "notice", "license")
        .agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
    )
    scored = dots.join(size, keys).withColumn("cosine", F.round(F.col("dot") / F.col("size"), 6))
    best = F.max_by(F.struct("license", "cosine", "n_terms"), F.struct("cosine", -F.col("notice"))).alias("b")
    return scored.groupBy(*keys).agg(best).select(*keys, "b.license", "b.cosine", "b.n_terms")


def directory(path: Column) -> Column:
    """All but the last step of a path; the top is the empty path."""
    return F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", "")).when(path.isNotNull(), "")


def inherited(declared: DataFrame, directories: DataFrame) -> DataFrame:
    """dir, license, origin: for every directory the license of the nearest one above or at it.

    Of several licenses declared in one directory the one of most files counts, then the
    first by name.
    """
    per_dir = declared.groupBy("dir", "license").agg(F.count("*").alias("files"))
    chosen = per_dir.groupBy("dir").agg(F.min(F.struct(-F.col("files"), "license")).alias("c"))
    chosen = chosen.select(F.col("dir").alias("origin"), "c.license")
    steps = F.split("dir", "/")
    depth = F.explode(F.sequence(F.lit(0), F.size(steps))).alias("depth")
    above = directories.filter("dir is not null").distinct().select("dir", depth)
    above = above.select("dir", "depth", F.array_join(F.slice(steps, 1, F.col("depth")), "/").alias("origin")).distinct()
    met = above.join(chosen, "origin").groupBy("dir").agg(F.max_by(F.struct("license", "origin"), "depth").alias("b"))
    return met.select("dir", "b.license", "b.origin")


def scanned(files: DataFrame, keep: list[str], scan: LicenseScan = LicenseScan()) -> DataFrame:
    """``keep`` columns of files(path, text) with own_license, cosine, license_file, license, inherited_from.

    A null or blank text has no license of its own; a null path inherits nothing; a file
    with several notices has the one of highest cosine, then the first by name. Repeated
    rows come out as often as they came in. Other columns are ignored; no rows give none.
    """
    spark = files.sparkSession
    notices = notice_table(spark)
    idf, other = term_weights(files, notices)
    keys = [F.coalesce("path", F.lit("\0")).alias("path_key"), F.xxhash64("text").alias("text_key")]
    cut = files.select(*keys, F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line", "raw"))
    telling = telling_terms(idf, scan.least_cosine)
    # the pattern finds the terms also inside others; the array tells
    near = cut.filter(F.lower("raw").rlike("|".join(map(re.escape, telling))))
    lines = near.select("path_key", "text_key", "line", terms(F.col("raw")).alias("terms"))
    lines = saved(lines.filter(F.arrays_overlap("terms", F.array(*map(F.lit, telling)))))
    matched = cosines(lines, notices, idf, other).filter(F.col("cosine") >= scan.least_cosine)
    # repeated rows have their lines' terms summed once per row: the cosine stays, the count is of all rows
    own = matched.groupBy("path_key", "text_key").agg(
        F.min(F.struct(-F.col("cosine"), "license")).alias("b"), F.sum("n_terms").alias("notice_terms")
    )
    own = saved(own.select("path_key", "text_key", F.col("b.license").alias("own_license"), (-F.col("b.col1")).alias("cosine"), "notice_terms"))
    n_terms = F.coalesce(F.regexp_count(F.lower("text"), F.lit(TERM)), F.lit(0)).alias("n_terms")
    rows = files.select(*keep, *([] if "path" in keep else ["path"]), *keys, n_terms)
    own = own.join(files.groupBy(*keys).agg(F.count("*").alias("times")), ["path_key", "text_key"])
    share = 100 * F.col("notice_terms") >= scan.file_share * F.col("n_terms") * F.col("times")
    told = F.col("own_license").isNotNull() & (share | F.coalesce(F.col("path").rlike(NAMED), F.lit(False)))
    found = saved(
        rows.join(own, ["path_key", "text_key"], "left").select(
            *rows.columns[:-3], "own_license", "cosine", F.coalesce(told, F.lit(False)).alias("license_file"),
            directory(F.col("path")).alias("dir"),
        )
    )
    declared = found.filter("license_file and dir is not null").select("dir", F.col("own_license").alias("license"))
    source = inherited(declared, found.select("dir")).toDF("_dir", "_license", "_origin")
    return found.join(source, found["dir"] == source["_dir"], "left").select(
        *keep, "own_license", "cosine", "license_file",
        F.coalesce("own_license", "_license").alias("license"),
        F.when(F.col("own_license").isNull(), F.col("_origin")).alias("inherited_from"),
    )


def document_paths(docs: DataFrame) -> DataFrame:
    """docs with a path: source / language / hundred of ids / id."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    hundred = F.coalesce(F.expr("doc_id div 100").cast("string"), F.lit("-"))
    return docs.withColumn("path", F.concat_ws("/", part("source"), part("lang"), hundred, part("doc_id")))


def _values() -> str:
    quoted = (f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(NOTICES))
    return ", ".join(quoted)


_TERMS = r"regexp_extract_all(lower(coalesce({}, '')), '[a-z0-9]+(?:[.+-][a-z0-9]+)*')"

SQL = f"""
WITH notices AS (
  SELECT * FROM (VALUES {_values()}) AS v(notice, license, text)
), files AS (
  SELECT doc_id, text, row_number() OVER () AS r,
    coalesce(source, '-') || '/' || coalesce(lang, '-') || '/' || coalesce((doc_id // 100)::VARCHAR, '-') AS dir,
    {_TERMS.format("text")} AS terms
  FROM documents
), vocabulary AS (
  SELECT DISTINCT unnest({_TERMS.format("text")}) AS term FROM notices
), seen AS (
  SELECT term, count(*) AS files FROM (SELECT r, unnest(list_distinct(terms)) AS term FROM files) JOIN vocabulary USING (term) GROUP BY term
), idf AS (
  SELECT term, ln(((SELECT count(*) FROM files) + 1) / (coalesce(files, 0) + 1)) + 1 AS idf FROM vocabulary LEFT JOIN seen USING (term)
), lines AS (
  SELECT r, line, {_TERMS.format("raw")} AS terms
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS line FROM files)
  WHERE regexp_matches(raw, '{CUE}')
), vector AS (
  SELECT r, line, term, count(*) AS tf, any_value(idf) AS idf, count(*) * coalesce(any_value(idf), ln((SELECT count(*) FROM files) + 1) + 1) AS w
  FROM (SELECT r, line, unnest(terms) AS term FROM lines) LEFT JOIN idf USING (term) GROUP BY r, line, term
), sizes AS (
  SELECT r, line, sqrt(sum(w * w)) AS size, sum(tf) AS n_terms FROM vector GROUP BY r, line
), model AS (
  SELECT notice, license, term, count(*) * any_value(idf) AS v
  FROM (SELECT notice, license, unnest({_TERMS.format("text")}) AS term FROM notices) JOIN idf USING (term) GROUP BY notice, license, term
), norms AS (
  SELECT notice, sqrt(sum(v * v)) AS norm FROM model GROUP BY notice
), dots AS (
  SELECT r, line, notice, license, sum(w * v / norm) AS dot FROM vector JOIN model USING (term) JOIN norms USING (notice)
  WHERE idf IS NOT NULL GROUP BY r, line, notice, license
), best AS (
  SELECT r, line, license, round(dot / size, 6) AS cosine, n_terms FROM dots JOIN sizes USING (r, line)
  QUALIFY row_number() OVER (PARTITION BY r, line ORDER BY round(dot / size, 6) DESC, notice) = 1
), own AS (
  SELECT r, first(license ORDER BY cosine DESC, license) AS own_license, max(cosine) AS cosine, sum(n_terms) AS notice_terms
  FROM best WHERE cosine >= 0.6 GROUP BY r
), found AS (
  SELECT f.r, doc_id, dir, own_license, cosine, coalesce(100 * notice_terms >= 30 * len(terms), false) AS license_file
  FROM files f LEFT JOIN own USING (r)
), chosen AS (
  SELECT dir AS origin, license FROM (SELECT dir, own_license AS license, count(*) AS n FROM found WHERE license_file GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY n DESC, license) = 1
), above AS (
  SELECT DISTINCT dir, d AS depth, array_to_string(string_split(dir, '/')[1 : d], '/') AS origin
  FROM (SELECT DISTINCT dir FROM found), generate_series(0, 3) AS g(d)
), near AS (
  SELECT dir, license, origin FROM above JOIN chosen USING (origin) QUALIFY row_number() OVER (PARTITION BY dir ORDER BY depth DESC) = 1
)
SELECT doc_id, own_license, cosine, license_file, coalesce(own_license, license) AS license,
  CASE WHEN own_license IS NULL THEN origin END AS inherited_from
FROM found LEFT JOIN near USING (dir)
"""
