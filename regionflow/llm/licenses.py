"""License scans by MinHash bands over overlapping windows, in DataFrame operations only.

Templates are short license statements and notices, or license texts that read_templates takes from a folder. A template
of T shingles belongs to the class of the next power of two; texts are cut into windows of the class that overlap so far
that any occurrence lies whole in one. A window whose MinHash signature agrees with a template's in a band retrieves it,
and exact containment of the template's shingles in the window decides. The buckets are looked up lazily: a band's first
row is the least hash over a set of shingles, so a window can only fall into a template's bucket if it holds the very
shingle that gives the template its least hash. One probe per word finds those shingles, and the bands are worked out
for the windows around them; all other windows are in no bucket. Templates of different names that share so many
shingles that one cannot match without them are rivals; where both match, the one that more of its own shingles speak
for stands. band_settings derives the bands from the least similarity that a window over the containment threshold can
have, so that all but MISS of such windows collide. Tables made from the templates are broadcast up to a counted size.
"""

from __future__ import annotations

from math import ceil, log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regionflow.llm.common import BROADCAST_ROWS, cut
from regionflow.llm.decontaminate import words

SHINGLE, CONTAINMENT, MISS = 5, 0.8, 1e-4
SMALLEST = 4
BROADCAST_BYTES = 64 << 20
#: License statements and notices by SPDX name.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("MIT", "Released under the MIT License"),
    ("MIT", "This project is licensed under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "licensed under the GNU Affero General Public License, version 3"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
]
#: The notice that licenses of the GNU family share, by name and version.
NOTICE = "This {work} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} General Public License as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
TEMPLATES += [
    ("MIT", "Licensed under the MIT license"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("AGPL-3.0", NOTICE.format(work="program", name="Affero", version="3")),
    ("LGPL-3.0", NOTICE.format(work="library", name="Lesser", version="3")),
    ("LGPL-2.1", NOTICE.format(work="library", name="Lesser", version="2.1")),
]


def size_class(n_shingles: int) -> int:
    c = SMALLEST
    while c < n_shingles:
        c *= 2
    return c


def window(c: int) -> tuple[int, int]:
    """Shingles of a window of class c, and the step from one to the next."""
    return c + c // 4, max(1, c // 4 + 1)


def least_similarity(c: int, containment: float = CONTAINMENT) -> float:
    """The least Jaccard similarity of a template of class c and a window that contains so much of it."""
    least = c // 2 + 1 if c > SMALLEST else 1
    return min(ceil(containment * n) / (window(c)[0] + n - ceil(containment * n)) for n in range(least, c + 1))


def band_settings(similarity: float, miss: float = MISS, most: int = 64) -> tuple[int, int]:
    """(bands, rows): the most selective setting of at most so many hashes in which sets of the given similarity
    fail to collide with probability miss or less."""
    best = None
    for rows in range(1, 9):
        bands = ceil(log(miss) / log(1 - similarity**rows)) if similarity < 1 else 1
        if bands * rows <= most and (best is None or rows > best[1]):
            best = (bands, rows)
    return best or (most, 1)


def shingles(w: Column) -> Column:
    """The word shingles of an array of words, as text; none for fewer words."""
    at = F.sequence(F.lit(1), F.size(w) - (SHINGLE - 1))
    return F.when(F.size(w) >= SHINGLE, F.transform(at, lambda i: F.array_join(F.slice(w, i, SHINGLE), " "))).otherwise(F.array().cast("array<string>"))


def by_class(classes: list[int], value) -> Column:
    """value of the column class."""
    return F.element_at(F.create_map(*[F.lit(x) for c in classes for x in (c, value(c))]), F.col("class"))


def bands(hashed: str, classes: list[int]) -> Column:
    """The band keys of a set of shingles, given by the column of their hashes: class, band and the band's minima."""
    n, rows = (by_class(classes, lambda c, k=k: band_settings(least_similarity(c))[k]) for k in (0, 1))
    minimum = lambda k: F.array_min(F.transform(hashed, lambda h: F.xxhash64(h, k)))
    key = lambda b: F.xxhash64("class", b, F.transform(F.sequence(F.lit(0), rows - 1), lambda r: minimum(b * rows + r)))
    return F.transform(F.sequence(F.lit(0), n - 1), key)


def band_shingles(classes: list[int]) -> Column:
    """Of each band of a set of shingles, in the column set, the shingle that gives the band's first row."""
    n, rows = (by_class(classes, lambda c, k=k: band_settings(least_similarity(c))[k]) for k in (0, 1))
    least = lambda k: F.array_min(F.transform("set", lambda s: F.struct(F.xxhash64(F.xxhash64(s), k).alias("h"), s.alias("s"))))
    return F.array_distinct(F.transform(F.sequence(F.lit(0), n - 1), lambda b: least(b * rows)["s"]))


def read_templates(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(name, text) of the text files below path, by name; the name is the file's up to `.txt`. The driver holds them:
    a list of license texts, some megabytes."""
    rows = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).select(F.regexp_replace("_metadata.file_name", r"\.txt$", "").alias("n"), "value")
    return sorted((r.n, r.value) for r in rows.collect())


def small(df: DataFrame, size: Column) -> DataFrame:
    """df, cut, to be broadcast if its rows and the sum of size are within bounds."""
    df = cut(df)
    n, total = df.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return F.broadcast(df) if n <= BROADCAST_ROWS and total <= BROADCAST_BYTES else df


def template_table(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """template (number), spdx, set (its distinct shingles), hashed (their hashes), class. Templates of fewer words than a shingle are left out."""
    t = spark.createDataFrame([(i, *x) for i, x in enumerate(templates)], "template int, spdx string, body string")
    t = t.select("template", "spdx", F.array_distinct(shingles(words(F.col("body")))).alias("set")).where(F.size("set") > 0)
    t = t.withColumn("hashed", F.transform("set", lambda s: F.xxhash64(s)))
    return t.withColumn("class", F.greatest(F.lit(SMALLEST), F.pow(2, F.ceil(F.log2(F.size("set")))).cast("int")))


def with_rivals(table: DataFrame) -> DataFrame:
    """table (of template_table) with rivals: array of (rival, own, rests). rival is a template of another name that
    shares shingles; own are the shingles that it lacks; rests is whether own is less than CONTAINMENT of all, so that
    a match rests on shared ones. A pair is listed on both sides, if either rests on the other. Pairs of templates: few."""
    a, b = table.select("template", "spdx", "set"), table.select(F.col("template").alias("rival"), F.col("spdx").alias("r_spdx"), F.col("set").alias("r_set"))
    own, theirs = F.array_except("set", "r_set"), F.array_except("r_set", "set")
    rests = lambda x, of: F.size(x) < CONTAINMENT * F.size(of)
    pairs = a.join(small(b, 64 * F.size("r_set")), (F.col("spdx") != F.col("r_spdx")) & F.arrays_overlap("set", "r_set")).where(rests(own, "set") | rests(theirs, "r_set"))
    listed = pairs.groupBy("template").agg(F.collect_list(F.struct("rival", own.alias("own"), rests(own, "set").alias("rests"))).alias("rivals"))
    none = F.array().cast("array<struct<rival:int,own:array<string>,rests:boolean>>")
    return table.join(listed, "template", "left").withColumn("rivals", F.coalesce("rivals", none))


def outdone(hits: DataFrame) -> DataFrame:
    """o_id, o_text, o_template, o_start of the windows whose match rests on shingles shared with a rival that matches
    in a window over their middle with a larger share of its own shingles. Few templates have rivals."""
    each = hits.where(F.size("own") > 0).select("k_id", "k_text", "template", "start", "n", F.explode("own").alias("o")).distinct()
    a = each.where("o.rests").select(F.col("k_id").alias("o_id"), F.col("k_text").alias("o_text"), F.col("template").alias("o_template"), F.col("start").alias("o_start"), (F.col("start") + F.col("n") / 2).alias("middle"), F.col("o.rival").alias("a_rival"), F.col("o.share").alias("a_share"))
    on = (
        F.col("k_id").eqNullSafe(F.col("o_id")) & (F.col("k_text") == F.col("o_text")) & (F.col("template") == F.col("a_rival")) & (F.col("o.rival") == F.col("o_template"))
        & (F.col("o.share") > F.col("a_share")) & F.col("middle").between(F.col("start"), F.col("start") + F.col("n"))
    )
    return a.join(each, on, "left_semi").select("o_id", "o_text", "o_template", "o_start").distinct()


def find_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row per row of docs: k_id, k_text, matches: array of (spdx, template, containment as shingles found per
    shingle of the template, start and end word of the first window, outdone: whether a rival stands for it in each of
    its windows), by template. The first of the best windows is told, of those that are not outdone if there are any.

    A template matches where a window holds CONTAINMENT or more of its distinct shingles. Words are those of
    decontaminate.words. Null, empty and short texts have no matches; repeated rows get the same matches each; an
    empty table gives no rows; other columns are not looked at.
    """
    spark = docs.sparkSession
    table = cut(with_rivals(template_table(spark, templates)))
    classes = sorted(r[0] for r in table.select("class").distinct().collect())
    key = [F.col(id_col).alias("k_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("k_text")]
    every = docs.select(*key)
    none = F.array().cast("array<struct<spdx:string,template:int,containment:double,start:int,end:int,outdone:boolean>>")
    if not classes:
        return every.withColumn("matches", none)
    probes = table.select(F.explode(band_shingles(classes)).alias("s"), "class").select(F.xxhash64(F.split("s", " ")).alias("h"), "class")
    probes = small(probes.groupBy("h").agg(F.collect_set("class").alias("classes")), F.lit(32) + 4 * F.size("classes"))
    scan = docs.select(*key, words(F.col(text_col)).alias("w")).select("k_id", "k_text", "w", F.posexplode("w").alias("pos", "_"))
    found = scan.join(
        probes,
        F.xxhash64(F.slice("w", F.col("pos") + 1, SHINGLE)) == F.col("h"),
    ).select("k_id", "k_text", "w", "pos", F.explode("classes").alias("class"))
    # The windows, by number, that hold the shingle at pos.
    size, step = (by_class(classes, lambda c, k=k: window(c)[k]) for k in (0, 1))
    first = F.greatest(F.lit(0), F.floor((F.col("pos") - size + step) / step)).cast("int")
    cells = found.select(
        "k_id", "k_text", "class", size.alias("size"), step.alias("step"), "w",
        F.explode(F.sequence(first, F.floor(F.col("pos") / step).cast("int"))).alias("win"),
    ).select("k_id", "k_text", "class", "win", (F.col("win") * F.col("step")).alias("start"), F.slice("w", F.col("win") * F.col("step") + 1, F.col("size") + SHINGLE - 1).alias("part"))
    cells = cells.groupBy("k_id", "k_text", "class", "win", "start").agg(F.first("part").alias("part"))
    cells = cut(
        cells.select("k_id", "k_text", "class", "start", F.size("part").alias("n"), F.array_distinct(shingles(F.col("part"))).alias("set"))
        .withColumn("hashed", F.transform("set", lambda s: F.xxhash64(s)))
    )
    buckets = small(table.select("template", F.explode(bands("hashed", classes)).alias("band")), F.lit(16))
    sets = small(table.select("template", "spdx", F.col("set").alias("wanted"), "rivals"), F.octet_length(F.array_join("wanted", " ")) + 64 * F.size("wanted") + 1024 * F.size("rivals"))
    share = lambda x: F.size(F.array_intersect("set", x["own"])) / F.greatest(F.size(x["own"]), F.lit(1))
    hits = (
        cells.withColumn("band", F.explode(bands("hashed", classes)))
        .join(buckets, "band")
        .join(sets, "template")
        .select("k_id", "k_text", "start", "n", "template", "spdx", (F.size(F.array_intersect("set", "wanted")) / F.size("wanted")).alias("containment"), F.transform("rivals", lambda x: F.struct(x["rival"].alias("rival"), share(x).alias("share"), x["rests"].alias("rests"))).alias("own"))
        .where(F.col("containment") >= CONTAINMENT)
    )
    of = F.col("k_id").eqNullSafe(F.col("o_id")) & (F.col("k_text") == F.col("o_text")) & (F.col("template") == F.col("o_template")) & (F.col("start") == F.col("o_start"))
    hits = hits.join(outdone(hits), of, "left").select("k_id", "k_text", "start", "n", "template", "spdx", "containment", F.col("o_template").isNull().alias("stands"))
    best = (
        hits.groupBy("k_id", "k_text", "template", "spdx")
        .agg(F.max(F.struct("stands", "containment", (-F.col("start")).alias("at"), "n")).alias("b"))
        .groupBy("k_id", "k_text")
        .agg(F.array_sort(F.collect_list(F.struct("template", "spdx", F.col("b.containment").alias("containment"), (-F.col("b.at")).alias("start"), (F.col("b.n") - F.col("b.at")).alias("end"), (~F.col("b.stands")).alias("outdone")))).alias("m"))
        .select(F.col("k_id").alias("f_id"), F.col("k_text").alias("f_text"), F.transform("m", lambda x: F.struct(x["spdx"].alias("spdx"), x["template"].alias("template"), x["containment"].alias("containment"), x["start"].cast("int").alias("start"), x["end"].cast("int").alias("end"), x["outdone"].alias("outdone"))).alias("m"))
    )
    on = F.col("k_id").eqNullSafe(F.col("f_id")) & (F.col("k_text") == F.col("f_text"))
    return every.join(best, on, "left").select("k_id", "k_text", F.coalesce("m", none).alias("matches"))
