"""License notices in texts: MinHash bands over overlapping windows find templates, exact shingles confirm them.

Templates are filed by size class. A class of windows spans WIDTH shingles, a power of two and at least
twice its templates' sizes, at every WIDTH / 2: whatever a template covers lies whole inside a window. A window
that holds 75 % of a template then has a Jaccard similarity of at least 0.17 with it, and BANDS = 64 bands
of one row collide with a probability of 1 - 0.83^64 > 0.99999. Collisions are only candidates: a
match is a window that contains at least 75 % of the template's distinct five-word shingles.

Notices resemble each other (versions of one license, a clause more). Of matches of different licenses on the same
words the best one counts: one whose places all belong to another's falls if that one holds more places, or as many at a
higher share of its template.

A window's minimum can only equal a template's if the window holds that very shingle. So shingles are first tested
against those of the templates (a set of bounded size) inside the scan, and minima are computed for windows
around hits only; no window that could collide is left out. Texts without a hit, nearly all, leave
the scan without being shuffled, and equal texts are searched once.

Everything is built from DataFrame functions. Defined results: words are runs of a-z and 0-9 with A-Z
lower-cased; a null text or one of fewer than five words holds no notice; repeated rows get the same row
each; templates of fewer than five words are never matched; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playtally.llm.storage import cut

SHINGLE, CONTAINED_PERCENT, BANDS = 5, 75, 64
MOST_TEMPLATE_SHINGLES = 100_000

#: Notices as licenses word them, and the short lines that name a license.
TEMPLATES = (
    ("mit-line", "Released under the MIT License."),
    ("apache-2.0-line", "Licensed under the Apache License, Version 2.0."),
    ("gpl-3.0-line", "This work is licensed under the GNU General Public License, version 3."),
    ("cc-by-nc-4.0-line", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0-line", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
            "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions: The above copyright notice and this permission notice shall be included in all copies or "
            "substantial portions of the Software."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("bsd-2-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met: Redistributions of source code must retain the above copyright "
                     "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
                     "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
                     "documentation and/or other materials provided with the distribution."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                   "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                   "CONDITIONS OF ANY KIND, either express or implied."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)

_FSF = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by "
        "the Free Software Foundation, either version {} of the License, or (at your option) any later version.")
_OLD_FSF = ("This {} is free software; you can redistribute it and/or modify it under the terms of the GNU {} as published by "
            "the Free Software Foundation; either version {} of the License, or (at your option) any later version.")
_FSF_TEXT = ("GNU {} Version {} Copyright (C) {} Free Software Foundation, Inc. {}Everyone is permitted to copy and distribute "
             "verbatim copies of this license document, but changing it is not allowed.")
_FSF_STREET = "51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA "
_BSD_2 = dict(TEMPLATES)["bsd-2-clause"]
#: Further notices, lines and heads of long texts; a license can have several. The SQL below covers only TEMPLATES.
MORE_TEMPLATES = (
    ("mit-line", "Licensed under the MIT License."),
    ("mit-line", "Distributed under the MIT License."),
    ("mit-line", "This project is licensed under the MIT License."),
    ("bsd-2-clause-line", "Licensed under the BSD 2-Clause License."),
    ("bsd-3-clause-line", "Licensed under the BSD 3-Clause License."),
    ("mpl-2.0-line", "Licensed under the Mozilla Public License, Version 2.0."),
    ("gpl-2.0-line", "This work is licensed under the GNU General Public License, version 2."),
    ("lgpl-2.1-line", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("lgpl-3.0-line", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("agpl-3.0-line", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("epl-2.0-line", "Licensed under the Eclipse Public License, Version 2.0."),
    ("cc-by-sa-4.0-line", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nd-4.0-line", "Licensed under CC BY-ND 4.0."),
    ("cc-by-nc-sa-4.0-line", "Licensed under CC BY-NC-SA 4.0."),
    ("cc-by-nc-nd-4.0-line", "Licensed under CC BY-NC-ND 4.0."),
    ("cc-by-sa-3.0-line", "Licensed under CC BY-SA 3.0."),
    ("cc-by-3.0-line", "This work is licensed under a Creative Commons Attribution 3.0 Unported License."),
    ("cc-by-sa-3.0-line", "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License."),
    ("cc-by-sa-4.0-line", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nd-4.0-line", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("cc-by-nc-4.0-line", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-nc-sa-4.0-line", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International "
                             "License."),
    ("cc-by-nc-nd-4.0-line", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 "
                             "International License."),
    ("cc0-1.0-line", "Licensed under CC0 1.0 Universal."),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this "
                "work."),
    ("cc0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to "
                "this software to the public domain worldwide. This software is distributed without any warranty."),
    ("bsd-3-clause", _BSD_2 + " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                     "promote products derived from this software without specific prior written permission."),
    ("gpl-2.0", _FSF.format("General Public License", "2")),
    ("gpl-2.0", _OLD_FSF.format("program", "General Public License", "2")),
    ("gpl-3.0", _OLD_FSF.format("program", "General Public License", "3")),
    ("lgpl-2.1", _OLD_FSF.format("library", "Lesser General Public License", "2.1")),
    ("lgpl-2.1", _FSF.format("Lesser General Public License", "2.1")),
    ("lgpl-3.0", _OLD_FSF.format("library", "Lesser General Public License", "3")),
    ("lgpl-3.0", _FSF.format("Lesser General Public License", "3")),
    ("agpl-3.0", _FSF.format("Affero General Public License", "3")),
    ("gpl-2.0", _FSF_TEXT.format("GENERAL PUBLIC LICENSE", "2, June 1991", "1989, 1991", _FSF_STREET)),
    ("gpl-3.0", _FSF_TEXT.format("GENERAL PUBLIC LICENSE", "3, 29 June 2007", "2007", "")),
    ("lgpl-2.1", _FSF_TEXT.format("LESSER GENERAL PUBLIC LICENSE", "2.1, February 1999", "1991, 1999", _FSF_STREET)),
    ("lgpl-3.0", _FSF_TEXT.format("LESSER GENERAL PUBLIC LICENSE", "3, 29 June 2007", "2007", "")),
    ("agpl-3.0", _FSF_TEXT.format("AFFERO GENERAL PUBLIC LICENSE", "3, 19 November 2007", "2007", "")),
    ("apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, "
                   "AND DISTRIBUTION"),
    ("epl-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which "
                "is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
             "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
             "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
             "restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original "
             "software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but "
             "is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the "
             "original software. 3. This notice may not be removed or altered from any source distribution."),
)


def shingles(text: Column) -> Column:
    """Hashes of the five-word shingles of a text, by place."""
    plain = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.regexp_extract_all(plain, F.lit("[a-z0-9]+"), F.lit(0))

    def hashed(held: Column) -> Column:
        return F.when(F.size(held) >= SHINGLE, F.transform(
            F.sequence(F.lit(0), F.size(held) - SHINGLE),
            lambda i: F.xxhash64(*[F.get(held, i + k) for k in range(SHINGLE)])))

    return F.element_at(F.transform(F.array(words), hashed), 1)


def bands(window: Column) -> Column:
    """The minimum of a window's shingles under each of BANDS hashes, with the band's number in it."""
    return F.transform(F.sequence(F.lit(1), F.lit(BANDS)), lambda band: F.xxhash64(band, F.array_min(
        F.transform(window, lambda shingle: F.xxhash64(shingle, band)))))


def width_of(size: Column) -> Column:
    """The window width of a template's class: twice the next power of two."""
    return (2 * F.pow(F.lit(2.0), F.ceil(F.log2(size.cast("double"))))).cast("int")


def template_table(spark: SparkSession, templates=TEMPLATES + MORE_TEMPLATES) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(name).alias("license"), F.lit(text).alias("text")) for name, text in templates])
    return spark.range(1).select(F.explode(rows).alias("row")).select("row.*")


def filed(templates: DataFrame) -> DataFrame:
    """(license, grams, width, bands) of each template that has a shingle."""
    grams = templates.select("license", F.array_distinct(shingles(F.col("text"))).alias("grams")).where("grams is not null")
    return grams.withColumn("width", width_of(F.size("grams"))).withColumn("bands", bands(F.col("grams")))


def matches(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """(key, license, windows) by md5 of the text: the licenses that a text holds and in how many windows."""
    known = filed(templates)
    sizes = known.agg(F.sum(F.size("grams")).alias("n"), F.collect_set("width").alias("widths")).first()
    if (sizes["n"] or 0) > MOST_TEMPLATE_SHINGLES:
        raise ValueError(f"templates hold {sizes['n']} shingles; at most {MOST_TEMPLATE_SHINGLES} are shared with every task")
    wanted = [row[0] for row in known.select(F.explode("grams")).distinct().collect()]

    held = docs.select(F.md5(F.coalesce("text", F.lit(""))).alias("key"), shingles(F.col("text")).alias("grams"))
    hit = held.where(F.exists("grams", lambda gram: gram.isin(wanted))).dropDuplicates(["key"])
    places = hit.withColumn("hits", F.expr("sequence(0, size(grams) - 1)")).withColumn(
        "hits", F.filter("hits", lambda at: F.get("grams", at).isin(wanted)))
    # The two windows of each width that hold a place.
    if not wanted:
        return docs.select(F.lit("").alias("key"), F.lit("").alias("license"), F.lit(0).cast("bigint").alias("windows")).limit(0)
    starts = F.flatten(F.array(*[F.array_distinct(F.flatten(F.transform("hits", _windows(width // 2))))
                                 for width in sorted(sizes["widths"])]))
    windows = places.select("key", "grams", F.explode(starts).alias("w")).select(
        "key", "w.start", "w.width", F.expr("slice(grams, w.start + 1, w.width)").alias("window"))
    posted = windows.withColumn("band", F.explode(bands(F.col("window"))))
    shared = known.select("license", F.col("grams").alias("template"), "width", F.explode("bands").alias("band"))
    found = posted.join(F.broadcast(shared), ["width", "band"]).dropDuplicates(["key", "start", "width", "license", "template"])
    found = found.withColumn("held", F.size(F.array_intersect("window", "template")))
    places = F.filter(F.sequence(F.lit(0), F.size("window") - 1), lambda i: F.array_contains("template", F.get("window", i)))
    found = cut(found.where(100 * F.col("held") >= CONTAINED_PERCENT * F.size("template")).select(
        "key", "license", "start", "width", (F.col("held") / F.size("template")).alias("share"),
        F.transform(places, lambda i: i + F.col("start")).alias("places")))
    return best(found, max(sizes["widths"])).groupBy("key", "license").agg(
        F.count_distinct("start", "width").alias("windows"))


def best(found: DataFrame, widest: int) -> DataFrame:
    """The matches but those whose places all belong to a better match of another license, one that is not so itself."""
    marked = cut(_beaten(found, found, widest))
    return _beaten(found, marked.where("not beaten").drop("beaten"), widest).where("not beaten")


def _beaten(found: DataFrame, rivals: DataFrame, widest: int) -> DataFrame:
    """`found` with a column `beaten`. A rival that holds all places of a match holds its first; it spans two blocks at most."""
    ends = F.array(F.element_at("places", 1), F.element_at("places", -1))
    rival = rivals.select(*[F.col(name).alias(f"r_{name}") for name in ("license", "share", "places")], "key", F.explode(
        F.array_distinct(F.transform(ends, lambda at: F.floor(at / widest)))).alias("block"))
    better = (F.col("license") != F.col("r_license")) & (F.size(F.array_except("places", "r_places")) == 0) & (
        (F.size("r_places") > F.size("places")) | (F.col("r_share") > F.col("share")))
    return found.withColumn("block", F.floor(F.element_at("places", 1) / widest)).join(
        rival, ["key", "block"], "left").groupBy("key", "license", "start", "width", "share", "places").agg(
        F.max(F.coalesce(better, F.lit(False))).alias("beaten"))


def _windows(half: int):
    def both(at: Column) -> Column:
        last = F.floor(at / half).cast("int") * half
        starts = [F.struct(start.cast("int").alias("start"), F.lit(2 * half).alias("width")) for start in (last - half, last)]
        return F.filter(F.array(*starts), lambda window: window["start"] >= 0)

    return both


def scan(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, n_licenses, licenses (names by alphabet), n_windows."""
    # Written first: a join that also aggregates one side cannot split the rows of many equal texts.
    found = cut(matches(docs, templates).groupBy("key").agg(
        F.count(F.lit(1)).alias("n_licenses"), F.array_join(F.sort_array(F.collect_list("license")), ",").alias("licenses"),
        F.sum("windows").alias("n_windows")))
    base = docs.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("key"))
    return base.join(found, "key", "left").select(
        "doc_id", F.coalesce("n_licenses", F.lit(0)).alias("n_licenses"), F.coalesce("licenses", F.lit("")).alias("licenses"),
        F.coalesce("n_windows", F.lit(0)).alias("n_windows"))


def license_scan(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), template_table(spark))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[a-z0-9]+')")
_GRAMS = f"""list_slice(w, i, i + {SHINGLE - 1}) as s, i - 1 as p
  from (select *, unnest(range(1, len(w) - {SHINGLE} + 2)) as i from"""
SQL = f"""with templates(license, text) as (values {", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in TEMPLATES)}),
template_grams as (
  select distinct license, s from (
    select license, {_GRAMS} (select license, {_WORDS} as w from templates) where len(w) >= {SHINGLE}))),
sizes as (
  select license, count(*) as n, cast(pow(2, ceil(log2(count(*)))) as bigint) as half from template_grams group by 1),
doc_grams as (
  select doc_id, {_GRAMS} (select doc_id, {_WORDS} as w from documents) where len(w) >= {SHINGLE})),
hits as (
  select doc_id, license, n, half, p // half * half as last, s from doc_grams join template_grams using (s) join sizes using (license)),
windows as (
  select doc_id, license, n, start, count(distinct s) as held
  from (select *, last as start from hits union all select *, last - half as start from hits where last >= half)
  group by all),
found as (
  select doc_id, license, count(*) as windows from windows where 100 * held >= {CONTAINED_PERCENT} * n group by 1, 2)
select doc_id, count(license) as n_licenses, coalesce(string_agg(license, ',' order by license), '') as licenses,
  cast(coalesce(sum(windows), 0) as bigint) as n_windows
from documents left join found using (doc_id) group by doc_id"""
