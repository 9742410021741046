"""Licences of files: sparse TF-IDF cosine to templates, then the nearest licence above."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import load
from marquee.sources.tables import materialize

LEAST_COSINE = 0.7

# Wordings by which licences are declared.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "You may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files, to deal in the Software without restriction."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the "
                "terms of the GNU General Public License as published by the Free Software Foundation."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, "
                     "are permitted provided that the following conditions are met."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]
# Published headers and licences, however they are wrapped and commented, and titles of one to
# three lines. The query's SQL states the wordings above only; none of these is in the tables.
NOTICES = [
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions: The above copyright notice and this permission notice shall be "
            "included in all copies or substantial portions of the Software."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                "or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
                 "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of "
                 "the License, or (at your option) any later version."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met: 1. Redistributions of source code must retain "
                     "the above copyright notice, this list of conditions and the following disclaimer. "
                     "2. Redistributions in binary form must reproduce the above copyright notice, this list of "
                     "conditions and the following disclaimer in the documentation and/or other materials provided "
                     "with the distribution."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
                "MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "This work is licensed under the Creative Commons Attribution 4.0 International License. To view a "
                  "copy of this license, visit http://creativecommons.org/licenses/by/4.0/"),
]
TITLES = [
    ("MIT", "MIT License"), ("MIT", "The MIT License (MIT)"), ("ISC", "ISC License"),
    ("Apache-2.0", "Apache License, Version 2.0"), ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("GPL-3.0", "GNU General Public License Version 3"), ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("BSD-3-Clause", "BSD 3-Clause License"), ("BSD-2-Clause", "BSD 2-Clause License"),
    ("CC-BY-4.0", "Attribution 4.0 International"), ("CC-BY-4.0", "Creative Commons Attribution 4.0 International"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International Public License"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International Public License"),
    ("CC-BY-ND-4.0", "Creative Commons Attribution-NoDerivatives 4.0 International Public License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"), ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"), ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0"),
    ("CC0-1.0", "CC0 1.0 Universal"),
    *[(name, f"SPDX-License-Identifier: {identifier}") for name, identifier in [
        ("MIT", "MIT"), ("ISC", "ISC"), ("Apache-2.0", "Apache-2.0"), ("MPL-2.0", "MPL-2.0"),
        ("GPL-2.0", "GPL-2.0"), ("GPL-2.0", "GPL-2.0-only"), ("GPL-2.0", "GPL-2.0-or-later"),
        ("GPL-3.0", "GPL-3.0"), ("GPL-3.0", "GPL-3.0-only"), ("GPL-3.0", "GPL-3.0-or-later"),
        ("LGPL-2.1", "LGPL-2.1-only"), ("LGPL-2.1", "LGPL-2.1-or-later"), ("LGPL-3.0", "LGPL-3.0-or-later"),
        ("AGPL-3.0", "AGPL-3.0-only"), ("AGPL-3.0", "AGPL-3.0-or-later"),
        ("BSD-2-Clause", "BSD-2-Clause"), ("BSD-3-Clause", "BSD-3-Clause"), ("CC0-1.0", "CC0-1.0"),
        ("CC-BY-4.0", "CC-BY-4.0"), ("CC-BY-SA-4.0", "CC-BY-SA-4.0"), ("CC-BY-NC-4.0", "CC-BY-NC-4.0")]],
]
# What a passage must have to be of a family, in words joined by single blanks.
FAMILIES = {
    "MIT": r"\bmit\b|permission is hereby granted", "ISC": r"\bisc\b|permission to use copy modify",
    "Apache": r"\bapache|compliance with the license", "GPL": r"general public license|\b[al]?gpl",
    "BSD": r"\bbsd\b|redistribution and use", "MPL": r"mozilla public license|\bmpl\b",
    "CC": r"\bcc by\b|attribution", "CC0": r"\bcc0\b",
}
# Lines of titles; words, and lines, after a passage in which variants are told apart.
TITLE_LINES, AFTER, AFTER_LINES = 3, 300, 40
# Names of files that speak for their directory and all below it.
LICENCE_FILES = ("license", "licence", "copying", "unlicense")


def terms(text: Column) -> Column:
    """Lower-case words of ASCII letters and digits; anything else separates."""
    return F.filter(F.split(F.lower(text), "[^0-9a-z]+"), lambda w: w != "")


def passages(text: Column) -> Column:
    """Lines, and sentences within lines."""
    return F.split(F.regexp_replace(text, "([.;!?]) +", "$1\n"), "\n")


def _words(text: str) -> list[str]:
    return "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()


class Weights:
    """Template vectors under the inverse document frequencies of a corpus."""

    def __init__(self, templates: list[tuple[str, str]], documents: int, frequency: dict[str, int]):
        self.unseen = math.log(1 + documents) + 1
        self.vectors = []
        for name, text in templates:
            words = _words(text)
            vector = {w: words.count(w) * (math.log((1 + documents) / (1 + frequency.get(w, 0))) + 1) for w in words}
            self.vectors.append((name, vector, math.sqrt(sum(x * x for x in vector.values()))))
        self.idf = {w: math.log((1 + documents) / (1 + frequency.get(w, 0))) + 1
                    for _, v, _ in self.vectors for w in v}

    def telling(self, least: float) -> list[str]:
        """Words of which a passage must have one to reach ``least`` with any template.

        Without a template's heaviest words, no passage comes closer to it than the length of
        the rest over its whole length.
        """
        found = set()
        for _, vector, norm in self.vectors:
            rest = sorted(vector.items(), key=lambda x: (-x[1], x[0]))
            while rest and math.sqrt(sum(x * x for _, x in rest)) >= least * norm * (1 - 1e-9):
                found.add(rest.pop(0)[0])
        return sorted(found)


def weigh(texts: DataFrame, *templates: list[tuple[str, str]]) -> list[Weights]:
    """Count in how many texts each template word occurs, over all texts.

    The driver gets a row per template word.
    """
    vocabulary = sorted({w for own in templates for _, t in own for w in _words(t)})
    known = F.array(*[F.lit(w) for w in vocabulary])
    present = texts.select(F.explode(F.array_append(
        F.array_intersect(terms(F.coalesce(F.col("text"), F.lit(""))), known), F.lit(""))).alias("word"))
    counts = {r.word: r["n"] for r in present.groupBy("word").agg(F.count("*").alias("n")).collect()}
    total = counts.pop("", 0)
    return [Weights(own, total, counts) for own in templates]


def closest(rows: DataFrame, weights: Weights, least: float) -> DataFrame:
    """Licences of cosine ``least`` to a passage, of rows file_id, line and passage."""
    spark = rows.sparkSession
    idf = spark.createDataFrame(sorted(weights.idf.items()), "word string, idf double")
    vectors = spark.createDataFrame(
        [(n, name, word, x / norm) for n, (name, vector, norm) in enumerate(weights.vectors)
         for word, x in sorted(vector.items())], "template int, licence string, word string, share double")
    # both tables have a row per word of the templates, whatever the input
    counted = (rows.select("file_id", "line", F.explode(terms(F.col("passage"))).alias("word"))
               .groupBy("file_id", "line", "word").agg(F.count("*").alias("n"))
               .join(F.broadcast(idf), "word", "left")
               .withColumn("weight", F.col("n") * F.coalesce("idf", F.lit(weights.unseen))))
    norms = counted.groupBy("file_id", "line").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("norm"))
    dots = (counted.join(F.broadcast(vectors), "word")
            .groupBy("file_id", "line", "template", "licence")
            .agg(F.sum(F.col("weight") * F.col("share")).alias("dot")))
    scored = dots.join(norms, [dots.file_id.eqNullSafe(norms.file_id), dots.line == norms.line]).select(
        dots.file_id, dots.line, "licence", F.round(F.col("dot") / F.col("norm"), 6).alias("score"))
    scored = scored.filter(F.col("score") >= least)
    # of several variants that are close enough, the words after the passage decide
    places = rows.select(F.col("file_id").alias("of"), F.col("line").alias("at"), "passage", "context").distinct()
    found = scored.join(places, [scored.file_id.eqNullSafe(places.of), scored.line == places["at"]])
    family, own = family_of(F.col("licence")), joined(F.col("passage"))
    has = F.lit(False)
    for name, pattern in FAMILIES.items():
        has = F.when(family == name, own.rlike(pattern)).otherwise(has)
    known = family.isin(*FAMILIES)
    return found.filter(has | ~known).select("file_id", variant(F.col("licence"), F.col("context")).alias("licence"), "score")


def joined(text: Column) -> Column:
    """The words in a row: comment marks, punctuation and line ends are single blanks."""
    return F.trim(F.regexp_replace(F.lower(text), "[^0-9a-z]+", " "))


def family_of(licence: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(licence, "^[A-Za-z]+0?", 0), "^[AL]GPL$", "GPL")


def variant(licence: Column, context: Column) -> Column:
    """The licence of its family that the words of ``context`` name, else ``licence`` itself."""
    def part(pattern: str, group: int) -> Column:
        return F.regexp_extract(context, pattern, group)

    def version(pattern: str, group: int) -> Column:
        minor = part(pattern, group + 1)
        return F.concat(part(pattern, group), F.lit("."), F.when(minor == "", "0").otherwise(minor))

    named = r"(?:(affero|lesser|library) )?(?:general public license|\b([al]?)gpl)"
    since = (r"(?:general public license|gpl)(?: as published by the free software foundation)?"
             r"(?: either)?(?: version| v)? ?v?([123])(?: ([01])\b)?(?![0-9])")
    kind = F.when((part(named, 1) == "affero") | (part(named, 2) == "a"), "AGPL").when(
        (part(named, 1) != "") | (part(named, 2) == "l"), "LGPL").otherwise("GPL")
    gpl = F.when(part(since, 1) != "", F.concat(kind, F.lit("-"), version(since, 1))).when(
        kind == "AGPL", "AGPL-3.0").when(kind == "LGPL", "LGPL").otherwise(licence)
    apache = r"apache(?: software)?(?: license)?(?: version| v)? ?v?([12])(?: ([01])\b)?(?![0-9])"
    mozilla = r"(?:mozilla public license|mpl)(?: version| v)? ?([12])(?: ([01])\b)?(?![0-9])"
    clause = part(r"\b(?:bsd ([234]) clause|([234]) clause bsd)", 0)
    first = part("redistribution and use.*?(all advertising materials|neither the name|this software is provided)", 1)
    bsd = (F.when(clause != "", F.concat(F.lit("BSD-"), F.regexp_extract(clause, "[234]", 0), F.lit("-Clause")))
           .when(first == "all advertising materials", "BSD-4-Clause").when(first == "neither the name", "BSD-3-Clause")
           .when(first != "", "BSD-2-Clause").otherwise(licence))
    commons = (r"\b(?:cc by|attribution)((?: (?:nc|sa|nd|non ?commercial|share ?alike|no ?deriv(?:ative)?s?))*)"
               r"(?: license)?(?: version)?(?: ([1-4]) ([05])\b)?")
    terms_of = part(commons, 1)
    cc = F.when(part(commons, 0) == "", licence).otherwise(F.concat(
        F.lit("CC-BY"), F.when(terms_of.rlike("nc|commercial"), "-NC").otherwise(""),
        F.when(terms_of.rlike("sa|alike"), "-SA").otherwise(""), F.when(terms_of.rlike("nd|deriv"), "-ND").otherwise(""),
        F.lit("-"), F.when(part(commons, 2) == "", "4.0").otherwise(version(commons, 2))))
    family = family_of(licence)
    return (F.when(family == "GPL", gpl).when(family == "BSD", bsd).when(family == "CC", cc)
            .when((family == "Apache") & (part(apache, 1) != ""), F.concat(F.lit("Apache-"), version(apache, 1)))
            .when((family == "MPL") & (part(mozilla, 1) != ""), F.concat(F.lit("MPL-"), version(mozilla, 1)))
            .otherwise(licence))


def windows(texts: DataFrame) -> DataFrame:
    """Joined stretches of texts that speak of licences: file_id, line (a key), passage, context.

    Titles are one to three consecutive lines that have words. Notices are as many words as
    the notice has, beginning at every quarter of it, where its family's words are in reach.
    """
    rows = texts.withColumn("lines", F.filter(
        F.transform(F.split("text", "\n"), joined), lambda x: x != "")).filter(F.size("lines") > 0)
    rows = materialize(rows.select("file_id", "lines", terms(F.col("text")).alias("words")), "marked")
    titles = (rows.select("file_id", "lines", F.explode(F.sequence(F.lit(0), F.size("lines") - 1)).alias("at"))
              .select("file_id", "at", "lines",
                      F.explode(F.array(*[F.lit(n) for n in range(1, TITLE_LINES + 1)])).alias("n"))
              .filter(F.col("at") + F.col("n") <= F.size("lines"))
              .select("file_id", F.concat_ws("-", F.lit("title"), "n", "at").alias("line"),
                      F.array_join(F.slice("lines", F.col("at") + 1, F.col("n")), " ").alias("passage"),
                      F.array_join(F.slice("lines", F.col("at") + 1, F.lit(AFTER_LINES)), " ").alias("context"))
              .filter(F.size(F.split("passage", " ")) <= 24)
              .filter(F.col("passage").rlike("|".join(FAMILIES.values()))))
    kinds = sorted({(name, len(_words(text))) for name, text in NOTICES})
    wanted = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(FAMILIES[_family(name)]).alias("needs")) for name, n in kinds])
    text = F.array_join("words", " ")
    notices = (rows.select("file_id", "words", text.alias("whole"), F.explode(wanted).alias("kind"))
               .select("file_id", "words", "whole", "kind.n", "kind.needs").filter(F.expr("rlike(whole, needs)"))
               .select("file_id", "words", "n", "needs", F.explode(F.expr(
                   "sequence(0, size(words) - 1, n div 4)")).alias("at"))
               .withColumn("passage", F.array_join(F.slice("words", F.col("at") + 1, F.col("n")), " "))
               .filter(F.expr("rlike(passage, needs)"))
               .select("file_id", F.concat_ws("-", F.lit("notice"), "n", "at").alias("line"), "passage",
                       F.array_join(F.slice("words", F.col("at") + 1, F.col("n") + AFTER), " ").alias("context")))
    return titles.union(notices).distinct()


def _family(name: str) -> str:
    return "GPL" if "GPL" in name else name.split("-")[0]


def declared(files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES,
             least: float = LEAST_COSINE) -> DataFrame:
    """The licence that each file's closest passage declares: file_id, licence, score.

    Passages are lines and sentences for ``templates``, joined lines for titles, and joined
    words for published notices. Versions and clauses named in or after a passage decide
    between the variants of a licence. Files without a passage of cosine ``least`` are left
    out. Words that no template has count with the weight of a word that no text has.
    Lines without any telling word cannot reach the cosine and are dropped before they are
    taken apart. Of equal scores the first licence by name is given; a file_id that repeats
    gives one row.
    """
    texts = files.select("file_id", F.col("text").cast("string").alias("text"))
    weights, wider = weigh(texts, templates, [*NOTICES, *TITLES])
    telling = "(?<![0-9a-z])(" + "|".join(weights.telling(least)) + ")(?![0-9a-z])"
    lines = (texts.filter(F.lower("text").rlike(telling))
             .withColumn("parts", passages(F.col("text")))
             .select("file_id", "parts", F.posexplode("parts").alias("line", "passage"))
             .filter(F.lower("passage").rlike(telling))
             .select("file_id", "line", "passage", joined(F.array_join(
                 F.slice("parts", F.col("line") + 1, F.lit(AFTER_LINES)), " ")).alias("context")))
    marks = "licen[sc]e|spdx|creative commons|cc0|attribution|permission|redistribution"
    marked = texts.filter(F.lower("text").rlike(marks))
    lines = materialize(lines, "lines")
    found = closest(lines, weights, least).union(closest(materialize(windows(marked), "windows"), wider, least))
    best = F.min(F.struct((-F.col("score")).alias("rank"), "licence"))
    return found.groupBy("file_id").agg(best.alias("best")).select(
        "file_id", F.col("best.licence").alias("licence"), (-F.col("best.rank")).alias("score"))


def folder_of(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def licences(files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES,
             least: float = LEAST_COSINE) -> DataFrame:
    """The licence of every file: its own, or that of the nearest directory above it.

    ``files`` has file_id, path and text. Rows: file_id, path, own_licence and own_score (of
    the file's own text), inherited_licence and inherited_from (the directory, itself included,
    that has a licence file of a declared licence; ``""`` is the root), and licence, the
    first of the two there is. Of several licence files in a directory that of the highest score
    counts, then the first licence by name. Null paths inherit nothing; null and empty texts
    declare nothing; repeated rows stay.

    Directories are made distinct before their ancestors are listed, so a directory with very
    many files costs as much as any other, and each path gives one row per level.
    """
    own = materialize(declared(files, templates, least), "declared")
    rows = files.select("file_id", "path", folder_of(F.col("path")).alias("folder"))
    name = F.lower(F.regexp_replace(F.regexp_replace("path", "^.*/", ""), "[.][^.]*$", ""))
    speaking = rows.filter(name.isin(*LICENCE_FILES)).join(own, "file_id")
    best = F.min(F.struct((-F.col("score")).alias("rank"), "licence"))
    above = materialize(speaking.groupBy("folder").agg(best.alias("best")).select(
        F.col("folder").alias("ancestor"), F.col("best.licence").alias("inherited_licence")), "above")
    steps = F.split("folder", "/")
    folders = rows.select("folder").filter("folder is not null").distinct()
    levels = folders.select("folder", F.explode(F.sequence(F.lit(0), F.size(steps))).alias("depth")).filter(
        (F.col("folder") != "") | (F.col("depth") == 0))
    climbed = levels.withColumn("ancestor", F.array_join(F.slice(steps, F.lit(1), F.col("depth")), "/"))
    nearest = F.max(F.struct("depth", "ancestor", "inherited_licence"))
    inherited = materialize(
        climbed.join(above, "ancestor").groupBy("folder").agg(nearest.alias("at")).select(
            "folder", F.col("at.inherited_licence").alias("inherited_licence"),
            F.col("at.ancestor").alias("inherited_from")), "inherited")
    owned = own.select("file_id", F.col("licence").alias("own_licence"), F.col("score").alias("own_score"))
    return (rows.join(owned, "file_id", "left").join(inherited, "folder", "left").select(
        "file_id", "path", "own_licence", "own_score", "inherited_licence", "inherited_from",
        F.coalesce("own_licence", "inherited_licence").alias("licence")))


# The tables have no paths. Documents lie one to three levels below their source, and every
# fourth is its directory's licence file.
PATH_SQL = """concat(source, '/', concat_ws('/', cast(doc_id DIV 4096 AS string),
    CASE WHEN doc_id % 3 > 0 THEN cast(doc_id DIV 256 AS string) END,
    CASE WHEN doc_id % 3 > 1 THEN cast(doc_id DIV 16 AS string) END,
    CASE WHEN doc_id % 4 = 0 THEN 'LICENSE' ELSE concat(cast(doc_id AS string), '.txt') END))"""


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = load(spark, sf_dir, "documents")
    files = documents.select(F.col("doc_id").alias("file_id"), F.expr(PATH_SQL).alias("path"), "text")
    return licences(files).withColumnRenamed("file_id", "doc_id")


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(repr(x) if isinstance(x, int) else "'" + x + "'" for x in r) + ")" for r in rows)


LICENCE_SQL = f"""
WITH files AS (
    SELECT doc_id, coalesce(lower(text), '') AS text,
      {PATH_SQL.replace("DIV", "//").replace("AS string", "AS VARCHAR")} AS path FROM documents),
  words AS (
    SELECT template, licence, unnest(list_filter(regexp_split_to_array(lower(t), '[^0-9a-z]+'), lambda x: x <> '')) AS word
    FROM (VALUES {_values([(n, *t) for n, t in enumerate(TEMPLATES)])}) v(template, licence, t)),
  total AS (SELECT count(*) AS n FROM files),
  present AS (
    SELECT word, count(*) AS df FROM (
      SELECT DISTINCT doc_id, unnest(list_filter(regexp_split_to_array(text, '[^0-9a-z]+'), lambda x: x <> '')) AS word
      FROM files) GROUP BY word),
  idf AS (
    SELECT word, ln((1 + n) / (1 + coalesce(df, 0))) + 1 AS idf
    FROM (SELECT DISTINCT word FROM words) LEFT JOIN present USING (word), total),
  vectors AS (
    SELECT template, licence, word, w / sqrt(sum(w * w) OVER (PARTITION BY template)) AS share
    FROM (SELECT template, licence, word, count(*) * any_value(idf) AS w FROM words JOIN idf USING (word)
          GROUP BY template, licence, word)),
  lines AS (
    SELECT doc_id, unnest(range(len(p))) AS line, unnest(p) AS passage
    FROM (SELECT doc_id, string_split(regexp_replace(text, '([.;!?]) +', '\\1' || chr(10), 'g'), chr(10)) AS p FROM files)),
  counted AS (
    SELECT doc_id, line, word, count(*) AS c FROM (
      SELECT doc_id, line, unnest(list_filter(regexp_split_to_array(passage, '[^0-9a-z]+'), lambda x: x <> '')) AS word
      FROM lines) GROUP BY ALL),
  weighted AS (
    SELECT doc_id, line, word, c * coalesce(idf, ln(1 + n) + 1) AS w FROM counted LEFT JOIN idf USING (word), total),
  norms AS (SELECT doc_id, line, sqrt(sum(w * w)) AS norm FROM weighted GROUP BY doc_id, line),
  scored AS (
    SELECT doc_id, licence, round(sum(w * share) / any_value(norm), 6) AS score
    FROM weighted JOIN vectors USING (word) JOIN norms USING (doc_id, line) GROUP BY doc_id, line, template, licence),
  own AS (
    SELECT doc_id, licence AS own_licence, score AS own_score FROM scored WHERE score >= {LEAST_COSINE}
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, licence) = 1),
  placed AS (SELECT doc_id, path, regexp_replace(path, '/?[^/]*$', '') AS folder FROM files),
  above AS (
    SELECT folder AS ancestor, own_licence FROM placed JOIN own USING (doc_id) WHERE path LIKE '%/LICENSE'
    QUALIFY row_number() OVER (PARTITION BY folder ORDER BY own_score DESC, own_licence) = 1),
  inherited AS (
    SELECT folder, ancestor, own_licence AS inherited_licence
    FROM (SELECT DISTINCT folder FROM placed) JOIN above ON starts_with(folder || '/', ancestor || '/')
    QUALIFY row_number() OVER (PARTITION BY folder ORDER BY length(ancestor) DESC) = 1)
SELECT doc_id, path, own_licence, own_score, inherited_licence, ancestor AS inherited_from,
  coalesce(own_licence, inherited_licence) AS licence
FROM placed LEFT JOIN own USING (doc_id) LEFT JOIN inherited USING (folder)
"""
