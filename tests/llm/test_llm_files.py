"""Token stores, archives, shards and licences, against plain versions and by their laws."""

import json
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from samples import odd_texts, sentence
from pyspark.sql import functions as F

from marquee.llm import licences, sharding, token_store, warc
from marquee.llm.common import filesystem
from marquee.llm.perfect_hash import PerfectHash
from marquee.session import scratch_path
from marquee.sources.tables import materialize


# --- token store ----------------------------------------------------------

def stored(spark, documents):
    path = scratch_path(spark, "store")
    token_store.write_store(documents, path)
    return path


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(0).integers(-1 << 63, 1 << 63, 50_000))
    made = PerfectHash.build(keys)
    again, values = PerfectHash.unpack(made.pack(place=np.arange(len(keys))))
    slots = again.find(keys)
    assert sorted(slots) == list(range(len(keys))) == values["place"].tolist()
    others = np.setdiff1d(np.random.default_rng(1).integers(-1 << 63, 1 << 63, 50_000), keys)
    assert (again.find(others) >= 0).mean() < 1e-3
    assert PerfectHash.unpack(PerfectHash.build(keys[:0]).pack())[0].find(keys[:3]).tolist() == [-1] * 3
    with pytest.raises(ValueError):
        PerfectHash.build(np.array([1, 1]))


def test_token_store_by_key(spark, given):
    documents, rows = given
    path = stored(spark, documents.repartition(3))
    want = brute.tokens(sorted(rows))
    places = token_store.locate(documents, path)
    got = token_store.read_ids(places, path, "<u2", token_store.checksum, "ids_crc32 long")
    assert sorted(tuple(r) for r in got.collect()) == want
    absent = spark.createDataFrame([(-1,), (10 ** 12,), (None,), (rows[0][0],), (rows[0][0],)], "doc_id long")
    assert [r.doc_id for r in token_store.locate(absent, path).collect()] == [rows[0][0]]


def test_token_store_of_odd_rows(spark, odd, none):
    path = stored(spark, odd)
    entries = spark.read.parquet(f"{path}/entries").join(spark.read.parquet(f"{path}/shards"), ["shard", "file"])
    rows = entries.orderBy("shard", "place").collect()
    keys = [(r.doc_id is not None, r.doc_id) for r in rows]
    assert keys == sorted(keys) and len(rows) == len(odd_texts())
    ends = np.cumsum([r.n_tokens for r in rows])
    assert [r.before + r.place for r in rows] == [0, *ends[:-1]]
    every = token_store.read_ids(entries, path, "<u2", token_store.checksum, "ids_crc32 long")
    got = Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in every.collect())
    assert got == Counter((d, n, c) for d, _, n, c in brute.tokens(odd_texts()))
    assert token_store.locate(odd, path).count() == len({d for d, _ in odd_texts()} - {None})
    path = stored(spark, none)
    assert token_store.locate(odd, path).count() == 0


# --- archives -------------------------------------------------------------

PAGES = [(1, "a" * 1000), (2, "a" * 1000), (3, "a" * 999), (4, "a" * 999), (5, None), (6, ""), (7, "é" * 500),
         (8, "é" * 500), (8, "é" * 500), (None, "é" * 500), (None, "z" * 2000), (None, "z" * 2000),
         (9, "x\r\n\r\nWARC/1.1\r\n" * 200), (-4, sentence(1, 200_000))]
WARC = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def pages(spark):
    rows = [(p, None if k % 5 == 0 else f"http://h/é{k}\r\nX: 1", h, k, "c") for k, (p, h) in enumerate(PAGES)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest long, payload string")


def test_archives(spark, same):
    folder = scratch_path(spark, "warc")
    crawled = warc.write_archives(warc.planned(pages(spark)), f"{folder}/a")
    members = warc.normalise(crawled, f"{folder}/b")
    same(warc.read_archives(members), brute.warc(PAGES), *WARC)
    again = warc.normalise(members, f"{folder}/c")  # members are taken as well as whole streams
    same(warc.read_archives(again), brute.warc(PAGES), *WARC)
    nothing = warc.write_archives(warc.planned(pages(spark).limit(0)), f"{folder}/d")
    assert warc.read_archives(warc.normalise(nothing, f"{folder}/e")).count() == 0


def test_every_record_is_a_member(spark):
    folder = scratch_path(spark, "warc")
    crawled = warc.write_archives(warc.planned(pages(spark).coalesce(1)), f"{folder}/a").first()
    fs, path = filesystem(crawled.file)
    whole = zlib.decompressobj(wbits=31)
    text = whole.decompress(fs.open_input_file(path).read())
    assert whole.eof and not whole.unused_data and text.count(b"WARC-Record-ID") == len(PAGES)
    made = warc.normalise(spark.createDataFrame([crawled]), f"{folder}/b").first()
    fs, path = filesystem(made.file)
    held = fs.open_input_file(path).read()
    index = [json.loads(x) for x in fs.open_input_stream(f"{path}.index", compression=None).read().splitlines()]
    assert sum(x["length"] for x in index) == len(held)
    parts = [zlib.decompress(held[x["offset"]:x["offset"] + x["length"]], wbits=31) for x in index]
    assert b"".join(parts) == text and all(p.startswith(b"WARC/1.1\r\n") for p in parts)


def test_cut_off_archives_fail():
    with pytest.raises(ValueError):
        list(warc.records(iter([warc.record(1, None, b"abc", "d", None)[:-3]])))


# --- shards ---------------------------------------------------------------

def laws(rows, texts, shards=8, slack=0.02):
    sizes, slots = Counter(), defaultdict(list)
    for r in rows:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
    for own in slots.values():
        assert sorted(own) == list(range(len(own)))
    got = Counter((r.doc_id, r.size, r.text_crc32) for r in rows)
    assert got == Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts)
    fair = sum(sizes.values()) / shards
    most = max((r.size for r in rows), default=0)
    assert all(abs(sizes[s] - fair) <= slack * fair + 2 * most for s in range(shards)), sizes


def test_shards(odd, given, none):
    laws(sharding.shard(given[0]).collect(), given[1])
    laws(sharding.shard(odd).collect(), odd_texts())
    assert sharding.shard(none).count() == 0
    with pytest.raises(ValueError):
        sharding.shard(none, shards=0)


def test_shards_of_hot_texts(spark):
    """A text with two thirds of all rows, a row repeated very often, and one large row."""
    rows = [(k if k % 3 else 7, "same text" if k % 2 else f"text {k}") for k in range(30_000)]
    rows += [(7, "repeated")] * 20_000 + [(-1, "x" * 20_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = sharding.shard(df, shards=8, ranges=256).collect()
    laws(found, rows, slack=0.05)


def test_equal_texts_stay_together(spark):
    rows = [(k, f"text {k // 4}") for k in range(8000)]
    found = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    where = defaultdict(set)
    for r in found:
        where[r.text_crc32].add(r.shard)
    assert sum(len(x) > 1 for x in where.values()) <= 7


# --- licences -------------------------------------------------------------

def test_licences(spark):
    apache, mit = licences.TEMPLATES[0][1], licences.TEMPLATES[2][1]
    files = [
        (1, "a/LICENSE", "Intro\n" + apache), (2, "a/x.txt", "nothing"), (3, "a/b/y.txt", None),
        (4, "a/b/c/z.txt", f"Some words. {mit} More words."), (5, "a/b/c/COPYING.md", mit.upper()),
        (6, "a/b/c/d/w.txt", ""), (7, "ab/v.txt", "licensed"), (8, "top.txt", "x"), (9, None, mit),
        (None, "a/n.txt", mit), (10, "a/b/license", "no wording known here"), (11, "/a/x", "of the license"),
        (2, "a/x.txt", "nothing"),
    ] + [(100 + k, f"z/{k % 3}/f", sentence(k, 30)) for k in range(40)]
    df = spark.createDataFrame(files, "file_id long, path string, text string").withColumn("licence", F.lit("c"))
    got = {(r.file_id, r.path): r for r in licences.licences(df).collect() if r.file_id is None or r.file_id < 100}
    want = {(1, "a/LICENSE"): "Apache-2.0", (2, "a/x.txt"): "Apache-2.0", (3, "a/b/y.txt"): "Apache-2.0",
            (4, "a/b/c/z.txt"): "MIT", (5, "a/b/c/COPYING.md"): "MIT", (6, "a/b/c/d/w.txt"): "MIT",
            (7, "ab/v.txt"): None, (8, "top.txt"): None, (9, None): "MIT", (10, "a/b/license"): "Apache-2.0",
            (11, "/a/x"): None}
    assert {k: got[k].licence for k in want} == want
    assert got[6, "a/b/c/d/w.txt"].inherited_from == "a/b/c" and got[4, "a/b/c/z.txt"].own_score == 1
    assert licences.licences(df).count() == len(files)
    assert licences.licences(df.limit(0)).count() == 0


WRAPPED_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
BSD = [""" * Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions
 * are met:
 * 1. Redistributions of source code must retain the above copyright
 *    notice, this list of conditions and the following disclaimer.
 * 2. Redistributions in binary form must reproduce the above copyright
 *    notice, this list of conditions and the following disclaimer in the
 *    documentation and/or other materials provided with the distribution.
""", """ * 3. Neither the name of the University nor the names of its contributors
 *    may be used to endorse or promote products derived from this software.
""", """ * THIS SOFTWARE IS PROVIDED BY THE REGENTS AND CONTRIBUTORS ``AS IS'' AND
 * ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED."""]
GPL = """# This program is free software; you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation; either version {} of the License, or
# (at your option) any later version."""
APACHE = """// Licensed under the Apache License, Version 2.0 (the "License");
// you may not use this file except in compliance with the License.
// You may obtain a copy of the License at
//
//     http://www.apache.org/licenses/LICENSE-2.0"""


def test_published_notices(spark):
    """Wrapped and commented notices, titles and identifiers, among prose and alone."""
    prose = sentence(7, 300)
    cases = [
        ("MIT License\n\nCopyright (c) 2020 A\n\n" + WRAPPED_MIT, "MIT"), (prose + "\n" + WRAPPED_MIT + "\n" + prose, "MIT"),
        ("The MIT License (MIT)", "MIT"), ("MIT License", "MIT"),
        ("/*\n" + BSD[0] + BSD[1] + BSD[2], "BSD-3-Clause"), ("/*\n" + BSD[0] + BSD[2], "BSD-2-Clause"),
        (prose + "\n" + BSD[0] + BSD[2], "BSD-2-Clause"),
        (GPL.format(2), "GPL-2.0"), (prose + "\n" + GPL.format(3) + "\n" + prose, "GPL-3.0"),
        (GPL.format("2.1").replace("GNU General", "GNU Lesser General"), "LGPL-2.1"),
        (APACHE, "Apache-2.0"), (prose + "\n" + APACHE + "\n" + prose, "Apache-2.0"),
        ("        GNU GENERAL PUBLIC LICENSE\n          Version 3, 29 June 2007\n" + prose, "GPL-3.0"),
        ("GNU GENERAL PUBLIC LICENSE\nVersion 3", "GPL-3.0"), ("GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991", "GPL-2.0"),
        ("# SPDX-License-Identifier: MIT\nimport x", "MIT"), ("// SPDX-License-Identifier: GPL-2.0-only\n", "GPL-2.0"),
        ("/* SPDX-License-Identifier: Apache-2.0 */", "Apache-2.0"), ("# SPDX-License-Identifier: BSD-2-Clause", "BSD-2-Clause"),
        ("# SPDX-License-Identifier: EPL-2.0", None), ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
        ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"), ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
        (prose, None), ("Please read the license before use of the software.", None),
    ]
    rows = [(k, f"{k}/LICENSE", t) for k, (t, _) in enumerate(cases)] + [(k + 100, f"{k}/a/b", "") for k in range(len(cases))]
    rows += [(1000 + k, f"z/{k}", sentence(k, 40)) for k in range(200)]
    found = licences.licences(spark.createDataFrame(rows, "file_id long, path string, text string").repartition(4))
    got = {r.file_id: r.licence for r in found.collect()}
    assert [(got[k], got[k + 100]) for k in range(len(cases))] == [(want, want) for _, want in cases]


def test_no_python_on_the_native_path(spark, given):
    for df in (sharding.shard(given[0]), licences.licences(given[0].selectExpr("doc_id AS file_id", "source AS path", "text"))):
        plan = df._jdf.queryExecution().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
        materialize(df, "native")
