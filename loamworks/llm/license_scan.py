"""Licence notices found by MinHash bands over overlapping windows. DataFrame operations only.

For each length that a template has, windows of that many five-word shingles slide over the text by an eighth of their
length. A window that shares no shingle with any template can match none, so only windows around shared shingles are
signed. Signatures of equal bands retrieve templates; the exact share of the template's shingles that the window (and
a step to either side) holds decides.

A template of which 0.8 is present has a window no further than a sixteenth of its length from it, whose similarity is
0.58 at least; 16 bands of 2 rows then meet with probability 1 - (1 - 0.58^2)^16 = 0.998, and more for whole copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORDS = 5
CONTAINMENT = 0.8
BANDS = 16
ROWS = 2
#: Template shingles that are literals of the plan, and rows of the template table that are broadcast, at most; more are
#: joined by shuffle.
LITERAL_SHINGLES = 100_000
BROADCAST_ROWS = 500_000

# Notices and short texts of public licences.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "mit-line": "Released under the MIT License.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."
    ),
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "lgpl-line": "This library is licensed under the GNU Lesser General Public License.",
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "bsd-notice": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
    ),
    "bsd-line": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies."
    ),
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0-line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc0-line": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "rights-reserved": "All rights reserved. No part of this publication may be reproduced.",
}


def shingle_hashes(text: Column) -> Column:
    """XXH64 of every run of five words (letters and digits, in lower case); none for shorter and null texts."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(
        F.filter(F.array(words), lambda w: F.size(w) >= WORDS),  # words once, by one-element array
        lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - (WORDS - 1)), lambda i: F.xxhash64(*[F.element_at(w, (i + k).cast("int")) for k in range(WORDS)])),
    )


def _first(nested: Column) -> Column:
    return F.coalesce(F.try_element_at(nested, F.lit(1)), F.array().cast("array<bigint>"))


def _bands(hashes: Column) -> Column:
    least = lambda k: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(k))))
    return F.array(*[F.xxhash64(F.lit(b), *[least(b * ROWS + r) for r in range(ROWS)]) for b in range(BANDS)])


def _slide(shingles: int) -> int:
    return max(1, shingles // 8)


def _window_starts(shared_at: Column, n: int) -> Column:
    """(n, start) of the windows of n shingles that hold a shingle at one of these places."""
    step = _slide(n)
    covering = F.transform(shared_at, lambda p: F.sequence(F.greatest(F.lit(0), F.floor((p - n + step) / step)).cast("int"), F.floor(p / step).cast("int")))
    return F.transform(F.array_distinct(F.flatten(covering)), lambda k: F.struct(F.lit(n).alias("n"), (k * step).cast("int").alias("start")))


def scan(docs: DataFrame, templates: dict[str, str], *, id_col: str = "doc_id", text_col: str = "text", containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, template_id, containment, first_word (0-based, of the best window), n_words: a row for each text and each
    template of whose five-word shingles the text holds ``containment`` or more in one window; the first best window counts.

    Null, empty and short texts match nothing; templates of under five words neither. Repeated rows (same id, same
    text) give one row; a null id is kept as null. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    listed = spark.createDataFrame(list(templates.items()), "template_id string, text string").select("template_id", F.array_distinct(_first(shingle_hashes(F.col("text")))).alias("has"), F.size(_first(shingle_hashes(F.col("text")))).alias("n"))
    listed = listed.where("n > 0")
    shingles = listed.select(F.explode("has").alias("hash")).distinct()
    sizes = sorted(r["n"] for r in listed.select("n").distinct().collect())  # the lengths of a curated list
    table = listed.select("template_id", "n", "has", F.explode(_bands(F.col("has"))).alias("band"))
    if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        table = F.broadcast(table)

    source = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).select("doc_id", F.xxhash64("text").alias("text_key"), shingle_hashes(F.col("text")).alias("nested"))
    hashed = source.select("doc_id", "text_key", F.explode("nested").alias("hashes"))
    known = [r["hash"] for r in shingles.limit(LITERAL_SHINGLES + 1).collect()]
    if len(known) <= LITERAL_SHINGLES:
        at = F.filter(F.sequence(F.lit(0), F.size("hashes") - 1), lambda i: F.get("hashes", i).isin(sorted(known)))
        shared = hashed.select("doc_id", "text_key", "hashes", at.alias("at")).where(F.size("at") > 0)
    else:  # only texts that share a shingle, found by a join on it, are looked at again
        spelt = hashed.select("doc_id", "text_key", F.posexplode("hashes").alias("place", "hash"))
        places = spelt.join(shingles, "hash").groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set("place")).alias("at"))
        first = hashed.groupBy("doc_id", "text_key").agg(F.first("hashes").alias("hashes")).withColumnRenamed("doc_id", "__id")
        shared = places.join(first, "text_key").where(F.col("doc_id").eqNullSafe(F.col("__id"))).select("doc_id", "text_key", "hashes", "at")
    starts = F.flatten(F.array(*[_window_starts(F.col("at"), n) for n in sizes]))
    step = F.greatest(F.lit(1), F.floor(F.col("n") / 8)).cast("int")
    windows = shared.select("doc_id", "text_key", "hashes", F.explode(starts).alias("w")).select("doc_id", "text_key", "hashes", "w.n", "w.start")
    begin = F.greatest(F.lit(0), F.col("start") - step)
    windows = windows.select(
        "doc_id", "text_key", "n", "start",
        F.slice("hashes", F.col("start") + 1, F.col("n")).alias("part"),
        F.slice("hashes", begin + 1, (F.col("start") + F.col("n") + step - begin).cast("int")).alias("around"),
    )
    signed = windows.select("doc_id", "text_key", "n", "start", "around", F.explode(F.array_distinct(_bands(F.col("part")))).alias("band"))
    found = signed.join(table, ["n", "band"]).select("doc_id", "text_key", "template_id", "start", "n", (F.size(F.array_intersect("around", "has")) / F.size("has")).alias("containment"))
    best = F.max(F.struct("containment", (-F.col("start")).alias("back"), "n")).alias("b")
    return found.where(F.col("containment") >= containment).groupBy("doc_id", "text_key", "template_id").agg(best).select("doc_id", "template_id", "b.containment", (-F.col("b.back")).alias("first_word"), (F.col("b.n") + WORDS - 1).alias("n_words"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"), TEMPLATES)
