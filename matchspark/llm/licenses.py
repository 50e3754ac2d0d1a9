"""License scans by diagonal voting.

Every k words in a row of a text are hashed and joined to the places in the license templates that have the same hash. A
hit votes for a diagonal: its place in the text minus its place in the template. Votes are summed by document, template and
diagonal. A diagonal is supported by all votes on diagonals at most `gap` beside it (words inserted or left out); the
supported ones of a neighbourhood are merged, wherever stray hits stand. A merged span is verified by words: the template's
words that its hits cover must be enough of the template, and the span no longer than the template and its slack.

The base phrases are templates too, and one of their places is a diagonal on which all of the phrase's hashes stand.
What is broadcast is the table of templates, which are constants here (BOUND words at most are accepted).

Words are runs of anything but ASCII characters other than letters and digits, A-Z in lower case. Null texts have none.
Rows that share a doc_id, and repeated rows, are separate documents. Labels are sorted; of spans that begin together the
template of lower number stands first. A table without rows gives none. The hits are written before they are grouped, so a
lost executor doesn't number rows anew.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ._shared import ascii_lower, materialize

K, GAP, COVER, BOUND = 3, 8, 0.6, 100_000
LICENSE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The phrases of the contract.
PHRASES = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]
#: Public license texts and the notices by which projects name their license. Each paragraph is a template.
MIT = [
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so",
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT',
]
BSD = [
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
]
BSD_3 = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"
ISC = [
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "provided that the above copyright notice and this permission notice appear in all copies",
]
APACHE = [
    "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License",
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
]
NOTICES = [
    *((t, "mit") for t in MIT), *((t, "apache-2") for t in APACHE), *((t, "bsd") for t in BSD), (BSD_3, "bsd-3"), *((t, "isc") for t in ISC),
    ("This work is licensed under the GNU General Public License, version 3", "gpl-3"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation", "gpl"),
    ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", "lgpl"),
    ("it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version", "agpl"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mpl-2"),
    ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0", "epl-2"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa"),
    ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work", "cc0"),
    ("This is free and unencumbered software released into the public domain", "unlicense"),
    ("This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software", "zlib"),
]


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(LICENSE_WORD), F.lit(0))


def hashes(w: Column, k: int) -> Column:
    """Hash of each k words in a row."""
    at = lambda i, j: F.get(w, i + j)
    return F.when(F.size(w) >= k, F.transform(F.sequence(F.lit(0), F.size(w) - k), lambda i: F.xxhash64(*[at(i, j) for j in range(k)]))).otherwise(F.array().cast("array<bigint>"))


def templates(spark: SparkSession, phrases=PHRASES, notices=NOTICES, k: int = K) -> DataFrame:
    """(hash, template, place, grams, base, label): a row for each place of each template."""
    texts = [(i, t, label, i < len(phrases)) for i, (t, label) in enumerate([*phrases, *notices])]
    if sum(len(re.findall(r"\w+", t)) for _, t, _, _ in texts) > BOUND:
        raise ValueError("too many template words to broadcast")
    table = spark.createDataFrame(texts, "template int, text string, label string, base boolean").withColumn("h", hashes(words(F.col("text")), k))
    return table.select("template", "label", "base", F.size("h").alias("grams"), F.posexplode("h").alias("place", "hash"))


def slack(words_: Column, gap: int) -> Column:
    """By how many words a span may be longer than its template."""
    return F.greatest(F.lit(2 * gap), F.floor(words_ / 2))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, cover: float = COVER, gap: int = GAP, **which) -> DataFrame:
    """(row, id_col, n_words, spans) of each row; spans: array of (template, base, label, first, last, score), words counted from 0.

    One scan; rows of the texts' words are joined where they stand, and what moves is hits and one row a document.
    """
    table = F.broadcast(templates(docs.sparkSession, k=k, **which))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), words(F.col(text_col)).alias("w"))
    # place -1 stands for the document itself and keeps its count of words
    rows = rows.select("row", "id", F.size("w").cast("long").alias("n"), F.concat(F.array(F.lit(0).cast("long")), hashes(F.col("w"), k)).alias("h"))
    each = rows.select("row", "id", "n", F.posexplode("h").alias("p", "hash")).withColumn("p", F.col("p") - 1)
    each = each.join(table, (each["hash"] == table["hash"]) & (F.col("p") >= 0), "left").where("p = -1 OR template IS NOT NULL")
    each = materialize(each.select("row", "id", "n", "p", "template", "base", "label", "grams", "place"))
    lines = each.where("p >= 0").withColumn("diagonal", F.col("p") - F.col("place")).groupBy("row", "template", "base", "label", "grams", "diagonal").agg(F.min("p").alias("low"), F.max("p").alias("high"), F.count("*").alias("votes"), F.collect_set("place").alias("places"))
    # a diagonal and those beside it; merged where the next supported one is near
    order = W.partitionBy("row", "template").orderBy("diagonal")
    beside = order.rangeBetween(-gap, gap)
    lines = lines.withColumn("support", F.when(F.col("base"), F.col("votes")).otherwise(F.sum("votes").over(beside))).where(F.when(F.col("base"), F.col("votes") >= F.col("grams")).otherwise(F.col("support") >= cover * F.col("grams") / 2))
    fresh = F.col("base") | F.lag("diagonal").over(order).isNull() | (F.col("diagonal") - F.lag("diagonal").over(order) > gap)
    merged = lines.withColumn("run", F.sum(F.when(fresh, 1).otherwise(0)).over(order))
    merged = merged.groupBy("row", "template", "base", "label", "grams", "run").agg(F.min("low").alias("first"), (F.max("high") + k - 1).alias("last"), F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("places", lambda x: F.sequence(x, x + k - 1)))))
    merged = merged.withColumn("score", F.least(covered / (F.col("grams") + k - 1), F.lit(1.0)))
    fits = F.col("last") - F.col("first") + 1 <= F.col("grams") + k - 1 + slack(F.col("grams") + k - 1, gap)
    good = merged.where(F.col("base") | ((F.col("score") >= cover) & fits))
    span = F.struct("template", "base", "label", F.col("first").cast("long").alias("first"), F.col("last").cast("long").alias("last"), F.round("score", 6).alias("score"))
    back = good.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("found"))
    none = F.array().cast(back.schema["found"].dataType)
    return each.where("p = -1").select("row", "id", "n").join(back, "row", "left").select("row", F.col("id").alias(id_col), F.col("n").alias("n_words"), F.coalesce("found", none).alias("spans"))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Places of the base phrases, labels and the best score, from scan()."""
    own = F.filter("spans", lambda s: s["base"])
    first = F.transform(own, lambda s: s["first"])
    labels = lambda c: F.array_join(F.array_sort(F.array_distinct(F.transform(c, lambda s: s["label"]))), ",")
    return found.select(id_col, "n_words", F.size(own).cast("long").alias("n_base"), F.array_min(first).alias("first_word"), F.array_max(first).alias("last_word"), labels(own).alias("base_labels"), labels(F.col("spans")).alias("labels"), F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("score"))
