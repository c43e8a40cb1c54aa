"""Finding licence notices in documents by diagonal voting.

1. **Index.** Every ``K`` consecutive words of a template have a hash and a place.
2. **Votes.** All rolling word hashes of all documents are joined with the templates' ones.
   A match at document word ``p`` and template word ``t`` votes for the diagonal ``p - t``.
   Votes are added up by document, template and diagonal, before and after the shuffle, so a
   notice that a third of all documents hold is a row for each document and no more.
3. **Diagonals.** A word put in or left out moves the rest of a notice to a neighbouring
   diagonal.  Diagonals of one document and template at most ``SLACK`` apart (a quarter of the
   template, if that is less) are one candidate, if it has enough votes (``VOTES``).
4. **Spans.** Candidates are compared with the document word by word.  A candidate is a
   span if at least ``SHARE`` of the template's words stand where one of its diagonals puts
   them.  Hashes alone decide nothing.

Beside this, fixed phrases are looked for as such (``PHRASES``).

Only DataFrame functions are used.  What is broadcast is counted first.

Defined results: null and empty texts have no words and no spans; templates of fewer than
``K`` words are never found; repeated documents each get their row, and equal rows vote once;
texts that share an id are told apart by hash; an empty table gives an empty result; other
columns are not read.  Texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vendora.llm.common import sized_broadcast, text_of
from vendora.llm.decontamination import BROADCAST_WORDS, distinct_rows, words
from vendora.session import settle

K = 5
SLACK = 8
# Least share of a template's hashes that vote for a candidate, and of its words in a span.
VOTES = 0.25
SHARE = 0.8

# --- Fixed values: phrases and notices ------------------------------------------------
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

TEMPLATES = [
    ("mit", "Released under the MIT License."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required "
        "by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
        "language governing permissions and limitations under the License.",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
        "details.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
]


def grams(w: Column, k: int) -> Column:
    """Hashes of all ``k`` consecutive words of the array ``w``."""
    n = F.size(w) - k
    rolled = F.transform(F.sequence(F.lit(0), n), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]))
    return F.when(n >= 0, rolled).otherwise(F.array().cast("array<bigint>"))


def template_table(spark: SparkSession, templates: list[tuple[str, str]], k: int) -> DataFrame:
    """Stored rows ``(template, label, words, slack, least)``."""
    rows = [(i, label, text) for i, (label, text) in enumerate(templates)]
    n = F.size("words")
    return settle(
        spark.createDataFrame(rows, "template int, label string, text string")
        .select("template", "label", words("text").alias("words"))
        .withColumn("slack", F.least(F.lit(SLACK), F.floor(n / 4)).cast("int"))
        .withColumn("least", F.greatest(F.lit(1), F.ceil(VOTES * (n - k + 1)))),
        "templates",
    )


def candidates(docs: DataFrame, templates: DataFrame, k: int = K) -> DataFrame:
    """Rows ``(id, key, template, votes, diagonals)`` for ``docs (id, key, text)``, one for each
    bundle of neighbouring diagonals with enough votes."""
    index = templates.select("template", F.posexplode(grams(F.col("words"), k)).alias("t", "gram"))
    rolled = (
        distinct_rows(docs)
        .select("id", "key", words("text").alias("w"))
        .select("id", "key", F.posexplode(grams(F.col("w"), k)).alias("p", "gram"))
    )
    votes = (
        rolled.join(sized_broadcast(settle(index, "template_grams"), BROADCAST_WORDS), "gram")
        .groupBy("id", "key", "template", (F.col("p") - F.col("t")).alias("diagonal"))
        .agg(F.count("*").alias("votes"))
    )
    # At most as many rows as the document has words.
    along = W.partitionBy("id", "key", "template").orderBy("diagonal")
    sizes = sized_broadcast(templates.select("template", "slack", "least"), BROADCAST_WORDS)
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > F.col("slack"), F.lit(True))
    return (
        votes.join(sizes, "template")
        .withColumn("apart", apart.cast("int"))
        .withColumn("bundle", F.sum("apart").over(along))
        .groupBy("id", "key", "template", "bundle")
        .agg(F.sum("votes").alias("votes"), F.max("least").alias("least"), F.sort_array(F.collect_list("diagonal")).alias("diagonals"))
        .filter(F.col("votes") >= F.col("least"))
        .select("id", "key", "template", "votes", "diagonals")
    )


def verified(docs: DataFrame, found: DataFrame, templates: DataFrame, share: float = SHARE) -> DataFrame:
    """Rows ``(id, key, spans)``: label, first and last word, share of the template's words."""
    found = settle(found, "candidates")
    of_doc = settle(
        found.groupBy("id", "key").agg(F.collect_list(F.struct("template", "votes", "diagonals")).alias("tries")), "tried"
    )
    held = F.aggregate("tries", F.lit(1), lambda n, t: n + 4 + F.size(t["diagonals"]))
    d, c = docs.alias("d"), sized_broadcast(of_doc, BROADCAST_WORDS, held).alias("c")
    same = F.col("d.id").eqNullSafe(F.col("c.id")) & (F.col("d.key") == F.col("c.key"))
    tried = (
        d.join(c, same)
        .select("d.id", "d.key", words("d.text").alias("w"), "tries")
        .select("id", "key", "w", F.explode("tries").alias("t"))
        .select("id", "key", "w", "t.template", "t.votes", "t.diagonals")
        .join(sized_broadcast(templates, BROADCAST_WORDS, F.size("words") + 1), "template")
    )
    at = lambda p: F.when(p >= 0, F.get("w", p))
    places = F.transform(
        "words", lambda x, t: F.get(F.filter("diagonals", lambda g: F.coalesce(at(g + t) == x, F.lit(False))), F.lit(0)) + t
    )
    return (
        tried.withColumn("places", F.filter(places, lambda p: p.isNotNull()))
        .withColumn("share", F.size("places") / F.size("words"))
        .filter(F.col("share") >= share)
        .groupBy("id", "key")
        .agg(
            F.array_sort(
                F.collect_set(
                    F.struct(
                        F.array_min("places").alias("first"), F.array_max("places").alias("last"), "label", "template", "share"
                    )
                )
            ).alias("spans")
        )
    )


def phrase_places(w: Column, phrase: str) -> Column:
    """Starts of a phrase in the array ``w``; most documents lack its last word and are not walked."""
    parts = phrase.split(" ")
    last = F.size(w) - len(parts)

    def here(i: Column) -> Column:
        agrees = F.lit(True)
        for j, part in enumerate(parts):
            agrees = agrees & (F.get(w, i + j) == part)
        return agrees

    may = F.array_contains(w, parts[-1]) & (last >= 0)
    return F.when(may, F.filter(F.sequence(F.lit(0), last), here)).otherwise(F.array().cast("array<int>"))


def scan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    templates: list[tuple[str, str]] = TEMPLATES,
    phrases: list[tuple[str, str]] = PHRASES,
    k: int = K,
    share: float = SHARE,
) -> DataFrame:
    """Per document its id, ``n_words``, ``phrases`` (start and label of each phrase), and
    ``spans`` (first and last word, label, number of the template, share of its words)."""
    listed = template_table(docs.sparkSession, templates, k)
    given = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text_of(text)).alias("key"), text_of(text).alias("text"))
    spans = settle(verified(given, candidates(given, listed, k), listed, share), "spans")
    d, s = given.alias("d"), sized_broadcast(spans, BROADCAST_WORDS, 8 * F.size("spans") + 1).alias("s")
    same = F.col("d.id").eqNullSafe(F.col("s.id")) & (F.col("d.key") == F.col("s.key"))
    both = d.join(s, same, "left").select(F.col("d.id").alias(doc_id), words("d.text").alias("w"), "spans")
    started = [
        F.transform(phrase_places(F.col("w"), p), (lambda label: lambda i: F.struct(i.alias("start"), label.alias("label")))(F.lit(x)))
        for p, x in phrases
    ]
    return both.select(
        doc_id,
        F.size("w").alias("n_words"),
        F.array_sort(F.concat(*started)).alias("phrases"),
        F.coalesce("spans", F.array()).alias("spans"),
    )


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **more) -> DataFrame:
    """Per document its words, phrases, labels and score: the largest share of a template's
    words in a span, or 1 for a phrase, which is found whole."""
    base = F.array_distinct(F.transform("phrases", lambda x: x["label"]))
    method = F.transform("spans", lambda x: x["label"])
    best = F.array_max(F.transform("spans", lambda x: x["share"]))
    return scan(docs, doc_id, text, **more).select(
        doc_id,
        F.col("n_words").cast("long").alias("n_words"),
        F.size("phrases").cast("long").alias("n_base"),
        F.get("phrases", F.lit(0))["start"].cast("long").alias("first_word"),
        F.array_max(F.transform("phrases", lambda x: x["start"])).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, method)), ",").alias("labels"),
        F.when(F.size("phrases") > 0, F.lit(1.0)).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"),
        F.size("spans").cast("long").alias("n_spans"),
    )
