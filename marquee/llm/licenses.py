"""License scans by diagonal voting.

Rolling hashes of `GRAM` words of every whole text are joined with the places of the same words in
the templates (a fixed list, sent to the executors). Each hit votes for a diagonal: the place in the
text less that in the template. Votes are counted by diagonal, diagonals that lie near each other
for the length of the template (words were put in or left out) are merged, and each merged span with
votes for a `VOTED` part of the template is verified word by word against the text: the share of the
template's words that stand on its diagonals must reach `VERIFIED`. Templates are the paragraphs of
license texts and the notices that licenses ask for. A notice that all rights are reserved says
nothing beside a license.

Besides, phrases are counted where their words stand one after the other.

Cases: a null or empty text has no words, no places and score 0. Equal texts are verified once; each
row gets its result. An empty table gives an empty result. Columns of other names take no part.
"""

from __future__ import annotations

import re
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import sent_if_small, small_batches, stored, text_key
from .words import byte_tables, chunks, mix, release, word_hashes

GRAM = 3
#: Words put in or left out at one place: at most so many, or this share of the template.
SLACK, SLACK_SHARE = 2, 0.2
VOTED = 0.25
VERIFIED = 0.85
RESERVED = "proprietary"
#: Words that tell licenses of one family apart: a span holds those of its template and no others.
TELLING = ("affero", "lesser", "nc", "nd", "noncommercial", "noderivatives", "sa", "sharealike")
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Notices as licenses ask for them or as texts give them, and their labels.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("mit", "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
            "of the Software"),
    ("mit", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED "
            "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
            "THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
            "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
            "DEALINGS IN THE SOFTWARE"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
               "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
               "See the License for the specific language governing permissions and limitations under the License"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
               "http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation"),
    ("gpl", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
            "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for "
            "more details"),
    ("gpl", "You should have received a copy of the GNU General Public License along with this program"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
            "following disclaimer"),
    ("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
            "following disclaimer in the documentation and/or other materials provided with the distribution"),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
            "products derived from this software without specific prior written permission"),
    ("bsd", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
            "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
            "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
            "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
            "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
            "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING "
            "IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
             "liable for any damages arising from the use of this software"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("bsl", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
            "accompanying documentation covered by this license"),
    ("mpl", "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    (RESERVED, "All rights reserved"),
)


def words_of(text: str) -> list[str]:
    return re.findall(WORD, text.translate({c: c + 32 for c in range(65, 91)}))


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """What parts words, and the number of each byte."""
    _, numbers = byte_tables()
    parts = np.ones(256, bool)
    parts[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
    numbers[parts] = 0
    return parts, numbers


def _word_hash(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    return word_hashes(data, np.array([0, len(data)]), *_tables())[0]


def _gram_hashes(hashes: np.ndarray, size: int = GRAM) -> np.ndarray:
    """The hash of the words from each place on."""
    out = hashes[size - 1 :]
    for j in range(size - 2, -1, -1):
        out = mix(hashes[j : len(hashes) - size + 1 + j] + mix(out))
    return out.astype(np.int64)


def _grams(batches):
    """(k1, k2, at, hash) of every place of every text."""
    parts, numbers = _tables()
    for batch in batches:
        k1, k2 = (batch.column(c).to_numpy() for c in ("k1", "k2"))
        for first, _, data, offsets in chunks(batch.column("text")):
            hashes, of, _, _ = word_hashes(data, offsets, parts, numbers)
            if len(hashes) < GRAM:
                continue
            at = np.flatnonzero(of[GRAM - 1 :] == of[: len(of) - GRAM + 1])
            begins = np.searchsorted(of, of[at])
            yield pa.RecordBatch.from_arrays([
                pa.array(k1[first + of[at]]), pa.array(k2[first + of[at]]),
                pa.array((at - begins).astype(np.int64)), pa.array(_gram_hashes(hashes)[at]),
            ], names=["k1", "k2", "at", "hash"])
    release()


def template_places(spark: SparkSession) -> DataFrame:
    """(hash, template, place): a row for each gram of the fixed list."""
    rows = [
        (int(h), number, place)
        for number, (_, text) in enumerate(TEMPLATES)
        for place, h in enumerate(_gram_hashes(_word_hash(words_of(text))).tolist())
    ]
    return spark.createDataFrame(rows, "hash long, template int, place int")


def template_words(spark: SparkSession) -> DataFrame:
    """(template, label, tokens, slack): a row for each text of the fixed list."""
    return spark.createDataFrame([
        (n, label, words_of(t), max(SLACK, int(SLACK_SHARE * len(words_of(t))))) for n, (label, t) in enumerate(TEMPLATES)
    ], "template int, label string, tokens array<string>, slack int")


def spans(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """(k1, k2, template, shifts, votes): merged diagonals of each different text, those with enough
    votes."""
    templates = F.broadcast(template_words(docs.sparkSession))
    k1, k2 = text_key(F.col(text))
    grams = docs.where(F.col(text) != "").select(k1.alias("k1"), k2.alias("k2"), F.col(text).alias("text")).mapInArrow(
        _grams, "k1 long, k2 long, at long, hash long")
    hits = grams.join(F.broadcast(template_places(docs.sparkSession)), "hash")  # the fixed list
    votes = hits.groupBy("k1", "k2", "template", (F.col("at") - F.col("place")).alias("shift")).agg(
        F.count_distinct("place").alias("votes"))
    line = Window.partitionBy("k1", "k2", "template").orderBy("shift")
    apart = F.coalesce(F.col("shift") - F.lag("shift").over(line) > F.col("slack"), F.lit(True))
    merged = (
        votes.join(templates.select("template", "slack"), "template")
        .withColumn("apart", apart.cast("long")).withColumn("span", F.sum("apart").over(line))
        .groupBy("k1", "k2", "template", "span")
        .agg(F.sort_array(F.collect_list("shift")).alias("shifts"), F.sum("votes").alias("votes")).drop("span")
    )
    grams = F.size("tokens") - (GRAM - 1)
    return merged.join(templates.select("template", "tokens"), "template").where(F.col("votes") >= VOTED * grams).drop("tokens")


def verified(docs: DataFrame, found: DataFrame, *, text: str = "text") -> DataFrame:
    """(k1, k2, score, labels): the spans that hold, by text; score is the best share of a template."""
    spark = docs.sparkSession
    likely = found.join(F.broadcast(template_words(spark)), "template")
    keys = sent_if_small(likely.select("k1", "k2").distinct())
    k1, k2 = text_key(F.col(text))
    texts = (
        docs.select(k1.alias("k1"), k2.alias("k2"), F.col(text).alias("text")).join(keys, ["k1", "k2"])
        .dropDuplicates(["k1", "k2"])
        .select("k1", "k2", F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)).alias("words"))
    )

    def standing(shift: Column) -> Column:
        return F.filter(
            F.sequence(F.lit(0), F.size("tokens") - 1),
            lambda j: F.coalesce(F.when(j + shift >= 0, F.get(F.col("words"), (j + shift).cast("int"))) == F.get(F.col("tokens"), j), F.lit(False)),
        )

    share = F.size(F.array_distinct(F.flatten(F.transform("shifts", standing)))) / F.size("tokens")
    first = F.greatest(F.array_min("shifts"), F.lit(0))
    inside = F.slice("words", (first + 1).cast("int"), (F.array_max("shifts") + F.size("tokens") - first).cast("int"))
    telling = F.array(*(F.lit(w) for w in TELLING))
    told = F.size(F.array_except(F.array_intersect(inside, telling), "tokens")) == 0
    own = F.size(F.array_except(F.array_intersect("tokens", telling), inside)) == 0
    return (
        likely.join(texts, ["k1", "k2"]).withColumn("share", share).where((F.col("share") >= VERIFIED) & told & own)
        .groupBy("k1", "k2").agg(F.max("share").alias("score"), F.collect_set("label").alias("labels"))
    )


def phrases(docs: DataFrame, *, text: str = "text", into: str = "phrases") -> DataFrame:
    """`docs` with a struct (n_words, n_base, first_word, last_word, base_labels) of the PHRASES."""
    looked_for = [(_word_hash(words_of(phrase)), label) for phrase, label in PHRASES]

    @F.arrow_udf("struct<n_words: bigint, n_base: bigint, first_word: bigint, last_word: bigint, base_labels: array<string>>")
    def places(texts: pa.Array) -> pa.Array:
        parts, numbers = _tables()
        n_words, n_base = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        low, high = np.full(len(texts), -1, np.int64), np.full(len(texts), -1, np.int64)
        labels = [[] for _ in range(len(texts))]
        for first, last, data, offsets in chunks(texts):
            hashes, of, _, _ = word_hashes(data, offsets, parts, numbers)
            n_words[first:last] = np.bincount(of, minlength=last - first)
            for phrase, label in looked_for:
                size = len(phrase)
                if len(hashes) < size:
                    continue
                here = of[size - 1 :] == of[: len(of) - size + 1]
                for j, h in enumerate(phrase):
                    here &= hashes[j : len(hashes) - size + 1 + j] == h
                at = np.flatnonzero(here)
                for row, place in zip((first + of[at]).tolist(), (at - np.searchsorted(of, of[at])).tolist()):
                    n_base[row] += 1
                    low[row] = place if low[row] < 0 else min(low[row], place)
                    high[row] = max(high[row], place)
                    if label not in labels[row]:
                        labels[row].append(label)
        none = n_base == 0
        release()
        return pa.StructArray.from_arrays([
            pa.array(n_words), pa.array(n_base), pa.array(low, mask=none), pa.array(high, mask=none),
            pa.array([sorted(x) for x in labels], pa.list_(pa.string())),
        ], names=["n_words", "n_base", "first_word", "last_word", "base_labels"])

    return docs.withColumn(into, places(F.col(text)))


def scan(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for each row."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id), F.coalesce(F.col(text), F.lit("")).alias("text"))
    found = stored(spans(rows), "spans")
    results = stored(verified(rows, found), "licenses")
    k1, k2 = text_key(F.col("text"))
    base = phrases(rows.withColumns({"k1": k1, "k2": k2})).select(doc_id, "k1", "k2", "phrases.*")
    none = F.array().cast("array<string>")
    every = F.array_sort(F.array_union("base_labels", F.coalesce("labels", none)))
    licensed = F.when(F.size(every) > 1, F.array_remove(every, RESERVED)).otherwise(every)
    return base.join(results, ["k1", "k2"], "left").select(
        doc_id, "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(licensed, ",").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


cloudpickle.register_pickle_by_value(sys.modules[__name__])
