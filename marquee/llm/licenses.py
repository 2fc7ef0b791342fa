"""License scans by diagonal voting.

Rolling two-word hashes of every document are joined to the places of the same pairs in license templates, and the
words behind a hash are compared. A match votes for its diagonal (place in the document minus place in the template);
a verbatim quote puts all its votes on one diagonal, an edited one on neighbouring diagonals. Diagonals that lie
close together, as far apart as the words a quote may gain or lose, are merged, and the merged matches are verified:
only matches that go forward in the document and in the template together count, and the template words under
them must reach the share asked for. Base phrases are templates of which every word must stand on one diagonal.
A text is read and cut into words once; what goes on is its word count and its few matches.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import alnum_words, let, materialise, same_row, text_key

GRAM = 2
COVER = 0.8        # share of a template's words that a span must cover

# Base phrases (label, words).
BASE = [
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
]
# Wording of public licenses (label, text).
TEXTS = [
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS
IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT,
STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF
ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED
"AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE
OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any
purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is
not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the
original software. 3. This notice may not be removed or altered from any source distribution."""),
    ("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License."""),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You
should have received a copy of the GNU General Public License along with this program."""),
]
# Sentences and notices by which the same licenses are named or begun (label, words).
NOTICES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to "
            "this work"),
]
TEMPLATES = NOTICES + TEXTS


def template_words(text: str) -> list[str]:
    return [w for w in re.split(r"[^0-9a-z\x80-\U0010ffff]+", text.lower()) if w]


def shift_allowed(n: int) -> int:
    """How far apart the diagonals of one quote of an ``n``-word template may lie: the words COVER leaves to lose."""
    return max(1, round(n / COVER) - n)


def template_grams(spark: SparkSession, templates: list[tuple[str, str]], base: list[tuple[str, str]]) -> DataFrame:
    """(h, first, second, template, label, is_base, n, offset): every word pair of every template, a fixed table."""
    rows = []
    for number, (label, text, is_base) in enumerate([(*b, True) for b in base] + [(*t, False) for t in templates]):
        words = template_words(text)
        rows += [(number, label, is_base, len(words), i, words[i], words[i + 1]) for i in range(len(words) - 1)]
    table = spark.createDataFrame(rows, "template int, label string, is_base boolean, n int, offset int, first string, second string")
    return table.withColumn("h", pair_hash(F.xxhash64("first"), F.xxhash64("second")))


def pair_hash(first: Column, second: Column) -> Column:
    return F.xxhash64(first, second)


def word_pairs(docs: DataFrame, wanted: list[int]) -> DataFrame:
    """(doc_id, text_key, n_words, pairs): the places (at, h, first, second) of the pairs whose hash is wanted."""
    def of(words: Column) -> Column:
        def pairs(hashes: Column) -> Column:
            at = F.filter(F.sequence(F.lit(0), F.size(hashes) - GRAM),
                          lambda i: pair_hash(F.get(hashes, i), F.get(hashes, i + 1)).isin(wanted))
            found = F.transform(at, lambda i: F.struct(
                i.alias("at"), pair_hash(F.get(hashes, i), F.get(hashes, i + 1)).alias("h"), F.get(words, i).alias("first"),
                F.get(words, i + 1).alias("second")))
            return F.when(F.size(hashes) >= GRAM, found)

        return F.struct(F.size(words).cast("long").alias("n_words"), let(F.transform(words, lambda w: F.xxhash64(w)), pairs).alias("pairs"))

    cut = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), let(alnum_words(F.col("text")), of).alias("w"))
    return cut.select("doc_id", "text_key", "w.n_words", "w.pairs")


def license_votes(pairs: DataFrame, templates: DataFrame) -> DataFrame:
    """(doc_id, text_key, template, label, is_base, n, diagonal, offsets): the template places confirmed on each diagonal."""
    spread = pairs.select("doc_id", "text_key", F.explode("pairs").alias("p")).select("doc_id", "text_key", "p.*")
    hits = spread.join(F.broadcast(templates), ["h", "first", "second"])  # a fixed table of some hundred rows
    return (hits.select("doc_id", "text_key", "template", "label", "is_base", "n", (F.col("at") - F.col("offset")).alias("diagonal"), "offset")
            .groupBy("doc_id", "text_key", "template", "label", "is_base", "n", "diagonal")
            .agg(F.collect_set("offset").alias("offsets")))


def longest_chain(matches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest choice of matches (at, offset) in which both numbers rise."""
    tails: list[int] = []
    last: list[int] = []
    before = [-1] * len(matches)
    matches = sorted(matches, key=lambda m: (m[0], -m[1]))
    for i, (_, offset) in enumerate(matches):
        k = bisect.bisect_left(tails, offset)
        before[i] = last[k - 1] if k else -1
        tails[k:k + 1] = [offset]
        last[k:k + 1] = [i]
    chain, i = [], last[-1] if last else -1
    while i >= 0:
        chain.append(matches[i])
        i = before[i]
    return chain[::-1]


def verified_spans(votes: list[tuple[int, list[int]]], n: int) -> list[tuple[int, int, int]]:
    """(start, end, covered words) of the quotes of an ``n``-word template among the votes (diagonal, offsets).

    From each diagonal on, those within ``shift_allowed`` are merged; what a span has used is not used again.
    """
    votes = sorted((d, sorted(set(o))) for d, o in votes)
    need, shift = -(-n * int(COVER * 100) // 100), shift_allowed(n)
    spans, at, upto = [], 0, -1
    for at in range(len(votes)):
        merged = [(d + o, o) for d, offsets in votes[at:bisect.bisect_right(votes, (votes[at][0] + shift, [n]))] for o in offsets
                  if d + o > upto]
        offsets = {o for _, o in merged}
        if len(offsets | {o + 1 for o in offsets}) < need:
            continue
        chain = longest_chain(merged)
        covered = {o for _, o in chain} | {o + 1 for _, o in chain}
        if len(covered) >= need:
            upto = chain[-1][0] + 1
            spans.append((chain[0][0], upto, len(covered)))
    return spans


SPAN = "doc_id {id}, text_key long, label string, start long, end long, cover double"


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, label, start, end, cover = [], [], [], [], []
        for i, (name, n, votes) in enumerate(zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)))):
            for a, b, covered in verified_spans([(v["diagonal"], v["offsets"]) for v in votes], n):
                at.append(i)
                label.append(name)
                start.append(a)
                end.append(b)
                cover.append(covered / n)
        rows = pa.array(at, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(label, pa.string()), pa.array(start, pa.int64()),
             pa.array(end, pa.int64()), pa.array(cover, pa.float64())],
            names=["doc_id", "text_key", "label", "start", "end", "cover"])


def license_spans(votes: DataFrame) -> DataFrame:
    """(doc_id, text_key, label, start, end, cover, is_base): base phrases on their place, and verified quotes."""
    kind = votes.schema["doc_id"].dataType.simpleString()
    base = votes.where("is_base").where(F.size("offsets") == F.col("n") - 1).select(
        "doc_id", "text_key", "label", F.col("diagonal").cast("long").alias("start"),
        (F.col("diagonal") + F.col("n") - 1).cast("long").alias("end"), F.lit(1.0).alias("cover"), F.lit(True).alias("is_base"))
    grouped = (votes.where("not is_base").groupBy("doc_id", "text_key", "template", "label", "n")
               .agg(F.collect_list(F.struct("diagonal", "offsets")).alias("votes")))
    # Few documents hold enough of a template's words anywhere; the others need no look at their order.
    offsets = F.array_distinct(F.flatten(F.transform("votes", lambda v: v["offsets"])))
    words = F.size(F.array_union(offsets, F.transform(offsets, lambda o: o + 1)))
    quotes = (grouped.where(words >= F.ceil(F.col("n") * COVER)).select("doc_id", "text_key", "label", "n", "votes")
              .mapInArrow(_verify, SPAN.format(id=kind)).withColumn("is_base", F.lit(False)))
    return base.unionByName(quotes)


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, base: list[tuple[str, str]] = BASE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Reads ``doc_id`` and ``text``; other columns are ignored. A null or empty text has no words, no labels and score
    0. The score is the largest share of a template's words that a verified span covers, base phrases included.
    Rows that repeat an id and a text get the same result each.
    """
    table = template_grams(docs.sparkSession, templates, base)
    wanted = [r["h"] for r in table.select("h").distinct().collect()]  # the fixed table again
    pairs = materialise(word_pairs(docs, wanted))
    # Rows that repeat an id and a text have the same pairs; their votes are sets.
    per_doc = license_spans(license_votes(pairs, table)).groupBy("doc_id", "text_key").agg(
        F.count_if("is_base").alias("n_base"),
        F.min(F.when(F.col("is_base"), F.col("start"))).alias("first_word"),
        F.max(F.when(F.col("is_base"), F.col("start"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("is_base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("cover").alias("score"))
    rows = pairs.select("doc_id", "text_key", "n_words")
    return rows.join(per_doc, same_row(rows, per_doc), "left").select(
        rows["doc_id"], "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
