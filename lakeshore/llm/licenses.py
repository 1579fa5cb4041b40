"""License scans by diagonal voting (operator 7).

Every document position's rolling word 2-gram and 5-gram hashes are joined by Spark
to the positions of the license templates (a fixed table, broadcast): 2-grams to
the base phrases and to one-sentence statements, 5-grams to whole license texts. A
match votes for the diagonal document position - template position; votes are added
per document, template and diagonal, neighbouring diagonals are merged (a word put
in or left out moves the rest by one, a holder's name in a whole text by several),
and a merged span is verified: enough of the template's grams, enough of its length,
and a span not much longer than it. A short template may miss the grams that put-in
words break before its license's name. One sentence of a license gives the
statement's label, its whole text also the label that ends in ``-text``.

A *base phrase* counts wherever its words stand consecutively (a full, unmerged
diagonal); labels hold those and the labels of verified templates.

A null or empty text has no words, no labels and score 0; every row is reported
by itself, repeated or null doc_ids included; an empty table gives an empty
table. Extra columns are never read.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lakeshore.llm import textkit as tk

#: Fixed values of the contract: phrases and labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Public license statements, as lower-case words; the method's own labels.
TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "cc-by-4.0": "licensed under cc by 4 0",
    "cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "cc-by-sa-4.0": "licensed under cc by sa 4 0",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "gpl-header": "you can redistribute it and or modify it under the terms of the gnu general "
                  "public license as published by the free software foundation",
    "lgpl": "under the terms of the gnu lesser general public license as published by the free "
            "software foundation",
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this "
           "software and associated documentation files",
    "bsd": "redistribution and use in source and binary forms with or without modification are "
           "permitted provided that the following conditions are met",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or "
           "without fee is hereby granted",
    "unlicense": "this is free and unencumbered software released into the public domain",
}

#: Licenses' names in short templates. A word put in before the name breaks a gram more
#: than VOTES lets these templates miss; one put into it ("nc", "nd") names another license.
NAMES = {"cc-by-4.0": "cc by 4 0", "cc-by-nc-4.0": "cc by nc 4 0", "cc-by-sa-4.0": "cc by sa 4 0"}

#: Public license texts in full (without title and copyright line); labels of whole texts.
TEXTS = {
    "apache-2.0-text":
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License.",
    "bsd-3-clause-text":
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: 1. Redistributions of source code must retain "
        "the above copyright notice, this list of conditions and the following disclaimer. 2. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. 3. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without "
        "specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND "
        "CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE "
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO "
        "EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
        "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
        "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
        "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
        "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF "
        "THE POSSIBILITY OF SUCH DAMAGE.",
    "isc-text":
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
        "in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH "
        "REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO "
        "EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR "
        "ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
        "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE.",
    "mit-text":
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions: The above copyright notice and this "
        "permission notice shall be included in all copies or substantial portions of the Software. THE "
        "SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT "
        "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
}

GRAM, TEXT_GRAM = 2, 5
#: Diagonals this far apart belong to one span; shares of grams and of length that verify it.
SHIFT, VOTES, LENGTH, STRETCH = 2, 0.85, 0.8, 1.5
#: The same for whole texts: a changed word breaks five grams, a holder's name may have some words.
TEXT_SHIFT, TEXT_VOTES = 8, 0.6
#: Hash of the row that each document sends besides its grams.
_DOCUMENT = -1


def _grams(buf, offsets, sizes: tuple[int, ...]):
    """The number of words per document, and for each size (document, position, gram
    hash, second hash) of all grams."""
    w = tk.Words(tk.LOWER[buf], offsets, tk.ALNUM)
    doc, left, first, second = w.doc(), w.left(), w.hashes(0), w.hashes(1)
    pos = np.arange(len(w)) - w.first[:-1][doc] if len(w) else doc

    def of(k: int) -> tuple[np.ndarray, ...]:
        ok = np.flatnonzero(left[:max(0, len(w) - k + 1)] >= k)
        gram, check = tk.rolling(first, k, 0), tk.rolling(second, k, 1)
        return doc[ok], pos[ok], gram[ok].view(np.int64), check[ok].view(np.int64)

    return np.diff(w.first), (of(k) for k in sizes)


def grams(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, pos, gram, check) of every word 2-gram and 5-gram; one more row
    with pos -1 per document carries its number of words in ``check``."""
    def run(batch: pa.RecordBatch):
        rid, ids = batch.column(0).to_numpy(), batch.column(1)
        buf, offsets = tk.texts_of(batch.column(2))
        for i, j, b, o in tk.passes(buf, offsets):
            n, found = _grams(b, o, (GRAM, TEXT_GRAM))
            every = np.arange(j - i)
            itself = (every, np.full(j - i, -1), np.full(j - i, _DOCUMENT), n)
            for doc, pos, gram, check in itertools.chain([itself], found):
                yield pa.RecordBatch.from_arrays([
                    pa.array(rid[doc + i]), ids.take(pa.array(doc + i)), pa.array(pos.astype(np.int32)),
                    pa.array(gram.astype(np.int64)), pa.array(check.astype(np.int64))],
                    ["rid", "doc_id", "pos", "gram", "check"])

    return tk.map_batches(docs, run, "rid long, doc_id long, pos int, gram long, check long")


def template_positions(spark, base: dict[str, str], templates: dict[str, str],
                       names_in: dict[str, str], texts: dict[str, str]) -> DataFrame:
    """One row per gram of each template: fixed, under a thousand rows; ``named`` are
    the grams of its name, ``n_named`` their number."""
    rows = [(_DOCUMENT, 0, "", "", 0, 0, False, 0)]
    for kind, k, names in (("base", GRAM, {v: k for k, v in base.items()}), ("own", GRAM, templates),
                           ("text", TEXT_GRAM, texts)):
        for label, text in names.items():
            raw = np.frombuffer(text.encode(), dtype=np.uint8)
            n, found = _grams(raw, np.array([0, len(raw)]), (k,))
            _, pos, gram, check = next(found)
            name = names_in.get(label, "").split() if kind == "own" else []
            words = text.split()
            at = next((i for i in range(len(words)) if name and words[i:i + len(name)] == name), 0)
            n_named = max(0, len(name) - GRAM + 1)
            rows += [(int(g), int(c), kind, label, int(p), int(n[0]), bool(at <= p < at + n_named), n_named)
                     for p, g, c in zip(pos, gram, check)]
    return spark.createDataFrame(
        rows, "gram long, t_check long, kind string, label string, t_pos int, t_len int, "
              "named boolean, n_named int")


def license_scan(docs: DataFrame, base: dict[str, str] = BASE,
                 templates: dict[str, str] = TEMPLATES, id_col: str = "doc_id",
                 text_col: str = "text", names: dict[str, str] = NAMES,
                 texts: dict[str, str] = TEXTS) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score (the best share of a template's grams that a
    verified span has; 1 for a base phrase) and spans, an array of (label, start,
    end, votes) in words, end exclusive."""
    spark = docs.sparkSession
    src = docs.select(F.monotonically_increasing_id().alias("rid"),
                      F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                      F.col(f"`{text_col}`").alias("text"))
    places = template_positions(spark, base, templates, names, texts)
    hits = (grams(src).join(F.broadcast(places), "gram")
            .where("kind = '' or check = t_check"))
    # one exchange for all that follows: rows of a document stay together
    hits = hits.repartition("rid").withColumn("diag", F.col("pos") - F.col("t_pos"))
    votes = hits.groupBy("rid", "kind", "label", "diag").agg(
        F.max("doc_id").alias("doc_id"),
        F.max(F.when(F.col("kind") == "", F.col("check"))).alias("n_words"),
        F.count("*").alias("votes"), F.max("t_len").alias("t_len"),
        F.count_if("named").alias("named"), F.max("n_named").alias("n_named"),
        F.min("t_pos").alias("t_min"), F.max("t_pos").alias("t_max"))
    line = Window.partitionBy("rid", "kind", "label").orderBy("diag")
    gap = F.col("diag") - F.lag("diag").over(line)
    # a base phrase stands on one diagonal; own templates may drift
    near = F.when(F.col("kind") == "own", gap <= SHIFT).when(F.col("kind") == "text", gap <= TEXT_SHIFT)
    votes = votes.withColumn("new", F.when(near, 0).otherwise(1))
    size = F.when(F.col("kind") == "text", TEXT_GRAM).otherwise(GRAM)
    votes = votes.withColumn("span", F.sum("new").over(line))
    spans = votes.groupBy("rid", "kind", "label", "span").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
        F.sum("votes").alias("votes"), F.max("t_len").alias("t_len"),
        F.max("named").alias("named"), F.max("n_named").alias("n_named"), F.count("*").alias("diagonals"),
        F.min("t_min").alias("t_min"), F.max("t_max").alias("t_max"),
        F.min(F.col("diag") + F.col("t_min")).alias("start"),
        F.max(F.col("diag") + F.col("t_max") + size).alias("end"))
    grams_of = F.col("t_len") - (size - 1)
    least = F.when(F.col("kind") == "text", TEXT_VOTES).otherwise(VOTES)
    full = (F.col("kind") == "base") & (F.col("votes") == grams_of)
    # each shift to the next diagonal breaks a gram: allowed if the name stands whole on
    # one diagonal and the template is there from its first to its last word
    moved = ((F.col("n_named") > 0) & (F.col("named") == F.col("n_named"))
             & (F.col("votes") >= grams_of - (F.col("diagonals") - 1))
             & (F.col("t_min") == 0) & (F.col("t_max") == F.col("t_len") - GRAM))
    held = (F.col("kind").isin("own", "text") & ((F.col("votes") >= least * grams_of) | moved)
            & (F.col("t_max") - F.col("t_min") + size >= LENGTH * F.col("t_len"))
            & (F.col("end") - F.col("start") <= STRETCH * F.col("t_len")))
    share = F.when(full, 1.0).when(held, F.least(F.lit(1.0), F.col("votes") / grams_of))
    spans = spans.select("*", full.alias("full"), (full | held).alias("good"), share.alias("share"))
    joined = lambda c: F.concat_ws(",", F.array_sort(F.collect_set(c)))
    return spans.groupBy("rid").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
        F.count_if("full").alias("n_base"),
        F.min(F.when(F.col("full"), F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("full"), F.col("start"))).cast("long").alias("last_word"),
        joined(F.when(F.col("full"), F.col("label"))).alias("base_labels"),
        joined(F.when(F.col("good"), F.col("label"))).alias("labels"),
        F.coalesce(F.max("share"), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(F.col("good"), F.struct("label", "start", "end", "votes"))))
        .alias("spans")).drop("rid")


def op7_license_scan(spark, sf_dir: str) -> DataFrame:
    """License phrases and statements of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return license_scan(docs).drop("spans")
