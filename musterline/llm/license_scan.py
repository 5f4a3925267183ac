"""License phrases and texts in documents, by diagonal voting.

Templates are word sequences. Every rolling word k-gram of every document is joined, by hash, to the
places it has in the templates; a hit votes for the diagonal (place in the document minus place in the
template). Votes are summed per document, template and diagonal, neighbouring diagonals are merged
(words inserted or left out move a passage to a diagonal nearby), and the spans that result are verified
against the words of the text.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from musterline.llm.text_hashing import ALNUM, list_array, rolling, slices, text_bytes, with_fields
from musterline.operators.small_side import join_statistics, rows_with_keys
from musterline.session import written

K = 3
#: Diagonals of one template at most half of this apart make one span, and so do hits at most WORD_GAP words apart.
BAND = 32
WORD_GAP = 12
#: Share of a template's words that a span must hold in order, unless the template is exact.
COVERED = 0.9
_WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
_LOWER = {i: i + 32 for i in range(65, 91)}

# The phrases that must match as they stand, and their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
# Further templates of the method, as commonly worded, and their labels.
TEMPLATES = (
    ("licensed under the gnu general public license version 3", "gpl-3"),
    ("licensed under the gnu general public license version 2", "gpl-2"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("mozilla public license version 2", "mpl-2"),
    ("released under the mit license", "mit"),
    ("licensed under the apache license version 2", "apache-2"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("creative commons attribution noncommercial", "cc-by-nc"),
    ("creative commons attribution sharealike", "cc-by-sa"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee", "isc"),
    ("unless required by applicable law or agreed to in writing software distributed under the license", "apache-2"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
)

# Whole license bodies, as published, and their labels.
BODIES = (
    (
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software.
        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
        WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
        COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
        OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.
        THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
        IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
        INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
        ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
        THIS SOFTWARE.""",
    ),
    (
        "bsd",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met:
        1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
        disclaimer.
        2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
        disclaimer in the documentation and/or other materials provided with the distribution.
        THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
        INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
        DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
        SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
        SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
        WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
        THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    ),
    (
        "zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
        liable for any damages arising from the use of this software.
        Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
        and redistribute it freely, subject to the following restrictions:
        1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
        you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
        required.
        2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
        3. This notice may not be removed or altered from any source distribution.""",
    ),
    (
        "apache-2",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
        the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
        "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
        language governing permissions and limitations under the License.""",
    ),
    (
        "gpl-3",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version.
        This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
        warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.
        You should have received a copy of the GNU General Public License along with this program. If not, see
        <https://www.gnu.org/licenses/>.""",
    ),
    (
        "unlicense",
        """This is free and unencumbered software released into the public domain.
        Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or
        as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
        In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
        interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
        detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of
        all present and future rights to this software under copyright law.
        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
        WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
        LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
        OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
)


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.translate(_LOWER)) if text else []


def templates() -> list[tuple[str, str, bool]]:
    return [(t, label, True) for t, label in PHRASES] + [(t, label, False) for t, label in TEMPLATES] + [(t, label, False) for label, t in BODIES]


def template_places(spark, k: int = K) -> DataFrame:
    """(gram, template, place): a fixed, small table. Templates shorter than ``k`` words are padded out by none."""
    rows = []
    for number, (text, _, _) in enumerate(templates()):
        words, _ = ALNUM.hashes(*text_bytes(pa.array([text])))
        rows += [(int(g), number, i) for i, g in enumerate(rolling(words, k).view(np.int64).tolist())]
    return spark.createDataFrame(rows, "gram long, template int, place int")


def document_grams(docs: DataFrame, k: int = K) -> DataFrame:
    """``docs`` (text and others) as n_words and the hashes of all rolling k-grams, in order, beside the others."""
    kept = docs.drop("text")
    names = kept.columns

    def grams(batches):
        for part in slices(batches):
            words, bounds = ALNUM.hashes(*text_bytes(part.column("text")))
            found = rolling(words, k)
            lists = [found[a : max(a, b - k + 1)] for a, b in zip(bounds[:-1], bounds[1:])]
            columns = [*(part.column(c) for c in names), pa.array(np.diff(bounds)), list_array(lists)]
            yield pa.record_batch(columns, names=[*names, "n_words", "grams"])

    return docs.mapInArrow(grams, with_fields(kept.schema, "n_words long, grams array<long>"))


def voted_spans(grams: DataFrame, places: DataFrame, k: int = K) -> DataFrame:
    """(key, template, start, end): spans of document words that gathered votes, ends exclusive."""
    hits = grams.select("key", F.posexplode("grams").alias("at", "gram")).join(F.broadcast(places), "gram")
    diagonals = hits.groupBy("key", "template", (F.col("at") - F.col("place")).alias("diagonal"), F.floor(F.col("at") / 4096).alias("part")).agg(
        F.sort_array(F.collect_set("at")).alias("ats")  # copies of a text vote once
    )
    # Neighbouring diagonals form bands; each diagonal is in two of them, so any two at most BAND / 2 apart share one,
    # and votes of far diagonals (phrases that a template repeats) don't cut a span. A part holds at most 4096 votes.
    bands = F.array(*[F.struct(F.lit(i).alias("set"), F.floor((F.col("diagonal") + i * BAND // 2) / BAND).alias("number")) for i in (0, 1)])
    single = diagonals.select("key", "template", "ats", F.explode(bands).alias("band")).select("key", "template", "band", F.explode("ats").alias("at"))
    order = Window.partitionBy("key", "template", "band").orderBy("at")
    far = F.col("at") - F.lag("at").over(order) > WORD_GAP
    numbered = single.withColumn("new", F.coalesce(far, F.lit(True)).cast("int"))
    numbered = numbered.withColumn("span", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = numbered.groupBy("key", "template", "band", "span").agg(F.min("at").alias("start"), (F.max("at") + k).alias("end"))
    return spans.select("key", "template", "start", "end")


def _covered(words: list[str], template: list[str]) -> float:
    """Share of the template's words that ``words`` hold in order."""
    row = [0] * (len(template) + 1)
    for word in words:
        before = 0
        for j, t in enumerate(template):
            row[j + 1], before = (before + 1 if word == t else max(row[j + 1], row[j])), row[j + 1]
    return row[-1] / len(template)


def scan_licenses(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: key, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    ``spans`` lists every verified (label, start, end, exact, covered); score is the largest covered share,
    0 without a span. A null or empty text has no words. What is found depends on a row's text alone: votes
    travel by 128 bits of the text's hash, so rows without a key, or with a key that others have too, find what
    is theirs, and copies of a text are scanned once after the vote.
    """
    spark = docs.sparkSession
    whole = F.col(text).cast("string")
    identity = F.struct(F.xxhash64(F.lit(1), whole).alias("a"), F.xxhash64(F.lit(2), whole).alias("b"))
    plain = docs.select(F.col(key).alias("__doc"), identity.alias("key"), whole.alias("text"))
    grams = document_grams(plain)
    spans = voted_spans(document_grams(plain.select("key", "text")), template_places(spark))
    per_key = spans.groupBy("key").agg(F.collect_set(F.struct("template", "start", "end")).alias("found"))
    texts = rows_with_keys(plain.select("key", "text"), per_key, "key").dropDuplicates(["key"]).join(per_key, "key")
    known = [(words_of(t), label, exact) for t, label, exact in templates()]

    def verify(batches):
        for part in slices(batches):
            out = []
            for t, found in zip(part.column("text").to_pylist(), part.column("found").to_pylist()):
                words, good = words_of(t), []
                for span in sorted(found, key=lambda s: (s["template"], s["start"])):
                    template, label, exact = known[span["template"]]
                    n = len(template)
                    if exact:
                        inside = range(max(0, span["start"]), min(span["end"], len(words)) - n + 1)
                        good += [(label, i, i + n, True, 1.0) for i in inside if words[i : i + n] == template]
                    else:
                        share = _covered(words[max(0, span["start"] - 4) : span["end"] + 4], template)
                        if share >= COVERED:
                            good.append((label, span["start"], min(span["end"], len(words)), False, share))
                out.append([dict(zip(("label", "start", "end", "exact", "covered"), g)) for g in good])
            kind = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("exact", pa.bool_()), ("covered", pa.float64())]))
            yield pa.record_batch([part.column("key"), pa.array(out, kind)], names=["key", "spans"])

    span_type = "spans array<struct<label:string,start:bigint,end:bigint,exact:boolean,covered:double>>"
    verified = texts.mapInArrow(verify, with_fields(plain.select("key").schema, span_type))
    verified = verified.groupBy("key").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    # Few texts have spans; beyond a checked size, copies of one meet its spans where adaptive execution splits them.
    all_rows = join_statistics(grams.select("__doc", "key", "n_words"), written(verified), "key")
    spans = F.coalesce("spans", F.array().cast(span_type.split(" ", 1)[1]))
    all_rows = all_rows.withColumn("spans", F.array_distinct(spans))
    base = F.filter("spans", lambda s: s["exact"])

    def labels(of):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda s: s["label"]))), ",")

    starts = F.transform(base, lambda s: s["start"])
    return all_rows.select(
        F.col("__doc").alias(key),
        "n_words",
        F.size(F.array_distinct(F.transform(base, lambda s: F.struct(s["label"], s["start"])))).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["covered"])), F.lit(0.0)).alias("score"),
        "spans",
    )


def op5_license_scan(spark, sf_dir: str) -> DataFrame:
    """Words, base places and labels of every document; odd rows as in :func:`scan_licenses`."""
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("spans")
