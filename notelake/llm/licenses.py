"""Licence scans with a positional rare-token index. DataFrame functions only."""

from __future__ import annotations

import json
import math
import re
from collections import Counter, defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_GAP, ascii_lower, free, let, words

#: Phrases that decide by themselves, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
OTHER DEALINGS IN THE SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO,
THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE
LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_GNU = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} as published by the Free Software Foundation,
{1}. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or
FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} for more details. You should have received a copy of the GNU {0} along with this program. If not, see
<https://www.gnu.org/licenses/>."""

#: Licence notices as published, each with its label and the key phrases that must all stand in a match word for word.
NOTICES = [
    ("mit", f"""Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the
"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute,
sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. {_WARRANTY}""",
     ["hereby granted free of charge", "substantial portions of the software"]),
    ("mit", "Released under the MIT License", ["mit license"]),
    ("bsd", f"{_BSD} {_BSD_END}", ["source and binary forms", "list of conditions"]),
    ("bsd", f"""{_BSD} 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from
this software without specific prior written permission. {_BSD_END}""", ["source and binary forms", "endorse or promote"]),
    ("bsd", "Licensed under the BSD 3-Clause License", ["bsd 3 clause"]),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO
THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS
ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""", ["with or without fee"]),
    ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising
from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote
the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2.
Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or
altered from any source distribution.""", ["must not be misrepresented"]),
    ("bsl-1.0", f"""Boost Software License - Version 1.0 - August 17th, 2003. Permission is hereby granted, free of charge, to any person or organization obtaining
a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit
the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the
following: {_WARRANTY}""", ["prepare derivative works of the software"]),
    ("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may
obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed
under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License.""", ["apache license", "compliance with the license"]),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", ["apache license"]),
    ("mpl-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You
can obtain one at https://mozilla.org/MPL/2.0/.""", ["mozilla public license"]),
    ("gpl-2.0", _GNU.format("General Public License", "either version 2 of the License, or (at your option) any later version"), ["version 2 of the license", "gnu general public license"]),
    ("gpl-3.0", _GNU.format("General Public License", "either version 3 of the License, or (at your option) any later version"), ["version 3 of the license", "gnu general public license"]),
    ("lgpl", _GNU.format("Lesser General Public License", "either version 2.1 of the License, or (at your option) any later version"), ["gnu lesser general public license"]),
    ("agpl", _GNU.format("Affero General Public License", "either version 3 of the License, or (at your option) any later version"), ["gnu affero general public license"]),
    ("gpl-2.0", "This work is licensed under the GNU General Public License version 2", ["general public license version 2"]),
    ("gpl-3.0", "This work is licensed under the GNU General Public License version 3", ["general public license version 3"]),
    ("lgpl", "This library is licensed under the GNU Lesser General Public License", ["lesser general public license"]),
    ("agpl", "Licensed under the GNU Affero General Public License", ["affero general public license"]),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions
that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this
dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of
relinquishment in perpetuity of all present and future rights to this software under copyright law.""", ["free and unencumbered software"]),
    ("cc0", """The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide
under copyright law, including all related and neighboring rights, to the extent allowed by law. You can copy, modify, distribute and perform the work, even for
commercial purposes, all without asking permission.""", ["to the public domain by waiving"]),
    ("cc0", "Dedicated to the public domain under the CC0 1.0 Universal waiver", ["cc0 1 0"]),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License", ["creative commons attribution 4 0"]),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", ["cc by nc"]),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", ["cc by sa"]),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0", ["cc by nd"]),
]

#: Words in more than this share of the notices are no index terms.
COMMON = 0.25
#: Least share, by IDF, of a notice's index terms that must stand at their relative positions.
LEAST = 0.5
#: Words put in or left out ahead of a word, by which its relative position may be off: half a bucket of offsets.
SLACK = 16

HITS = "array<struct<label:string,start:bigint,phrase:string,base:boolean,coverage:double>>"


def _index() -> tuple[dict[str, list[dict]], list[dict], dict[str, float]]:
    """Postings of the notices' rare words (notice, position, IDF), the notices' key phrases and weights, and the IDF of all their words.

    IDF is over the notices: a word of few of them tells them apart best.
    """
    split = [re.findall(r"[0-9a-z]+", text.lower()) for _, text, _ in NOTICES]
    df = Counter(w for ws in split for w in set(ws))
    idf = {w: math.log(1 + len(split) / n) for w, n in df.items()}
    postings, notices = defaultdict(list), []
    for t, ((label, _, keys), ws) in enumerate(zip(NOTICES, split, strict=True)):
        rare = [(p, w) for p, w in enumerate(ws) if df[w] <= COMMON * len(split)]
        for p, w in rare:
            postings[w].append({"t": t, "p": p, "w": idf[w]})
        notices.append({"label": label, "size": len(ws), "weight": sum(idf[w] for _, w in rare), "keys": [k.split() for k in keys]})
    return dict(postings), notices, idf


def scan(docs: DataFrame, text: str = "text", least: float = LEAST) -> DataFrame:
    """The documents with n_words and `hits`: every place of a phrase of BASE, and every notice found.

    A hit has label, start (word, from 0; of a notice the place of its first word by its first rare word), phrase, base (is
    it one of BASE) and coverage. Words are runs of digits, a-z and characters beyond ASCII, after lower-casing A-Z.
    Index terms are the words of few notices, of highest IDF: those of a text are looked up, and what their postings and
    places agree on (notice and relative position, within a bucket) is intersected; coverage is the share by IDF of
    the notice's terms that agree. From `least` on, the notice's key phrases are verified word for word. Texts without a
    rarest word of any key phrase can hold none and aren't looked into. Null or empty texts have no words and no
    hits; all places count, ties and repeated rows included; other columns stay as they are, but those named n_words or hits.
    """
    postings, notices, idf = _index()
    (own,) = free(docs.columns, "words")
    rarest = lambda ws: max(ws, key=lambda w: (idf.get(w, math.inf), len(w), w))
    anchors = sorted({rarest(k) for n in notices for k in n["keys"]} | {rarest(p.split()) for p in BASE})
    index = F.from_json(F.lit(json.dumps(postings)), "map<string,array<struct<t:int,p:int,w:double>>>")  # folded to literals
    told = F.from_json(F.lit(json.dumps(notices)), "array<struct<label:string,size:int,weight:double,keys:array<array<string>>>>")

    def base(ws: Column, at: Column) -> list[Column]:
        return [_phrase_hits(ws, at, phrase, label, rarest(phrase.split())) for phrase, label in BASE.items()]

    def clustered(ws: Column, s: Column) -> Column:
        """Of agreeing postings in order, the runs of one notice and bucket that are verified."""
        same = lambda i: (F.get(s, i)["t"] == F.get(s, i - 1)["t"]) & (F.get(s, i)["bucket"] == F.get(s, i - 1)["bucket"])
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | ~same(i))
        run = lambda at: lambda a, j: F.slice(s, a + 1, F.coalesce(F.get(at, j + 1), F.size(s)) - a)
        runs = let(starts, lambda at: F.transform(at, run(at)))
        weight = lambda r: F.aggregate(F.array_distinct(F.transform(r, lambda x: F.struct(x.p.alias("p"), x.w.alias("w")))), F.lit(0.0), lambda a, x: a + x.w)
        shaped = F.transform(runs, lambda r: F.struct(F.get(told, F.get(r, 0)["t"]).alias("n"), F.array_min(F.transform(r, lambda x: x.off)).alias("off"), weight(r).alias("weight")))
        strong = F.filter(shaped, lambda c: c.weight >= c.n.weight * least)

        def there(c: Column) -> Column:
            first, last = F.greatest(c.off - SLACK, F.lit(0)), F.least(c.off + c.n.size + 2 * SLACK, F.size(ws)) - 1
            return F.forall(c.n["keys"], lambda k: F.exists(F.sequence(first, F.greatest(last, first)), lambda i: F.slice(ws, i + 1, F.size(k)) == k))

        hit = lambda c: F.struct(c.n.label.alias("label"), F.greatest(c.off, F.lit(0)).cast("bigint").alias("start"), F.array_join(F.get(c.n["keys"], 0), " ").alias("phrase"), F.lit(False).alias("base"), F.least(c.weight / c.n.weight, F.lit(1.0)).alias("coverage"))
        return F.array_distinct(F.transform(F.filter(strong, there), hit)).cast(HITS)

    def agreeing(ws: Column, at: Column) -> Column:
        """(notice, bucket of the offset, position, weight, offset), in order; buckets overlap by half."""
        pair = lambda i, shift: lambda x: F.struct(x.t.alias("t"), (2 * F.floor((i - x.p + shift) / (2 * SLACK)) + (1 if shift else 0)).alias("bucket"), x.p.alias("p"), x.w.alias("w"), (i - x.p).alias("off"))
        both = lambda i: let(F.element_at(index, F.get(ws, i)), lambda found: F.concat(F.transform(found, pair(i, 0)), F.transform(found, pair(i, SLACK))))
        return F.array_sort(F.flatten(F.transform(F.filter(at, lambda i: F.get(ws, i).isin(list(postings))), both)))

    def found(ws: Column) -> Column:
        every = sorted({*postings, *anchors})
        at = F.filter(F.sequence(F.lit(0), F.size(ws) - 1), lambda i: F.get(ws, i).isin(every))
        notice = lambda places: F.coalesce(let(agreeing(ws, places), lambda s: F.when(F.size(s) > 0, clustered(ws, s))), none)
        return F.when(F.arrays_overlap(ws, F.array(*map(F.lit, anchors))), let(at, lambda places: F.concat(*base(ws, places), notice(places))))

    none = F.from_json(F.lit("[]"), HITS)
    df = docs.withColumn(own, words(ascii_lower(F.col(text)), WORD_GAP))
    return df.withColumn("n_words", F.size(own).cast("long")).withColumn("hits", F.coalesce(let(F.col(own), found), none)).drop(own)


def _phrase_hits(ws: Column, at: Column, phrase: str, label: str, anchor: str) -> Column:
    """Hits of a phrase of BASE, of whose rarest word `at` has all places."""
    one = phrase.split()
    shift = one.index(anchor)
    places = F.filter(at, lambda i: (i >= shift) & (F.slice(ws, F.greatest(i - shift, F.lit(0)) + 1, F.lit(len(one))) == F.array(*map(F.lit, one))))
    hit = lambda i: F.struct(F.lit(label).alias("label"), (i - shift).cast("bigint").alias("start"), F.lit(phrase).alias("phrase"), F.lit(True).alias("base"), F.lit(1.0).alias("coverage"))
    return F.transform(places, hit).cast(HITS)


def digest(docs: DataFrame) -> DataFrame:
    """One row per document of scan(): the counts, places and labels. A document without hits scores 0."""
    base = F.filter("hits", lambda h: h.base)
    named = lambda hits: F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda h: h.label))), ",")
    return scan(docs.select("doc_id", "text")).select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda h: h.start)).alias("first_word"),
        F.array_max(F.transform(base, lambda h: h.start)).alias("last_word"),
        named(base).alias("base_labels"),
        named(F.col("hits")).alias("labels"),
        F.coalesce(F.array_max(F.transform("hits", lambda h: h.coverage)), F.lit(0.0)).alias("score"),
    )
