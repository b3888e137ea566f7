"""Licence scan by canonical digests.

A text is brought to a canonical form (case, punctuation, copyright lines and
equivalent spellings) and its digest is joined with the digests of known licences.
Whole texts are looked up, and every line of them, as licence notices are one line.
Only built-in functions are used; the same expressions exist as DuckDB SQL.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spellings that licence guidelines treat as the same, on canonical words.
SPELLINGS = [("licence", "license"), ("sub license", "sublicense"), ("organisation", "organization"),
             ("merchantibility", "merchantability"), ("acknowledgement", "acknowledgment"),
             ("non commercial", "noncommercial"), ("per cent", "percent"), ("authorisation", "authorization"),
             ("authorised", "authorized"), ("judgement", "judgment"), ("fulfilment", "fulfillment"), ("favour", "favor"),
             ("programme", "program"), ("wilful", "willful"), ("whilst", "while"), ("recognised", "recognized"),
             ("copyright owner", "copyright holder"), ("copyright owners", "copyright holders"), ("https", "http")]
#: Lines that say who holds the copyright, and the numbers of list items. A line that only goes on about "copyright
#: notices" is text.
_COPYRIGHT = (r"(^|\n)[ \t*#/;-]*((copyright[ \t:]*(\(c\)|©|[0-9<\[{]|by )|\(c\)|©|all rights reserved)[^\n]*"
              r"|\(?[0-9]{1,2}[.)][ \t])")
#: Rows of a catalogue up to which it is sent to all tasks.
CATALOGUE = 5_000
_PUNCTUATION = r"[^\p{L}\p{N}]+"

_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software."""
_MIT_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""
_FREE_USE = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"

_BSD_GRANT = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_NAMES = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.
"""
_BSD_WARRANTY = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF
USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED
OF THE POSSIBILITY OF SUCH DAMAGE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you
use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
_UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as
a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all
present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE
FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>"""
_BOOST = """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and
transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is
furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and
the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of
the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by
a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT
HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""
_MPL_NOTICE = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
_GNU_NOTICE = """This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {name}
as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.

This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty
of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details.

You should have received a copy of the GNU {name} along with this {what}. If not, see <https://www.gnu.org/licenses/>."""

#: Known licence texts and notices (fixed values, as published).
KNOWN = [
    ("MIT", "MIT License\n\n" + _GRANT + "\n\n" + _MIT_WARRANTY),
    ("MIT", _GRANT + "\n\n" + _MIT_WARRANTY),
    ("ISC", "ISC License\n\n" + _FREE_USE + ", provided that the above copyright notice and this permission notice "
            "appear in all copies.\n\n" + _ISC_WARRANTY),
    ("ISC", _FREE_USE + ", provided that the above copyright notice and this permission notice appear in all copies."
            "\n\n" + _ISC_WARRANTY),
    ("0BSD", _FREE_USE + ".\n\n" + _ISC_WARRANTY),
    ("BSD-2-Clause", _BSD_GRANT + _BSD_WARRANTY),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_GRANT + _BSD_WARRANTY),
    ("BSD-3-Clause", _BSD_GRANT + _BSD_NAMES + _BSD_WARRANTY),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_GRANT + _BSD_NAMES + _BSD_WARRANTY),
    ("Zlib", _ZLIB),
    ("Zlib", "zlib License\n\n" + _ZLIB),
    ("Unlicense", _UNLICENSE),
    ("BSL-1.0", _BOOST),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003\n\n" + _BOOST),
    ("Apache-2.0", _APACHE_NOTICE),
    ("MPL-2.0", _MPL_NOTICE),
    *[(f"{short}-{version}-or-later", _GNU_NOTICE.format(what=what, name=name, version=number))
      for short, name, what in (("GPL", "General Public License", "program"), ("LGPL", "Lesser General Public License", "library"),
                                ("AGPL", "Affero General Public License", "program"))
      for version, number in (("2.0", "2"), ("2.1", "2.1"), ("3.0", "3"))
      if (short, version) in {("GPL", "2.0"), ("GPL", "3.0"), ("LGPL", "2.1"), ("LGPL", "3.0"), ("AGPL", "3.0")}],
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
]


def canonical(text: Column) -> Column:
    """Lower case, without copyright lines; words parted by single blanks, usual spellings."""
    t = F.regexp_replace(F.lower(text), _COPYRIGHT, "\n")
    t = F.concat(F.lit(" "), F.regexp_replace(t, _PUNCTUATION, " "), F.lit(" "))
    t = F.regexp_replace(t, " {2,}", " ")
    for a, b in SPELLINGS:
        t = F.replace(t, F.lit(f" {a} "), F.lit(f" {b} "))
    return F.trim(t)


def known_licences(spark: SparkSession, texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """(digest, licence, anchor): one row for each canonical form; of several names the first by name.

    The anchor is the form's longest word that no spelling rule makes: every text with
    that form holds it, letter case apart.
    """
    rows = spark.createDataFrame(texts or KNOWN, "licence string, text string")
    made = sorted({w for _, b in SPELLINGS for w in b.split()})
    words = F.filter(F.split(canonical(F.col("text")), " "), lambda w: ~w.isin(made))
    anchor = F.array_max(F.transform(words, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    return (rows.withColumn("anchor", anchor).groupBy(F.md5(canonical(F.col("text"))).alias("digest"))
            .agg(F.min("licence").alias("licence"), F.min("anchor").alias("anchor")))


def scanned(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, text_digest, licence, notices) for every row of ``docs``.

    licence: the known licence that the whole text is, else null. notices: the sorted
    distinct licences whose text one of the lines is. Null, empty and blank texts, and
    such with copyright lines only, are no licence. ``known`` is broadcast up to ``CATALOGUE``
    rows and its anchors spare most texts their digests; a larger one is joined. Repeated rows give a row each; rows with the same
    doc_id and different texts are kept apart. An empty table gives an empty result.
    """
    form = canonical(F.col("text"))
    rows = docs.select("doc_id", "text").withColumn("text_digest", F.when(form != "", F.md5(form)))
    small = known.limit(CATALOGUE + 1).count() <= CATALOGUE
    anchors = [r["anchor"] for r in known.select("anchor").distinct().collect()] if small else [None]
    known = F.broadcast(known.select("digest", "licence")) if small else known.select("digest", "licence")
    whole = rows.join(known, F.col("text_digest") == F.col("digest"), "left")

    def may_match(text: str) -> Column:
        """Only texts and lines with an anchor can have a known form; the rest need no digest."""
        low = F.lower(F.col(text))
        return reduce(or_, [F.contains(low, F.lit(a)) for a in anchors], F.lit(False)) if all(anchors) else F.lit(True)

    # Rows of one id are told apart by their exact texts, so each has the notices of its own lines.
    lines = (rows.where(may_match("text"))
             .select("doc_id", F.md5("text").alias("exact"), F.explode(F.split("text", "\n")).alias("line"))
             .where(may_match("line")))
    line = canonical(F.col("line"))
    found = (lines.withColumn("digest", F.when(line != "", F.md5(line))).join(known, "digest")
             .groupBy("doc_id", "exact").agg(F.array_sort(F.collect_set("licence")).alias("notices"))
             .withColumnsRenamed({"doc_id": "_doc", "exact": "_exact"}))
    whole = whole.select("doc_id", "text_digest", "licence", F.md5("text").alias("exact"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("exact") == F.col("_exact"))
    return (whole.join(found, same, "left")
            .select("doc_id", "text_digest", "licence",
                    F.coalesce("notices", F.array().cast("array<string>")).alias("notices")))


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql_canonical(x: str) -> str:
    t = f"regexp_replace(lower({x}), {_sql_text(_COPYRIGHT)}, chr(10), 'g')"
    t = f"' ' || regexp_replace({t}, {_sql_text(_PUNCTUATION)}, ' ', 'g') || ' '"
    t = f"regexp_replace({t}, ' {{2,}}', ' ', 'g')"
    for a, b in SPELLINGS:
        t = f"replace({t}, ' {a} ', ' {b} ')"
    return f"trim({t})"


def oracle_sql() -> str:
    """DuckDB SQL of the registered query over documents."""
    values = ", ".join(f"({_sql_text(n)}, {_sql_text(t)})" for n, t in KNOWN)
    return f"""
WITH known AS (SELECT md5({_sql_canonical('t')}) AS digest, min(n) AS licence FROM (VALUES {values}) AS k(n, t) GROUP BY 1),
doc AS (SELECT row_number() OVER () AS r, doc_id, text, {_sql_canonical('text')} AS form FROM documents),
line AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM doc),
notice AS (SELECT r, array_to_string(list_sort(list(DISTINCT licence)), ',') AS notices
  FROM (SELECT r, {_sql_canonical('line')} AS form FROM line) JOIN known ON form <> '' AND md5(form) = digest GROUP BY r)
SELECT doc_id, CASE WHEN form <> '' THEN md5(form) END AS text_digest, licence, coalesce(notices, '') AS notices
FROM doc LEFT JOIN known ON form <> '' AND md5(form) = digest LEFT JOIN notice USING (r)"""
