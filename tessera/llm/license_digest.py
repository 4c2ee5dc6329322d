"""Licence scan by canonical digests, built from DataFrame functions alone.

A text is brought into a canonical form: copyright notices dropped, lower case,
anything but letters and digits read as one space, equivalent spellings made
one.  The digest of that form is joined to the digests of known licences, for
the entire text and for each of its lines (a licence notice is a line).
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# a name after "Copyright", but for the terms Holder, Owner, Notice, Licence, Law, before which licence text may wrap (RE2 has no look-ahead)
_NAME = r"(?-i:Copyright) +(?-i:[A-GI-KMP-ZÀ-ÖØ-Þ]|H[^o\n]|Ho[^l\n]|O[^w\n]|Ow[^n\n]|N[^o\n]|No[^t\n]|L[^ia\n]|Li[^c\n]|La[^w\n])"
#: a notice: a line that begins with a sign, or with "copyright" and a sign, a blank to fill in, a year, "by" or a name, or only reserves all rights
COPYRIGHT_LINE = (r"(?im)^[^\p{L}\p{N}\n]*(?:(?:copyright[ \t:,.;*-]*(?:\(c\)|©|&copy;|[\[<{]|\d{4}|by\b)|" + _NAME
                  + r"|\(c\)|©)[^\n]*|all rights reserved[^\p{L}\p{N}\n]*)$")

# fixed values: spellings that licence matching guidelines hold equivalent
SPELLINGS = (
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("catalogue", "catalog"), ("centre", "center"),
    ("copyright owner", "copyright holder"), ("customise", "customize"), ("emphasised", "emphasized"), ("favour", "favor"),
    ("favourite", "favorite"), ("fulfil", "fulfill"), ("fulfilment", "fulfillment"), ("https", "http"), ("initialise", "initialize"),
    ("judgement", "judgment"), ("labelling", "labeling"), ("labour", "labor"), ("licence", "license"), ("licenced", "licensed"),
    ("licences", "licenses"), ("licencing", "licensing"), ("sublicence", "sublicense"), ("sublicences", "sublicenses"), ("maximise", "maximize"),
    ("modelled", "modeled"), ("modelling", "modeling"), ("non commercial", "noncommercial"), ("offence", "offense"),
    ("optimise", "optimize"), ("organisation", "organization"), ("organise", "organize"), ("per cent", "percent"),
    ("practise", "practice"), ("programme", "program"), ("realise", "realize"), ("recognise", "recognize"),
    ("signalling", "signaling"), ("sub license", "sublicense"), ("utilisation", "utilization"), ("whilst", "while"),
    ("wilful", "willful"),
)

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted"""
_ISC_TAIL = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING
ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
_BSD_GRANT = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software.
3. This notice may not be removed or altered from any source distribution."""
_APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""

# fixed values: known licences, entire texts and one-line notices
KNOWN = (
    ("MIT", _MIT), ("MIT", "MIT License\n" + _MIT), ("MIT", "The MIT License (MIT)\n" + _MIT),
    ("ISC", _ISC_GRANT + ", provided that the above copyright notice and this permission notice appear in all copies.\n" + _ISC_TAIL),
    ("0BSD", _ISC_GRANT + ".\n" + _ISC_TAIL),
    ("BSD-2-Clause", _BSD_GRANT + "\n" + _BSD_TAIL), ("BSD-3-Clause", _BSD_GRANT + "\n" + _BSD_NAMES + "\n" + _BSD_TAIL),
    ("Zlib", _ZLIB), ("Apache-2.0", _APACHE_HEADER),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."), ("CC0-1.0", "Licensed under CC0 1.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("MIT", "SPDX-License-Identifier: MIT"), ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"), ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
)

_VARIANTS = r"\b(?:" + "|".join(a for a, _ in SPELLINGS) + r")\b"


def plain_lines(text: Column) -> Column:
    """Canonical form but for spellings: words separated by one space, or by one line feed where a line ended."""
    rest = F.regexp_replace(text, COPYRIGHT_LINE, "")
    words = F.regexp_replace(F.lower(rest), r"[^\p{L}\p{N}\n]+", " ")
    return F.trim(F.regexp_replace(words, r" ?\n[ \n]*", "\n"), F.lit(" \n"))


def one_spelling(lines: Column) -> Column:
    """Equivalent spellings made one; only texts that hold any are gone through."""
    same = lines
    for a, b in SPELLINGS:
        same = F.regexp_replace(same, rf"\b{a}\b".replace(" ", "[ \n]"), b)
    return F.when(lines.rlike(_VARIANTS.replace(" ", "[ \n]")), same).otherwise(lines)


def canonical_lines(text: Column) -> Column:
    """Canonical form of a text, with its line breaks."""
    return one_spelling(plain_lines(text))


def digest(canonical: Column) -> Column:
    """Digest of a canonical text, its lines joined by spaces."""
    return F.sha2(F.translate(canonical, "\n", " "), 256)


def canonical_text(text: str) -> str:
    """The canonical form, lines joined by spaces, of one text on the driver (for the table of known licences)."""
    rest = re.sub(COPYRIGHT_LINE.replace(r"[^\p{L}\p{N}\n]", r"(?:[^\w\n]|_)"), "", text)
    out = " ".join(re.findall(r"[^\W_]+", rest.lower()))
    for a, b in SPELLINGS:
        out = re.sub(rf"\b{a}\b", b, out)
    return out


def known_licenses(spark: SparkSession) -> DataFrame:
    """``digest, license`` of the built-in licences and notices."""
    return spark.createDataFrame(known_digests(), "digest string, license string")


def known_digests() -> list[tuple[str, str]]:
    return sorted({(hashlib.sha256(canonical_text(t).encode()).hexdigest(), name) for name, t in KNOWN})


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row per input row: ``doc_id, digest, license, notices``.

    ``license`` is the known licence whose entire text the document is (null if
    none), ``notices`` the known licences that single lines of it state, sorted and
    joined by commas (empty if none).  A null text counts as empty.  ``known``
    (``digest, license``, one row per digest) replaces the built-in table.  The
    built-in one is a constant of a few rows, so each digest is looked up where its
    text is read and no row moves; a given table may be large and is joined.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # one projection a step, so that no step's regular expressions run more than once a text
    forms = (docs.select("doc_id", plain_lines(text).alias("_plain"))
             .select("doc_id", one_spelling(F.col("_plain")).alias("_form"))
             .select("doc_id", digest(F.col("_form")).alias("digest"),
                     F.array_distinct(F.transform(F.split("_form", "\n"), lambda x: F.sha2(x, 256))).alias("_lines")))
    if known is None:
        names = F.create_map(*[F.lit(x) for pair in known_digests() for x in pair])
        stated = F.array_compact(F.transform("_lines", lambda x: F.element_at(names, x)))
        return forms.select("doc_id", "digest", F.element_at(names, F.col("digest")).alias("license"),
                            F.array_join(F.array_sort(F.array_distinct(stated)), ",").alias("notices"))
    table = known.select(F.col("digest").alias("_known"), "license")
    # the entire text and every line are looked up in one join; a text without a match keeps its own row
    keys = F.concat(F.array(F.struct(F.lit(True).alias("whole"), F.col("digest").alias("key"))),
                    F.transform("_lines", lambda x: F.struct(F.lit(False).alias("whole"), x.alias("key"))))
    found = forms.select("doc_id", "digest", F.explode(keys).alias("k")).select("doc_id", "digest", "k.whole", "k.key")
    found = found.join(table, F.col("key") == F.col("_known"), "left").where(F.col("whole") | F.col("license").isNotNull())
    rows = found.groupBy("doc_id", "digest").agg(
        F.count_if("whole").alias("_copies"), F.max(F.when(F.col("whole"), F.col("license"))).alias("license"),
        F.array_join(F.array_sort(F.collect_set(F.when(~F.col("whole"), F.col("license")))), ",").alias("notices"))
    # rows of one id and one canonical text were counted as one
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select(
        "doc_id", "digest", "license", "notices")


def oracle() -> str:
    """The same scan of ``documents`` in DuckDB SQL."""
    lit = lambda s: "'" + s.replace("'", "''") + "'"
    same = "l"
    for a, b in SPELLINGS:
        same = f"regexp_replace({same}, '\\b{a.replace(' ', '[ \\n]')}\\b', '{b}', 'g')"
    known = ", ".join(f"({lit(d)}, {lit(n)})" for d, n in known_digests())
    copyright_line = COPYRIGHT_LINE.replace("(?im)", "")
    return f"""
WITH known(d, license) AS (VALUES {known}),
words AS (
  SELECT doc_id, regexp_replace(lower(regexp_replace(coalesce(text, ''), {lit('(?im)' + copyright_line)}, '', 'g')),
                                '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g') AS w FROM documents),
plain AS (SELECT doc_id, trim(regexp_replace(w, ' ?\\n[ \\n]*', chr(10), 'g'), ' ' || chr(10)) AS l FROM words),
forms AS (SELECT doc_id, {same} AS form FROM plain),
whole AS (SELECT doc_id, form, sha256(replace(form, chr(10), ' ')) AS digest FROM forms),
stated AS (
  SELECT x.doc_id, x.digest, string_agg(DISTINCT k.license, ',' ORDER BY k.license) AS notices
  FROM (SELECT doc_id, digest, sha256(unnest(string_split(form, chr(10)))) AS d FROM whole) x JOIN known k ON x.d = k.d
  GROUP BY 1, 2)
SELECT w.doc_id, w.digest, k.license, coalesce(s.notices, '') AS notices
FROM whole w LEFT JOIN known k ON w.digest = k.d
LEFT JOIN stated s ON w.doc_id IS NOT DISTINCT FROM s.doc_id AND w.digest = s.digest"""
