"""License scan by canonical digest lookup, in DataFrame operations only.

Entire texts are brought to a canonical form (case, punctuation, white space,
copyright statements, numbers of lists, names of holders, equivalent spellings), digested, and hash-joined to the digests
of known license texts and notices. A document is looked up as a whole and line by
line, since files commonly carry a notice as one line of their own; either way the
unit is compared as an entire text, never by a part of it.

Every text is settled once; its lines and the whole are looked up in one pass. Only the
known digests are broadcast, and only after counting them (`BROADCAST_ROWS`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Spellings taken as equal, and known texts.
SPELLINGS = (
    ("licence", "license"),
    ("organisation", "organization"),
    ("authoris", "authoriz"),
    ("merchantibility", "merchantability"),
    ("sub license", "sublicense"),
    ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"),
    ("https", "http"),
)

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""

BSD_3 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

#: The same without its third condition.
BSD_2 = "\n\n".join(x for x in BSD_3.split("\n\n") if not x.startswith("3."))

ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""

BOOST = """Boost Software License - Version 1.0 - August 17th, 2003

Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>"""

#: Texts with the headings that they are found under.
TEXTS = (
    ("MIT", MIT, ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT")),
    ("BSD-3-Clause", BSD_3, ("BSD 3-Clause License", "The BSD 3-Clause License", "New BSD License", "The 3-Clause BSD License", "BSD License")),
    ("BSD-2-Clause", BSD_2, ("BSD 2-Clause License", "The BSD 2-Clause License", "Simplified BSD License", "The 2-Clause BSD License", "BSD License")),
    ("Zlib", ZLIB, ("zlib License", "The zlib License")),
    ("BSL-1.0", BOOST, ()),
    ("Unlicense", UNLICENSE, ("The Unlicense", "Unlicense")),
    ("ISC", ISC, ("ISC License", "The ISC License", "The ISC License (ISC)")),
)

KNOWN = (
    *((name, "text", head + "\n\n" + body) for name, body, heads in TEXTS for head in ("", *heads)),
    ("Apache-2.0", "notice", APACHE_NOTICE),
    ("MIT", "notice", "Released under the MIT License."),
    ("MIT", "notice", "Licensed under the MIT License."),
    ("MIT", "notice", "This project is licensed under the MIT License."),
    ("MIT", "notice", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "notice", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "notice", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "notice", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "notice", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "notice", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "notice", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "notice", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "notice", "SPDX-License-Identifier: GPL-2.0-only"),
    ("LGPL-3.0", "notice", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "notice", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "notice", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "notice", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-2-Clause", "notice", "Released under the BSD 2-Clause License."),
    ("BSD-2-Clause", "notice", "SPDX-License-Identifier: BSD-2-Clause"),
    ("MPL-2.0", "notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "notice", "SPDX-License-Identifier: MPL-2.0"),
    ("CC0-1.0", "notice", "Licensed under CC0 1.0."),
    ("CC0-1.0", "notice", "Dedicated to the public domain under CC0 1.0."),
    ("CC-BY-4.0", "notice", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "notice", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "notice", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "notice", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "notice", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "notice", "Licensed under CC BY-NC-SA 4.0."),
    ("proprietary", "notice", "All rights reserved."),
)

# Digests and sizes of the canonical forms of whole texts too long to stand here.
DIGESTS = (
    ("Apache-2.0", "text", 9863, "cf9739dc05765966fc191a4dbc2a4e34cca29a14bc442014e467766d0df5a6ef"),
    ("Artistic-1.0-Perl", "text", 5812, "b4afa077d253371bcb30944c7a16b4385d4d6a3a4220363535165a4734387bae"),
    ("CC0-1.0", "text", 6684, "2106cd4f7c9f6d4a9e5f54c911e4ff372736db5467794e4b89bcea996afde21c"),
    ("GFDL-1.2", "text", 19560, "c015dc0a33d4b0c9904c69fb6954d48550fa3a94f315fa7f95f494ff6b782e11"),
    ("GFDL-1.3", "text", 21990, "5bbcc2e4821491c735cc7e3fc53bb96ac511afd3e66939b7eb31de75ccb4ef78"),
    ("GPL-1.0", "text", 11740, "8006d6938e45108c7c95d49b6d84aa0a345eedc8566395dd2bc121b8e6ba4ae9"),
    ("GPL-2.0", "text", 17086, "5ca608bb2eb79eb10b1a80b55bb0a99df497ce228143b9d233b5df274e85643a"),
    ("GPL-3.0", "text", 33358, "9df17f8b30e00a627b3d6ed8a16ccb66c85169c334b9499fe926866baf3682c2"),
    ("LGPL-2.0", "text", 24089, "ec44c766883b869bef6a328cf51aafbe256ee10744ba67af3472eda9d0446def"),
    ("LGPL-2.1", "text", 25176, "5ef8b7ba71d31fa31954beed6b9d500255758be9aaae1903502fe0f4c080e8d9"),
    ("LGPL-3.0", "text", 7086, "828c3944cde1fc14c68737c9be14d8d0f4f13ab980f8a72364a0e64f72965525"),
    ("MPL-1.1", "text", 22433, "c21da7db47fdd9d729022114526313faa8058be180af2021998fbacdd011452e"),
    ("MPL-2.0", "text", 14320, "cf0cbde7aa46b215c9fa1eda48a097d574d70a04e3c2fab1c0b55f755160d0d6"),
)

# Patterns of the canonical form. They also run in the oracle, whose regular expressions have no look-around.
#: A number before an item of a list.
LIST_MARK = r"(?m)^[^\p{L}\p{N}\n]*[0-9]{1,2}[.)][ \t]+"
#: Points that end no sentence: after initials and abbreviations of companies, and inside words.
ABBREVIATION = r" (inc|ltd|co|corp|llc|\p{L})\."
INNER_POINT = r"\.+([^ \t\r\n.])"
#: A copyright statement at the start of a line, in lower case, up to the end of its sentence or line; it has a sign or a
#: year, as lines of a license's own text may begin with the word, too. Rights reserved after it, also in lines of their own.
_GAP = r"[^\p{L}\p{N}\n]*"
_YEAR = r"(?:[0-9]{4}|year|yyyy|19yy)"
HOLDER = rf"(?m)^{_GAP}(?:copyright{_GAP}(?:\(c\)|©)|copyright{_GAP}(?:by{_GAP})?{_YEAR}|\(c\){_GAP}(?:copyright{_GAP})?{_YEAR}|©)[^.\n]*\.?(?:([^\p{{L}}\p{{N}}]*)all rights reserved\.?)?"
#: Where a license names its holder: the names stand for each other.
NAMED = (
    (r"neither the names? of .*? nor the names? of", "neither the name of the copyright holder nor the names of"),
    (r"this software is provided by .*? as is and any", "this software is provided by the copyright holders and contributors as is and any"),
    (r"in no event shall .*? be liable for any direct", "in no event shall the copyright holder or contributors be liable for any direct"),
)
#: Known digests that are broadcast at most.
BROADCAST_ROWS = 1_000_000


def lines(text: Column) -> Column:
    """The text with case, punctuation, spellings, numbers of lists and copyright statements settled; line breaks are kept."""
    out = F.lower(F.coalesce(text, F.lit("")))
    # (?d): lines end at \n alone
    for pattern, keep in ((f"(?d){LIST_MARK}", ""), (ABBREVIATION, " $1 "), (INNER_POINT, " $1"), (f"(?d){HOLDER}", "$1"), (r"[^\p{L}\p{N}\n]+", " ")):
        out = F.regexp_replace(out, pattern, keep)
    for have, want in SPELLINGS:
        out = F.replace(out, F.lit(have), F.lit(want))
    return out


def joined(settled: Column) -> Column:
    """One settled text as a single line with the holder's names settled; blanks stand alone in it."""
    out = F.trim(F.regexp_replace(settled, r" ?\n[ \n]*", " "))
    for pattern, name in NAMED:
        out = F.regexp_replace(out, pattern, name)
    return out


def known_digests(spark: SparkSession, known=KNOWN, digests=DIGESTS) -> DataFrame:
    """digest, size, license, form: one row per digest; of clashing entries the smallest name stays."""
    rows = spark.createDataFrame(list(known), "license string, form string, text string").select(joined(lines(F.col("text"))).alias("body"), "license", "form")
    rows = rows.select(F.sha2("body", 256).alias("digest"), F.length("body").alias("size"), "license", "form")
    rows = rows.unionByName(spark.createDataFrame(list(digests), "license string, form string, size int, digest string"))
    return rows.groupBy("digest", "size").agg(F.min(F.struct("license", "form")).alias("m")).select("digest", "size", "m.license", "m.form")


def scan(spark: SparkSession, docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row per (document, license, form, unit): doc_id, license, form, unit, n_hits, first_line.

    known: digest, size (code points of the canonical form), license, form; without it
    `KNOWN` and `DIGESTS`. `unit` is `text` where the whole text is a known one, else
    `line`. n_hits counts matching lines (1 for a whole text), first_line the first of
    them from 1 (0 for a whole text). A text without words (null and empty ones too)
    matches nothing, whatever its length a text is settled whole; rows that repeat a
    doc_id add their hits. A copyright statement ends with its sentence or line, whatever its length;
    one without a sign or a year is left, and so is what a statement carries on in the next line.
    Rights reserved after a statement go with it. Documents without a known text have no row, nor does an
    empty table. Other columns are ignored.
    """
    known = known_digests(spark) if known is None else known.select("digest", "size", "license", "form")
    known = known.groupBy("digest").agg(F.min(F.struct("license", "form", "size")).alias("m")).select("digest", "m.license", "m.form", "m.size")
    few = known.count() <= BROADCAST_ROWS
    settled = docs.select("doc_id", lines(F.col("text")).alias("settled"))
    unit = lambda name, line, body: F.struct(F.lit(name).alias("unit"), line.cast("long").alias("line"), body.alias("body"))
    each = F.transform(F.split("settled", "\n", -1), lambda x, i: unit("line", i + 1, F.trim(x)))
    units = settled.select("doc_id", F.explode_outer(F.concat(each, F.array(unit("text", F.lit(0), joined(F.col("settled")))))).alias("u")).select("doc_id", "u.*").where("body <> ''")
    if few:  # only a unit as long as a known text is digested
        units = units.where(F.length("body").isin([r[0] for r in known.select("size").distinct().collect()]))
        known = F.broadcast(known)
    hits = units.select("doc_id", "unit", "line", F.sha2("body", 256).alias("digest")).join(known.drop("size"), "digest")
    return hits.groupBy("doc_id", "license", "form", "unit").agg(F.count(F.lit(1)).alias("n_hits"), F.min("line").alias("first_line"))


def oracle_sql(known=KNOWN, digests=DIGESTS) -> str:
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    spell = lambda x: "".join(["replace("] * len(SPELLINGS)) + x + "".join(f", {quote(a)}, {quote(b)})" for a, b in SPELLINGS)
    steps = ((LIST_MARK, ""), (ABBREVIATION, r" \1 "), (INNER_POINT, r" \1"), (HOLDER, r"\1"), (r"[^\p{L}\p{N}\n]+", " "))
    replaced = lambda x, pairs: "".join(["regexp_replace("] * len(pairs)) + x + "".join(f", {quote(a)}, {quote(b)}, 'g')" for a, b in pairs)
    settle = lambda x: spell(replaced(f"lower(coalesce({x}, ''))", steps))
    whole = lambda x: replaced(f"trim(regexp_replace({x}, '[ \\n]+', ' ', 'g'))", NAMED)
    values = ", ".join(f"({quote(a)}, {quote(b)}, {quote(c)})" for a, b, c in known)
    more = ", ".join(f"({quote(a)}, {quote(b)}, {quote(d)})" for a, b, _, d in digests)
    return f"""
WITH k AS (SELECT digest, min({{'license': license, 'form': form}}) AS m FROM (
             SELECT license, form, sha256({whole(settle('text'))}) AS digest FROM (VALUES {values}) AS v(license, form, text)
             UNION ALL SELECT * FROM (VALUES {more}) AS w(license, form, digest)) GROUP BY 1),
s AS (SELECT doc_id, {settle('text')} AS settled FROM documents),
l AS (SELECT doc_id, string_split(settled, chr(10)) AS parts FROM s),
u AS (SELECT doc_id, 'line' AS unit, i AS line, trim(parts[i]) AS body FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM l)
      UNION ALL SELECT doc_id, 'text', 0, {whole('settled')} FROM s)
SELECT doc_id, m.license AS license, m.form AS form, unit, count(*) AS n_hits, min(line) AS first_line
FROM u JOIN k ON sha256(u.body) = k.digest WHERE body <> '' GROUP BY ALL
"""
