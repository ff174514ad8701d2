"""Licence scans by canonical digests, in DataFrame expressions only.

A text is brought to a canonical form (lower case, copyright lines dropped,
punctuation and white space to single spaces, equivalent spellings unified),
and the digest of the whole form is joined with the digests of known licence
texts. Single lines are looked up the same way among licence notices.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Equivalent spellings, as word sequences of the canonical form.
SPELLINGS = [
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("licencing", "licensing"),
    ("licencee", "licensee"),
    ("licencor", "licensor"),
    ("sub license", "sublicense"),
    ("sub licence", "sublicense"),
    ("sublicence", "sublicense"),
    ("sublicences", "sublicenses"),
    ("acknowledgement", "acknowledgment"),
    ("acknowledgements", "acknowledgments"),
    ("analogue", "analog"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("behaviour", "behavior"),
    ("favour", "favor"),
    ("fulfil", "fulfill"),
    ("honour", "honor"),
    ("initialisation", "initialization"),
    ("judgement", "judgment"),
    ("organisation", "organization"),
    ("organisations", "organizations"),
    ("recognised", "recognized"),
    ("utilisation", "utilization"),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("per cent", "percent"),
    ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"),
    ("copyright holder", "copyright owner"),
    ("copyright holders", "copyright owners"),
    ("https", "http"),
    ("all rights reserved", ""),
]
# A line that states who holds a copyright.
COPYRIGHT_LINE = r"^[ \t]*[#*/;%-]*[ \t]*(copyright|\(c\)|©)[ \t]*(\(c\)|©|[0-9]{4}|<|\[)[^\n]*"
# The same in a text that still has its capitals, wider: also "Copyright, 2020", and a holder's name without a year, if the line
# holds nothing but names: up to 20 further words without small initials, addresses, and the small words that names are joined by.
HOLDER_LINE = (
    r"^[ \t]*[#*/;%-]*[ \t]*(?:(?i:copyright|\(c\)|©)[ \t]*(?:(?i:\(c\))|©|[0-9]{4}|<|\[)|(?i:copyright)[ \t]*[,:][ \t]*[0-9]{4}"
    r"|(?:Copyright|©)[ \t]*[,:]?[ \t]+(?:by[ \t]+|the[ \t]+)*"
    r"(?!(?:Licen[cs]es?|Acts?|Laws?|Notices?|Holders?|Owners?|Statements?|Office|Rights?|Interests?)\b)\p{Lu}\S*"
    r"(?:[ \t]+(?:[^\p{Ll}\s]\S*|\S*@\S*|https?:\S*|(?:of|and|the|for|by|at|de|der|den|du|di|da|van|von|la|le|et|al|its|other|others"
    r"|authors?|contributors?|all|rights|reserved)\b[.,;]?(?!\S))){0,20}+[ \t\r]*$)[^\n]*"
)
NOT_WORD = r"[^\p{L}\p{N}]+"
NOT_WORD_OR_LINE = r"[^\p{L}\p{N}\n]+"

_WARRANTY_HEAD = "THE SOFTWARE IS PROVIDED \"AS IS\""
# Licence texts, their copyright lines left out.
LICENSES = {
    "MIT": f"""MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

{_WARRANTY_HEAD}, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": f"""ISC License

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

{_WARRANTY_HEAD} AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE.""",
    "0BSD": f"""Zero-Clause BSD

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

{_WARRANTY_HEAD} AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE.""",
    "BSD-2-Clause": """BSD 2-Clause License

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
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
    "Unlicense": f"""This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or
as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to
the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity
of all present and future rights to this software under copyright law.

{_WARRANTY_HEAD}, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>""",
    "Zlib": """zlib License

This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter
it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software.

3. This notice may not be removed or altered from any source distribution.""",
}
# Usual headings of the texts above, beside none at all.
HEADINGS = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)", "ISC License (ISCL)"],
    "0BSD": ["Zero-Clause BSD", "BSD Zero Clause License", "Zero-Clause BSD License", "BSD Zero-Clause License (0BSD)"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The 2-Clause BSD License", 'BSD 2-Clause "Simplified" License', "Simplified BSD License", "The BSD 2-Clause License"],
    "BSD-3-Clause": [
        "BSD 3-Clause License", "The 3-Clause BSD License", 'BSD 3-Clause "New" or "Revised" License', "New BSD License", "The BSD 3-Clause License",
        "Modified BSD License", "BSD License", "The BSD License",
    ],
    "Unlicense": ["The Unlicense", "Unlicense"],
    "Zlib": ["zlib License", "The zlib License", "zlib/libpng License", "The zlib/libpng License"],
}
# Names under which notices call a licence.
NAMES = {
    "MIT": ["the MIT License", "MIT"],
    "Apache-2.0": ["the Apache License, Version 2.0", "the Apache License 2.0", "Apache-2.0"],
    "BSD-2-Clause": ["the BSD 2-Clause License", "BSD-2-Clause"],
    "BSD-3-Clause": ["the BSD 3-Clause License", "BSD-3-Clause"],
    "ISC": ["the ISC License", "ISC"],
    "Zlib": ["the zlib License"],
    "MPL-2.0": ["the Mozilla Public License, version 2.0", "the Mozilla Public License 2.0", "MPL-2.0"],
    "GPL-2.0": ["the GNU General Public License, version 2", "the GNU GPL v2", "GPL-2.0"],
    "GPL-3.0": ["the GNU General Public License, version 3", "the GNU GPL v3", "GPL-3.0"],
    "LGPL-2.1": ["the GNU Lesser General Public License, version 2.1", "LGPL-2.1"],
    "LGPL-3.0": ["the GNU Lesser General Public License, version 3", "LGPL-3.0"],
    "AGPL-3.0": ["the GNU Affero General Public License, version 3", "AGPL-3.0"],
    "CC0-1.0": ["CC0 1.0"],
    "CC-BY-4.0": ["CC BY 4.0", "the Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "the Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "the Creative Commons Attribution-NonCommercial 4.0 International License"],
}
PHRASES = [
    f"{subject}{verb} under"
    for subject in ("", "This work is ", "This project is ", "This software is ", "This file is ", "This document is ")
    for verb in ("licensed", "released", "distributed")
]


def notices() -> list[tuple[str, str]]:
    """(licence id, notice line) for every phrase and name."""
    return [(key, f"{phrase} {name}") for key, names in NAMES.items() for phrase in PHRASES for name in names]


def longer_notices() -> list[tuple[str, str]]:
    """The notices as the head of a licence header: they also define "the License"."""
    heads = ['(the "License")', '(the "License"); you may not use this file except in compliance with the License.']
    return [(key, f"{notice} {head}") for key, notice in notices() for head in heads]


def known_texts() -> list[tuple[str, str]]:
    """(licence id, text) of the licence table: ``LICENSES``, BSD-3-Clause and the files beside this module, in their usual forms.

    Short texts come under each of ``HEADINGS`` and under none, BSD clauses with and without numbers; long ones with
    and without what follows their terms, and those of the FSF with its former address too. A file's name is its
    licence id, a part that tells wordings apart, and ``.txt``.
    """
    rows = list(LICENSES.items())
    body = {k: t if k == "Unlicense" else t.split("\n", 1)[1].strip() for k, t in LICENSES.items()}
    third = (
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission."
    )
    head, tail = body["BSD-2-Clause"].split("THIS SOFTWARE IS PROVIDED", 1)
    bodies = [*body.items(), ("BSD-3-Clause", f"{head}{third}\n\nTHIS SOFTWARE IS PROVIDED{tail}")]
    files = [(f.name, f.read_text(encoding="utf-8")) for f in sorted((Path(__file__).parent / "licenses").glob("*.txt"))]
    for name, text in files:
        key = re.match(r"(.+?)(\.[a-z]+)?\.txt$", name).group(1)
        if key in HEADINGS:
            bodies.append((key, text))
            continue
        ends = re.search(r"END OF TERMS AND CONDITIONS", text)
        forms = [text, *([text[: ends.end()], text[: ends.start()]] if ends else [])]
        moved = [re.sub(r"51 Franklin Street, Fifth Floor, Boston, MA\s+02110-1301,?\s+USA", "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA", t) for t in forms]
        rows += [(key, t) for t in dict.fromkeys([*forms, *moved])]
    for key, text in bodies:
        plain = re.sub(r"(?m)^[123]\. ", "", text) if key.startswith("BSD") else text
        rows += [(key, f"{title}\n\n{t}") for t in dict.fromkeys([text, plain]) for title in ["", *HEADINGS[key]]]
    return rows


def _unified(t: Column, spellings) -> Column:
    for a, b in spellings:
        t = F.replace(t, F.lit(f" {a.replace(' ', '  ')} "), F.lit(f" {b} "))
    return t


def _words(t: Column) -> Column:
    return F.trim(F.regexp_replace(t, " +", " "))


def _spaced_lines(text: Column) -> Column:
    """The text's words in lower case with spelling unified within lines; each word has spaces of its own, lines end in \\n."""
    t = F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), "(?dm)" + HOLDER_LINE, " "))
    t = F.regexp_replace(t, NOT_WORD_OR_LINE, "  ")
    return _unified(F.concat(F.lit("  "), F.replace(t, F.lit("\n"), F.lit("  \n  ")), F.lit("  ")), SPELLINGS)


def canonical_lines(spaced: Column) -> Column:
    """Canonical form of each line of a text in ``_spaced_lines`` form."""
    return F.transform(F.split(spaced, "\n", -1), _words)


def canonical_whole(spaced: Column) -> Column:
    """Canonical form of the whole text: spellings of several words may also span lines."""
    return _words(_unified(F.replace(spaced, F.lit("\n"), F.lit("")), [(a, b) for a, b in SPELLINGS if " " in a]))


def canonical(text: Column) -> Column:
    """Canonical form of a text: words by single spaces, '' for null."""
    return canonical_whole(_spaced_lines(text))


def digests(known: list[tuple[str, str]] | DataFrame, spark: SparkSession) -> DataFrame:
    """(digest, license_id) of known texts (license_id, text); of ids with one canonical form the first by name stays."""
    table = known if isinstance(known, DataFrame) else spark.createDataFrame(known, "license_id string, text string")
    rows = table.select("license_id", canonical(F.col("text")).alias("c"))
    return rows.where("c <> ''").groupBy(F.sha2("c", 256).alias("digest")).agg(F.min("license_id").alias("license_id"))


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    known: list[tuple[str, str]] | DataFrame | None = None,
    known_notices: list[tuple[str, str]] | DataFrame | None = None,
) -> DataFrame:
    """(doc_id, canonical_sha256, license_id, notices) for every row.

    ``known`` and ``known_notices`` are tables of (license_id, text); without
    them ``known_texts`` and all notices of this module are used.
    license_id names the known licence whose canonical text the whole text is,
    else null. notices lists, by comma and in order, the licences of which some
    line of the text is a notice; '' for none. A null text counts as empty and
    is no licence; repeated rows give repeated rows; an empty table gives none.
    Only ids, hashes and digests are joined, never texts.
    """
    spark = docs.sparkSession
    whole = digests(known_texts() if known is None else known, spark)
    lines = digests(notices() + longer_notices() if known_notices is None else known_notices, spark)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.select(F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("no"), F.xxhash64("text").alias("version"), "text")
    keys = ["id", "no", "version", "digest"]
    spaced = rows.select("id", "no", "version", _spaced_lines(F.col("text")).alias("spaced"))
    parts = spaced.select(
        "id", "no", "version", F.sha2(canonical_whole(F.col("spaced")), 256).alias("digest"), canonical_lines(F.col("spaced")).alias("lines")
    )
    parts = parts.select(*keys, F.posexplode("lines").alias("at", "line"))
    found = parts.select(*keys, "at", F.sha2("line", 256).alias("own")).join(
        lines.select(F.col("digest").alias("own"), F.col("license_id").alias("notice")), "own", "left"
    )
    # equal rows are counted once and given back as often as they came
    each = found.groupBy(*keys).agg(
        F.array_join(F.sort_array(F.collect_set("notice")), ",").alias("notices"), F.count(F.when(F.col("at") == 0, 1)).alias("times")
    )
    done = each.join(whole, "digest", "left").withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return done.select(
        F.when(~F.col("no"), F.col("id")).alias("doc_id"), F.col("digest").alias("canonical_sha256"), "license_id", "notices"
    )


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def canonical_sql(text: str) -> str:
    """The canonical form in DuckDB SQL."""
    t = f"regexp_replace(lower(coalesce({text}, '')), {_sql_text('(?m)' + COPYRIGHT_LINE)}, ' ', 'g')"
    t = f"('  ' || regexp_replace({t}, {_sql_text(NOT_WORD)}, '  ', 'g') || '  ')"
    for a, b in SPELLINGS:
        t = f"replace({t}, {_sql_text(' ' + a.replace(' ', '  ') + ' ')}, {_sql_text(' ' + b + ' ')})"
    return f"trim(regexp_replace({t}, ' +', ' ', 'g'))"


def scan_sql() -> str:
    """The scan of ``documents`` in DuckDB SQL."""
    values = lambda rows: ", ".join(f"({_sql_text(k)}, {_sql_text(v)})" for k, v in rows)
    known = lambda rows: (
        f"SELECT sha256(c) AS digest, min(license_id) AS license_id FROM (SELECT license_id, {canonical_sql('text')} AS c "
        f"FROM (VALUES {values(rows)}) v(license_id, text)) WHERE c <> '' GROUP BY 1"
    )
    return f"""
WITH whole AS ({known(LICENSES.items())}), notice AS ({known(notices())}),
own AS (SELECT doc_id, sha256({canonical_sql('text')}) AS digest FROM documents),
line AS (SELECT doc_id, sha256({canonical_sql('line')}) AS digest
         FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)),
hit AS (SELECT doc_id, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notices
        FROM line JOIN notice USING (digest) GROUP BY doc_id)
SELECT own.doc_id, own.digest AS canonical_sha256, whole.license_id, coalesce(hit.notices, '') AS notices
FROM own LEFT JOIN whole USING (digest) LEFT JOIN hit ON hit.doc_id = own.doc_id
"""
