"""Licence scans by canonical digests.

Every line, every paragraph and the whole of a document are texts of their own. Each is brought to
one canonical form (case, punctuation, white space, copyright lines, equivalent spellings), and
the digest of that form is looked up in a small table of digests of known licences. Only entire
texts match; there is no search inside a text. Native expressions only: texts never leave their
row, and what is joined are digests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Identifiers of licences with the names that texts give them.
NAMES = {
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"),
    "MIT": ("MIT License",),
    "ISC": ("ISC License",),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License"),
    "MPL-2.0": ("Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "MPL 2.0"),
    "Unlicense": ("Unlicense",),
    "Zlib": ("zlib License",),
    "BSL-1.0": ("Boost Software License, Version 1.0", "Boost Software License 1.0"),
    "EPL-2.0": ("Eclipse Public License, Version 2.0", "Eclipse Public License 2.0"),
    "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero 1.0"),
}
# The GNU family and the Creative Commons family follow a rule.
GNU = {"GPL": "GNU General Public License", "LGPL": "GNU Lesser General Public License", "AGPL": "GNU Affero General Public License"}
GNU_VERSIONS = {"GPL": ("2.0", "3.0"), "LGPL": ("2.1", "3.0"), "AGPL": ("3.0",)}
CC_PARTS = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-NC": "Attribution-NonCommercial",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
CC_VERSIONS = ("2.0", "2.5", "3.0", "4.0")
# Sentences that grant a licence by its name; {} is the name.
GRANTS = (
    "{}",
    "Licensed under {}",
    "Licensed under the {}",
    "Released under {}",
    "Released under the {}",
    "Distributed under the {}",
    "This work is licensed under {}",
    "This work is licensed under the {}",
    "This work is licensed under a {}",
    "This software is licensed under the {}",
    "This software is released under the {}",
    "This project is licensed under the {}",
    "This program is licensed under the {}",
    "SPDX-License-Identifier: {}",
)
# Whole texts of short licences, as published.
MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
)
MIT_NOTICE = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the Software."
)
MIT_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
    "IN THE SOFTWARE."
)
ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies."
)
ISC_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING '
    "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
    "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
    "USE OR PERFORMANCE OF THIS SOFTWARE."
)
BSD_START = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:"
)
BSD_CONDITIONS = (
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution.",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.",
)
BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
    "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
    "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY "
    "OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
    "liable for any damages arising from the use of this software.",
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
    "alter it and redistribute it freely, subject to the following restrictions:",
    "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original "
    "software. If you use this software in a product, an acknowledgment in the product documentation would be "
    "appreciated but is not required.",
    "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original "
    "software.",
    "3. This notice may not be removed or altered from any source distribution.",
)
UNLICENSE = (
    "This is free and unencumbered software released into the public domain.",
    "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code "
    "form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all "
    "copyright interest in the software to the public domain. We make this dedication for the benefit of the public at "
    "large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of "
    "relinquishment in perpetuity of all present and future rights to this software under copyright law.",
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
    "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
)
UNLICENSE_ENDS = (
    "For more information, please refer to <https://unlicense.org>",
    "For more information, please refer to <http://unlicense.org/>",
)
BOOST_TITLE = "Boost Software License - Version 1.0 - August 17th, 2003"
BOOST = (
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
    'accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, '
    "execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties "
    "to whom the Software is furnished to do so, all subject to the following:",
    "The copyright notices in the Software and this entire statement, including the above license grant, this "
    "restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and "
    "all derivative works of the Software, unless such copies or derivative works are solely in the form of "
    "machine-executable object code generated by a source language processor.",
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL "
    "THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
    "IN THE SOFTWARE.",
)
# Notices at the head of files, for licences whose own text is long.
APACHE_NOTICE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
    "with the License. You may obtain a copy of the License at",
    "http://www.apache.org/licenses/LICENSE-2.0",
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
    'on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for '
    "the specific language governing permissions and limitations under the License.",
)
# {0}: program or library, {1}: the licence's name, {2}: its version.
GNU_NOTICE = (
    "This {0} is free software: you can redistribute it and/or modify it under the terms of the {1} as published by the "
    "Free Software Foundation, either version {2} of the License, or (at your option) any later version.",
    "This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
    "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {1} for more details.",
    "You should have received a copy of the {1} along with this {0}. If not, see <{3}://www.gnu.org/licenses/>.",
)
MPL_NOTICE = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
    "distributed with this file, You can obtain one at http{}://mozilla.org/MPL/2.0/."
)


def _bsd(conditions: int) -> tuple[str, ...]:
    """The text with numbered and with marked conditions."""
    lists = ("\n\n".join(f"{n}. {c}" for n, c in enumerate(BSD_CONDITIONS[:conditions], 1)), "\n\n".join(BSD_CONDITIONS[:conditions]))
    return tuple("\n\n".join((BSD_START, x, BSD_WARRANTY)) for x in lists)


def _gnu(short: str, version: str) -> tuple[str, ...]:
    plain = version.removesuffix(".0")
    return tuple(
        "\n\n".join(GNU_NOTICE).format(thing, GNU[short], plain, scheme)
        for thing in ("program", "library") for scheme in ("http", "https")
    )


FULL_TEXTS = {
    "BSD-2-Clause": (*_bsd(2), *(f"BSD 2-Clause License\n\n{t}" for t in _bsd(2))),
    "BSD-3-Clause": (*_bsd(3), *(f"BSD 3-Clause License\n\n{t}" for t in _bsd(3))),
    "Zlib": ("\n\n".join(ZLIB), "\n\n".join(("zlib License", *ZLIB))),
    "Unlicense": tuple("\n\n".join((*UNLICENSE, end)) for end in UNLICENSE_ENDS),
    "BSL-1.0": ("\n\n".join(BOOST), "\n\n".join((BOOST_TITLE, *BOOST))),
    "Apache-2.0": ("\n\n".join(APACHE_NOTICE), "\n\n".join(APACHE_NOTICE).replace("http:", "https:")),
    "MPL-2.0": (MPL_NOTICE.format(""), MPL_NOTICE.format("s")),
    **{f"{short}-{v}": _gnu(short, v) for short, versions in GNU_VERSIONS.items() for v in versions},
    "MIT": (
        "\n\n".join((MIT_GRANT, MIT_NOTICE, MIT_WARRANTY)),
        "\n\n".join(("MIT License", MIT_GRANT, MIT_NOTICE, MIT_WARRANTY)),
        "\n\n".join(("The MIT License (MIT)", MIT_GRANT, MIT_NOTICE, MIT_WARRANTY)),
    ),
    "ISC": ("\n\n".join((ISC_GRANT, ISC_WARRANTY)), "\n\n".join(("ISC License", ISC_GRANT, ISC_WARRANTY))),
}
# Spellings that count as one, applied in this order to lower-case words between single spaces.
SPELLINGS = (
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("sublicence", "sublicense"),
    ("organisation", "organization"),
    ("noncommercial", "non commercial"),
    ("sharealike", "share alike"),
    ("noderivatives", "no derivatives"),
    ("noninfringement", "non infringement"),
    ("merchantibility", "merchantability"),
    ("ver", "version"),
    ("v2", "version 2"),
    ("v3", "version 3"),
    ("v4", "version 4"),
    ("2 0", "2"),
    ("3 0", "3"),
    ("4 0", "4"),
    ("1 0", "1"),
)
ALL_RIGHTS = "all rights reserved"
RESERVED = "all-rights-reserved"
# A line that only states who holds the rights, behind marks of a comment or not: left out of texts
# of several lines. Where a word follows "copyright" a year tells it from a line of running text.
COPYRIGHT_LINE = r"^[ \t/#*;%!<-]*(?:copyright(?:[ \t]*$|[ \t]*[^a-z \t\n].*$|[ \t]+[a-z].*[12][0-9]{3}.*$)|\(c\).*$|©.*$)"
OTHER = "[^a-z0-9]+"
# A blank line or more between paragraphs.
BLANK = r"\n[ \t]*\n[ \t\r\n\f]*"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def canonical(text: Column) -> Column:
    """The canonical form: ASCII lower case, copyright lines left out, punctuation and white space
    as single spaces, equivalent spellings as one. NULL stays NULL."""
    out = F.translate(text, UPPER, UPPER.lower())
    # Lines end at line feeds only, and nowhere else.
    out = F.regexp_replace(F.regexp_replace(out, "(?md)" + COPYRIGHT_LINE, ""), OTHER, " ")
    out = F.concat(F.lit(" "), F.trim(out), F.lit(" "))
    for spelling, by in SPELLINGS:
        out = F.replace(out, F.lit(f" {spelling} "), F.lit(f" {by} "))
    return F.trim(out)


def known_texts() -> list[tuple[str, str]]:
    """Licence identifiers with every text that stands for them."""
    names = {k: set(v) | {k} for k, v in NAMES.items()}
    for short, long in GNU.items():
        for version in GNU_VERSIONS[short]:
            plain = version.removesuffix(".0")
            forms = {f"{long}, version {plain}", f"{long} version {plain}", f"{long} v{plain}", f"{short} v{plain}", f"{short}-{version}"}
            names[f"{short}-{version}"] = forms | {f"{short}-{version}-only", f"{short}v{plain}"}
    for part, long in CC_PARTS.items():
        for version in CC_VERSIONS:
            names[f"CC-{part}-{version}"] = {
                f"CC {part} {version}",
                f"CC-{part}-{version}",
                f"Creative Commons {long} {version} International License",
                f"Creative Commons {long} {version} License",
                f"Creative Commons {long} {version}",
            }
    texts = [(k, g.format(n)) for k, forms in names.items() for n in sorted(forms) for g in GRANTS]
    texts += [(k, t) for k, ts in FULL_TEXTS.items() for t in ts]
    return [*texts, (RESERVED, ALL_RIGHTS)]


def digests(spark: SparkSession) -> DataFrame:
    """``digest, license``: SHA-256 of the canonical form of every known text. Its size is fixed."""
    rows = spark.createDataFrame(known_texts(), "license string, text string")
    rows = rows.select(F.sha2(canonical(F.col("text")), 256).alias("digest"), "license")
    return rows.groupBy("digest").agg(F.min("license").alias("license"))


def _beginnings() -> str:
    """A pattern of the first two words of every known text, in all their spellings.

    A text can only equal a known one if its first words do, so this spares the others the
    canonical form. Between the two there may be whatever the canonical form leaves out.
    """

    def spelled(word: str) -> str:
        found = {a.split()[0] for a, b in SPELLINGS if b.split()[0] == word}
        return "(?:" + "|".join(sorted({word, *found})) + ")"

    between = f"(?:[^A-Za-z0-9]|{COPYRIGHT_LINE})+"
    firsts: dict[str, set[str]] = {}
    for _, text in known_texts():
        plain = "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower())
        # The first words as they are written here and as their canonical spelling is.
        first, *rest = _respelled(plain).split()
        firsts.setdefault(first, set()).add(rest[0] if rest else "")
    parts = []
    for first, seconds in sorted(firsts.items()):
        then = [between + "(?:" + "|".join(spelled(w) for w in sorted(seconds) if w) + ")"] if seconds - {""} else []
        then += [r"[^A-Za-z0-9\n]*$"] if "" in seconds else []  # nothing follows in its line
        parts.append(f"{spelled(first)}(?:{'|'.join(then)})")
    return "(?:" + "|".join(parts) + ")"


def _respelled(words: str) -> str:
    out = f" {' '.join(words.split())} "
    for spelling, by in SPELLINGS:
        out = out.replace(f" {spelling} ", f" {by} ")
    return out


def _units(text: Column) -> Column:
    """The entire texts in a document that begin like a known one: its lines, its paragraphs of
    several lines and itself. NULL if none of its lines does."""
    begins = F.lit("(?imd)^[^A-Za-z0-9\n]*" + _beginnings())
    unit = lambda kind, parts: F.transform(
        parts, lambda x, i: F.struct(F.lit(kind).alias("unit"), (i + 1).alias("place"), x.alias("body"))
    )
    paragraphs = F.filter(unit("paragraph", F.split(text, BLANK)), lambda s: F.instr(s["body"], "\n") > 0)
    # A text of one paragraph is found as that.
    whole = F.filter(unit("document", F.array(text)), lambda s: F.regexp_like(s["body"], F.lit(BLANK)))
    units = F.concat(unit("line", F.split(text, "\n")), paragraphs, whole)
    return F.when(F.regexp_like(text, begins), F.filter(units, lambda s: F.regexp_like(s["body"], begins)))


def scan(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, unit, place, license``: every line, paragraph or document that is a known licence
    text as a whole. ``place`` counts from 1; repeated rows give repeated results; NULL and empty
    texts give none; a NULL key is kept.
    """
    known = digests(df.sparkSession)
    # The outer form and the digest that is never NULL leave nothing to test below them, which
    # would compute units and digests twice.
    units = df.select(F.col(key).alias(key), F.explode_outer(_units(F.col(text))).alias("u"))
    digest = F.coalesce(F.sha2(canonical(F.col("u.body")), 256), F.lit(""))
    found = units.select(key, "u.unit", "u.place", digest.alias("digest"))
    return found.join(F.broadcast(known), "digest").select(key, "unit", "place", "license")


def per_document(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's ``key`` with ``licenses`` (sorted, comma-joined; empty if none) and ``n_found``."""
    found = scan(df, key, text).groupBy(key).agg(
        F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"), F.count("*").alias("n_found")
    )
    found = found.withColumnRenamed(key, "_found")
    rows = df.select(F.col(key)).join(found, F.col(key).eqNullSafe(F.col("_found")), "left")
    return rows.select(key, F.coalesce("licenses", F.lit("")).alias("licenses"), F.coalesce("n_found", F.lit(0)).alias("n_found"))


def _sql_canonical(text: str) -> str:
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    out = f"regexp_replace(translate({text}, '{UPPER}', '{UPPER.lower()}'), {quote('(?m)' + COPYRIGHT_LINE)}, '', 'g')"
    out = f"' ' || trim(regexp_replace({out}, '{OTHER}', ' ', 'g')) || ' '"
    for spelling, by in SPELLINGS:
        out = f"replace({out}, ' {spelling} ', ' {by} ')"
    return f"trim({out})"


def sql() -> str:
    """The same scan in SQL."""
    rows = ", ".join("('{}', '{}')".format(k, t.replace("'", "''")) for k, t in known_texts())
    return f"""
WITH known AS (
  SELECT sha256({_sql_canonical("t")}) AS digest, min(k) AS license FROM (VALUES {rows}) v(k, t) GROUP BY 1
), units AS (
  SELECT doc_id, 'line' AS unit, unnest(string_split(text, chr(10))) AS body,
         generate_subscripts(string_split(text, chr(10)), 1) AS place FROM documents WHERE text IS NOT NULL
  UNION ALL
  SELECT * FROM (SELECT doc_id, 'paragraph' AS unit, unnest(string_split_regex(text, '{BLANK}')) AS body,
         generate_subscripts(string_split_regex(text, '{BLANK}'), 1) AS place FROM documents WHERE text IS NOT NULL)
  WHERE contains(body, chr(10))
  UNION ALL
  SELECT doc_id, 'document', text, 1 FROM documents WHERE regexp_matches(text, '{BLANK}')
)
SELECT doc_id, unit, place::INTEGER AS place, license
FROM units JOIN known ON known.digest = sha256({_sql_canonical("body")})
"""
