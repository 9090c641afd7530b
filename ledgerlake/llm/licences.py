"""Licence scan by canonical digests, in DataFrame functions only.

A text's canonical form is in lower case, without copyright notices, with every run of other
characters than letters and digits as one space, and with one spelling of words that licences
spell differently. A copyright notice is a line that begins, behind any comment marks, with
`copyright` and holds a year or a sign, or that begins with a sign or `all rights reserved`.
Digests of whole documents, of their lines, and of every run of consecutive paragraphs as long as
a known text may be, are joined to the digests of known licence texts: a licence is found whole,
alone or beside other text, under a title, in comment marks, with its paragraphs set apart or not.

Null texts, and texts that are empty in canonical form, match nothing; known texts that are empty
in it are left out. A document has one row per licence, however often it occurs; equal passages of
a document count once. Rows that repeat an id are pooled; null ids form one document. A text of
any length is one row of paragraphs; only those that begin like a known text are digested. Other
columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import broadcast_if_small, store

# Spellings that count as equal, canonical one second.
SPELLINGS = [
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"),
    ("catalogue", "catalog"), ("centre", "center"), ("copyright holder", "copyright owner"), ("emphasised", "emphasized"),
    ("favour", "favor"), ("favourite", "favorite"), ("fulfil", "fulfill"), ("initialise", "initialize"),
    ("judgement", "judgment"), ("labelling", "labeling"), ("licence", "license"), ("licenced", "licensed"),
    ("licences", "licenses"), ("modelled", "modeled"), ("noncommercial", "non commercial"), ("organisation", "organization"),
    ("organised", "organized"), ("per cent", "percent"), ("programme", "program"), ("realise", "realize"),
    ("recognise", "recognize"), ("sub license", "sublicense"), ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful")]
COPYRIGHT_LINE = (r"(?m)^[ \t#*;%/<!-]*(?:copyright\b[^\n]*(?:\(c\)|©|\b[12][0-9][0-9][0-9]\b)|©|\(c\)|all rights reserved)[^\n]*$")
# Known texts are looked for in up to so many more paragraphs than they are written in here.
MORE_PARAGRAPHS = 2
# Known texts may begin with up to so many different words for texts to be told by them.
MOST_FIRSTS = 10_000
OTHER = r"[^\p{L}\p{N}\n]+"

# Public notices and licence texts.
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions "
        "and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list "
        "of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
        "{third}\n\nTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE "
        "ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
        "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
        "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
        "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
        "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
KNOWN = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "This project is licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at\n\n"
                   "http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, "
                   "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                   "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                   "permissions and limitations under the License."],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
            "to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above "
            "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
            "Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT "
            "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
            "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
            "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
            "OTHER DEALINGS IN THE SOFTWARE."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE "
            "IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
            "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
            "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
            "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
            "PERFORMANCE OF THIS SOFTWARE."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "Licensed under the GNU General Public License, version 3."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["Licensed under CC0 1.0.", "Released under CC0 1.0."],
    "BSD-3-Clause": ["Released under the BSD License.", "Licensed under the BSD 3-Clause License.",
                     _BSD.format(third="\n\n3. Neither the name of the copyright holder nor the names of its contributors may be used "
                                       "to endorse or promote products derived from this software without specific prior written "
                                       "permission.")],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License.", _BSD.format(third="")],
    "Zlib": ["This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
             "liable for any damages arising from the use of this software.\n\nPermission is granted to anyone to use this "
             "software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject "
             "to the following restrictions:\n\n1. The origin of this software must not be misrepresented; you must not claim "
             "that you wrote the original software. If you use this software in a product, an acknowledgment in the product "
             "documentation would be appreciated but is not required.\n\n2. Altered source versions must be plainly marked as "
             "such, and must not be misrepresented as being the original software.\n\n3. This notice may not be removed or "
             "altered from any source distribution."],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0.",
                "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
                "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, "
                "execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties "
                "to whom the Software is furnished to do so, all subject to the following:\n\nThe copyright notices in the "
                "Software and this entire statement, including the above license grant, this restriction and the following "
                "disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the "
                "Software, unless such copies or derivative works are solely in the form of machine-executable object code "
                "generated by a source language processor.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
                "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
                "PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE "
                "BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
                "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
}


def canonical_lines(text: Column) -> Column:
    """Canonical form but for spellings: lines as single, paragraphs as double line feeds."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(text), COPYRIGHT_LINE, ""), OTHER, " ")
    return F.trim(F.regexp_replace(F.regexp_replace(plain, " ?\n ?", "\n"), "\n{3,}", "\n\n"), F.lit(" \n"))


def canonical(lines: Column) -> Column:
    """From canonical lines to the canonical form of the whole. Every word has spaces of its own
    while spellings are replaced, so that neighbours don't share one."""
    out = F.concat(F.lit(" "), F.replace(F.translate(lines, "\n", " "), F.lit(" "), F.lit("  ")), F.lit(" "))
    for spelt, canon in SPELLINGS:
        old, new = (" " + x.replace(" ", "  ") + " " for x in (spelt, canon))
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.trim(F.regexp_replace(out, " +", " "))


def known_licences(spark: SparkSession) -> DataFrame:
    """licence_id and text of the notices and texts above."""
    rows = [(name, text) for name, texts in KNOWN.items() for text in texts]
    return spark.createDataFrame(rows, "licence_id string, text string")


def digests(known: DataFrame) -> DataFrame:
    """Stored: licence_id, digest, first (the canonical form's first word), paragraphs."""
    lines = known.select("licence_id", canonical_lines(F.col("text")).alias("lines"))
    return store(lines.select("licence_id", canonical(F.col("lines")).alias("form"), F.size(F.split("lines", "\n\n")).alias("paragraphs"))
                 .where("form != ''").select(
        "licence_id", F.sha2(F.col("form").cast("binary"), 256).alias("digest"),
        F.substring_index("form", " ", 1).alias("first"), "paragraphs").distinct(), "licence-digests")


def _beginnings(table: DataFrame) -> set[str] | None:
    """First words, in any spelling, of texts that may be known ones; None if that could be any."""
    firsts = {r["first"] for r in table.select("first").distinct().limit(MOST_FIRSTS + 1).collect()}
    if len(firsts) > MOST_FIRSTS:
        return None
    return firsts | {spelt.split()[0] for spelt, canon in SPELLINGS if canon.split()[0] in firsts}


def scan(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, licence_id, whole (the document is nothing else), n_texts (its different passages that are)."""
    table = digests(known)
    longest = (table.agg(F.max("paragraphs")).head()[0] or 0) + MORE_PARAGRAPHS
    firsts = _beginnings(table)

    def likely(text: Column) -> Column:
        if firsts is None:
            return F.lit(True)
        word = F.regexp_extract(text, "^[^ \n]*", 0)
        return word.isin(*sorted(firsts)) if firsts else F.lit(False)

    lines = docs.select(F.col(id_col).alias("id"), canonical_lines(F.col(text_col)).alias("text")).where("text != ''")
    split = lines.select("id", "text", F.split("text", "\n\n").alias("paragraphs"))
    begins = F.filter(F.sequence(F.lit(0), F.size("paragraphs") - 1), lambda i: likely(F.get("paragraphs", i)))
    runs = F.flatten(F.transform(begins, lambda i: F.transform(
        F.sequence(F.lit(1), F.least(F.lit(longest), F.size("paragraphs") - i)),
        lambda m: F.array_join(F.slice("paragraphs", i + 1, m), "\n\n"))))
    single = F.filter(F.split("text", "\n+"), likely)
    whole = F.filter(F.array("text"), likely)
    units = split.select("id", F.explode(F.transform(F.array_distinct(F.concat(whole, runs, single)), lambda p: F.struct(
        (p == F.col("text")).alias("whole"), p.alias("part")))).alias("u")).select("id", "u.whole", "u.part")
    found = units.select("id", "whole", F.sha2(canonical(F.col("part")).cast("binary"), 256).alias("digest"))
    return found.join(broadcast_if_small(table.select("licence_id", "digest").distinct()), "digest").groupBy("id", "licence_id").agg(
        F.max("whole").alias("whole"), F.count("*").alias("n_texts"))
