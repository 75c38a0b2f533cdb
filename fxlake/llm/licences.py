"""Licence scans by canonical digest: normalise a whole text, hash it, join known digests.

Two kinds of whole texts are looked up: the document and each of its lines. The
canonical form lower-cases A-Z, drops copyright lines, replaces equivalent
spellings and turns every run of other characters into one space. A text is
only normalised when it holds one of ``TRIGGERS``: runs of letters that
normalisation neither splits nor makes, and of which every known canonical text
holds one (checked), so ordinary text is not rewritten.

Cases: null and empty texts hold nothing; repeated rows are answered each; a
line or document that differs from a known text in any canonical word is no
hit; an empty table gives no rows.
"""

from __future__ import annotations

import re
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, functions as F

# Notices and whole licence texts; the README lists what is covered.
KNOWN = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        'law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ],
    "MIT": [
        "Licensed under the MIT License.",
        "Released under the MIT License.",
        "MIT License Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
        "this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "
        '"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
        "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
        *[title + "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
          "provided that the above copyright notice and this permission notice appear in all copies. "
          'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
          "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
          "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
          "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
          for title in ("", "ISC License ")],
    ],
    "GPL-3.0-only": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
    ],
    "GPL-2.0-only": ["This work is licensed under the GNU General Public License, version 2."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "All-Rights-Reserved": ["All rights reserved."],
}
_MIT = KNOWN["MIT"][2].removeprefix("MIT License ")
KNOWN["MIT"] += [title + _MIT for title in ("", "The MIT License ", "The MIT License (MIT) ")]

_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
        "the following disclaimer in the documentation and/or other materials provided with the distribution. ")
_BSD_3 = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
          "derived from this software without specific prior written permission. ")
_BSD_END = ('THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, '
            "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT "
            "SHALL THE COPYRIGHT {holder} OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
            "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR "
            "PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
            "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
            "POSSIBILITY OF SUCH DAMAGE.")
# With and without title, a line of reserved rights and numbers (bullets vanish in the canonical form).
for _name, _body in (("BSD-2-Clause", _BSD), ("BSD-3-Clause", _BSD + _BSD_3)):
    KNOWN[_name] = [title + rights + body + _BSD_END.format(holder=holder)
                    for title in ("", _name.replace("-", " ", 1) + " License ") for rights in ("", "All rights reserved. ")
                    for body in (_body, re.sub(r"\b[123]\. ", "* ", _body)) for holder in ("HOLDER", "HOLDERS")]


def _published() -> dict[str, list[str]]:
    """The licences of ``texts``: as published, which drops wrapped lines that begin like a copyright line, and unwrapped;
    Apache-2.0 without its appendix, too."""
    out = {}
    for path in sorted((Path(__file__).parent / "texts").glob("*.txt")):
        whole = path.read_text(encoding="utf-8")
        cuts = [whole, whole.split("APPENDIX:")[0]] if "APPENDIX:" in whole else [whole]
        out[path.stem] = [form for cut in cuts for form in (cut, " ".join(cut.split()))]
    return out


for _name, _texts in _published().items():
    KNOWN.setdefault(_name, []).extend(_texts)
KNOWN["MPL-2.0"] += ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                     f"distributed with this file, You can obtain one at {scheme}://mozilla.org/MPL/2.0/." for scheme in ("http", "https")]
# Spellings that count as equal.
SPELLINGS = [
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"),
    ("organisation", "organization"), ("authorisation", "authorization"), ("merchantability", "merchantability"),
    ("acknowledgement", "acknowledgment"), ("favour", "favor"), ("honour", "honor"), ("labour", "labor"),
    ("non commercial", "noncommercial"), ("non infringement", "noninfringement"), ("share alike", "sharealike"),
    ("copyright owner", "copyright holder"), ("copyright owners", "copyright holders"), ("per cent", "percent"), ("v 2 0", "version 2 0"),
]
# Each within one word, so no spacing, punctuation or line break splits it.
TRIGGERS = ["licen", "permission", "reserved", "redistribution"]
COPYRIGHT = r"(^|\n)[ \t]*(copyright|\(c\)|©)[^\n]*"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def canonical(text: Column) -> Column:
    """Lower case, no copyright lines, single spaces, one spelling; words are separated and framed by spaces."""
    x = F.translate(text, UPPER, LOWER)
    x = F.regexp_replace(x, COPYRIGHT, "$1")
    x = F.regexp_replace(x, "[^a-z0-9\u0080-\U0010ffff]+", " ")
    x = F.concat(F.lit(" "), F.trim(x), F.lit(" "))
    for old, new in SPELLINGS:
        if old != new:
            x = F.replace(x, F.lit(f" {old} "), F.lit(f" {new} "))
    return x


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def may_hold(text: Column) -> Column:
    low = F.translate(text, UPPER, LOWER)
    return reduce(lambda a, b: a | b, [F.contains(low, F.lit(t)) for t in TRIGGERS])


def known_digests(spark, known: dict[str, list[str]] = KNOWN) -> DataFrame:
    """(digest, licence) of the known texts."""
    for t in TRIGGERS:
        made = [new for old, new in SPELLINGS if any(t in w for w in new.split()) and not any(t in w for w in old.split())]
        if not re.fullmatch("[a-z0-9]+", t) or made:
            raise ValueError(f"the trigger {t!r} is not one run of letters and digits that every spelling keeps")
    rows = [(name, text) for name, texts in known.items() for text in texts]
    table = spark.createDataFrame(rows, "licence string, text string").withColumn("form", canonical(F.col("text")))
    # What canonical() drops is no trigger of a text. The known texts are a short list.
    for name, form in table.select("licence", "form").collect():
        if not any(t in form for t in TRIGGERS):
            raise ValueError(f"a text of {name} holds none of TRIGGERS")
    return table.select(F.sha2("form", 256).alias("digest"), "licence").distinct()


def scan(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: dict[str, list[str]] = KNOWN) -> DataFrame:
    """Per row: doc, row (hash of its text), whole_text (licence or null), n_lines (hit lines), licences (comma-joined)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    body = documents.select(F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("row"), text.alias("text"))
    lines = F.filter(F.split("text", "\n"), may_hold)
    units = (body.where(may_hold(F.col("text"))).dropDuplicates(["doc", "row"])
             .select("doc", "row", F.explode(F.concat(F.array(F.struct(F.lit(True).alias("whole"), F.col("text").alias("unit"))),
                                                      F.transform(lines, lambda x: F.struct(F.lit(False).alias("whole"), x.alias("unit"))))).alias("u"))
             .select("doc", "row", "u.whole", digest(F.col("u.unit")).alias("digest")))
    hits = (units.join(known_digests(documents.sparkSession, known), "digest").groupBy("doc", "row")
            .agg(F.max(F.when(F.col("whole"), F.col("licence"))).alias("whole_text"),
                 F.count(F.when(~F.col("whole"), 1)).alias("n_lines"),
                 F.array_join(F.array_sort(F.collect_set("licence")), ",").alias("licences"))
            .withColumnsRenamed({"doc": "_doc", "row": "_row"}))
    return (body.select("doc", "row").join(hits, F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("row") == F.col("_row")), "left")
            .select("doc", "row", "whole_text", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.coalesce("licences", F.lit("")).alias("licences")))
