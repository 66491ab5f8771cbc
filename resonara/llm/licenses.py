"""License scans by canonical digest.

A text is brought to a canonical form - lower case, copyright lines left out,
punctuation and list marks as blanks, equivalent spellings united - and the digest
of the whole form is looked up in a table of known license digests by a hash join.
What is looked up are the whole text and each of its paragraphs (stretches of lines
between empty lines) and lines as texts of their own, so a notice at a document's
end is found as well as a document that is a license.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from resonara.llm import license_texts

#: Spellings that count as the same, as the published matching guidelines for license texts list them.
EQUIVALENT = (
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"),
    ("catalogue", "catalog"), ("centre", "center"), ("colour", "color"), ("copyright owner", "copyright holder"),
    ("favour", "favor"), ("favourite", "favorite"), ("fulfil", "fulfill"), ("fulfilment", "fulfillment"), ("https", "http"),
    ("initialise", "initialize"), ("judgement", "judgment"), ("labelling", "labeling"), ("labour", "labor"),
    ("licence", "license"), ("licenced", "licensed"), ("licences", "licenses"), ("maximise", "maximize"), ("modelling", "modeling"),
    ("modelled", "modeled"), ("noncommercial", "non commercial"), ("offence", "offense"), ("optimise", "optimize"),
    ("organisation", "organization"), ("organise", "organize"), ("practise", "practice"), ("programme", "program"),
    ("realise", "realize"), ("recognise", "recognize"), ("signalling", "signaling"), ("sublicence", "sublicense"),
    ("sub license", "sublicense"), ("sub licence", "sublicense"), ("utilisation", "utilization"), ("whilst", "while"),
    ("wilful", "willful"), ("v 2", "version 2"), ("v 3", "version 3"), ("v2", "version 2"), ("v3", "version 3"),
)
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to
do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR
ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH
THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided
that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY
DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions
and limitations under the License."""
_GPL3_NOTICE = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""
_GPL2_NOTICE = _GPL3_NOTICE.replace("either version 3", "either version 2")

#: License and a text that states it.  Full texts, file notices and the short statements in use.
KNOWN = (
    ("MIT", _MIT), ("MIT", "MIT License\n\n" + _MIT), ("MIT", "The MIT License (MIT)\n\n" + _MIT),
    ("ISC", _ISC), ("ISC", "ISC License\n\n" + _ISC),
    ("Apache-2.0", license_texts.APACHE_2), ("Apache-2.0", license_texts.APACHE_2.split("   APPENDIX:")[0]),
    ("GPL-2.0-only", license_texts.GPL_2), ("GPL-3.0-only", license_texts.GPL_3), ("LGPL-3.0-only", license_texts.LGPL_3),
    ("MPL-2.0", license_texts.MPL_2), ("CC0-1.0", license_texts.CC0_1), ("BSD-3-Clause", license_texts.BSD_REGENTS),
    *((license_id, title + re.sub(r"(?m)^\d\.", mark, text)) for license_id, title, text in (
        ("BSD-2-Clause", "BSD 2-Clause License", license_texts.BSD_2), ("BSD-3-Clause", "BSD 3-Clause License", license_texts.BSD_3))
      for title in ("", title + "\n\n") for mark in (r"\g<0>", "*")),
    *((license_id, title + text) for license_id, title, text in (
        ("Zlib", "zlib License", license_texts.ZLIB), ("Unlicense", "The Unlicense", license_texts.UNLICENSE)) for title in ("", title + "\n\n")),
    ("Apache-2.0", _APACHE_NOTICE), ("GPL-3.0-or-later", _GPL3_NOTICE), ("GPL-2.0-or-later", _GPL2_NOTICE),
)
#: License and the names under which short statements cite it.
NAMES = (
    ("MIT", ("MIT License", "The MIT License", "MIT")),
    ("Apache-2.0", ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0", "Apache Software License 2.0")),
    ("GPL-2.0-only", ("GNU General Public License, version 2", "GNU General Public License v2", "GNU GPL version 2", "GPL-2.0", "GPLv2", "GPL-2.0-only")),
    ("GPL-3.0-only", ("GNU General Public License, version 3", "GNU General Public License v3", "GNU GPL version 3", "GPL-3.0", "GPLv3", "GPL-3.0-only")),
    ("LGPL-3.0-only", ("GNU Lesser General Public License, version 3", "LGPL-3.0", "LGPLv3", "LGPL-3.0-only")),
    ("AGPL-3.0-only", ("GNU Affero General Public License, version 3", "AGPL-3.0", "AGPLv3", "AGPL-3.0-only")),
    ("BSD-2-Clause", ("BSD 2-Clause License", "BSD-2-Clause", "Simplified BSD License")),
    ("BSD-3-Clause", ("BSD 3-Clause License", "BSD-3-Clause", "New BSD License", "Modified BSD License")),
    ("MPL-2.0", ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL-2.0")),
    ("ISC", ("ISC License", "ISC")), ("Unlicense", ("Unlicense", "The Unlicense")), ("Zlib", ("zlib License", "Zlib")),
    ("CC0-1.0", ("CC0 1.0", "CC0", "CC0-1.0", "Creative Commons Zero v1.0 Universal")),
    *((f"CC-{kind}-4.0", (f"CC {kind} 4.0", f"CC-{kind}-4.0", f"Creative Commons {name} 4.0 International License", f"Creative Commons {name} 4.0"))
      for kind, name in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
                         ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
                         ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))),
)
#: The short statements, with {} for a name.
STATEMENTS = ("{}", "License: {}", "Licensed under {}", "Licensed under the {}", "Licensed under the terms of the {}", "Released under {}",
              "Released under the {}", "Distributed under the {}", "This work is licensed under {}", "This work is licensed under the {}",
              "This work is licensed under a {}", "This project is licensed under the {}", "SPDX-License-Identifier: {}",
              "Available under the {}", "Published under the {}")
#: Names too short or common to stand for a license without a statement around them.
BARE = frozenset({"MIT", "ISC", "Zlib", "CC0"})


COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}\n]*(?:copyright[ \t]*(?:\(c\)|©|\d|:|by\b)|\(c\)[ \t]|©|all rights reserved)[^\n]*$"
FEW_LICENSES = 50_000


def plain(text: Column) -> Column:
    """Lower case without copyright lines; one blank for each stretch of anything but letters and digits."""
    form = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "")
    return F.trim(F.regexp_replace(form, r"[^\p{L}\p{N}]+", " "))


def united(form: Column) -> Column:
    """Equivalent spellings of a plain form brought to one; spellings are whole words."""
    form = F.concat(F.lit(" "), F.replace(form, F.lit(" "), F.lit("  ")), F.lit(" "))
    for written_as, standard in EQUIVALENT:
        form = F.replace(form, F.lit(f" {written_as.replace(' ', '  ')} "), F.lit(f" {standard.replace(' ', '  ')} "))
    return F.trim(F.replace(form, F.lit("  "), F.lit(" ")))


def known_texts() -> list[tuple[str, str]]:
    """License and text: the full texts and notices, and every short statement under every name."""
    short = [(license_id, statement.format(name)) for license_id, names in NAMES for name in names for statement in STATEMENTS
             if statement != "{}" or name not in BARE]
    return [*KNOWN, *short]


def known_licenses(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(known_texts(), "license_id string, text string")


def license_scan(docs: DataFrame, licenses: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Findings: ``id``, ``license_id``, ``unit`` (text, paragraph or line), ``position`` and ``content``.

    ``licenses`` has ``license_id`` and ``text``.  Paragraphs (between empty lines)
    and lines are units where there are several.  Each unit is reported once for
    each license whose digest it has, at its position from 0, equal rows of
    ``docs`` each.  Null, empty and copyright-only texts give no findings.

    Only units that begin like a known license have their spellings united and
    their digest looked up: a spelling spans two words at most, so the first two
    words of the canonical form follow from the first four.
    """
    table = (licenses.select("license_id", united(plain(F.col("text"))).alias("form")).where("form != ''")
             .select("license_id", F.sha2(F.col("form").cast("binary"), 256).alias("digest"),
                     F.substring_index("form", " ", 2).alias("begin")).distinct())
    if table.count() <= FEW_LICENSES:
        table = F.broadcast(table)

    # a form never reaches over a line end, so the lines' forms make up the text's; they are
    # made by a generator, which keeps them from being made again wherever they are used
    lines = F.split(F.col(text_col), "\n", -1)
    made = docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"),
        F.inline(F.array(F.struct(lines.alias("lines"), F.transform(lines, plain).alias("forms")))))

    def unit(name: str, position: Column | int, content: Column, form: Column) -> Column:
        return F.struct(F.lit(name).alias("unit"), (F.lit(position) if isinstance(position, int) else position).alias("position"),
                        content.alias("content"), form.alias("form"))

    whole = F.array(unit("text", 0, F.col("text"), F.array_join(F.filter("forms", lambda form: form != ""), " ")))
    own = F.transform("lines", lambda line, at: unit("line", at, line, F.col("forms")[at]))
    parts = F.split("text", "\n\n", -1)
    paragraphs = F.transform(parts, lambda part, at: unit("paragraph", at, part, plain(part)))
    none = F.slice(own, 1, 0)
    found = made.select("id", F.inline(F.concat(
        whole, F.when(F.size(parts) > 1, paragraphs).otherwise(none), F.when(F.size("lines") > 1, own).otherwise(none)))).where("form != ''")
    begin = F.substring_index(united(F.substring_index("form", " ", 4)), " ", 2)
    likely = found.withColumn("begin", begin).join(table.select("begin").distinct(), "begin", "left_semi")
    likely = likely.withColumn("digest", F.sha2(united(F.col("form")).cast("binary"), 256))
    return likely.join(table.drop("begin"), "digest").select("id", "license_id", "unit", "position", "content")
