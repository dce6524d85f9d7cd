"""License scan by sentence rules, with DataFrame functions only.

A text is cut into sentences, lines of a wrapped paragraph or comment being joined first; a sentence
that holds one of the ``CRITICAL`` words is normalised, names and holders in it are replaced by a
fixed word, and it is looked up among the known licence sentences, which gives an identifier, or
``Unknown``.  The
identifiers of a document, in order, are then matched against licence rules, the first rule that
matches naming the licence; what a rule has matched is taken away before the next rule looks.

Everything happens inside one row, so nothing is shuffled and no group can be hot; both tables are
constants of this module or parameters of bounded size.

Defined cases: a null or empty text has no sentence and no licence; a licence that is stated more
than once is listed once, at its first rule; a known sentence in no matching rule names no licence; a
line of fewer than 40 characters is not taken for a wrapped one; rows that repeat are treated alike; other columns are
carried along or ignored.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.llm.common import column

#: Words a licence sentence must hold to be looked up; lower case, letters only.
CRITICAL = "licens|licenc|copyright|warrant|redistribut|permission|rights reserved|public domain|spdx"
UNKNOWN = "Unknown"
_END, _DOT = "\x1e", "\x1f"

#: Steps that put ``_END`` between the sentences of a text; no look-around, so SQL takes the same steps.
BREAKS: Sequence[tuple[str, str]] = (
    (r"\r\n?", "\n"),
    # What begins the lines of a comment.
    (r"\n[ \t]*(?:/\*+|\*+/|//+|#+|;+|\*)[ \t]*", "\n"),
    # Blank lines and list marks; a line of its own for copyright statements and identifiers.
    (r"\n[ \t]*\n[ \t\n]*", _END + "\n"),
    (r"\n[ \t]*(?:[0-9]{1,2}[.)]|\(?[a-z]\)|[-\x{2022}])[ \t]+", _END),
    (r"\n[ \t]*(Copyright|SPDX|All rights reserved)", _END + "$1"),
    (_END + "((?:Copyright|SPDX)[^\n" + _END + "]*)\n", _END + "$1" + _END),
    # A line that ends a sentence, a long line that goes on, a short line.
    (r"([.:!?])[ \t]*\n[ \t]*([A-Z(])", "$1" + _END + "$2"),
    ("([^\n" + _END + "]{40,})\n[ \t]*", "$1 "),
    (r"\n", _END),
    (r"([.!?])[ \t]+([A-Z(])", "$1" + _END + "$2"),
)
#: Steps that normalise a lower-cased sentence: a dot between digits stays, everything else but letters
#: and digits is one blank.
CLEAN: Sequence[tuple[str, str]] = (
    (r"([0-9])[.]([0-9])", "$1" + _DOT + "$2"), (r"[^\p{L}\p{N}" + _DOT + "]+", " "), (_DOT, "."), ("^ | $", ""),
)
#: Parts of normalised sentences that differ between holders and programs.
VARIABLE: Sequence[tuple[str, str]] = (
    (r"^copyright (?:c )?[0-9]{4}( .{0,200})?$", "copyright statement"),
    (r"^neither the name of .{1,120} nor the names of (?:its|any|their) contributors ", "neither the name of the copyright holder nor the names of its contributors "),
    (r"^this software is provided by .{1,120} as is and any express", "this software is provided by the copyright holders and contributors as is and any express"),
    (r"^in no event shall .{1,120} be liable for any direct ", "in no event shall the copyright holder or contributors be liable for any direct "),
    (r"^.{1,60} is free software you can redistribute it", "this program is free software you can redistribute it"),
    (r"^.{1,60} is distributed in the hope that", "this program is distributed in the hope that"),
    (r"^you should have received a copy of the gnu (lesser |affero |)general public license.*$", "you should have received a copy of the gnu $1general public license"),
    (r"^if not see https? www gnu org licenses$", "if not see https www gnu org licenses"),
    (r"^https? www apache org licenses license 2[.]0$", "https www apache org licenses license 2.0"),
    (r" at https? www apache org licenses license 2[.]0$", " at"),
)


def plain(sentence: str) -> str:
    """A sentence of the table, which is ASCII, normalised as ``normalised`` does it."""
    low = re.sub(r"([0-9])[.]([0-9])", rf"\1{_DOT}\2", sentence.lower())
    return re.sub(f"[^a-z0-9{_DOT}]+", " ", low).replace(_DOT, ".").strip()


_GNU = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public License"
_OLD = _GNU + " as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."

#: Known licence sentences and their identifiers.
SENTENCES: Mapping[str, str] = {plain(s): k for s, k in {
    # fixed values
    "Licensed under the Apache License, Version 2.0": "Apache2Ref",
    "Licensed under the Apache License, Version 2.0 (the License)": "Apache2Ref",
    "This file is licensed under the Apache License, Version 2.0": "Apache2Ref",
    "This project is licensed under the Apache License, Version 2.0": "Apache2Ref",
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.": "Apache2Grant",
    "You may not use this file except in compliance with the License": "ApacheUse",
    "You may obtain a copy of the License at": "ApacheCopy",
    "https://www.apache.org/licenses/LICENSE-2.0": "ApacheUrl",
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.": "ApacheAsIs",
    "See the License for the specific language governing permissions and limitations under the License.": "ApacheLimits",
    "SPDX-License-Identifier: Apache-2.0": "Apache2Spdx",
    "MIT License": "MitRef",
    "The MIT License (MIT)": "MitRef",
    "The MIT License": "MitRef",
    "Released under the MIT License": "MitRef",
    "Licensed under the MIT License": "MitRef",
    "This project is licensed under the MIT License": "MitRef",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:": "MitGrant",
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.": "MitNotice",
    "The above copyright notice and this permission notice (including the next paragraph) shall be included in all copies or substantial portions of the Software.": "MitNotice",
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.": "MitAsIs",
    "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.": "MitLiable",
    "SPDX-License-Identifier: MIT": "MitSpdx",
    "ISC License": "IscRef",
    "The ISC License": "IscRef",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.": "IscGrant",
    "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.": "IscGrant",
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.": "IscAsIs",
    "SPDX-License-Identifier: ISC": "IscSpdx",
    "BSD 2-Clause License": "Bsd2Ref",
    "BSD 3-Clause License": "Bsd3Ref",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:": "BsdGrant",
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.": "BsdSource",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.": "BsdBinary",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.": "BsdEndorse",
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.": "BsdAsIs",
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.": "BsdLiable",
    "SPDX-License-Identifier: BSD-2-Clause": "Bsd2Spdx",
    "SPDX-License-Identifier: BSD-3-Clause": "Bsd3Spdx",
    _GNU.format("") + " as published by the Free Software Foundation": "GplGrant",
    "Either version 2 of the License, or (at your option) any later version.": "V2OrLater",
    "Either version 3 of the License, or (at your option) any later version.": "V3OrLater",
    _OLD.format("", "2"): "Gpl2Later",
    _OLD.format("", "3"): "Gpl3Later",
    _GNU.format("") + " version 2 as published by the Free Software Foundation.": "Gpl2Only",
    _OLD.format("Lesser ", "2.1"): "Lgpl21Later",
    _OLD.format("Lesser ", "3"): "Lgpl3Later",
    _OLD.format("Affero ", "3"): "Agpl3Later",
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY": "GplNoWarranty",
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.": "GplNoWarranty",
    "See the GNU General Public License for more details.": "GplDetails",
    "See the GNU Lesser General Public License for more details.": "GplDetails",
    "See the GNU Affero General Public License for more details.": "GplDetails",
    "You should have received a copy of the GNU General Public License": "GplCopy",
    "You should have received a copy of the GNU Lesser General Public License": "GplCopy",
    "You should have received a copy of the GNU Affero General Public License": "GplCopy",
    "If not, see <https://www.gnu.org/licenses/>": "GplUrl",
    "This work is licensed under the GNU General Public License, version 3": "Gpl3Ref",
    "Licensed under the GNU General Public License, version 3": "Gpl3Ref",
    "SPDX-License-Identifier: GPL-2.0-only": "Gpl2Spdx",
    "SPDX-License-Identifier: GPL-2.0-or-later": "Gpl2LaterSpdx",
    "SPDX-License-Identifier: GPL-3.0-only": "Gpl3Spdx",
    "SPDX-License-Identifier: GPL-3.0-or-later": "Gpl3LaterSpdx",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": "Mpl2Ref",
    "SPDX-License-Identifier: MPL-2.0": "Mpl2Spdx",
    "Licensed under CC BY 4.0": "CcBy4Ref",
    "Licensed under CC BY-SA 4.0": "CcBySa4Ref",
    "Licensed under CC BY-NC 4.0": "CcByNc4Ref",
    "This work is licensed under a Creative Commons Attribution 4.0 International License": "CcBy4Ref",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License": "CcBySa4Ref",
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License": "CcByNc4Ref",
    "This work is dedicated to the public domain": "PublicDomain",
    "This is free and unencumbered software released into the public domain.": "PublicDomain",
    "All rights reserved": "AllRights",
    "Copyright statement": "Copyright",
}.items()}

#: Licence and the sequence of identifiers that states it, tried in this order.
RULES: Sequence[tuple[str, str]] = (
    # fixed values
    ("GPL-3.0-or-later", "GplGrant V3OrLater GplNoWarranty"),
    ("GPL-3.0-or-later", "GplGrant V3OrLater"),
    ("GPL-3.0-or-later", "Gpl3Later"),
    ("GPL-3.0-or-later", "Gpl3LaterSpdx"),
    ("GPL-2.0-or-later", "GplGrant V2OrLater GplNoWarranty"),
    ("GPL-2.0-or-later", "GplGrant V2OrLater"),
    ("GPL-2.0-or-later", "Gpl2Later"),
    ("GPL-2.0-or-later", "Gpl2LaterSpdx"),
    ("LGPL-3.0-or-later", "Lgpl3Later"),
    ("LGPL-2.1-or-later", "Lgpl21Later"),
    ("AGPL-3.0-or-later", "Agpl3Later"),
    ("BSD-3-Clause", "AllRights BsdGrant BsdSource BsdBinary BsdEndorse"),
    ("BSD-3-Clause", "BsdGrant BsdSource BsdBinary BsdEndorse"),
    ("BSD-3-Clause", "Bsd3Ref"),
    ("BSD-3-Clause", "Bsd3Spdx"),
    ("BSD-2-Clause", "AllRights BsdGrant BsdSource BsdBinary"),
    ("BSD-2-Clause", "BsdGrant BsdSource BsdBinary"),
    ("BSD-2-Clause", "Bsd2Ref"),
    ("BSD-2-Clause", "Bsd2Spdx"),
    ("MIT", "MitGrant MitNotice MitAsIs MitLiable"),
    ("MIT", "MitGrant MitNotice"),
    ("MIT", "MitRef"),
    ("MIT", "MitSpdx"),
    ("ISC", "IscGrant"),
    ("ISC", "IscRef"),
    ("ISC", "IscSpdx"),
    ("Apache-2.0", "Apache2Grant"),
    ("Apache-2.0", "Apache2Ref ApacheUse ApacheCopy"),
    ("Apache-2.0", "Apache2Ref"),
    ("Apache-2.0", "Apache2Spdx"),
    ("MPL-2.0", "Mpl2Ref"),
    ("MPL-2.0", "Mpl2Spdx"),
    ("GPL-2.0-only", "Gpl2Only"),
    ("GPL-2.0-only", "Gpl2Spdx"),
    ("GPL-3.0-only", "Gpl3Ref"),
    ("GPL-3.0-only", "Gpl3Spdx"),
    ("CC-BY-4.0", "CcBy4Ref"),
    ("CC-BY-SA-4.0", "CcBySa4Ref"),
    ("CC-BY-NC-4.0", "CcByNc4Ref"),
    ("Public-Domain", "PublicDomain"),
    ("Proprietary", "AllRights"),
    ("Unrecognised", UNKNOWN),
)


def _replaced(text: Column, steps: Sequence[tuple[str, str]]) -> Column:
    for pattern, new in steps:
        text = F.regexp_replace(text, pattern, new)
    return text


def normalised(sentence: Column) -> Column:
    """Lower case, cleaned, with the variable parts replaced."""
    return _replaced(F.lower(sentence), [*CLEAN, *VARIABLE])


def matched(ids: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Distinct licences of a sequence of identifiers, in the order of the rules."""
    table = F.array(*[F.struct(F.lit(f" {sequence} ").alias("ids"), F.lit(name).alias("name")) for name, sequence in rules])
    # A match becomes a bar, so what stands around it does not join.
    start = F.struct(F.concat(F.lit("| "), F.array_join(ids, " "), F.lit(" |")).alias("rest"), F.array().cast("array<string>").alias("names"))

    def step(state: Column, rule: Column) -> Column:
        # A blank ends one match and begins the next, so neighbours take two passes.
        once = F.replace(state["rest"], rule["ids"], F.lit(" | "))
        names = F.when(F.contains(state["rest"], rule["ids"]), F.array_append(state["names"], rule["name"])).otherwise(state["names"])
        return F.struct(F.replace(once, rule["ids"], F.lit(" | ")).alias("rest"), names.alias("names"))

    return F.array_distinct(F.aggregate(table, start, step, lambda state: state["names"]))


def scan(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", sentences: Mapping[str, str] = SENTENCES,
    rules: Sequence[tuple[str, str]] = RULES,
) -> DataFrame:
    """doc_id, sentence_ids (array, in order) and licenses (array, in the order of the rules)."""
    body = column(text)
    critical, nothing = f"(?i:{CRITICAL})", F.array().cast("array<string>")
    pieces = F.split(_replaced(F.concat(F.lit("\n"), body), BREAKS), _END, -1)
    cut = F.when(body.rlike(critical), F.filter(pieces, lambda s: s.rlike(critical))).otherwise(nothing)
    known = F.create_map(*[F.lit(x) for pair in sentences.items() for x in pair])
    found = docs.select(column(doc_id).alias("doc_id"), F.transform(cut, normalised).alias("pieces"))
    named = found.select("doc_id", F.transform("pieces", lambda s: F.coalesce(F.element_at(known, s), F.lit(UNKNOWN))).alias("ids"))
    return named.select(
        "doc_id", F.col("ids").alias("sentence_ids"),
        F.when(F.size("ids") > 0, matched(F.col("ids"), rules)).otherwise(nothing).alias("licenses"),
    )


def _in_sql(text: str, steps: Sequence[tuple[str, str]]) -> str:
    for pattern, new in steps:
        text = f"regexp_replace({text}, '{pattern}', '{new.replace('$', chr(92))}', 'g')"
    return text


def oracle(sentences: Mapping[str, str] = SENTENCES, rules: Sequence[tuple[str, str]] = RULES) -> str:
    """The same scan in SQL."""
    known = ", ".join(f"('{s}', '{k}')" for s, k in sentences.items())
    steps = "named0 AS (SELECT doc_id, n, ids, '| ' || ids || ' |' AS rest, [] :: VARCHAR[] AS names FROM joined)"
    for k, (name, sequence) in enumerate(rules):
        again = f"replace(replace(rest, ' {sequence} ', ' | '), ' {sequence} ', ' | ')"
        steps += f""",
     named{k + 1} AS (SELECT doc_id, n, ids, {again} AS rest,
        CASE WHEN contains(rest, ' {sequence} ') AND NOT list_contains(names, '{name}') THEN list_append(names, '{name}') ELSE names END AS names
        FROM named{k})"""
    return f"""
WITH known(s, id) AS (VALUES {known}),
     cut AS (SELECT doc_id, row_number() OVER () AS r, CASE WHEN regexp_matches(text, '(?i:{CRITICAL})')
                    THEN string_split({_in_sql("chr(10) || text", BREAKS)}, '{_END}') ELSE [] END AS parts FROM documents),
     each AS (SELECT r, unnest(range(1, len(parts) + 1)) AS i, unnest(parts) AS s FROM cut),
     found AS (SELECT r, i, {_in_sql("lower(s)", [*CLEAN, *VARIABLE])} AS s FROM each WHERE regexp_matches(s, '(?i:{CRITICAL})')),
     listed AS (SELECT r, string_agg(coalesce(id, '{UNKNOWN}'), ' ' ORDER BY i) AS ids, count(*) AS n FROM found LEFT JOIN known USING (s) GROUP BY r),
     joined AS (SELECT doc_id, r, coalesce(ids, '') AS ids, coalesce(n, 0) AS n FROM cut LEFT JOIN listed USING (r)),
     {steps}
SELECT doc_id, n::BIGINT AS n_sentences, ids AS sentence_ids, array_to_string(names, ' AND ') AS licenses FROM named{len(rules)}"""
