"""License scans by sentence rules, in DataFrame expressions only.

A text is cut into sentences; each is normalised and looked up in a fixed list of known licence sentences; the
identifiers that remain, in order, are matched against rules. A sentence ends at a mark, a line break or, where the lines
joined are a known sentence, some lines later. A rule is a sequence of identifiers that must follow each other without
another known sentence between them; the longest rule at a place wins.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# FIXED VALUES: known sentences as (identifier, normal form): lower case, words of letters and digits, one space.
SENTENCES = (
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "this work is licensed under cc by nc 4 0"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl-2", "licensed under the gnu general public license version 2"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2-grant", "you may not use this file except in compliance with the license"),
    ("apache-2-copy", "you may obtain a copy of the license at"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("as-is", "the software is provided as is without warranty of any kind"),
    ("reserved", "all rights reserved"),
    ("bsd-grant", "redistribution and use in source and binary forms with or without modification are permitted"),
)
# FIXED VALUES: rules as (licence, sentence identifiers in order).
RULES = (
    ("Apache-2.0", ("apache-2", "apache-2-grant", "apache-2-copy")),
    ("Apache-2.0", ("apache-2", "apache-2-grant")),
    ("Apache-2.0", ("apache-2",)),
    ("BSD-style", ("reserved", "bsd-grant")),
    ("BSD-style", ("bsd-grant",)),
    ("CC-BY-4.0", ("cc-by",)),
    ("CC-BY-NC-4.0", ("cc-by-nc",)),
    ("CC-BY-SA-4.0", ("cc-by-sa",)),
    ("GPL-2.0", ("gpl-2",)),
    ("GPL-3.0", ("gpl-3",)),
    ("MIT", ("mit", "mit-grant", "as-is")),
    ("MIT", ("mit-grant", "as-is")),
    ("MIT", ("mit",)),
    ("Proprietary", ("reserved",)),
)



def normal(sentence: str) -> str:
    """The normal form of a sentence written out."""
    return re.sub("[^0-9a-z\x80-\U0010ffff]+", " ", re.sub("[A-Z]", lambda m: m[0].lower(), sentence)).strip(" ")


def _gnu() -> list[tuple[str, str]]:
    """Notices of the GNU licences."""
    out = []
    for what, name, versions in (("GNU General Public License", "gpl", ("2", "3")),
                                 ("GNU Lesser General Public License", "lgpl", ("2.1", "3")),
                                 ("GNU Library General Public License", "lgpl", ("2",)),
                                 ("GNU Affero General Public License", "agpl", ("3",))):
        for it in ("program", "library", "software", "file"):
            for v in versions:
                free = f"This {it} is free software: you can redistribute it and/or modify it under the terms of the {what}"
                out += [(f"{name}-{v}-header", free + end) for end in (
                    f" as published by the Free Software Foundation, either version {v} of the License, or (at your option) any later version",
                    f" as published by the Free Software Foundation, version {v} of the License",
                    f" as published by the Free Software Foundation, version {v}",
                    f" version {v} as published by the Free Software Foundation",
                    f", version {v}, or (at your option) any later version, as published by the Free Software Foundation")]
            out.append((f"{name}-copy", f"You should have received a copy of the {what} along with this {it}"))
        out.append((f"{name}-details", f"See the {what} for more details"))
    out += [("gnu-warranty", f"This {it} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
             "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE") for it in ("program", "library", "software", "file")]
    return out + [
        ("gpl-2-header", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
        ("gpl-3-header", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
        ("lgpl-2-header", "GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June 1991"),
        ("lgpl-2.1-header", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
        ("lgpl-3-header", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
        ("agpl-3-header", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007")]


def _creative_commons() -> list[tuple[str, str]]:
    out = []
    for kind, words in (("by", "Attribution"), ("by-sa", "Attribution-ShareAlike"), ("by-nc", "Attribution-NonCommercial"),
                        ("by-nd", "Attribution-NoDerivatives"), ("by-nc-sa", "Attribution-NonCommercial-ShareAlike"),
                        ("by-nc-nd", "Attribution-NonCommercial-NoDerivatives")):
        name = f"cc-{kind}-header"
        out += [(name, f"{words} 4.0 International"), (name, f"Creative Commons {words} 4.0 International Public License"),
                (name, f"Creative Commons {words} 4.0 International"),
                (name, f"To view a copy of this license, visit http://creativecommons.org/licenses/{kind}/4.0/"),
                (name, f"To view a copy of this license, visit https://creativecommons.org/licenses/{kind}/4.0/")]
        out += [(name, f"{start}icensed under {a} Creative Commons {words} 4.0 International License{end}")
                for start in ("This work is l", "L") for a in ("a", "the") for end in ("", f" (CC {kind} 4.0)")]
    return out


_AS_IS = ("is provided by {} \"as is\" and any express or implied warranties, including, but not limited to, the implied "
          "warranties of merchantability and fitness for a particular purpose are disclaimed")
_DAMAGES = ("in no event shall {} be liable for any direct, indirect, incidental, special, exemplary, or consequential damages "
            "(including, but not limited to, procurement of substitute goods or services; loss of use, data, or profits; or "
            "business interruption) however caused and on any theory of liability, whether in contract, strict liability, or "
            "tort (including negligence or otherwise) arising in any way out of the use of this software, even if advised of "
            "the possibility of such damage")
_NAMES = "may be used to endorse or promote products derived from this software without specific prior written permission"
_SPDX = {"mit": ("MIT",), "apache-2": ("Apache-2.0",), "gpl-2": ("GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-2.0 WITH Linux-syscall-note"),
         "gpl-3": ("GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"), "cc-by": ("CC-BY-4.0",), "cc-by-sa": ("CC-BY-SA-4.0",),
         "cc-by-nc": ("CC-BY-NC-4.0",), "cc-by-nd-header": ("CC-BY-ND-4.0",), "cc-by-nc-sa-header": ("CC-BY-NC-SA-4.0",),
         "cc-by-nc-nd-header": ("CC-BY-NC-ND-4.0",), "lgpl-2-header": ("LGPL-2.0", "LGPL-2.0-only", "LGPL-2.0-or-later"),
         "lgpl-2.1-header": ("LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later"),
         "lgpl-3-header": ("LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later"),
         "agpl-3-header": ("AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later"), "mpl-2-header": ("MPL-2.0",),
         "bsd-2": ("BSD-2-Clause",), "bsd-3": ("BSD-3-Clause",), "bsd-4": ("BSD-4-Clause",)}

# FIXED VALUES: sentences of the standard licence texts and notices, as in SENTENCES. The SQL twin knows SENTENCES only.
STANDARD_SENTENCES = tuple((i, normal(x)) for i, x in [
    ("mit-title", "MIT License"), ("mit-title", "The MIT License"), ("mit-title", "The MIT License (MIT)"),
    ("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                 "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
                 "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
                 "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("mit-notice", "The above copyright notice and this permission notice shall be included in all copies or substantial "
                   "portions of the Software"),
    ("mit-as-is", "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited "
                  "to the warranties of merchantability, fitness for a particular purpose and noninfringement"),
    ("mit-liability", "In no event shall the authors or copyright holders be liable for any claim, damages or other liability, "
                      "whether in an action of contract, tort or otherwise, arising from, out of or in connection with the "
                      "software or the use or other dealings in the software"),
    ("bsd-text", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                 "the following conditions are met"),
    ("bsd-source", "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
                   "following disclaimer"),
    ("bsd-binary", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
                   "following disclaimer in the documentation and/or other materials provided with the distribution"),
    ("bsd-advert", "All advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("bsd-names", f"Neither the name of the copyright holder nor the names of its contributors {_NAMES}"),
    ("bsd-names", f"nor the names of its contributors {_NAMES}"),
    ("bsd-names", "The name of the author may not be used to endorse or promote products derived from this software without "
                  "specific prior written permission"),
    *[("bsd-as-is", f"This software {_AS_IS.format(x)}") for x in (
        "the copyright holders and contributors", "the copyright holder and contributors", "the author", "the author and contributors",
        "the regents and contributors")],
    *[("bsd-liability", _DAMAGES.format(x)) for x in (
        "the copyright holder or contributors", "the copyright owner or contributors", "the copyright holders or contributors",
        "the author", "the author or contributors", "the regents or contributors")],
    *[("apache-2-header", f"{x} under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
       "compliance with the License") for x in ("Licensed", "The ASF licenses this file to You")],
    ("apache-2-header", "Apache License Version 2.0, January 2004"),
    *[("apache-2-header", f"Apache License Version 2.0, January 2004 {x}://www.apache.org/licenses/") for x in ("http", "https")],
    ("asf-agreements", "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements"),
    ("asf-notice", "See the NOTICE file distributed with this work for additional information regarding copyright ownership"),
    *[("apache-2-copy", f"You may obtain a copy of the License at {x}://www.apache.org/licenses/LICENSE-2.0") for x in ("http", "https")],
    ("apache-2-basis", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                       "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"),
    ("apache-2-see", "See the License for the specific language governing permissions and limitations under the License"),
    # "v. 2.0" ends a sentence after "v"; only version 2.0 speaks of a Source Code Form.
    ("mpl-2-header", "This Source Code Form is subject to the terms of the Mozilla Public License, v"),
    ("mpl-2-header", "Mozilla Public License Version 2.0"),
    *[("mpl-2-copy", f"If a copy of the MPL was not distributed with this file, You can obtain one at {x}mozilla.org/MPL/2.0/")
      for x in ("http://", "https://")],
    *_gnu(), *_creative_commons(),
    *[(i, f"SPDX-License-Identifier: {x}") for i, names in _SPDX.items() for x in names],
])
_HEADERS = (
    ("MIT", ("mit-text",)), ("MIT", ("mit-title",)), ("MIT", ("mit-title", "mit-text")), ("Apache-2.0", ("apache-2-header",)),
    ("BSD-style", ("bsd-text",)),
    ("BSD-2-Clause", ("bsd-text", "bsd-source", "bsd-binary", "bsd-as-is")),
    ("BSD-3-Clause", ("bsd-text", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-4-Clause", ("bsd-text", "bsd-source", "bsd-binary", "bsd-advert")),
    ("BSD-2-Clause", ("bsd-2",)), ("BSD-3-Clause", ("bsd-3",)), ("BSD-4-Clause", ("bsd-4",)),
    ("GPL-2.0", ("gpl-2-header",)), ("GPL-3.0", ("gpl-3-header",)), ("LGPL-2.0", ("lgpl-2-header",)),
    ("LGPL-2.1", ("lgpl-2.1-header",)), ("LGPL-3.0", ("lgpl-3-header",)), ("AGPL-3.0", ("agpl-3-header",)),
    ("MPL-2.0", ("mpl-2-header",)), ("CC-BY-4.0", ("cc-by-header",)), ("CC-BY-SA-4.0", ("cc-by-sa-header",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-header",)), ("CC-BY-ND-4.0", ("cc-by-nd-header",)),
    ("CC-BY-NC-SA-4.0", ("cc-by-nc-sa-header",)), ("CC-BY-NC-ND-4.0", ("cc-by-nc-nd-header",)),
)
# FIXED VALUES: rules for them. "All rights reserved" in front of a licence belongs to its copyright line.
STANDARD_RULES = (*_HEADERS, *((name, ("reserved", *ids)) for name, ids in _HEADERS))
KNOWN = SENTENCES + STANDARD_SENTENCES
ALL_RULES = RULES + STANDARD_RULES

#: Where a sentence ends, lines joined: marks before white space or the end of the text, or a line without letters and digits.
APART = "[.!?](?=[ \t\r\f\n]|$)|\n[^0-9a-z\u0080-\U0010ffff]*\n"
#: What stands between words of a normalised sentence.
BETWEEN = "[^0-9a-z\u0080-\U0010ffff]+"


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _normalised(parts: Column) -> Column:
    each = F.transform(parts, lambda s: F.trim(F.regexp_replace(s, BETWEEN, " ")))
    return F.filter(each, lambda s: s != "")


def _identifiers(lines: Column, known) -> Column:
    """Of normalised lines without an end mark between them: the identifiers of the known sentences, in order, each the
    longest that starts with its line. Other lines give none."""
    names = F.map_from_arrays(F.array(*[F.lit(s) for _, s in known]), F.array(*[F.lit(i) for i, _ in known]))
    starts = F.array(*[F.lit(w) for w in sorted({s.split(" ")[0] for _, s in known})])
    longest = max(s.count(" ") + 1 for _, s in known)  # no sentence has more lines than words
    holder = "neither the name of the copyright holder nor the names of its contributors"

    def named(s: Column) -> Column:
        return F.try_element_at(names, F.when(s.startswith("neither the name of "), F.regexp_replace(
            s, "^neither the name of .*? nor the names of (its|their) contributors", holder)).otherwise(s))

    def able(s: Column) -> Column:  # spares the look-up of nearly all
        return F.array_contains(starts, F.substring_index(s, " ", 1))

    def longest_at(place: Column) -> Column:
        sizes = F.sequence(F.least(F.size(lines) - place + 1, F.lit(longest)), F.lit(1), F.lit(-1))
        each = F.transform(sizes, lambda k: F.struct(k.alias("size"), named(F.array_join(F.slice(lines, place, k), " ")).alias("name")))
        return F.try_element_at(F.filter(each, lambda x: x["name"].isNotNull()), F.lit(1))

    def step(state: Column, place: Column) -> Column:
        here = (place >= state["next"]) & able(F.element_at(lines, place))
        return F.transform(F.array(F.when(here, longest_at(place))), lambda hit: F.when(hit.isNull(), state).otherwise(F.struct(
            (place + hit["size"]).alias("next"), F.concat(state["found"], F.array(hit["name"])).alias("found"))))[0]

    empty = F.struct(F.lit(1).alias("next"), F.array().cast("array<string>").alias("found"))
    many = F.aggregate(F.sequence(F.lit(1), F.size(lines)), empty, step, lambda s: s["found"])
    return F.when(F.size(lines) > 1, many).otherwise(F.filter(F.transform(lines, lambda s: F.when(able(s), named(s))), lambda i: i.isNotNull()))


def known_sentences(docs: DataFrame, known=KNOWN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, identifiers): each row's known sentences in order; identifiers is empty where there is none.

    The look-up is a map of the fixed list, so no sentence leaves its task.
    """
    parts = F.split(_lower(F.col(text_col)), APART)
    found = F.flatten(F.transform(parts, lambda part: F.transform(
        F.array(_normalised(F.split(part, "\n"))), lambda lines: _identifiers(lines, known))[0]))
    return docs.select(F.col(id_col), F.coalesce(found, F.array().cast("array<string>")).alias("identifiers"))


def match(identifiers: Column, rules=ALL_RULES) -> Column:
    """The licences whose rules an identifier sequence meets, in order: at each place the longest rule, then on."""
    ordered = sorted(rules, key=lambda r: (-len(r[1]), r[0]))
    empty = F.struct(F.lit(1).alias("next"), F.array().cast("array<string>").alias("found"))

    def step(state: Column, place: Column) -> Column:
        licence = F.coalesce(*[
            F.when(F.slice(identifiers, place, len(ids)) == F.array(*[F.lit(i) for i in ids]),
                   F.struct(F.lit(name).alias("name"), F.lit(len(ids)).alias("size"))) for name, ids in ordered])
        taken = F.when(place >= state["next"], licence)
        return F.when(taken.isNull(), state).otherwise(F.struct(
            (place + taken["size"]).alias("next"), F.concat(state["found"], F.array(taken["name"])).alias("found")))

    places = F.when(F.size(identifiers) > 0, F.sequence(F.lit(1), F.size(identifiers)))
    return F.when(F.size(identifiers) > 0, F.aggregate(places, empty, step, lambda s: s["found"])).otherwise(
        F.array().cast("array<string>"))


def scan(docs: DataFrame, known=KNOWN, rules=ALL_RULES, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """(id, n_known, identifiers, n_licenses, licenses) per row of ``docs``.

    identifiers: known sentences in order, comma-joined. licenses: the distinct licences found, sorted, comma-joined.
    Null and empty texts have none. Repeated rows and rows without an id keep a row each. Other columns are ignored.
    An empty table gives no row.
    """
    rows = known_sentences(docs, known, id_col, text_col).select(
        id_col, "identifiers", F.array_sort(F.array_distinct(match(F.col("identifiers"), rules))).alias("found"))
    return rows.select(id_col, F.size("identifiers").cast("long").alias("n_known"),
                       F.array_join("identifiers", ",").alias("identifiers"),
                       F.size("found").cast("long").alias("n_licenses"),
                       F.array_join("found", ",").alias("licenses"))


def oracle() -> str:
    """The scan of ``documents`` as DuckDB SQL, for the short notices of ``SENTENCES`` and ``RULES``."""
    known = ", ".join(f"('{s}', '{i}')" for i, s in SENTENCES)
    ordered = sorted(RULES, key=lambda r: (-len(r[1]), r[0]))
    pattern = "|".join("".join(f"<{i}>" for i in ids) for _, ids in ordered)
    names = " ".join(f"WHEN '{''.join(f'<{i}>' for i in ids)}' THEN '{name}'" for name, ids in ordered)
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH known(sentence, identifier) AS (VALUES {known}),
docs AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
cut AS (SELECT r, regexp_split_to_array({lower}, '\n|[.!?]+([ \t\r\f\n]|$)') AS parts FROM docs),
pieces AS (SELECT r, unnest(parts) AS part, generate_subscripts(parts, 1) AS place FROM cut),
hit AS (SELECT r, place, identifier FROM pieces JOIN known
        ON trim(regexp_replace(part, '[^0-9a-z\\x{{80}}-\\x{{10ffff}}]+', ' ', 'g')) = sentence),
lines AS (SELECT r, count(*) AS n, string_agg(identifier, ',' ORDER BY place) AS ids,
                string_agg('<' || identifier || '>', '' ORDER BY place) AS line FROM hit GROUP BY r),
met AS (SELECT DISTINCT r, CASE m {names} END AS licence
        FROM (SELECT r, unnest(regexp_extract_all(line, '{pattern}')) AS m FROM lines)),
found AS (SELECT r, count(*) AS n, string_agg(licence, ',' ORDER BY licence) AS names FROM met GROUP BY r)
SELECT doc_id, coalesce(lines.n, 0) AS n_known, coalesce(ids, '') AS identifiers,
       coalesce(found.n, 0) AS n_licenses, coalesce(names, '') AS licenses
FROM docs LEFT JOIN lines USING (r) LEFT JOIN found USING (r)"""
