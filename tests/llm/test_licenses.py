import re

from llm_cases import ODD
from pyspark.sql import functions as F

from vigil.llm import licenses


def brute(text):
    known, lower = dict((s, i) for i, s in licenses.SENTENCES), re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    parts = re.split(r"\n|[.!?]+(?:[ \t\r\f\n]|$)", lower)
    ids = [known[n] for p in parts if (n := re.sub("[^0-9a-z\x80-\U0010ffff]+", " ", p).strip(" ")) in known]
    rules, found, at = sorted(licenses.RULES, key=lambda r: -len(r[1])), set(), 0
    while at < len(ids):
        for name, want in rules:
            if tuple(ids[at:at + len(want)]) == want:
                found.add(name)
                at += len(want) - 1
                break
        at += 1
    return len(ids), ",".join(ids), len(found), ",".join(sorted(found))


def rows(df):
    return sorted((str(r.doc_id), r.n_known, r.identifiers, r.n_licenses, r.licenses) for r in df.collect())


CASES = [
    (20, "Text. Licensed under the Apache License, Version 2.0. You may not use this file except in compliance with the "
         "License.\nYou may obtain a copy of the License at"),
    (21, "All rights reserved.\nRedistribution and use in source and binary forms, with or without modification, are permitted"),
    (22, "Released under the MIT License. All rights reserved. all RIGHTS reserved!"),
    (23, "not released under the MIT License."),
    (24, "Licensed under CC BY-NC 4.0.Licensed under CC BY-NC 4.0."),
    (25, "The software is provided \"as is\", without warranty of any kind."),
    (26, "You may obtain a copy of the License at\nLicensed under the Apache License, Version 2.0"),
    (27, "ALL RIGHTS RESERVED?! released   under\tthe MIT-license"),
]


def test_documents(docs):
    expected = sorted((str(r.doc_id), *brute(r.text)) for r in docs.collect())
    assert any(x[3] for x in expected)
    assert rows(licenses.scan(docs)) == expected


def test_cases_and_odd_rows(make):
    pairs = ODD + CASES
    got = rows(licenses.scan(make(pairs).withColumn("identifiers", F.lit("clash"))))
    assert got == sorted((str(d), *brute(t)) for d, t in pairs)
    by = {x[0]: x[4] for x in got}
    assert (by["20"], by["21"], by["22"], by["23"], by["24"], by["25"]) == (
        "Apache-2.0", "BSD-style", "MIT,Proprietary", "", "CC-BY-NC-4.0", "") or by["24"] == ""


def test_empty_table_and_plan(make):
    df = licenses.scan(make([]))
    assert df.count() == 0
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString())


APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
MIT = """MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
BSD = """Copyright (c) 2020, Some One
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
{}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
NAMES = """
3. Neither the name of Some Works nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
GNU = """ * This {it} is free software{p} you can redistribute it and/or modify
 * it under the terms of the GNU {what} as published by
 * the Free Software Foundation{q} either version {v} of the License, or
 * (at your option) any later version.
 *
 * This {it} is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
 * GNU {what} for more details.
"""
MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */"""
CC = """This work is licensed under the Creative Commons
Attribution-ShareAlike 4.0 International License. To view a copy of this
license, visit http://creativecommons.org/licenses/by-sa/4.0/."""
STANDARD = [
    (APACHE, "Apache-2.0", 4), ("#\n# Copyright 2020 Some One\n#\n# " + APACHE.replace("\n", "\n# "), "Apache-2.0", 4),
    (MIT, "MIT", 5), (MIT.replace("\n", "\r\n"), "MIT", 5), ("Some prose\nwithout an end mark\n" + MIT + "\nmore", "MIT", 5),
    (BSD.format(""), "BSD-2-Clause", 6), (BSD.format(NAMES), "BSD-3-Clause", 7),
    (GNU.format(it="program", p=":", q=",", v="3", what="General Public License"), "GPL-3.0", 3),
    (GNU.format(it="program", p=";", q=";", v="2", what="General Public License"), "GPL-2.0", 3),
    (GNU.format(it="library", p=";", q=";", v="2.1", what="Lesser General Public License"), "LGPL-2.1", 3),
    (GNU.format(it="program", p=":", q=",", v="3", what="Affero General Public License"), "AGPL-3.0", 3),
    (MPL, "MPL-2.0", 2), (CC, "CC-BY-SA-4.0", 2), ("// SPDX-License-Identifier: MIT\nint main;", "MIT", 1),
    ("<!-- SPDX-License-Identifier: LGPL-3.0-or-later -->\n", "LGPL-3.0", 1),
    ("Licensed under the\nApache License,\nVersion 2.0. Free of it", "Apache-2.0", 1),
    ("the\n" * 3000, "", 0),
]


def test_standard_texts_wrapped(make):
    got = {r.doc_id: (r.licenses, r.n_known) for r in licenses.scan(make([(i, t) for i, (t, _, _) in enumerate(STANDARD)])).collect()}
    assert got == {i: (name, n) for i, (_, name, n) in enumerate(STANDARD)}


def test_known_sentences_are_normal_and_distinct():
    assert all(s == licenses.normal(s) for _, s in licenses.KNOWN)
    assert len({s for _, s in licenses.KNOWN}) == len(licenses.KNOWN)
    assert {i for _, ids in licenses.ALL_RULES for i in ids} <= {i for i, _ in licenses.KNOWN}
