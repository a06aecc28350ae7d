"""Licence texts as they stand in files: wrapped at usual widths, in comments, with list numbers."""

import textwrap
import time

import duckdb
import pandas as pd
import pytest

from lotmill.llm import licenses

GPL = """This program is free software{a} you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation{b} {c}version {v} of the License{d}

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU General Public License for more details."""
LATER = ", or (at your option) any later version."
MIT = """MIT License

Copyright (c) 2019 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
APACHE = """Copyright 2019 Somebody

Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
TEXTS = {
    "GPL-3.0-or-later": GPL.format(a=":", b=",", c="either ", v=3, d=LATER),
    "GPL-2.0-or-later": GPL.format(a=";", b=";", c="either ", v=2, d=LATER),
    "GPL-2.0-only": GPL.format(a=";", b=";", c="", v=2, d="."),
    "MIT": MIT,
    "Apache-2.0": APACHE,
    "BSD-2-Clause": BSD_2,
}


def wrapped(text, width):
    return "\n\n".join(textwrap.fill(part, width, break_long_words=False, break_on_hyphens=False) for part in text.split("\n\n"))


def variants(text):
    yield text
    yield text.replace("\n\n", "\n")
    for width in (30, 50, 60, 64, 72, 76, 80, 100):
        plain = wrapped(text, width)
        yield plain
        yield "/*\n" + "".join(f" * {line}\n" for line in plain.split("\n")) + " */\nint x;\n"
        yield "".join(f"# {line}".rstrip() + "\r\n" for line in plain.split("\n"))


def found(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    by = {k: set() for k in range(len(texts))}
    for r in licenses.licenses(docs).collect():
        by[r["doc_id"]].add(r["license"])
    return by


@pytest.mark.parametrize("name", list(TEXTS))
def test_whole_notice_in_any_wrapping(spark, name):
    texts = list(variants(TEXTS[name]))
    assert {k: v for k, v in found(spark, texts).items() if v != {name}} == {}


def test_lines_without_stops(spark):
    texts = [
        "Licensed under CC BY 4.0\nContact Somebody",
        "Some Heading\nLicensed under CC BY 4.0\n\nText",
        "Copyright (c) 2020 Somebody\nAll rights reserved\nMore words",
        "This work is\nlicensed under the GNU\nGeneral Public License,\nversion 3.",
        BSD_2.replace("\n\n", " ") + " Words.",
        BSD_2.replace("2. ", "Something else. 2. "),
        "=====\n" + BSD_2.replace("\n\n", "\n-----\n\n"),
    ]
    got = found(spark, texts)
    want = [{"CC-BY-4.0"}, {"CC-BY-4.0"}, {"Proprietary"}, {"GPL-3.0-only"}, {"BSD-2-Clause"}, set(), {"BSD-2-Clause"}]
    assert [got[k] for k in range(len(texts))] == want


HEAD = "Copyright (c) 2019 Somebody\nAll rights reserved.\n\n"
BSD_3 = BSD_2 + """

3. Neither the name of {} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
BSD_4 = BSD_2 + "\n\n3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by Somebody."
GNU_3 = GPL.format(a=":", b=",", c="either ", v=3, d=LATER)
FAMILIES = {
    "BSD-3-Clause": [BSD_3.format("the copyright holder"), BSD_3.format("Somebody Inc."), BSD_3.format("the University").replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* ")],
    "BSD-4-Clause": [BSD_4],
    "AGPL-3.0-or-later": [GNU_3.replace("GNU General", "GNU Affero General")],
    "LGPL-3.0-or-later": [GNU_3.replace("GNU General", "GNU Lesser General")],
    "LGPL-2.1-or-later": [GPL.format(a=";", b=";", c="either ", v=2.1, d=LATER).replace("GNU General", "GNU Lesser General").replace("program", "library")],
    "LGPL-3.0-only": ["GNU LESSER GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n\nCopyright (C) 2007 Somebody"],
    "AGPL-3.0-only": ["This work is licensed under the GNU Affero General Public License v3."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one.", "Licensed under the Mozilla Public License, version 2.0."],
    "MPL-1.1": ['The contents of this file are subject to the Mozilla Public License Version 1.1 (the "License"); you may not use this file except in compliance with the License.'],
    "EPL-2.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v. 2.0 which is available at http://www.eclipse.org/legal/epl-2.0.",
    ],
    "EPL-1.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution."],
}


@pytest.mark.parametrize("name", list(FAMILIES))
def test_more_families_in_any_wrapping(spark, name):
    texts = [x for text in FAMILIES[name] for x in variants(text)]
    assert {k: v for k, v in found(spark, texts).items() if v != {name}} == {}


def test_a_reservation_beside_a_licence_text_is_not_proprietary(spark):
    texts = [HEAD + x for x in (MIT, APACHE, BSD_2, FAMILIES["BSD-3-Clause"][0], GNU_3, "Words.", "MOZILLA PUBLIC LICENSE\nVersion 1.1\n")]
    got = found(spark, texts)
    want = ["MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-3.0-or-later", "Proprietary", "MPL-1.1"]
    assert [got[k] for k in range(len(texts))] == [{x} for x in want]


@pytest.mark.parametrize("piece", [" ", "\t", "-", "\n", " \n", "* ", ". ", "a\n", "(c) 2020\n", "1. "])
def test_a_megabyte_of_one_piece_takes_seconds(spark, piece):
    """Padding is gone through once; the notice behind it is found."""
    text = piece * (1_000_000 // len(piece)) + "\n\nReleased under the MIT License."
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    start = time.perf_counter()
    found = licenses.licenses(docs).collect()
    assert time.perf_counter() - start < 30
    assert any(r["license"] == "MIT" for r in found)


TAGS = {
    "// SPDX-License-Identifier: MIT\nint x;": {"MIT"},
    "/* SPDX-License-Identifier: (GPL-2.0+ WITH Classpath-exception-2.0 OR MIT) */\nx": {"GPL-2.0-or-later", "MIT"},
    "# SPDX-License-Identifier: Apache-2.0 AND LGPL-2.1-or-later\n# more": {"Apache-2.0", "LGPL-2.1-or-later"},
    "<!-- SPDX-License-Identifier: GPL-2.0-only -->": {"GPL-2.0-only"},
    "SPDX-License-Identifier: GPL-2.0.": {"GPL-2.0-only"},
    "SPDX-License-Identifier: Nothing-1.0 or Zlib": {"Zlib"},
    "Words before SPDX-License-Identifier: BSL-1.0 and words after it": {"BSL-1.0"},
    "SPDX-License-Identifier: GPL-3.0-or-later\r\nSPDX-License-Identifier: ISC\r\n": {"GPL-3.0-or-later", "ISC"},
    "SPDX-License-Identifier:" + " " * 50: set(),
    "SPDX-License-Identifier:\nMIT": set(),
    HEAD + "SPDX-License-Identifier: MIT\n": {"MIT"},
    "MIT": set(),
}
CLAUSES = {
    "Released under the MIT License, see the file.": {"MIT"},
    "Licensed under the GNU General Public License, version 3, which is in COPYING.": {"GPL-3.0-only"},
    "Licensed under the GNU General Public License, version 3 or later, see the file.": {"GPL-3.0-or-later"},
    "This project is licensed under the Apache License, Version 2.0 - see the file.": {"Apache-2.0"},
    "Released under the MIT Licensee.": set(),
}


@pytest.mark.parametrize("cases", [TAGS, CLAUSES], ids=["tags", "clauses"])
def test_tags_and_clauses_behind_a_name(spark, cases):
    got = found(spark, list(cases))
    assert [got[k] for k in range(len(cases))] == list(cases.values())


def test_sentences_are_known_once():
    assert len({x for _, x in licenses.KNOWN}) == len(licenses.KNOWN)


def test_sql_gives_the_same_rows_on_notices_in_any_wrapping(spark):
    notices = [*TEXTS.values(), *(x for own in FAMILIES.values() for x in own)]
    texts = [x for text in notices for x in variants(text)]
    texts += [HEAD + x for x in notices] + [*TAGS, *CLAUSES, "", " \n"]
    columns = ["doc_id", "license", "rule", "n_sentences"]
    db = duckdb.connect()
    db.register("documents", pd.DataFrame({"doc_id": range(len(texts)), "text": texts}))
    want = sorted(db.sql(f"SELECT {', '.join(columns)} FROM ({licenses.duck_sql()})").fetchall())
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = sorted(tuple(r) for r in licenses.licenses(docs).select(*columns).collect())
    assert len(want) > len(texts) // 2 and got == want


@pytest.mark.parametrize("piece", ["SPDX-License-Identifier: ", "SPDX-License-Identifier: MIT OR ", "SPDX-License-Identifier: ((", "SPDX-License-Identifier:" + " " * 100_000 + "\n"])
def test_a_megabyte_of_tags_takes_seconds(spark, piece):
    docs = spark.createDataFrame([(1, piece * (1_000_000 // len(piece)))], "doc_id long, text string")
    start = time.perf_counter()
    licenses.licenses(docs).collect()
    assert time.perf_counter() - start < 30
