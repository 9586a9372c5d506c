import pytest
from pyspark.sql import functions as F

from ebbtide.llm import licenses
from tests.llm.cases import TEXTS, rows

APACHE = "Licensed under the Apache License, Version 2.0."
FILES = [
    ("/repo/LICENSE", "Released under the MIT License.\n\nCopyright someone"),
    ("/repo/a.py", "code"),
    ("/repo/src/b.py", f"# {APACHE}\ncode code code code code code code code code code code code code code code code code"),
    ("/repo/src/c.py", "more code"),
    ("/repo/vendor/COPYING", "This work is licensed under the GNU General Public License, version 3.\nmany more words " + "word " * 50),
    ("/repo/vendor/x/y/z.c", None),
    ("/other/d.py", "a license is mentioned here among quite a few other words that say nothing of it at all"),
    ("/repository/e.py", "not below /repo"),
    ("plain.txt", ""),
    (None, "Released under the MIT License."),
    (None, "no path"),
]


@pytest.fixture(scope="module")
def found(spark):
    df = spark.createDataFrame(FILES, "path string, text string")
    return {r.path if r.path else r.own_license: r for r in licenses.scan(df, F.col("path"), "text", ["path"]).collect()}


def test_own_licences(found):
    assert found["/repo/LICENSE"].own_license == "MIT" and found["/repo/LICENSE"].cosine > 0.99
    assert found["/repo/src/b.py"].own_license == "Apache-2.0"
    assert found["/other/d.py"].own_license is None
    assert found["MIT"].origin == "own"


def test_the_nearest_ancestor_speaks(found):
    assert (found["/repo/a.py"].license, found["/repo/a.py"].origin) == ("MIT", "/repo")
    assert (found["/repo/src/c.py"].license, found["/repo/src/c.py"].origin) == ("MIT", "/repo")  # a header speaks for its file alone
    assert (found["/repo/vendor/x/y/z.c"].license, found["/repo/vendor/x/y/z.c"].origin) == ("GPL-3.0", "/repo/vendor")
    for path in ("/other/d.py", "/repository/e.py", "plain.txt"):
        assert (found[path].license, found[path].origin) == (None, None)
    assert found[None].license is None


def test_awkward_rows(messy, empty):
    path = F.concat(F.lit("/"), "source", F.lit("/"), F.col("doc_id").cast("string"))
    scanned = licenses.scan(messy, path, "text", ["doc_id", "license" if "license" in messy.columns else "unit"])
    assert rows(scanned, "doc_id") == sorted([(k,) for k, _ in TEXTS], key=repr)
    own = {r.doc_id: r.own_license for r in scanned.collect()}
    assert own[12] == "MIT" and own[10] is None
    assert licenses.scan(empty, path, "text", ["doc_id"]).collect() == []


PROBES = {
    "SPDX-License-Identifier: MIT": "MIT",
    "// SPDX-License-Identifier: GPL-2.0-only": "GPL-2.0",
    "# SPDX-License-Identifier: AGPL-3.0-or-later": "AGPL-3.0",
    " * SPDX-License-Identifier: BSD-3-Clause": "BSD-3-Clause",
    "Apache License": "Apache-2.0",
    "GNU GENERAL PUBLIC LICENSE": "GPL",
    "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007": "GPL-3.0",
    "BSD 3-Clause License": "BSD-3-Clause",
    "This module does quite a few things that are told below. Licensed under the MIT License. See the manual for all the rest of it, please": "MIT",
    "Copyright (c) someone\n\nPermission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, "
    "provided that the above\ncopyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED AS IS": "ISC",
    "/*\n * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n"
    " * the Free Software Foundation, either version 3 of the License, or\n * (at your option) any later version.\n */\nint main() {}": "GPL-3.0",
    "GNU Affero General Public License, version 3": "AGPL-3.0",
    "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this\n"
    " * file, You can obtain one at https://mozilla.org/MPL/2.0/. */": "MPL-2.0",
    "This is free and unencumbered software released into the public domain.\n\nAnyone is free": "Unlicense",
    "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:": "BSD-2-Clause",
    "the permission of the author is asked for here, and a license may follow some day": None,
    "free software is a topic of this page, like many others": None,
}


def test_licences_as_they_are_found_in_files(spark):
    """Known answers, among files that say nothing of the kind."""
    data = [(f"/p{i}/f", text) for i, text in enumerate(PROBES)] + [(f"/q{i}/f", f"plain words {i} of no matter") for i in range(50)]
    df = spark.createDataFrame(data, "path string, text string")
    found = {r.path: r.own_license for r in licenses.scan(df, F.col("path"), "text", ["path"]).collect()}
    assert {text: found[f"/p{i}/f"] for i, text in enumerate(PROBES)} == PROBES
    assert not any(v for k, v in found.items() if k.startswith("/q"))


def test_every_template_has_an_anchor(spark):
    import re

    assert all(re.search(licenses.ANCHORS, text) for _, text in licenses.TEMPLATES)


def test_repeated_statements_are_weighed_once(spark):
    df = spark.createDataFrame([(f"/d{i % 3}/{i}", APACHE if i % 3 else f"text {i}") for i in range(300)], "path string, text string")
    kinds = {(r.own_license, r.license) for r in licenses.scan(df, F.col("path"), "text", ["path"]).collect()}
    assert kinds == {("Apache-2.0", "Apache-2.0"), (None, None)}


def test_native(messy):
    plan = licenses.scan(messy, F.col("source"), "text", ["doc_id"])._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
