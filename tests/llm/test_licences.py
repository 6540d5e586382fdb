from windrow.llm import licences

APACHE, MIT = "Licensed under the Apache License, Version 2.0.", "Released under the MIT License."


def scanned(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "path string, text string, licence string, similarity int")
    return {(r.path, r.licence, r.declared_by, r.inherited) for r in licences.scan(df, "path", "text").collect()}


def test_nearest_directory_wins(spark):
    rows = [
        ("LICENSE", APACHE),
        ("a/x.py", "code"),
        ("a/b/LICENSE.txt", MIT),
        ("a/b/c/y.py", "code"),
        ("a/b/c/z.py", "# " + APACHE + "\ncode"),
        ("a/b/c/d/w.py", ""),
        ("ab/v.py", None),
        (None, APACHE),
        (None, None),
        ("a/x.py", "code"),
    ]
    assert scanned(spark, rows) == {
        ("LICENSE", "Apache-2.0", "LICENSE", False),
        ("a/x.py", "Apache-2.0", "LICENSE", True),
        ("a/b/LICENSE.txt", "MIT", "a/b/LICENSE.txt", False),
        ("a/b/c/y.py", "Apache-2.0", "a/b/c/z.py", True),
        ("a/b/c/z.py", "Apache-2.0", "a/b/c/z.py", False),
        ("a/b/c/d/w.py", "Apache-2.0", "a/b/c/z.py", True),
        ("ab/v.py", "Apache-2.0", "LICENSE", True),
        (None, None, None, False),
    }


def test_no_licence_ties_and_empty(spark):
    assert scanned(spark, [("a/b", "license"), ("c", "the version of this work")]) == {
        ("a/b", None, None, False),
        ("c", None, None, False),
    }
    # Two in one directory: the more similar, then the smaller path, declares for it.
    rows = [("d/b", MIT), ("d/a", MIT), ("d/e/f", "x" * 50_000 + "\n" + MIT + " now"), ("d/g", "x")]
    assert ("d/g", "MIT", "d/a", True) in scanned(spark, rows)
    df = spark.createDataFrame([], "path string, text string")
    assert licences.scan(df, "path", "text").collect() == []


def test_deciding_terms_lose_nothing():
    """Whatever is near a template has one of its deciding terms."""
    known = licences.Templates(licences.TEMPLATES, licences.LEAST)
    for name in licences.TEMPLATES:
        others = sum(share**2 for n, t, share in known.rows if n == name and t not in known.deciding)
        assert others < licences.LEAST**2


def test_no_python_on_the_path(spark, sf):
    from windrow.llm import queries

    plan = queries.op4_licences(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not [w for w in ("Python", "Pandas", "InArrow", "Cartesian") if w in plan]


def test_headers_that_are_no_copies_of_the_templates(spark):
    """Tags, titles, notices and headers within longer lines or over several."""
    gpl = "# {} it under the terms of the GNU {}General Public License as\n# published by the Free Software Foundation; either version {} of\n# the License"
    cases = {
        "// SPDX-License-Identifier: MIT": "MIT",
        "/* SPDX-License-Identifier: Apache-2.0 */": "Apache-2.0",
        "# SPDX-License-Identifier: GPL-2.0-or-later": "GPL-2.0",
        "# SPDX-License-Identifier: (MIT OR GPL-2.0-only)": "(MIT OR GPL-2.0)",
        "All rights reserved.": "Proprietary",
        "Copyright (c) 2020 Some Firm, Inc. All rights reserved.": "Proprietary",
        "Copyright 2020 Some Firm. All rights reserved.\n\n" + MIT: "MIT",
        "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0",
        "Licensed under CC BY 4.0.": "CC-BY-4.0",
        "  GNU LESSER GENERAL PUBLIC LICENSE\n   Version 2.1, February 1999": "LGPL-2.1",
        "  GNU LESSER GENERAL PUBLIC LICENSE": "LGPL",
        "  GNU GENERAL PUBLIC LICENSE\n   Version 2, June 1991\n\n text": "GPL-2.0",
        "  GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007": "GPL-3.0",
        "GNU GENERAL PUBLIC LICENSE": "GPL",
        gpl.format("redistribute", "", "2"): "GPL-2.0",
        gpl.format("modify", "Affero ", "3"): "AGPL-3.0",
        "some words " * 30 + APACHE + " more words" * 30: "Apache-2.0",
        "The text so far. " * 20 + "This is released under the MIT License. And on.": "MIT",
        "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted": "ISC",
        "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that "
        "the following conditions\nare met:": "BSD-2-Clause",
        "all the rights of words and a version of the general public": None,
    }
    rows = [(f"d{i}/x", text) for i, text in enumerate(cases)]
    got = {path: licence for path, licence, _, _ in scanned(spark, rows)}
    assert {text: got[f"d{i}/x"] for i, text in enumerate(cases)} == cases


def test_one_table_is_written_on_the_way(spark, monkeypatch):
    """Each file that a task writes costs the executor processes of the file system."""
    written, keep = [], licences.materialise
    monkeypatch.setattr(licences, "materialise", lambda df, name: written.append(name) or keep(df, name))
    files = spark.createDataFrame([("a/LICENSE", "Released under the MIT License."), ("a/b/x", "x")], "path string, text string")
    got = {r.path: (r.licence, r.inherited) for r in licences.scan(files, "path", "text").collect()}
    assert got == {"a/LICENSE": ("MIT", False), "a/b/x": ("MIT", True)} and written == ["licences"]
