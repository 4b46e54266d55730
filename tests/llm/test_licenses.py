"""Licence scan against a plain version."""

import re
from collections import Counter
from math import log, sqrt

from pyspark.sql import functions as F

from threadsift.llm import licenses
from threadsift.llm.queries import QUERIES

APACHE, MIT, GPL = (licenses.TEMPLATES[n] for n in ("Apache-2.0", "MIT", "GPL-3.0"))


def terms(text):
    return re.findall(r"[^\W_]+(?:[.-][^\W_]+)*", text.lower())


def brute_own(text, licence_file):
    vectors = {n: Counter(terms(t)) for n, t in licenses.TEMPLATES.items()}
    seen = Counter(t for v in vectors.values() for t in v)
    idf = {t: log(1 + len(vectors) / n) for t, n in seen.items()}
    lines = [x for x in re.split(r"[\r\n]+", text or "") if re.search(licenses.SPEAKS, x)]
    if licence_file and text is not None:
        lines.append(text)
    best = (0, None)
    for line in lines:
        w = {t: n * idf.get(t, log(1 + len(vectors))) for t, n in Counter(terms(line)).items()}
        size = sqrt(sum(x * x for x in w.values()))
        for name, v in sorted(vectors.items()):
            weight = {t: n * idf[t] for t, n in v.items()}
            dot = sum(x * weight.get(t, 0) for t, x in w.items())
            cosine = round(dot / size / sqrt(sum(x * x for x in weight.values())), 9) if dot else 0
            if cosine >= licenses.THRESHOLD and cosine > best[0]:
                best = (cosine, name)
    return best[1]


def brute(rows):
    own = [brute_own(t, bool(p and re.search(licenses.LICENCE_FILE, p.split("/")[-1]))) for _, t, p in rows]
    folders = {}
    for (_, _, p), licence in zip(rows, own):
        if p and licence and re.search(licenses.LICENCE_FILE, p.split("/")[-1]):
            folders.setdefault("/".join(p.split("/")[:-1]), licence)
    out = []
    for (i, _, p), licence in zip(rows, own):
        origin = "own" if licence else None
        if not licence and p is not None:
            for depth in range(p.count("/"), -1, -1):
                above = folders.get("/".join(p.split("/")[:depth]))
                if above:
                    licence, origin = above, "inherited"
                    break
        out.append((i, p, licence, origin))
    return sorted(out, key=repr)


ROWS = [
    (1, APACHE + "\nwords", "a/LICENSE"), (2, "no header", "a/b/c.txt"), (3, "x\n// " + MIT + "\ny", "a/b/d.txt"),
    (4, GPL, "a/b/COPYING.md"), (5, "deep", "a/b/c/d/e.txt"), (6, "lone", "z/q.txt"), (7, None, "a/f.txt"), (8, "", "a/f.txt"),
    (9, "a licence to speak of nothing at all here, with many other words around it", "z/r.txt"), (10, "no path", None),
    (11, "root", "r.txt"), (3, MIT, "a/b/g.txt"), (None, "x", "a/b/h.txt"), (12, "word " * 50_000 + "\n" + MIT, "z/long.txt"),
]


def test_equals_a_plain_version(spark):
    frame = spark.createDataFrame(ROWS, "doc_id long, text string, p string").withColumn("k", F.lit(1)).withColumn("licence", F.lit("x"))
    got = licenses.scan(frame, F.col("p")).select("doc_id", "path", "licence", "origin").collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(ROWS)


def test_given_documents_and_empty_table(spark, documents):
    rows = QUERIES["op9_license_scan"](spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        if "MIT License." in texts[r.doc_id]:
            assert r.licence == "MIT" and r.origin == "own"
    assert licenses.scan(documents([]), licenses.document_paths()).collect() == []


MIT_TEXT = """Copyright (c) 2024 Ann Lee and others

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
BSD_FIRST = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
"""
BSD_TWO = BSD_FIRST + """
1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_THREE = BSD_TWO + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
GNU = """ * This file is part of Foo.
 *
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU {}General Public License as published by
 * the Free Software Foundation, either version {} of the License, or
 * (at your option) any later version.
 *
"""
REAL = [
    ("MIT License", "MIT"),
    ("x\n# Licensed under the MIT license.\ny", "MIT"),
    ("// SPDX-License-Identifier: MIT\nint x;", "MIT"),
    ("# SPDX-License-Identifier: Apache-2.0", "Apache-2.0"),
    ("/* SPDX-License-Identifier: GPL-2.0-only */", "GPL-2.0"),
    (MIT_TEXT, "MIT"),
    ("Copyright 2024 Foo\n" + BSD_FIRST, "BSD-3-Clause"),
    ("Copyright (c) 2024, Foo\n\n" + BSD_TWO, "BSD-2-Clause"),
    ("Copyright (c) 2024, Foo\n\n" + BSD_THREE, "BSD-3-Clause"),
    (GNU.format("", 3), "GPL-3.0"),
    (GNU.format("", 2), "GPL-2.0"),
    (GNU.format("Lesser ", 3), "LGPL-3.0"),
    (GNU.format("Affero ", 3), "AGPL-3.0"),
    ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation", "GPL-3.0"),
    ("                    GNU GENERAL PUBLIC LICENSE\r\n                       Version 2, June 1991\r\n", "GPL-2.0"),
    ("                  Apache License\n            Version 2.0, January 2004\n       http://www.apache.org/licenses/\n", "Apache-2.0"),
    ('# Copyright 2024 Foo Bar Inc.\n#\n# Licensed under the Apache License, Version 2.0 (the "License");\n# you may not use this file except in compliance with the License.\n# You may obtain a copy of the License at\n#\n', "Apache-2.0"),
    ("/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this\n * file, You can obtain one at https://mozilla.org/MPL/2.0/. */", "MPL-2.0"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0\nInternational License.", "CC-BY-SA-4.0"),
    ("This work is licensed under the GNU General\nPublic License, version 3.", "GPL-3.0"),
    ("GNU General Public License", None),
    ("# SPDX-License-Identifier: Foo-1.0", None),
    ("Licensed under the Foo License.", None),
    ("Licensed under the Apache License, Version 1.1", None),
    ("Copyright (c) 2020 MIT", None),
    ("All rights reserved.", None),
    ("The driving licence of the GNU was lost under the bridge of the river.", None),
]


def test_real_headers_and_licence_files(spark):
    rows = [(i, t, f"d{i}/a.c") for i, (t, _) in enumerate(REAL)] + [(100 + i, t, f"f{i}/LICENSE") for i, (t, _) in enumerate(REAL)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, p string")
    got = {r.doc_id: r.licence for r in licenses.scan(frame, F.col("p")).collect()}
    assert got == {i + n: licence for i, (_, licence) in enumerate(REAL) for n in (0, 100)}
