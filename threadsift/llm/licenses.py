"""Licence scan: sparse TF-IDF cosine to templates, then inheritance down the directories.

Every line of a file that speaks of a licence is a header. So is every run of up to RUN
adjacent lines around one, as far as at least half the words of each line are words of the
templates: a notice wrapped over lines is seen whole. The whole text of a file named like a
licence is one more. A template has several forms: SPDX line, short notices, standard header
and the opening or whole of the licence text. Headers and forms become sparse vectors of term
weights, frequency in the text times ln(1 + templates / templates with the term), where a
term in no template weighs as much as one in a single template. A header meets a form that
names numbers (versions) only if it has one of them. A file carries the template of its
header with the greatest cosine, if that reaches `threshold`. A file without a header
of its own inherits from the nearest directory above it that holds a licence file: each
file's ancestors are joined with the directories of licence files, and the deepest counts.

The templates are a short table passed as a parameter; it is sent to every task. All else
is grouped and joined on keys.

Edge cases: null or empty texts have no header. A null path is a file of its own without
directories. A title without its version ('GNU General Public License') names no template.
Ties go to the template of which more forms are found, then to the template, then the path,
that comes first. The first sentence of the BSD licences alone counts as BSD-3-Clause. Of several licence
files in a directory the best match counts. Rows that repeat an id or path are files each;
an empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadsift.llm.common import keyed, materialize

THRESHOLD = 0.75

# How files announce these licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms are permitted under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0, Creative Commons Attribution 4.0 International.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0, Creative Commons Attribution-ShareAlike 4.0 International.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This work is subject to the terms of the Mozilla Public License, version 2.0.",
}
# Names of the licences, the notices made with them, and their own words.
NAMES = {
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0", "GNU AGPL v3", "AGPL-3.0 License"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0 License", "Apache License v2.0", "Apache License"),
    "BSD-2-Clause": ("BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "BSD-2-Clause License"),
    "BSD-3-Clause": ("BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "BSD-3-Clause License"),
    "CC-BY-4.0": ("Creative Commons Attribution 4.0 International License", "Creative Commons Attribution 4.0 International Public License", "CC BY 4.0", "CC BY 4.0 License", "CC-BY-4.0 License"),
    "CC-BY-NC-4.0": ("Creative Commons Attribution-NonCommercial 4.0 International License", "Creative Commons Attribution-NonCommercial 4.0 International Public License", "CC BY-NC 4.0", "CC BY-NC 4.0 License", "CC-BY-NC-4.0 License"),
    "CC-BY-SA-4.0": ("Creative Commons Attribution-ShareAlike 4.0 International License", "Creative Commons Attribution-ShareAlike 4.0 International Public License", "CC BY-SA 4.0", "CC BY-SA 4.0 License", "CC-BY-SA-4.0 License"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL v2", "GNU GPLv2", "GPLv2 License", "GPL-2.0 License"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL v3", "GNU GPLv3", "GPLv3 License", "GPL-3.0 License"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "GNU LGPL v2.1", "LGPL-2.1 License"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0", "GNU LGPL v3", "LGPL-3.0 License"),
    "MIT": ("MIT License", "MIT Licence", "The MIT License (MIT)"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License, v. 2.0", "Mozilla Public License 2.0", "MPL-2.0 License", "MPL 2.0 License"),
}
NOTICES = (
    "{}", "License: {}", "Licensed under the {}.", "Released under the {}.", "Distributed under the {}. See LICENSE for more information.",
    "This project is licensed under the {}.", "This project is licensed under the {} - see the LICENSE file for details.",
    "This work is licensed under the {}.", "This work is licensed under a {}.", "This software is licensed under the terms of the {}.",
    "Use of this source code is governed by the {} that can be found in the LICENSE file.",
)
_GNU = (
    "This program is free software{} you can redistribute it and/or modify it under the terms of the {} as published by the "
    "Free Software Foundation{} either version {} of the License, or (at your option) any later version."
)
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
    'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
    "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
    "Software is furnished to do so, subject to the following conditions:"
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met:"
)
_BSD_SECOND = (
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_THIRD = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission."
)
_CC = "Creative Commons {} 4.0 International Public License"
TEXTS = {
    "AGPL-3.0": ("GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007", _GNU.format(":", "GNU Affero General Public License", ",", 3)),
    "Apache-2.0": (
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        'law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES '
        "OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License.",
        "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE file "
        "distributed with this work for additional information regarding copyright ownership. The ASF licenses this file to You "
        'under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at",
    ),
    "BSD-2-Clause": (_BSD_SECOND, "2. " + _BSD_SECOND),
    "BSD-3-Clause": (_BSD, _BSD_THIRD, "3. " + _BSD_THIRD),
    "CC-BY-4.0": (_CC.format("Attribution"),),
    "CC-BY-NC-4.0": (_CC.format("Attribution-NonCommercial"),),
    "CC-BY-SA-4.0": (_CC.format("Attribution-ShareAlike"),),
    "GPL-2.0": ("GNU GENERAL PUBLIC LICENSE Version 2, June 1991", _GNU.format(";", "GNU General Public License", ";", 2)),
    "GPL-3.0": ("GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", _GNU.format(":", "GNU General Public License", ",", 3)),
    "LGPL-2.1": ("GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999", _GNU.format(";", "GNU Lesser General Public License", ";", 2.1)),
    "LGPL-3.0": ("GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007", _GNU.format(":", "GNU Lesser General Public License", ",", 3)),
    "MIT": (
        _MIT,
        _MIT + " The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
        "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "MPL-2.0": (
        "Mozilla Public License Version 2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
}
SPDX = {name: (name, f"{name}-only", f"{name}-or-later") if "GPL" in name else (name,) for name in NAMES}
#: Lines of the longest run that is compared as one header, besides the whole text of a licence file.
RUN = 12


def all_forms() -> dict[str, tuple[str, ...]]:
    """Every form of every template."""
    out = {}
    for name, names in NAMES.items():
        notices = [n.format(x) for n in NOTICES for x in names]
        ids = [f"SPDX-License-Identifier: {i}" for i in SPDX[name]]
        given = [TEMPLATES[name]] if name in TEMPLATES else []
        out[name] = tuple(dict.fromkeys([*given, *notices, *ids, *TEXTS[name]]))
    return out


SPEAKS = "(?i)licen[sc]e|copyright|spdx|redistribut|public domain|all rights reserved"
LICENCE_FILE = "(?i)^(licen[sc]e|copying|copyright|notice|unlicense)([-._].*)?$"
_TERM = "[\\p{L}\\p{N}]+([.-][\\p{L}\\p{N}]+)*"


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_TERM), 0)


def template_weights(spark, templates: dict[str, str | tuple[str, ...]]) -> DataFrame:
    """template, form, term, weight, idf, numbers: a row for each term of each form, vectors of length 1.

    numbers: whether the form has terms with digits.
    """
    forms = [(name, i, t) for name, texts in sorted(templates.items()) for i, t in enumerate([texts] if isinstance(texts, str) else texts)]
    rows = spark.createDataFrame(forms, "template string, form int, text string")
    rows = rows.select("template", "form", _terms(F.col("text")).alias("terms")).collect()  # the parameter itself
    seen = Counter(t for name in templates for t in {t for r in rows if r["template"] == name for t in r["terms"]})
    idf = {t: log(1 + len(templates) / n) for t, n in seen.items()}
    out = []
    for r in rows:
        weights = {t: n * idf[t] for t, n in Counter(r["terms"]).items()}
        length = sum(w * w for w in weights.values()) ** 0.5
        numbers = any(c.isdigit() for t in weights for c in t)
        out += [(r["template"], r["form"], t, w / length, idf[t], numbers) for t, w in weights.items()]
    return spark.createDataFrame(out, "template string, form int, term string, weight double, idf double, numbers boolean")


def headers(files: DataFrame, words: list[str]) -> DataFrame:
    """k, header (its place), text: lines that speak of a licence, runs of lines around them, whole texts of licence files.

    words: those of the templates.
    """

    def like(line: Column) -> Column:
        terms = _terms(line)
        return (F.size(terms) > 0) & (2 * F.size(F.filter(terms, lambda t: t.isin(words))) >= F.size(terms))

    text = files.filter(F.col("text").rlike(SPEAKS)).select("k", F.split("text", "\r\n|\r|\n").alias("lines"))
    text = text.withColumn("speaks", F.transform("lines", lambda line: line.rlike(SPEAKS)))
    text = text.withColumn("like", F.transform("lines", lambda line: like(line)))
    at = text.select("*", F.posexplode("speaks").alias("p", "here")).filter("here").drop("here")
    # Runs in which this is the first line that speaks; each is a line alone at least.
    first = at.select("*", F.explode(F.sequence(F.greatest(F.col("p") - (RUN - 1), F.lit(0)), "p")).alias("s")).filter(
        (F.col("s") == F.col("p"))
        | F.forall(F.slice("like", F.col("s") + 1, F.col("p") - F.col("s") + 1), lambda x: x)
        & ~F.exists(F.slice("speaks", F.col("s") + 1, F.col("p") - F.col("s")), lambda x: x)
    )
    last = F.least(F.col("s") + RUN, F.size("lines")) - 1
    runs = first.select("*", F.explode(F.sequence("p", last)).alias("e")).filter(
        (F.col("s") == F.col("e")) | F.forall(F.slice("like", F.col("s") + 1, F.col("e") - F.col("s") + 1), lambda x: x)
    )
    lines = runs.select(
        "k",
        (F.col("s").cast("long") * RUN + F.col("e") - F.col("s")).alias("header"),
        F.array_join(F.slice("lines", F.col("s") + 1, F.col("e") - F.col("s") + 1), " ").alias("text"),
    )
    whole = files.filter("licence_file AND text IS NOT NULL").select("k", F.lit(-1).cast("long").alias("header"), "text")
    return lines.unionByName(whole)


def matches(files: DataFrame, templates: dict[str, str | tuple[str, ...]], threshold: float) -> DataFrame:
    """k, licence, cosine of every file with a header of its own; files: k, text, licence_file."""
    made = template_weights(files.sparkSession, templates)  # as long as the parameter
    rare = log(1 + len(templates))
    idf = made.groupBy("term").agg(F.max("idf").alias("idf"))
    words = [r["term"] for r in idf.select("term").collect()]
    counted = (
        headers(files, words)
        .select("k", "header", F.explode(_terms(F.col("text"))).alias("term"))
        .groupBy("k", "header", "term")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    weighed = counted.join(F.broadcast(idf), "term", "left").withColumn("w", F.col("n") * F.coalesce("idf", F.lit(rare)))
    # One row for each header; its terms are those of the templates, as many as the parameter has.
    vectors = weighed.groupBy("k", "header").agg(
        F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"),
        F.sqrt(F.sum(F.when(F.col("idf").isNotNull(), F.col("w") * F.col("w")))).alias("known"),
        F.collect_list(F.when(F.col("idf").isNotNull(), F.struct("term", "w"))).alias("terms"),
    )
    # No cosine exceeds the known part of a header's length.
    vectors = vectors.filter(F.col("known") >= (threshold - 1e-6) * F.col("length"))
    terms = vectors.select("k", "header", "length", F.explode("terms").alias("t")).select("k", "header", "length", "t.term", "t.w")
    dot = terms.join(F.broadcast(made.drop("idf")), "term").groupBy("k", "header", "template", "form").agg(
        F.sum(F.col("w") * F.col("weight")).alias("dot"),
        F.max("length").alias("length"),
        (~F.max("numbers") | F.max(F.col("term").rlike("[0-9]"))).alias("numbered"),
    )
    cosine = dot.filter("numbered").select("k", "template", "form", F.round(F.col("dot") / F.col("length"), 9).alias("cosine"))
    best = cosine.filter(F.col("cosine") >= threshold).groupBy("k", "template").agg(
        F.max("cosine").alias("cosine"), F.count_distinct("form").alias("forms")
    )
    first = Window.partitionBy("k").orderBy(F.desc("cosine"), F.desc("forms"), "template")
    return best.withColumn("n", F.row_number().over(first)).filter("n = 1").select("k", F.col("template").alias("licence"), "cosine")


def scan(documents: DataFrame, path: Column, templates: dict[str, str | tuple[str, ...]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, path, licence, origin (own, inherited or null), cosine, licence_path for every file.

    documents: doc_id and text; path: a column of theirs, parts separated by '/'.
    """
    files = keyed(documents.select("doc_id", "text", path.alias("path")))
    files = files.select("k", F.col("doc_id").cast("long"), "text", F.col("row.path").alias("path"))
    parts = F.split("path", "/")
    files = files.withColumns(
        {"licence_file": F.coalesce(F.element_at(parts, -1).rlike(LICENCE_FILE), F.lit(False)), "parts": parts}
    )
    own = materialize(matches(files.select("k", "text", "licence_file"), templates or all_forms(), threshold))
    named = files.select("k", "doc_id", "path", "parts", "licence_file").join(own, "k", "left")
    folder = F.array_join(F.slice("parts", 1, F.size("parts") - 1), "/")
    held = named.filter("licence_file AND licence IS NOT NULL").select(folder.alias("folder"), "licence", "cosine", F.col("path").alias("licence_path"))
    first = Window.partitionBy("folder").orderBy(F.desc("cosine"), "licence_path", "licence")
    held = held.withColumn("n", F.row_number().over(first)).filter("n = 1").drop("n")
    held = materialize(held.select("folder", F.col("licence").alias("above"), F.col("cosine").alias("above_cosine"), "licence_path"))
    climbing = named.filter("licence IS NULL AND path IS NOT NULL").select(
        "k", "parts", F.explode(F.sequence(F.lit(0), F.size("parts") - 1)).alias("depth")
    )
    climbing = climbing.select("k", "depth", F.array_join(F.slice("parts", 1, F.col("depth")), "/").alias("folder"))
    nearest = climbing.join(held, "folder").groupBy("k").agg(F.max_by(F.struct("above", "above_cosine", "licence_path"), "depth").alias("from"))
    return named.join(nearest, "k", "left").select(
        "doc_id",
        "path",
        F.coalesce("licence", "from.above").alias("licence"),
        F.when(F.col("licence").isNotNull(), "own").when(F.col("from").isNotNull(), "inherited").alias("origin"),
        F.coalesce("cosine", "from.above_cosine").alias("cosine"),
        F.when(F.col("licence").isNotNull(), F.col("path")).otherwise(F.col("from.licence_path")).alias("licence_path"),
    )


def document_paths() -> Column:
    """A path for the given documents: source, thousand, hundred, name.

    A document that opens with a line about a licence is taken for the licence file of its
    folder, every other one for a text file.
    """
    thousand, hundred = (F.floor(F.col("doc_id") / n).cast("string") for n in (1000, 100))
    opens = F.substring_index(F.col("text"), "\n", 1).rlike(SPEAKS)
    name = F.concat(F.when(opens, "LICENSE-").otherwise("text-"), F.col("doc_id").cast("string"))
    return F.concat_ws("/", F.coalesce("source", F.lit("none")), thousand, hundred, name)
