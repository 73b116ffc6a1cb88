"""Scans for licence texts and notices: Dice coefficient over word bigrams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom.llm.license_texts import TEXTS

LEAST_DICE = 0.8
# Words of all templates together that one scan takes into its plan.
MOST_TEMPLATE_WORDS = 20_000


def _gnu(what: str, name: str, version: str) -> str:
    return (
        f"This {what} you can redistribute it and/or modify it under the terms of the GNU {name} Public License as "
        f"published by the Free Software Foundation{version} of the License, or (at your option) any later version."
    )


_BSD_START = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
    "this list of conditions and the following disclaimer. "
)
_BSD_BINARY = (
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission. "
)
_BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
    "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
    "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)

# Notices and texts of public licences.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "bsd-2-clause": "Licensed under the BSD 2-Clause License.",
    "bsd-3-clause": "Licensed under the BSD 3-Clause License.",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-long-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-nc-sa-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "mit": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions:"
    ),
    "mit-warranty": (
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
        "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
        "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR "
        "THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "public-domain": "This work is dedicated to the public domain.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "agpl-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "agpl-3.0-header": _gnu("program is free software:", "Affero General", ", either version 3"),
    "bsd-2-clause-text": _BSD_START + _BSD_BINARY + _BSD_WARRANTY,
    "bsd-3-clause-text": _BSD_START + _BSD_BINARY + _BSD_NAMES + _BSD_WARRANTY,
    "bsd-conditions": _BSD_START,
    "bsd-warranty": _BSD_WARRANTY,
    "cc0-1.0": "This work is dedicated to the public domain under CC0 1.0 Universal.",
    "epl-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public "
        "License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"
    ),
    "gpl-2.0-header": _gnu("program is free software;", "General", "; either version 2"),
    "gpl-2.0-only-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License version 2 as published by the Free Software Foundation."
    ),
    "lgpl-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "lgpl-2.1-header": _gnu("library is free software;", "Lesser General", "; either version 2.1"),
    "lgpl-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "lgpl-3.0-header": _gnu("library is free software;", "Lesser General", "; either version 3"),
    "lgpl-3.0-program-header": _gnu("program is free software:", "Lesser General", ", either version 3"),
    "zlib": (
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, "
        "and to alter it and redistribute it freely, subject to the following restrictions:"
    ),
    **TEXTS,
}


def template_frame(spark: SparkSession) -> DataFrame:
    """The built-in templates: columns ``template_id`` and ``text``."""
    return spark.createDataFrame(sorted(TEMPLATES.items()), "template_id string, text string")


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _plain(text: Column) -> Column:
    """Lower case, words between single blanks, lines as they are."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}\n]+", " ")


def _words(unit: Column) -> Column:
    return F.filter(F.split(unit, r"[ \n]+"), lambda w: w != "")


def _pairs(words: Column) -> Column:
    """Word bigrams as numbers."""
    return F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1)),
    )


def _bigrams(words: Column) -> Column:
    """Word bigrams as numbers; the second of two equal ones is another number, so that
    sets of them compare like bags."""
    return _bind(
        F.sort_array(_pairs(words)),
        lambda s: F.transform(s, lambda x, i: F.xxhash64(x, i + 1 - F.array_position(s, x))),
    )


def license_scan(
    docs: DataFrame, templates: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    least_dice: float = LEAST_DICE,
) -> DataFrame:
    """Columns ``doc``, ``n_compared``, ``n_matches``, ``licenses`` (ids, sorted, comma-joined),
    ``best_license`` and ``best_dice``, one row per row of ``docs``.

    Units of a text are its lines, its paragraphs (between blank lines) if it has
    several lines, and the whole of a text of several paragraphs. A unit of n
    bigrams is compared with a template of m only if n and m admit the coefficient
    at all: 2 min(n, m) >= least_dice (n + m); without any such template it is left
    out before bigrams are formed. The template of the highest coefficient counts
    (of equals the first id), if it reaches ``least_dice``.

    Null, empty and wordless texts have no unit; texts may be of any length; repeated
    rows stay; an empty table of documents gives no rows, one of templates no match;
    templates of fewer than two words or without id never match; other columns are
    not looked at. Templates enter the plan as literals, at most
    ``MOST_TEMPLATE_WORDS`` words: scan a larger library in parts.
    """
    text = _plain(F.col("text").cast("string"))
    known = (
        templates.select("template_id", _words(text).alias("words"))
        .where("template_id is not null").withColumn("n", F.size("words") - 1).where("n > 0").distinct()
    )
    total = known.agg(F.sum("n")).first()[0] or 0
    if total > MOST_TEMPLATE_WORDS:
        raise ValueError(f"{total} template words; scan at most {MOST_TEMPLATE_WORDS} at a time")
    library = known.select(
        "template_id", "n", _bigrams(F.col("words")).alias("grams"), F.array_distinct(_pairs(F.col("words"))).alias("pairs")
    ).collect()
    rows = [
        F.struct(
            F.lit(t["template_id"]).alias("id"), F.lit(t["n"]).alias("n"),
            *[F.split(F.lit(",".join(map(str, t[k]))), ",").cast("array<bigint>").alias(k) for k in ("grams", "pairs")],
        )
        for t in sorted(library, key=lambda t: t["template_id"])
    ]
    kind = "array<struct<id: string, n: int, grams: array<bigint>, pairs: array<bigint>>>"
    all_templates = (F.array(*rows) if rows else F.array()).cast(kind)

    def admits(t: Column, n: Column) -> Column:
        return 2 * F.least(t["n"], n) >= least_dice * (t["n"] + n)

    # Sizes that any template admits: most units end here.
    sizes = sorted({
        n for t in library for n in range(1, int(t["n"] * (2 / least_dice - 1)) + 2)
        if 2 * min(t["n"], n) >= least_dice * (t["n"] + n)
    })
    fitting = F.array(*[F.lit(n) for n in sizes]).cast("array<int>")

    def may_match(distinct: Column, n: Column) -> Column:
        """Templates that may reach the coefficient: bags have in common at most what their
        sets have, and the repeated bigrams of the one that has fewer of them."""
        return F.filter(
            all_templates,
            lambda t: admits(t, n) & (
                2 * (
                    F.size(F.array_intersect(distinct, t["pairs"]))
                    + F.least(n - F.size(distinct), t["n"] - F.size(t["pairs"]))
                ) >= least_dice * (t["n"] + n)
            ),
        )

    def compare(words: Column) -> Column:
        n = F.size(words) - 1
        none = F.array(F.struct(F.lit(0.0).alias("dice"), F.lit("").alias("id")))

        def scored(candidates: Column) -> Column:
            found = _bind(
                _bigrams(words),
                lambda grams: F.sort_array(
                    F.transform(
                        candidates,
                        lambda t: F.struct(
                            (F.lit(2.0) * F.size(F.array_intersect(grams, t["grams"])) / (n + t["n"])).alias("dice"),
                            t["id"].alias("id"),
                        ),
                    )
                ),
            )
            return F.when(F.size(candidates) > 0, found).otherwise(none)

        return _bind(F.array_distinct(_pairs(words)), lambda distinct: _bind(may_match(distinct, n), scored))

    def best(found: Column) -> Column:
        """Of the highest coefficient the first id; found is sorted by both."""
        top = F.element_at(found, -1)["dice"]
        return F.element_at(F.filter(found, lambda f: f["dice"] == top), 1)

    plain = docs.select(F.col(id_col).cast("long").alias("doc"), _plain(F.col(text_col).cast("string")).alias("plain"))
    lines = F.split("plain", "\n")
    paragraphs = F.split("plain", r"\n *\n")
    units = F.concat(
        lines,
        F.when(F.instr("plain", "\n") > 0, paragraphs).otherwise(F.array().cast("array<string>")),
        F.when(F.size(paragraphs) > 1, F.array(F.col("plain"))).otherwise(F.array().cast("array<string>")),
    )
    worth = F.filter(F.transform(units, _words), lambda w: F.array_contains(fitting, F.size(w) - 1))
    scored = plain.select("doc", F.transform(worth, compare).alias("found"))
    matches = F.filter(F.transform("found", best), lambda b: b["dice"] >= least_dice)
    scored = scored.select("doc", F.size("found").cast("long").alias("n_compared"), matches.alias("m"))
    return scored.select(
        "doc", "n_compared", F.size("m").cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("m", lambda x: x["id"]))), ",").alias("licenses"),
        *[
            F.when(F.size("m") > 0, _bind(F.sort_array("m"), best)[part]).alias(name)
            for part, name in (("id", "best_license"), ("dice", "best_dice"))
        ],
    )
