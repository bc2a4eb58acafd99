"""License scans: TF-IDF cosine of headers and licence files to templates, inherited along directories.

Units. Notices are wrapped, so every line of a text is compared, and every block of
neighbouring lines: paragraphs (up to a line that holds nothing but comment marks),
runs (up to an empty line, or where comment marks begin or end) and whole comments
between marks that open and close one. A row whose file name says licence (``LICENSE``,
``COPYING`` and the like) is also compared as a whole. Comment marks aren't terms.

Cosine. Terms are runs of a-z and 0-9 in lower case; a term weighs its count in the
unit times ln((1 + n) / (1 + df)) + 1, n being the number of documents and df that of
documents which hold it, counted over all documents for every term.

Only units that can reach ``least`` are cut into terms: the common terms of a
template whose weights together have a length under ``least`` of the template's
can't do it alone, so a unit has to hold one of the others. That is exact.

Inheritance. A licence file, or a text of which at least ``share`` of the words are in
lines of matched units, licenses its directory; in a directory with several the best
score counts, then the smallest path. A row without a licence of its own takes
that of the nearest directory above it. Directories are resolved once each,
then joined to the rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import name, stored, word_array

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions:"""
_MIT_REST = """The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that
the above copyright notice and this permission notice appear in all copies."""
_ISC_REST = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER
TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
in the documentation and/or other materials provided with the distribution."""
_BSD_3 = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived
from this software without specific prior written permission."""
_BSD_REST = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT
NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT
HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT
LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_GNU = "you can redistribute it and/or modify it under the terms of the GNU {0}General Public License as published by the Free Software Foundation"
_LATER = "version {0} of the License, or (at your option) any later version."
_UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile,
sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any
means."""
_CC0 = """2. Waiver. To the greatest extent permitted by, but not in contravention of, applicable law, Affirmer hereby overtly, fully, permanently,
irrevocably and unconditionally waives, abandons, and surrenders all of Affirmer's Copyright and Related Rights and associated claims and
causes of action, whether now known or unknown (including existing as well as future claims and causes of action), in the Work (i) in all
territories worldwide, (ii) for the maximum duration provided by applicable law or treaty (including future time extensions), (iii) in any
current or future medium and for any number of copies, and (iv) for any purpose whatsoever, including without limitation commercial,
advertising or promotional purposes (the "Waiver"). Affirmer makes the Waiver for the benefit of each member of the public at large and to
the detriment of Affirmer's heirs and successors, fully intending that such Waiver shall not be subject to revocation, rescission,
cancellation, termination, or any other legal or equitable action to disrupt the quiet enjoyment of the Work by the public as contemplated
by Affirmer's express Statement of Purpose."""
_CC = """By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this Creative Commons
{0} 4.0 International Public License ("Public License"). To the extent this Public License may be interpreted as a contract, You are granted
the Licensed Rights in consideration of Your acceptance of these terms and conditions, and the Licensor grants You such rights in consideration
of benefits the Licensor receives from making the Licensed Material available under these terms and conditions."""
# Customary notices and texts, by licence. Long texts are known by the notices they hold.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Licensed under the ISC License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("MIT", _MIT),
    ("MIT", f"{_MIT} {_MIT_REST}"),
    ("ISC", _ISC),
    ("ISC", f"{_ISC} {_ISC_REST}"),
    ("BSD-2-Clause", _BSD_2),
    ("BSD-2-Clause", f"{_BSD_2} {_BSD_REST}"),
    ("BSD-3-Clause", _BSD_3),
    ("BSD-3-Clause", f"{_BSD_2} {_BSD_3}"),
    ("BSD-3-Clause", f"{_BSD_2} {_BSD_3} {_BSD_REST}"),
    ("GPL-2.0", f"This program is free software; {_GNU.format('')}; either {_LATER.format(2)}"),
    ("LGPL-2.1", f"This library is free software; {_GNU.format('Lesser ')}; either {_LATER.format('2.1')}"),
    ("LGPL-3.0", f"This library is free software: {_GNU.format('Lesser ')}, either {_LATER.format(3)}"),
    ("LGPL-3.0", "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public License, supplemented by the additional permissions listed below."),
    ("AGPL-3.0", f"This program is free software: {_GNU.format('Affero ')}, either {_LATER.format(3)}"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", _UNLICENSE),
    ("CC0-1.0", _CC0),
    ("CC-BY-4.0", _CC.format("Attribution")),
    ("CC-BY-SA-4.0", _CC.format("Attribution-ShareAlike")),
    ("CC-BY-NC-4.0", _CC.format("Attribution-NonCommercial")),
)
FILE = r"(?i)(^|/)(un)?(licen[sc]e|copying|notice)([-._][^/]*)?$"
TERM = "[a-z0-9]+"
# Lines that hold at most marks, begin with a comment mark, open a comment, or close one.
BLANK, MARKED = r"^[^\p{L}\p{N}]*$", r"^\s*(?:#|//|/\*|\*|--|;|%|<!--|\.\.\s)"
OPENS, CLOSES = r"^\s*(?:/\*|<!--)", r"(?:\*/|-->)\s*$"


@dataclass(frozen=True)
class Settings:
    least: float = 0.75
    share: float = 0.4
    digits: int = 6


def counts() -> list[Counter]:
    return [Counter(re.findall(TERM, text.lower())) for _, text in TEMPLATES]


def _idf(df: Column | float, n: float) -> Column:
    return F.log((F.lit(1.0) + F.lit(float(n))) / (F.lit(1.0) + df)) + 1.0


def heavy_terms(weight: dict[str, float], least: float) -> set[str]:
    """Terms of which a text must hold one to reach ``least`` against some template."""
    found: set[str] = set()
    for terms in counts():
        size = {t: (n * weight[t]) ** 2 for t, n in terms.items()}
        room = least**2 * sum(size.values()) * (1 - 1e-9)
        for t in sorted(size, key=lambda t: (weight[t], size[t], t)):
            room -= size[t]
            if room <= 0:
                found.add(t)
    return found


def _any_of(terms: set[str]) -> str:
    """A pattern for one of the terms, letter by letter."""
    found = [f"{c}{_any_of({t[1:] for t in terms if t[:1] == c})}" for c in sorted({t[:1] for t in terms} - {""})]
    return f"(?:{'|'.join(found)}){'?' if '' in terms else ''}" if found else ""


def _starts(flags: Column, begins: Callable[[Column, Column], Column]) -> Column:
    """Lines at which blocks begin; ``begins`` says so of the flags of a line and of the one before it."""
    return F.filter(F.sequence(F.lit(0), F.size(flags) - 1), lambda i: (i == 0) | begins(F.get(flags, i), F.get(flags, i - 1)))


def _spans(at: Column, last: Column) -> Column:
    """Blocks as numbers, ``_block``, from the lines at which they begin."""
    after = F.concat(F.slice(at, F.lit(2), F.size(at)), F.array(last))
    return F.zip_with(at, after, lambda i, j: _block(i, j - i))


def _block(line: Column, n: Column) -> Column:
    """``n`` lines from ``line`` on as one number: arrays of numbers lose their copies in linear time, those of structs don't."""
    return F.shiftleft(line.cast("bigint"), 32).bitwiseOR(n.cast("bigint"))


def _units(docs: DataFrame, heavy: str) -> DataFrame:
    """(key, line, n, unit): single lines and blocks of ``n`` lines from ``line`` on; -1 and 0 for licence files as a whole.

    Only those that hold a term of the pattern ``heavy``: terms don't go over the ends of lines, so a block holds one where a line of it does.
    """
    lines, last = F.col("lines"), F.size("lines")
    patterns = {OPENS: 1, CLOSES: 2, BLANK: 4, r"^\s*$": 8, MARKED: 16, heavy: 32}
    flags = F.transform(lines, lambda x: sum((F.when(x.rlike(p), bit).otherwise(0) for p, bit in patterns.items()), F.lit(0)))
    has = lambda x, bit: x.bitwiseAND(F.lit(bit)) != 0
    edge = lambda x, y: has(x, 1) | has(y, 2)
    starts = {
        "paragraphs": lambda x, y: edge(x, y) | has(x, 4),
        "runs": lambda x, y: edge(x, y) | has(x, 8) | (has(x, 16) != has(y, 16)),
        "comments": edge,
    }
    # each step is a column of its own: within one expression flags and starts would be formed anew wherever they are used
    split = docs.withColumn("lines", F.split(F.lower("text"), "\n")).withColumn("flags", flags)
    split = split.withColumns({n: _starts(F.col("flags"), begins) for n, begins in starts.items()})
    single = F.transform(F.sequence(F.lit(0), last - 1), lambda i: _block(i, F.lit(1)))
    first = lambda b: F.shiftright(b, 32).cast("int")
    length = lambda b: b.bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
    held = lambda b: F.exists(F.slice("flags", first(b) + 1, length(b)), lambda x: has(x, 32))
    paragraphs, runs = _spans(F.col("paragraphs"), last), _spans(F.col("runs"), last)
    comments = F.filter(_spans(F.col("comments"), last), lambda x: has(F.get("flags", first(x)), 1))
    whole = F.when(F.col("key.path").rlike(FILE), F.array(_block(F.lit(-1), F.lit(0))))
    blocks = F.array_distinct(F.concat(F.filter(F.concat(single, paragraphs, runs, comments), held), F.coalesce(whole, F.array().cast("array<bigint>"))))

    def unit(block: Column) -> Column:
        line, n = first(block), length(block)
        text = F.when(n == 0, F.lower("text")).otherwise(F.array_join(F.slice(lines, F.greatest(line, F.lit(0)) + 1, n), " "))
        return F.struct(line.alias("line"), n.alias("n"), text.alias("unit"))

    # units are cut before they become rows: a row holds its own lines, not those of the whole text
    cut = split.select("key", F.explode(F.transform(blocks, unit)).alias("u"))
    return cut.select("key", "u.line", "u.n", "u.unit")


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TERM), F.lit(0))


def scan(docs: DataFrame, id_col: str, path: Column, text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """(id, path, license, score, origin) per row of ``docs``; all three null where nothing is found.

    license and score are those of the row's best unit and origin is its own path;
    for an inherited licence they're those of the directory, and origin is the
    directory. Of equal scores the last name counts. A null text or path is empty. Rows equal
    in id, path and text are one text and get the same result; an empty table
    gives an empty result.
    """
    s, spark = settings, docs.sparkSession
    text = F.coalesce(name(text_col).cast("string"), F.lit(""))
    key = F.struct(name(id_col).alias("id"), F.coalesce(path, F.lit("")).alias("path"), F.xxhash64(text).alias("digest"))
    texts = docs.select(key.alias("key"), text.alias("text"))
    # weights of the terms
    vocabulary = sorted({t for c in counts() for t in c})
    # one pass counts documents and what they hold, the number of documents under the empty term
    marked = texts.select(F.explode(F.concat(F.array(F.lit("")), F.array_distinct(_terms(F.lower("text"))))).alias("d_term"))
    df, _ = stored(marked.groupBy("d_term").agg(F.count(F.lit(1)).alias("df")), "license-df")
    found = {r["d_term"]: r["df"] for r in df.where(F.col("d_term").isin("", *vocabulary)).collect()}
    n = found.get("", 0)
    weight = {t: math.log((1.0 + n) / (1.0 + found.get(t, 0))) + 1.0 for t in vocabulary}
    # units that hold a heavy term, cut into terms
    heavy = f"(?<![a-z0-9]){_any_of(heavy_terms(weight, s.least))}(?![a-z0-9])"
    units = _units(texts.where(F.lower("text").rlike(heavy)), heavy)
    terms = units.select("key", "line", "n", F.explode(_terms(F.col("unit"))).alias("term"))
    tf = terms.groupBy("key", "line", "n", "term").agg(F.count(F.lit(1)).alias("tf"))
    weighed = tf.join(df, tf["term"] == df["d_term"]).withColumn("w", F.col("tf") * _idf(F.col("df"), n))
    weighed, _ = stored(weighed.select("key", "line", "n", "term", "w"), "license-terms")
    sizes = weighed.groupBy("key", "line", "n").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("size"))
    rows = []
    for i, ((license_, _), c) in enumerate(zip(TEMPLATES, counts(), strict=True)):
        size = math.sqrt(sum((k * weight[t]) ** 2 for t, k in c.items()))
        rows += [(t, i, license_, k * weight[t] / size) for t, k in sorted(c.items())]
    templates = spark.createDataFrame(rows, "t_term string, template int, license string, t double")
    dots = weighed.join(templates, weighed["term"] == templates["t_term"])
    dots = dots.groupBy("key", "line", "n", "template", "license").agg(F.sum(F.col("w") * F.col("t")).alias("dot"))
    scored = dots.join(sizes, ["key", "line", "n"]).withColumn("score", F.round(F.col("dot") / F.col("size"), s.digits))
    best = F.max(F.struct("score", "license"))
    found = scored.where(F.col("score") >= s.least).groupBy("key", "line", "n").agg(best.alias("best"))
    own = found.groupBy("key").agg(F.max("best").alias("best"), F.collect_set(F.struct("line", "n")).alias("spans"))
    own, _ = stored(own, "license-own")
    # directories
    sizes = F.transform(F.split("text", "\n"), lambda x: F.size(word_array(x)))
    rows_ = texts.select("key", sizes.alias("sizes"), _directory(F.col("key.path")).alias("dir"))
    rows_, _ = stored(rows_, "license-rows")
    met = rows_.distinct().join(own, "key")
    met = met.withColumns({"in_lines": _total(_covered(F.col("spans")), lambda i: F.get("sizes", i)), "n_words": _total(F.col("sizes"), lambda x: x)})
    files = met.where(F.col("key.path").rlike(FILE) | (F.col("in_lines") >= s.share * F.col("n_words")))
    # the greatest of (score, smallest path): paths are compared once the score is settled
    top = files.groupBy("dir").agg(F.max("best.score").alias("top"))
    tied = files.join(top, "dir").where(F.col("best.score") == F.col("top"))
    licensed = tied.groupBy("dir").agg(F.min_by("best", F.struct("key.path", "best.license")).alias("best"))
    above = rows_.select("dir").distinct().withColumn("up", F.explode(_ancestors(F.col("dir"))))
    licensed = licensed.select(F.col("dir").alias("up"), "best")
    near = above.join(licensed, "up").groupBy("dir").agg(F.max_by(F.struct("best", "up"), F.length("up")).alias("near"))
    full = rows_.select("key", "dir").join(own.select(F.col("key").alias("o_key"), "best"), F.col("key") == F.col("o_key"), "left")
    full = full.join(near.select(F.col("dir").alias("n_dir"), "near"), F.col("dir") == F.col("n_dir"), "left")
    return full.select(
        F.col("key.id").alias(id_col),
        F.col("key.path").alias("path"),
        F.coalesce("best.license", "near.best.license").alias("license"),
        F.coalesce("best.score", "near.best.score").alias("score"),
        F.when(F.col("best").isNotNull(), F.col("key.path")).otherwise(F.col("near.up")).alias("origin"),
    )


def _covered(spans: Column) -> Column:
    """The lines of some blocks, once each."""
    within = F.filter(spans, lambda x: x["n"] > 0)
    return F.array_distinct(F.flatten(F.transform(within, lambda x: F.sequence(x["line"], x["line"] + x["n"] - 1))))


def _total(values: Column, size: Callable[[Column], Column]) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + size(x))


def _directory(path: Column) -> Column:
    return F.regexp_extract(path, r"(?s)^(.*)/[^/]*$", 1)


def _ancestors(directory: Column) -> Column:
    """The directory, those above it, and the root."""
    parts = F.filter(F.split(directory, "/"), lambda x: x != "")
    return F.transform(F.sequence(F.size(parts), F.lit(0)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))
