"""Licence scan: sparse TF-IDF cosine to templates, then inheritance by directory.

Each line of a file is compared with one-line templates. The whole file, the
block of its leading lines and that block's paragraphs are compared with the
licences' full texts and header blocks, with document frequencies counted over
all files. The most similar one gives the file's own licence. A file that
consists mostly of licence text is a licence file and speaks for its directory;
a file without a licence of its own takes that of the nearest directory above
it that has one. DataFrame functions only.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import Scratch, small_side

#: Fixed one-line notices by SPDX identifier.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.",
    "BSD-3-Clause": "Redistributed under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0.",
}
_GNU = """This {thing} is free software{mark} you can redistribute it and/or modify
it under the terms of the GNU {name} as published by
the Free Software Foundation{comma} either version {version} of the License, or
(at your option) any later version.

This {thing} is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU {name} for more details.

You should have received a copy of the GNU {name}
along with this {thing}{end}"""
_ADDRESS = "; if not, write to the Free Software\nFoundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA"
_LINK = ".  If not, see <https://www.gnu.org/licenses/>."
_CREATIVE = """This work is licensed under the Creative Commons {name} 4.0 International License.
To view a copy of this license, visit http://creativecommons.org/licenses/{code}/4.0/
or send a letter to Creative Commons, PO Box 1866, Mountain View, CA 94042, USA."""


def _gnu(name: str, version: str, end: str, thing: str = "program") -> str:
    return _GNU.format(thing=thing, mark=":" if end == _LINK else ";", comma="," if end == _LINK else ";", name=name, version=version, end=end)


#: Header blocks of files by SPDX identifier.
HEADERS = {
    "Apache-2.0": [
        """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.""",
        """Licensed to the Apache Software Foundation (ASF) under one or more
contributor license agreements.  See the NOTICE file distributed with
this work for additional information regarding copyright ownership.
The ASF licenses this file to You under the Apache License, Version 2.0
(the "License"); you may not use this file except in compliance with
the License.  You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.""",
    ],
    "MIT": [
        "Use of this source code is governed by an MIT-style\nlicense that can be found in the LICENSE file or at\nhttps://opensource.org/licenses/MIT.",
        "Licensed under the MIT License. See LICENSE in the project root for license information.",
    ],
    "GPL-2.0": [_gnu("General Public License", "2", _ADDRESS), _gnu("General Public License", "2", _LINK)],
    "GPL-3.0": [_gnu("General Public License", "3", _LINK)],
    "LGPL-2.1": [_gnu("Lesser General Public License", "2.1", _ADDRESS, "library"), _gnu("Lesser General Public License", "2.1", _LINK, "library")],
    "LGPL-3.0": [_gnu("Lesser General Public License", "3", _LINK), _gnu("Lesser General Public License", "3", _LINK, "library")],
    "AGPL-3.0": [_gnu("Affero General Public License", "3", _LINK)],
    "MPL-2.0": [
        """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    ],
    "BSD-3-Clause": ["Use of this source code is governed by a BSD-style\nlicense that can be found in the LICENSE file."],
    "CC-BY-4.0": [_CREATIVE.format(name="Attribution", code="by")],
    "CC-BY-NC-4.0": [_CREATIVE.format(name="Attribution-NonCommercial", code="by-nc")],
    "CC-BY-SA-4.0": [_CREATIVE.format(name="Attribution-ShareAlike", code="by-sa")],
    "CC0-1.0": [
        """To the extent possible under law, the author(s) have dedicated all copyright
and related and neighboring rights to this software to the public domain worldwide.
This software is distributed without any warranty.

You should have received a copy of the CC0 Public Domain Dedication along with this software.
If not, see <http://creativecommons.org/publicdomain/zero/1.0/>.""",
    ],
}
#: The leading lines of a file: a comment, or lines that all have a comment mark, or lines up to an empty one.
LEADING = (
    r"(?s)\A\s*+(?:(?:#!|<\?)[^\n]*+\n\s*+)?"
    r"(?:/\*.*?\*/|<!--.*?-->|\"\"\".*?\"\"\"|'''.*?'''"
    r"|(?:[ \t]*+(?:#|//|--|;|%|dnl\b|REM\b)[^\n]*+(?:\n|\z))++|(?:[ \t\r]*+[^\s][^\n]*+(?:\n|\z))++)"
)
#: Words that most English lines hold; they are the last to be searched for.
COMMON = frozenset("a and are as at be by for from in is it of on or that the this to was with".split())
TOKEN = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"


def template_weights(templates: dict[str, str]) -> tuple[dict[tuple[str, str], float], dict[str, float], float]:
    """((template, token) -> unit vector weight, token -> idf, idf of unseen tokens)."""
    tokens = {name: Counter(re.findall(TOKEN, text.lower())) for name, text in templates.items()}
    n = len(templates)
    df = Counter(t for c in tokens.values() for t in c)
    idf = {t: round(math.log((1 + n) / (1 + d)) + 1, 9) for t, d in df.items()}
    weights = {}
    for name, c in tokens.items():
        norm = math.sqrt(sum((f * idf[t]) ** 2 for t, f in c.items()))
        weights |= {(name, t): round(f * idf[t] / norm, 9) for t, f in c.items()}
    return weights, idf, round(math.log(1 + n) + 1, 9)


def telling_tokens(weights: dict[tuple[str, str], float], least: float) -> list[str]:
    """Tokens of which a line needs at least one to reach the cosine ``least`` with any template.

    Long tokens first (ordinary texts rarely hold them), then heavy ones, common words at the end,
    tokens are taken until what is left of every template is too short.
    """
    chosen: set[str] = set()
    for name in sorted({n for n, _ in weights}):
        rest = sorted(((t not in COMMON, min(len(t), 6), w, t) for (n, t), w in weights.items() if n == name and t not in chosen), reverse=True)
        while rest and math.sqrt(sum(w * w for _, _, w, _ in rest)) >= least:
            chosen.add(rest.pop(0)[3])
    return sorted(chosen)


@cache
def block_templates() -> dict[str, tuple[str, ...]]:
    """Header blocks, their first paragraphs that name the licence, and full texts by SPDX identifier."""
    texts = {f.stem: [f.read_text()] for f in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}
    for name, blocks in HEADERS.items():
        texts.setdefault(name, []).extend(part for b in blocks for part in dict.fromkeys([b, b.split("\n\n")[0]]))
    return {name: tuple(t) for name, t in texts.items()}


def block_weights(texts: dict[str, tuple[str, ...]], df: dict[str, int], n: int) -> dict[tuple[str, int, str], float]:
    """(licence, number of its text, token) -> unit vector weight, with document frequencies of ``n`` files."""
    out = {}
    for name, blocks in texts.items():
        for k, block in enumerate(blocks):
            x = {t: (1 + math.log(f)) * (math.log((1 + n) / (1 + df.get(t, 0))) + 1) for t, f in Counter(re.findall(TOKEN, block.lower())).items()}
            norm = math.sqrt(sum(v * v for v in x.values()))
            out |= {(name, k, t): v / norm for t, v in x.items()}
    return out


def _tokens(line: Column) -> Column:
    return F.regexp_extract_all(F.lower(line), F.lit(TOKEN), F.lit(0))


def _table(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame(rows, schema)


def line_licenses(lines: DataFrame, templates: dict[str, str] = TEMPLATES, least: float = 0.7) -> DataFrame:
    """(line, license, cosine) of the distinct lines that are like a template; the best one, ties by name."""
    weights, idf, unseen = template_weights(templates)
    known = F.broadcast(_table(lines, [(t, i) for t, i in idf.items()], "token string, idf double"))  # fixed size
    vectors = F.broadcast(_table(lines, [(t, n, w) for (n, t), w in weights.items()], "token string, license string, w double"))
    kinds = lines.select("line").distinct()
    counts = kinds.select("line", F.explode(_tokens(F.col("line"))).alias("token")).groupBy("line", "token").agg(F.count("*").alias("f"))
    parts = counts.join(known, "token", "left").withColumn("x", F.col("f") * F.coalesce("idf", F.lit(unseen)))
    norms = parts.groupBy("line").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    dots = parts.join(vectors, "token").groupBy("line", "license").agg(F.sum(F.col("x") * F.col("w")).alias("dot"))
    near = dots.join(norms, "line").select("line", "license", F.round(F.col("dot") / F.col("norm"), 6).alias("cosine")).where(F.col("cosine") >= least)
    best = near.groupBy("line").agg(F.min(F.struct((-F.col("cosine")).alias("c"), F.col("license"))).alias("b"))
    return best.select("line", F.col("b.license").alias("license"), (-F.col("b.c")).alias("cosine"))


def _spread_join(left: DataFrame, right: DataFrame, on: str, by: str, how: str = "inner", salts: int = 16) -> DataFrame:
    """``left`` joined with the one row that ``right`` has for each ``on``; rows of one ``on`` go to ``salts`` tasks by ``by``."""
    many = left.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(salts)))
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return many.join(copies, [on, "_salt"], how).drop("_salt")


def known_words(texts: DataFrame, vocabulary: set[str]) -> DataFrame:
    """(key, token): which words of the vocabulary each file holds; the one tokenisation of all texts."""
    known = F.broadcast(_table(texts, [(t,) for t in sorted(vocabulary)], "token string"))  # fixed size
    words = texts.where("text IS NOT NULL").select("key", F.explode(F.array_distinct(_tokens(F.col("text")))).alias("token"))
    return words.join(known, "token").select("key", "token")


def block_licenses(
    texts: DataFrame, known: DataFrame, scratch: Scratch, templates: dict[str, tuple[str, ...]], least: float, file_share_pct: int
) -> DataFrame:
    """(key, b, is_file) of the texts of which the whole, the leading block or one of its paragraphs is like a template.

    ``texts`` has a row (key, text) for each file, ``known`` the words of the templates that each file holds. A
    block's cosine with a template is at most the norm of the template's weights on the words of the file; only
    files that reach ``least`` by that become vectors.
    """
    own = {t for blocks in templates.values() for b in blocks for t in re.findall(TOKEN, b.lower())}
    n = texts.where("text IS NOT NULL").count()
    # the counts of a fixed vocabulary
    counted = {r.token: r.df for r in known.groupBy("token").agg(F.count("*").alias("df")).collect()}
    weights = block_weights(templates, {t: counted[t] for t in own if t in counted}, n)
    most: dict[str, float] = {}
    for (_, _, t), w in weights.items():
        most[t] = max(most.get(t, 0.0), w * w)
    bound = known.join(F.broadcast(_table(texts, list(most.items()), "token string, most double")), "token").groupBy("key").agg(F.sum("most").alias("most"))
    keys = scratch.store(bound.where(F.col("most") >= (least - 1e-6) ** 2).select("key"))
    some = texts.join(small_side(keys, 100_000), "key", "left_semi").groupBy("key").agg(F.min("text").alias("text"))
    spread = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    some = some.repartition(spread, "key")  # few texts, much work for each
    head = F.regexp_extract("text", LEADING, 0)
    # lines without a word part the paragraphs
    blocks = F.array_distinct(F.concat(F.array("text", head), F.split(head, r"\n[^A-Za-z0-9\n]*+(?=\n)")))
    parted = some.select("key", F.size(_tokens(F.col("text"))).alias("n"), F.posexplode(blocks).alias("block", "part"))
    tokens = parted.withColumn("words", _tokens(F.col("part"))).select("key", "n", "block", F.size("words").alias("own"), F.explode("words").alias("token"))
    counts = scratch.store(tokens.groupBy("key", "n", "block", "own", "token").agg(F.count("*").alias("f")))
    seen = counts.select("token").distinct()
    other = scratch.store(seen.join(F.broadcast(_table(texts, [(t,) for t in sorted(own)], "token string")), "token", "left_anti"))
    words = texts.where("text IS NOT NULL").select(F.explode(F.array_distinct(_tokens(F.col("text")))).alias("token"))
    rare = words.join(small_side(other, 100_000), "token", "left_semi").groupBy("token").agg(F.count("*").alias("df"))
    df = scratch.store(rare.unionByName(_table(texts, [(t, counted[t]) for t in sorted(own) if t in counted], "token string, df long")))
    idf = F.log(F.lit(1.0 + n) / (F.lit(1.0) + F.col("df"))) + 1
    parts = counts.join(small_side(df, 100_000), "token").withColumn("x", (F.log("f") + 1) * idf)
    block = ["key", "n", "block", "own"]
    norms = parts.groupBy(*block).agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    vectors = F.broadcast(_table(texts, [(*k, w) for k, w in weights.items()], "license string, k int, token string, w double"))
    dots = parts.join(vectors, "token").groupBy(*block, "license", "k").agg(F.sum(F.col("x") * F.col("w")).alias("dot"))
    near = dots.join(norms, block).withColumn("cosine", F.round(F.col("dot") / F.col("norm"), 6)).where(F.col("cosine") >= least)
    return near.groupBy("key").agg(
        F.min(F.struct((-F.col("cosine")).alias("c"), F.col("license"))).alias("b"),
        (F.lit(100) * F.max("own") >= F.lit(file_share_pct) * F.min("n")).alias("is_file"),
    )


def scan_licenses(
    files: DataFrame, path: str, text: str = "text", templates: dict[str, str] = TEMPLATES, least: float = 0.7, file_share_pct: int = 50,
    texts: dict[str, tuple[str, ...]] | None = None,
) -> DataFrame:
    """``files`` with own_license, cosine, is_license_file, license and license_dir.

    ``path`` is the file's path, its directories separated by ``/``. A
    directory with several licence files has the licence most of them have
    (ties by name). ``license`` is the own one, else the nearest directory's;
    ``license_dir`` says which directory, null if own or none. Null and empty
    texts have no own licence; a null path has no directory. Rows of one path
    are one file each by its own text. Input columns named like an added one
    are replaced. An empty table gives an empty result. ``texts`` are the header
    blocks and full texts (``block_templates()`` if not given).
    """
    added = ["own_license", "cosine", "is_license_file", "license", "license_dir"]
    kept = [F.col(f"`{c}`") for c in files.columns if c not in added]
    files = files.select(F.struct(*kept).alias("file"), F.col(f"`{path}`").alias("path"), F.col(f"`{text}`").alias("text"))
    # a null text has no licence of its own: any key that no text has
    key = F.coalesce(F.sha2("text", 256), F.concat(F.lit("-"), F.xxhash64("file").cast("string")))
    weights, _, _ = template_weights(templates)
    telling = telling_tokens(weights, least)
    blocks = block_templates() if texts is None else texts
    scratch = Scratch(files.sparkSession)
    hashed = files.select(key.alias("key"), "text")
    own_words = {t for b in blocks.values() for x in b for t in re.findall(TOKEN, x.lower())}
    known = scratch.store(known_words(hashed, own_words | set(telling)), "zstd")
    # lines without a telling token cannot be similar; equal texts count once from here on
    held = scratch.store(known.where(F.col("token").isin(telling)).select("key").distinct())
    some = hashed.join(small_side(held, 100_000), "key", "left_semi").groupBy("key").agg(F.min("text").alias("text"))
    lines = some.select("key", F.size(_tokens(F.col("text"))).alias("n"), F.explode(F.split("text", "\n")).alias("line"))
    telling_lines = lines.where(F.arrays_overlap(_tokens(F.col("line")), F.array(*[F.lit(t) for t in telling])))
    one = scratch.store(telling_lines.groupBy("key", "line").agg(F.min("n").alias("n")))
    found = _spread_join(one, line_licenses(one, templates, least), "line", by="key")
    # a text's licence lines count once each
    own_lines = found.groupBy("key").agg(
        F.min(F.struct((-F.col("cosine")).alias("c"), F.col("license"))).alias("b"),
        (F.lit(100) * F.sum(F.size(_tokens(F.col("line")))) >= F.lit(file_share_pct) * F.min("n")).alias("is_file"),
    )
    own_blocks = block_licenses(hashed, known, scratch, blocks, least, file_share_pct)
    own = own_lines.unionByName(own_blocks).groupBy("key").agg(F.min("b").alias("b"), F.max("is_file").alias("is_file"))
    rows = files.withColumns({"key": key, "file_dir": _parent(F.col("path"))}).drop("text").join(own, "key", "left")
    speaks = rows.where("is_file").groupBy("file_dir", "b.license").agg(F.count("*").alias("files"))
    of_dir = speaks.groupBy(F.col("file_dir").alias("dir")).agg(F.min(F.struct((-F.col("files")).alias("f"), F.col("license"))).alias("d"))
    # nearest ancestor: each directory meets the directories above it, the deepest with a licence wins
    parts = F.split("file_dir", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.struct(i.alias("depth"), F.array_join(F.slice(parts, 1, i), "/").alias("dir")))
    dirs = files.select(_parent(F.col("path")).alias("file_dir")).where("file_dir IS NOT NULL").distinct()
    dirs = dirs.select("file_dir", F.explode(above).alias("a")).select("file_dir", "a.depth", "a.dir")
    nearest = dirs.join(of_dir, "dir").groupBy("file_dir").agg(F.max(F.struct("depth", "dir", "d.license")).alias("up"))
    out = _spread_join(rows, nearest, "file_dir", by="key", how="left")
    own_license = F.col("b.license")
    return out.select(
        *[F.col(f"file.`{c}`") for c in files.schema["file"].dataType.names],
        own_license.alias("own_license"),
        (-F.col("b.c")).alias("cosine"),
        F.coalesce("is_file", F.lit(False)).alias("is_license_file"),
        F.coalesce(own_license, F.col("up.license")).alias("license"),
        F.when(own_license.isNull(), F.col("up.dir")).alias("license_dir"),
    )


def _parent(path: Column) -> Column:
    """The directory of a path; a path without one lies in the directory ""."""
    return F.when(path.isNotNull(), F.regexp_extract(path, r"^(?:(.*)/)?[^/]*$", 1))
