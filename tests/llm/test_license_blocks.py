"""Real licence files and header blocks, which no single line gives away."""

import math
import re
from collections import Counter

from stratus.llm.licenses import HEADERS, TOKEN, block_templates, scan_licenses


def comment(block, mark):
    return "\n".join(f"{mark} {x}".rstrip() for x in ["Copyright 2020 The Someone Authors", "", *block.split("\n")])


def cosine(a, b, files):
    """Plain version of the blocks' cosine."""
    has = [set(re.findall(TOKEN, (f or "").lower())) for f in files if f is not None]

    def vector(t):
        c = Counter(re.findall(TOKEN, t.lower()))
        return {w: (1 + math.log(f)) * (math.log((1 + len(has)) / (1 + sum(w in h for h in has))) + 1) for w, f in c.items()}

    x, y = vector(a), vector(b)
    return sum(v * y.get(w, 0) for w, v in x.items()) / math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))


def test_license_files_and_header_blocks(spark):
    code = "\n\nint main(void) {\n" + "".join(f"  call_{i}(arg{i}, other{i});\n" for i in range(400)) + "}\n"
    prose = "The ship sailed on the morning of the third day, and all of the crew were glad of it.\n" * 30
    files, want = [("p/x.txt", prose), ("p/y.c", code), ("p/z", None), ("p/e", "")], {}
    for name, texts in block_templates().items():
        if len(texts[0]) > 600 and name not in ("AGPL-3.0",) and texts[0] not in HEADERS.get(name, []):
            path = f"full/{name}/LICENSE"
            files += [(path, texts[0].replace("<year> <copyright holders>", "2019 Jo Doe")), (f"full/{name}/src/a.c", "int x;")]
            want[path] = (name, True)
        for k, header in enumerate(HEADERS.get(name, [])):
            for mark in ("#", "//", " *"):
                path = f"heads/{name}/{k}{mark.strip().replace('/', 's')}.c"
                block = comment(header, mark)
                files.append((path, ("/*\n" + block + "\n */" if mark == " *" else "#!/bin/sh\n" + block if mark == "#" else block) + code))
                want[path] = (name, False)
    df = spark.createDataFrame(files, "path string, text string").repartition(4)
    out = {r.path: r for r in scan_licenses(df, "path").collect()}
    assert len(out) == len(files) and len(want) > 50
    assert {p: (out[p].own_license, out[p].is_license_file) for p in want} == want
    for name in ("MIT", "GPL-3.0", "MPL-2.0", "Apache-2.0"):
        below = out[f"full/{name}/src/a.c"]
        assert (below.license, below.license_dir) == (name, f"full/{name}")
        full = dict(files)[f"full/{name}/LICENSE"]
        assert abs(out[f"full/{name}/LICENSE"].cosine - cosine(full, block_templates()[name][0], [t for _, t in files])) < 2e-6
    assert all(out[p].own_license is None for p in ("p/x.txt", "p/y.c", "p/z", "p/e"))


def test_long_leading_block(spark):
    df = spark.createDataFrame([("a.py", "# word\n" * 100_000 + "x = 1"), ("b", "line of text\n" * 100_000)], "path string, text string")
    assert [r.license for r in scan_licenses(df, "path").collect()] == [None, None]
