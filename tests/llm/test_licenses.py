import math
import os
import re
from collections import Counter

import pytest

from logloom.llm.licenses import TEMPLATES, read_templates, scan_licenses

FULL_TEXTS = "/usr/share/common-licenses"


def plain(rows, least=0.6, given=TEMPLATES):
    """{path: (license, cosine, from)} of rows (path, text), every segment against every template."""
    split = lambda t: [w for w in re.split("[^a-z0-9]+", t.lower()) if w]
    texts = {(p, t) for p, t in rows if t is not None}
    vocabulary = {w for _, t in given for w in split(t)}
    sets = [set(split(t)) for _, t in texts]
    df = {w: sum(w in s for s in sets) for w in vocabulary}
    idf = lambda w: math.log((len(texts) + 1) / (df.get(w, 0) + 1)) + 1
    vector = lambda ws: {w: n * idf(w) for w, n in Counter(ws).items()}
    length = lambda v: math.sqrt(sum(x * x for x in v.values()))
    templates = [(n, vector(split(t))) for n, t in given]

    def best(segments):
        found = []
        for s in segments:
            v = vector(split(s))
            found += [(-round(sum(x * t.get(w, 0) for w, x in v.items()) / length(v) / length(t), 6), n) for n, t in templates if v]
        top = min(found, default=(0, None))
        return (top[1], -top[0]) if -top[0] >= least else None

    own = {(p, t): best([t, *t.split("\n")]) for p, t in texts}
    notices = {}
    for p, t in texts:
        if p is not None and (b := best([t])):
            d = p.rpartition("/")[0]
            notices[d] = min(notices.get(d, (1, "", "")), (-b[1], b[0], p))
    out = {}
    for p, t in rows:
        hit = own.get((p, t))
        out[p, t] = (hit[0], hit[1], p) if hit else (None, None, None)
        d = p
        while not hit and d:
            d = d.rpartition("/")[0]
            if d in notices:
                out[p, t] = (notices[d][1], -notices[d][0], notices[d][2])
                break
    return out


def check(spark, rows, given=TEMPLATES):
    from pyspark.sql import functions as F
    files = spark.createDataFrame(rows, "path string, text string").withColumns({c: F.lit("x") for c in ("w", "segment", "idf", "depth", "notice", "own", "_own", "_dir", "_id", "_row", "a.b")})
    found = scan_licenses(files, given).collect()
    assert all(r[c] == "x" for r in found for c in ("_own", "_dir", "_id", "_row", "a.b"))
    assert len(found) == len(rows)
    want = plain(rows, given=given)
    for r in found:
        name, cosine, source = want[r.path, r.text]
        assert (r.license, r.license_from) == (name, source), r
        assert cosine is None and r.cosine is None or abs(r.cosine - cosine) < 2e-6
    return {(r.path, r.text): r for r in found}


def test_nearest_ancestor_and_own_headers(spark):
    mit = TEMPLATES[3][1]
    rows = [
        ("LICENSE", "Licensed under CC BY-NC 4.0."), ("a/LICENSE", mit), ("a/b/c/COPYING", "This work is licensed under the GNU General Public License, version 3"),
        ("a/x.py", "print(1)"), ("a/b/y.py", "code of the work"), ("a/b/c/z.py", "some text"), ("a/b/c/own.py", "# Licensed under the Apache License, Version 2.0.\ncode " * 3),
        ("ab/q.py", "nothing here"), ("top.py", "nothing"), (None, "nothing"), (None, "Released under the MIT License."), ("a/null", None), ("a/empty", ""),
        ("a/x.py", "print(1)"), ("long", "filler words " * 100_000 + "\nReleased under the MIT License.\n" + "more filler " * 1000),
    ]
    found = check(spark, rows)
    assert found["a/b/y.py", "code of the work"].license_from == "a/LICENSE"
    assert found["a/b/c/z.py", "some text"].license == "GPL-3.0" and found["ab/q.py", "nothing here"].license == "CC-BY-NC-4.0"
    assert found["long", rows[-1][1]].license == "MIT" and found[None, "nothing"].license is None


def test_lines_near_a_template(spark):
    rows = [(f"d{k}/f", t) for k, t in enumerate([
        "licensed under the apache license", "licensed license", "the the the of", "This work is licensed under the General Public License", "MIT",
        "released under the BSD license", "version 2.0 of the apache thing", "work of the general public version 3 gnu"])]
    check(spark, rows + [(f"e{k}/f", "the of and work under this") for k in range(30)])


def test_whole_licence_files_give_their_licence_below(spark):
    """A licence file as it is found (holder, line breaks) gives its own licence to the code below it."""
    rows = []
    for name, text in TEMPLATES:
        if len(text) > 600:
            folded = re.sub("((?:\\S+ ){9}\\S+) ", "\\1\n", text)
            rows += [(f"{name}/LICENSE", f"Copyright 2019 Some Holder\n\n{folded}\n"), (f"{name}/src/code.py", f"def {name.lower()[:3]}(): return 1")]
    found = check(spark, rows + [(f"d/{k}", f"plain words number {k}") for k in range(40)])
    below = {p: r.license for (p, _), r in found.items() if p.endswith(".py")}
    assert below == {f"{n}/src/code.py": n for n in ("MIT", "BSD-3-Clause", "ISC")}


@pytest.mark.skipif(not os.path.isdir(FULL_TEXTS), reason="no licence texts on this machine")
def test_templates_read_from_a_folder(spark):
    names = [n for n in ("Apache-2.0", "GPL-2", "GPL-3", "LGPL-2.1", "MPL-2.0") if os.path.isfile(f"{FULL_TEXTS}/{n}")]
    read = read_templates(spark, *(f"{FULL_TEXTS}/{n}" for n in names))
    assert [n for n, _ in read] == sorted(names)
    rows = [(f"{n}/COPYING", f"This is project {n}, by its holders.\n\n{t}") for n, t in read] + [(f"{n}/a/b.c", f"int {n[:3]};") for n, _ in read]
    found = check(spark, rows + [(f"d/{k}", f"the words of a text, to be or not {k}") for k in range(60)], TEMPLATES + read)
    assert {p: r.license for (p, _), r in found.items() if p.endswith(".c")} == {f"{n}/a/b.c": n for n in names}
    with pytest.raises(ValueError):
        scan_licenses(spark.createDataFrame(rows[:1], "path string, text string"), [("x", " ".join(f"w{k}" for k in range(20_001)))])


def test_empty_table(spark):
    assert scan_licenses(spark.createDataFrame([], "path string, text string")).collect() == []
