import collections
import math
import os
import re

from fixtures import frame

from shardloom.llm import licenses
from shardloom.llm.queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
FILES = "path string, text string"
APACHE = licenses.TEMPLATES["Apache-2.0"]
MIT = licenses.TEMPLATES["MIT"]


def plain_cosine(unit):
    """The best template of one line or text, and its cosine."""
    counts = {n: collections.Counter(re.findall("[a-z0-9]+", t.lower())) for n, t in licenses.TEMPLATES.items()}
    df = collections.Counter(t for c in counts.values() for t in c)
    weight = lambda t: math.log((1 + len(counts)) / (1 + df[t])) + 1
    vector = lambda c: {t: n * weight(t) for t, n in c.items()}
    line = vector(collections.Counter(re.findall("[a-z0-9]+", unit.lower())))
    size = math.sqrt(sum(w * w for w in line.values()))
    best = (0.0, None)
    for name in sorted(counts):
        v = vector(counts[name])
        dot = sum(w * v.get(t, 0.0) for t, w in line.items())
        c = round(dot / size / math.sqrt(sum(w * w for w in v.values())), 6) if size else 0.0
        best = max(best, (c, name), key=lambda x: x[0])
    return best


def plain_scan(files):
    own = {}
    for k, (path, text) in enumerate(files):
        named = path is not None and re.match(licenses.LICENCE_FILE, path.split("/")[-1])
        units = (text or "").split("\n") + ([text or ""] if named else [])
        hits = [h for h in map(plain_cosine, units) if h[0] >= licenses.THRESHOLD]
        own[k] = (min(hits, key=lambda h: (-h[0], h[1])) if hits else None, named)
    held = {}
    for k, (path, _) in enumerate(files):
        hit, named = own[k]
        if named and hit:
            folder = path.rpartition("/")[0]
            held[folder] = min([hit, *([held[folder]] if folder in held else [])], key=lambda h: (-h[0], h[1]))
    out = []
    for k, (path, text) in enumerate(files):
        hit, _ = own[k]
        if hit:
            out.append((path, hit[1], hit[0], "header", None))
            continue
        folder, found = (path or "").rpartition("/")[0], None
        while path is not None:
            if folder in held:
                found = folder
                break
            if not folder:
                break
            folder = folder.rpartition("/")[0]
        out.append((path, held[found][1], held[found][0], "directory", found) if found is not None else (path, None, None, None, None))
    return out


def test_files_and_folders(spark):
    files = [
        ("LICENSE", MIT),
        ("a/x.py", "no header\nat all"),
        ("a/b/LICENSE.txt", f"{APACHE}\nSee the file."),
        ("a/b/c/d/y.py", "print(1)"),
        ("a/b/c/z.py", "# released under the mit license"),
        ("a/bb/y.py", ""),
        ("a/b", None),
        (None, APACHE),
        (None, None),
        ("e/COPYING", "nothing known"),
        ("e/f/w.c", "This software is free"),
        ("e/f/w.c", "This software is free"),
        ("g/LICENSE", MIT),
        ("g/LICENSE-2", APACHE),
        ("g/h.py", "x" * 200_000),
        ("/abs/LICENSE", MIT),
        ("/abs/q.py", "LICENSED UNDER CC BY 4.0"),
        ("/abs/r.py", "licence unknown"),
    ]
    docs = frame(spark, files, FILES).selectExpr("*", "'x' AS licence", "1 AS folder", "2 AS own")
    out = licenses.scan(docs)
    assert out.columns == ["path", "text", "folder", "own", "licence", "cosine", "via", "licence_directory"]
    got = collections.Counter(tuple(r[c] for c in ("path", "licence", "cosine", "via", "licence_directory")) for r in out.collect())
    assert got == collections.Counter(plain_scan(files))
    assert licenses.scan(docs.limit(0)).count() == 0


def test_query_equals_the_plain_version(spark):
    rows = QUERIES["op5_licenses"](spark, FOLDER).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    rows.sort(key=lambda r: r["doc_id"])
    want = plain_scan([(r["path"], texts[r["doc_id"]]) for r in rows])
    assert [tuple(r)[1:] for r in rows] == want
    assert any(r["via"] == "header" for r in rows)


def test_the_quick_bound_loses_nothing(spark):
    space = licenses.Space()
    lines = [*licenses.TEMPLATES.values(), "", "the of and", "mit", "under the license", "gnu general public"]
    lines += [" ".join(t.split()[k:]) for t in licenses.TEMPLATES.values() for k in range(1, 6)]
    df = frame(spark, [(x,) for x in lines], "t string")
    from pyspark.sql import functions as F

    for r in df.withColumn("may", space.reachable(F.lower("t"))).collect():
        assert r["may"] or plain_cosine(r["t"])[0] < licenses.THRESHOLD
