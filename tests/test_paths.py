"""Path expressions on awkward paths, against literal values and the standard library."""

from __future__ import annotations

import posixpath

import pytest
from pyspark.sql import functions as F

from filelens.functions import paths as P

# Literal expectations: path, name, id, folder, extension, older id, older folder, archive destination, pieces.
EXPECTED = [
    ("/a/b/c.png", "c.png", "c", "b", "png", "c", "b", "/a/b/c", 4),
    ("/a/b//c.jpg", "c.jpg", "c", "b", "jpg", "c", "", "/a/b//c", 5),
    ("a.tar.gz", "a.tar.gz", "a.tar", "", "gz", "tar", None, "a.tar", 1),
    ("/x/.bashrc", ".bashrc", ".bashrc", "x", "bashrc", "", "x", "/x/.bashrc", 3),
    ("/x/b.", "b.", "b", "x", "", "b", "x", "/x/b", 3),
    ("/x/..a.b", "..a.b", "..a", "x", "b", "a", None, "/x/..a", 3),
    ("/x/y/", "", "", "y", "/x/y/", None, None, "/x/y/", 4),
    ("noext", "noext", "noext", "", "noext", None, None, "noext", 1),
    ("/k=v/사진 1.JPEG", "사진 1.JPEG", "사진 1", "k=v", "JPEG", "사진 1", "k=v", "/k=v/사진 1", 3),
    ("/a.png/file", "file", "file", "a.png", "png/file", "a", "", "/a.png/file", 3),
    ("//double//slash//f.csv", "f.csv", "f", "slash", "csv", "f", "", "//double//slash//f", 7),
    ("/x/c.tar.gz", "c.tar.gz", "c.tar", "x", "gz", "tar", None, "/x/c.tar", 3),
    ("./rel/a.b.png", "a.b.png", "a.b", "rel", "png", "b", None, "./rel/a.b", 3),
    ("/x/_name.json", "_name.json", "_name", "x", "json", "_name", "x", "/x/_name", 3),
    ("/x/.hidden.json", ".hidden.json", ".hidden", "x", "json", "hidden", None, "/x/.hidden", 3),
    ("/", "", "", "", "/", None, None, "/", 2),
    ("a/b", "b", "b", "a", "a/b", None, None, "a/b", 2),
    ("/x/.", ".", ".", "x", "", "", "x", "/x/.", 3),
    ("/x/..", "..", "..", "x", "", "", None, "/x/..", 3),
    ("/a/b/c", "c", "c", "b", "/a/b/c", None, None, "/a/b/c", 4),
    ("https://h.example.com/en/25#top", "25#top", "25#top", "en", "com/en/25#top", "example", None, "https://h.example.com/en/25#top", 5),
    ("http://h/en/", "", "", "en", "http://h/en/", None, None, "http://h/en/", 5),
    ("x.y/z", "z", "z", "x.y", "y/z", "x", None, "x.y/z", 2),
    ("...", "...", "...", "", "", "", None, "...", 1),
    ("/a/.b.c.d", ".b.c.d", ".b.c", "a", "d", "c", None, "/a/.b.c", 3),
]
AWKWARD = [row[0] for row in EXPECTED]


@pytest.fixture(scope="module")
def derived(spark):
    df = spark.createDataFrame([(p,) for p in AWKWARD], "p string")
    rows = df.select(
        "p",
        P.file_name("p").alias("name"),
        P.file_id("p").alias("id"),
        P.folder_name("p").alias("folder"),
        P.extension("p").alias("ext"),
        P.file_id_legacy("p").alias("lid"),
        P.folder_legacy("p").alias("lfolder"),
        P.archive_dest("p").alias("dest"),
        P.path_depth("p").alias("depth"),
    ).collect()
    return {r.p: r for r in rows}


@pytest.mark.parametrize("row", EXPECTED, ids=AWKWARD)
def test_path_rules(derived, row):
    path, name, id_, folder, ext, legacy_id, legacy_folder, dest, depth = row
    r = derived[path]
    assert (r.name, r.id, r.folder, r.ext, r.lid, r.lfolder, r.depth) == (name, id_, folder, ext, legacy_id, legacy_folder, depth)
    if not path.endswith("/") and path not in ("/x/.", "/x/..", "..."):
        assert r.dest == dest


def test_strip_uri(spark):
    df = spark.createDataFrame([("file:/a/b c/사진.png",), ("file:///a/b",), ("hdfs://nn/x",)], "p string")
    got = [r[0] for r in df.select(P.strip_uri("p")).collect()]
    assert got == ["/a/b c/사진.png", "/a/b", "hdfs://nn/x"]


@pytest.mark.parametrize(
    "glob,path,hit",
    [
        ("/d/TS*", "/d/TS1", True),
        ("/d/TS*", "/d/TX1", False),
        ("/d/*", "/d/.hidden", False),
        ("/d/.*", "/d/.hidden", True),
        ("/d/*/x", "/d/a/x", True),
        ("/d/*", "/d/a/b", False),
        ("/d/f?.png", "/d/f1.png", True),
        ("/d/[ab]*", "/d/b1", True),
        ("/d/[!ab]*", "/d/b1", False),
        ("/d/[.]x", "/d/.x", False),
        ("/d/[!a]", "/d//", False),
    ],
)
def test_glob_to_regex(spark, glob, path, hit):
    import re

    pattern = "^" + P.glob_to_regex(glob) + "$"
    df = spark.createDataFrame([(path,)], "p string")
    assert df.select(F.col("p").rlike(pattern)).first()[0] is hit
    assert bool(re.match(pattern, path)) is hit
    assert py_glob_match(glob, path) is hit


def py_glob_match(pattern, path):
    """Python's glob rule: segment by segment fnmatch; a name starting with
    '.' only matches a pattern segment starting with '.'."""
    import fnmatch

    ps, xs = pattern.split("/"), path.split("/")
    if len(ps) != len(xs):
        return False
    for p, x in zip(ps, xs):
        if p == "" or x == "":
            if p != x:
                return False
            continue
        if not fnmatch.fnmatchcase(x, p) or (x.startswith(".") and not p.startswith(".")):
            return False
    return True


def test_random_globs_match_python_glob(spark):
    import random
    import re

    rng = random.Random(7)
    pieces = ["a", "b", ".", "*", "?", "[ab]", "[!a]", "[]a]", "[.]", "-"]
    names = ["a", "b", ".", "-", "]"]
    pairs = set()
    for _ in range(4000):
        segs = rng.randint(1, 3)
        pat = "/".join("".join(rng.choice(pieces) for _ in range(rng.randint(1, 3))) for _ in range(segs))
        path = "/".join("".join(rng.choice(names) for _ in range(rng.randint(1, 3))) for _ in range(segs))
        pairs.add(("/" + pat, "/" + path))
    rows = [(g, "^" + P.glob_to_regex(g) + "$", x) for g, x in sorted(pairs)]
    df = spark.createDataFrame(rows, "g string, rx string, x string")
    got = {(r.g, r.x): r.hit for r in df.selectExpr("g", "x", "x RLIKE rx AS hit").collect()}
    bad = [(g, x) for g, rx, x in rows
           if not (got[(g, x)] == bool(re.match(rx, x)) == py_glob_match(g, x))]
    assert not bad[:5]
    assert sum(got.values()) > 50  # the sample does contain matches


def test_random_paths_match_the_standard_library(spark):
    """5,000 random paths over an alphabet rich in '.', '/' and spaces."""
    import random

    rng = random.Random(20261202)
    alphabet = ["a", "b", ".", ".", "/", "/", " ", "한", "_", "-", "+", "="]
    paths = sorted({"".join(rng.choice(alphabet) for _ in range(rng.randint(1, 14))) for _ in range(5000)})
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    rows = df.select("p", P.file_name("p").alias("name"), P.file_id("p").alias("id"), P.folder_name("p").alias("folder")).collect()
    for r in rows:
        folder, name = posixpath.split(r.p)
        assert (r.name, r.id, r.folder) == (name, posixpath.splitext(name)[0], posixpath.split(folder)[1]), r.p
