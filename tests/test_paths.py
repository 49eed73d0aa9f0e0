"""Path access against the rules applied file by file in Python."""

import fnmatch
import random
import re

import pytest

from wardline.operators import paths
from wardline.operators.paths import uri_access

ROOT = "hdfs://n/data"


def _files(rng):
    found = {}
    for _ in range(40):
        parts = [rng.choice(["a", "ab", "b.c", "day=1", "day=12"]) for _ in range(rng.randint(1, 3))]
        found["/".join([ROOT, *parts, f"f{rng.randint(0, 5)}"])] = (rng.choice(["u1", "u2"]), rng.choice(["NONE", "READ", "ALL", "ALL"]))
    found[f"{ROOT}/a"] = ("u1", "READ")
    return [(path, owner, others) for path, (owner, others) in found.items()]


def _permits(file, user, action):
    return file[1] == user or file[2] == "ALL" or (action == "READ" and file[2] == "READ")


def _wanted(files, path, user, action):
    if action == "NONE":
        return True
    path = path.rstrip("/")
    braces = re.search(r"\{(.*)\}", path)
    names = [path.replace(braces.group(0), name) for name in braces.group(1).split(",")] if braces else [path]

    def matches(node):
        return any(
            len(node.split("/")) == len(name.split("/"))
            and all(fnmatch.fnmatchcase(a, b) for a, b in zip(node.split("/"), name.split("/")))
            for name in names
        )

    below = []
    for file in files:
        parts = file[0].split("/")
        if any(matches("/".join(parts[:n])) for n in range(1, len(parts) + 1)):
            below.append(file)
    if below:
        return all(_permits(f, user, action) for f in below)
    parents = [f for f in files if path.startswith(f[0] + "/")]
    return bool(parents) and _permits(max(parents, key=lambda f: len(f[0])), user, action)


PATHS = [
    "/a", "/a/", "/ab", "/a/ab", "/b.c", "/b?c", "/a*", "/*", "/*/f1", "/a/*/f?", "/day=[1]*", "/day=[!1]*", "/{a,b.c}/f1",
    "/day=1", "/day=1*/f0", "/a/f0/deep/er", "/a/none", "/none", "/none*", "/ab/f3", "/b.c/a/f2",
]
OPS = {"LOAD": "READ", "QUERY": "ALL", "MSCK": "NONE"}


@pytest.mark.parametrize(("seed", "small"), [(1, True), (2, True), (2, False)])
def test_paths_agree_with_the_rules(spark, monkeypatch, seed, small):
    monkeypatch.setattr(paths, "fits", lambda df: small)
    files = _files(random.Random(seed))
    asked = [(i, ROOT + p, op, u) for i, (p, op, u) in enumerate((p, op, u) for p in PATHS for op in OPS for u in ("u1", "u2", "u3"))]
    found = uri_access(
        spark.createDataFrame(asked, "id int, path string, op string, user_name string"),
        spark.createDataFrame(files, "path string, owner string, others_action string"),
    )
    got = {r.id: r.allowed for r in found.collect()}
    wanted = {i: _wanted(files, path, user, OPS[op]) for i, path, op, user in asked}
    assert {asked[i][1:]: a for i, a in got.items() if a != wanted[i]} == {}
    assert got.keys() == wanted.keys() and set(wanted.values()) == {True, False}


def test_denial_text_and_schemes(spark):
    asked = [("hdfs://n/x", "LOAD", "u"), ("s3://n/x", "LOAD", "u"), ("", "LOAD", "u"), (None, "LOAD", "u")]
    named = spark.createDataFrame(asked, "path string, op string, user_name string")
    files = spark.createDataFrame([], "path string, owner string, others_action string")
    rows = uri_access(named, files).collect()
    assert [(r.path, r.allowed, r.message) for r in rows] == [
        ("hdfs://n/x", False, "Permission denied: user [u] does not have [READ] privilege on [hdfs://n/x]")
    ]
    assert [r.path for r in uri_access(named, files, schemes=["s3:"]).collect()] == ["s3://n/x"]


OPEN = ["/a/b/f", "/a/zz/q/f", "/a/q/f", "/a/z/f", "/q/a*b", "/q/axb", "/a/b,c)d", "/s/x^y", "/s/x]y", "/s/a-b", "/e/{k}"]


@pytest.mark.parametrize(
    ("path", "allowed"),
    [
        ("/a/[b", False), ("/a/{b", False), ("/a/b\\", False), ("/a/[]", False), ("/a/{b,[q}/f", False),
        ("/a/{b,zz/q}/f", True), ("/a/{b,{q,z}}/f", True), ("/q/a\\*b", True), ("/a/b,c)*", True), ("/a/{b,none}/f", True),
        ("/s/x[^a]y", True), ("/s/x[!\\]^]y", False), ("/s/x[\\]a]y", True), ("/s/x\\]y", True), ("/s/a[-]b", True), ("/e/\\{k\\}", True), ("/e/{k}", False),
        ("/a/{none,other}/f", False), ("/a/[a-c]/f", True), ("/a/[!a-c]/f", True), ("/q/a?b", True), ("/a/?/f", True), ("/none/{a,b}", False),
    ],
)
def test_globs(spark, path, allowed):
    """Escapes, sets, nested braces and braces with slashes; one broken glob fails alone."""
    files = spark.createDataFrame([(f"hdfs:{p}", "u", "ALL") for p in OPEN], "path string, owner string, others_action string")
    paths = spark.createDataFrame([(f"hdfs:{path}", "LOAD", "v"), ("hdfs:/a/b/f", "LOAD", "v")], "path string, op string, user_name string")
    assert [r.allowed for r in uri_access(paths, files).collect()][0:2].count(True) == allowed + 1
