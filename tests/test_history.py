"""Policies in time: versions, how long grants held, which version a row falls under."""

import bisect
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wardline.operators import history
from wardline.operators.decide import match_grants
from wardline.operators.delta import changed_grants, touched_statements
from wardline.operators.history import as_of, grant_history, number_versions
from wardline.plans.governance import Governance
from wardline.sources.policies import load_history, save_version, write_versions

START = datetime(2024, 1, 1)


def versions_at(spark, times):
    return number_versions(spark.createDataFrame([(t,) for t in times], "valid_from timestamp"))


@pytest.mark.parametrize("broadcast", [True, False])
def test_as_of_equals_bisection(spark, monkeypatch, broadcast):
    r = random.Random(4)
    # Most changes fall in a few minutes of a year; some statements fall on a change to the microsecond.
    changes = sorted({START + timedelta(days=r.randrange(365)) for _ in range(20)} | {START + timedelta(days=100, seconds=r.randrange(300), microseconds=r.randrange(5)) for _ in range(200)})
    times = [START + timedelta(days=r.randrange(-20, 400), microseconds=r.randrange(10**6)) for _ in range(300)] + r.sample(changes, 100) + [changes[0], changes[-1], None]
    times += [START + timedelta(days=100, seconds=r.randrange(300), microseconds=r.randrange(5)) for _ in range(300)]
    log = spark.createDataFrame(list(enumerate(times)), "id long, ts timestamp")
    versions = versions_at(spark, [*changes, *changes[:5], None])
    assert [x.version for x in versions.orderBy("valid_from").collect()] == list(range(1, len(changes) + 1))
    if not broadcast:
        monkeypatch.setattr(history, "fits", lambda df: False)
    found = {x.id: x.version for x in as_of(log, versions).collect()}
    assert found == {k: (bisect.bisect_right(changes, t) or None) if t else None for k, t in enumerate(times)}


def test_dense_changes_get_fine_buckets(spark):
    dense = versions_at(spark, [START + timedelta(seconds=k) for k in range(500)] + [START + timedelta(days=30)])
    even = versions_at(spark, [START + timedelta(days=k) for k in range(30)])
    length = 30 * 86_400 * 10**6
    begin = dense.agg(F.min(F.unix_micros("valid_from"))).first()[0]
    assert history._width(dense, begin, length) < length // 10_000 and history._width(even, begin, length) == length // 64


def test_no_or_one_version(spark):
    log = spark.createDataFrame([(1, START), (2, START - timedelta(1)), (3, None)], "id long, ts timestamp")
    none = spark.createDataFrame([], "valid_from timestamp")
    assert {x.version for x in as_of(log, number_versions(none)).collect()} == {None}
    assert {x.id: x.version for x in as_of(log, versions_at(spark, [START])).collect()} == {1: 1, 2: None, 3: None}


def test_runs_of_versions(spark):
    times = [START + timedelta(days=k) for k in range(5)]
    held = {"a": [0, 1, 2, 3, 4], "b": [1, 3, 4], "c": [0], "d": [0, 1, 3], "e": [2, 2]}
    rows = [(user, "d", None, None, None, "select", times[k]) for user, ks in held.items() for k in ks]
    snapshots = spark.createDataFrame(rows, "user_name string, db string, tbl string, col string, udf string, access string, valid_from timestamp")
    found = sorted((x.user_name, x.since, x.until) for x in grant_history(snapshots, versions_at(spark, times)).collect())
    assert found == [("a", 1, None), ("b", 2, 3), ("b", 4, None), ("c", 1, 2), ("d", 1, 3), ("d", 4, 5), ("e", 3, 4)]


def test_verdicts_follow_the_versions(spark, tables, tmp_path):
    folder = str(tmp_path / "versions")
    grant = {"db": "d", "tbl": "s", "access": "select"}
    save_version(tables.grants(grant), folder, START)
    save_version(tables.grants(), folder, START + timedelta(hours=1))
    save_version(tables.grants({**grant, "user_name": "bob"}), folder, START + timedelta(hours=2))
    save_version(tables.grants({**grant, "tbl": "other"}), folder, START + timedelta(hours=2))  # replaces the one before
    write_versions(tables.grants(grant, {**grant, "user_name": "bob"}).withColumn("valid_from", F.lit(START + timedelta(hours=3))), folder)
    versions, held = load_history(spark, folder)
    assert versions.count() == 4
    stmts = tables.statements(*[{"command": "Query", "ts": START + timedelta(minutes=m), "user_name": u} for m in (-1, 0, 59, 60, 121, 180) for u in ("ann", "bob")])
    rels = tables.relations(*[{"stmt_id": k} for k in range(12)])
    for sizes in ({}, {"limit": 0}, {"tries": 0}):
        verdicts = Governance(stmts, rels, tables.inventory(), held, versions=versions, **sizes).verdicts
        allowed = [r.stmt_id for r in verdicts.orderBy("stmt_id").collect() if r.allowed]
        assert allowed == [2, 4, 10, 11], sizes
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        load_history(spark, str(tmp_path / "none"))


def test_a_history_needs_versions(spark, tables):
    reqs = spark.createDataFrame([("ann", "SELECT", "TABLE", "d", "t", None, None)], "user_name string, access string, object_type string, database string, table string, udf string, column string")
    with pytest.raises(ValueError, match="version"):
        match_grants(reqs, tables.grants().withColumns({"since": F.lit(1), "until": F.lit(None).cast("long")}))


def test_only_what_a_change_speaks_of_is_judged_again(spark, tables):
    r = random.Random(13)
    pattern = lambda: {"user_name": r.choice(["ann", "bob", "eve"]), "db": r.choice(["d", "d*"]), "tbl": r.choice(["t*", "t1", "t2", "*", "u"]), "col": r.choice(["*", "a", None]), "access": r.choice(["select", "drop"])}
    rows = [pattern() for _ in range(14)]
    stmts = tables.statements(*[{"command": r.choice(["Query", "DropTableCommand", "SetCommand"]), "user_name": r.choice(["ann", "bob", "eve"]), "tbl": r.choice(["t1", "t2", "u"])} for _ in range(120)])
    rels = tables.relations(*[{"stmt_id": k, "tbl": r.choice(["t1", "t2", "u"]), "projected": [r.choice("ab")]} for k in range(120)])
    before, after = tables.grants(*rows[:10], rows[0]), tables.grants(*rows[2:12], rows[3])
    inv = tables.inventory()
    old = Governance(stmts, rels, inv, before).verdicts
    # What is carried over is told by its message.
    marked = old.withColumn("message", F.concat(F.lit("kept"), F.coalesce("message", F.lit(""))))
    for sizes in ({}, {"limit": 0}):
        now = Governance(stmts, rels, inv, after, **sizes)
        wanted = {x.stmt_id: x for x in now.verdicts.collect()}
        found = now.verdicts_after(marked, before).collect()
        again = {x.stmt_id for x in touched_statements(now.requests, before, after, **sizes).collect()}
        assert len(found) == 120 and 0 < len(again) < 120
        for x in found:
            assert x.allowed == wanted[x.stmt_id].allowed
            assert x.message == (wanted[x.stmt_id].message if x.stmt_id in again else "kept" + (wanted[x.stmt_id].message or ""))
    assert changed_grants(before, before).collect() == [] and changed_grants(before, tables.grants(*rows[:10])).collect() == []


def test_other_grants_are_asked_the_same_stored_requests(spark, tables):
    stmts = tables.statements({"command": "Query"}, {"command": "Query", "user_name": "bob"}, {"command": "DropTableCommand"})
    rels, inv = tables.relations({"tbl": "t1", "projected": ["a"]}, {"stmt_id": 1, "tbl": "t2", "projected": ["a", "b"]}), tables.inventory()
    before, after = tables.grants({"db": "d", "tbl": "t1", "access": "select"}), tables.grants(*[{"user_name": "bob", "db": "d", "access": "select"}] * 3)
    for sizes in ({}, {"limit": 0}):
        then = Governance(stmts, rels, inv, before, **sizes).stored()
        now = then.under(after)
        assert now.requests is then.requests and len(now.requests.inputFiles()) > 0
        wanted = {g: sorted(Governance(stmts, rels, inv, x, **sizes).verdicts.collect()) for g, x in (("before", before), ("after", after))}
        assert sorted(then.verdicts.collect()) == wanted["before"] != wanted["after"] == sorted(now.verdicts.collect())
        assert sorted(now.verdicts_after(then.verdicts, before).collect()) == wanted["after"]
        assert now.requests is then.requests


def test_packed_versions_hold_every_snapshot(spark, tables, tmp_path):
    r, folder = random.Random(5), str(tmp_path / "versions")
    times = [START + timedelta(hours=k) for k in range(520)]
    # Users whose grant stands always, in every other version, in two of three, in one stretch, and at random; one repeats.
    stands = {"ann": lambda k: True, "bob": lambda k: k % 2 == 0, "cat": lambda k: k % 3 != 1, "dan": lambda k: 200 <= k < 300, "eve": lambda k: r.random() < 0.5}
    held = {u: {k for k in range(520) if f(k)} for u, f in stands.items()}
    schema = "user_name string, db string, tbl string, col string, udf string, access string, valid_from timestamp"
    listed = [(u, "d", "t*", None, None, "select", times[k]) for u, ks in held.items() for k in ks for _ in range(2 if u == "ann" else 1)]
    write_versions(spark.createDataFrame(listed, schema).repartition(3), folder, spark.createDataFrame([(t,) for t in [*times, times[-1] + timedelta(1)]], "valid_from timestamp"))
    # A line for each grant and block of versions, not for each version: 5 grants, at most 3 blocks.
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(f"{folder}/packed/policies").count()
    assert lines <= 15 and not list((tmp_path / "versions").glob("valid_from_us=*"))

    def check():
        versions, grants = load_history(spark, folder)
        number = {x.valid_from: x.version for x in versions.collect()}
        assert sorted(number) == times and versions.where("valid_to IS NULL").count() == 1
        asked = [(u, number[times[k]], k, "SELECT", "TABLE", "d", "t1") for u in held for k in r.sample(range(520), 60) + [0, 255, 256, 257, 518, 519]]
        reqs = spark.createDataFrame(asked, "user_name string, version long, k long, access string, object_type string, database string, table string").withColumns({c: F.lit(None).cast("string") for c in ("udf", "column")})
        for sizes in ({}, {"limit": 0}):
            wrong = [x for x in match_grants(reqs, grants, **sizes).collect() if x.allowed != (x.k in held[x.user_name])]
            assert wrong == [], sizes
        assert {x.user_name for x in grants.where("until IS NULL").collect()} == {u for u in held if 519 in held[u]}

    check()
    # Written again, in a pack and alone, versions replace what they were.
    write_versions(spark.createDataFrame([("dan", "d", "t*", None, None, "select", t) for t in times[250:260]], schema), folder)
    save_version(tables.grants({"user_name": "bob", "db": "d", "tbl": "t*", "access": "select"}), folder, times[255])
    for u in held:
        held[u] = held[u] - set(range(250, 260)) | {"dan": set(range(250, 260)) - {255}, "bob": {255}}.get(u, set())
    check()
    with pytest.raises(Exception, match="not given"):
        write_versions(spark.createDataFrame(listed[:1], schema), folder, spark.createDataFrame([(times[1] + timedelta(1),)], "valid_from timestamp").where("false"))
