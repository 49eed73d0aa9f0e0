"""Grant matching in both ways, against the rules applied pair by pair in Python."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.operators.decide import (
    answer_by_broadcast,
    answer_by_shuffle,
    broadcastable,
    compile_grants,
    match_grants,
    measure_grants,
    with_question,
)

USERS = ["ann", "bob", None]
DBS, TABLES = ["d", "dd", "e"], ["t", "ta", "tab", "u"]
COLUMNS, UDFS = ["a", "ab", "b", "a_b"], ["f", "fa", "g"]
ACCESSES = ["select", "update", "admin", "drop"]

REQUESTS = T.StructType(
    [T.StructField("id", T.IntegerType())]
    + [
        T.StructField(c, T.StringType())
        for c in ("user_name", "access", "object_type", "database", "table", "udf", "column")
    ]
)


def _pattern(rng, names):
    name = rng.choice(names)
    return rng.choice([name, name, "*", name[: rng.randint(0, len(name))] + "*"])


def _grants(rng, count):
    rows = []
    for _ in range(count):
        row = {"user_name": rng.choice(USERS), "db": _pattern(rng, DBS), "access": rng.choice(ACCESSES)}
        if rng.random() < 0.25:
            row["udf"] = _pattern(rng, UDFS)
        else:
            row["tbl"] = rng.choice([None, _pattern(rng, TABLES), _pattern(rng, TABLES)])
            row["col"] = rng.choice([None, _pattern(rng, COLUMNS), _pattern(rng, COLUMNS)])
        rows.append(row)
    return rows


def _requests(rng, count):
    rows = []
    for i in range(count):
        kind = rng.choice(["DATABASE", "TABLE", "VIEW", "COLUMN", "FUNCTION"])
        access = rng.choice(["USE", "ADMIN", "SELECT", "UPDATE", "DROP"])
        db = rng.choice([*DBS, "*"]) if kind == "DATABASE" else rng.choice(DBS)
        table = rng.choice(TABLES) if kind in ("TABLE", "VIEW", "COLUMN") else None
        udf = rng.choice(UDFS) if kind == "FUNCTION" else None
        column = rng.choice(COLUMNS) if kind == "COLUMN" else None
        # Half of the log belongs to one user.
        user = "ann" if rng.random() < 0.5 else rng.choice(USERS)
        rows.append((i, user, access, kind, db, table, udf, column))
    return rows


def _fits(pattern, value):
    pattern = "*" if pattern is None else pattern
    return value.startswith(pattern[:-1]) if pattern.endswith("*") else value == pattern


def _covers(grant, request):
    _, user, access, kind, db, table, udf, column = request
    if user is None or grant.get("user_name") != user:
        return False
    any_access = access == "USE"
    if not any_access and grant["access"] != access.lower():
        return False
    on_function, in_db = grant.get("udf") is not None, _fits(grant["db"], db)
    whole_table = grant.get("col") in (None, "*")
    if kind == "FUNCTION":
        return on_function and in_db and _fits(grant["udf"], udf)
    if kind == "DATABASE":
        if any_access:
            return in_db or db == "*"
        return not on_function and in_db and whole_table and grant.get("tbl") in (None, "*")
    if on_function or not in_db or not _fits(grant.get("tbl"), table):
        return False
    if kind == "COLUMN":
        return _fits(grant.get("col"), column)
    return any_access or whole_table


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_both_ways_agree_with_the_rules(spark, tables, seed):
    rng = random.Random(seed)
    grants, requests = _grants(rng, 25), _requests(rng, 400)
    wanted = {r[0]: any(_covers(g, r) for g in grants) for r in requests}
    assert len(set(wanted.values())) == 2
    reqs, facts = spark.createDataFrame(requests, REQUESTS), compile_grants(tables.grants(*grants))
    for answer in (answer_by_broadcast, answer_by_shuffle):
        found = answer(with_question(reqs), facts).select("id", "allowed").collect()
        assert len(found) == len(requests)
        assert dict(found) == wanted


def test_the_way_follows_the_measure(spark, tables):
    rng = random.Random(7)
    reqs = spark.createDataFrame(_requests(rng, 50), REQUESTS)
    grants = tables.grants(*_grants(rng, 40))
    small, by_bytes, by_tries = (match_grants(reqs, grants, **s) for s in ({}, {"limit": 1}, {"tries": 1}))
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "ExistenceJoin" in plan(small)
    assert "ExistenceJoin" not in plan(by_bytes) and "ExistenceJoin" not in plan(by_tries)
    answers = [sorted(df.select("id", "allowed").collect()) for df in (small, by_bytes, by_tries)]
    assert answers[0] == answers[1] == answers[2]


def test_measure_bounds_bytes_and_tries(tables):
    open_rows = [{"db": "d", "tbl": f"t{i}*", "access": "select"} for i in range(30)]
    exact_rows = [{"db": "d", "tbl": f"t{i}", "col": "*", "access": "select"} for i in range(300)]
    size = measure_grants(tables.grants(*open_rows, *exact_rows))
    assert 30 <= size.tries <= 31
    facts = compile_grants(tables.grants(*open_rows, *exact_rows))
    text = facts.select(F.sum(F.length(F.concat_ws("", *facts.columns)))).first()[0]
    assert size.bytes >= text
    assert broadcastable(tables.grants(*exact_rows)) and not broadcastable(tables.grants(*open_rows), tries=20)


def test_no_grants_allow_nothing(spark, tables):
    reqs = spark.createDataFrame(_requests(random.Random(3), 20), REQUESTS)
    assert {r.allowed for r in match_grants(reqs, tables.grants()).collect()} == {False}


def test_more_grants_never_deny(spark, tables):
    rng = random.Random(11)
    rows, reqs = _grants(rng, 30), spark.createDataFrame(_requests(rng, 200), REQUESTS)
    few, many = (
        dict(match_grants(reqs, tables.grants(*rows[:n])).select("id", "allowed").collect()) for n in (10, 30)
    )
    assert all(many[i] for i, allowed in few.items() if allowed)
    assert sum(many.values()) > sum(few.values())


def _many_patterns(rng, count):
    """Grants of one user, nearly all of them patterns, below one database and many tables."""
    rows = [{"user_name": "ann", "db": rng.choice(["d", "d*", "e"]), "tbl": f"t{k}*", "col": rng.choice(["*", "a*", "b", None]), "access": "select"} for k in range(count)]
    return rows + [{"user_name": "ann", "db": "d", "tbl": "x*", "col": f"c{k}*", "access": "select"} for k in range(50)]


def _asked_tables(rng, count):
    names = [f"t{rng.randrange(count * 2)}{rng.choice(['', '_x'])}" for _ in range(300)] + ["x1", "y"]
    return [(k, "ann", "SELECT", rng.choice(["TABLE", "COLUMN"]), rng.choice(["d", "dd", "e", "f"]), t, None, rng.choice(["a", "ab", "b", "c7", "c700"])) for k, t in enumerate(names)]


def _by_prefixes(grants, requests):
    """Who is allowed what, by looking up the grants of each prefix of the table."""
    by_table = {}
    for g in grants:
        by_table.setdefault(g["tbl"][:-1], []).append(g)
    return {r[0]: any(_covers(g, r) for n in range(len(r[5]) + 1) for g in by_table.get(r[5][:n], [])) for r in requests}


def test_ten_thousand_patterns_of_one_user(spark, tables):
    rng = random.Random(21)
    grants, requests = _many_patterns(rng, 10_000), _asked_tables(rng, 10_000)
    wanted = _by_prefixes(grants, requests)
    assert 50 < sum(wanted.values()) < 250
    reqs, held = spark.createDataFrame(requests, REQUESTS), tables.grants(*grants)
    assert not broadcastable(held)
    assert dict(match_grants(reqs, held).select("id", "allowed").collect()) == wanted


def test_the_walk_meets_only_children_of_nodes_it_reached(spark, tables):
    """What a join of the walk puts out does not grow with the patterns a user has elsewhere."""
    requests = spark.createDataFrame([(0, "ann", "SELECT", "COLUMN", "d", "t5_x", None, "a")], REQUESTS)
    most = []
    for count in (100, 3000):
        grants = tables.grants(*[{"db": "d", "tbl": f"t{k}*", "col": "a*", "access": "select"} for k in range(count)], *[{"db": f"e{k}*", "tbl": f"{'u' * (k % 40)}*", "access": "select"} for k in range(count)])
        answered = match_grants(requests, grants, limit=0)
        assert [r.allowed for r in answered.collect()] == [True]
        nodes, rows = [answered._jdf.queryExecution().executedPlan()], []
        while nodes:
            node = nodes.pop()
            if hasattr(node, "finalPhysicalPlan") and "AdaptiveSparkPlan" in node.getClass().getSimpleName():
                nodes.append(node.finalPhysicalPlan())
                continue
            children, metrics = node.children(), node.metrics()
            nodes += [children.apply(k) for k in range(children.size())]
            if "QueryStage" in node.getClass().getSimpleName():
                nodes.append(node.plan())
            if "Join" in node.getClass().getSimpleName() and metrics.contains("numOutputRows"):
                rows.append(metrics.apply("numOutputRows").value())
        most.append(max(rows))
    assert most[0] == most[1] <= 10
