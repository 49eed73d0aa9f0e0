"""Plans that must hold at scale: few exchanges, filters at the scan, hot keys split."""

import random
import re

import pytest
from pyspark.sql import functions as F

from wardline.operators.decide import answer_by_broadcast, compile_grants, decide, with_question
from wardline.operators.guards import number_tables, unfold, visible_ranges, visible_tables
from wardline.operators.objects import route_relations
from wardline.operators.paths import uri_access
from wardline.operators.sizing import fits, lookup, planned_bytes
from wardline.plans.governance import Governance


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def log(spark, tables, tmp_path_factory):
    """A log on files in which one statement holds a third of all relations."""
    base = str(tmp_path_factory.mktemp("log"))
    stmts = spark.range(3000).select(
        F.col("id").alias("stmt_id"), F.timestamp_seconds(F.col("id")).alias("ts"), F.lit("ann").alias("user_name"),
        F.lit("Query").alias("command"),
    )
    whole = tables.statements()
    missing = {f.name: F.lit(None).cast(f.dataType) for f in whole.schema.fields if f.name not in stmts.columns}
    stmts.withColumns(missing).select(whole.columns).write.parquet(f"{base}/s")
    rels = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 3000).alias("stmt_id"), F.col("id").cast("int").alias("ord"),
        F.lit("catalog").alias("kind"), F.lit("d").alias("db"), F.concat(F.lit("t"), F.col("id") % 500).alias("tbl"),
        F.lit(None).cast("string").alias("raw_name"), F.array(F.concat(F.lit("c"), F.col("id") % 7)).alias("projected"),
    )
    rels.repartition(8).write.parquet(f"{base}/r")
    return spark.read.parquet(f"{base}/s"), spark.read.parquet(f"{base}/r")


def _governed(tables, log):
    return Governance(*log, tables.inventory(), tables.grants({"db": "d", "tbl": "t1*", "access": "select"}))


def test_one_exchange_per_input_of_the_log(tables, log):
    plan = _plan(_governed(tables, log).verdicts)
    exchanges = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    # Relations, statements that read, statements with objects, and the statements the verdicts go to.
    assert exchanges == ["stmt_id"] * 4
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "BatchEvalPython" not in plan


def test_audit_reads_the_log_once(tables, log):
    audited = _governed(tables, log).audit
    assert audited.count() > 0
    audited.collect()
    final = _plan(audited).split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet \[stmt_id#\d+L,ord", final)) == 1
    assert "ReusedExchange [stmt_id" in final and "Window" not in final


def test_broadcast_answers_move_nothing(spark, tables):
    names = ("user_name", "access", "object_type", "database", "table", "udf", "column")
    reqs = spark.range(10).selectExpr("id", *[f"CAST(id AS STRING) AS {name}" for name in names])
    plan = _plan(answer_by_broadcast(with_question(reqs), compile_grants(tables.grants({"db": "d", "access": "select"}))))
    assert "hashpartitioning" not in plan and "NestedLoop" not in plan
    assert len(re.findall("BroadcastHashJoin.*ExistenceJoin", plan)) == 3


def test_relation_filters_and_columns_reach_the_scan(tables, log):
    plan = _plan(route_relations(log[1]).select("stmt_id", "name"))
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "kind" in scan.split("PushedFilters")[1] and "db" in scan.split("PushedFilters")[1]
    assert "ts" not in scan.split("ReadSchema")[1] and "ord" not in scan.split("ReadSchema")[1]


def test_a_hot_statement_is_split_and_stays_whole(spark, tables, log):
    wanted = sorted(_governed(tables, log).verdicts.collect())
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        found = _governed(tables, log).verdicts
        assert sorted(found.collect()) == wanted
        assert "skew=true" in _plan(found)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert len(wanted) == 3000 and {r.allowed for r in wanted} == {True, False}


def test_lookup_broadcasts_what_fits_and_shuffles_the_rest(spark):
    big = spark.range(1000).selectExpr("IF(id % 3 = 0, 0, id) AS k", "id AS v")
    small = spark.range(300).selectExpr("id AS k", "repeat('x', 100) AS w")
    assert fits(small, 10**6) and not fits(small, 10**4)
    both = [lookup(big, small, ["k"], how, limit) for how in ("left", "inner") for limit in (10**6, 10**4)]
    rows = [sorted(map(tuple, df.select("k", "v", "w").collect()), key=str) for df in both]
    assert rows[0] == rows[1] and rows[2] == rows[3] and len(rows[0]) == 1000 and len(rows[2]) == 534
    assert planned_bytes(small) > 0


def test_a_small_planned_size_is_no_proof(spark, tmp_path):
    """Files that compress well and rows that explode are measured."""
    spark.range(20_000).selectExpr("id AS k", "repeat('x', 1000) AS w").write.parquet(str(tmp_path / "files"))
    files = spark.read.parquet(str(tmp_path / "files"))
    assert planned_bytes(files) < 10**6 and not fits(files, 8 * 10**6) and fits(files, 10**8)
    exploded = spark.range(1).selectExpr("explode(sequence(1, 100000)) AS k")
    assert not fits(exploded, 8 * 10**5) and fits(exploded, 10**7)
    joined = lookup(spark.range(10).selectExpr("id AS k"), files, ["k"], "left", 8 * 10**6)
    assert "strategy=broadcast" not in joined._jdf.queryExecution().optimizedPlan().toString()


def test_checks_without_a_result(tables):
    reqs = tables.spark.createDataFrame(
        [(0, "ann", "READ", "URI"), (1, "ann", "SELECT", "TABLE")], "stmt_id long, user_name string, access string, object_type string"
    ).selectExpr("*", "'d' AS database", "'t' AS table", "CAST(NULL AS STRING) AS udf", "CAST(NULL AS STRING) AS column", "CAST(NULL AS STRING) AS reason", "0 AS seq")
    grants = tables.grants({"db": "d", "tbl": "x", "access": "select"})
    for limit in (10**6, 0):
        for null_allows in (True, False):
            found = {r.stmt_id: r.allowed for r in decide(reqs, grants, null_allows, limit=limit).collect()}
            assert found == {0: null_allows, 1: False}


def test_asked_listings_come_in_first(spark, tables):
    inv = tables.inventory({"db": "a", "tbl": "t"}, {"db": "b", "tbl": "t"}, {"db": "b", "tbl": "u"}, {"db": "b", "tbl": "t"})
    grants = tables.grants({"db": "*", "tbl": "*", "access": "select"}, {"user_name": "bob", "db": "b", "tbl": "t*", "access": "drop"})
    asked = spark.createDataFrame([("ann", "b"), ("bob", "b"), ("bob", "a"), ("eve", "b"), ("ann", None), ("ann", "b")], "user_name string, db string")
    shown = visible_tables(inv, grants, asked)
    assert sorted(map(tuple, shown.collect())) == [("ann", "b", "t"), ("ann", "b", "u"), ("bob", "b", "t")]
    everything = visible_tables(inv, grants, asked.select("user_name"))
    assert sorted(map(tuple, everything.collect())) == [("ann", "a", "t"), ("ann", "b", "t"), ("ann", "b", "u"), ("bob", "b", "t")]


def test_paths_are_one_lazy_plan(spark):
    """What is read again has been written before; the plan itself holds no write, and the log is read once."""
    files = spark.createDataFrame([("hdfs:/a/b/f", "u", "ALL")], "path string, owner string, others_action string")
    paths = spark.createDataFrame([("hdfs:/a/*/f", "LOAD", "u")], "path string, op string, user_name string")
    found = uri_access(paths, files)
    assert "InsertIntoHadoopFsRelationCommand" not in _plan(found) and [r.allowed for r in found.collect()] == [True]


def test_ranges_unfold_to_the_listing(spark, tables):
    r = random.Random(9)
    inv = tables.inventory(*[{"db": r.choice("ab"), "tbl": r.choice([None, "t", "tt", "u", "\u00e9"]) and r.choice("tu\u00e9") * r.randrange(1, 4) + str(r.randrange(30))} for _ in range(200)])
    pattern = lambda: r.choice(["*", "t*", "tt*", "u1*", "\u00e9*", "t1", "u2", "none"])
    grants = tables.grants(*[{"user_name": u, "db": r.choice(["a", "b", "*", "a*"]), "tbl": pattern(), "col": r.choice(["*", "x"]), "access": "select"} for u in ("ann", "bob", "eve") for _ in range(6 if u != "eve" else 1)])
    numbered = number_tables(inv)
    for asked in (spark.createDataFrame([("ann",), ("eve",)], "user_name string"), spark.createDataFrame([("ann", "a"), ("bob", "b")], "user_name string, db string")):
        ranges = visible_ranges(numbered, grants, asked)
        wanted = sorted(map(tuple, visible_tables(inv, grants, asked).collect()))
        assert wanted and sorted(map(tuple, unfold(ranges, numbered).collect())) == wanted
        spans = sorted(map(tuple, ranges.collect()))
        assert all(a[:2] != b[:2] or a[3] + 1 < b[2] for a, b in zip(spans, spans[1:]))
