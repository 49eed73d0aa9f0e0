"""Snapshots, logs, audit tables and live logs on files."""

import json
from functools import partial

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from wardline.plans.governance import Governance
from wardline.schemas import LIVE_STATEMENTS, STATEMENTS
from wardline.sources.audit import compact_audit, write_audit
from wardline.sources.inventory import load_inventory, session_inventory
from wardline.sources.logs import load_bucketed_log, load_log, save_bucketed_log, split_live, write_log
from wardline.sources.policies import load_grants, snapshot_path
from wardline.streaming.live import audit_requests, audit_stream, authorize_stream, live_verdicts, read_live

POLICY = {"policy": "p", "resources": {"database": ["d"], "table": ["t", "s*"]}, "items": [{"users": ["ann", "bob"], "accesses": ["select"]}]}
FUNCTION = {"policy": "f", "resources": {"database": ["d"], "udf": ["f*"]}, "items": [{"users": ["ann"], "accesses": ["drop", "create"]}]}


def _snapshot(tmp_path, *policies):
    path = snapshot_path(str(tmp_path), "app", "svc")
    with open(path, "w") as out:
        out.write("\n".join(p if isinstance(p, str) else json.dumps(p) for p in policies))
    return path


def test_snapshot(spark, tmp_path):
    path = _snapshot(tmp_path, POLICY, FUNCTION)
    assert path.endswith("/app_svc.json")
    found = sorted(tuple(r) for r in load_grants(spark, path).collect() if r.udf is None)
    assert found == [(u, "d", t, "*", None, "select") for u in ("ann", "bob") for t in ("s*", "t")]
    functions = sorted(tuple(r) for r in load_grants(spark, path).collect() if r.udf)
    assert functions == [("ann", "d", None, None, "f*", a) for a in ("create", "drop")]


def test_missing_empty_and_broken_snapshots_are_errors(spark, tmp_path):
    with pytest.raises(AnalysisException):
        load_grants(spark, str(tmp_path / "none.json"))
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        load_grants(spark, str(tmp_path / "empty"))
    with pytest.raises(Exception, match="(?i)malformed"):
        load_grants(spark, _snapshot(tmp_path, POLICY, '{"policy": "cut')).collect()


def test_inventory(spark, tables, tmp_path):
    tables.inventory().write.parquet(str(tmp_path / "inv"))
    assert sorted(load_inventory(spark, str(tmp_path / "inv")).collect()) == sorted(tables.inventory().collect())
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    spark.sql("CREATE TABLE IF NOT EXISTS shop.sales (id BIGINT, day STRING) USING parquet PARTITIONED BY (day)")
    assert [tuple(r) for r in session_inventory(spark, "shop").collect()] == [("shop", "sales", ["id", "day"], ["day"])]


def _governance(tables, stmts, rels, **settings):
    return Governance(stmts, rels, tables.inventory(), tables.grants({"db": "d", "tbl": "s", "access": "select"}), **settings)


def test_log_round_trip(spark, tables, tmp_path):
    stmts, rels = tables.statements({"command": "Query"}, {"command": "SetCommand", "columns": ["a"]}), tables.relations({"projected": ["x"]})
    write_log(stmts, rels, str(tmp_path / "log"))
    found = load_log(spark, str(tmp_path / "log"))
    assert sorted(found[0].collect()) == sorted(stmts.collect()) and found[1].collect() == rels.collect()


def test_bucketed_log_needs_no_exchange(spark, tables):
    stmts = tables.statements(*[{"command": "Query"}, {"command": "DropTableCommand"}] * 20)
    rels = tables.relations(*[{"stmt_id": i, "ord": 0} for i in range(40)])
    wanted = sorted(_governance(tables, stmts, rels).verdicts.collect())
    spark.sql("CREATE DATABASE IF NOT EXISTS logs")
    save_bucketed_log(stmts, rels, "logs", 4)
    judged = _governance(tables, *load_bucketed_log(spark, "logs"), bucketed=True)
    assert sorted(judged.verdicts.collect()) == wanted
    assert "hashpartitioning(stmt_id" not in judged.verdicts._jdf.queryExecution().executedPlan().toString()


def test_audit_batches_are_idempotent(spark, tables, tmp_path):
    audited = _governance(tables, tables.statements({"command": "Query"}), tables.relations({})).audit
    path = str(tmp_path / "audit")
    for batch_id in (0, 0, 1):
        write_audit(audited, path, batch_id, "one")
    assert spark.read.parquet(path).groupBy("batch_id").count().orderBy("batch_id").collect() == [(0, 2), (1, 2)]
    appended = str(tmp_path / "appended")
    write_audit(audited, appended)
    write_audit(audited, appended)
    rows = spark.read.parquet(appended)
    assert rows.count() == 4 and [str(r.day) for r in rows.select("day").distinct().collect()] == ["2024-01-01"]
    # Another run with the same batch id keeps what is there, and appended rows may lie beside both.
    write_audit(audited, path, 0, "two")
    write_audit(audited, path)
    assert spark.read.parquet(path).count() == 8
    compact_audit(spark, path, str(tmp_path / "compact"))
    compact = spark.read.parquet(str(tmp_path / "compact"))
    assert sorted(compact.select("run_id", "stmt_id").collect()) == sorted(spark.read.parquet(path).select("run_id", "stmt_id").collect())


def _live(stmts, rels):
    nested = rels.groupBy("stmt_id").agg(F.collect_list(F.struct(*[c for c in rels.columns if c != "stmt_id"])).alias("relations"))
    return stmts.join(nested, "stmt_id", "left").select(LIVE_STATEMENTS.fieldNames())


def test_live_log_reloads_policies_and_equals_the_batch(spark, tables, tmp_path):
    stmts = tables.statements({"command": "Query"}, {"command": "DropTableCommand"}, {"command": "SetCommand", "conf_key": "spark.sql.proxy-user"})
    rels = tables.relations({}, {"tbl": "t", "projected": ["a"]})
    live, log = _live(stmts, rels), str(tmp_path / "live")
    live.coalesce(1).write.parquet(log)
    assert sorted(split_live(live)[0].collect()) == sorted(stmts.select(STATEMENTS.fieldNames()).collect())
    assert sorted(split_live(live)[1].collect()) == sorted(rels.collect())
    grants = _snapshot(tmp_path, POLICY)

    def run():
        query = live_verdicts(
            read_live(spark, log, files_per_trigger=1), tables.inventory(), partial(load_grants, path=grants),
            str(tmp_path / "verdicts"), str(tmp_path / "checkpoint"), audit_path=str(tmp_path / "audit"), interval=None,
        )
        query.awaitTermination()
        return spark.read.parquet(str(tmp_path / "verdicts"))

    first = run()
    batch = Governance(stmts, rels, tables.inventory(), load_grants(spark, grants))
    assert sorted(first.drop("run_id", "batch_id").collect(), key=str) == sorted(batch.verdicts.collect(), key=str)
    assert {r.stmt_id: r.allowed for r in first.collect()} == {0: True, 1: False, 2: False}
    assert spark.read.parquet(str(tmp_path / "audit")).count() == batch.audit.count() == 4

    _snapshot(tmp_path, {**POLICY, "items": [{"users": ["ann"], "accesses": ["drop"]}]})
    live.withColumn("stmt_id", F.col("stmt_id") + 10).coalesce(1).write.mode("append").parquet(log)
    found = {r.stmt_id: r.allowed for r in run().collect()}
    assert found == {0: True, 1: False, 2: False, 10: False, 11: True, 12: False}


def test_a_missing_snapshot_stops_the_live_log(spark, tables, tmp_path):
    _live(tables.statements({"command": "Query"}), tables.relations({})).write.parquet(str(tmp_path / "live"))
    query = live_verdicts(
        read_live(spark, str(tmp_path / "live")), tables.inventory(), partial(load_grants, path=str(tmp_path / "none.json")),
        str(tmp_path / "verdicts"), str(tmp_path / "checkpoint"), interval=None,
    )
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        query.awaitTermination()


def test_stream_of_requests(spark, tables, tmp_path):
    stmts, rels = tables.statements({"command": "Query"}, {"command": "Query", "user_name": "bob"}), tables.relations({}, {"stmt_id": 1})
    judged = _governance(tables, stmts, rels)
    judged.requests.write.parquet(str(tmp_path / "requests"))
    stream = spark.readStream.schema(judged.requests.schema).parquet(str(tmp_path / "requests"))
    grants = tables.grants({"db": "d", "tbl": "s", "access": "select"})
    decided = authorize_stream(stream, grants)
    assert decided.isStreaming
    query = audit_stream(decided, str(tmp_path / "audit"), str(tmp_path / "checkpoint"), interval=None)
    query.awaitTermination()
    found = spark.read.parquet(str(tmp_path / "audit")).select("stmt_id", "column_name", "allowed").collect()
    assert sorted(map(tuple, found)) == [(0, "x", True), (0, "y", True), (1, "x", False), (1, "y", False)]
    # Another checkpoint on the same folder is another run; grants beyond the bound give the same decisions.
    again = audit_stream(authorize_stream(stream, grants, limit=1), str(tmp_path / "audit"), str(tmp_path / "other"), interval=None)
    again.awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "audit"))
    assert rows.count() == 8 and rows.select("run_id").distinct().count() == 2
    assert sorted(map(tuple, rows.select("stmt_id", "column_name", "allowed").distinct().collect())) == sorted(map(tuple, found))


def test_live_log_reloads_the_inventory(spark, tables, tmp_path):
    stmts, rels = tables.statements({"command": "Query"}), tables.relations({"tbl": "later", "projected": []})
    _live(stmts, rels).coalesce(1).write.parquet(str(tmp_path / "live"))
    seen = []

    def catalog(session):
        seen.append(1)
        return tables.inventory({"db": "d", "tbl": "later", "columns": ["p", "q"], "part_cols": []})

    query = live_verdicts(
        read_live(spark, str(tmp_path / "live")), catalog, partial(load_grants, path=_snapshot(tmp_path, POLICY)),
        str(tmp_path / "verdicts"), str(tmp_path / "checkpoint"), audit_path=str(tmp_path / "audit"), interval=None,
    )
    query.awaitTermination()
    assert seen and {r.column_name for r in spark.read.parquet(str(tmp_path / "audit")).collect()} <= {"p", "q"}


def test_a_stream_with_many_patterns_is_judged_by_batches(spark, tables, tmp_path):
    stmts, rels = tables.statements(*[{"command": "Query"}] * 40), tables.relations(*[{"stmt_id": k, "tbl": f"t{k * 500}_x", "projected": ["a"]} for k in range(40)])
    requests = _governance(tables, stmts, rels).requests
    requests.write.parquet(str(tmp_path / "requests"))
    stream = spark.readStream.schema(requests.schema).parquet(str(tmp_path / "requests"))
    grants = tables.grants(*[{"db": "d", "tbl": f"t{k}_*", "access": "select"} for k in range(10_000)])
    with pytest.raises(ValueError, match="audit_stream"):
        authorize_stream(stream, grants)
    query = audit_stream(stream, str(tmp_path / "audit"), str(tmp_path / "checkpoint"), interval=None, load_grants=lambda session: grants)
    query.awaitTermination()
    found = spark.read.parquet(str(tmp_path / "audit")).select("stmt_id", "allowed").collect()
    assert sorted(map(tuple, found)) == [(k, k * 500 < 10_000) for k in range(40)]


def test_requests_are_judged_under_any_number_of_patterns(spark, tables, tmp_path):
    stmts, rels = tables.statements(*[{"command": "Query"}] * 6), tables.relations(*[{"stmt_id": k, "tbl": f"t{k * 100}_x", "projected": ["a"]} for k in range(6)])
    requests = _governance(tables, stmts, rels).requests
    requests.write.parquet(str(tmp_path / "requests"))
    stream = spark.readStream.schema(requests.schema).parquet(str(tmp_path / "requests"))
    for n in (150, 400):
        grants = tables.grants(*[{"db": "d", "tbl": f"t{k}_*", "access": "select"} for k in range(n)])
        audit_requests(stream, grants, str(tmp_path / f"audit{n}"), str(tmp_path / f"checkpoint{n}"), interval=None).awaitTermination()
        found = spark.read.parquet(str(tmp_path / f"audit{n}")).select("stmt_id", "allowed").collect()
        assert sorted(map(tuple, found)) == [(k, k * 100 < n) for k in range(6)]
