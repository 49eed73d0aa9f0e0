"""Audit tables with a manifest, and statements that come in parts."""

import json
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from verification import runs
from wardline.operators.decide import audit_rows
from wardline.plans.governance import Governance
from wardline.session import written
from wardline.sources.audit import commit_audit, committed, compact_committed, read_audit, stage_audit, unused_attempts
from wardline.streaming import live
from wardline.streaming.live import audit_open_statements

START = datetime(2024, 1, 1)


def _decisions(tables, count, **grant):
    """Statements one hour apart, each reading three tables; grants allow all but the table `s1`."""
    stmts = tables.statements(*[{"command": "Query", "ts": START + timedelta(hours=k)} for k in range(count)])
    rels = tables.relations(*[{"stmt_id": k, "ord": o, "tbl": f"s{(k + o) % 3}", "projected": ["x"]} for k in range(count) for o in range(3)])
    grants = tables.grants({"db": "d", "tbl": "s0", "access": "select"}, {"db": "d", "tbl": "s2", "access": "select"})
    return Governance(stmts, rels, tables.inventory(), grants).decisions


def _rows(df):
    return sorted((r.stmt_id, r.seq, r.col_pos, r.allowed) for r in df.collect())


def test_readers_see_whole_batches_only(spark, tables, tmp_path):
    path, decisions = str(tmp_path / "audit"), _decisions(tables, 30)
    audited = audit_rows(decisions)
    assert read_audit(spark, path).collect() == []
    commit_audit(audited.where("stmt_id < 10"), path, 0, "run")
    first = _rows(read_audit(spark, path))
    assert first == _rows(audited.where("stmt_id < 10"))
    # A write that never came to its end, and one that fails on a row after others have been written.
    stage_audit(audited.where("stmt_id >= 10"), path)
    broken = audited.withColumn("cluster", F.when(F.col("stmt_id") == 29, F.raise_error(F.lit("killed"))).otherwise(F.col("cluster")))
    with pytest.raises(Exception, match="killed"):
        commit_audit(broken.repartition(4), path, 1, "run")
    assert _rows(read_audit(spark, path)) == first
    commit_audit(audited.where("stmt_id >= 10"), path, 1, "run")
    assert _rows(read_audit(spark, path)) == _rows(audited)


def test_a_batch_replaces_itself_and_compaction_changes_nothing(spark, tables, tmp_path):
    path, audited = str(tmp_path / "audit"), audit_rows(_decisions(tables, 24))
    for k in range(6):
        commit_audit(audited.where(F.col("stmt_id") % 6 == k), path, k, "a")
    commit_audit(audited.where("stmt_id = 0"), path, 5, "a")
    commit_audit(audited.where(F.col("stmt_id") % 6 == 5), path, 5, "a")
    commit_audit(audited.where("stmt_id = 1"), path, 5, "b")
    wanted = sorted(_rows(audited) + _rows(audited.where("stmt_id = 1")))
    assert _rows(read_audit(spark, path)) == wanted and committed(spark, path).count() == 7
    listed = read_audit(spark, path)
    compact_committed(spark, path)
    left = {(r.run_id, r.batch_id) for r in committed(spark, path).collect()}
    assert left == {("compacted", 0), ("a", 5), ("b", 5)} and _rows(read_audit(spark, path)) == wanted
    # A reader from before still has its files; the last batch may still be written again.
    assert _rows(listed) == wanted and unused_attempts(spark, path).count() == 7
    commit_audit(audited.where(F.col("stmt_id") % 6 == 5), path, 5, "a")
    compact_committed(spark, path)
    commit_audit(audited.where("stmt_id = 2"), path, 6, "a")
    compact_committed(spark, path)
    assert _rows(read_audit(spark, path)) == sorted(wanted + _rows(audited.where("stmt_id = 2")))
    day = read_audit(spark, path).where("day = DATE'2024-01-01'")
    assert "PartitionFilters: [isnotnull(day" in day._jdf.queryExecution().toString()


def test_statements_close_behind_the_watermark(spark, tables, tmp_path):
    decisions = _decisions(tables, 12).drop("cluster").withColumn("cluster", F.lit("")).cache()
    log, path = str(tmp_path / "log"), str(tmp_path / "audit")

    def add(rows):
        rows.coalesce(1).write.mode("append").parquet(log)
        stream = spark.readStream.schema(decisions.schema).option("maxFilesPerTrigger", 1).parquet(log)
        audit_open_statements(stream, path, str(tmp_path / "checkpoint"), "3 hours", interval=None, write=commit_audit).awaitTermination()
        return _rows(read_audit(spark, path))

    # The denial comes last, after later requests of its statement; both orders of parts occur.
    late = (F.col("seq") == 0) | ((F.col("stmt_id") % 2 == 0) & (F.col("seq") == 1))
    wanted = audit_rows(decisions)
    add(decisions.where(~late & (F.col("stmt_id") < 3)))
    assert add(decisions.where(late & (F.col("stmt_id") < 3))) == []
    got = add(decisions.where(F.col("stmt_id").between(3, 8)))
    got = add(decisions.where("stmt_id = 9"))
    # At nine hours the watermark is at six: a statement closes when it is reached.
    assert got == _rows(wanted.where("stmt_id < 7"))
    # Later than the delay: left out. Without a time: never closed.
    add(decisions.where("stmt_id = 10"))
    add(decisions.where("stmt_id = 0").withColumn("seq", F.lit(77).cast("long")).unionByName(decisions.where("stmt_id = 11").withColumn("ts", F.lit(None).cast("timestamp"))))
    nothing = [F.lit(START + timedelta(days=9)).alias("ts") if f.name == "ts" else F.lit(None).cast(f.dataType).alias(f.name) for f in decisions.schema.fields]
    add(spark.range(1).select(*nothing))
    got = add(spark.range(1).select(*nothing))
    assert got == _rows(wanted.where("stmt_id < 11"))


@pytest.mark.parametrize("in_memory", [True, False])
def test_parts_of_several_files_are_one_batch(spark, monkeypatch, tmp_path, in_memory):
    queries, start = [], live._start
    monkeypatch.setattr(live, "_start", lambda *args: queries.append(start(*args)) or queries[0])
    monkeypatch.setattr(live, "open_rows_fit", lambda spark, rows: in_memory)
    monkeypatch.setattr(runs, "_ROWS_PER_FILE", 8)
    rows = [(k, START + timedelta(hours=k), k % 7, "view", 1.0, "") for k in range(120)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame([(1, "a", 2)], "s_suppkey long, s_name string, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(k, "a", k % 5) for k in range(40)], "c_custkey long, c_name string, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    found = runs.stream_audit_in_parts(spark, str(tmp_path))
    wanted = runs.matrix(spark, str(tmp_path)).audit
    assert _rows(found) == _rows(wanted) and len(_rows(found)) > 0
    # Three parts of several files each, the clock alone, and what it closes.
    state = f"{found.inputFiles()[0].split('/audit/')[0].removeprefix('file:').replace('///', '/')}"
    names = sorted(Path(state, "log").glob("*.parquet"))
    seen = [json.loads(p.json)["numInputRows"] for p in queries[0].recentProgress]
    assert len(names) > 4 and len(names) % 3 == 1 and seen[3:] == [1, 0] and min(seen[:3]) > 8
    kept = {f.suffix for f in Path(state, "checkpoint", "state").rglob("*") if f.is_file()}
    assert (".delta" in kept, ".zip" in kept) == ((True, False) if in_memory else (False, True))
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


def test_open_rows_fit_in_memory(spark):
    assert live.open_rows_fit(spark, 1000) and not live.open_rows_fit(spark, 10**10)


def test_parts_are_written_once_and_read_alone(spark):
    rows = spark.createDataFrame([(k, k % 3 if k < 8 else None) for k in range(9)], "stmt_id long, part long")
    held = written(rows, "parts", "part")
    one = held.where("part = 1").drop("part")
    assert sorted(r.stmt_id for r in one.collect()) == [1, 4, 7]
    assert "PartitionFilters: [isnotnull(part" in one._jdf.queryExecution().toString()
    assert held.where("part = 5").count() == 0 and sorted(map(str, held.collect())) == sorted(map(str, rows.collect()))
    assert written(rows.where("false"), "parts", "part").where("part = 1").count() == 0


def test_a_committed_audit_is_made_once(spark, monkeypatch, tmp_path):
    made = []
    audit = runs.Governance.audit.fget

    def counted(self):
        number = spark.sparkContext.accumulator(0)
        made.append(number)

        def seen(batches):
            number.add(1)
            yield from batches

        rows = audit(self).coalesce(1)
        return rows.mapInArrow(seen, rows.schema)

    monkeypatch.setattr(runs.Governance, "audit", property(counted))
    rows = [(k, START + timedelta(hours=k), k % 7, "view", 1.0, "") for k in range(40)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame([(1, "a", 2)], "s_suppkey long, s_name string, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(1, "a", 2)], "c_custkey long, c_name string, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    assert runs.committed_audit(spark, str(tmp_path)).count() > 0
    assert [m.value for m in made] == [1]
