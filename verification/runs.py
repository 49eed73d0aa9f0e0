"""The registered queries: the package run over inputs derived from the given tables."""

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verification import recipes as R
from wardline.functions import expressions as X
from wardline.functions.masking import mask_columns
from wardline.operators.classify import classify_operation
from wardline.operators.decide import decide, denials, match_grants
from wardline.operators.display import object_positions as positions_of
from wardline.operators.display import rank_objects, show_objects
from wardline.operators.guards import guard_settings, metadata_decisions, number_tables, visible_ranges, visible_tables
from wardline.operators.objects import build_objects, expand_command_objects, expand_query_objects
from wardline.operators.paths import uri_access
from wardline.operators.requests import RESOURCE, fan_out_columns, with_access
from wardline.plans.governance import Governance
from wardline.schemas import RELATIONS, STATEMENTS
from wardline.session import work_folder, written
from wardline.sources.audit import commit_audit, compact_committed, read_audit, stage_audit, write_audit
from wardline.sources.inventory import load_inventory
from wardline.sources.logs import load_log, write_log
from wardline.sources.policies import load_grants, load_history, snapshot_path, write_snapshot, write_versions
from wardline.streaming.live import audit_open_statements, audit_requests, live_verdicts

_REQUEST = ["stmt_id", "seq", "access", "object_type", *RESOURCE]
_OBJECT = ["stmt_id", "side", "ord"]
_VERDICT = ["stmt_id", "user_name", "op", "allowed", "message"]


_schemas = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read from the files once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def derive(spark: SparkSession, sql: str, **inputs: DataFrame) -> DataFrame:
    """Runs a recipe over DataFrames that it names as tables."""
    views = {}
    for name, df in inputs.items():
        views[name] = f"recipe_{name}_{id(df):x}"
        df.createOrReplaceTempView(views[name])
        for keyword in ("FROM", "JOIN"):
            sql = sql.replace(f"{keyword} {name} ", f"{keyword} {views[name]} ").replace(f"{keyword} {name}\n", f"{keyword} {views[name]}\n")
            sql = sql.replace(f"{keyword} {name})", f"{keyword} {views[name]})")
            if sql.endswith(f"{keyword} {name}"):
                sql = sql[: -len(name)] + views[name]
    result = spark.sql(sql)
    for view in views.values():
        spark.catalog.dropTempView(view)
    return result


def names(text: str) -> F.Column:
    return F.when(F.col(text) != "", F.split(text, ",")).otherwise(F.array().cast("array<string>"))


def statement_log(raw: DataFrame) -> DataFrame:
    """A recipe's statements in the log's schema; what the recipe lacks is null or false."""
    if "cols" in raw.columns:
        raw = raw.withColumn("columns", names("cols"))
    absent = {
        f.name: (F.lit(False) if f.dataType.typeName() == "boolean" else F.lit(None)).cast(f.dataType)
        for f in STATEMENTS.fields
        if f.name not in raw.columns
    }
    return raw.withColumns(absent) if absent else raw


def relation_log(raw: DataFrame) -> DataFrame:
    return raw.withColumn("projected", names("projected")).select(RELATIONS.fieldNames())


def inventory(spark: SparkSession) -> DataFrame:
    raw = spark.sql(R.INVENTORY)
    return raw.select("db", "tbl", names("cols").alias("columns"), names("parts").alias("part_cols"))


def plain_grants(spark, sf_dir):
    raw = derive(spark, R.GRANTS, supplier=table(spark, sf_dir, "supplier"))
    return raw.withColumn("udf", F.lit(None).cast("string"))


def mixed_grants(spark, sf_dir):
    return derive(
        spark, R.MIXED_GRANTS, supplier=table(spark, sf_dir, "supplier"), customer=table(spark, sf_dir, "customer")
    )


def matrix_log(spark, sf_dir, events=None):
    stmts = derive(spark, R.MATRIX_STATEMENTS, events=table(spark, sf_dir, "events") if events is None else events)
    return statement_log(stmts), relation_log(derive(spark, R.MATRIX_RELATIONS, statements=stmts))


def simple_log(spark, sf_dir):
    stmts = derive(spark, R.STATEMENTS, events=table(spark, sf_dir, "events"))
    return statement_log(stmts), relation_log(derive(spark, R.RELATIONS, statements=stmts))


def matrix(spark, sf_dir) -> Governance:
    stmts, rels = matrix_log(spark, sf_dir)
    return Governance(stmts, rels, inventory(spark), mixed_grants(spark, sf_dir), R.CONFIGURED_EXCLUDES)


def simple(spark, sf_dir) -> Governance:
    stmts, rels = simple_log(spark, sf_dir)
    return Governance(stmts, rels, inventory(spark), plain_grants(spark, sf_dir), R.CONFIGURED_EXCLUDES)


def _flat(df: DataFrame) -> DataFrame:
    """Lists as comma-joined text."""
    lists = [f.name for f in df.schema.fields if f.dataType.typeName() == "array"]
    return df.withColumns({c: F.array_join(c, ",") for c in lists}) if lists else df


# ---- queries -----------------------------------------------------------------------------------


def denied_selects(spark, sf_dir):
    """Which SELECT statements of the log would be denied, and on what?"""
    stmts, rels = simple_log(spark, sf_dir)
    selects = stmts.where(F.col("command") == "Query")
    judged = Governance(selects, rels, inventory(spark), plain_grants(spark, sf_dir), R.CONFIGURED_EXCLUDES)
    return judged.verdicts.where(~F.col("allowed")).select("stmt_id", "user_name", "message")


def op_classification(spark, sf_dir):
    stmts, _ = matrix_log(spark, sf_dir)
    return classify_operation(stmts).select("stmt_id", "command", "target_command", "objects_checked", "op")


def _relation_objects(log, spark, sf_dir):
    _, rels = log(spark, sf_dir)
    objs = expand_query_objects(rels, inventory(spark))
    ok = F.col("reason").isNull()
    shown = {c: F.when(ok, F.col(c)) for c in ("db", "name", "columns", "part_keys")}
    return _flat(objs).withColumns(shown).select("stmt_id", "ord", "reason", *shown)


def mixed_query_objects(spark, sf_dir):
    return _relation_objects(matrix_log, spark, sf_dir).where(F.col("reason").isNull())


def unsupported_relations(spark, sf_dir):
    found = _relation_objects(matrix_log, spark, sf_dir).where(F.col("reason").isNotNull())
    return found.select("stmt_id", "ord", "reason")


def command_objects(spark, sf_dir):
    stmts, _ = matrix_log(spark, sf_dir)
    return _flat(expand_command_objects(classify_operation(stmts), inventory(spark)))


def _objects(spark, sf_dir, *more):
    stmts, rels = matrix_log(spark, sf_dir)
    objs = build_objects(classify_operation(stmts), rels, inventory(spark))
    if more:
        objs = objs.join(stmts.select("stmt_id", *more), "stmt_id")
    return objs.where("reason IS NULL AND name IS NOT NULL")


def statement_objects(spark, sf_dir):
    return _flat(_objects(spark, sf_dir)).select(*_OBJECT, "obj_type", "db", "name", "part_keys", "columns", "action")


def resource_types(spark, sf_dir):
    typed = _objects(spark, sf_dir).withColumn("object_type", X.object_type())
    return typed.withColumns(X.resource_keys()).select(*_OBJECT, "object_type", *RESOURCE)


def access_types(spark, sf_dir):
    plain = with_access(_objects(spark, sf_dir)).withColumnRenamed("needed", "access")
    shown = with_access(plain, X.show_all_columns("Show-All"))
    return shown.select(*_OBJECT, "access", F.col("needed").alias("access_show_all"))


def deduped_requests(spark, sf_dir):
    asked = matrix(spark, sf_dir).requests.where(F.col("reason").isNull())
    return asked.select(*_REQUEST, "user_name", "action", "client_ip")


def column_fanout(spark, sf_dir):
    fanned = fan_out_columns(matrix(spark, sf_dir).requests.where(F.col("reason").isNull()))
    return fanned.select(*_REQUEST, "col_pos", "column_name")


def decisions(spark, sf_dir):
    decided = matrix(spark, sf_dir).decisions.where(F.col("reason").isNull())
    return decided.select(*_REQUEST, "col_pos", "column_name", "allowed")


def denial_messages(spark, sf_dir):
    denied = denials(matrix(spark, sf_dir).decisions.where(F.col("reason").isNull()))
    return denied.select("stmt_id", "seq", "col_pos", "message")


def statement_verdicts(spark, sf_dir):
    return matrix(spark, sf_dir).verdicts.select(_VERDICT)


def shuffled_verdicts(spark, sf_dir):
    """The same with grants taken as too big for a broadcast."""
    stmts, rels = matrix_log(spark, sf_dir)
    judged = Governance(stmts, rels, inventory(spark), mixed_grants(spark, sf_dir), R.CONFIGURED_EXCLUDES, limit=0)
    return judged.verdicts.select(_VERDICT)


def simple_verdicts(spark, sf_dir):
    return simple(spark, sf_dir).verdicts.select(_VERDICT)


def verdicts_as_of(spark, sf_dir):
    """Each statement judged by the policies that held at its time, from a folder of versions."""
    folder, events = work_folder(spark, "versions"), table(spark, sf_dir, "events")
    grants = derive(spark, R.NUMBERED_GRANTS, supplier=table(spark, sf_dir, "supplier"), customer=table(spark, sf_dir, "customer"))
    # A snapshot of each version is many rows for each grant: they are made by all cores, whatever the files.
    times, grants = derive(spark, R.VERSIONS, events=events), grants.repartition(4 * spark.sparkContext.defaultParallelism)
    write_versions(derive(spark, R.SNAPSHOTS, versions=times, grants=grants), folder, times)
    versions, history = load_history(spark, folder)
    judged = Governance(*matrix_log(spark, sf_dir), inventory(spark), history, R.CONFIGURED_EXCLUDES, versions=versions)
    return judged.verdicts.select(_VERDICT)


def verdicts_after_change(spark, sf_dir):
    """Verdicts kept from before a change of the grants, and judged again where the change can matter."""
    tables = {name: table(spark, sf_dir, name) for name in ("supplier", "customer")}
    before, after = (derive(spark, sql, **tables) for sql in (R.GRANTS_BEFORE, R.GRANTS_AFTER))
    # Both sets of grants are asked the same requests, which are made once.
    then = Governance(*matrix_log(spark, sf_dir), inventory(spark), before, R.CONFIGURED_EXCLUDES).stored()
    kept = written(then.verdicts, "verdicts")
    return then.under(after).verdicts_after(kept, before).select(_VERDICT)


_AUDITED = [
    "stmt_id", "seq", "col_pos", "user_name", "client_ip", "action", "access", "object_type", "database", "table",
    "udf", "column_name", "allowed",
]


def audit_rows(spark, sf_dir):
    return matrix(spark, sf_dir).audit.select(*_AUDITED, F.to_date("ts").alias("day"))


def audit_sink(spark, sf_dir):
    """Writes the audit table and counts it back."""
    path = work_folder(spark, "audit")
    write_audit(matrix(spark, sf_dir).audit, path)
    return spark.read.parquet(path).groupBy("day", "user_name", "action", "allowed").agg(F.count("*").alias("n"))


def _run_stream(spark, sf_dir):
    """Judges the events as a live log until all are done; gives the folders of verdicts and audit."""
    schema = table(spark, sf_dir, "events").schema
    live = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    folder = work_folder(spark, "live")
    snapshot = snapshot_path(folder, "wardline", "spark")
    write_snapshot(mixed_grants(spark, sf_dir), snapshot)
    query = live_verdicts(
        live,
        inventory(spark),
        partial(load_grants, path=snapshot),
        f"{folder}/verdicts",
        f"{folder}/checkpoint",
        audit_path=f"{folder}/audit",
        interval=None,
        split=lambda batch: matrix_log(batch.sparkSession, sf_dir, events=batch),
        excluded_settings=R.CONFIGURED_EXCLUDES,
    )
    query.awaitTermination()
    return f"{folder}/verdicts", f"{folder}/audit"


def stream_verdicts(spark, sf_dir):
    return spark.read.parquet(_run_stream(spark, sf_dir)[0]).select(_VERDICT)


def stream_audit(spark, sf_dir):
    return spark.read.parquet(_run_stream(spark, sf_dir)[1]).select(*_AUDITED, "day")


def stream_policy_change(spark, sf_dir):
    """A live log in two batches, with other grants from the second one on."""
    folder, events = work_folder(spark, "change"), table(spark, sf_dir, "events")
    snapshot = snapshot_path(folder, "wardline", "spark")
    for half, grants in enumerate((mixed_grants, plain_grants)):
        write_snapshot(grants(spark, sf_dir), snapshot)
        events.where(F.col("event_id") % 2 == half).write.mode("append").parquet(f"{folder}/log")
        query = live_verdicts(
            spark.readStream.schema(events.schema).parquet(f"{folder}/log"),
            inventory,
            partial(load_grants, path=snapshot),
            f"{folder}/verdicts",
            f"{folder}/checkpoint",
            interval=None,
            split=lambda batch: matrix_log(batch.sparkSession, sf_dir, events=batch),
            excluded_settings=R.CONFIGURED_EXCLUDES,
        )
        query.awaitTermination()
    return spark.read.parquet(f"{folder}/verdicts").select(_VERDICT)


def stream_requests(spark, sf_dir):
    """Requests as a stream, decided with fixed grants and recorded as they come."""
    folder, judged = work_folder(spark, "requests"), matrix(spark, sf_dir)
    judged.requests.write.parquet(f"{folder}/requests")
    stream = spark.readStream.schema(judged.requests.schema).parquet(f"{folder}/requests")
    audit_requests(stream, mixed_grants(spark, sf_dir), f"{folder}/audit", f"{folder}/checkpoint", interval=None).awaitTermination()
    return spark.read.parquet(f"{folder}/audit").select(*_AUDITED, "cluster", "day")


#: Rows of a file of a live log, at least, where it has several.
_ROWS_PER_FILE = 50_000


def stream_audit_in_parts(spark, sf_dir):
    """Decisions in three batches, each with a part of every statement, then a row that only moves the clock."""
    folder, decided = work_folder(spark, "parts"), matrix(spark, sf_dir).decisions.withColumn("ts", F.col("ts").cast("timestamp"))
    decided.withColumn("part", F.pmod(F.xxhash64("stmt_id", "seq", "col_pos"), F.lit(3))).write.partitionBy("part").parquet(f"{folder}/all")
    # Each part is as many files, and a batch is as many as a part has; so many rows to a file that none is empty.
    least, rows = spark.read.parquet(f"{folder}/all").groupBy("part").count().agg(F.min("count"), F.sum("count")).first()
    files = max(1, (least or 0) // _ROWS_PER_FILE)
    for part in range(3):
        spark.read.schema(decided.schema).parquet(f"{folder}/all/part={part}").repartition(files).write.mode("append").parquet(f"{folder}/log")
    end = table(spark, sf_dir, "events").agg((F.max("ts") + F.expr("INTERVAL 1000 DAYS")).cast("timestamp").alias("ts"))
    clock = end.select(*[F.col("ts") if f.name == "ts" else F.lit(None).cast(f.dataType).alias(f.name) for f in decided.schema.fields])
    clock.coalesce(1).write.mode("append").parquet(f"{folder}/log")
    stream = spark.readStream.schema(decided.schema).option("maxFilesPerTrigger", files).parquet(f"{folder}/log")
    query = audit_open_statements(stream, f"{folder}/audit", f"{folder}/checkpoint", "500 days", interval=None, write=commit_audit, open_rows=rows)
    query.awaitTermination()
    return read_audit(spark, f"{folder}/audit").select(*_AUDITED, "day")


def committed_audit(spark, sf_dir):
    """An audit table written in batches, one of them twice and one never finished, then compacted; counted through its manifest."""
    path, audited = work_folder(spark, "committed"), matrix(spark, sf_dir).audit
    # The audit is made once; each batch reads its own part of it.
    audited = written(audited.withColumn("part", F.col("stmt_id") % 3), "parts", "part")
    part = lambda k: audited.where(F.col("part") == k).drop("part")
    # Batch 1 is written with the wrong rows first.
    for batch, k in ((0, 0), (1, 0), (1, 1), (2, 2)):
        commit_audit(part(k), path, batch, "run")
    stage_audit(part(2), path)
    compact_committed(spark, path)
    return read_audit(spark, path).groupBy("day", "user_name", "action", "allowed").agg(F.count("*").alias("n"))


def checked_paths(spark, sf_dir):
    files = derive(
        spark, R.FILES, supplier=table(spark, sf_dir, "supplier"), nation=table(spark, sf_dir, "nation")
    )
    paths = derive(spark, R.PATHS, events=table(spark, sf_dir, "events"))
    return uri_access(paths, files).select("stmt_id", "user_name", "op", "path", "uri_action", "allowed", "message")


def listed_tables(spark, sf_dir):
    stmts, _ = simple_log(spark, sf_dir)
    asking = stmts.where(F.col("command") == "ShowTablesCommand")
    listing = derive(spark, R.LISTING, part=table(spark, sf_dir, "part"))
    return visible_tables(listing, mixed_grants(spark, sf_dir), asking.select("user_name"))


def listed_ranges(spark, sf_dir):
    """The same as ranges of the tables in order."""
    stmts, _ = simple_log(spark, sf_dir)
    asking = stmts.where(F.col("command") == "ShowTablesCommand")
    numbered = number_tables(derive(spark, R.LISTING, part=table(spark, sf_dir, "part")))
    return visible_ranges(numbered, mixed_grants(spark, sf_dir), asking.select("user_name"))


def show_tables_listings(spark, sf_dir):
    """What SHOW TABLES shows: the tables of the database each user asks about."""
    stmts = derive(spark, R.STATEMENTS, events=table(spark, sf_dir, "events"))
    asked = derive(spark, R.ASKED_LISTINGS, statements=stmts)
    stmts = statement_log(asked.withColumns({"command": F.lit("ShowTablesCommand"), "stmt_id": F.lit(0).cast("long"), "ts": F.lit(None).cast("timestamp"), "tbl": F.lit(None).cast("string")}))
    listing = derive(spark, R.LISTING, part=table(spark, sf_dir, "part"))
    columns = {c: F.array().cast("array<string>") for c in ("columns", "part_cols")}
    path = work_folder(spark, "inventory")
    listing.withColumns(columns).write.parquet(path)
    relations = spark.createDataFrame([], RELATIONS)
    return Governance(stmts, relations, load_inventory(spark, path), mixed_grants(spark, sf_dir)).listings


def settings_guard(spark, sf_dir):
    stmts = derive(spark, R.STATEMENTS, events=table(spark, sf_dir, "events"))
    guarded = guard_settings(derive(spark, R.SETTINGS, statements=stmts), R.CONFIGURED_EXCLUDES)
    return guarded.select("stmt_id", "user_name", "conf_key", "allowed", "message")


def metadata_checks(spark, sf_dir):
    visible = metadata_decisions(_objects(spark, sf_dir), mixed_grants(spark, sf_dir))
    return visible.select(*_OBJECT, "obj_type", "user_name", "allowed")


def object_order(spark, sf_dir):
    return rank_objects(_objects(spark, sf_dir, "k"), ["user_name", "k"]).select(*_OBJECT, "position")


def object_positions(spark, sf_dir):
    return positions_of(_objects(spark, sf_dir)).select(*_OBJECT, "position")


def path_requests(spark, sf_dir):
    """What is asked of paths, as inputs and as outputs, where no grant can answer: allowed, or denied by setting."""
    given = _objects(spark, sf_dir).where("obj_type = 'DFS_URI'")
    typed = with_access(given.unionByName(given.withColumn("side", F.lit("out"))))
    nothing = [F.lit(None).cast("string").alias(c) for c in (*RESOURCE, "reason")]
    asked = typed.select("stmt_id", "side", F.lit(0).alias("seq"), F.col("needed").alias("access"), "object_type", "user_name", *nothing)
    loose, strict = (decide(asked, mixed_grants(spark, sf_dir), null_allows) for null_allows in (True, False))
    strictly = strict.select("stmt_id", "side", F.col("allowed").alias("allowed_strictly"))
    return loose.select("stmt_id", "side", "access", "allowed").join(strictly, ["stmt_id", "side"])


def object_text(spark, sf_dir):
    return show_objects(_objects(spark, sf_dir)).select(*_OBJECT, "text")


def masked_customers(spark, sf_dir):
    phrase = F.concat("c_mktsegment", F.lit("-"), F.col("c_nationkey").cast("string"))
    copies = {c: phrase for c in ("show_first", "show_last", "last_masked", "hashed")}
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    kinds = {
        "c_name": "mask", "c_mktsegment": "mask_first_n", "show_first": "mask_show_first_n",
        "show_last": "mask_show_last_n", "last_masked": "mask_last_n", "hashed": "mask_hash",
    }
    return mask_columns(customers.withColumns(copies), kinds).drop("c_nationkey")


def _bulk(sizes, grants, spark, sf_dir):
    raw = derive(spark, R.BULK_REQUESTS, lineitem=table(spark, sf_dir, "lineitem"))
    nothing = F.lit(None).cast("string")
    reqs = raw.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "user_name", F.upper("access").alias("access"),
        F.lit("COLUMN").alias("object_type"), F.col("db").alias("database"), F.col("tbl").alias("table"),
        nothing.alias("udf"), F.col("col").alias("column"),
    )
    answered = match_grants(reqs, grants(spark, sf_dir), **sizes)
    return answered.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "user_name", F.col("table").alias("tbl"),
        F.col("column").alias("col"), X.access_token().alias("access"), "allowed",
    )


def policy_snapshot(spark, sf_dir):
    """Grants written as a snapshot and loaded back."""
    path = snapshot_path(work_folder(spark, "policies"), "wardline", "spark")
    write_snapshot(mixed_grants(spark, sf_dir), path)
    flat = load_grants(spark, path)
    whole = {c: F.when(F.col("udf").isNull(), F.coalesce(c, F.lit("*"))) for c in ("tbl", "col")}
    return flat.withColumns(whole).select("user_name", "db", "tbl", "col", "udf", "access").distinct()


def log_round_trip(spark, sf_dir):
    """A log written and loaded back."""
    path = work_folder(spark, "log")
    write_log(*matrix_log(spark, sf_dir), path)
    stmts, rels = load_log(spark, path)
    counted = rels.groupBy("stmt_id").agg(
        F.count("*").alias("n_relations"), F.sum(F.size("projected")).alias("n_names")
    )
    joined = stmts.select("stmt_id", "command", "db", F.array_join("columns", ",").alias("cols")).join(
        counted, "stmt_id", "left"
    )
    return joined.na.fill(0, ["n_relations", "n_names"])


QUERIES = {
    "denied_selects": denied_selects,
    "op_classification": op_classification,
    "query_objects": partial(_relation_objects, simple_log),
    "mixed_query_objects": mixed_query_objects,
    "unsupported_relations": unsupported_relations,
    "command_objects": command_objects,
    "statement_objects": statement_objects,
    "resource_types": resource_types,
    "access_types": access_types,
    "deduped_requests": deduped_requests,
    "column_fanout": column_fanout,
    "decisions": decisions,
    "denial_messages": denial_messages,
    "statement_verdicts": statement_verdicts,
    "shuffled_verdicts": shuffled_verdicts,
    "simple_verdicts": simple_verdicts,
    "verdicts_as_of": verdicts_as_of,
    "verdicts_after_change": verdicts_after_change,
    "stream_verdicts": stream_verdicts,
    "audit_rows": audit_rows,
    "audit_sink": audit_sink,
    "stream_audit": stream_audit,
    "stream_policy_change": stream_policy_change,
    "stream_requests": stream_requests,
    "stream_audit_in_parts": stream_audit_in_parts,
    "committed_audit": committed_audit,
    "uri_access": checked_paths,
    "visible_tables": listed_tables,
    "visible_ranges": listed_ranges,
    "show_tables_listings": show_tables_listings,
    "settings_guard": settings_guard,
    "metadata_decisions": metadata_checks,
    "object_order": object_order,
    "object_positions": object_positions,
    "path_requests": path_requests,
    "object_text": object_text,
    "masked_customers": masked_customers,
    "bulk_decisions": partial(_bulk, {}, plain_grants),
    "bulk_decisions_shuffled": partial(_bulk, {"limit": 0}, mixed_grants),
    "policy_snapshot": policy_snapshot,
    "log_round_trip": log_round_trip,
}
