"""Behaviour that may surprise, kept on purpose."""

import pytest
from pyspark.sql import functions as F

from wardline.functions.expressions import access_type
from wardline.operators.classify import classify_operation
from wardline.operators.decide import decide, denials, on_null
from wardline.operators.guards import excluded_keys, guard_settings, metadata_decisions
from wardline.operators.objects import expand_query_objects, resolve_columns, resolve_part_keys, split_connector_name
from wardline.operators.requests import dedupe_requests, fan_out_columns
from wardline.plans.governance import Governance

ALL = {"db": "*", "access": "select"}


@pytest.fixture
def governed(tables):
    def build(stmts, rels=(), grants=(), **settings):
        return Governance(
            tables.statements(*stmts), tables.relations(*rels), tables.inventory(), tables.grants(*grants), **settings
        )

    return build


def _verdicts(governance):
    return {r.stmt_id: (r.allowed, r.message) for r in governance.verdicts.collect()}


def test_paths_are_never_checked_by_default(governed):
    load = governed([{"command": "LoadDataCommand", "path": "hdfs://n/x"}])
    assert [(o.obj_type, o.side) for o in load.objects.orderBy("side").collect()] == [("DFS_URI", "in"), ("TABLE_OR_VIEW", "out")]
    assert [(r.access, r.table) for r in load.requests.collect()] == [("UPDATE", "t")]


def test_a_check_without_result_lets_pass(spark):
    df = spark.createDataFrame([(None,), (True,), (False,)], "allowed boolean").select(
        on_null().alias("kept"), on_null(verdict=False).alias("strict")
    )
    assert [tuple(r) for r in df.collect()] == [(True, False), (True, True), (False, False)]


def test_an_object_of_another_type_is_not_visible(tables):
    objs = tables.spark.createDataFrame(
        [("ann", "DATABASE", "d", "d"), ("ann", "TABLE_OR_VIEW", "d", "t"), ("ann", "FUNCTION", "d", "f"), ("bob", "DATABASE", "d", "d")],
        "user_name string, obj_type string, db string, name string",
    )
    seen = metadata_decisions(objs, tables.grants({"db": "d", "tbl": "t", "col": "a", "access": "drop"}))
    found = {(r.user_name, r.obj_type): (r.allowed, r.action, r.client_ip) for r in seen.collect()}
    assert found == {
        ("ann", "DATABASE"): (True, "METADATA OPERATION", "Error"),
        ("ann", "TABLE_OR_VIEW"): (True, "METADATA OPERATION", "Error"),
        ("ann", "FUNCTION"): (False, "METADATA OPERATION", "Error"),
        ("bob", "DATABASE"): (False, "METADATA OPERATION", "Error"),
    }


def test_no_projection_means_all_columns(tables):
    rels = tables.relations({}, {"projected": ["y"]}, {"projected": None}, {"tbl": "gone"})
    found = {r.ord: r.columns for r in resolve_columns(rels, tables.inventory()).collect()}
    assert found == {0: ["x", "y"], 1: ["y"], 2: ["x", "y"], 3: []}


def test_partition_keys_keep_table_order(tables):
    inv = tables.inventory({"db": "d", "tbl": "s", "columns": ["q", "p", "x"], "part_cols": ["q", "p"]})
    rels = tables.relations({}, {"projected": ["p", "x", "q"]}, {"projected": ["x", "p"]})
    found = {r.ord: r.part_keys for r in resolve_part_keys(rels, inv).collect()}
    assert found == {0: ["q", "p"], 1: ["q", "p"], 2: ["p"]}


def test_names_with_commas_split_and_blank_names_drop(governed):
    rels = [{"projected": ["a,b"]}, {"projected": ["x", " ", "y"]}, {"projected": [" "]}, {"projected": [" ", ""]}]
    asked = governed([{"command": "Query"}], rels).requests
    fanned = [(r.column, r.col_pos, r.column_name) for r in fan_out_columns(asked).orderBy("seq", "col_pos").collect()]
    assert fanned == [("a,b", 0, "a"), ("a,b", 1, "b"), ("x, ,y", 0, "x"), ("x, ,y", 2, "y"), (" ", 0, " ")]


def test_blank_names_only_leave_the_statement_allowed(governed):
    assert _verdicts(governed([{"command": "Query"}], [{"projected": [" ", ""]}])) == {0: (True, None)}


def test_writes_through_a_source_and_view_changes_need_select_only(governed):
    stmts = [{"command": "InsertIntoDataSourceCommand"}, {"command": "AlterViewAsCommand"}]
    assert all(ok for ok, _ in _verdicts(governed(stmts, grants=[ALL])).values())


def test_unchecked_statements_are_allowed(governed):
    stmts = [{"command": c} for c in ("DescribeQueryCommand", "CreateTempViewUsing", "AddFileCommand", "ShowTablesCommand")]
    stmts.append({"command": "StreamingExplainCommand", "inner_command": "DropTableCommand"})
    found = _verdicts(governed(stmts, [{"stmt_id": i} for i in range(5)]))
    assert found == {i: (True, None) for i in range(5)}


def test_show_tables_is_filtered_and_show_views_is_checked(governed):
    stmts = [{"command": "ShowTablesCommand"}, {"command": "ShowViewsCommand"}, {"command": "ShowTablesCommand", "user_name": "bob"}]
    shown = governed(stmts, grants=[{"db": "d", "tbl": "t", "col": "a", "access": "drop"}])
    assert [tuple(r) for r in shown.listings.collect()] == [("ann", "d", "t")]
    assert _verdicts(shown) == {i: (True, None) for i in range(3)}


def test_setting_keys_match_whole_patterns(tables):
    keys = ["spark.sql.proxy-user", "spark.sql.proxy-user.clientIp", "sparkXsql.proxy-user", "x\nspark.sql.proxy-user", "a.b", "A.B", "", None]
    stmts = tables.statements(*[{"command": "SetCommand", "conf_key": k} for k in keys], {"command": "Query", "conf_key": keys[0]})
    found = {r.conf_key: r.allowed for r in guard_settings(stmts, ["a|b", "(?i)a.b", " "]).collect()}
    assert found == {keys[0]: False, keys[1]: True, keys[2]: False, keys[3]: True, "a.b": False, "A.B": False, "": True, None: True}
    assert excluded_keys() == ["spark.sql.optimizer.excludedRules", "spark.sql.proxy-user"]


def test_setting_guard_denies_every_user_also_when_reading(governed):
    stmts = [{"command": "SetCommand", "conf_key": "spark.sql.proxy-user"}, {"command": "ExplainCommand", "inner_command": "SetCommand", "conf_key": "spark.sql.proxy-user"}]
    found = _verdicts(governed(stmts, grants=[ALL]))
    assert found == {0: (False, "All user not allow to set this property: spark.sql.proxy-user !!!"), 1: (True, None)}


def test_unsupported_relations_deny_without_audit(governed):
    text = "User try access unsupport catalog, contact admin to get more info: {} !!!"
    rels = [{"projected": ["no"]}, {"kind": "path", "raw_name": "/x"}, {"kind": "path", "raw_name": "/y"}]
    rels += [{"stmt_id": 1, "kind": "connector", "raw_name": "bare"}, {"stmt_id": 2, "kind": "connector", "raw_name": "c::bare"}]
    rels += [{"stmt_id": 3, "kind": "connector", "raw_name": "c::d.s.more", "projected": ["x"]}]
    stmts = [{"command": "Query"}] * 4
    found = governed(stmts, rels, [{"db": "d", "tbl": "s", "access": "select"}])
    assert _verdicts(found) == {
        0: (False, text.format("/x")), 1: (False, text.format("bare")), 2: (False, text.format("c::bare")), 3: (True, None)
    }
    assert [(r.stmt_id, r.column_name) for r in found.audit.collect()] == [(3, "x")]


def test_connector_names(tables):
    names = ["c::d.t", "c::d.t.u", "c::d.t::e", "d.t", "c::d", "c::d.", "c::.t", None]
    rels = tables.relations(*[{"kind": "connector", "raw_name": n} for n in names])
    found = {r.raw_name: (r.connector_db, r.connector_tbl) for r in split_connector_name(rels).collect()}
    assert found == {
        "c::d.t": ("d", "t"), "c::d.t.u": ("d", "t"), "c::d.t::e": ("d", "t"), "d.t": (None, None),
        "c::d": (None, None), "c::d.": (None, None), "c::.t": ("", "t"), None: (None, None),
    }


def test_relations_without_database_are_not_checked(tables):
    rels = tables.relations({"db": None}, {"kind": "unresolved"}, {"kind": "unresolved", "db": None}, {"kind": "local"})
    assert expand_query_objects(rels, tables.inventory()).count() == 0
    objs = expand_query_objects(rels, tables.inventory(), unresolved_with_db=True)
    assert [(o.ord, o.name, o.columns) for o in objs.collect()] == [(1, "s", [])]


def test_audit_ends_with_the_first_denied_request(governed):
    rels = [{"projected": ["x"]}, {"projected": ["x", "no", "y"]}, {"projected": ["z"]}]
    grants = [{"db": "d", "tbl": "s", "col": c, "access": "select"} for c in ("x", "y", "z")]
    audited = governed([{"command": "Query"}], rels, grants).audit.orderBy("seq", "col_pos").collect()
    assert [(r.column_name, r.allowed) for r in audited] == [("x", True), ("x", True), ("no", False), ("y", True)]


def test_first_denial_names_the_whole_list(governed):
    rels = [{"ord": 3, "projected": ["x", "no"]}, {"ord": 1, "tbl": "t", "projected": ["a", "b"]}, {"ord": 2, "projected": ["x"]}]
    found = governed([{"command": "Query"}], rels, [{"db": "d", "tbl": "s", "col": "x", "access": "select"}])
    assert _verdicts(found) == {0: (False, "Permission denied: user [ann] does not have [SELECT] privilege on [d/t/a,b]")}
    assert denials(found.decisions).select("message").distinct().count() == 2


def test_inputs_are_asked_before_outputs(governed):
    found = governed([{"command": "InsertIntoHiveTable"}], [{"ord": 7}])
    assert _verdicts(found)[0][1].endswith("[SELECT] privilege on [d/s/x,y]")


def test_requests_are_deduped_on_joined_columns_per_statement(governed):
    rels = [{"projected": ["a", "b"]}, {"projected": ["a,b"]}, {"projected": ["b", "a"]}, {"stmt_id": 1, "projected": ["a", "b"]}]
    asked = governed([{"command": "Query"}] * 2, rels).requests
    kept = sorted((r.stmt_id, r.seq, r.column) for r in asked.collect())
    assert kept == [(0, 0, "a,b"), (0, 2, "b,a"), (1, 3, "a,b")]
    assert sorted(dedupe_requests(asked).collect()) == sorted(asked.collect())


def test_envelope(governed):
    asked = governed([{"command": "Query", "client_ip": "10.1.1.1"}, {"command": "Query"}], [{}, {"stmt_id": 1}], cluster="c1")
    rows = asked.requests.orderBy("stmt_id").collect()
    assert [(r.user_name, r.action, r.client_ip, r.cluster) for r in rows] == [("ann", "QUERY", "10.1.1.1", "c1"), ("ann", "QUERY", "Error", "c1")]


def test_view_type_follows_the_operation_name(governed):
    stmts = [{"command": "CreateViewCommand"}, {"command": "DropTableCommand", "is_view": True}, {"command": "DropTableCommand"}]
    types = {r.stmt_id: r.object_type for r in governed(stmts).requests.collect()}
    assert types == {0: "VIEW", 1: "VIEW", 2: "TABLE"}


def test_show_columns_option(governed):
    stmts = [{"command": "DescribeTableCommand"}]
    grants = [{"db": "d", "tbl": "t", "col": "a", "access": "update"}]
    assert _verdicts(governed(stmts, grants=grants))[0][0] is False
    assert _verdicts(governed(stmts, grants=grants, show_columns_option="SHOW-ALL"))[0][0] is True


def test_unknown_commands_count_as_explain(tables):
    row = classify_operation(tables.statements({"command": "NoSuchCommand"})).first()
    assert (row.op, row["shape"], row.reads) == ("EXPLAIN", "nothing", None)


def test_decide_keeps_every_request(governed, tables):
    asked = governed([{"command": "Query"}], [{"projected": ["x", "y"]}, {"kind": "path", "raw_name": "p"}]).requests
    decided = decide(asked, tables.grants(ALL))
    assert decided.groupBy("allowed").agg(F.count("*")).count() == 2 and decided.count() == 3


def test_uris_are_read_on_one_side_and_written_on_the_other(spark):
    objs = spark.createDataFrame([("in",), ("out",)], "side string").selectExpr(
        "side", "'OTHER' AS action", "'DFS_URI' AS obj_type", "'URI' AS object_type", "'NONE' AS needs", "CAST(NULL AS STRING) AS on_input", "CAST(NULL AS STRING) AS on_output"
    )
    assert {r.side: r.access for r in objs.select("side", access_type().alias("access")).collect()} == {"in": "READ", "out": "WRITE"}


def test_names_of_white_space_alone_are_blank(spark):
    """White space of any script; what keeps words together is no white space."""
    blank, kept = ["", " ", "\t", "\u2003", "\u3000 \u2028", "\x1c\x1f", "\u1680"], ["\u00a0", "\u2007", "\u202f", " a ", "\u200b", "\x85"]
    reqs = spark.createDataFrame([(",".join(["x", *blank, *kept]),), (" ",), (None,)], "column string")
    found = [r.column_name for r in fan_out_columns(reqs).collect()]
    assert found == ["x", *kept, " ", None]
