"""One statement per command class, and the requests it must give."""

import pytest
from pyspark.sql import functions as F

from wardline.operators.classify import classify_operation
from wardline.operators.objects import build_objects
from wardline.operators.requests import build_requests

READ = "SELECT d/s/x,y"
BOTH = "{} d/t"

# Name of the case: statement, operation type, requests in order. Relations are all columns of d.s.
CASES = {
    "M1": ({"command": "AlterDatabasePropertiesCommand"}, "ALTERDATABASE", ["ALTER d"]),
    "M2": ({"command": "AlterDatabaseSetLocationCommand"}, "ALTERDATABASE_LOCATION", ["ALTER d"]),
    "M3": ({"command": "AlterTableAddColumnsCommand", "columns": ["n", "m"]}, "ALTERTABLE_ADDCOLS", ["ALTER d/t/n,m"]),
    "M4": ({"command": "AlterTableAddPartitionCommand"}, "ALTERTABLE_ADDPARTS", ["ALTER d/t"]),
    "M5": ({"command": "AlterTableChangeColumnCommand", "columns": ["a"]}, "ALTERTABLE_RENAMECOL", ["ALTER d/t/a"]),
    "M6": ({"command": "AlterTableDropPartitionCommand"}, "ALTERTABLE_DROPPARTS", ["ALTER d/t"]),
    "M7": ({"command": "AlterTableRenameCommand", "new_db": "d", "new_tbl": "n"}, "ALTERTABLE_RENAME", ["ALTER d/t", "ALTER d/n"]),
    "M7 view": ({"command": "AlterTableRenameCommand", "is_view": True, "new_db": "d", "new_tbl": "n"}, "ALTERVIEW_RENAME", ["ALTER d/t", "ALTER d/n"]),
    "M7 temp view": ({"command": "AlterTableRenameCommand", "is_view": True, "db": None, "new_db": "d", "new_tbl": "n"}, "ALTERVIEW_RENAME", []),
    "M8": ({"command": "AlterTableRenamePartitionCommand"}, "ALTERTABLE_RENAMEPART", ["ALTER d/t"]),
    "M9": ({"command": "AlterTableSerDePropertiesCommand"}, "ALTERTABLE_SERDEPROPERTIES", ["ALTER d/t"]),
    "M10": ({"command": "AlterTableSetLocationCommand"}, "ALTERTABLE_LOCATION", ["ALTER d/t"]),
    "M11": ({"command": "AlterTableSetPropertiesCommand"}, "ALTERTABLE_PROPERTIES", ["ALTER d/t"]),
    "M12": ({"command": "AlterTableUnsetPropertiesCommand"}, "ALTERTABLE_PROPERTIES", ["ALTER d/t"]),
    "M13": ({"command": "AlterViewAsCommand"}, "QUERY", [READ, "SELECT d/t"]),
    "M13 temp view": ({"command": "AlterViewAsCommand", "db": None}, "QUERY", [READ]),
    "M14": ({"command": "AnalyzeColumnCommand", "columns": ["a", "b"]}, "QUERY", ["SELECT d/t/a,b"]),
    "M14 no list": ({"command": "AnalyzeColumnCommand"}, "QUERY", ["SELECT d/t"]),
    "M15": ({"command": "AnalyzePartitionCommand"}, "QUERY", ["SELECT d/t"]),
    "M16": ({"command": "AnalyzeTableCommand"}, "QUERY", ["SELECT d/t/RAW__DATA__SIZE", "SELECT d/t"]),
    "M17": ({"command": "AnalyzeTablesCommand"}, "QUERY", ["SELECT d"]),
    "M17 no database": ({"command": "AnalyzeTablesCommand", "db": None}, "QUERY", []),
    "M18": ({"command": "CreateDatabaseCommand"}, "CREATEDATABASE", ["CREATE d"]),
    "M19": ({"command": "CreateDataSourceTableAsSelectCommand", "save_mode": "ErrorIfExists"}, "CREATETABLE_AS_SELECT", [READ, "CREATE d/t"]),
    "M19 append": ({"command": "CreateDataSourceTableAsSelectCommand", "save_mode": "Append"}, "CREATETABLE_AS_SELECT", [READ, "UPDATE d/t"]),
    "M19 overwrite": ({"command": "CreateDataSourceTableAsSelectCommand", "save_mode": "Overwrite"}, "CREATETABLE_AS_SELECT", [READ, "UPDATE d/t"]),
    "M20": ({"command": "CreateHiveTableAsSelectCommand", "save_mode": "Append"}, "CREATETABLE_AS_SELECT", [READ, "CREATE d/t"]),
    "M21": ({"command": "CreateTableCommand"}, "CREATETABLE", ["CREATE d/t"]),
    "M22": ({"command": "CreateDataSourceTableCommand"}, "CREATETABLE", ["CREATE d/t"]),
    "M23": ({"command": "CreateTableLikeCommand", "new_db": "e", "new_tbl": "n"}, "CREATETABLE", ["SELECT d/t", "CREATE e/n"]),
    "M24": ({"command": "CreateFunctionCommand", "func": "f"}, "CREATEFUNCTION", ["CREATE d/f"]),
    "M24 temp": ({"command": "CreateFunctionCommand", "func": "f", "is_temp": True}, "CREATEFUNCTION", []),
    "M25": ({"command": "CreateViewCommand"}, "CREATEVIEW", [READ, "CREATE d/t"]),
    "M25 temp": ({"command": "CreateViewCommand", "is_temp": True}, "CREATEVIEW", [READ]),
    "M26": ({"command": "CreateTempViewUsing"}, "CREATEVIEW", []),
    "M27": ({"command": "DescribeColumnCommand", "columns": ["a", "b"]}, "DESCTABLE", ["SELECT d/t/a,b"]),
    "M28": ({"command": "DescribeDatabaseCommand"}, "DESCDATABASE", ["USE d"]),
    "M29": ({"command": "DescribeFunctionCommand", "func": "f"}, "DESCFUNCTION", ["SELECT d/f"]),
    "M29 built in": ({"command": "DescribeFunctionCommand", "func": "f", "db": None}, "DESCFUNCTION", []),
    "M30": ({"command": "DescribeQueryCommand"}, "DESCQUERY", []),
    "M31": ({"command": "DescribeTableCommand"}, "DESCTABLE", ["SELECT d/t"]),
    "M32": ({"command": "DropDatabaseCommand"}, "DROPDATABASE", ["DROP d"]),
    "M33": ({"command": "DropFunctionCommand", "func": "f"}, "DROPTABLE", ["DROP d/f"]),
    "M33 temp": ({"command": "DropFunctionCommand", "func": "f", "is_temp": True, "db": None}, "DROPFUNCTION", []),
    "M34": ({"command": "DropTableCommand"}, "DROPTABLE", ["DROP d/t"]),
    "M34 view": ({"command": "DropTableCommand", "is_view": True}, "DROPVIEW", ["DROP d/t"]),
    "M35": ({"command": "InsertIntoDataSourceCommand"}, "QUERY", [READ, "SELECT d/t"]),
    "M35 no catalog": ({"command": "InsertIntoDataSourceCommand", "db": None}, "QUERY", [READ]),
    "M36": ({"command": "InsertIntoDataSourceDirCommand"}, "QUERY", [READ]),
    "M37": ({"command": "InsertIntoHadoopFsRelationCommand", "save_mode": "Overwrite"}, "LOAD", [READ, "UPDATE d/t/a,b,p"]),
    "M38": ({"command": "InsertIntoHiveDirCommand"}, "QUERY", [READ]),
    "M39": ({"command": "InsertIntoHiveTable"}, "LOAD", [READ, "UPDATE d/t"]),
    "M40": ({"command": "LoadDataCommand", "path": "hdfs://n/x"}, "LOAD", ["UPDATE d/t"]),
    "M41": ({"command": "SaveIntoDataSourceCommand"}, "QUERY", [READ]),
    "M42": ({"command": "RefreshFunctionCommand", "func": "f"}, "REFRESHFUNCTION", ["ALTER d/f"]),
    "M43": ({"command": "RefreshTableCommand"}, "REFRESHTABLE", ["ALTER d/t"]),
    "M44": ({"command": "RepairTableCommand"}, "MSCK", ["ALTER d/t"]),
    "M45": ({"command": "ShowColumnsCommand"}, "SHOWCOLUMNS", ["SELECT d/t"]),
    "M46": ({"command": "ShowCreateTableCommand"}, "SHOW_CREATETABLE", ["SELECT d/t"]),
    "M47": ({"command": "ShowCreateTableAsSerdeCommand"}, "SHOW_CREATETABLE", ["SELECT d/t"]),
    "M48": ({"command": "ShowFunctionsCommand"}, "SHOWFUNCTIONS", ["USE d"]),
    "M49": ({"command": "ShowPartitionsCommand"}, "SHOWPARTITIONS", ["SELECT d/t"]),
    "M50": ({"command": "ShowTablePropertiesCommand"}, "SHOW_TBLPROPERTIES", ["SELECT d/t"]),
    "M51": ({"command": "ShowTablesCommand"}, "SHOWTABLES", []),
    "M51 explained": ({"command": "ExplainCommand", "inner_command": "ShowTablesCommand"}, "SHOWTABLES", ["USE d"]),
    "M52": ({"command": "ShowViewsCommand"}, "SHOWVIEWS", ["USE d"]),
    "M53": ({"command": "TruncateTableCommand"}, "TRUNCATETABLE", ["UPDATE d/t"]),
    "M54 read": ({"command": "SetCommand", "conf_key": "k"}, "SHOWCONF", []),
    "M54 write": ({"command": "SetCommand", "conf_key": "k", "conf_has_value": True}, "EXPLAIN", []),
    "M55": ({"command": "ExplainCommand", "inner_command": "DropTableCommand"}, "DROPTABLE", ["DROP d/t"]),
    "M55 query": ({"command": "ExplainCommand"}, "QUERY", [READ]),
    "M55 twice": ({"command": "ExplainCommand", "inner_command": "ExplainCommand"}, "EXPLAIN", []),
    "M56": ({"command": "StreamingExplainCommand", "inner_command": "DropTableCommand"}, "DROPTABLE", []),
    "M57": ({"command": "AddJarCommand"}, "EXPLAIN", []),
    "M58": ({"command": "Query"}, "QUERY", [READ]),
    "M58 null": ({"command": None}, "QUERY", [READ]),
    "X13 all": ({"command": "SHOWDATABASES"}, "SHOWDATABASES", ["USE *"]),
    "X13 all streaming": ({"command": "StreamingExplainCommand", "inner_command": "SHOWDATABASES"}, "SHOWDATABASES", ["USE *"]),
    "X13 switch": ({"command": "SWITCHDATABASE"}, "SWITCHDATABASE", ["USE d"]),
    "X15 cache": ({"command": "CACHE"}, "CACHE", ["ADMIN d/t"]),
    "X15 map": ({"command": "DATA_MAP"}, "DATA_MAP", ["ADMIN d/t"]),
    "X16": ({"command": "STREAM"}, "STREAM", [READ, "ADMIN d/t"]),
    "X17 mutation": ({"command": "MUTATION"}, "MUTATION", [READ, "UPDATE d/t"]),
    "X17 management": ({"command": "MANAGEMENT"}, "MANAGEMENT", [READ, "UPDATE d/t"]),
}


def _requests(tables, show_all=False):
    stmts = tables.statements(*[statement for statement, _, _ in CASES.values()])
    rels = tables.relations(*[{"stmt_id": i, "ord": 0} for i in range(len(CASES))])
    classified = classify_operation(stmts)
    objs = build_objects(classified, rels, tables.inventory())
    reqs = build_requests(objs, show_all).withColumn("what", F.concat_ws("/", "database", "table", "udf", "column"))
    asked = {i: [] for i in range(len(CASES))}
    for row in reqs.orderBy("stmt_id", "seq").collect():
        asked[row.stmt_id].append(f"{row.access} {row.what}")
    ops = {row.stmt_id: row.op for row in classified.collect()}
    return {name: (ops[i], asked[i]) for i, name in enumerate(CASES)}


@pytest.fixture(scope="module")
def results(tables):
    return _requests(tables)


@pytest.mark.parametrize("name", CASES)
def test_requests_of_a_command(results, name):
    _, op, requests = CASES[name]
    assert results[name] == (op, requests)


def test_show_all_turns_listings_into_any_access(tables):
    shown = _requests(tables, show_all=True)
    assert shown["M27"][1] == ["USE d/t/a,b"]
    assert shown["M31"][1] == ["USE d/t"]
    assert shown["M45"][1] == ["USE d/t"]
    assert shown["M46"][1] == ["SELECT d/t"]
