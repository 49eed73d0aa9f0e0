"""What each registered query must return, as DuckDB SQL over the given tables.

Written from the rules (which command needs which access on what), by lists and CASE, not from the
tables the package joins with.
"""

from verification import recipes as R

EXCLUDES = ("spark.sql.optimizer.excludedRules", "spark.sql.hive.convertMetastoreParquet",
            "spark.sql.parquet.int96TimestampConversion", "spark.sql.proxy-user")


def _with(*parts: tuple[str, str]) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in parts)


def _in(column: str, names: str) -> str:
    return f"{column} IN (" + ", ".join(f"'{n}'" for n in names.split()) + ")"


# ---- statements: command, operation type -------------------------------------------------------

TARGET = """
SELECT *, CASE WHEN command IN ('ExplainCommand', 'StreamingExplainCommand') THEN coalesce(inner_command, 'Query') ELSE command END AS cmd,
 command NOT IN ('StreamingExplainCommand', 'ShowTablesCommand') AS checked
FROM statements"""

OPS = f"""
SELECT *, CASE
 WHEN cmd = 'AlterDatabasePropertiesCommand' THEN 'ALTERDATABASE'
 WHEN cmd = 'AlterDatabaseSetLocationCommand' THEN 'ALTERDATABASE_LOCATION'
 WHEN cmd = 'AlterTableAddColumnsCommand' THEN 'ALTERTABLE_ADDCOLS'
 WHEN cmd = 'AlterTableAddPartitionCommand' THEN 'ALTERTABLE_ADDPARTS'
 WHEN cmd = 'AlterTableChangeColumnCommand' THEN 'ALTERTABLE_RENAMECOL'
 WHEN cmd = 'AlterTableDropPartitionCommand' THEN 'ALTERTABLE_DROPPARTS'
 WHEN cmd = 'AlterTableRenameCommand' THEN CASE WHEN is_view THEN 'ALTERVIEW_RENAME' ELSE 'ALTERTABLE_RENAME' END
 WHEN cmd = 'AlterTableRenamePartitionCommand' THEN 'ALTERTABLE_RENAMEPART'
 WHEN cmd = 'AlterTableSerDePropertiesCommand' THEN 'ALTERTABLE_SERDEPROPERTIES'
 WHEN cmd = 'AlterTableSetLocationCommand' THEN 'ALTERTABLE_LOCATION'
 WHEN {_in('cmd', 'AlterTableSetPropertiesCommand AlterTableUnsetPropertiesCommand')} THEN 'ALTERTABLE_PROPERTIES'
 WHEN {_in('cmd', '''AlterViewAsCommand AnalyzeColumnCommand AnalyzePartitionCommand AnalyzeTableCommand AnalyzeTablesCommand
   InsertIntoDataSourceCommand InsertIntoDataSourceDirCommand InsertIntoHiveDirCommand SaveIntoDataSourceCommand Query''')} THEN 'QUERY'
 WHEN cmd = 'CreateDatabaseCommand' THEN 'CREATEDATABASE'
 WHEN {_in('cmd', 'CreateDataSourceTableAsSelectCommand CreateHiveTableAsSelectCommand')} THEN 'CREATETABLE_AS_SELECT'
 WHEN {_in('cmd', 'CreateTableCommand CreateDataSourceTableCommand CreateTableLikeCommand')} THEN 'CREATETABLE'
 WHEN cmd = 'CreateFunctionCommand' THEN 'CREATEFUNCTION'
 WHEN {_in('cmd', 'CreateViewCommand CreateTempViewUsing')} THEN 'CREATEVIEW'
 WHEN {_in('cmd', 'DescribeColumnCommand DescribeTableCommand')} THEN 'DESCTABLE'
 WHEN cmd = 'DescribeDatabaseCommand' THEN 'DESCDATABASE'
 WHEN cmd = 'DescribeFunctionCommand' THEN 'DESCFUNCTION'
 WHEN cmd = 'DescribeQueryCommand' THEN 'DESCQUERY'
 WHEN cmd = 'DropDatabaseCommand' THEN 'DROPDATABASE'
 WHEN cmd = 'DropFunctionCommand' THEN CASE WHEN is_temp THEN 'DROPFUNCTION' ELSE 'DROPTABLE' END
 WHEN cmd = 'DropTableCommand' THEN CASE WHEN is_view THEN 'DROPVIEW' ELSE 'DROPTABLE' END
 WHEN {_in('cmd', 'InsertIntoHadoopFsRelationCommand InsertIntoHiveTable LoadDataCommand')} THEN 'LOAD'
 WHEN cmd = 'RefreshFunctionCommand' THEN 'REFRESHFUNCTION'
 WHEN cmd = 'RefreshTableCommand' THEN 'REFRESHTABLE'
 WHEN cmd = 'RepairTableCommand' THEN 'MSCK'
 WHEN cmd = 'SetCommand' THEN CASE WHEN conf_key IS NULL OR NOT conf_has_value THEN 'SHOWCONF' ELSE 'EXPLAIN' END
 WHEN cmd = 'ShowColumnsCommand' THEN 'SHOWCOLUMNS'
 WHEN {_in('cmd', 'ShowCreateTableCommand ShowCreateTableAsSerdeCommand')} THEN 'SHOW_CREATETABLE'
 WHEN cmd = 'ShowFunctionsCommand' THEN 'SHOWFUNCTIONS'
 WHEN cmd = 'ShowPartitionsCommand' THEN 'SHOWPARTITIONS'
 WHEN cmd = 'ShowTablePropertiesCommand' THEN 'SHOW_TBLPROPERTIES'
 WHEN cmd = 'ShowTablesCommand' THEN 'SHOWTABLES'
 WHEN cmd = 'ShowViewsCommand' THEN 'SHOWVIEWS'
 WHEN cmd = 'TruncateTableCommand' THEN 'TRUNCATETABLE'
 WHEN {_in('cmd', 'SHOWDATABASES SWITCHDATABASE CACHE STREAM MUTATION DATA_MAP MANAGEMENT')} THEN cmd
 ELSE 'EXPLAIN' END AS op
FROM target"""

# ---- objects -----------------------------------------------------------------------------------

RELATION_OBJECTS = """
SELECT stmt_id, ord, reason, db, name, columns, part_keys FROM (
 SELECT r.stmt_id, r.ord, r.kind,
  CASE WHEN r.kind = 'path' OR (r.kind = 'connector' AND split_part(split_part(r.raw_name, '::', 2), '.', 2) = '')
   THEN concat('User try access unsupport catalog, contact admin to get more info: ', r.raw_name, ' !!!') END AS reason,
  CASE WHEN r.kind = 'connector' THEN split_part(split_part(r.raw_name, '::', 2), '.', 1) ELSE r.db END AS db,
  CASE WHEN r.kind = 'connector' THEN split_part(split_part(r.raw_name, '::', 2), '.', 2) ELSE r.tbl END AS name,
  CASE WHEN r.projected <> '' THEN r.projected
   ELSE coalesce((SELECT max(i.cols) FROM inv i WHERE i.tbl = r.tbl AND (r.kind = 'connector' OR i.db = r.db)), '') END AS columns,
  CASE WHEN r.kind <> 'catalog' THEN '' ELSE coalesce((SELECT max(i.parts) FROM inv i WHERE i.db = r.db AND i.tbl = r.tbl
   AND (r.projected = '' OR list_contains(string_split(r.projected, ','), i.parts))), '') END AS part_keys
 FROM relations r WHERE r.kind IN ('catalog', 'connector', 'path')
) WHERE reason IS NOT NULL OR db IS NOT NULL"""

_ONE_TABLE = """AlterTableAddPartitionCommand RepairTableCommand AlterTableDropPartitionCommand AlterTableRenamePartitionCommand
 AlterTableSerDePropertiesCommand AlterTableSetLocationCommand AlterTableSetPropertiesCommand AlterTableUnsetPropertiesCommand
 AnalyzePartitionCommand DropTableCommand TruncateTableCommand RefreshTableCommand"""
_RENAMED = "(cmd = 'AlterTableRenameCommand' AND (NOT is_view OR db IS NOT NULL))"
_PERSISTED_VIEW = "(cmd = 'CreateViewCommand' AND NOT is_temp)"
_NEW_FUNCTION = "(cmd = 'CreateFunctionCommand' AND NOT is_temp)"


def _object(side, ord, kind, db, name, where, columns="''", parts="''", action="'OTHER'"):
    return (
        f"SELECT stmt_id, '{side}' AS side, {ord} AS ord, '{kind}' AS obj_type, {db} AS db, {name} AS name, {parts} AS part_keys,"
        f" {columns} AS columns, {action} AS action FROM ops WHERE checked AND {db} IS NOT NULL AND ({where})"
    )


_INV = "coalesce((SELECT max({c}) FROM inv i WHERE i.db = ops.db AND i.tbl = ops.tbl), '')"

COMMAND_OBJECTS = "\nUNION ALL ".join(
    [
        _object("in", 0, "TABLE_OR_VIEW", "db", "tbl", _in("cmd", _ONE_TABLE + """ DescribeTableCommand ShowColumnsCommand
          ShowCreateTableCommand ShowCreateTableAsSerdeCommand ShowPartitionsCommand ShowTablePropertiesCommand CACHE""") + " OR " + _RENAMED),
        _object("in", 0, "TABLE_OR_VIEW", "db", "tbl", _in("cmd", """AlterTableAddColumnsCommand AlterTableChangeColumnCommand
          AnalyzeColumnCommand DescribeColumnCommand"""), columns="cols"),
        _object("in", 0, "TABLE_OR_VIEW", "db", "tbl", "cmd = 'AnalyzeTableCommand'", columns="'RAW__DATA__SIZE'"),
        _object("in", 0, "DATABASE", "db", "db", _in("cmd", """AnalyzeTablesCommand DescribeDatabaseCommand DropDatabaseCommand
          ShowFunctionsCommand ShowTablesCommand ShowViewsCommand CreateTableLikeCommand SWITCHDATABASE""")),
        _object("in", 1, "TABLE_OR_VIEW", "db", "tbl", "cmd = 'CreateTableLikeCommand'"),
        _object("in", 0, "FUNCTION", "db", "func", _in("cmd", "DescribeFunctionCommand DropFunctionCommand RefreshFunctionCommand")),
        _object("in", 0, "DFS_URI", "path", "path", "cmd = 'LoadDataCommand' AND NOT is_local"),
        _object("out", 0, "DATABASE", "db", "db", _in("cmd", """AlterDatabasePropertiesCommand AlterDatabaseSetLocationCommand
          AnalyzeTablesCommand CreateDatabaseCommand CreateDataSourceTableAsSelectCommand CreateHiveTableAsSelectCommand
          CreateTableCommand DropDatabaseCommand""") + f" OR {_PERSISTED_VIEW} OR {_NEW_FUNCTION}"),
        _object("out", 0, "DATABASE", "new_db", "new_db", "cmd = 'CreateTableLikeCommand'"),
        _object("out", 1, "TABLE_OR_VIEW", "new_db", "new_tbl", "cmd = 'CreateTableLikeCommand'"),
        _object("out", 0, "TABLE_OR_VIEW", "new_db", "new_tbl", _RENAMED),
        _object("out", 0, "TABLE_OR_VIEW", "db", "tbl", _in("cmd", _ONE_TABLE + """ AlterViewAsCommand AnalyzeTableCommand
          CreateDataSourceTableCommand InsertIntoDataSourceCommand InsertIntoHiveTable LoadDataCommand STREAM MUTATION DATA_MAP MANAGEMENT""")),
        _object("out", 0, "TABLE_OR_VIEW", "db", "tbl", _in("cmd", "AlterTableAddColumnsCommand AnalyzeColumnCommand"), columns="cols"),
        _object("out", 0, "TABLE_OR_VIEW", "db", "tbl", "cmd = 'InsertIntoHadoopFsRelationCommand'",
                columns=_INV.format(c="i.cols"), parts=_INV.format(c="i.parts")),
        _object("out", 1, "TABLE_OR_VIEW", "db", "tbl", _in("cmd", "CreateHiveTableAsSelectCommand CreateTableCommand") + f" OR {_PERSISTED_VIEW}"),
        _object("out", 1, "TABLE_OR_VIEW", "db", "tbl", "cmd = 'CreateDataSourceTableAsSelectCommand'",
                action="CASE save_mode WHEN 'Append' THEN 'INSERT' WHEN 'Overwrite' THEN 'INSERT_OVERWRITE' ELSE 'OTHER' END"),
        _object("out", 1, "FUNCTION", "db", "func", _NEW_FUNCTION),
        _object("out", 0, "FUNCTION", "db", "func", _in("cmd", "DropFunctionCommand RefreshFunctionCommand")),
    ]
)

READERS = f"""
SELECT stmt_id, CASE WHEN cmd = 'SaveIntoDataSourceCommand' THEN 'out' ELSE 'in' END AS side FROM ops WHERE checked AND {_in('cmd', '''
 AlterViewAsCommand CreateDataSourceTableAsSelectCommand CreateHiveTableAsSelectCommand CreateViewCommand DescribeQueryCommand
 InsertIntoDataSourceCommand InsertIntoDataSourceDirCommand InsertIntoHadoopFsRelationCommand InsertIntoHiveDirCommand
 InsertIntoHiveTable SaveIntoDataSourceCommand Query STREAM MUTATION MANAGEMENT''')}"""

OBJECTS = """
SELECT stmt_id, side, ord, obj_type, db, name, part_keys, columns, action, CAST(NULL AS VARCHAR) AS reason FROM command_objects
UNION ALL
SELECT o.stmt_id, q.side, o.ord, 'TABLE_OR_VIEW', CASE WHEN o.reason IS NULL THEN o.db END, o.name, o.part_keys, o.columns, 'OTHER', o.reason
FROM relation_objects o JOIN readers q ON o.stmt_id = q.stmt_id"""

# ---- requests ----------------------------------------------------------------------------------

_SEQ = "CASE WHEN o.side = 'out' THEN 4294967296 ELSE 0 END + o.ord"


def object_type(o="o", op="s.op"):
    return f"""CASE WHEN {o}.obj_type = 'DATABASE' OR {o}.obj_type IS NULL THEN 'DATABASE'
  WHEN {o}.obj_type = 'TABLE_OR_VIEW' AND {o}.columns <> '' THEN 'COLUMN'
  WHEN {o}.obj_type = 'TABLE_OR_VIEW' THEN CASE WHEN position('VIEW' IN {op}) > 0 THEN 'VIEW' ELSE 'TABLE' END
  WHEN {o}.obj_type = 'FUNCTION' THEN 'FUNCTION' WHEN {o}.obj_type = 'DFS_URI' THEN 'URI' ELSE 'NONE' END"""


def access(o="o", op="s.op", listing="'SELECT'"):
    return f"""CASE
  WHEN {o}.obj_type = 'DFS_URI' THEN CASE {o}.side WHEN 'in' THEN 'READ' ELSE 'WRITE' END
  WHEN {o}.action <> 'OTHER' THEN 'UPDATE'
  WHEN {op} = 'CREATEDATABASE' AND {o}.obj_type = 'DATABASE' THEN 'CREATE'
  WHEN {op} = 'CREATEFUNCTION' AND {o}.obj_type = 'FUNCTION' THEN 'CREATE'
  WHEN {_in(op, 'CREATETABLE CREATEVIEW CREATETABLE_AS_SELECT')} AND {o}.obj_type = 'TABLE_OR_VIEW'
   THEN CASE {o}.side WHEN 'in' THEN 'SELECT' ELSE 'CREATE' END
  WHEN starts_with({op}, 'ALTER') OR {_in(op, 'MSCK REFRESHTABLE REFRESHFUNCTION')} THEN 'ALTER'
  WHEN starts_with({op}, 'DROP') THEN 'DROP'
  WHEN {op} = 'LOAD' THEN CASE {o}.side WHEN 'in' THEN 'SELECT' ELSE 'UPDATE' END
  WHEN {_in(op, 'QUERY SHOW_CREATETABLE SHOWPARTITIONS SHOW_TBLPROPERTIES DESCFUNCTION')} THEN 'SELECT'
  WHEN {_in(op, 'SHOWCOLUMNS DESCTABLE')} THEN {listing}
  WHEN {_in(op, 'SHOWDATABASES SWITCHDATABASE DESCDATABASE SHOWTABLES SHOWFUNCTIONS SHOWVIEWS')} THEN 'USE'
  WHEN {op} = 'TRUNCATETABLE' THEN 'UPDATE'
  WHEN {_in(op, 'CACHE DATA_MAP')} THEN 'ADMIN'
  WHEN {op} = 'STREAM' THEN CASE {o}.side WHEN 'in' THEN 'SELECT' ELSE 'ADMIN' END
  WHEN {_in(op, 'MUTATION MANAGEMENT')} THEN CASE {o}.side WHEN 'in' THEN 'SELECT' ELSE 'UPDATE' END
  ELSE 'NONE' END"""


_KEYS = """CASE WHEN object_type = 'FUNCTION' THEN coalesce(db, '') WHEN object_type IN ('DATABASE', 'TABLE', 'VIEW', 'COLUMN') THEN coalesce(db, '*') END AS "database",
 CASE WHEN object_type IN ('TABLE', 'VIEW', 'COLUMN') THEN name END AS "table",
 CASE WHEN object_type = 'FUNCTION' THEN name END AS udf, CASE WHEN object_type = 'COLUMN' THEN columns END AS "column" """

ASKED = f"""
SELECT * FROM (SELECT stmt_id, seq, user_name, op AS action, access, object_type, {_KEYS}, coalesce(client_ip, 'Error') AS client_ip, day FROM (
 SELECT o.stmt_id, {_SEQ} AS seq, s.user_name, s.op, s.client_ip, CAST(s.ts AS DATE) AS day, o.db, o.name, o.columns, {object_type()} AS object_type, {access()} AS access
 FROM objects o JOIN ops s ON o.stmt_id = s.stmt_id WHERE o.reason IS NULL)
) WHERE "database" IS NOT NULL AND access <> 'NONE'
UNION ALL
SELECT stmt_id, 0, user_name, op, 'USE', 'DATABASE', '*', NULL, NULL, NULL, coalesce(client_ip, 'Error'), CAST(ts AS DATE) FROM ops WHERE op = 'SHOWDATABASES' """

REQUESTS = """
SELECT * EXCLUDE (nth) FROM (SELECT *, row_number() OVER (PARTITION BY stmt_id, access, "database", "table", udf, "column" ORDER BY seq) AS nth FROM asked)
WHERE nth = 1"""

FANNED = """
SELECT *, CAST(0 AS INTEGER) AS col_pos, "column" AS column_name FROM requests WHERE "column" IS NULL OR position(',' IN "column") = 0
UNION ALL
SELECT * FROM (SELECT *, CAST(unnest(range(len(string_split("column", ',')))) AS INTEGER) AS col_pos, unnest(string_split("column", ',')) AS column_name
 FROM requests WHERE position(',' IN "column") > 0) WHERE regexp_matches(column_name, '[^  ]') """

# ---- decisions ---------------------------------------------------------------------------------


def _fits(pattern, value):
    return f"({pattern} = {value} OR (right({pattern}, 1) = '*' AND starts_with({value}, left({pattern}, length({pattern}) - 1))))"


def allowed(r="r", column="column_name"):
    db = _fits("g.db", f'{r}."database"')
    tbl, col, udf = _fits("coalesce(g.tbl, '*')", f'{r}."table"'), _fits("coalesce(g.col, '*')", f"{r}.{column}"), _fits("g.udf", f"{r}.udf")
    own = f"g.access = lower({r}.access) AND {r}.access NOT IN ('USE', 'ADMIN') OR g.access = 'admin' AND {r}.access = 'ADMIN'"
    return f"""EXISTS (SELECT 1 FROM grants g WHERE g.user_name = {r}.user_name AND ({r}.access = 'USE' OR {own}) AND (
   ({r}.object_type = 'FUNCTION' AND g.udf IS NOT NULL AND {db} AND {udf})
   OR ({r}.object_type = 'COLUMN' AND g.udf IS NULL AND {db} AND {tbl} AND {col})
   OR ({r}.object_type IN ('TABLE', 'VIEW') AND g.udf IS NULL AND {db} AND {tbl} AND ({r}.access = 'USE' OR coalesce(g.col, '*') = '*'))
   OR ({r}.object_type = 'DATABASE' AND {r}.access = 'USE' AND ({db} OR {r}."database" = '*'))
   OR ({r}.object_type = 'DATABASE' AND {r}.access <> 'USE' AND g.udf IS NULL AND {db} AND coalesce(g.tbl, '*') = '*' AND coalesce(g.col, '*') = '*')))"""


_TEXT = """concat('Permission denied: user [', user_name, '] does not have [', access, '] privilege on [',
 concat_ws('/', "database", "table", udf, "column"), ']')"""

DECISIONS = f"SELECT *, CASE WHEN NOT allowed THEN {_TEXT} END AS message FROM (SELECT r.*, {allowed()} AS allowed FROM fanned r)"

UNSUPPORTED = "SELECT stmt_id, arg_min(reason, seq) AS reason FROM (SELECT o.stmt_id, o.reason, " + _SEQ + " AS seq FROM objects o WHERE o.reason IS NOT NULL) GROUP BY stmt_id"

_EXCLUDED = " OR ".join(f"regexp_full_match(conf_key, '{p}')" for p in EXCLUDES)
_GUARD = "concat('All user not allow to set this property: ', conf_key, ' !!!')"

VERDICTS = f"""
SELECT s.stmt_id, s.user_name, s.op, g.message IS NULL AND u.reason IS NULL AND d.message IS NULL AS allowed, coalesce(g.message, u.reason, d.message) AS message
FROM ops s
LEFT JOIN (SELECT stmt_id, {_GUARD} AS message FROM ops WHERE command = 'SetCommand' AND conf_key <> '' AND ({_EXCLUDED})) g ON g.stmt_id = s.stmt_id
LEFT JOIN unsupported u ON u.stmt_id = s.stmt_id
LEFT JOIN (SELECT stmt_id, arg_min(message, seq) AS message FROM decisions WHERE NOT allowed GROUP BY stmt_id) d ON d.stmt_id = s.stmt_id"""

AUDIT = """
SELECT d.stmt_id, d.seq, d.col_pos, d.user_name, d.client_ip, d.action, d.access, d.object_type, d."database", d."table", d.udf, d.column_name, d.allowed, d.day
FROM decisions d LEFT JOIN (SELECT stmt_id, min(seq) AS last_seq FROM decisions WHERE NOT allowed GROUP BY stmt_id) f ON f.stmt_id = d.stmt_id
WHERE d.seq <= coalesce(f.last_seq, d.seq) AND d.stmt_id NOT IN (SELECT stmt_id FROM unsupported)"""

# ---- sets of steps -----------------------------------------------------------------------------

_STEPS = [
    ("target", TARGET), ("ops", OPS), ("relation_objects", RELATION_OBJECTS), ("readers", READERS),
    ("command_objects", COMMAND_OBJECTS), ("objects", OBJECTS), ("asked", ASKED), ("requests", REQUESTS), ("fanned", FANNED),
    ("decisions", DECISIONS), ("unsupported", UNSUPPORTED), ("verdicts", VERDICTS), ("audit", AUDIT),
]

MATRIX = [("statements", R.MATRIX_STATEMENTS), ("relations", R.MATRIX_RELATIONS), ("inv", R.INVENTORY), ("grants", R.MIXED_GRANTS)]

_SIMPLE_STATEMENTS = f"""SELECT b.*, CAST(NULL AS VARCHAR) AS client_ip, CAST(NULL AS VARCHAR) AS inner_command, false AS is_view, false AS is_temp,
 false AS is_local, CAST(NULL AS VARCHAR) AS save_mode, CAST(NULL AS VARCHAR) AS conf_key, false AS conf_has_value, CAST(NULL AS VARCHAR) AS new_db,
 CAST(NULL AS VARCHAR) AS new_tbl, CAST(NULL AS VARCHAR) AS func, '' AS cols, concat('hdfs://nn/data/tpch/', b.tbl) AS path FROM ({R.STATEMENTS}) b"""
_PLAIN_GRANTS = f"SELECT *, CAST(NULL AS VARCHAR) AS udf FROM ({R.GRANTS}) g"
SIMPLE = [("statements", _SIMPLE_STATEMENTS), ("relations", R.RELATIONS), ("inv", R.INVENTORY), ("grants", _PLAIN_GRANTS)]


def _query(inputs, select, last):
    names = [name for name, _ in _STEPS]
    return _with(*inputs, *(_STEPS[: names.index(last) + 1] if last else [])) + "\n" + select


def _pm(pattern, value):
    return _fits(pattern, value)


_MASK = "regexp_replace(regexp_replace(regexp_replace({c}, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g')"

_URI = f"""
SELECT stmt_id, user_name, op, path, uri_action, allowed,
 CASE WHEN NOT allowed THEN concat('Permission denied: user [', user_name, '] does not have [', uri_action, '] privilege on [', path, ']') END AS message
FROM (SELECT p.*, CASE WHEN p.uri_action = 'NONE' THEN true
  WHEN p.rx IS NULL THEN false
  WHEN m.n_matches > 0 THEN m.all_permit
  ELSE coalesce((SELECT arg_max(n.owner = p.user_name OR n.others_action = 'ALL' OR (p.uri_action = 'READ' AND n.others_action = 'READ'), length(n.path))
   FROM files n WHERE starts_with(p.path, concat(n.path, '/'))), false) END AS allowed
 FROM paths p LEFT JOIN (
  SELECT q.path, q.user_name, q.uri_action, count(*) AS n_matches, bool_and(f.owner = q.user_name OR f.others_action = 'ALL' OR (q.uri_action = 'READ' AND f.others_action = 'READ')) AS all_permit
  FROM (SELECT DISTINCT path, rx, user_name, uri_action FROM paths) q JOIN files f
   ON regexp_matches(f.path, concat('^', q.rx, '(/|$)'))
  GROUP BY q.path, q.user_name, q.uri_action
 ) m ON m.path = p.path AND m.user_name = p.user_name AND m.uri_action = p.uri_action)"""

_PATHS_CHECKED = f"""SELECT *, CASE WHEN op = 'LOAD' THEN 'READ' WHEN op = 'CREATEVIEW' THEN 'NONE' ELSE 'ALL' END AS uri_action
 FROM ({R.PATHS}) x WHERE starts_with(path, 'hdfs:') OR starts_with(path, 'file:')"""

_VISIBLE = f"""
SELECT DISTINCT u.user_name, i.db, i.tbl FROM (SELECT DISTINCT db, tbl FROM listing WHERE tbl IS NOT NULL) i
 JOIN grants g ON g.udf IS NULL AND {_pm('g.db', 'i.db')} AND {_pm("coalesce(g.tbl, '*')", 'i.tbl')}
 JOIN (SELECT DISTINCT user_name FROM statements WHERE command = 'ShowTablesCommand') u ON u.user_name = g.user_name"""

_RANGES = f"""
SELECT user_name, db, min(number) AS first, max(number) AS last FROM (
 SELECT v.user_name, v.db, n.number, n.number - row_number() OVER (PARTITION BY v.user_name, v.db ORDER BY n.number) AS run FROM ({_VISIBLE}) v
 JOIN (SELECT db, tbl, row_number() OVER (ORDER BY db, tbl) AS number FROM (SELECT DISTINCT db, tbl FROM listing WHERE tbl IS NOT NULL)) n ON n.db = v.db AND n.tbl = v.tbl)
GROUP BY user_name, db, run"""

_LISTED = f"""
SELECT DISTINCT a.user_name, i.db, i.tbl FROM asked a JOIN (SELECT DISTINCT db, tbl FROM listing WHERE tbl IS NOT NULL) i ON i.db = a.db
 JOIN grants g ON g.user_name = a.user_name AND g.udf IS NULL AND {_pm('g.db', 'i.db')} AND {_pm("coalesce(g.tbl, '*')", 'i.tbl')}"""

_METADATA = f"""
SELECT stmt_id, side, ord, obj_type, user_name, coalesce({allowed('r', 'column_name')}, false) AND obj_type IN ('DATABASE', 'TABLE_OR_VIEW') AS allowed
FROM (SELECT o.*, s.user_name, 'USE' AS access, CAST(NULL AS VARCHAR) AS udf, CAST(NULL AS VARCHAR) AS column_name,
  CASE obj_type WHEN 'DATABASE' THEN 'DATABASE' WHEN 'TABLE_OR_VIEW' THEN 'TABLE' END AS object_type,
  CASE obj_type WHEN 'DATABASE' THEN o.name ELSE o.db END AS "database", o.name AS "table"
 FROM objects o JOIN ops s ON s.stmt_id = o.stmt_id WHERE o.reason IS NULL) r"""

_OBJECT_RANK = """
SELECT stmt_id, side, ord, rank() OVER (PARTITION BY user_name, k ORDER BY
  CASE obj_type WHEN 'DATABASE' THEN 0 WHEN 'TABLE_OR_VIEW' THEN 1 WHEN 'FUNCTION' THEN 2 ELSE 3 END NULLS FIRST, db NULLS FIRST, name NULLS FIRST,
  CASE part_keys WHEN '' THEN [] ELSE string_split(part_keys, ',') END NULLS FIRST, CASE columns WHEN '' THEN [] ELSE string_split(columns, ',') END NULLS FIRST) AS position
FROM (SELECT o.*, s.user_name, s.k FROM objects o JOIN ops s ON s.stmt_id = o.stmt_id WHERE o.reason IS NULL)"""

# No grant speaks of paths: what a check without a result means is a setting.
_PATH_REQUESTS = """
SELECT o.stmt_id, d.side, CASE d.side WHEN 'in' THEN 'READ' ELSE 'WRITE' END AS access, true AS allowed, false AS allowed_strictly
FROM objects o JOIN (VALUES ('in'), ('out')) d(side) ON o.obj_type = 'DFS_URI'"""

_OBJECT_TEXT = """
SELECT stmt_id, side, ord, concat('Object [type=', obj_type, ', name=', CASE obj_type WHEN 'DATABASE' THEN db WHEN 'TABLE_OR_VIEW' THEN concat(db, '.', name, '[', part_keys, ']')
 WHEN 'FUNCTION' THEN concat(db, '.', name) ELSE '' END, CASE action WHEN 'OTHER' THEN '' ELSE concat(', action=', action) END, ']') AS text
FROM objects WHERE reason IS NULL"""

_REQUEST = 'stmt_id, seq, access, object_type, "database", "table", udf, "column"'
_BULK = _with(("reqs", f"""SELECT b.*, upper(b.access) AS acc FROM ({R.BULK_REQUESTS}) b"""), ("grants", "{grants}")) + f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, user_name, tbl, col, token AS access, {{allowed}} AS allowed
FROM (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, user_name, tbl, col, access AS token, acc AS access, 'COLUMN' AS object_type,
 db AS "database", tbl AS "table", CAST(NULL AS VARCHAR) AS udf, col AS column_name FROM reqs) r"""  # fmt: skip

_LATER = [(name, _PLAIN_GRANTS if name == "grants" else sql) for name, sql in MATRIX]

# A grant stands in a version unless their numbers add up to a multiple of three; a statement falls under the last version that began by then.
_AS_OF = [("versions", R.VERSIONS), ("under", "SELECT s.stmt_id, v.ver FROM statements s ASOF LEFT JOIN versions v ON s.ts >= v.valid_from")]
_AT_THE_TIME = DECISIONS.replace("FROM fanned r", "FROM (SELECT f.*, u.ver FROM fanned f JOIN under u ON u.stmt_id = f.stmt_id) r").replace(
    "FROM grants g WHERE ", "FROM grants g WHERE (g.gid + r.ver) % 3 <> 0 AND "
)
_HISTORIC = [(name, R.NUMBERED_GRANTS if name == "grants" else sql) for name, sql in MATRIX] + _AS_OF
_HISTORIC_STEPS = [(name, _AT_THE_TIME if name == "decisions" else sql) for name, sql in _STEPS[:-1]]

ORACLES = {
    "denied_selects": _query(SIMPLE, "SELECT v.stmt_id, v.user_name, v.message FROM verdicts v JOIN statements s ON s.stmt_id = v.stmt_id WHERE s.command = 'Query' AND NOT v.allowed", "verdicts"),
    "op_classification": _query(MATRIX, "SELECT stmt_id, command, cmd AS target_command, checked AS objects_checked, op FROM ops", "ops"),
    "query_objects": _query(SIMPLE, "SELECT stmt_id, ord, reason, CASE WHEN reason IS NULL THEN db END AS db, CASE WHEN reason IS NULL THEN name END AS name, CASE WHEN reason IS NULL THEN columns END AS columns, CASE WHEN reason IS NULL THEN part_keys END AS part_keys FROM relation_objects", "relation_objects"),
    "mixed_query_objects": _query(MATRIX, "SELECT stmt_id, ord, reason, db, name, columns, part_keys FROM relation_objects WHERE reason IS NULL", "relation_objects"),
    "unsupported_relations": _query(MATRIX, "SELECT stmt_id, ord, reason FROM relation_objects WHERE reason IS NOT NULL", "relation_objects"),
    "command_objects": _query(MATRIX, "SELECT * FROM command_objects", "command_objects"),
    "statement_objects": _query(MATRIX, "SELECT stmt_id, side, ord, obj_type, db, name, part_keys, columns, action FROM objects WHERE reason IS NULL", "objects"),
    "resource_types": _query(MATRIX, f"SELECT stmt_id, side, ord, object_type, {_KEYS} FROM (SELECT o.*, {object_type()} AS object_type FROM objects o JOIN ops s ON s.stmt_id = o.stmt_id WHERE o.reason IS NULL)", "objects"),
    "access_types": _query(MATRIX, f"SELECT o.stmt_id, o.side, o.ord, {access()} AS access, {access(listing=chr(39) + 'USE' + chr(39))} AS access_show_all FROM objects o JOIN ops s ON s.stmt_id = o.stmt_id WHERE o.reason IS NULL", "objects"),
    "deduped_requests": _query(MATRIX, f"SELECT {_REQUEST}, user_name, action, client_ip FROM requests", "requests"),
    "column_fanout": _query(MATRIX, f"SELECT {_REQUEST}, col_pos, column_name FROM fanned", "fanned"),
    "decisions": _query(MATRIX, f"SELECT {_REQUEST}, col_pos, column_name, allowed FROM decisions", "decisions"),
    "denial_messages": _query(MATRIX, "SELECT stmt_id, seq, col_pos, message FROM decisions WHERE NOT allowed", "decisions"),
    "statement_verdicts": _query(MATRIX, "SELECT * FROM verdicts", "verdicts"),
    "shuffled_verdicts": _query(MATRIX, "SELECT * FROM verdicts", "verdicts"),
    "simple_verdicts": _query(SIMPLE, "SELECT * FROM verdicts", "verdicts"),
    "verdicts_as_of": _with(*_HISTORIC, *_HISTORIC_STEPS) + " SELECT * FROM verdicts",
    "stream_verdicts": _query(MATRIX, "SELECT * FROM verdicts", "verdicts"),
    "audit_rows": _query(MATRIX, "SELECT * FROM audit", "audit"),
    "audit_sink": _query(MATRIX, "SELECT day, user_name, action, allowed, count(*) AS n FROM audit GROUP BY day, user_name, action, allowed", "audit"),
    "stream_audit": _query(MATRIX, "SELECT * FROM audit", "audit"),
    "stream_policy_change": f"SELECT * FROM ({_query(MATRIX, 'SELECT * FROM verdicts', 'verdicts')}) WHERE stmt_id % 2 = 0 UNION ALL SELECT * FROM ({_query(_LATER, 'SELECT * FROM verdicts', 'verdicts')}) WHERE stmt_id % 2 = 1",
    "stream_requests": _query(MATRIX, "SELECT *, '' AS cluster FROM audit", "audit"),
    "verdicts_after_change": _query([(n, R.GRANTS_AFTER if n == "grants" else sql) for n, sql in MATRIX], "SELECT * FROM verdicts", "verdicts"),
    "stream_audit_in_parts": _query(MATRIX, "SELECT * FROM audit", "audit"),
    "committed_audit": _query(MATRIX, "SELECT day, user_name, action, allowed, count(*) AS n FROM audit GROUP BY day, user_name, action, allowed", "audit"),
    "uri_access": _with(("files", R.FILES), ("paths", _PATHS_CHECKED)) + _URI,
    "visible_tables": _with(("statements", R.STATEMENTS), ("listing", R.LISTING), ("grants", R.MIXED_GRANTS)) + _VISIBLE,
    "visible_ranges": _with(("statements", R.STATEMENTS), ("listing", R.LISTING), ("grants", R.MIXED_GRANTS)) + _RANGES,
    "show_tables_listings": _with(("statements", R.STATEMENTS), ("listing", R.LISTING), ("grants", R.MIXED_GRANTS), ("asked", R.ASKED_LISTINGS)) + _LISTED,
    "settings_guard": _with(("statements", R.STATEMENTS), ("settings", R.SETTINGS)) + f" SELECT stmt_id, user_name, conf_key, NOT ({_EXCLUDED}) AS allowed, CASE WHEN {_EXCLUDED} THEN {_GUARD} END AS message FROM settings",
    "metadata_decisions": _query(MATRIX, _METADATA, "objects"),
    "object_order": _query(MATRIX, _OBJECT_RANK, "objects"),
    "object_positions": _query(MATRIX, _OBJECT_RANK.replace("PARTITION BY user_name, k ", ""), "objects"),
    "path_requests": _query(MATRIX, _PATH_REQUESTS, "objects"),
    "object_text": _query(MATRIX, _OBJECT_TEXT, "objects"),
    "masked_customers": f"""SELECT c_custkey, {_MASK.format(c='c_name')} AS c_name, concat({_MASK.format(c='left(c_mktsegment, 4)')}, substr(c_mktsegment, 5)) AS c_mktsegment,
 concat(left(c_phrase, 4), {_MASK.format(c='substr(c_phrase, 5)')}) AS show_first, concat({_MASK.format(c='left(c_phrase, greatest(length(c_phrase) - 4, 0))')}, right(c_phrase, 4)) AS show_last,
 concat(left(c_phrase, greatest(length(c_phrase) - 4, 0)), {_MASK.format(c='right(c_phrase, 4)')}) AS last_masked, sha256(c_phrase) AS hashed
 FROM (SELECT *, concat(c_mktsegment, '-', CAST(c_nationkey AS STRING)) AS c_phrase FROM customer)""",
    "bulk_decisions": _BULK.format(grants=_PLAIN_GRANTS, allowed=allowed()),
    "bulk_decisions_shuffled": _BULK.format(grants=R.MIXED_GRANTS, allowed=allowed()),
    "policy_snapshot": f"SELECT DISTINCT * FROM ({R.MIXED_GRANTS}) g",
    "log_round_trip": _query(MATRIX, "SELECT s.stmt_id, s.command, s.db, s.cols, count(r.ord) AS n_relations, CAST(coalesce(sum(CASE WHEN r.projected = '' THEN 0 ELSE len(string_split(r.projected, ',')) END), 0) AS BIGINT) AS n_names FROM statements s LEFT JOIN relations r ON r.stmt_id = s.stmt_id GROUP BY s.stmt_id, s.command, s.db, s.cols", None),
}
