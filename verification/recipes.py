"""Inputs derived from the given tables. Each recipe is SQL that Spark and DuckDB both run."""

TABLES = """(VALUES (0,'region','r_regionkey','r_name'),(1,'nation','n_nationkey','n_name'),(2,'customer','c_custkey','c_name'),
 (3,'supplier','s_suppkey','s_name'),(4,'part','p_partkey','p_name'),(5,'orders','o_orderkey','o_custkey'),
 (6,'lineitem','l_orderkey','l_partkey'),(7,'events','event_id','ts')) AS t(i, tbl, first_col, second_col)"""

ACCESSES = "(VALUES (0,'select'),(1,'update'),(2,'alter'),(3,'drop'),(4,'create')) AS a(i, access)"

# Statements of twelve command classes, one per event; `k` counts within a class.
STATEMENTS = f"""
SELECT e.event_id AS stmt_id, CAST(floor(e.event_id / 12) AS BIGINT) AS k, e.ts,
 concat('u', CAST(e.user_id % 20 AS STRING)) AS user_name, c.command, 'tpch' AS db, t.tbl, t.first_col, t.second_col
FROM events e JOIN (VALUES (0,'Query'),(1,'InsertIntoHadoopFsRelationCommand'),(2,'DropTableCommand'),(3,'AlterTableAddPartitionCommand'),
 (4,'TruncateTableCommand'),(5,'DescribeTableCommand'),(6,'ShowTablesCommand'),(7,'CreateDataSourceTableAsSelectCommand'),
 (8,'SetCommand'),(9,'DescribeQueryCommand'),(10,'LoadDataCommand'),(11,'ShowFunctionsCommand')) AS c(i, command) ON e.event_id % 12 = c.i
 JOIN {TABLES} ON CAST(floor(e.event_id / 12) AS BIGINT) % 8 = t.i"""

GRANTS = f"""
SELECT concat('u', CAST(s.s_suppkey % 20 AS STRING)) AS user_name, 'tpch' AS db,
 CASE WHEN s.s_nationkey % 7 = 0 THEN '*' ELSE t.tbl END AS tbl,
 CASE WHEN s.s_nationkey % 3 = 0 AND s.s_nationkey % 7 <> 0 THEN t.first_col ELSE '*' END AS col, a.access
FROM supplier s JOIN {TABLES} ON (s.s_suppkey * 3 + s.s_nationkey) % 8 = t.i
 JOIN {ACCESSES} ON s.s_nationkey % 5 = a.i"""

RELATIONS = """
SELECT stmt_id, 0 AS ord,
 CASE WHEN k % 11 = 10 THEN 'path' WHEN k % 7 = 6 THEN 'connector' WHEN k % 5 = 4 THEN 'unresolved' ELSE 'catalog' END AS kind,
 db, tbl, concat('conn::', db, '.', tbl) AS raw_name,
 CASE k % 3 WHEN 0 THEN '' WHEN 1 THEN first_col ELSE concat(first_col, ',', second_col) END AS projected
FROM statements
WHERE command IN ('Query','InsertIntoHadoopFsRelationCommand','CreateDataSourceTableAsSelectCommand','DescribeQueryCommand')"""

SETTINGS = """
SELECT stmt_id, user_name, command, CASE k % 5 WHEN 0 THEN 'spark.sql.proxy-user' WHEN 1 THEN 'spark.sql.proxy-user.clientIp'
 WHEN 2 THEN 'spark.sql.shuffle.partitions' WHEN 3 THEN 'spark.sql.optimizer.excludedRules' ELSE 'sparkXsql.proxy-user' END AS conf_key
FROM statements WHERE command = 'SetCommand'"""

CONFIGURED_EXCLUDES = (
    "spark.sql.optimizer.excludedRules",
    "spark.sql.hive.convertMetastoreParquet",
    "spark.sql.parquet.int96TimestampConversion",
)

BULK_REQUESTS = f"""
SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, concat('u', CAST(l.l_suppkey % 20 AS STRING)) AS user_name,
 'tpch' AS db, t.tbl, t.first_col AS col, a.access
FROM lineitem l JOIN {TABLES} ON l.l_orderkey % 8 = t.i JOIN {ACCESSES} ON l.l_linenumber % 5 = a.i"""

# The catalog: the tables the statements name.
INVENTORY = """
SELECT db, tbl, cols, parts FROM (VALUES
 ('tpch','region','r_regionkey,r_name',''),
 ('tpch','nation','n_nationkey,n_name,n_regionkey',''),
 ('tpch','customer','c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment',''),
 ('tpch','supplier','s_suppkey,s_name,s_nationkey,s_acctbal',''),
 ('tpch','part','p_partkey,p_name,p_brand,p_type,p_size,p_retailprice',''),
 ('tpch','orders','o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority','o_orderdate'),
 ('tpch','lineitem','l_orderkey,l_partkey,l_suppkey,l_linenumber,l_quantity,l_extendedprice,l_discount,l_tax,l_returnflag,l_linestatus,l_shipdate','l_shipdate'),
 ('tpch','events','event_id,ts,user_id,event_type,value,props','')) AS v(db, tbl, cols, parts)"""

# Every command class of the rule matrix, two that no rule names, and the operation names that a log may carry
# (fixed values).
MATRIX_COMMANDS = """
AlterDatabasePropertiesCommand AlterDatabaseSetLocationCommand AlterTableAddColumnsCommand AlterTableAddPartitionCommand
AlterTableChangeColumnCommand AlterTableDropPartitionCommand AlterTableRenameCommand AlterTableRenamePartitionCommand
AlterTableSerDePropertiesCommand AlterTableSetLocationCommand AlterTableSetPropertiesCommand AlterTableUnsetPropertiesCommand
AlterViewAsCommand AnalyzeColumnCommand AnalyzePartitionCommand AnalyzeTableCommand AnalyzeTablesCommand CreateDatabaseCommand
CreateDataSourceTableAsSelectCommand CreateHiveTableAsSelectCommand CreateTableCommand CreateDataSourceTableCommand
CreateTableLikeCommand CreateFunctionCommand CreateViewCommand CreateTempViewUsing DescribeColumnCommand DescribeDatabaseCommand
DescribeFunctionCommand DescribeQueryCommand DescribeTableCommand DropDatabaseCommand DropFunctionCommand DropTableCommand
InsertIntoDataSourceCommand InsertIntoDataSourceDirCommand InsertIntoHadoopFsRelationCommand InsertIntoHiveDirCommand
InsertIntoHiveTable LoadDataCommand SaveIntoDataSourceCommand RefreshFunctionCommand RefreshTableCommand RepairTableCommand
ShowColumnsCommand ShowCreateTableCommand ShowCreateTableAsSerdeCommand ShowFunctionsCommand ShowPartitionsCommand
ShowTablePropertiesCommand ShowTablesCommand ShowViewsCommand TruncateTableCommand SetCommand ExplainCommand
StreamingExplainCommand AddFileCommand AddJarCommand Query SHOWDATABASES SWITCHDATABASE CACHE STREAM MUTATION DATA_MAP MANAGEMENT
""".split()

_N = len(MATRIX_COMMANDS)
_COMMAND_VALUES = ",".join(f"({i},'{name}')" for i, name in enumerate(MATRIX_COMMANDS))

# Statements of all classes with all their flags; `k` counts within a class, `cols` is comma-joined.
MATRIX_STATEMENTS = f"""
SELECT e.event_id AS stmt_id, e.ts, e.k, concat('u', CAST(e.user_id % 20 AS STRING)) AS user_name,
 CASE WHEN e.k % 4 < 3 THEN concat('10.0.0.', CAST(e.user_id % 250 AS STRING)) END AS client_ip,
 c.command, CASE WHEN c.command IN ('ExplainCommand', 'StreamingExplainCommand') THEN w.command END AS inner_command,
 e.k % 2 = 1 AS is_view, e.k % 3 = 1 AS is_temp, e.k % 5 < 2 AS is_local,
 CASE e.k % 6 WHEN 0 THEN 'Append' WHEN 1 THEN 'Overwrite' WHEN 2 THEN 'ErrorIfExists' WHEN 3 THEN 'Ignore' END AS save_mode,
 CASE WHEN c.command = 'SetCommand' OR w.command = 'SetCommand' THEN CASE e.k % 6 WHEN 0 THEN 'spark.sql.proxy-user'
  WHEN 1 THEN 'spark.sql.proxy-user.clientIp' WHEN 2 THEN 'spark.sql.shuffle.partitions' WHEN 3 THEN 'spark.sql.optimizer.excludedRules'
  WHEN 4 THEN 'sparkXsql.proxy-user' END END AS conf_key,
 e.k % 7 < 4 AS conf_has_value,
 CASE WHEN e.k % 13 <> 12 THEN 'tpch' END AS db, t.tbl,
 CASE WHEN e.k % 11 <> 10 THEN 'tpch' END AS new_db, concat(t.tbl, '_new') AS new_tbl, concat('f_', t.tbl) AS func,
 CASE e.k % 3 WHEN 0 THEN t.first_col WHEN 1 THEN concat(t.first_col, ',', t.second_col) ELSE '' END AS cols,
 concat('hdfs://nn/data/tpch/', t.tbl) AS path, t.first_col, t.second_col
FROM (SELECT event_id, ts, user_id, CAST(floor(event_id / {_N}) AS BIGINT) AS k FROM events) e
 JOIN (VALUES {_COMMAND_VALUES}) AS c(i, command) ON e.event_id % {_N} = c.i
 JOIN (VALUES {_COMMAND_VALUES}) AS w(i, command) ON e.k % {_N} = w.i
 JOIN {TABLES} ON (e.k + e.user_id) % 8 = t.i"""

# Up to three relations per statement, of all kinds, some with names that are malformed or lack a database, some with
# blank column names (a blank, an em space).
MATRIX_RELATIONS = f"""
SELECT s.stmt_id, CAST(r.ord AS INT) AS ord,
 CASE (s.k + 3 * r.ord) % 9 WHEN 5 THEN 'connector' WHEN 6 THEN 'unresolved' WHEN 7 THEN 'local'
  WHEN 8 THEN CASE WHEN s.k % 4 = 0 THEN 'path' ELSE 'connector' END ELSE 'catalog' END AS kind,
 CASE WHEN (s.k + r.ord) % 17 <> 16 THEN 'tpch' END AS db, t.tbl,
 CASE WHEN (s.k + r.ord) % 19 = 18 THEN concat('bare.', t.tbl) WHEN (s.k + r.ord) % 19 = 17 THEN 'conn::bare' ELSE concat('conn::tpch.', t.tbl) END AS raw_name,
 CASE (s.k + r.ord) % 4 WHEN 0 THEN t.first_col WHEN 1 THEN concat(t.first_col, ',', t.second_col) WHEN 2 THEN concat(t.second_col, ', , ,', t.first_col) ELSE '' END AS projected
FROM statements s JOIN (VALUES (0,0),(1,0),(1,1),(2,0),(2,1),(2,2),(3,0),(3,1),(3,2)) AS r(m, ord) ON s.k % 4 = r.m
 JOIN {TABLES} ON (s.stmt_id + r.ord) % 8 = t.i"""

# Grants of all shapes: prefixes in every key, functions, nulls, every access.
MIXED_GRANTS = f"""
SELECT concat('u', CAST(c.c_custkey % 300 AS STRING)) AS user_name,
 CASE c.c_custkey % 7 WHEN 0 THEN 'tp*' WHEN 1 THEN '*' WHEN 2 THEN 'other' ELSE 'tpch' END AS db,
 CASE WHEN c.c_custkey % 5 = 4 THEN NULL ELSE CASE c.c_nationkey % 4 WHEN 0 THEN '*' WHEN 1 THEN concat(substr(t.tbl, 1, 2), '*') ELSE t.tbl END END AS tbl,
 CASE WHEN c.c_custkey % 5 = 4 THEN NULL ELSE CASE c.c_nationkey % 3 WHEN 0 THEN '*' WHEN 1 THEN concat(substr(t.first_col, 1, 3), '*') ELSE t.second_col END END AS col,
 CASE WHEN c.c_custkey % 5 = 4 THEN CASE c.c_nationkey % 2 WHEN 0 THEN 'f_*' ELSE concat('f_', t.tbl) END END AS udf,
 CASE c.c_nationkey % 6 WHEN 0 THEN 'select' WHEN 1 THEN 'update' WHEN 2 THEN 'alter' WHEN 3 THEN 'drop' WHEN 4 THEN 'create' ELSE 'admin' END AS access
FROM customer c JOIN {TABLES} ON (c.c_custkey + c.c_nationkey) % 8 = t.i
UNION ALL
SELECT user_name, db, tbl, col, CAST(NULL AS STRING) AS udf, access FROM ({GRANTS}) g"""

# A listing to filter: the catalog and one table per part; some rows have no table name.
LISTING = f"""
SELECT db, tbl FROM ({INVENTORY}) i
UNION ALL
SELECT CASE p_size % 3 WHEN 0 THEN 'tpch' WHEN 1 THEN 'tpcds' ELSE 'sales' END AS db,
 CASE WHEN p_partkey % 10 <> 9 THEN concat(CASE p_size % 4 WHEN 0 THEN 'part_' WHEN 1 THEN 'ordering_' WHEN 2 THEN 'na' ELSE 'x' END, CAST(p_partkey AS STRING)) END AS tbl
FROM part"""

# Who asks for the tables of which database.
ASKED_LISTINGS = """
SELECT user_name, CASE k % 3 WHEN 0 THEN 'tpch' WHEN 1 THEN 'sales' ELSE 'none' END AS db FROM statements WHERE command = 'ShowTablesCommand'"""

# Existing files: for each supplier one below the folder of a table, some tables with a file of that very name.
FILES = f"""
SELECT concat('hdfs://nn/data/tpch/', t.tbl, '/day=', CAST(s.s_nationkey AS STRING), '/part-', CAST(s.s_suppkey AS STRING)) AS path,
 concat('u', CAST(s.s_nationkey % 20 AS STRING)) AS owner,
 CASE s.s_nationkey % 3 WHEN 0 THEN 'NONE' WHEN 1 THEN 'READ' ELSE 'ALL' END AS others_action
FROM supplier s JOIN {TABLES} ON s.s_nationkey % 8 = t.i
UNION ALL
SELECT concat('hdfs://nn/data/tpch/', t.tbl, '/extra') AS path, concat('u', CAST(n.n_nationkey % 20 AS STRING)) AS owner,
 CASE n.n_nationkey % 3 WHEN 0 THEN 'NONE' WHEN 1 THEN 'READ' ELSE 'ALL' END AS others_action
FROM nation n JOIN {TABLES} ON n.n_nationkey = t.i"""

# Paths that operations name: files, folders, globs of all kinds, missing ones with and without an existing parent,
# and globs that are broken. `rx` says as a regular expression what a path means, for DuckDB alone; null: broken.
_AT = "'hdfs://nn/data/tpch/', t.tbl"
PATHS = f"""
SELECT stmt_id, user_name, op, path, CASE WHEN rx = '' THEN replace(replace(replace(path, '.', '[.]'), '*', '[^/]*'), '?', '[^/]') ELSE rx END AS rx
FROM (SELECT e.event_id AS stmt_id, concat('u', CAST(e.user_id % 20 AS STRING)) AS user_name,
 CASE e.event_id % 5 WHEN 0 THEN 'LOAD' WHEN 1 THEN 'QUERY' WHEN 2 THEN 'CREATETABLE' WHEN 3 THEN 'ALTERTABLE_LOCATION' ELSE 'CREATEVIEW' END AS op,
 CASE CAST(floor(e.event_id / 5) AS BIGINT) % 16
  WHEN 0 THEN concat({_AT}, '/day=', CAST(e.user_id % 25 AS STRING))
  WHEN 1 THEN concat({_AT}, '/day=', CAST(e.user_id % 25 AS STRING), '/part-', CAST(e.event_id % 100 AS STRING))
  WHEN 2 THEN concat({_AT}, '/day=*/part-', CAST(e.event_id % 10 AS STRING), '*')
  WHEN 3 THEN concat({_AT}, '/day=', CAST(e.user_id % 10 AS STRING), '?')
  WHEN 4 THEN concat({_AT}, '/extra/deep/', CAST(e.event_id AS STRING))
  WHEN 5 THEN concat('hdfs://nn/data/none/', CAST(e.event_id AS STRING))
  WHEN 6 THEN concat('s3://data/', t.tbl)
  WHEN 7 THEN concat({_AT}, '/extra')
  WHEN 8 THEN concat('hdfs://nn/data/tpch/{{', t.tbl, ',none}}/day=', CAST(e.user_id % 25 AS STRING))
  WHEN 9 THEN concat('hdfs://nn/data/{{none/x,tpch/', t.tbl, '/day={{1{{0,1}},', CAST(e.user_id % 25 AS STRING), '}}}}/part-*')
  WHEN 10 THEN concat({_AT}, '/day=[1', CAST(e.user_id % 10 AS STRING), ']/part-[0-4]*')
  WHEN 11 THEN concat({_AT}, '/day=[!1-', CAST(2 + e.user_id % 7 AS STRING), ']')
  WHEN 12 THEN concat({_AT}, '/e', chr(92), 'x*')
  WHEN 13 THEN concat({_AT}, '/ext?a', chr(92), '*')
  WHEN 14 THEN concat({_AT}, '/extra/{{a,b')
  ELSE concat({_AT}, '/extra/[ab') END AS path,
 CASE CAST(floor(e.event_id / 5) AS BIGINT) % 16
  WHEN 8 THEN concat({_AT}, '/day=', CAST(e.user_id % 25 AS STRING))
  WHEN 9 THEN concat({_AT}, '/day=(10|11|', CAST(e.user_id % 25 AS STRING), ')/part-[^/]*')
  WHEN 10 THEN concat({_AT}, '/day=[1', CAST(e.user_id % 10 AS STRING), ']/part-[0-4][^/]*')
  WHEN 11 THEN concat({_AT}, '/day=[^/1-', CAST(2 + e.user_id % 7 AS STRING), ']')
  WHEN 12 THEN concat({_AT}, '/ex[^/]*')
  WHEN 13 THEN concat({_AT}, '/ext[^/]a[*]')
  WHEN 14 THEN CAST(NULL AS STRING)
  WHEN 15 THEN CAST(NULL AS STRING)
  ELSE '' END AS rx
 FROM events e JOIN {TABLES} ON e.user_id % 8 = t.i) x"""

# Times at which policies change: those of some events, so that a statement may fall on a change.
VERSIONS = "SELECT CAST(floor(event_id / 499) AS BIGINT) AS ver, ts AS valid_from FROM events WHERE event_id % 499 = 5"

# Grants with a number that says in which versions they stand: not in every third.
NUMBERED_GRANTS = f"""
SELECT *, CAST(substr(user_name, 2) AS BIGINT) + length(concat_ws('/', db, tbl, col, udf, access)) AS gid FROM ({MIXED_GRANTS}) m"""
SNAPSHOTS = """
SELECT g.user_name, g.db, g.tbl, g.col, g.udf, g.access, v.valid_from
FROM versions v JOIN (VALUES (0,1),(0,2),(1,0),(1,1),(2,0),(2,2)) AS h(m, r) ON v.ver % 3 = h.m JOIN grants g ON g.gid % 3 = h.r"""

# Grants before and after a change that drops some and adds some.
GRANTS_BEFORE = f"SELECT user_name, db, tbl, col, udf, access FROM ({NUMBERED_GRANTS}) n WHERE gid % 11 <> 3"
GRANTS_AFTER = f"SELECT user_name, db, tbl, col, udf, access FROM ({NUMBERED_GRANTS}) n WHERE gid % 11 <> 5"
