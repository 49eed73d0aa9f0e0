"""The rule tables, as data.

The values in this file are fixed: command names, operation names, access names and the pairing
between them define the results, so they are listed plainly.
"""

from pyspark.sql import DataFrame, SparkSession

# Command class, operation type, operation type when `flag` holds, flag, object shape
# (see SHAPES), side on which the relations of the embedded query count ("-": they do not).
# The last block holds operation names that a log may carry directly instead of a command class.
COMMANDS = """
AlterDatabasePropertiesCommand        ALTERDATABASE             -                 -        database_out     -
AlterDatabaseSetLocationCommand       ALTERDATABASE_LOCATION    -                 -        database_out     -
AlterTableAddColumnsCommand           ALTERTABLE_ADDCOLS        -                 -        columns_both     -
AlterTableAddPartitionCommand         ALTERTABLE_ADDPARTS       -                 -        table_both       -
AlterTableChangeColumnCommand         ALTERTABLE_RENAMECOL      -                 -        columns_in       -
AlterTableDropPartitionCommand        ALTERTABLE_DROPPARTS      -                 -        table_both       -
AlterTableRenameCommand               ALTERTABLE_RENAME         ALTERVIEW_RENAME  is_view  rename           -
AlterTableRenamePartitionCommand      ALTERTABLE_RENAMEPART     -                 -        table_both       -
AlterTableSerDePropertiesCommand      ALTERTABLE_SERDEPROPERTIES -                -        table_both       -
AlterTableSetLocationCommand          ALTERTABLE_LOCATION       -                 -        table_both       -
AlterTableSetPropertiesCommand        ALTERTABLE_PROPERTIES     -                 -        table_both       -
AlterTableUnsetPropertiesCommand      ALTERTABLE_PROPERTIES     -                 -        table_both       -
AlterViewAsCommand                    QUERY                     -                 -        table_out        in
AnalyzeColumnCommand                  QUERY                     -                 -        columns_both     -
AnalyzePartitionCommand               QUERY                     -                 -        table_both       -
AnalyzeTableCommand                   QUERY                     -                 -        table_size       -
AnalyzeTablesCommand                  QUERY                     -                 -        database_both    -
CreateDatabaseCommand                 CREATEDATABASE            -                 -        database_out     -
CreateDataSourceTableAsSelectCommand  CREATETABLE_AS_SELECT     -                 -        new_table_mode   in
CreateHiveTableAsSelectCommand        CREATETABLE_AS_SELECT     -                 -        new_table        in
CreateTableCommand                    CREATETABLE               -                 -        new_table        -
CreateDataSourceTableCommand          CREATETABLE               -                 -        table_out        -
CreateTableLikeCommand                CREATETABLE               -                 -        like             -
CreateFunctionCommand                 CREATEFUNCTION            -                 -        new_function     -
CreateViewCommand                     CREATEVIEW                -                 -        new_view         in
CreateTempViewUsing                   CREATEVIEW                -                 -        nothing          -
DescribeColumnCommand                 DESCTABLE                 -                 -        columns_in       -
DescribeDatabaseCommand               DESCDATABASE              -                 -        database_in      -
DescribeFunctionCommand               DESCFUNCTION              -                 -        function_in      -
DescribeQueryCommand                  DESCQUERY                 -                 -        nothing          in
DescribeTableCommand                  DESCTABLE                 -                 -        table_in         -
DropDatabaseCommand                   DROPDATABASE              -                 -        database_both    -
DropFunctionCommand                   DROPTABLE                 DROPFUNCTION      is_temp  function_both    -
DropTableCommand                      DROPTABLE                 DROPVIEW          is_view  table_both       -
InsertIntoDataSourceCommand           QUERY                     -                 -        table_out        in
InsertIntoDataSourceDirCommand        QUERY                     -                 -        nothing          in
InsertIntoHadoopFsRelationCommand     LOAD                      -                 -        full_table_out   in
InsertIntoHiveDirCommand              QUERY                     -                 -        nothing          in
InsertIntoHiveTable                   LOAD                      -                 -        table_out        in
LoadDataCommand                       LOAD                      -                 -        load             -
SaveIntoDataSourceCommand             QUERY                     -                 -        nothing          out
RefreshFunctionCommand                REFRESHFUNCTION           -                 -        function_both    -
RefreshTableCommand                   REFRESHTABLE              -                 -        table_both       -
RepairTableCommand                    MSCK                      -                 -        table_both       -
SetCommand                            EXPLAIN                   SHOWCONF          reads    nothing          -
ShowColumnsCommand                    SHOWCOLUMNS               -                 -        table_in         -
ShowCreateTableCommand                SHOW_CREATETABLE          -                 -        table_in         -
ShowCreateTableAsSerdeCommand         SHOW_CREATETABLE          -                 -        table_in         -
ShowFunctionsCommand                  SHOWFUNCTIONS             -                 -        database_in      -
ShowPartitionsCommand                 SHOWPARTITIONS            -                 -        table_in         -
ShowTablePropertiesCommand            SHOW_TBLPROPERTIES        -                 -        table_in         -
ShowTablesCommand                     SHOWTABLES                -                 -        database_in      -
ShowViewsCommand                      SHOWVIEWS                 -                 -        database_in      -
TruncateTableCommand                  TRUNCATETABLE             -                 -        table_both       -
Query                                 QUERY                     -                 -        nothing          in
SHOWDATABASES                         SHOWDATABASES             -                 -        all_databases    -
SWITCHDATABASE                        SWITCHDATABASE            -                 -        database_in      -
CACHE                                 CACHE                     -                 -        table_in         -
STREAM                                STREAM                    -                 -        table_out        in
MUTATION                              MUTATION                  -                 -        table_out        in
DATA_MAP                              DATA_MAP                  -                 -        table_out        -
MANAGEMENT                            MANAGEMENT                -                 -        table_out        in
"""

# The objects of each shape as side, object type, source of the names, source of the
# columns, condition. The position in a side is the position in the list.
SHAPES = """
database_in     in   DATABASE       db    -       -
database_out    out  DATABASE       db    -       -
database_both   in   DATABASE       db    -       -
database_both   out  DATABASE       db    -       -
table_in        in   TABLE_OR_VIEW  tbl   -       -
table_out       out  TABLE_OR_VIEW  tbl   -       -
table_both      in   TABLE_OR_VIEW  tbl   -       -
table_both      out  TABLE_OR_VIEW  tbl   -       -
table_size      in   TABLE_OR_VIEW  tbl   size    -
table_size      out  TABLE_OR_VIEW  tbl   -       -
columns_in      in   TABLE_OR_VIEW  tbl   listed  -
columns_both    in   TABLE_OR_VIEW  tbl   listed  -
columns_both    out  TABLE_OR_VIEW  tbl   listed  -
full_table_out  out  TABLE_OR_VIEW  tbl   schema  -
rename          in   TABLE_OR_VIEW  tbl   -       permanent_name
rename          out  TABLE_OR_VIEW  new   -       permanent_name
new_table       out  DATABASE       db    -       -
new_table       out  TABLE_OR_VIEW  tbl   -       -
new_table_mode  out  DATABASE       db    -       -
new_table_mode  out  TABLE_OR_VIEW  tbl   -       by_mode
new_view        out  DATABASE       db    -       not_temp
new_view        out  TABLE_OR_VIEW  tbl   -       not_temp
new_function    out  DATABASE       db    -       not_temp
new_function    out  FUNCTION       func  -       not_temp
function_in     in   FUNCTION       func  -       -
function_both   in   FUNCTION       func  -       -
function_both   out  FUNCTION       func  -       -
like            in   DATABASE       db    -       -
like            in   TABLE_OR_VIEW  tbl   -       -
like            out  DATABASE       newdb -       -
like            out  TABLE_OR_VIEW  new   -       -
all_databases   in   DATABASE       all   -       -
load            in   DFS_URI        path  -       not_local
load            out  TABLE_OR_VIEW  tbl   -       -
"""

# Operation types, object type they need ("-": any), access on the input side, access
# on the output side. What is not listed needs no access.
ACCESS = """
CREATEDATABASE                                                            DATABASE       CREATE  CREATE
CREATEFUNCTION                                                            FUNCTION       CREATE  CREATE
CREATETABLE,CREATEVIEW,CREATETABLE_AS_SELECT                              TABLE_OR_VIEW  SELECT  CREATE
ALTERDATABASE,ALTERDATABASE_LOCATION                                      -              ALTER   ALTER
ALTERTABLE_ADDCOLS,ALTERTABLE_ADDPARTS,ALTERTABLE_DROPPARTS               -              ALTER   ALTER
ALTERTABLE_LOCATION,ALTERTABLE_PROPERTIES,ALTERTABLE_SERDEPROPERTIES      -              ALTER   ALTER
ALTERTABLE_RENAME,ALTERTABLE_RENAMECOL,ALTERTABLE_RENAMEPART              -              ALTER   ALTER
ALTERVIEW_RENAME,MSCK,REFRESHTABLE,REFRESHFUNCTION                        -              ALTER   ALTER
DROPFUNCTION,DROPTABLE,DROPVIEW,DROPDATABASE                              -              DROP    DROP
LOAD                                                                      -              SELECT  UPDATE
QUERY,SHOW_CREATETABLE,SHOWPARTITIONS,SHOW_TBLPROPERTIES,DESCFUNCTION     -              SELECT  SELECT
SHOWDATABASES,SWITCHDATABASE,DESCDATABASE                                 -              USE     USE
SHOWTABLES,SHOWFUNCTIONS,SHOWVIEWS                                        -              USE     USE
TRUNCATETABLE                                                             -              UPDATE  UPDATE
CACHE,DATA_MAP                                                            -              ADMIN   ADMIN
STREAM                                                                    -              SELECT  ADMIN
MUTATION,MANAGEMENT                                                       -              SELECT  UPDATE
"""

# Fixed values.
COLUMN_LISTING_OPS = ("SHOWCOLUMNS", "DESCTABLE")
SHOW_ALL = "show-all"
TABLE_SIZE_COLUMN = "RAW__DATA__SIZE"
OBJECT_TYPES = ("DATABASE", "TABLE_OR_VIEW", "FUNCTION", "DFS_URI")
ANY_TOKEN = "_any"
ADMIN_TOKEN = "_admin"
UNKNOWN_CLIENT = "Error"
METADATA_ACTION = "METADATA OPERATION"
ALWAYS_EXCLUDED_KEYS = ("spark.sql.optimizer.excludedRules", "spark.sql.proxy-user")
FILE_SCHEMES = ("hdfs:", "file:")
READ_OPS = ("LOAD",)
FULL_OPS = (
    "CREATEDATABASE", "CREATETABLE", "CREATETABLE_AS_SELECT", "ALTERDATABASE", "ALTERTABLE_ADDCOLS",
    "ALTERTABLE_RENAMECOL", "ALTERTABLE_RENAMEPART", "ALTERTABLE_RENAME", "ALTERTABLE_DROPPARTS",
    "ALTERTABLE_ADDPARTS", "ALTERTABLE_PROPERTIES", "ALTERTABLE_SERDEPROPERTIES", "ALTERTABLE_LOCATION", "QUERY",
)


def _rows(text: str) -> list[list[str | None]]:
    return [[None if cell == "-" else cell for cell in line.split()] for line in text.strip().splitlines()]


def values_table(spark: SparkSession, columns: list[str], rows: list[list[str | None]]) -> DataFrame:
    """A literal table of strings, known to the optimizer with its size."""

    def cell(value):
        return "CAST(NULL AS STRING)" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    body = ", ".join("(" + ", ".join(cell(value) for value in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(columns)})")


def command_rules(spark: SparkSession) -> DataFrame:
    """One row per command class: target_command, rule_op, flag_op, flag, shape, reads."""
    return values_table(
        spark, ["target_command", "rule_op", "flag_op", "flag", "shape", "reads"], _rows(COMMANDS)
    )


def access_rules(spark: SparkSession, show_all: bool = False) -> DataFrame:
    """One row per operation that needs an access: rule_op, needs, on_input, on_output.

    `show_all` lets column listings pass with any access on the table.
    """
    listing = "USE" if show_all else "SELECT"
    rows = [[op, None, listing, listing] for op in COLUMN_LISTING_OPS]
    rows += [[op, *rule] for ops, *rule in _rows(ACCESS) for op in ops.split(",")]
    return values_table(spark, ["rule_op", "needs", "on_input", "on_output"], rows)


def object_templates(spark: SparkSession) -> DataFrame:
    """One row per object of a shape: shape, side, pos, obj_type, name_from, columns_from, condition."""
    rows, seen = [], {}
    for shape, side, *rest in _rows(SHAPES):
        seen[shape, side] = seen.get((shape, side), -1) + 1
        rows.append([shape, side, str(seen[shape, side]), *rest])
    table = values_table(
        spark, ["shape", "side", "pos", "obj_type", "name_from", "columns_from", "condition"], rows
    )
    return table.withColumn("pos", table.pos.cast("int"))
