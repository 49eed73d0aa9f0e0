"""Privilege objects of statements: from the relations they read and from the command itself.

Raw objects are rows with `stmt_id, side, ord, obj_type, db, name, listed, columns_from, part_keys_from,
action, reason`; `attach_schema` turns the last hints into `columns` and `part_keys`. `reason` is set
on relations that cannot be checked at all: they deny their statement.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.expressions import action_of, any_of, unsupported_message
from wardline.functions.rules import TABLE_SIZE_COLUMN, object_templates
from wardline.operators.sizing import lookup

OBJECT_COLUMNS = ["stmt_id", "side", "ord", "obj_type", "db", "name", "part_keys", "columns", "action"]
CONTEXT = ["op", "user_name", "client_ip", "ts"]

_RAW = ["stmt_id", "side", "ord", "obj_type", "db", "name", "listed", "columns_from", "action", "reason"]
_NO_NAMES = "CAST(array() AS array<string>)"


def resolved_columns(projected="projected", catalog_columns="inv_columns") -> Column:
    """The projected names, or all columns of the table where none are projected."""
    return F.expr(f"IF(size({projected}) > 0, {projected}, coalesce({catalog_columns}, {_NO_NAMES}))")


def resolved_part_keys(projected="projected", part_cols="part_cols") -> Column:
    """Partition columns in table order, restricted to the projected names if there are any."""
    kept = f"filter({part_cols}, name -> array_contains({projected}, name))"
    return F.expr(f"coalesce(IF(size({projected}) > 0, {kept}, {part_cols}), {_NO_NAMES})")


def _catalog(inv: DataFrame) -> DataFrame:
    return inv.selectExpr("db AS inv_db", "tbl AS inv_tbl", "columns AS inv_columns", "part_cols")


def _with_catalog(rels: DataFrame, inv: DataFrame) -> DataFrame:
    keyed = rels.selectExpr("*", "db AS inv_db", "tbl AS inv_tbl")
    return lookup(keyed, _catalog(inv), ["inv_db", "inv_tbl"])


def resolve_columns(rels: DataFrame, inv: DataFrame) -> DataFrame:
    """`rels` with the `columns` each relation needs."""
    return _with_catalog(rels, inv).select(*rels.columns, resolved_columns().alias("columns"))


def resolve_part_keys(rels: DataFrame, inv: DataFrame) -> DataFrame:
    """`rels` with the partition columns (`part_keys`) each relation needs."""
    return _with_catalog(rels, inv).select(*rels.columns, resolved_part_keys().alias("part_keys"))


def split_connector_name(rels: DataFrame) -> DataFrame:
    """Adds `connector_db` and `connector_tbl` from names such as `prefix::db.table`; null if malformed."""
    name = "split_part(raw_name, '::', 2)"
    table = f"nullif(split_part({name}, '.', 2), '')"
    return rels.selectExpr(
        "*", f"IF({table} IS NOT NULL, split_part({name}, '.', 1), NULL) AS connector_db", f"{table} AS connector_tbl"
    )


def flag_unsupported(rels: DataFrame) -> DataFrame:
    """Adds `reason`, the text of the denial, on relations that no catalog and no known connector covers."""
    named = rels if "connector_tbl" in rels.columns else split_connector_name(rels)
    unknown = F.expr("kind = 'path' OR (kind = 'connector' AND connector_tbl IS NULL)")
    return named.select(*rels.columns, F.when(unknown, unsupported_message()).alias("reason"))


def route_relations(rels: DataFrame, unresolved_with_db: bool = False) -> DataFrame:
    """Raw objects of relations, by kind; other kinds give none.

    An unresolved relation gives none, as the checker sees its bare name only. With the stricter
    `unresolved_with_db` it gives a table-level object if the log names its database.
    """
    named_kinds = ["catalog", "unresolved"] if unresolved_with_db else ["catalog"]
    # Stated on the columns of the log, so that it reaches the scan.
    counts = f"kind IN ('connector', 'path') OR ({any_of('kind', named_kinds)} AND db IS NOT NULL)"
    return flag_unsupported(split_connector_name(rels.where(counts))).selectExpr(
        "stmt_id",
        "ord",
        "'TABLE_OR_VIEW' AS obj_type",
        "CASE WHEN reason IS NULL THEN IF(kind = 'connector', connector_db, db) END AS db",
        "IF(kind = 'connector', connector_tbl, tbl) AS name",
        f"IF(kind = 'unresolved', {_NO_NAMES}, coalesce(projected, {_NO_NAMES})) AS listed",
        "CASE WHEN kind IN ('catalog', 'connector') THEN kind END AS columns_from",
        "'OTHER' AS action",
        "reason",
    )


def attach_schema(raw: DataFrame, inv: DataFrame) -> DataFrame:
    """Replaces the hints of raw objects by `columns` and `part_keys` from the inventory.

    Only rows that need the catalog carry join keys, the others keep null ones.
    """
    needs = "columns_from IN ('catalog', 'connector', 'schema')"
    keyed = raw.selectExpr("*", f"IF({needs}, db, NULL) AS inv_db", f"IF({needs}, name, NULL) AS inv_tbl")
    joined = lookup(keyed, _catalog(inv), ["inv_db", "inv_tbl"])
    added = {
        "columns": F.when(F.expr(needs), resolved_columns("listed")).otherwise(F.col("listed")),
        "part_keys": F.when(F.expr("columns_from IN ('catalog', 'schema')"), resolved_part_keys("listed")).otherwise(
            F.expr(_NO_NAMES)
        ),
    }
    hints = ["inv_db", "inv_tbl", "inv_columns", "part_cols", "listed", "columns_from"]
    return joined.withColumns(added).drop(*hints)


def expand_query_objects(rels: DataFrame, inv: DataFrame, unresolved_with_db: bool = False) -> DataFrame:
    """Objects of relations, on the input side; rows with a `reason` are denials, not objects."""
    raw = route_relations(rels, unresolved_with_db)
    return attach_schema(raw, inv).withColumn("side", F.lit("in")).select(*OBJECT_COLUMNS, "reason")


def _raw_command_objects(classified: DataFrame, keep: list[str]) -> DataFrame:
    templates = object_templates(classified.sparkSession)
    holds = """
        CASE condition WHEN 'not_temp' THEN NOT coalesce(is_temp, false)
                       WHEN 'not_local' THEN NOT coalesce(is_local, false)
                       WHEN 'permanent_name' THEN NOT coalesce(is_view, false) OR db IS NOT NULL
                       ELSE true END"""
    expanded = classified.join(F.broadcast(templates), "shape").where(holds)
    raw = expanded.select(
        "stmt_id",
        "side",
        F.expr("pos AS ord"),
        "obj_type",
        F.expr("""
            CASE name_from WHEN 'new' THEN new_db WHEN 'newdb' THEN new_db WHEN 'path' THEN path
                           WHEN 'all' THEN NULL ELSE db END AS db"""),
        F.expr("""
            CASE name_from WHEN 'all' THEN NULL WHEN 'db' THEN db WHEN 'newdb' THEN new_db WHEN 'new' THEN new_tbl
                           WHEN 'func' THEN func WHEN 'path' THEN path ELSE tbl END AS name"""),
        F.expr(f"""
            CASE columns_from WHEN 'listed' THEN coalesce(columns, {_NO_NAMES})
                              WHEN 'size' THEN array('{TABLE_SIZE_COLUMN}') ELSE {_NO_NAMES} END AS listed"""),
        "columns_from",
        F.when(F.expr("condition = 'by_mode'"), action_of()).otherwise("OTHER").alias("action"),
        F.expr("CAST(NULL AS STRING) AS reason"),
        F.expr("name_from = 'all' AS all_databases"),
        *keep,
    )
    return raw.where("db IS NOT NULL OR all_databases").drop("all_databases")


def expand_command_objects(classified: DataFrame, inv: DataFrame) -> DataFrame:
    """Objects that classified commands name themselves; the templates are a fixed table."""
    named = _raw_command_objects(classified, []).where("db IS NOT NULL")
    return attach_schema(named, inv).select(OBJECT_COLUMNS)


def build_objects(
    classified: DataFrame,
    rels: DataFrame,
    inv: DataFrame,
    unresolved_with_db: bool = False,
    bucketed: bool = False,
) -> DataFrame:
    """All objects of statements, with the statement's operation, user, client and time on each row.

    A listing of all databases, which names none, is a DATABASE object without a name.

    Both branches are partitioned by `stmt_id`, so the union keeps that partitioning and everything
    done per statement afterwards needs no further exchange. The join brings its own exchanges, which
    leaves AQE free to split the relations of a hot statement. For tables bucketed by `stmt_id` pass
    `bucketed`, and their own layout is used.
    """
    readers = classified.where("reads IS NOT NULL").select("stmt_id", F.expr("reads AS side"), *CONTEXT)
    queried = route_relations(rels, unresolved_with_db).join(readers, "stmt_id")
    naming = classified.where("shape <> 'nothing' AND stmt_id IS NOT NULL")
    commanded = _raw_command_objects(naming if bucketed else naming.repartition("stmt_id"), CONTEXT)
    raw = queried.select(*_RAW, *CONTEXT).unionByName(commanded)
    return attach_schema(raw, inv).select(*OBJECT_COLUMNS, "reason", *CONTEXT)
