"""From command class to operation type."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions.rules import command_rules

def unwrap_explain(stmts: DataFrame) -> DataFrame:
    """Adds `target_command`, the command whose rules count, and `objects_checked`.

    EXPLAIN stands for what it wraps, one level deep. Streaming EXPLAIN takes over the operation
    only, and a plain SHOW TABLES is not checked: its rows are filtered instead.
    """
    target = """
        CASE WHEN command IN ('ExplainCommand', 'StreamingExplainCommand') THEN coalesce(inner_command, 'Query')
             ELSE coalesce(command, 'Query') END"""
    checked = "coalesce(command, 'Query') NOT IN ('StreamingExplainCommand', 'ShowTablesCommand')"
    return stmts.withColumns({"target_command": F.expr(target), "objects_checked": F.expr(checked)})


def classify_operation(stmts: DataFrame) -> DataFrame:
    """Adds `op`, and the `shape` and `reads` that say which objects the statement has.

    The rule table has a fixed number of rows. Commands it does not know count as EXPLAIN. A listing of
    all databases goes by the operation alone, so it keeps its shape where objects are not checked.
    """
    rules = command_rules(stmts.sparkSession)
    flag_set = """
        CASE flag WHEN 'is_view' THEN is_view WHEN 'is_temp' THEN is_temp
                  WHEN 'reads' THEN conf_key IS NULL OR NOT coalesce(conf_has_value, false) END"""
    added = {
        "op": F.expr(f"coalesce(CASE WHEN {flag_set} THEN flag_op END, rule_op, 'EXPLAIN')"),
        "shape": F.expr("IF(objects_checked OR shape = 'all_databases', coalesce(shape, 'nothing'), 'nothing')"),
        "reads": F.expr("CASE WHEN objects_checked THEN reads END"),
    }
    classified = unwrap_explain(stmts).join(F.broadcast(rules), "target_command", "left").withColumns(added)
    return classified.drop("rule_op", "flag_op", "flag")
