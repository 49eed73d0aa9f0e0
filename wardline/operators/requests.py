"""Access requests: what each statement asks for, once."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions import expressions as X
from wardline.functions.rules import UNKNOWN_CLIENT, access_rules

RESOURCE = ["database", "table", "udf", "column"]
ENVELOPE = ["user_name", "action", "client_ip", "cluster", "ts"]
_OF_REQUEST = {"needed": "access", "object_type": "object_type", **{c: c for c in RESOURCE}}
REQUEST_COLUMNS = ["stmt_id", "seq", "access", "object_type", *RESOURCE, "reason", *ENVELOPE]

# Position in a statement: inputs first, then outputs. What denies outright comes before all requests.
_POSITION = "IF(side = 'out', 4294967296L, 0L) + ord"
_REJECTED_POSITION = "ord - 1099511627776L"


# A sign that is no white space: neither a separator of Unicode (but for those that do not break) nor one of the
# control characters that count as white space (fixed values).
_INK = r"[^\p{Z}\x09-\x0D\x1C-\x1F]|[\u00A0\u2007\u202F]"


def with_access(objs: DataFrame, show_all: bool = False) -> DataFrame:
    """Adds `object_type` and `needed`, the access each object needs; the rules are a fixed table."""
    rules = access_rules(objs.sparkSession, show_all)
    typed = objs.withColumn("object_type", X.object_type())
    ruled = typed.join(F.broadcast(rules), typed["op"] == rules["rule_op"], "left")
    return ruled.withColumn("needed", X.access_type()).drop("rule_op", "needs", "on_input", "on_output")


def object_requests(objs: DataFrame, show_all: bool = False, cluster: str = "") -> DataFrame:
    """One request per object that makes a resource and needs an access; paths make none.

    Rows with a `reason` pass through ahead of all requests.
    """
    needed = with_access(objs, show_all).withColumns(X.resource_keys())
    asking = needed.where("reason IS NOT NULL OR (database IS NOT NULL AND needed <> 'NONE')")
    return asking.selectExpr(
        "stmt_id",
        f"IF(reason IS NULL, {_POSITION}, {_REJECTED_POSITION}) AS seq",
        *[f"CASE WHEN reason IS NULL THEN {c} END AS {n}" for c, n in _OF_REQUEST.items()],
        "reason",
        "user_name",
        "op AS action",
        f"coalesce(client_ip, {X.quoted(UNKNOWN_CLIENT)}) AS client_ip",
        f"{X.quoted(cluster)} AS cluster",
        "ts",
    )


def dedupe_requests(reqs: DataFrame) -> DataFrame:
    """Keeps the first of the requests with equal access and resource in a statement.

    Everything but the position is a grouping key, as it follows from the statement, the access and
    the resource. That leaves a hash aggregate of one number, which combines before any exchange.
    """
    keys = [c for c in REQUEST_COLUMNS if c != "seq"]
    return reqs.groupBy(*keys).agg(F.min("seq").alias("seq")).select(REQUEST_COLUMNS)


def build_requests(objs: DataFrame, show_all: bool = False, cluster: str = "") -> DataFrame:
    """All requests of statements. The object without a name, a listing of all databases, asks for `*`."""
    return dedupe_requests(object_requests(objs, show_all, cluster))


def fan_out_columns(reqs: DataFrame) -> DataFrame:
    """One row per column: a joined list is split at its commas and loses its blank names.

    Adds `column_name` and `col_pos`. The list stays in `column`, where messages show it. A request
    with one name stays as it is, and one with blank names only leaves nothing to check. Blank is what
    has no sign but white space of any script.
    """
    several = "coalesce(contains(column, ','), false)"
    names = f"IF({several}, split(column, ','), array(column))"
    fanned = reqs.selectExpr("*", f"posexplode({names}) AS (col_pos, column_name)")
    return fanned.where(rf"NOT {several} OR column_name RLIKE r'{_INK}'")
