"""Explicit schemas of every table that enters or leaves the package; nothing is inferred."""

from pyspark.sql import types as T

_TEXT = T.StringType()
_NAMES = T.ArrayType(T.StringType())
_FLAG = T.BooleanType()


def _schema(*fields):
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


# One row per statement. `command` is the class of the plan, "Query" (or null) for a plan that is no command.
STATEMENTS = _schema(
    ("stmt_id", T.LongType(), False),
    ("ts", T.TimestampType(), True),
    ("user_name", _TEXT, True),
    ("client_ip", _TEXT, True),
    ("command", _TEXT, True),
    ("inner_command", _TEXT, True),
    ("is_view", _FLAG, True),
    ("is_temp", _FLAG, True),
    ("is_local", _FLAG, True),
    ("save_mode", _TEXT, True),
    ("conf_key", _TEXT, True),
    ("conf_has_value", _FLAG, True),
    ("db", _TEXT, True),
    ("tbl", _TEXT, True),
    ("new_db", _TEXT, True),
    ("new_tbl", _TEXT, True),
    ("func", _TEXT, True),
    ("columns", _NAMES, True),
    ("path", _TEXT, True),
)

# One row per relation a statement touches, subqueries included. `projected` holds the names the
# statement takes from this relation; empty or null means all of its columns.
RELATIONS = _schema(
    ("stmt_id", T.LongType(), False),
    ("ord", T.IntegerType(), False),
    ("kind", _TEXT, True),
    ("db", _TEXT, True),
    ("tbl", _TEXT, True),
    ("raw_name", _TEXT, True),
    ("projected", _NAMES, True),
)

# One row per catalog table; (db, tbl) is the key.
INVENTORY = _schema(
    ("db", _TEXT, False),
    ("tbl", _TEXT, True),
    ("columns", _NAMES, True),
    ("part_cols", _NAMES, True),
)

# Allow rules. `udf` set: a rule on functions; else a rule on tables and columns.
GRANTS = _schema(
    ("user_name", _TEXT, True),
    ("db", _TEXT, True),
    ("tbl", _TEXT, True),
    ("col", _TEXT, True),
    ("udf", _TEXT, True),
    ("access", _TEXT, True),
)

# One JSON line of a policy snapshot: resource patterns, and who holds which accesses on them.
POLICY_SNAPSHOT = _schema(
    ("policy", _TEXT, True),
    (
        "resources",
        _schema(
            ("database", _NAMES, True), ("table", _NAMES, True), ("column", _NAMES, True), ("udf", _NAMES, True)
        ),
        True,
    ),
    ("items", T.ArrayType(_schema(("users", _NAMES, True), ("accesses", _NAMES, True))), True),
)

# Existing files. `others_action` is what everybody but the owner may do: NONE, READ or ALL.
FILE_STATUS = _schema(
    ("path", _TEXT, False),
    ("owner", _TEXT, True),
    ("others_action", _TEXT, True),
)

# A statement together with its relations, as one message of a live log.
LIVE_STATEMENTS = T.StructType(
    STATEMENTS.fields
    + [
        T.StructField(
            "relations",
            T.ArrayType(T.StructType([f for f in RELATIONS.fields if f.name != "stmt_id"])),
            True,
        )
    ]
)
