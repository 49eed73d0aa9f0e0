"""Column expressions: what an object is, which access it needs, how results are worded.

Arguments are column names. The bodies are SQL text, which reads like the rules it states and
reaches the JVM in one call.
"""

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardline.functions import rules


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def any_of(name: str, values: Iterable[str]) -> str:
    return f"{name} IN ({', '.join(map(quoted, values))})"


def action_of(mode="save_mode") -> Column:
    """Action on the target of a write, from its save mode."""
    return F.expr(f"CASE lower({mode}) WHEN 'append' THEN 'INSERT' WHEN 'overwrite' THEN 'INSERT_OVERWRITE' ELSE 'OTHER' END")


def object_type(obj_type="obj_type", columns="columns", op="op") -> Column:
    """Resource type of a privilege object under an operation."""
    return F.expr(f"""
        CASE WHEN {obj_type} IS NULL OR {obj_type} = 'DATABASE' THEN 'DATABASE'
             WHEN {obj_type} = 'TABLE_OR_VIEW' THEN
               CASE WHEN size({columns}) > 0 THEN 'COLUMN' WHEN contains(lower({op}), 'view') THEN 'VIEW' ELSE 'TABLE' END
             WHEN {obj_type} = 'FUNCTION' THEN 'FUNCTION'
             WHEN {obj_type} = 'DFS_URI' THEN 'URI'
             ELSE 'NONE' END""")


def access_type(action="action", obj_type="obj_type", resource_type="object_type", side="side") -> Column:
    """Access an object needs, next to the access rule of its operation (`needs`, `on_input`, `on_output`)."""
    return F.expr(f"""
        CASE WHEN {resource_type} = 'URI' THEN IF({side} = 'in', 'READ', 'WRITE')
             WHEN {action} IN ('INSERT', 'INSERT_OVERWRITE') THEN 'UPDATE'
             WHEN on_input IS NULL OR needs <> {obj_type} THEN 'NONE'
             ELSE IF({side} = 'in', on_input, on_output) END""")


def show_all_columns(option: str | None) -> bool:
    """Reads the setting that says how column listings are checked."""
    return (option or "NONE").lower() == rules.SHOW_ALL


def resource_keys(object_type="object_type", db="db", name="name", columns="columns") -> dict[str, Column]:
    """The four keys a request is matched on; all null for types that make no resource."""
    on_table = f"{object_type} IN ('TABLE', 'VIEW', 'COLUMN')"
    return {
        "database": F.expr(f"""
            CASE WHEN {on_table} OR {object_type} = 'DATABASE' THEN coalesce({db}, '*')
                 WHEN {object_type} = 'FUNCTION' THEN coalesce({db}, '') END"""),
        "table": F.expr(f"CASE WHEN {on_table} THEN {name} END"),
        "udf": F.expr(f"CASE WHEN {object_type} = 'FUNCTION' THEN {name} END"),
        "column": F.expr(f"CASE WHEN {object_type} = 'COLUMN' THEN array_join({columns}, ',') END"),
    }


def access_token(access="access") -> Column:
    """The word that policies are matched on."""
    return F.expr(
        f"CASE {access} WHEN 'USE' THEN '{rules.ANY_TOKEN}' WHEN 'ADMIN' THEN '{rules.ADMIN_TOKEN}' ELSE lower({access}) END"
    )


def _denial(user: str, privilege: str, resource: str) -> Column:
    return F.expr(f"""
        concat('Permission denied: user [', coalesce({user}, 'null'), '] does not have [', {privilege},
               '] privilege on [', {resource}, ']')""")


def denial_message(user="user_name", access="access", column="column") -> Column:
    """Text of a denial; the resource is its keys, joined by slashes."""
    return _denial(user, access, f"concat_ws('/', database, table, udf, `{column}`)")


def uri_denial_message(user="user_name", action="uri_action", path="path") -> Column:
    return _denial(user, action, path)


# The texts of both messages below are fixed values.


def unsupported_message(raw_name="raw_name") -> Column:
    text = "User try access unsupport catalog, contact admin to get more info: "
    return F.expr(f"concat('{text}', coalesce({raw_name}, ''), ' !!!')")


def guard_message(conf_key="conf_key") -> Column:
    return F.expr(f"concat('All user not allow to set this property: ', {conf_key}, ' !!!')")


def in_fs_scheme(path="path", schemes=rules.FILE_SCHEMES) -> Column:
    """Whether a path lies in one of the checked file systems."""
    known = " OR ".join(f"startswith({path}, {quoted(s.strip())})" for s in schemes) or "false"
    return F.expr(f"coalesce({path} <> '' AND ({known}), false)")


def uri_action(op="op") -> Column:
    """What an operation does with a path it names."""
    return F.expr(f"""
        CASE WHEN {any_of(op, rules.READ_OPS)} THEN 'READ' WHEN {any_of(op, rules.FULL_OPS)} THEN 'ALL' ELSE 'NONE' END""")


def type_ordinal(obj_type="obj_type") -> Column:
    cases = " ".join(f"WHEN '{name}' THEN {number}" for number, name in enumerate(rules.OBJECT_TYPES))
    return F.expr(f"CASE {obj_type} {cases} END")


def object_keys() -> list[Column]:
    """What the total order of objects goes by: type, database, name, partition keys, columns; the action does not count.

    Spark compares arrays element by element and puts the shorter one first.
    """
    return [type_ordinal(), *map(F.col, ("db", "name", "part_keys", "columns"))]


def object_sort_keys() -> list[Column]:
    return [key.asc_nulls_first() for key in object_keys()]


def render_object(obj_type="obj_type", db="db", name="name", part_keys="part_keys", action="action") -> Column:
    """Text of an object, as shown to people."""
    qualified = f"concat(coalesce(concat({db}, '.'), ''), coalesce({name}, 'null'))"
    return F.expr(f"""
        concat('Object [type=', {obj_type}, ', name=',
          CASE {obj_type} WHEN 'DATABASE' THEN coalesce({db}, 'null')
            WHEN 'TABLE_OR_VIEW' THEN concat({qualified}, coalesce(concat('[', array_join({part_keys}, ', '), ']'), ''))
            WHEN 'FUNCTION' THEN {qualified} ELSE '' END,
          IF({action} IN ('INSERT', 'INSERT_OVERWRITE'), concat(', action=', {action}), ''), ']')""")
