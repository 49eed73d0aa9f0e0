"""Guards on settings, table listings and single objects."""

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.functions import expressions as X
from wardline.functions.rules import ALWAYS_EXCLUDED_KEYS, ANY_TOKEN, METADATA_ACTION, UNKNOWN_CLIENT
from wardline.operators.decide import compile_grants, match_grants
from wardline.operators.ranking import ranked


def excluded_keys(configured: Iterable[str] = ()) -> list[str]:
    """The key patterns nobody may set: the configured ones and the built-in ones."""
    return sorted({key.strip() for key in configured if key.strip()} | set(ALWAYS_EXCLUDED_KEYS))


def excluded(conf_key: Column, patterns: Iterable[str]) -> Column:
    """Whether a whole key matches one of the patterns, which are regular expressions."""
    hits = [conf_key.rlike(rf"\A(?:{pattern})\z") for pattern in patterns]
    hit = reduce(lambda a, b: a | b, hits, F.lit(False))
    return F.coalesce((conf_key != "") & hit, F.lit(False))


def guard_settings(stmts: DataFrame, patterns: Iterable[str] = ()) -> DataFrame:
    """The SET statements with `allowed` and `message`. Reading an excluded key is denied as well."""
    sets = stmts.where(F.col("command") == "SetCommand")
    return sets.withColumn("allowed", ~excluded(F.col("conf_key"), excluded_keys(patterns))).withColumn(
        "message", F.when(~F.col("allowed"), X.guard_message())
    )


def _name_cuts(name: Column, prefix: str) -> Column:
    """The texts a pattern must have to match a name: the name itself, and its prefixes."""
    exact = F.struct(name.alias(f"k{prefix}"), F.lit(-1).alias(f"n{prefix}"))
    prefixes = F.transform(
        F.sequence(F.lit(0), F.length(name)),
        lambda n: F.struct(F.left(name, n).alias(f"k{prefix}"), n.alias(f"n{prefix}")),
    )
    return F.concat(F.array(exact), prefixes)


def _held_patterns(inv: DataFrame, grants: DataFrame, asked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The tables that are asked about, and `user_name, db, k2, n2`: patterns on tables that users hold in their databases."""
    facts = compile_grants(grants).where((F.col("token") == ANY_TOKEN) & (F.col("level") == "T"))
    facts = facts.join(asked.select("user_name").distinct(), "user_name", "left_semi")
    facts = facts.select("user_name", "k1", "n1", "k2", "n2").distinct()
    listed = inv.select("db", "tbl").where(F.col("tbl").isNotNull()).distinct()
    if "db" in asked.columns:
        listed = listed.join(asked.select("db").distinct(), "db", "left_semi")

    schemas = listed.select("db").distinct().select("db", F.inline(_name_cuts(F.col("db"), "1")))
    schemas = schemas.join(facts.select("k1", "n1").distinct(), ["k1", "n1"], "left_semi")
    if "db" in asked.columns:
        pairs = asked.select("user_name", "db").distinct().join(schemas, "db")
        held = pairs.join(facts, ["user_name", "k1", "n1"])
    else:
        held = schemas.join(facts, ["k1", "n1"])
    return listed, held.select("user_name", "db", "k2", "n2").distinct()


def visible_tables(inv: DataFrame, grants: DataFrame, asked: DataFrame) -> DataFrame:
    """The listing each user gets to see: `user_name, db, tbl` of tables with any grant on or in them.

    `asked` has the users and, in a column `db`, the databases they ask about; without such a column
    they ask about all. What is asked comes in first: users and databases meet the database patterns
    of the users' grants by equal keys, and only tables of databases that are left are looked at.
    Patterns for all tables of a database meet no table before the result is made.
    """
    listed, held = _held_patterns(inv, grants, asked)
    everything = held.where(F.col("n2") == 0).select("user_name", "db")
    some = held.where(F.col("n2") != 0).join(everything, ["user_name", "db"], "left_anti")
    tables = listed.select("db", "tbl", F.inline(_name_cuts(F.col("tbl"), "2")))
    tables = tables.join(some.select("db", "k2", "n2").distinct(), ["db", "k2", "n2"], "left_semi")
    by_pattern = tables.join(some, ["db", "k2", "n2"]).select("user_name", "db", "tbl").distinct()
    return listed.join(everything, "db").select("user_name", "db", "tbl").unionByName(by_pattern)


def number_tables(inv: DataFrame) -> DataFrame:
    """`db, tbl, number`: the tables in order of their names, from 1."""
    return ranked(inv.select("db", "tbl").where(F.col("tbl").isNotNull()).distinct(), [F.col("db"), F.col("tbl")], "number")


def visible_ranges(numbered: DataFrame, grants: DataFrame, asked: DataFrame) -> DataFrame:
    """What each user gets to see as ranges of numbered tables: `user_name, db, first, last`.

    All tables with a prefix stand next to each other in the order of names, so a pattern is one range,
    however many tables it covers, and a user's row count follows the grants instead of the tables.
    Ranges of a user in a database that touch or overlap are one; only patterns are brought together
    for that. `asked` is as in `visible_tables`.
    """
    listed, held = _held_patterns(numbered, grants, asked)
    patterns = held.select("db", "k2", "n2").distinct()
    placed = numbered.join(listed, ["db", "tbl"], "left_semi")
    ends = [F.min("number").alias("first"), F.max("number").alias("last")]
    whole = placed.groupBy("db").agg(*ends)
    cuts = placed.select("db", "number", F.inline(_name_cuts(F.col("tbl"), "2"))).where("n2 <> 0")
    cut = cuts.join(patterns, ["db", "k2", "n2"], "left_semi").groupBy("db", "k2", "n2").agg(*ends)
    spans = held.where("n2 = 0").join(whole, "db").select("user_name", "db", "first", "last")
    spans = spans.unionByName(held.join(cut, ["db", "k2", "n2"]).select("user_name", "db", "first", "last")).distinct()
    before = Window.partitionBy("user_name", "db").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    begins = F.coalesce(F.col("first") > F.max("last").over(before) + 1, F.lit(True)).cast("int")
    apart = spans.withColumn("begins", begins).withColumn("run", F.sum("begins").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    return apart.groupBy("user_name", "db", "run").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("run")


def unfold(ranges: DataFrame, numbered: DataFrame) -> DataFrame:
    """`user_name, db, tbl` of the tables in some ranges, such as those of one user."""
    each = ranges.select("user_name", F.explode(F.sequence("first", "last")).alias("number"))
    return each.join(numbered, "number").select("user_name", "db", "tbl")


def metadata_decisions(objs: DataFrame, grants: DataFrame, **sizes) -> DataFrame:
    """`objs` of users with `allowed`: may the user know that the object exists?

    Only databases and tables can be asked about; anything else, and any doubt, is not visible.
    """
    kind = F.col("obj_type")
    is_db, is_table = kind == "DATABASE", kind == "TABLE_OR_VIEW"
    asked = objs.withColumns(
        {
            "object_type": F.when(is_db, "DATABASE").when(is_table, "TABLE"),
            "access": F.when(is_db | is_table, "USE"),
            "action": F.lit(METADATA_ACTION),
            "client_ip": F.lit(UNKNOWN_CLIENT),
            "database": F.when(is_db | is_table, F.coalesce(F.when(is_db, F.col("name")).otherwise(F.col("db")), F.lit("*"))),
            "table": F.when(is_table, F.col("name")),
            "udf": F.lit(None).cast("string"),
            "column": F.lit(None).cast("string"),
        }
    )
    return match_grants(asked, grants, **sizes).withColumn("allowed", F.coalesce("allowed", F.lit(False)))
