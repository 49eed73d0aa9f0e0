"""What a change of the grants can change: the statements to judge again, and no others."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.operators.decide import match_grants
from wardline.operators.requests import fan_out_columns

_GRANT = ["user_name", "db", "tbl", "col", "udf", "access"]


def changed_grants(before: DataFrame, after: DataFrame) -> DataFrame:
    """The grants that stand in one of two sets only. How often a grant stands in a set does not count."""
    a, b = (g.select(*[F.col(c) if c in g.columns else F.lit(None).cast("string").alias(c) for c in _GRANT]) for g in (before, after))
    return a.subtract(b).unionByName(b.subtract(a))


def touched_statements(reqs: DataFrame, before: DataFrame, after: DataFrame, **sizes) -> DataFrame:
    """`stmt_id` of the statements with a request that a changed grant speaks of.

    The answer to any other request rests on grants that stand in both sets. The changed grants are
    asked like any grants: measured, then broadcast or walked as a trie.
    """
    asked = match_grants(fan_out_columns(reqs.where(F.col("reason").isNull())), changed_grants(before, after), **sizes)
    return asked.where("allowed").select("stmt_id").distinct()
