"""Positions in a global order, without a window over all rows."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.operators.sizing import lookup
from wardline.session import written


def ranked(df: DataFrame, order: Sequence[Column], position: str = "position", rank: str | None = None) -> DataFrame:
    """`df` with the `position` of each row in the order (from 1; ascending, nulls first), and its `rank`, which equal rows share, if asked for.

    Rows are dealt to ranges of the order and written; the rows of each range are counted, and what
    comes before a range is added to the positions within it. Equal rows may be many: a number of the
    row is the last part of the order, so that ranges can split them. Their positions are then in no
    defined order. A rank is the least position of a row's equals, taken from ranges by a join on the
    key they share.
    """
    keys = {f"__key{k}": c for k, c in enumerate(order)}
    names = [*keys, "__row"]
    numbered = df.withColumns({**keys, "__row": F.monotonically_increasing_id()})
    dealt = written(numbered.repartitionByRange(*names).withColumn("__part", F.spark_partition_id()), "ranked")
    # One row for each range.
    sizes = dealt.groupBy("__part").agg(F.count("*").alias("__size"))
    before = sizes.select("__part", (F.sum("__size").over(Window.orderBy("__part")) - F.col("__size")).alias("__before"))
    within = dealt.withColumn("__within", F.row_number().over(Window.partitionBy("__part").orderBy(*names)))
    out = lookup(within, before, ["__part"], "inner").withColumn(position, F.col("__before") + F.col("__within")).drop("__part", "__before", "__within")
    if rank is None:
        return out.drop(*names)
    # Few groups: only keys that occur more than once need a common rank.
    shared = out.groupBy(*keys).agg(F.min(position).alias("__first"), F.count("*").alias("__n")).where("__n > 1").drop("__n")
    same = [F.col(f"a.{n}").eqNullSafe(F.col(f"b.{n}")) for n in keys]
    joined = out.alias("a").join(shared.alias("b"), same, "left").select("a.*", F.col("b.__first"))
    return joined.withColumn(rank, F.coalesce("__first", position)).drop(*names, "__first")

