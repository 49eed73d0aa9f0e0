"""Ordering and display of privilege objects."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.functions.expressions import object_keys, object_sort_keys, render_object
from wardline.operators.ranking import ranked


def order_objects(objs: DataFrame) -> DataFrame:
    """Objects in their total order, by a range-partitioned sort."""
    return objs.orderBy(*object_sort_keys())


def object_positions(objs: DataFrame) -> DataFrame:
    """Adds `position`, the place of an object among all objects; equal objects share the first of their places.

    Ranges of the order are counted apart and then numbered on, so that no task sorts more than a range.
    """
    return ranked(objs, object_keys(), position="__place", rank="position").drop("__place")


def rank_objects(objs: DataFrame, within: list[str]) -> DataFrame:
    """Adds `position`, the place of an object among those of its group; equal objects share it."""
    return objs.withColumn("position", F.rank().over(Window.partitionBy(*within).orderBy(*object_sort_keys())))


def show_objects(objs: DataFrame) -> DataFrame:
    """Adds `text`, the object as shown to people."""
    return objs.withColumn("text", render_object())
