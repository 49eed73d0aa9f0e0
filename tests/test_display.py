"""Order and text of objects, and masks on short values."""

import bisect
import random

import pytest
from pyspark.sql import functions as F

from wardline.functions.masking import mask_columns
from wardline.operators.display import order_objects, show_objects
from wardline.operators.ranking import ranked

SCHEMA = "obj_type string, db string, name string, part_keys array<string>, columns array<string>, action string"


def test_total_order(spark):
    wanted = [
        ("DATABASE", None, "z", [], [], "OTHER"),
        ("DATABASE", "a", None, [], [], "OTHER"),
        ("DATABASE", "a", "a", [], [], "OTHER"),
        ("TABLE_OR_VIEW", "a", "t", None, [], "OTHER"),
        ("TABLE_OR_VIEW", "a", "t", [], None, "OTHER"),
        ("TABLE_OR_VIEW", "a", "t", [], [], "OTHER"),
        ("TABLE_OR_VIEW", "a", "t", [], ["a"], "OTHER"),
        ("TABLE_OR_VIEW", "a", "t", [], ["a", "b"], "OTHER"),
        ("TABLE_OR_VIEW", "a", "t", [], ["b"], "OTHER"),
        ("TABLE_OR_VIEW", "a", "t", ["a"], [], "OTHER"),
        ("TABLE_OR_VIEW", "b", "a", [], [], "OTHER"),
        ("FUNCTION", "a", "f", [], [], "OTHER"),
        ("DFS_URI", "a", "a", [], [], "OTHER"),
    ]
    mixed = wanted[:]
    random.Random(5).shuffle(mixed)
    assert [tuple(r) for r in order_objects(spark.createDataFrame(mixed, SCHEMA).repartition(4)).collect()] == wanted


def test_text(spark):
    rows = {
        "Object [type=DATABASE, name=d]": ("DATABASE", "d", "d", [], [], "OTHER"),
        "Object [type=TABLE_OR_VIEW, name=d.t[p, q], action=INSERT]": ("TABLE_OR_VIEW", "d", "t", ["p", "q"], ["a"], "INSERT"),
        "Object [type=TABLE_OR_VIEW, name=t[], action=INSERT_OVERWRITE]": ("TABLE_OR_VIEW", None, "t", [], [], "INSERT_OVERWRITE"),
        "Object [type=TABLE_OR_VIEW, name=d.t]": ("TABLE_OR_VIEW", "d", "t", None, [], None),
        "Object [type=FUNCTION, name=d.f]": ("FUNCTION", "d", "f", ["p"], [], "OTHER"),
        "Object [type=DFS_URI, name=]": ("DFS_URI", "/x", "/x", [], [], "OTHER"),
    }
    shown = show_objects(spark.createDataFrame(list(rows.values()), SCHEMA).coalesce(1))
    assert [r.text for r in shown.collect()] == list(rows)


@pytest.mark.parametrize(
    ("kind", "long", "short"),
    [
        ("mask", "Xxx-nnnx x", "Xn"),
        ("mask_first_n", "Xxx-123z é", "Xn"),
        ("mask_last_n", "Abc-12nx x", "Xn"),
        ("mask_show_first_n", "Abc-nnnx x", "B7"),
        ("mask_show_last_n", "Xxx-nn3z é", "B7"),
    ],
)
def test_masks(spark, kind, long, short):
    df = spark.createDataFrame([("Abc-123z é", "B7", None)], "long string, short string, none string")
    row = mask_columns(df, dict.fromkeys(df.columns, kind)).first()
    assert (row.long, row.short, row.none) == (long, short, None)


def test_unknown_masks_are_refused(spark):
    with pytest.raises(ValueError, match="unknown masks"):
        mask_columns(spark.range(1).select(F.lit("a").alias("a")), {"a": "blur"})


@pytest.mark.parametrize("parts", [1, 7])
def test_positions_in_a_global_order(spark, monkeypatch, parts):
    """Half of the rows are equal: their ranges are split, their rank is one."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        r = random.Random(parts)
        rows = [(k, r.choice([None, "a", "b", "c"]) if k % 2 else "b", r.choice([None, 1, 2]) if k % 2 else 1) for k in range(2000)]
        df = spark.createDataFrame(rows, "id long, x string, y int").repartition(5)
        found = ranked(df, [F.col("x"), F.col("y")], rank="rank").collect()
        key = lambda x, y: (x is not None, x or "", y is not None, y or 0)
        order = sorted(key(x, y) for _, x, y in rows)
        assert sorted(f.position for f in found) == list(range(1, len(rows) + 1))
        assert [key(f.x, f.y) for f in sorted(found, key=lambda f: f.position)] == order
        assert all(f["rank"] == bisect.bisect_left(order, key(f.x, f.y)) + 1 for f in found)
        assert ranked(df.limit(0), [F.col("x")]).collect() == []
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
