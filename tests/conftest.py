import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from wardline.schemas import GRANTS, INVENTORY, RELATIONS, STATEMENTS  # noqa: E402
from wardline.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    builder = configure(SparkSession.builder.master("local[4]").appName("tests"))
    session = (
        builder.config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .config("spark.checkpoint.dir", str(base / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


class Tables:
    """Small tables from rows given as dicts; what a row leaves out is null."""

    def __init__(self, spark):
        self.spark = spark

    def _make(self, rows, schema):
        return self.spark.createDataFrame([tuple(r.get(f) for f in schema.fieldNames()) for r in rows], schema)

    def statements(self, *rows):
        base = {"user_name": "ann", "db": "d", "tbl": "t", "ts": datetime(2024, 1, 1)}
        flags = {"is_view": False, "is_temp": False, "is_local": False, "conf_has_value": False}
        return self._make([{**base, **flags, "stmt_id": i, **r} for i, r in enumerate(rows)], STATEMENTS)

    def relations(self, *rows):
        base = {"stmt_id": 0, "kind": "catalog", "db": "d", "tbl": "s", "projected": []}
        return self._make([{**base, "ord": i, **r} for i, r in enumerate(rows)], RELATIONS)

    def inventory(self, *rows):
        rows = rows or (
            {"db": "d", "tbl": "t", "columns": ["a", "b", "p"], "part_cols": ["p"]},
            {"db": "d", "tbl": "s", "columns": ["x", "y"], "part_cols": []},
        )
        return self._make(rows, INVENTORY)

    def grants(self, *rows):
        return self._make([{"user_name": "ann", **r} for r in rows], GRANTS)


@pytest.fixture(scope="session")
def tables(spark):
    return Tables(spark)
