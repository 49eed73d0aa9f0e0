"""Statement and relation logs."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.schemas import RELATIONS, STATEMENTS

_STATEMENTS, _RELATIONS = "statements", "relations"


def load_log(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The two tables of a log: one row per statement, one row per relation touched."""
    return (
        spark.read.schema(STATEMENTS).parquet(f"{path}/{_STATEMENTS}"),
        spark.read.schema(RELATIONS).parquet(f"{path}/{_RELATIONS}"),
    )


def write_log(stmts: DataFrame, rels: DataFrame, path: str) -> None:
    stmts.select(STATEMENTS.fieldNames()).write.mode("overwrite").parquet(f"{path}/{_STATEMENTS}")
    rels.select(RELATIONS.fieldNames()).write.mode("overwrite").parquet(f"{path}/{_RELATIONS}")


def save_bucketed_log(stmts: DataFrame, rels: DataFrame, database: str, buckets: int) -> None:
    """Saves the log as tables bucketed by statement: later runs join and group without a shuffle."""
    for df, schema, name in ((stmts, STATEMENTS, _STATEMENTS), (rels, RELATIONS, _RELATIONS)):
        placed = df.select(schema.fieldNames()).repartition(buckets, "stmt_id")
        placed.write.mode("overwrite").bucketBy(buckets, "stmt_id").sortBy("stmt_id").saveAsTable(f"{database}.{name}")


def load_bucketed_log(spark: SparkSession, database: str) -> tuple[DataFrame, DataFrame]:
    return spark.table(f"{database}.{_STATEMENTS}"), spark.table(f"{database}.{_RELATIONS}")


def split_live(live: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Statements and relations of live messages, each of which carries its own relations."""
    stmts = live.select(STATEMENTS.fieldNames())
    return stmts, live.select("stmt_id", F.inline("relations")).select(RELATIONS.fieldNames())
