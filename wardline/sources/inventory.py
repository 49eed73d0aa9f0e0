"""The catalog inventory: tables, their columns, their partition columns."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.schemas import INVENTORY


def load_inventory(spark: SparkSession, path: str) -> DataFrame:
    """The inventory kept as a Parquet table, one row per (db, tbl)."""
    return spark.read.schema(INVENTORY).parquet(path)


def session_inventory(spark: SparkSession, db: str) -> DataFrame:
    """The inventory of one database of the session's own catalog, by one listing. Reads metadata only."""
    listing = spark.sql(f"SHOW TABLE EXTENDED IN `{db}` LIKE '*'").where("NOT isTemporary AND namespace <> ''")
    # What a listing says of a table: its schema as a tree, a line for each column, and its partition columns in quotes.
    columns = F.regexp_extract_all("information", F.lit(r"(?m)^ \|-- (.*): [^:]+ \(nullable = (?:true|false)\)$"), F.lit(1))
    parts = F.regexp_extract("information", r"(?m)^Partition Columns: \[(.*)\]$", 1)
    names = F.transform(F.regexp_extract_all(parts, F.lit(r"`((?:[^`]|``)*)`"), F.lit(1)), lambda n: F.replace(n, F.lit("``"), F.lit("`")))
    # A view may hold text that looks like a schema; its own comes last.
    own = F.regexp_extract("information", r"(?s)(?:.*\n)?(Schema: root\n.*)\z", 1)
    listing = listing.withColumn("tree", own).withColumn("partitioned", names).withColumn("information", F.col("tree"))
    found = listing.select(F.lit(db).alias("db"), F.col("tableName").alias("tbl"), columns.alias("columns"), F.col("partitioned").alias("part_cols"))
    return spark.createDataFrame(found.collect(), INVENTORY)
