"""The audit table, as plain folders `day=/run_id=/batch_id=` or with a manifest of finished batches.

With a manifest, rows lie in a folder of their own for each attempt to write a batch, and the manifest
is a log of what has been added to and taken from the table. One file of it is one change: rows that
no file names do not exist for readers, whatever became of the job that wrote them.
"""

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

AUDIT_COLUMNS = [
    "stmt_id", "seq", "col_pos", "ts", "user_name", "client_ip", "cluster", "action", "access", "object_type",
    "database", "table", "udf", "column_name", "allowed",
]
LAYOUT = ["day", "run_id", "batch_id"]
_KINDS = {"stmt_id": T.LongType(), "seq": T.LongType(), "col_pos": T.IntegerType(), "ts": T.TimestampType(), "allowed": T.BooleanType()}
_AUDIT = T.StructType([T.StructField(c, _KINDS.get(c, T.StringType())) for c in AUDIT_COLUMNS])
_STORED = T.StructType([*_AUDIT.fields, T.StructField("day", T.DateType()), T.StructField("attempt", T.StringType())])


def audit_table(audited: DataFrame) -> DataFrame:
    kinds = {f.name: f.dataType for f in _AUDIT.fields}
    return audited.select(*[F.col(c).cast(kinds[c]) for c in AUDIT_COLUMNS], F.to_date("ts").alias("day"))


def stream_run_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream that owns a checkpoint; Spark keeps it there from the first start on."""
    lines = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").collect()
    return json.loads(lines[0][0])["id"]


def write_audit(audited: DataFrame, path: str, batch_id: int = 0, run_id: str | None = None) -> None:
    """Adds audit rows below `path`, by day.

    A batch of a run replaces itself when it is written again, and nothing else: other runs and other
    batches keep their rows. Without a run id the rows are a run of their own. Rows are gathered by
    day before the write; AQE cuts a busy day into several files.
    """
    run = run_id or uuid.uuid4().hex
    rows = audit_table(audited).hint("rebalance", "day").withColumns({"run_id": F.lit(run), "batch_id": F.lit(batch_id)})
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*LAYOUT).parquet(path)


def compact_audit(spark: SparkSession, path: str, target: str) -> None:
    """Writes the audit rows below `path` to a new table at `target` with few files a day.

    Runs and batches become plain columns there. The source stays as it is; it may go when the new
    table is in use.
    """
    rows = spark.read.parquet(path).hint("rebalance", "day")
    rows.write.mode("errorifexists").partitionBy("day").parquet(target)


_MANIFEST, _ROWS = "manifest", "rows"
_CHANGE = "attempt string, run_id string, batch_id long, added boolean"
#: The run of rows that a compaction has brought together.
COMPACTED = "compacted"


def _changes(spark: SparkSession, path: str) -> DataFrame:
    """All changes of the table so far; none where there is no manifest yet."""
    folder = f"{path.rstrip('/')}/{_MANIFEST}"
    try:
        return spark.read.schema(_CHANGE).parquet(folder)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _CHANGE)


def committed(spark: SparkSession, path: str) -> DataFrame:
    """`attempt, run_id, batch_id` of the batches that are in the table: added and not taken out again."""
    changes = _changes(spark, path)
    gone = changes.where("NOT added").select("attempt").distinct()
    return changes.where("added").drop("added").distinct().join(gone, "attempt", "left_anti")


def _change(spark: SparkSession, path: str, added: list[tuple], gone: list[tuple]) -> None:
    """Adds one file to the manifest. It appears as a whole or not at all, and with it all of its changes."""
    rows = [(*a, True) for a in added] + [(*g, False) for g in gone]
    spark.createDataFrame(rows, _CHANGE).coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/{_MANIFEST}")


def stage_audit(audited: DataFrame, path: str) -> str:
    """Writes audit rows where no reader looks yet, and gives the name of the attempt. Busy days are cut into several files."""
    attempt = uuid.uuid4().hex
    rows = audit_table(audited).hint("rebalance", "day")
    rows.write.partitionBy("day").parquet(f"{path.rstrip('/')}/{_ROWS}/attempt={attempt}")
    return attempt


def commit_audit(audited: DataFrame, path: str, batch_id: int = 0, run_id: str | None = None) -> None:
    """Adds a batch to an audit table with a manifest. Written again, a batch takes the place of what it was.

    Readers see the batch when all of it is written, and never a part: a write that is killed leaves
    files that nothing refers to. A run has one writer at a time, as a stream has.
    """
    spark, run = audited.sparkSession, run_id or uuid.uuid4().hex
    attempt = stage_audit(audited, path)
    before = committed(spark, path).where((F.col("run_id") == run) & (F.col("batch_id") == batch_id)).collect()
    _change(spark, path, [(attempt, run, batch_id)], [tuple(r) for r in before])


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all committed batches, with `day`. Only folders of the manifest are listed; filters on the day reach them."""
    base = f"{path.rstrip('/')}/{_ROWS}"
    # One short name for each batch since the last compaction; their files are listed by the driver anyway.
    live = [r["attempt"] for r in committed(spark, path).select("attempt").collect()]
    folders = [f"{base}/attempt={a}" for a in sorted(live)]
    rows = spark.read.schema(_STORED).option("basePath", base).parquet(*folders) if folders else spark.createDataFrame([], _STORED)
    return rows.drop("attempt")


def compact_committed(spark: SparkSession, path: str) -> None:
    """Brings the committed batches together in few files a day, and switches readers over by one change.

    The last batch of each run stays as it is, since its stream may write it again. The old files stay
    for readers that have already listed them; `unused_attempts` tells which may go later.
    """
    done = committed(spark, path).collect()
    last = {}
    for r in done:
        last[r["run_id"]] = max(r["batch_id"], last.get(r["run_id"], r["batch_id"]))
    old = [tuple(r) for r in done if r["run_id"] == COMPACTED or r["batch_id"] < last[r["run_id"]]]
    if len(old) < 2:
        return
    base = f"{path.rstrip('/')}/{_ROWS}"
    rows = spark.read.schema(_STORED).option("basePath", base).parquet(*[f"{base}/attempt={a}" for a, _, _ in old])
    attempt = stage_audit(rows, path)
    _change(spark, path, [(attempt, COMPACTED, 0)], old)


def unused_attempts(spark: SparkSession, path: str) -> DataFrame:
    """`attempt` of rows that were taken out of the table."""
    return _changes(spark, path).where("NOT added").select("attempt").distinct()
