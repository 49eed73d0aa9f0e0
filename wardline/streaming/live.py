"""The same checks on a live log with Structured Streaming."""

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wardline.operators.decide import RECORDED, audit_rows, decide, triable
from wardline.plans.governance import Governance
from wardline.schemas import LIVE_STATEMENTS
from wardline.sources.audit import stream_run_id, write_audit
from wardline.sources.logs import split_live

POLL_INTERVAL = "10 seconds"


def read_live(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """A live log of Parquet files, each statement with its relations."""
    reader = spark.readStream.schema(LIVE_STATEMENTS)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def authorize_stream(stream_reqs: DataFrame, grants: DataFrame, **sizes) -> DataFrame:
    """Decisions on a stream of requests with fixed grants: a stateless stream-static join.

    Grants of any number of bytes will do, as long as each user has few patterns to try; `audit_stream`
    with `load_grants` takes grants of any kind.
    """
    return decide(stream_reqs, grants, **sizes)


def _start(stream: DataFrame, handle, checkpoint: str, interval: str | None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def audit_stream(
    decisions: DataFrame, path: str, checkpoint: str, interval: str | None = POLL_INTERVAL,
    load_grants: Callable[[SparkSession], DataFrame] | None = None, write: Callable = write_audit, **settings,
) -> StreamingQuery:
    """Adds audit rows as they come. A repeated batch replaces itself; another checkpoint is another run.

    `write` is `write_audit`, or `commit_audit` for a table whose readers see whole batches only.

    With `load_grants` the stream is one of requests, decided batch by batch with freshly loaded grants
    of any size. The decisions of a statement must arrive together, as they do when its requests do.
    """

    def record(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        decided = decide(batch, load_grants(spark), **settings) if load_grants else batch
        write(audit_rows(decided), path, batch_id, stream_run_id(spark, checkpoint))

    return _start(decisions, record, checkpoint, interval)


def audit_requests(
    stream_reqs: DataFrame, grants: DataFrame, path: str, checkpoint: str, interval: str | None = POLL_INTERVAL, write: Callable = write_audit, **sizes,
) -> StreamingQuery:
    """Decides a stream of requests with fixed grants of any kind, and records the audit as they come.

    Grants that a stream can try are joined with it. With more patterns than that each batch is
    brought together and walks down the trie of the grants; both give the same decisions.
    """
    if triable(grants, **sizes):
        return audit_stream(authorize_stream(stream_reqs, grants, **sizes), path, checkpoint, interval, write=write)
    return audit_stream(stream_reqs, path, checkpoint, interval, load_grants=lambda _: grants, write=write, **sizes)


def close_statements(decisions: DataFrame, delay: str, at: str = "ts") -> DataFrame:
    """The audit rows of a stream whose statements come in parts, over several batches and in any order.

    All decisions of a statement have its time (`at`). A statement stays open until the watermark has
    reached that time, `delay` behind the latest time seen; then the audit is cut after its first
    denial, whichever batch that came in. State holds the least denied position of each open
    statement, and its decisions one by one, not as a list. Parts that come later than the delay are
    dropped, as are decisions without a time, which would never close. The last statements close when
    later ones, or a row with nothing but a later time, move the watermark.
    """
    timed = decisions.withColumn(at, F.col(at).cast("timestamp")).where(F.col(at).isNotNull()).withWatermark(at, delay)
    denied = timed.where(~F.col("allowed")).groupBy(F.col("stmt_id").alias("denied_stmt"), F.col(at).alias("denied_at")).agg(F.min("seq").alias("denied_seq"))
    same = (F.col("stmt_id") == F.col("denied_stmt")) & (F.col(at) == F.col("denied_at"))
    # Names both sides of the join, so that no row is dropped before it has moved the watermark.
    cut = timed.join(denied, same, "left_outer").where("coalesce(stmt_id, denied_seq) IS NOT NULL").where(RECORDED)
    return cut.drop("denied_stmt", "denied_at", "denied_seq")


#: Bytes that a decision of an open statement takes in a state store in memory (measured: 850), and the store beyond memory.
_OPEN_ROW = 900
_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}


def open_rows_fit(spark: SparkSession, rows: int) -> bool:
    """Whether the decisions of open statements can lie in the memory that the executors have for data."""
    memory = spark._jsc.sc().getExecutorMemoryStatus().values().iterator()
    total = 0
    while memory.hasNext():
        total += memory.next()._1()
    return rows * _OPEN_ROW <= total


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    """Settings for what is started inside; a stream keeps those it was started with."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def audit_open_statements(
    decisions: DataFrame, path: str, checkpoint: str, delay: str, interval: str | None = POLL_INTERVAL, write: Callable = write_audit, at: str = "ts",
    open_rows: int | None = None,
) -> StreamingQuery:
    """Records the audit of statements that come in parts, as they close.

    With more `open_rows` than memory holds (the most decisions that are open at a time, if that is
    known), a new stream keeps them in RocksDB: slower, but of bounded memory. A stream that is started
    again stays with the store of its checkpoint.
    """

    def record(batch: DataFrame, batch_id: int) -> None:
        write(batch, path, batch_id, stream_run_id(batch.sparkSession, checkpoint))

    spark = decisions.sparkSession
    with _settings(spark, {} if open_rows is None or open_rows_fit(spark, open_rows) else _ON_DISK):
        return _start(close_statements(decisions, delay, at), record, checkpoint, interval)


def live_verdicts(
    live: DataFrame,
    inv: DataFrame | Callable[[SparkSession], DataFrame],
    load_grants: Callable[[SparkSession], DataFrame],
    verdict_path: str,
    checkpoint: str,
    audit_path: str | None = None,
    interval: str | None = POLL_INTERVAL,
    split: Callable[[DataFrame], tuple[DataFrame, DataFrame]] = split_live,
    **settings,
) -> StreamingQuery:
    """Judges each statement of a live log once, writing verdicts and audit rows per batch.

    The grants are loaded again for every batch, so policy changes take effect within one interval
    and a missing snapshot stops the query. The inventory is too, if it is given as a loader; a
    DataFrame is taken as it is. Verdicts and audit rows lie below the id of the run, which stays
    with the checkpoint. Without an interval all available rows are judged and the query ends.
    """

    def judge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kept = [batch.persist()]
        try:
            stmts, rels = split(kept[0])
            catalog = inv(spark) if callable(inv) else inv
            governance = Governance(stmts, rels, catalog, load_grants(spark), **settings)
            run = stream_run_id(spark, checkpoint)
            # Verdicts and audit rows come from the same decisions.
            kept.append(governance.decisions.persist())
            governance.verdicts.write.mode("overwrite").parquet(f"{verdict_path}/run_id={run}/batch_id={batch_id}")
            if audit_path:
                write_audit(governance.audit, audit_path, batch_id, run)
        finally:
            for df in kept:
                df.unpersist()

    return _start(live, judge, checkpoint, interval)
