"""Small helpers that the operators of this folder share."""

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardline.session import work_folder

#: Rows that a task holds as Python objects at a time.
ROWS_AT_ONCE = 256

_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def map_columns(df: DataFrame, schema: str, start: Callable[[], Callable], finish: bool = False) -> DataFrame:
    """`df` through Python in blocks of rows.

    `start` runs once in each task and gives a function from the columns of a block (a list of
    lists) to the columns of its result. With `finish` that function is called once more at the
    end of the task, with None, for what it has kept.
    """
    out = StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        kind, step = to_arrow_schema(out), start()

        def packed(columns: Any) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, kind.types, strict=True)], schema=kind
            )

        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                if (columns := step([c.to_pylist() for c in part.columns])) is not None:
                    yield packed(columns)
        if finish and (columns := step(None)) is not None:
            yield packed(columns)

    return df.mapInArrow(run, out)


def struct_udf(schema: str, start: Callable[[], Callable]):
    """A vectorized function of a text column; `start` gives, once in each task, a function from
    the texts of a block to the lists of the fields of `schema`.

    It counts as nondeterministic, so that the planner does not compute it once for a filter and
    again for a projection.
    """
    names = StructType.fromDDL(schema).fieldNames()

    def run(blocks: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        step = start()
        for block in blocks:
            parts = []
            for at in range(0, len(block), ROWS_AT_ONCE):
                columns = step([x if isinstance(x, str) else None for x in block.iloc[at : at + ROWS_AT_ONCE]])
                parts.append(pd.DataFrame({n: pd.Series(c, dtype=object) for n, c in zip(names, columns, strict=True)}))
            yield pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({n: pd.Series([], dtype=object) for n in names})

    return F.pandas_udf(run, StructType.fromDDL(schema)).asNondeterministic()


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written to a new folder below the shared one and read again: cuts the lineage."""
    spark, folder = df.sparkSession, work_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of unsigned 64-bit integers that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(31))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def words(text: str | None) -> list[bytes]:
    """Maximal runs without ASCII white space, with A-Z (and no other letter) in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


#: The same words in SQL.
WORDS_SQL = r"filter(split(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), w -> w <> '')"


def most_frequent(counted: DataFrame, limit: int, n: str = "n") -> DataFrame:
    """The rows of `counted` with the greatest `n`, at most `limit` of them.

    These are all rows from some count on (in steps of about 3 %), so that no order of ties matters.
    """
    step = F.floor(F.log(n) * 32).alias("step")
    steps = {r["step"]: r["count"] for r in counted.groupBy(step).count().collect()}
    total, least = 0, None
    for k in sorted(steps, reverse=True):
        total += steps[k]
        if total > limit:
            break
        least = k
    return counted.where(step >= least) if least is not None else counted.where(F.lit(False))


def residue(column: str, divisor: int):
    """crc32 of a column as text, modulo `divisor`; a null counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))), F.lit(divisor))


