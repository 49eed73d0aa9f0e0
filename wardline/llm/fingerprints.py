"""Document fingerprints: sketches scaled by a threshold.

A fingerprint keeps every shingle hash below a fixed fraction of the hash space, so its size follows
the document's. Fingerprints merge by union, and what two share tells containment as well as
likeness, also between very unequal documents.

Shingles are of code points, since short texts have too few of words.
"""

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.tasks import map_columns, mix, read

#: Code points in a shingle. A shorter text is one shingle as a whole.
SHINGLE = 12
#: One of so many hashes is kept.
SCALE = 16

_KEPT = np.uint64((1 << 64) // SCALE)
_ODD, _SEED = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def fingerprint(text: str) -> np.ndarray:
    """The sorted different kept hashes. Of a text all of whose hashes are above the threshold, the
    least one is kept, so that only the empty text has an empty fingerprint."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    if not len(points):
        return np.zeros(0, np.uint64)
    width = min(SHINGLE, len(points))
    # A polynomial over the window, by doubling; wraps around at 64 bits.
    value, done, power, total, shift = mix(points * _ODD + _SEED), 1, _ODD, None, 0
    with np.errstate(over="ignore"):
        while True:
            if width & done:
                part = value[shift : shift + len(points) - width + 1]
                total = part if total is None else total * power + part
                shift += done
            if done * 2 > width:
                break
            value = value[:-done] * power + value[done:]
            power, done = power * power, done * 2
        hashes = mix(total + np.uint64(width))
    kept = hashes[hashes < _KEPT]
    return np.unique(kept) if len(kept) else hashes.min(keepdims=True)


def shared_parts(a: np.ndarray, b: np.ndarray) -> tuple[float, float, float]:
    """Likeness (shared of all), and the shares of `a` in `b` and of `b` in `a`. Two empty ones are alike."""
    if not len(a) or not len(b):
        same = float(len(a) == len(b))
        return same, same, same
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both), both / len(a), both / len(b)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The fingerprint of two documents together."""
    both = np.union1d(a, b)
    return both[both < _KEPT] if (both < _KEPT).any() else both[:1]


def written(a: np.ndarray) -> str:
    return a.astype(">u8").tobytes().hex()


def parsed(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ">u8").astype(np.uint64)


def edited_text(text: str, following: str) -> str:
    """The last third replaced by as many code points of the following document (or all it has)."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def _ranges(docs: DataFrame, key: str) -> list:
    """Bounds that cut the keys in as many ranges as shuffles have partitions; a bounded number of values."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [k / parts for k in range(1, parts)]
    found = docs.select(F.percentile_approx(F.col(key), shares, 100 * parts)).first()[0] if shares else None
    return sorted(set(found or []))


def with_next(docs: DataFrame, key: str, text: str, start: Callable[[], Callable], schema: str) -> DataFrame:
    """Each document and the next by descending key (after the last, the first) through `start()`.

    Texts move once: documents are dealt to ranges of the key and sorted there, nulls last and equal
    keys by their text. To the end of each range comes a copy of the first document of the next one.
    """
    spark, bounds = docs.sparkSession, _ranges(docs, key)
    kind = docs.schema[key].dataType.simpleString()
    # The number of bounds at or below a key, counted from above; nulls come after all others.
    known = F.array(*[F.lit(b).cast(kind) for b in bounds]) if bounds else F.array().cast(f"array<{kind}>")
    above = F.size(F.filter(known, lambda b: b > F.col("k")))
    picked = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("x"))
    dealt = picked.withColumn("bucket", F.when(F.col("k").isNull(), F.lit(len(bounds) + 1)).otherwise(above))

    # The first document of each range, found by key alone, then by text among equal keys.
    firsts = dealt.groupBy("bucket").agg(F.max("k").alias("first")).collect()
    firsts.sort(key=lambda r: r["bucket"])
    if not firsts:
        return map_columns(docs.where(F.lit(False)).select(F.lit(None).cast(kind), F.lit("")), schema, start)
    goes = {r["bucket"]: firsts[k - 1]["bucket"] for k, r in enumerate(firsts)}
    ids = spark.createDataFrame([(r["bucket"], r["first"], goes[r["bucket"]]) for r in firsts], f"b int, first {kind}, goes int")
    at_edge = (F.col("bucket") == F.col("b")) & F.col("k").eqNullSafe(F.col("first"))
    guests = dealt.join(F.broadcast(ids), at_edge).groupBy("goes").agg(F.min("x").alias("x"))
    rows = dealt.select("bucket", F.lit(0).alias("guest"), "k", "x").unionByName(
        guests.select(F.col("goes").alias("bucket"), F.lit(1).alias("guest"), F.lit(None).cast(kind).alias("k"), "x")
    )
    order = ["bucket", "guest", F.col("k").desc_nulls_last(), "x"]
    placed = rows.repartition(len(bounds) + 1, "bucket").sortWithinPartitions(*order)

    def paired():
        step, waiting = start(), []

        def run(columns):
            if columns is None:
                return None
            pairs = []
            for _, guest, k, x in zip(*columns, strict=True):
                if waiting:
                    pairs.append((*waiting.pop(), x))
                if not guest:
                    waiting.append((k, x))
            return step(pairs) if pairs else None

        return run

    return map_columns(placed, schema, paired)


def fingerprint_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited form, with their likenesses.

    A null text counts as empty; of two empty texts the likeness is 1. Equal texts have equal
    fingerprints. Rows are neither dropped nor merged: equal keys are neighbours in order of text, a
    single document is its own next. `in_edited`: which share of the fingerprint the edited one holds.
    """

    def start():
        def step(pairs: Iterator[tuple]):
            out = []
            ahead = None
            for k, x, following in pairs:
                own = fingerprint(x) if ahead is None or ahead[0] is not x else ahead[1]
                after = fingerprint(following)
                ahead = following, after
                changed = edited_text(x, following)
                other = fingerprint(changed)
                near, within, _ = shared_parts(own, other)
                out.append((
                    k, len(x), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), written(own), written(other),
                    near, shared_parts(own, after)[0], within,
                ))
            return list(zip(*out, strict=True))

        return step

    kind = docs.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, in_edited double"
    return with_next(docs, key, text, start, schema)


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(read(spark, sf_dir, "documents"))
