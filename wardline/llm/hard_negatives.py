"""Hard-negative mining: inner products bounded by segment summaries, then computed exactly.

A vector is stored with the mean and the deviation of each of its segments. For two segments of
length l the inner product lies within `l * (mean * mean -+ deviation * deviation)`, so sums over
segments bound a score from above and below. Pairs of anchor and row that the bounds of a coarse cut
leave open are refined with finer segments; what is left is scored exactly.

Anchors are broadcast in rounds of a bounded size and held against all rows in blocks; each task
keeps the best few rows of each anchor, and the bounds sharpen with what it has found.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, StructField, StructType

from wardline.llm.tasks import read, stored

POSITIVES, NEGATIVES = 5, 5
#: A negative scores at least so many hundredths of the positive, and no more than it.
LEAST_PERCENT = 80
#: Numbers of segments of a vector, from coarse to fine.
LEVELS = (1, 4, 16)
#: Bytes of anchors that a round broadcasts, and rows and anchors that meet at a time.
ROUND_BYTES, ROWS, ANCHORS = 16 << 20, 2048, 512
#: Share of open pairs above which a level is computed for whole blocks.
DENSE = 0.2

_NONE = -np.inf


def segments(v: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, means and deviations of `n` segments (fewer for short vectors) of each row of `v`."""
    bounds = np.unique(np.linspace(0, v.shape[1], min(n, max(v.shape[1], 1)) + 1).astype(int))
    if len(bounds) < 2:
        return np.zeros(1), np.zeros((len(v), 1)), np.zeros((len(v), 1))
    size = np.diff(bounds)
    mean = np.add.reduceat(v, bounds[:-1], axis=1) / size
    rest = v - np.repeat(mean, size, axis=1)
    return size.astype(float), mean, np.sqrt(np.add.reduceat(rest * rest, bounds[:-1], axis=1) / size)


def summaries(v: np.ndarray) -> np.ndarray:
    """Means and deviations of all levels of each row, each times the root of its segment's length."""
    parts = [(np.sqrt(size) * x).astype(np.float32) for size, *both in (segments(v, n) for n in LEVELS) for x in both]
    return np.concatenate(parts, axis=1)


def level_slices(dims: int) -> list[tuple[slice, slice]]:
    """Where means and deviations of each level lie in a summary."""
    out, at = [], 0
    for n in LEVELS:
        k = len(segments(np.zeros((1, dims)), n)[0])
        out.append((slice(at, at + k), slice(at + k, at + 2 * k)))
        at += 2 * k
    return out


class Block:
    """Rows with their vectors as whole numbers, and their summaries."""

    def __init__(self, row, ids, labels, vectors: np.ndarray, summary: np.ndarray):
        self.row, self.ids, self.labels, self.vectors, self.summary = row, ids, labels, vectors, summary

    def __len__(self) -> int:
        return len(self.ids)

    def part(self, at) -> "Block":
        return Block(self.row[at], self.ids[at], self.labels[at], self.vectors[at], self.summary[at])


def scores(rows: Block, anchors: Block, least: np.ndarray, most: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`row, anchor, score` of the wanted pairs (a mask of rows by anchors) with a score within the anchor's `least` and `most`.

    Pairs that the bounds of a level rule out do not reach the next one.
    """
    norm = [np.sqrt((x.vectors * x.vectors).sum(axis=1)) for x in (rows, anchors)]
    at = None  # open pairs as two index arrays, once they are few
    for mean, deviation in level_slices(rows.vectors.shape[1]):
        m, d, am, ad = (x.summary[:, s].astype(float) for x in (rows, anchors) for s in (mean, deviation))
        if at is None:
            middle, spread = m @ am.T, d @ ad.T
            slack = 0.5 + 1e-6 * norm[0][:, None] * norm[1][None, :]  # summaries are kept in single precision
            wanted = wanted & (middle + spread + slack >= least) & (middle - spread - slack <= most)
            if wanted.mean() < DENSE:
                at = np.nonzero(wanted)
        else:
            i, j = at
            middle, spread = np.einsum("ij,ij->i", m[i], am[j]), np.einsum("ij,ij->i", d[i], ad[j])
            slack = 0.5 + 1e-6 * norm[0][i] * norm[1][j]
            keep = (middle + spread + slack >= least[j]) & (middle - spread - slack <= most[j])
            at = i[keep], j[keep]
    if at is None:
        exact = rows.vectors @ anchors.vectors.T
        i, j = np.nonzero(wanted & (exact >= least) & (exact <= most))
        return i, j, exact[i, j]
    i, j = at
    exact = np.einsum("ij,ij->i", rows.vectors[i], anchors.vectors[j])
    keep = (exact >= least[j]) & (exact <= most[j])
    return i[keep], j[keep], exact[keep]


def first_of_each(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The places of the first `k` of each group, by falling score, then by rising id."""
    order = np.lexsort((ids, -score, group))
    g = group[order]
    begins = np.flatnonzero(np.append(True, g[1:] != g[:-1])) if len(g) else np.zeros(0, np.int64)
    rank = np.arange(len(g)) - np.repeat(begins, np.diff(np.append(begins, len(g))))
    return order[rank < k]


class Best:
    """The best few rows of each group that a task has met: columns `group, score, id, row`."""

    def __init__(self, groups: int, k: int):
        self.k, self.fifth, self.fifth_id = k, np.full(groups, _NONE), np.full(groups, np.iinfo(np.int64).max)
        self.held = [np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)]

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray, row: np.ndarray) -> None:
        # Equal scores are common where vectors are: of those only smaller ids can come in.
        better = (score > self.fifth[group]) | ((score == self.fifth[group]) & (ids <= self.fifth_id[group]))
        if not better.any():
            return
        new = [x[better] for x in (group, score, ids, row)]
        touched = np.isin(self.held[0], new[0])
        all_ = [np.concatenate((h[touched], n)) for h, n in zip(self.held, new, strict=True)]
        kept = first_of_each(all_[0], all_[1], all_[2], self.k)
        all_ = [x[kept] for x in all_]
        ends = np.flatnonzero(np.append(all_[0][1:] != all_[0][:-1], True))
        full = ends[np.bincount(all_[0], minlength=len(self.fifth))[all_[0][ends]] == self.k]
        self.fifth[all_[0][full]], self.fifth_id[all_[0][full]] = all_[1][full], all_[2][full]
        self.held = [np.concatenate((h[~touched], x)) for h, x in zip(self.held, all_, strict=True)]


#: Stands for a null id, which comes last.
_ID_LAST = np.iinfo(np.int64).max


def label_codes(anchors: Block, rows: Block) -> tuple[np.ndarray, np.ndarray]:
    """The labels of anchors and rows as numbers."""
    codes: dict = {}
    return tuple(np.array([codes.setdefault(x, len(codes)) for x in b.labels], np.int64) for b in (anchors, rows))


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[Block]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            columns = {n: part.column(k) for k, n in enumerate(part.schema.names)}
            yield Block(
                columns["row"].to_numpy(zero_copy_only=False), columns["id"].fill_null(_ID_LAST).to_numpy(zero_copy_only=False),
                np.array(columns["label"].to_pylist(), object), np.floor(256 * _matrix(columns["vector"], dims)), _matrix(columns["summary"], None),
            )


def _matrix(column: pa.Array, dims: int | None) -> np.ndarray:
    """Lists as the rows of a matrix, filled up with zeros."""
    size, values = np.diff(column.offsets.to_numpy()), column.flatten().to_numpy(zero_copy_only=False).astype(float)
    dims = int(size.max(initial=0)) if dims is None else dims
    if (size == dims).all():
        return values.reshape(len(size), dims)
    out = np.zeros((len(size), dims))
    out[np.arange(dims) < size[:, None]] = values
    return out


def usable(vectors: DataFrame, vector: str, label: str) -> Column:
    """Rows that take part: a label, and a vector of finite components."""
    sound = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return F.col(label).isNotNull() & F.col(vector).isNotNull() & sound


def summarized(rows: DataFrame, dims: int) -> DataFrame:
    """`row, id, label, vector` with `summary`, the means and deviations of the segments; written and read again."""
    schema = StructType([*rows.schema.fields, StructField("summary", ArrayType(FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = summaries(np.floor(256 * _matrix(batch.column(batch.schema.get_field_index("vector")), dims)))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(s) + 1) * s.shape[1], pa.int32()), pa.array(s.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "summary"])

    return stored(rows.mapInArrow(run, schema), "summarized")


def _against(rows: DataFrame, dims: int, groups: int, k: int, schema: str, meet: Callable) -> DataFrame:
    """`group, id, row, score`: the best `k` rows of each group in each task. `meet` gives for a block the groups, scores and places of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(groups, k)
        for block in _blocks(batches, dims):
            for group, score, place in meet(block, best):
                best.add(group, score, block.ids[place], block.row[place])
        group, score, ids, row = best.held
        ids = pa.array(ids, pa.int64(), mask=ids == _ID_LAST)
        yield pa.RecordBatch.from_arrays([pa.array(group), ids, pa.array(row), pa.array(score.astype(np.int64))], names=["group", "id", "row", "score"])

    return rows.mapInArrow(run, schema)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The first `k` of each group over all tasks; a group has `k` rows for each task at most."""
    order = Window.partitionBy("group").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def _positives(rows: DataFrame, anchors: Block, dims: int) -> DataFrame:
    """The best other rows of the same label of each anchor, by its place in the round."""
    shared = rows.sparkSession.sparkContext.broadcast(anchors)

    def meet(block: Block, best: Best):
        anchors = shared.value
        labels = label_codes(anchors, block)
        for label in set(labels[0].tolist()).intersection(labels[1].tolist()):
            all_, own = (np.flatnonzero(x == label) for x in labels)
            rows_of = block.part(own)
            for at in range(0, len(all_), ANCHORS):
                some = all_[at : at + ANCHORS]
                of = anchors.part(some)
                i, j, score = scores(rows_of, of, best.fifth[some], np.full(len(some), np.inf), rows_of.row[:, None] != of.row[None, :])
                yield some[j], score, own[i]

    return _against(rows, dims, len(anchors), POSITIVES, "group long, id long, row long, score long", meet)


def _negatives(rows: DataFrame, anchors: Block, dims: int, positives: np.ndarray) -> DataFrame:
    """The best rows of other labels for each anchor and positive; `positives` has the scores by anchor, NaN where there is none."""
    shared = rows.sparkSession.sparkContext.broadcast((anchors, positives))

    def meet(block: Block, best: Best):
        anchors, positives = shared.value
        labels = label_codes(anchors, block)
        for at in range(0, len(anchors), ANCHORS):
            some = np.arange(at, min(at + ANCHORS, len(anchors)))
            of, p = anchors.part(some), positives[some]
            low = np.where(np.isnan(p), np.inf, LEAST_PERCENT * p / 100)
            # No row below both the window and what is found already can come in.
            least = np.where(np.isnan(p), np.inf, np.maximum(low, best.fifth.reshape(-1, POSITIVES)[some])).min(axis=1)
            most = np.where(np.isnan(p), -np.inf, p).max(axis=1)
            i, j, score = scores(block, of, least, most, labels[1][:, None] != labels[0][some])
            for k in range(POSITIVES):
                inside = (LEAST_PERCENT * p[j, k] <= 100 * score) & (score <= p[j, k])
                yield some[j[inside]] * POSITIVES + k, score[inside], i[inside]

    return _against(rows, dims, len(anchors) * POSITIVES, NEGATIVES, "group long, id long, row long, score long", meet)


def mine(vectors: DataFrame, is_anchor: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label", round_bytes: int = ROUND_BYTES) -> DataFrame:
    """`anchor_id, positive_id, rank, negative_id, positive_score, negative_score`.

    Vectors are compared by the inner product of their components times 256, rounded down; shorter ones
    count as filled up with zeros. Scores are exact while they stay below 2^53. Rows without a label,
    without a vector or with a null or non-finite component take no part. Higher scores come first,
    ties go by the smaller id, null ids last, then by an order of rows that a rerun may change where
    ids repeat. Rows with equal ids are rows of their own, equal vectors are partners like any others.
    A positive without negatives gives no row, so does an anchor alone with its label.
    """
    spark = vectors.sparkSession
    kept = vectors.where(usable(vectors, vector, label)).select(
        F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("id"), F.col(label).alias("label"),
        F.col(vector).alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    )
    kept = stored(kept, "vectors")
    dims = kept.select(F.max(F.size("vector"))).first()[0] or 0
    rows = summarized(kept, dims)
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    anchors = rows.where("anchor")
    total = anchors.count()
    of_round = max(1, round_bytes // (16 * max(dims, 1)))
    results = None
    for k in range(-(-total // of_round)):
        # A round holds the anchors with one remainder of a hash of their row, about as many as it may.
        of = F.pmod(F.xxhash64("row"), F.lit(-(-total // of_round))) == k
        found = stored(_round(rows, _collected(anchors.where(of), dims), dims), "mined")
        results = found if results is None else results.unionByName(found)
    return results if results is not None else spark.createDataFrame([], out)


def _collected(anchors: DataFrame, dims: int) -> Block:
    """The anchors of one round, whose size is bounded."""
    found = list(_blocks(iter(anchors.toArrow().combine_chunks().to_batches()), dims))
    if not found:
        return Block(*[np.zeros(0, np.int64)] * 2, np.zeros(0, object), np.zeros((0, dims)), np.zeros((0, 0)))
    return Block(*[np.concatenate([getattr(b, f) for b in found]) for f in ("row", "ids", "labels", "vectors", "summary")])


def _round(rows: DataFrame, anchors: Block, dims: int) -> DataFrame:
    spark = rows.sparkSession
    scored = stored(_ranked(_positives(rows, anchors, dims), POSITIVES), "positives")
    positives = np.full((len(anchors), POSITIVES), np.nan)
    of_round = scored.select("group", "place", "score").toArrow()
    positives[of_round["group"].to_numpy(), of_round["place"].to_numpy() - 1] = of_round["score"].to_numpy()
    negatives = _ranked(_negatives(rows, anchors, dims, positives), NEGATIVES)
    names = pa.table({"anchor": np.arange(len(anchors)), "anchor_id": pa.array(anchors.ids, mask=anchors.ids == _ID_LAST)})
    of_anchor = scored.select(
        (F.col("group") * POSITIVES + F.col("place") - 1).alias("group"), F.col("group").alias("anchor"),
        F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
    )
    mined = negatives.select("group", F.col("place").cast("int").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = mined.join(of_anchor, "group").join(F.broadcast(spark.createDataFrame(names)), "anchor")
    return named.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


ORACLE_SQL = """
WITH vecs AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM vecs a, vecs b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id, (row_number() OVER best)::INTEGER AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW best AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER best <= 5
"""
