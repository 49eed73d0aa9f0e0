"""Mixing sources to target weights by a splitting tree of block quotas.

Each source is a stream of words, its documents one behind the other in a hashed order, cut into
blocks. A source takes exactly its target: all blocks as often as the target holds the source, then
the first blocks of a permutation, the last of them in part. These block quotas are split among the
output shards by a tree: each node gives its left half a multivariate hypergeometric draw from its
quotas, the right half the rest, so that shards come out as if all blocks had been shuffled over
them. A block finds its shard from its place in the permuted order; a shard is shuffled within itself.

All of it are DataFrame and SQL functions. The state of a source is one row.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.llm.tasks import read, stored
from wardline.operators.ranking import ranked
from wardline.operators.sizing import fits

WEIGHTS = (5, 2, 1)
#: Percent of all words that the mix holds, and how often a word may be taken.
SHARE, MOST = 150, 2
#: Words in a block; output shards.
BLOCK, SHARDS = 1024, 64
#: Rows of a source that one task lays one behind the other.
ROWS_A_BUCKET = 4096
#: Nodes of the tree hold a quota for each of so many groups of sources, whose blocks are permuted together.
STRATA = 1024
#: Rounds of a permutation.
ROUNDS = 24
SEED = 13

#: How many words a text has, whole texts and nulls included.
SIZE_SQL = r"coalesce(size(filter(split({0}, '[\\x20\\x09-\\x0D]+'), w -> w <> '')), 0)"


def _hash(*parts: str) -> str:
    return f"xxhash64({', '.join(parts)})"


def permuted(x: str, n: str, *of: str) -> str:
    """SQL: the place of `x` in a permutation of the numbers below `n`, told apart by `of`.

    In each round a number and its mirror image around a key change places, or do not, as a hash of
    the greater of both says.
    """
    mirror = f"pmod({_hash(*of, 'turn')}, {n}) - y"
    swap = f"transform(array(pmod({mirror}, {n})), m -> IF({_hash(*of, 'turn', 'greatest(y, m)')} & 1 = 1, m, y))[0]"
    return f"aggregate(sequence(1, {ROUNDS}), CAST({x} AS BIGINT), (y, turn) -> {swap})"


def hypergeometric(total: str, marked: str, drawn: str, uniform: str) -> str:
    """SQL: how many of `drawn` out of `total` are among the `marked`, as the inverse of a number from 0 to 1.

    Weights go from the mode outwards by their ratios, so far that the rest is below any rounding.
    """
    let = f"named_struct('n', {total}, 'c', {marked}, 'a', {drawn}, 'u', {uniform})"
    # From here on `v` holds the numbers, `b` the mode and the ends of the range.
    ends = """named_struct(
      'mode', greatest(least(CAST(floor((v.a + 1.0D) * (v.c + 1.0D) / (v.n + 2.0D)) AS BIGINT), v.a, v.c), v.a + v.c - v.n, 0L),
      'wide', CAST(ceil(12 * sqrt(v.a * (v.c / CAST(v.n AS DOUBLE)) * (1 - v.c / CAST(v.n AS DOUBLE)) * (v.n - v.a) / greatest(v.n - 1, 1))) AS BIGINT) + 30)"""
    bounds = "named_struct('mode', e.mode, 'low', greatest(v.a + v.c - v.n, 0L, e.mode - e.wide), 'high', least(v.a, v.c, e.mode + e.wide))"
    down = """aggregate(IF(b.mode > b.low, sequence(b.mode, b.low + 1), CAST(array() AS array<bigint>)), 1.0D,
      (p, x) -> p * (CAST(x AS DOUBLE) * (v.n - v.c - v.a + x)) / (CAST(v.c - x + 1 AS DOUBLE) * (v.a - x + 1)))"""
    upward = "IF(b.high > b.low, sequence(b.low + 1, b.high), CAST(array() AS array<bigint>))"
    ratio = "(CAST(v.c - x + 1 AS DOUBLE) * (v.a - x + 1)) / (CAST(x AS DOUBLE) * (v.n - v.c - v.a + x))"
    whole = f"aggregate({upward}, struct(f AS p, f AS sum), (s, x) -> struct(s.p * {ratio} AS p, s.sum + s.p * {ratio} AS sum), s -> s.sum)"
    pick = (
        f"aggregate({upward}, struct(f AS p, f AS sum, b.low AS at), (s, x) -> struct(s.p * {ratio} AS p, s.sum + s.p * {ratio} AS sum, "
        "IF(s.sum < v.u * t, x, s.at) AS at), s -> s.at)"
    )
    steps = f"transform(array({down}), f -> transform(array({whole}), t -> {pick})[0])[0]"
    inner = f"transform(array({ends}), e -> transform(array({bounds}), b -> {steps})[0])[0]"
    return f"transform(array({let}), v -> IF(v.c = 0 OR v.a = 0 OR v.n = 0, 0L, {inner}))[0]"


def drawn_quotas(counts: str, left: str, *of: str) -> str:
    """SQL: a multivariate hypergeometric draw of `left` blocks from an array of quotas, group by group."""
    uniform = f"shiftrightunsigned({_hash(*of, 'k')}, 11) * {2.0**-53!r}D"
    draw = hypergeometric("s.rest", f"element_at({counts}, k)", "s.open", uniform)
    return f"""aggregate(sequence(1, size({counts})), named_struct('rest', aggregate({counts}, 0L, (t, c) -> t + c), 'open', {left}, 'out', CAST(array() AS array<bigint>)),
      (s, k) -> transform(array({draw}), d -> named_struct('rest', s.rest - element_at({counts}, k), 'open', s.open - d, 'out', concat(s.out, array(d))))[0], s -> s.out)"""


def split_quotas(quotas: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """`shard, quotas` for each of `shards` shards, from one row with an array `quotas`.

    A node holds the shards from `low` to `high`; its left half takes its share of the blocks.
    """
    middle = "CAST((node.low + node.high) div 2 AS INT)"
    left = f"aggregate(node.quotas, 0L, (t, c) -> t + c) * ({middle} - node.low) div (node.high - node.low)"
    halves = f"""transform(array({drawn_quotas("node.quotas", left, str(seed), "node.low", "node.high")}), l -> array(
      struct(node.low AS low, {middle} AS high, l AS quotas),
      struct({middle} AS low, node.high AS high, zip_with(node.quotas, l, (q, x) -> q - x) AS quotas)))[0]"""
    level = f"flatten(transform(nodes, node -> IF(node.high - node.low > 1, {halves}, array(node))))"
    tree = f"aggregate(sequence(1, {max(1, (shards - 1).bit_length())}), array(struct(0 AS low, {shards} AS high, quotas)), (nodes, depth) -> {level})"
    return quotas.selectExpr(f"inline({tree})").selectExpr("low AS shard", "quotas")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: int = SHARE, most: int = MOST) -> DataFrame:
    """`sizes` (columns `source, source_size`) with `place`, `weight` and `target`.

    Sources get weights in turn by their code points, null last, and share a percentage of all words by
    weight; none gets more than `most` times what it has, and what it leaves is shared again.
    """
    turns = F.array(*[F.lit(w) for w in weights])
    placed = ranked(sizes, [F.col("source").isNull(), F.col("source")], "place")
    placed = stored(placed.withColumn("weight", F.element_at(turns, (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))), "sources")
    limit = F.col("source_size") * most
    rate = None
    while True:  # each turn stops more sources at their limit, or ends
        full = F.lit(False) if rate is None else limit <= F.col("weight") * rate
        sums = placed.agg(
            F.sum("source_size").alias("all"), F.sum(F.when(full, limit).otherwise(0)).alias("taken"),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("open"), F.count(F.when(full, 1)).alias("full"),
        ).first()
        if not sums["open"]:
            break
        new = (share * (sums["all"] or 0) / 100 - sums["taken"]) / sums["open"]
        if rate is not None and new <= rate:
            break
        rate = new
    target = F.least(limit.cast("double"), F.col("weight") * rate) if rate is not None else limit.cast("double")
    return placed.withColumn("target", target)


def plan_sources(sources: DataFrame, block: int, seed: int) -> DataFrame:
    """Sources with what their blocks need: how many there are, the full passes, and the part of the last pass."""
    id_ = f"{seed}, place"
    planned = sources.selectExpr(
        "*", f"greatest(CAST(ceil(source_size / {block}) AS BIGINT), 1L) AS blocks", "CAST(round(target) AS BIGINT) AS wanted"
    ).selectExpr(
        "*", f"source_size - (blocks - 1) * {block} AS short", "IF(source_size = 0, 0L, wanted div source_size) AS passes",
        "IF(source_size = 0, 0L, wanted % source_size) AS part",
    )
    planned = planned.withColumn("short_at", F.expr(permuted("blocks - 1", "blocks", id_, "passes")))
    first = f"CAST(ceil(part / {block}) AS BIGINT)"
    behind = f"CAST(ceil((part + {block} - short) / {block}) AS BIGINT)"
    drawn = f"IF(part = 0, 0L, least({first}, short_at + 1) + greatest({behind} - short_at - 1, 0L))"
    return planned.withColumn("quota", F.expr(f"passes * blocks + {drawn}"))


def deal(sources: DataFrame, shards: int, seed: int) -> DataFrame:
    """Sources with `stratum`, their `offset` in it, its size, and `ends`: the last place of each shard in the stratum, plus one.

    Blocks of a stratum are permuted together, which is the same as drawing each source apart.
    """
    placed = sources.withColumn("stratum", F.pmod(F.col("place") - 1, F.lit(STRATA)).cast("int"))
    window = Window.partitionBy("stratum").orderBy("place")
    placed = stored(placed.withColumn("offset", F.sum("quota").over(window) - F.col("quota")), "dealt")
    strata = placed.groupBy("stratum").agg(F.sum("quota").alias("n"))
    # At most STRATA numbers in one row.
    root = strata.agg(F.sort_array(F.collect_list(F.struct("stratum", "n"))).alias("all")).selectExpr("transform(all, x -> x.n) AS quotas")
    parts = split_quotas(root.where("size(quotas) > 0"), shards, seed).select("shard", F.posexplode("quotas").alias("stratum", "n"))
    # At most one number for each shard in a row.
    by_stratum = parts.groupBy("stratum").agg(F.sort_array(F.collect_list(F.struct("shard", "n"))).alias("all"))
    ends = by_stratum.selectExpr("stratum", "transform(sequence(1, size(all)), k -> aggregate(slice(all, 1, k), 0L, (t, x) -> t + x.n)) AS ends")
    return placed.join(strata.withColumnRenamed("n", "stratum_size"), "stratum").join(ends, "stratum")


def laid_out(docs: DataFrame, seed: int) -> DataFrame:
    """`docs` (columns `key, source, size`) with `begin`, the words before each document in the stream of its source.

    Documents are dealt to buckets by a hash of their key, so that a source of any size is laid out by
    many tasks; what comes before a bucket is a sum over buckets.
    """
    buckets = max(1, -(-docs.count() // ROWS_A_BUCKET))
    hashed = docs.withColumn("hash", F.expr(_hash(str(seed), "coalesce(CAST(key AS STRING), '')")))
    hashed = hashed.withColumn("bucket", F.pmod("hash", F.lit(buckets)))
    sums = hashed.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    before = sums.withColumn("before", F.sum("words").over(Window.partitionBy("source").orderBy("bucket")) - F.col("words")).drop("words")
    within = Window.partitionBy("source", "bucket").orderBy("hash", "key", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = hashed.withColumn("within", F.coalesce(F.sum("size").over(within), F.lit(0)))
    small = before.withColumnRenamed("source", "__source").withColumnRenamed("bucket", "__bucket")
    same = placed["source"].eqNullSafe(small["__source"]) & (placed["bucket"] == small["__bucket"])
    joined = placed.join(F.broadcast(small) if fits(small) else small, same)
    return joined.withColumn("begin", F.col("before") + F.col("within")).drop("__source", "__bucket", "before", "within", "bucket", "hash")


def _draws(block: int, seed: int) -> Column:
    """The spans of a document that the mix takes: `shard, at` (its order there), `begin, words` (counted in the document), `pass`."""
    id_ = f"{seed}, place"
    spot = permuted("b", "blocks", id_, "pass")
    size = f"IF(b = blocks - 1, short, {block}L)"
    before = f"x.spot * {block} - IF(x.spot > short_at, {block} - short, 0L)"
    taken = f"IF(pass < passes, {size}, least({size}, greatest(part - ({before}), 0L)))"
    # y: the block's place among all blocks of its stratum, whose shard is the first that ends behind it.
    of_stratum = permuted("offset + pass * blocks + x.spot", "stratum_size", str(seed), "-1 - stratum")
    span = f"""struct(size(filter(ends, e -> e <= y.at)) AS shard, {_hash(str(seed), "y.at", "stratum")} AS at,
      greatest(b * {block} - begin, 0L) AS begin, greatest(least(begin + size, b * {block} + y.taken) - greatest(begin, b * {block}), 0L) AS words, pass)"""
    one = f"transform(array(struct({spot} AS spot)), x -> transform(array(struct({taken} AS taken, IF({taken} > 0, {of_stratum}, 0L) AS at)), y -> {span})[0])[0]"
    passes = f"transform(IF(part > 0, sequence(0L, passes), IF(passes > 0, sequence(0L, passes - 1), CAST(array() AS array<bigint>))), pass -> {one})"
    met = f"IF(size = 0, CAST(array() AS array<bigint>), sequence(begin div {block}, (begin + size - 1) div {block}))"
    return F.expr(f"filter(flatten(transform({met}, b -> {passes})), d -> d.words > 0)")


def mix(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[int] = WEIGHTS, share: int = SHARE,
    most: int = MOST, block: int = BLOCK, shards: int = SHARDS, seed: int = SEED,
) -> DataFrame:
    """`<key>, size, source, source_size, target, draws` of each document.

    `draws` are the spans of words that the mix takes: `shard`, `at` (the order within the shard),
    `begin` and `words` (in words of the document), `pass`. A source's spans add up to its target,
    rounded to whole words; no word is taken more than `most` times. Null and wordless texts have size
    0 and no draws. A null source is a source of its own, the last. Rows that repeat are documents of
    their own, one behind the other; they lie in one bucket. Texts of any length are counted whole, a
    long one spans many blocks. The result depends on keys, sources, sizes and `seed` only.
    """
    sized = docs.select(F.col(key).alias("key"), F.col(source).alias("source"), F.expr(SIZE_SQL.format(f"`{text}`")).cast("long").alias("size"))
    sized = stored(sized, "sizes")
    sources = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    dealt = stored(deal(plan_sources(sources, block, seed), shards, seed), "quotas").withColumnRenamed("source", "__source").drop("weight", "wanted")
    placed = laid_out(sized, seed)
    joined = placed.join(F.broadcast(dealt) if fits(dealt) else dealt, placed["source"].eqNullSafe(dealt["__source"]))
    return joined.select(F.col("key").alias(key), "size", "source", "source_size", "target", _draws(block, seed).alias("draws"))


def write_mix(docs: DataFrame, path: str, files: int = 4, key: str = "doc_id", text: str = "text", **settings) -> None:
    """Writes the words of the mix below `path`, a folder `shard=` for each shard, spans in the shard's own shuffled order.

    Texts are cut where they lie, then moved once. Keys must be unique, as a text is found by its key.
    """
    mixed = mix(docs, key, text, **settings).select(key, "draws").where("size(draws) > 0")
    words = F.expr(f"filter(split(`{text}`, '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w <> '')")
    spans = docs.select(key, words.alias("__words")).join(mixed, key).select(key, "__words", F.inline("draws"))
    cut = spans.select(key, "shard", "at", "begin", "words", "pass", F.expr("array_join(slice(__words, CAST(begin + 1 AS INT), CAST(words AS INT)), ' ')").alias(text))
    dealt = cut.withColumn("__file", F.pmod("at", F.lit(files))).repartition("shard", "__file").sortWithinPartitions("shard", "__file", "at", "begin", key)
    dealt.drop("__file").write.partitionBy("shard").parquet(path)


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(read(spark, sf_dir, "documents"))
    taken = F.expr("aggregate(draws, 0L, (t, d) -> t + d.words)").alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken, F.expr("size(draws)").alias("n_draws"))
