"""Benchmark decontamination by spaced seeds.

A seed is a window of words of which a fixed mask ignores some, so a replaced word at an ignored
place does not hide a copied passage; there are masks enough that none within the rule is hidden. Seeds of the benchmark and of the documents are joined by
their hashes. Each hit says how a document and an item would lie on each other; there the words
are compared, and the document counts as contaminated if a stretch of the item agrees but for a few
words. All of it is built-in expressions.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.tasks import read, stored

#: Which words in a row a seed looks at, for stretches of each length. Wherever the words lie that AGREE
#: lets differ (two from ten words on, below that one), a mask fits between them; a test tries all.
MASKS = {
    5: ("1101", "1011"), 6: ("11101", "10111"), 7: ("111011", "101111", "111101"), 8: ("111101", "110111"), 9: ("1111101", "1101111"),
    10: ("10011101", "11010011", "11101001"), 11: ("1110011", "1101011"), 12: ("10110111", "11101011", "11100111"), 13: ("11110011", "11010111"),
}
#: A shorter item is looked for as a whole, from so many words on; still shorter ones are no passages.
LEAST_WORDS = 5
#: So many words in a row (or the whole of a shorter item) must agree to so many parts of 100.
STRETCH, AGREE = 13, 80
#: Rows up to which a side is broadcast; it holds a few numbers a row. Beyond it, joins shuffle.
BROADCAST_ROWS = 200_000

# Trimmed first, so that splitting leaves no empty words at the ends. Text without words is one empty word.
_WORDS = r"split(btrim(lower({0}), ' \u0009\u000A\u000B\u000C\u000D'), '[\\x20\\x09-\\x0D]+')"


def _small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df`, broadcast if it is counted to hold at most `rows` rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def _seeds(words: DataFrame, masks: tuple[str, ...], keep: str) -> DataFrame:
    """`words` (an array `w`) as rows `<keep>, pos, seed`: all masks of one length at all places.

    The array is laid beside itself, shifted by each place of a mask, so that what follows the
    explode is plain columns.
    """
    span = len(masks[0])
    beside = F.arrays_zip(*[F.expr(f"slice(w, {k + 1}, size(w))").alias(f"w{k}") for k in range(span)])
    # The outer form: for the other one the planner would filter on the array's size below, computing it for that alone.
    placed = words.select(keep, F.posexplode_outer(beside).alias("pos", "at"))
    seeds = [F.xxhash64(F.lit(mask), *[F.col(f"at.w{k}") for k, c in enumerate(mask) if c == "1"]) for mask in masks]
    return placed.where(F.col(f"at.w{span - 1}").isNotNull()).select(keep, "pos", F.explode(F.array(*seeds)).alias("seed"))


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """`row, <key>, <item>, n_words, n_equal, place`: which documents hold a stretch of which items.

    `row` is a hash of key and text: repeated rows give one. `n_words` and `n_equal` count the words
    of the item that lie on the document and those that agree there, where most do; `place` is the
    place in the document (in words) of the item's first word, below 0 if only a later part is there. Null and
    empty texts hold nothing, items of fewer than five words are not looked for, items with equal
    texts are found each. Words are compared in lower case.
    """
    asked = benchmark.select(F.col(item).alias("item"), F.expr(_WORDS.format(f"`{item_text}`")).alias("item_words"))
    asked = stored(asked.where(F.size("item_words") >= LEAST_WORDS), "benchmark")
    asked_stretch = F.least(F.lit(STRETCH), F.size("item_words"))
    stretches = sorted(r[0] for r in asked.select(asked_stretch).distinct().collect())

    rows = docs.select(F.xxhash64(F.col(key), F.col(text)).alias("row"), F.col(key).alias("key"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    own = rows.select("row", F.expr(_WORDS.format("text")).alias("w"))
    hits = None
    for n in stretches or [STRETCH]:
        of_items = asked.where(asked_stretch == n).select("item", F.col("item_words").alias("w"))
        known = _small(_seeds(of_items, MASKS[n], "item").withColumnRenamed("pos", "item_pos"))
        met = _seeds(own, MASKS[n], "row").join(known, "seed").select("row", "item", (F.col("pos") - F.col("item_pos")).alias("place"))
        hits = met if hits is None else hits.unionByName(met)
    hits = stored(hits.distinct(), "hits")

    # Only documents with a hit are read as texts again.
    wanted = hits.select("row").distinct()
    texts = rows.join(_small(wanted), "row", "left_semi").dropDuplicates(["row"]).select("row", "key", F.expr(_WORDS.format("text")).alias("words"))
    laid = hits.join(texts, "row").join(_small(asked), "item")
    # Words of the item from its first to its last that lies on the document, compared place by place.
    laid = laid.withColumn("low", F.greatest(-F.col("place"), F.lit(0))).withColumn("high", F.least(F.size("item_words"), F.size("words") - F.col("place")))
    laid = laid.withColumn("equal", F.expr("transform(sequence(low, high - 1), j -> IF(item_words[j] = words[j + place], 1, 0))"))
    laid = laid.withColumn("stretch", asked_stretch).where(F.size("equal") >= F.col("stretch"))
    enough = "100 * aggregate(slice(equal, j, stretch), 0, (a, e) -> a + e) >= {0} * stretch"
    laid = laid.where(F.expr(f"exists(sequence(1, size(equal) - stretch + 1), j -> {enough.format(AGREE)})"))
    counted = laid.select("row", "key", "item", F.size("equal").alias("n_words"), F.expr("aggregate(equal, 0, (a, e) -> a + e)").alias("n_equal"), "place")
    best = counted.groupBy("row", "key", "item").agg(F.max(F.struct("n_equal", F.expr("-n_words AS less"), F.expr("-place AS back"))).alias("b"))
    return best.select(
        "row", F.col("key").alias(key), F.col("item").alias(item), (-F.col("b.less")).cast("long").alias("n_words"),
        F.col("b.n_equal").cast("long").alias("n_equal"), (-F.col("b.back")).cast("long").alias("place"),
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.drop("row")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a stretch of a benchmark item."""
    found = stored(contaminated(docs, read(spark, sf_dir, "benchmark")).select("row").distinct(), "contaminated")
    return docs.withColumn("__row", F.xxhash64("doc_id", "text")).join(_small(found.withColumnRenamed("row", "__row")), "__row", "left_anti").select(*docs.columns)


def _oracle() -> str:
    # These masks find less than the operator; where results differ, the operator's are right.
    masks, span = ("1101101011", "1110010111"), 10
    words = r"list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda w: w <> '')"
    seed = lambda mask: "concat_ws(' ', '" + mask + "', " + ", ".join(f"w[i + {k + 1}]" for k, c in enumerate(mask) if c == "1") + ")"
    places = lambda table, id_, mask: f"SELECT {id_}, i AS pos, {seed(mask)} AS seed FROM (SELECT {id_}, w, unnest(range(0, len(w) - {span} + 1)) AS i FROM {table} WHERE len(w) >= {span})"
    return f"""
WITH docs AS (SELECT doc_id, {words} AS w FROM documents WHERE text IS NOT NULL),
items AS (SELECT item_id, w FROM (SELECT item_id, {words} AS w FROM benchmark) WHERE len(w) >= {LEAST_WORDS}),
item_seeds AS ({" UNION ALL ".join(places("items", "item_id", m) for m in masks)}),
doc_seeds AS ({" UNION ALL ".join(places("docs", "doc_id", m) for m in masks)}),
short AS (
  SELECT doc_id, item_id, i AS place FROM (SELECT doc_id, w AS dw, unnest(range(0, len(w))) AS i FROM docs), items
  WHERE len(items.w) < {span} AND dw[i + 1 : i + len(items.w)] = items.w),
hits AS (
  SELECT DISTINCT doc_id, item_id, d.pos - b.pos AS place FROM doc_seeds d JOIN item_seeds b USING (seed) UNION SELECT * FROM short),
laid AS (
  SELECT doc_id, item_id, place, least({STRETCH}, len(items.w)) AS stretch,
         list_transform(range(greatest(-place, 0), least(len(items.w), len(docs.w) - place)),
                        lambda j: CASE WHEN items.w[j + 1] = docs.w[j + place + 1] THEN 1 ELSE 0 END) AS equal
  FROM hits JOIN docs USING (doc_id) JOIN items USING (item_id)),
good AS (
  SELECT * FROM laid WHERE len(equal) >= stretch
  AND list_bool_or(list_transform(range(1, len(equal) - stretch + 2),
                   lambda j: 100 * list_sum(equal[j : j + stretch - 1]) >= {AGREE} * stretch)))
SELECT doc_id, item_id, n_words, n_equal, place FROM (
  SELECT doc_id, item_id, len(equal) AS n_words, list_sum(equal)::BIGINT AS n_equal, place,
         row_number() OVER (PARTITION BY doc_id, item_id ORDER BY list_sum(equal) DESC, len(equal), place) AS k
  FROM good) WHERE k = 1
"""


ORACLE_SQL = _oracle()
