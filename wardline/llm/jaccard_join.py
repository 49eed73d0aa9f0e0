"""N-gram Jaccard join: light sets by their subsets, heavy sets by inverted lists.

A document is the set of its five-word shingles; equal sets are one class. All pairs of classes of
a similarity of 0.8 or more are found, by keys that such pairs must share:

- light sets: all pairs out of the first few shingles in hash order (as many as a similar set can
  miss, and two more);
- heavy sets: shingles are dealt to blocks by hash. A similar set differs in so few shingles that
  some blocks are equal; the fullest blocks, one more than may differ, become keys of inverted lists.
  A block holds several shingles, so a passage that many documents share does not fill a list.

Where light ends is chosen by cost. Keys only propose; every link is proven on the sets. Within a
list, all are first held against one; only classes that are then in different components meet again,
by small parities in blocks, and long lists are cut into tiles before. So copies never meet all copies.
"""

from collections.abc import Callable

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.tasks import map_columns, mix, read, stored, words

SHINGLE = 5
#: A set may be light up to this size, and is always light up to TINY: smaller sets have too few
#: blocks for 1 + SPLITS common ones, but four common shingles.
LIGHT, TINY = 64, 7
#: Shingles of all sets of a list, in units of TILE, from which on it is cut into tiles.
LONG, TILE = 1.0, 1 << 22
#: Common keys that sets have to spare.
SPLITS = 0
#: Words of parities that are compared at a time.
_AT_A_TIME = 1 << 18
#: Rows of a few numbers up to which a side is broadcast, by count: for pairs and sets, and for keys
#: (two numbers, some 64 MB). Beyond it, joins shuffle.
BROADCAST_ROWS, BROADCAST_KEYS = 200_000, 1_500_000

_KNOWN_WORDS = 300_000
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > _KNOWN_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def shingle_set(text: str | None, hashes: _Hashes) -> np.ndarray:
    """The sorted different hashes of a text's shingles."""
    w = words(text)
    h = np.fromiter(map(hashes.__getitem__, w), np.uint64, len(w))
    if len(w) < SHINGLE:
        return mix(np.array([xxhash.xxh64_intdigest(h.tobytes(), len(w) + 1)], np.uint64)) if len(w) else h
    n = len(w) - SHINGLE + 1
    total = h[:n]
    for k in range(1, SHINGLE):
        total = mix(total * _A + h[k : k + n])
    return np.unique(total)


def least_overlap(n: int) -> int:
    """What a set of n must share with a similar one at least."""
    return -(-4 * n // 5)


def light_items(s: np.ndarray) -> list[int]:
    """The first shingles in hash order, enough for subsets of 2 + SPLITS."""
    return s[: len(s) - least_overlap(len(s)) + 2 + SPLITS].view(np.int64).tolist()


def block_lists(s: np.ndarray) -> list[list[int]]:
    """Keys of the fullest blocks, for each range of sizes that a similar set may be in.

    Two similar sets of the sizes a and b differ in at most (a + b) / 9 shingles, hence in n / 4 at
    most for a set of n, and in no more blocks. Both rank their blocks by fullness, then by hash, so
    the first n / 4 + 1 have one in common, and the first n / 4 + k have k, as long as so many are
    equal at all: above TINY that is 1 + SPLITS at least.
    """
    n, out = len(s), []
    for level in sorted({n.bit_length() - 1, (5 * n // 4).bit_length() - 1}):
        blocks, tag = max(1, 3 * (1 << level) // 4), np.array([level], np.uint64) * _B
        block = (s >> np.uint64(17)) % np.uint64(blocks)
        order = np.argsort(block, kind="stable")
        first = np.flatnonzero(np.diff(block[order], prepend=np.uint64(blocks)))
        count = np.diff(first, append=n)
        key = mix(np.add.reduceat(mix(s[order]), first) + block[order][first] * _A + tag)
        want = n // 4 + 1 + SPLITS
        chosen = key[np.lexsort((key, -count))[:want]]
        if len(chosen) < want:  # equal blocks may then be empty ones
            empty = mix(np.setdiff1d(np.arange(blocks, dtype=np.uint64), block) * _A + tag)
            chosen = np.concatenate((chosen, np.sort(empty)[: want - len(chosen)]))
        out.append(chosen.view(np.int64).tolist())
    return out


def class_rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """`row, id, n, cls, light, blocks` of each document. `row` hashes id and text, `cls` (null without words) hashes the set."""

    def start():
        hashes = _Hashes()

        def step(columns):
            out = []
            for row, id_, x in zip(*columns, strict=True):
                s = shingle_set(x, hashes)
                if not len(s):
                    out.append((row, id_, 0, None, [], []))
                    continue
                cls = np.array([xxhash.xxh64_intdigest(s.tobytes())], np.uint64).view(np.int64)[0]
                # A set of one shingle is similar to equal sets only.
                light = light_items(s) if 1 < len(s) <= LIGHT else []
                out.append((row, id_, len(s), int(cls), light, block_lists(s) if len(s) > 1 else []))
            return list(zip(*out, strict=True))

        return step

    kind = docs.schema[key].dataType.simpleString()
    picked = docs.select(F.xxhash64(F.col(key), F.col(text)).alias("row"), F.col(key).alias("id"), F.col(text).alias("text"))
    return map_columns(picked, f"row long, id {kind}, n int, cls long, light array<long>, blocks array<array<long>>", start)


def choose_boundary(classes: DataFrame) -> int:
    """The largest light size, by the cost of all keys of the sets up to LIGHT.

    A light set costs a row for each pair of its first shingles; a heavy one a scan of a list for
    each key. How long lists are is measured. The choice changes cost only, never a link.
    """
    small = classes.where((F.col("n") > 1) & (F.col("n") <= LIGHT))
    lists = small.select(F.explode(F.flatten("blocks")).alias("key")).groupBy("key").count()
    length = lists.select(F.sum(F.col("count") * F.col("count")) / F.sum("count")).first()[0] or 1.0
    sizes = {r["n"]: (r["rows"], r["keys"]) for r in small.groupBy("n").agg(F.count("*").alias("rows"), F.sum(F.size(F.flatten("blocks"))).alias("keys")).collect()}

    def cost(limit: int) -> float:
        pairs = sum(rows * (p := n - least_overlap(n) + 2) * (p - 1) / 2 for n, (rows, _) in sizes.items() if n <= limit)
        return pairs + sum(keys * length for n, (_, keys) in sizes.items() if n > 0.8 * limit)

    return min(range(TINY, LIGHT + 1), key=cost)


def _first_keys(classes: DataFrame, boundary: int) -> DataFrame:
    """`key, cls` of all classes: pairs of light sets, blocks of heavy ones and of those that may be similar to one."""
    boundary = max(boundary, TINY)
    light = F.expr(
        "flatten(transform(slice(light, 1, n - CAST(ceil(0.8 * n) AS INT) + 2), (x, i) -> "
        "transform(slice(light, i + 2, greatest(n - CAST(ceil(0.8 * n) AS INT) + 1 - i, 0)), y -> x ^ y)))"
    )
    of_light = classes.where((F.col("n") > 1) & (F.col("n") <= boundary)).select(F.explode(light).alias("key"), "cls")
    of_heavy = classes.where((F.col("n") > 1) & (F.col("n") > 0.8 * boundary)).select(
        F.explode(F.expr("flatten(transform(blocks, b -> slice(b, 1, CAST(floor(n / 4) AS INT) + 1)))")).alias("key"), "cls"
    )
    return of_light.unionByName(of_heavy)


def _small(df: DataFrame, rows: int | None = None) -> DataFrame:
    most = BROADCAST_ROWS if rows is None else rows
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def _members(keys: DataFrame) -> DataFrame:
    """`key, cls, center` of the keys that several classes have; the center is the least of them."""
    ends = keys.groupBy("key").agg(F.min("cls").alias("center"), F.max("cls").alias("last")).where("center < last").select("key", "center")
    return keys.join(_small(stored(ends, "keys"), BROADCAST_KEYS), "key").distinct()


def _sets(classes: DataFrame, docs: DataFrame, key: str, text: str, wanted: DataFrame) -> DataFrame:
    """`cls, n, parity, items`: the sets of the wanted classes, and the parities of how many shingles fall to each of some 3n places."""

    def start():
        hashes = _Hashes()

        def step(columns):
            out = []
            for cls, x in zip(*columns, strict=True):
                s = shingle_set(x, hashes)
                places = 1 << max(6, (2 * len(s)).bit_length())
                odd = np.bincount((s >> np.uint64(9)).astype(np.int64) & (places - 1), minlength=places).astype(np.uint8) & 1
                out.append((cls, len(s), np.packbits(odd).tobytes(), s.tobytes()))
            return list(zip(*out, strict=True))

        return step

    of = classes.join(_small(wanted), "cls").groupBy("cls").agg(F.min("row").alias("row"))
    rows = docs.select(F.xxhash64(F.col(key), F.col(text)).alias("row"), F.col(text).alias("text"))
    texts = rows.join(_small(of), "row").dropDuplicates(["cls"]).select("cls", "text")
    return map_columns(texts, "cls long, n long, parity binary, items binary", start)


def may_link(n: int, p: bytes, m: int, q: bytes) -> bool:
    """Whether sizes and parities allow a similarity of 0.8. Each shingle that differs changes one place at most."""
    if 5 * min(n, m) < 4 * max(n, m):
        return False
    a, b = (np.frombuffer(x, np.uint8) for x in sorted((p, q), key=len))
    while len(b) > len(a):
        half = len(b) // 2
        b = b[:half] ^ b[half:]
    return 9 * int(np.bitwise_count(a ^ b).sum()) <= n + m


def links_of(a: bytes, b: bytes) -> bool:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= 80 * (len(x) + len(y) - both)


def near_pairs(tile: list[tuple[bool, int, int, int, bytes]], forest: bool = False) -> list[tuple[int, int]]:
    """The pairs `a < b` of a tile that sizes and parities allow, as `may_link` does, of different components.

    The rows are `side, cls, n, comp, parity`. Rows of either side meet those of the other; if all are of one side, all meet.
    With `forest` only as many pairs as bring together all components that any pairs bring together, so fewer than rows.
    """
    out, one = [], len({r[0] for r in tile}) == 1
    side, cls, n, comp = (np.array(c) for c in list(zip(*tile, strict=True))[:4])
    length = np.array([len(r[4]) for r in tile])
    # Sizes that may link are so near that lengths are equal or one is half the other.
    for size in np.unique(length).tolist():
        own, longer = np.flatnonzero(length == size), np.flatnonzero(length == 2 * size)
        words_ = np.frombuffer(b"".join([tile[k][4] for k in own]), np.uint64).reshape(-1, size // 8)
        halves = np.frombuffer(b"".join([tile[k][4] for k in longer]), np.uint64).reshape(-1, size // 4)
        half = size // 8
        for others, parity in ((own, words_), (longer, halves[:, :half] ^ halves[:, half:])):
            step = max(1, _AT_A_TIME // max(1, parity.size))
            for at in range(0, len(own) if len(others) else 0, step):
                some = own[at : at + step]
                differ = np.bitwise_count(words_[at : at + step, None] ^ parity).sum(axis=2, dtype=np.int64)
                low, high = np.minimum(n[some, None], n[others]), np.maximum(n[some, None], n[others])
                fits = (9 * differ <= low + high) & (5 * low >= 4 * high) & (comp[some, None] != comp[others])
                if not one:
                    fits &= side[some, None] != side[others]
                i, j = np.nonzero(fits)
                i, j = some[i], others[j]
                while forest and len(i):
                    out.append((int(cls[i[0]]), int(cls[j[0]])))
                    comp[comp == comp[i[0]]] = comp[j[0]]
                    apart = comp[i] != comp[j]
                    i, j = i[apart], j[apart]
                out += zip(cls[i].tolist(), cls[j].tolist(), strict=True)
    return list({(min(p), max(p)) for p in out})


def _sieved(pairs: DataFrame, test: Callable) -> DataFrame:
    """The pairs `a, b` whose fields pass."""

    def start():
        def step(columns):
            kept = [r[:2] for r in zip(*columns, strict=True) if test(*r[2:])]
            return list(zip(*kept, strict=True)) if kept else None

        return step

    return map_columns(pairs, "a long, b long", start)


def _laid(pairs: DataFrame, sets: DataFrame, fields: list[str]) -> DataFrame:
    """The pairs with the fields of both ends; pairs are few numbers, so they move to the sets where they can."""
    pairs = stored(pairs, "pairs")
    ends = pairs.select(F.col("b").alias("cls")).distinct()
    of_a = sets.join(_small(pairs), sets["cls"] == pairs["a"]).select("a", "b", *[F.col(f).alias(f"a_{f}") for f in fields])
    of_b = sets.join(_small(ends), "cls", "left_semi").select(F.col("cls").alias("b"), *[F.col(f).alias(f"b_{f}") for f in fields])
    return of_a.join(of_b, "b").select("a", "b", *[f"a_{f}" for f in fields], *[f"b_{f}" for f in fields])


def _possible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that sizes and parities allow to be similar."""
    return _sieved(_laid(pairs, sets, ["n", "parity"]), may_link)


def _proven(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs `a, b` of classes that are similar, by the sets."""
    return _sieved(_laid(pairs, sets, ["items"]), links_of)


def components(edges: DataFrame) -> DataFrame:
    """`cls, comp`: for each end of an edge `a, b` the least class it reaches. Labels spread and jump until none changes."""
    both = stored(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("cls")).agg(F.least(F.min("b"), F.col("cls")).alias("comp")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("cls")).groupBy("a").agg(F.min("comp").alias("near"))
        spread = labels.join(near, F.col("cls") == F.col("a")).select("cls", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        onward = labels.select(F.col("cls").alias("at"), F.col("comp").alias("onward"))
        jumped = spread.join(onward, F.col("comp") == F.col("at")).select("cls", "old", F.least("comp", "onward").alias("comp"))
        new = stored(jumped, "labels")
        if new.where("old <> comp").isEmpty():
            return new.select("cls", "comp")
        labels = new.select("cls", "comp")


def _mixed(members: DataFrame, labelled: DataFrame) -> DataFrame:
    """`key, cls, n, comp, tiles` of the lists whose classes are in several components, with the number of parts a list is cut to.

    Lists of two are left out, as their one pair has been held against its center.
    """
    named = members.select("key", "cls").join(labelled, "cls")
    ends = named.groupBy("key").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("members"),
        F.least(F.count("*"), F.ceil(F.sum("n") / max(1.0, LONG * TILE))).alias("tiles"),
    )
    return named.join(ends.where("low < high AND members > 2").select("key", "tiles"), "key")


#: Sizes of sets with a similarity of 0.8 or more.
_SIZES = "5 * least(a_n, b_n) >= 4 * greatest(a_n, b_n)"


def _across(mixed: DataFrame, sets: DataFrame, forest: bool) -> DataFrame:
    """The pairs of classes of a list that are in different components and that sizes and parities allow; with `forest` few of them.

    A tile is a pair of parts of a list; each part meets each part, itself included, in one of them. A task holds one tile.
    """

    def start():
        held, now = [], [None]

        def met():
            pairs = near_pairs(held, forest) if len(held) > 1 else []
            held.clear()
            return pairs

        def step(columns):
            if columns is None:
                out = met()
            else:
                out = []
                for row in zip(*columns, strict=True):
                    if row[:3] != now[0]:
                        out += met()
                        now[0] = row[:3]
                    held.append(row[3:])
            return list(zip(*out, strict=True)) if out else None

        return step

    parts = mixed.withColumn("part", F.pmod(F.xxhash64("cls"), F.col("tiles"))).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    placed = parts.select("key", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "cls", "n", "comp")
    rows = placed.join(sets.select("cls", "parity"), "cls").select("key", "low", "high", (F.col("part") == F.col("low")).alias("side"), "cls", "n", "comp", "parity")
    tiles = rows.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    return map_columns(tiles, "a long, b long", start, finish=True).distinct()


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`row, <key>, n_shingles, component, component_id` of each document.

    Documents link when 100 times what they share is at least 80 times what they have together; the
    component is named by the least id in it (and by a hash in `component`). Null, empty and wordless texts have no shingles and
    are linked with nothing. Fewer than five words are one shingle. Equal ids with different texts
    are different documents, rows that repeat are linked. A null id names a component only if there is
    no other. Shingles and sets are told apart by 64-bit hashes. No table, group or list is cut.
    """
    classes = stored(class_rows(docs, key, text), "classes")
    boundary = choose_boundary(classes)
    first = stored(_members(_first_keys(classes, boundary)), "members")
    wanted = first.select("cls").distinct()
    sizes = stored(classes.join(_small(wanted), "cls", "left_semi").select("cls", "n").distinct(), "sizes")
    star = first.where("cls <> center").select(F.col("center").alias("a"), F.col("cls").alias("b")).distinct()
    for end in ("a", "b"):
        star = star.join(_small(sizes.select(F.col("cls").alias(end), F.col("n").alias(f"{end}_n"))), end)
    star = stored(star.where(_SIZES).select("a", "b"), "star")
    sets = stored(_sets(classes, docs, key, text, wanted), "sets")
    # Each class is held against one center first. What that brings together need not meet again.
    nearest = stored(star.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "star")
    edges = stored(_proven(_possible(nearest, sets), sets), "links")
    labels = components(edges)
    apart = star.join(nearest, ["a", "b"], "left_anti")
    for end in ("a", "b"):
        apart = apart.join(_small(labels.select(F.col("cls").alias(end), F.col("comp").alias(f"{end}_comp"))), end, "left")
    apart = apart.where("coalesce(a_comp, a) <> coalesce(b_comp, b)").select("a", "b")
    further = stored(_proven(_possible(apart, sets), sets), "links")
    if not further.isEmpty():
        edges = edges.unionByName(further)
        labels = components(edges)

    # Of the pairs across components first few in each list, so that groups with many links come together; then all that are left.
    for forest in (True, False):
        labelled = stored(sizes.join(labels, "cls", "left").select("cls", "n", F.coalesce("comp", "cls").alias("comp")), "labelled")
        later = _across(stored(_mixed(first, labelled), "mixed"), sets, forest).join(star, ["a", "b"], "left_anti")
        later = stored(later, "later")
        more = stored(_proven(later, sets), "links")
        star = star.unionByName(later)
        if not more.isEmpty():
            edges = edges.unionByName(more)
            labels = components(edges)

    least = classes.where(F.col("cls").isNotNull()).groupBy("cls").agg(F.min("id").alias("least"))
    named = least.join(labels, "cls", "left").select("cls", F.coalesce("comp", "cls").alias("comp"), "least")
    of_comp = named.groupBy("comp").agg(F.min("least").alias("least"))
    by_class = named.select("cls", "comp").join(of_comp, "comp")
    out = classes.select("row", "id", "n", "cls").join(by_class, "cls", "left")
    return out.select(
        "row", F.col("id").alias(key), F.col("n").cast("long").alias("n_shingles"), F.col("comp").alias("component"),
        F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"),
    )


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read(spark, sf_dir, "documents")).drop("row", "component")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each component the document with the least id, once; documents without words all stay."""
    judged = stored(jaccard_components(docs), "components")
    known = judged.where("n_shingles > 0")
    stays = known.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("component").agg(F.min("row").alias("__row"), F.count("*").alias("n"))
    gone = known.select(F.col("row").alias("__row")).join(stays.select("__row"), "__row", "left_anti").distinct()
    twice = stays.where("n > 1").select("__row")
    marked = docs.withColumn("__row", F.xxhash64("doc_id", "text"))
    once = marked.join(_small(stored(gone.unionByName(twice), "gone")), "__row", "left_anti")
    again = marked.join(_small(stored(twice, "twice")), "__row", "left_semi").dropDuplicates(["__row"])
    return once.unionByName(again).select(*docs.columns)


ORACLE_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) END AS s FROM docs),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
counted AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS shared
  FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM counted WHERE 100 * shared >= 80 * (n + m - shared)),
reached(a, b) AS (SELECT doc_id, doc_id FROM sets UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, least AS component_id
FROM sets JOIN (SELECT a, min(b) AS least FROM reached GROUP BY a) ON a = doc_id
"""
