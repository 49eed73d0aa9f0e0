"""Policies as they were: versions in time, the grants each holds, and which of them a row falls under."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.operators.ranking import ranked
from wardline.operators.sizing import fits

#: Versions that a bucket of time may hold before finer buckets are taken, and the finest cut of the whole time.
PER_BUCKET, FINEST = 32, 20

#: Versions of a block, and of a word of it: a grant has one bit for each version. A block with more runs than `RUNS` stays a row of bits.
BLOCK, WORD, RUNS = 256, 64, 8

_GRANT = ["user_name", "db", "tbl", "col", "udf", "access"]


def number_versions(versions: DataFrame) -> DataFrame:
    """`version, valid_from, valid_to` of the times at which policies changed (column `valid_from`).

    Versions count from 1 in order of time, unless they come with numbers in that order (`version`, which
    may leave some out); equal times are one version, null times none. The last one has no end.
    """
    given = "version" in versions.columns
    times = versions.select(F.col("valid_from").cast("timestamp"), *(["version"] if given else [])).where("valid_from IS NOT NULL").distinct()
    placed = ranked(times, [F.col("valid_from")], "place")
    later = placed.select((F.col("place") - 1).alias("place"), F.col("valid_from").alias("valid_to"))
    number = F.col("version" if given else "place").alias("version")
    return placed.join(later, "place", "left").select(number, "valid_from", "valid_to")


def pack_versions(listed: DataFrame) -> DataFrame:
    """Rows with a `version` as one row for each block of versions, with `block` and `held`: the words of its bits.

    Only numbers are aggregated, so that rows combine before any exchange: what is moved and kept
    grows with the bits, whatever the number of rows.
    """
    keys = [c for c in listed.columns if c != "version"]
    bit, word = F.expr(f"shiftleft(1L, CAST(version % {WORD} AS INT))"), F.expr(f"version DIV {WORD} % {BLOCK // WORD}")
    words = [F.bit_or(F.when(word == k, bit).otherwise(F.lit(0).cast("long"))).alias(f"__{k}") for k in range(BLOCK // WORD)]
    packed = listed.groupBy(*keys, F.expr(f"version DIV {BLOCK}").alias("block")).agg(*words)
    return packed.select(*keys, "block", F.array(*[f"__{k}" for k in range(BLOCK // WORD)]).alias("held"))


def unpack_versions(packed: DataFrame) -> DataFrame:
    """The rows of `pack_versions` with one `version` each."""
    places = F.filter(F.sequence(F.lit(0), F.lit(BLOCK - 1)), lambda i: _bit(F.col("held"), i))
    return packed.withColumn("version", F.explode(F.transform(places, lambda i: i + F.col("block") * BLOCK))).drop("block", "held")


def versions_of(packed: DataFrame) -> DataFrame:
    """Each `version` in which any of the packed rows stands."""
    words = [F.bit_or(F.get("held", F.lit(k))).alias(f"__{k}") for k in range(BLOCK // WORD)]
    blocks = packed.groupBy("block").agg(*words)
    return unpack_versions(blocks.select("block", F.array(*[f"__{k}" for k in range(BLOCK // WORD)]).alias("held")))


def _bit(words: Column, place: Column) -> Column:
    """Whether a bit of the words of a block is set."""
    return F.getbit(F.get(words, F.call_function("div", place, F.lit(WORD)).cast("int")), (place % WORD).cast("int")) == 1


def standing(words: Column, version: Column) -> Column:
    """Whether a version of a block is one of those that its words tell of."""
    return _bit(words, version % BLOCK)


def words_between(since: Column, until: Column, block: Column) -> list[Column]:
    """The words of a block in which the versions from one up to another have their bits."""
    found = []
    for first in range(0, BLOCK, WORD):
        low, high = (F.greatest(F.least(c - (block * BLOCK + first), F.lit(WORD)), F.lit(0)).cast("int") for c in (since, until))
        # A shift by 64 is one by 0: no versions are no bits.
        ones = F.call_function("shiftrightunsigned", F.lit(-1).cast("long"), WORD - (high - low))
        found.append(F.when(low < high, F.call_function("shiftleft", ones, low)).otherwise(F.lit(0).cast("long")))
    return found


def block_spells(blocks: DataFrame, last: int) -> DataFrame:
    """Grants with `since`, `until` and `held`, from blocks of their versions.

    A grant that stands in versions one behind the other is one row from the first of them up to the
    first that lacks it; `until` is null while it stands in the last. Where it comes and goes, a block
    stays one row, and `held` tells which of its versions count.
    """
    grant = [c for c in blocks.columns if c not in ("block", "held")]
    begun = F.aggregate(F.transform("held", lambda w: F.bit_count(w.bitwiseAND(F.bitwise_not(F.shiftleft(w, 1))))), F.lit(0), lambda a, b: a + b)
    few = begun <= RUNS
    places = F.sequence(F.lit(0), F.lit(BLOCK - 1))
    begins = F.filter(places, lambda i: _bit(F.col("held"), i) & ((i == 0) | ~_bit(F.col("held"), F.greatest(i - 1, F.lit(0)))))
    ends = F.filter(places, lambda i: _bit(F.col("held"), i) & ((i == BLOCK - 1) | ~_bit(F.col("held"), F.least(i + 1, F.lit(BLOCK - 1)))))
    runs = blocks.where(few).select(*grant, "block", F.explode(F.arrays_zip(begins.alias("since"), ends.alias("end"))).alias("run"))
    runs = runs.select(*grant, (F.col("block") * BLOCK + F.col("run.since")).alias("since"), (F.col("block") * BLOCK + F.col("run.end")).alias("end"))
    # A grant has at most a few runs for each block; those that meet at a border are one.
    by_grant = Window.partitionBy(*grant).orderBy("since", "end")
    before = F.max("end").over(by_grant.rowsBetween(Window.unboundedPreceding, -1))
    joined = runs.withColumn("__new", F.coalesce(before + 1 < F.col("since"), F.lit(True)).cast("int")).withColumn("__run", F.sum("__new").over(by_grant.rowsBetween(Window.unboundedPreceding, 0)))
    whole = joined.groupBy(*grant, "__run").agg(F.min("since").alias("since"), F.max("end").alias("end"))
    whole = whole.select(*grant, "since", F.when(F.col("end") < last, F.col("end") + 1).alias("until"), F.lit(None).cast("array<bigint>").alias("held"))
    stands_now = (F.col("block") == last // BLOCK) & standing(F.col("held"), F.lit(last))
    until = F.when(~stands_now, F.least((F.col("block") + 1) * BLOCK, F.lit(last + 1).cast("long"))).alias("until")
    broken = blocks.where(~few).select(*grant, (F.col("block") * BLOCK).alias("since"), until, "held")
    return whole.unionByName(broken)


def grant_history(snapshots: DataFrame, versions: DataFrame) -> DataFrame:
    """Grants with `since`, `until` and `held` as `block_spells` gives them, from the whole snapshots of all versions (column `valid_from`)."""
    grant = [c for c in _GRANT if c in snapshots.columns]
    last = versions.agg(F.max("version")).first()[0] or 0
    listed = snapshots.withColumn("valid_from", F.col("valid_from").cast("timestamp")).join(versions.select("valid_from", "version"), "valid_from").select(*grant, "version")
    return block_spells(pack_versions(listed), last)


def _bucket(at: Column, first: int, width: int) -> Column:
    return F.floor((F.unix_micros(at) - first) / width).cast("long")


def _width(versions: DataFrame, first: int, length: int) -> int:
    """Microseconds of a bucket, so that few versions begin in one: the widest of the halvings of the whole time that will do."""
    cuts = F.explode(F.sequence(F.lit(6), F.lit(FINEST))).alias("cut")
    place = F.floor((F.unix_micros("valid_from") - first) / F.greatest(F.floor(F.lit(length) / F.pow(F.lit(2), F.col("cut"))), F.lit(1)))
    filled = versions.select(cuts, "valid_from").groupBy("cut", place.alias("place")).count()
    most = {r["cut"]: r["most"] for r in filled.groupBy("cut").agg(F.max("count").alias("most")).collect()}
    cut = next((c for c in sorted(most) if most[c] <= PER_BUCKET), FINEST)
    return max(1, length >> cut)


def as_of(log: DataFrame, versions: DataFrame, at: str = "ts") -> DataFrame:
    """`log` with the `version` in force at each row's time: the last one that began by then.

    Rows before the first version, and rows without a time, have none. Time is cut into buckets; a
    version lies in each bucket it touches, so a row meets the few versions of its own bucket by an
    equal key. Rows under the last version need no lookup. The buckets are broadcast if they are
    proven to fit; beyond that, rows without a lookup are spread, and hot buckets are left to AQE.
    """
    ends = versions.agg(F.min("valid_from"), F.max("valid_from"), F.max("version"), F.min(F.unix_micros("valid_from")), F.max(F.unix_micros("valid_from"))).first()
    first, last, newest, begin, end = ends
    if newest is None:
        return log.withColumn("version", F.lit(None).cast("long"))
    width = _width(versions, begin, end - begin)
    until = F.unix_micros("valid_to") - 1
    touched = F.sequence(_bucket(F.col("valid_from"), begin, width), F.floor((until - begin) / width).cast("long"))
    spans = versions.where("valid_to IS NOT NULL").select(F.explode(touched).alias("__bucket"), F.col("version").alias("__version"), "valid_from", "valid_to")
    time = F.col(at).cast("timestamp")
    inside = (time >= F.lit(first)) & (time < F.lit(last))
    spread = -1 - F.pmod(F.xxhash64(time), F.lit(1 << 20))
    keyed = log.withColumns({"__time": time, "__at": F.when(inside, _bucket(time, begin, width)).otherwise(spread)}).alias("log")
    spans = (F.broadcast(spans) if fits(spans) else spans).alias("span")
    met = (F.col("log.__at") == F.col("span.__bucket")) & (F.col("span.valid_from") <= F.col("log.__time")) & (F.col("log.__time") < F.col("span.valid_to"))
    version = F.when(F.col("log.__time") >= F.lit(last), F.lit(newest)).otherwise(F.col("span.__version")).alias("version")
    return keyed.join(spans, met, "left").select("log.*", version).drop("__at", "__time")
