"""Sharding: a lookup table that shards fill in turns by their own orders of preference.

Each shard walks a permutation of the slots of a prime-sized table (its start and its stride come
from a hash of its name) and claims, when it is its turn, the first slot that is still free. A key
then finds its shard by one lookup, shards hold nearly equal parts, and a shard that leaves
disturbs few others.
"""

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.tasks import read

SLOTS = 65_537
SHARDS = 64


def _preference(shard: str, slots: int) -> tuple[int, int]:
    digest = hashlib.sha256(shard.encode()).digest()
    return int.from_bytes(digest[:8], "big") % slots, int.from_bytes(digest[8:16], "big") % (slots - 1) + 1


def lookup_table(shards: Sequence[str], slots: int = SLOTS) -> list[str]:
    """The shard of each slot. `slots` must be a prime, so that each stride reaches every slot."""
    if not shards or len(set(shards)) != len(shards) or len(shards) > slots:
        raise ValueError("shards must be distinct, at least one, and no more than slots")
    if slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be a prime")
    walks = [_preference(s, slots) for s in shards]
    at, table, free = [start for start, _ in walks], [""] * slots, slots
    while free:
        for k, (_, stride) in enumerate(walks):
            while table[at[k]]:
                at[k] = (at[k] + stride) % slots
            table[at[k]] = shards[k]
            free -= 1
            if not free:
                break
    return table


def slot_of(key: str, slots: int = SLOTS):
    """The slot of a key column, by its text; a null key counts as empty text."""
    return F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(slots))


def place(df: DataFrame, key: str, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """`df` with `slot` and `shard` (columns of these names are replaced).

    Equal keys share a shard, null keys are placed as empty text, every row stays once. The table
    is broadcast: its size is the parameter `slots`, whatever `df` holds. Nothing is shuffled.
    """
    table = df.sparkSession.createDataFrame([(k, s) for k, s in enumerate(lookup_table(shards, slots))], "slot long, shard string")
    kept = df.select(*[F.col(c) for c in df.columns if c not in ("slot", "shard")], slot_of(key, slots).alias("slot"))
    return kept.join(F.broadcast(table), "slot").select(*[c for c in kept.columns if c != "slot"], "slot", "shard")


def write_shards(placed: DataFrame, path: str, files: int = 4) -> None:
    """Writes placed rows below `path`, a folder for each shard, each of about `files` files.

    Rows are spread by shard and slot, so that one shard is not one task.
    """
    spread = placed.withColumn("__part", F.pmod(F.col("slot"), F.lit(files)))
    spread.repartition(F.col("shard"), F.col("__part")).drop("__part").write.partitionBy("shard").parquet(path)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id")
    return place(docs, "doc_id", [f"shard-{k:03d}" for k in range(SHARDS)])
