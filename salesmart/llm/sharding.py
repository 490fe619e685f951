"""Sharding through a permutation-filled lookup table.

Shards take turns claiming slots of a table of prime size. A shard's order of
preference is a permutation of the slots (an offset and a stride from its name's
hash), and in its turn it claims the first slot of that order still free. Every
shard ends up with nearly equally many slots, and when a shard comes or goes
few slots change hands. A document's key hashes to a slot; the table is a small
fixed number of rows, broadcast, so that placing is one lookup.

Results for odd input: a document without a key is placed by its text, one with
neither by the empty text; repeated rows go to one shard; an empty table stays
empty; columns named ``shard`` or ``slot`` are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHARDS = tuple(f"shard-{i:03d}" for i in range(64))
#: Slots: a prime far above the number of shards. It bounds the broadcast table's rows.
SLOTS = 65_537
MAX_SHARDS = SLOTS // 100


def _number(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{salt}:{name}".encode()).digest()[:8], "big")


def fill_table(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """For each slot the index of the shard that claimed it."""
    if not 0 < len(shards) <= slots or len(set(shards)) != len(shards):
        raise ValueError(f"between 1 and {slots} distinct shard names are needed")
    if slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"the number of slots must be a prime, not {slots}")
    at = [_number(s, "offset") % slots for s in shards]
    stride = [_number(s, "stride") % (slots - 1) + 1 for s in shards]
    owner = [-1] * slots
    free = slots
    while free:
        for i in range(len(shards)):
            while owner[at[i]] >= 0:
                at[i] = (at[i] + stride[i]) % slots
            owner[at[i]] = i
            free -= 1
            if not free:
                break
    return owner


def lookup_table(spark: SparkSession, shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """slot, shard_id and shard; ``slots`` rows."""
    owner = fill_table(shards, slots)
    # an Arrow table is a local relation; a list of rows would start Python workers of another kind on the executors
    columns = {"slot": pa.array(range(slots), pa.int32()), "shard_id": pa.array(owner, pa.int32()), "shard": [shards[i] for i in owner]}
    return spark.createDataFrame(pa.table(columns), "slot int, shard_id int, shard string")


def shard(
    docs: DataFrame, shards: Sequence[str] = SHARDS, *, key: str = "doc_id", text: str = "text", slots: int = SLOTS
) -> DataFrame:
    """``docs`` with slot, shard_id and shard: one broadcast lookup, no shuffle."""
    if len(shards) > MAX_SHARDS:
        raise ValueError(f"at most {MAX_SHARDS} shards share {slots} slots evenly")
    table = F.broadcast(lookup_table(docs.sparkSession, shards, slots))
    named = F.concat_ws(
        ":", F.when(F.col(key).isNull(), "text").otherwise("key"),
        F.coalesce(F.col(key).cast("string"), F.col(text), F.lit("")),
    )
    # 60 bits of a digest, which any engine can compute
    digits = F.conv(F.substring(F.md5(named), 1, 15), 16, 10).cast("long")
    keyed = docs.drop("slot", "shard", "shard_id").withColumn("slot", (digits % slots).cast("int"))
    return keyed.join(table, "slot").select(*[c for c in keyed.columns if c != "slot"], "slot", "shard_id", "shard")


def write_shards(sharded: DataFrame, path: str, *, rows_per_file: int = 1_000_000) -> None:
    """Writes one folder per shard; a shard's rows spread over tasks, its files hold ``rows_per_file`` rows at most."""
    (
        sharded.repartition("shard", F.pmod(F.xxhash64(*sharded.columns), F.lit(16)))
        .write.option("maxRecordsPerFile", rows_per_file)
        .partitionBy("shard")
        .parquet(path)
    )
