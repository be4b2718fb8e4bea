"""Placement of keys on shards by a permutation-filled lookup table, with DataFrame functions only.

Every shard prefers the slots of a prime-sized table in an order of its own, given by an offset and a
stride. The shards take turns; at each turn a shard claims the first slot of its order that is still
free, until the table is full. All shards get the same number of slots to within one, and few slots
change hands when a shard joins or leaves. A key's slot is its hash modulo the table size, so placement
is one lookup. The table has a fixed size, which the caller chooses, and is broadcast.

A hot key cannot be split by placement: rows of one key share a shard by contract. Rows are never
grouped or shuffled here, so a hot key costs nothing either.

Nulls: a null key is placed as the empty key. Repeated rows are placed alike. Columns `slot` and
`shard` replace ones of the same name.
"""

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHARDS = [f"shard-{i:02d}" for i in range(48)]
SLOTS = 10_007
SLOT_LIMIT = 1_000_000  # bound of what is broadcast


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill(shards: list[str], slots: int) -> list[int]:
    """Index of the owning shard per slot. Takes slots * log(slots) steps or so, whatever the data."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards must be given and distinct")
    if not len(shards) <= slots <= SLOT_LIMIT or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"slots must be a prime between the number of shards and {SLOT_LIMIT}")
    place = [_number(f"offset:{s}") % slots for s in shards]
    stride = [_number(f"stride:{s}") % (slots - 1) + 1 if slots > 1 else 0 for s in shards]
    owner = [-1] * slots
    left = slots
    while left:
        for i in range(len(shards)):
            if not left:
                break
            while owner[place[i]] >= 0:
                place[i] = (place[i] + stride[i]) % slots
            owner[place[i]] = i
            left -= 1
    return owner


def lookup(spark: SparkSession, shards: list[str], slots: int) -> DataFrame:
    """(slot, shard) as a table."""
    owners = ",".join(str(i) for i in fill(shards, slots))
    names = F.array(*[F.lit(s) for s in shards])
    entries = spark.range(1, numPartitions=1).select(F.posexplode(F.split(F.lit(owners), ",")).alias("slot", "owner"))
    return entries.select(F.col("slot").cast("long").alias("slot"), F.element_at(names, F.col("owner").cast("int") + 1).alias("shard"))


def slot_of(key: Column, slots: int) -> Column:
    """15 hexadecimal digits of the key's MD5, modulo the table size."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15)
    return F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(slots))


def place(rows: DataFrame, key: str = "doc_id", shards: list[str] | None = None, slots: int = SLOTS) -> DataFrame:
    """rows with `slot` and `shard`; the lookup table, of at most SLOT_LIMIT rows, is broadcast."""
    table = lookup(rows.sparkSession, shards or SHARDS, slots)
    placed = rows.drop("shard", *([] if key == "slot" else ["slot"])).withColumn("_slot", slot_of(F.col(key), slots))
    joined = placed.join(F.broadcast(table.withColumnRenamed("slot", "_at")), F.col("_slot") == F.col("_at"))
    return joined.drop("_at").drop("slot").withColumnRenamed("_slot", "slot")


def sql() -> str:
    """DuckDB check of the placement of documents, over the same table of owners."""
    owners = ", ".join(str(i) for i in fill(SHARDS, SLOTS))
    return f"""
WITH k AS (SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {SLOTS} AS slot FROM documents)
SELECT doc_id, slot, 'shard-' || lpad(([{owners}])[slot + 1]::VARCHAR, 2, '0') AS shard FROM k
"""
