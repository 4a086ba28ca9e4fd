"""Document placement with a permutation-filled lookup table.

Each shard prefers the table's slots in an order of its own: from an offset it
goes on by a step, both hashes of its name, modulo the table's prime size, so
that it meets every slot once.  The shards take turns; at its turn a shard
claims the first slot of its order that is still free, until all are taken.
A shard of weight w has w turns in a round.  A key's hash modulo the size is
its slot.  Loads differ by at most one slot per weight, and when a shard
leaves, few other slots change hands.

The table is a parameter, of ``SIZE`` slots whatever the data, filled once; it
enters the plan as a constant and is broadcast, so placing is one lookup and
nothing is shuffled.  DataFrame operations only.

Defined results: a null key hashes as the text "null"; equal keys share a
slot; other columns stay as they are (``slot`` and ``shard`` replace columns
of these names); an empty table stays empty.
"""

from __future__ import annotations

from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Slots (a prime, over 100 for each shard) and shards of the registered query.
SIZE = 16381
SHARDS = tuple(f"shard-{i:03d}" for i in range(96))


def _number(*words: str) -> int:
    return int(md5("|".join(words).encode()).hexdigest()[:15], 16)


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def fill(shards: dict[str, int] | tuple[str, ...], size: int = SIZE) -> list[int]:
    """The shard number of each slot; shards are numbered in the order of their names."""
    weights = shards if isinstance(shards, dict) else {s: 1 for s in shards}
    names = sorted(weights)
    if not is_prime(size) or len(names) > size or not names or min(weights.values()) < 1:
        raise ValueError("the size must be a prime, not under the number of shards, and weights at least 1")
    at = [_number("offset", s) % size for s in names]
    step = [_number("step", s) % (size - 1) + 1 for s in names]
    table, free = [-1] * size, size
    while True:
        for i, s in enumerate(names):
            for _ in range(weights[s]):
                while table[at[i]] >= 0:
                    at[i] = (at[i] + step[i]) % size
                table[at[i]] = i
                free -= 1
                if not free:
                    return table


def slot(key: Column, size: int = SIZE) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("null")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"), F.lit(size)).cast("int")


def table(spark: SparkSession, shards: dict[str, int] | tuple[str, ...] = SHARDS, size: int = SIZE) -> DataFrame:
    """(slot, shard): the lookup table."""
    names = sorted(shards)
    numbers = ",".join(str(i) for i in fill(shards, size))
    cells = spark.range(1).select(F.posexplode(F.split(F.lit(numbers), ",")).alias("slot", "n"))
    return cells.select("slot", F.get(F.split(F.lit("\n".join(names)), "\n"), F.col("n").cast("int")).alias("shard"))


def place(docs: DataFrame, key: str = "doc_id", shards: dict[str, int] | tuple[str, ...] = SHARDS, size: int = SIZE) -> DataFrame:
    """``docs`` with slot and shard."""
    docs = docs.drop("shard").withColumn("slot", slot(F.col(f"`{key}`"), size))
    return docs.join(F.broadcast(table(docs.sparkSession, shards, size)), "slot", "left")


def report(docs: DataFrame, shards: tuple[str, ...] = SHARDS, size: int = SIZE) -> DataFrame:
    """Per document: doc_id, text's bytes, slot, shard, and the shard that would hold it if the first one left."""
    rows = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    rest = table(docs.sparkSession, tuple(sorted(shards)[1:]), size).withColumnRenamed("shard", "shard_without_first")
    placed = place(rows, "doc_id", shards, size).join(F.broadcast(rest), "slot", "left")
    return placed.select("doc_id", "n_bytes", F.col("slot").cast("long").alias("slot"), "shard", "shard_without_first")


def sql(shards: tuple[str, ...] = SHARDS, size: int = SIZE) -> str:
    """The report in DuckDB's SQL, which looks up the same tables by their own hash of the key."""
    names = sorted(shards)

    def values(of: list[str]) -> str:
        return f"string_split('{' '.join(of)}', ' ')[s + 1]"

    first = [names[i] for i in fill(shards, size)]
    rest = [names[1:][i] for i in fill(tuple(names[1:]), size)]
    return f"""
select doc_id, n_bytes, s as slot, {values(first)} as shard, {values(rest)} as shard_without_first from (
  select doc_id, cast(coalesce(strlen(text), 0) as bigint) as n_bytes,
    cast(('0x' || substr(md5(coalesce(cast(doc_id as varchar), 'null')), 1, 15)) as bigint) % {size} as s
  from documents)
"""
