"""Exact middle values of groups of any size, by distributed radix selection.

A percentile aggregate holds every different value of a group in one task.
Where readings have 15 digits that is every row of a hot group.  Here no task
holds more than the 65,536 counts of one digit of a group: doubles become whole
numbers of the same order (their bits, with those of negative numbers turned),
and the number at a rank is found digit by digit, 16 bits at a time.  Each
pass counts, for the values that share the digits found so far, how many have
which next digit (partial counts before the shuffle), and keeps the digit in
which the rank lies.  Four passes, whatever the data; each one's targets (two a
group at most) are written to the shared folder, so that no plan grows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.session import fresh_path

DIGIT = 16
#: Parts over which a group's values are dealt where they meet the group's targets.
SALTS = 64
_MAX = "9223372036854775807L"


def pinned(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = fresh_path(df.sparkSession, "rank", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ordered_bits(c: str) -> Column:
    """A double as a whole number of the same order: -0.0 as 0.0, NaN after infinity; null stays null."""
    bits = f"CAST(reflect('java.lang.Double', 'doubleToLongBits', {c} + 0D) AS BIGINT)"
    return F.expr(f"CASE WHEN {c} IS NOT NULL THEN {bits} ^ (shiftright({bits}, 63) & {_MAX}) END")


def from_ordered_bits(c: str) -> Column:
    """The double of :func:`ordered_bits`."""
    return F.expr(f"CASE WHEN {c} IS NOT NULL THEN CAST(reflect('java.lang.Double', 'longBitsToDouble', {c} ^ (shiftright({c}, 63) & {_MAX})) AS DOUBLE) END")


def middle_values(rows: DataFrame, keys: list[str], value: str, weight: str | None = None) -> DataFrame:
    """Of each group its number of values, and the two middle ones (one and the same, if their number is odd):
    ``keys, n, low, high``.

    ``weight``: how often a row's value counts.  Rows with a null value are
    left out; keys must not be null.  Batch only.
    """
    number = F.col(f"`{weight}`") if weight else F.lit(1).cast("long")
    coded = rows.where(F.col(f"`{value}`").isNotNull()).select(*keys, ordered_bits(f"`{value}`").alias("_code"), number.alias("_n"))
    # Equal values become one row each; the code in the key spreads a hot group.
    counted = pinned(coded.groupBy(*keys, "_code").agg(F.sum("_n").alias("_n")), "codes")
    counted = counted.withColumn("_salt", F.pmod(F.xxhash64("_code"), F.lit(SALTS)).cast("int"))
    total = counted.groupBy(*keys).agg(F.sum("_n").alias("n"))
    ranks = F.array_distinct(F.array(F.expr("(n - 1) div 2"), F.expr("n div 2")))
    targets = pinned(total.select(*keys, "n", F.posexplode(ranks).alias("_which", "_rank"), F.lit(0).cast("long").alias("_code")), "targets")
    for shift in range(64 - DIGIT, -1, -DIGIT):
        dealt = targets.select(*keys, "_which", "_rank", F.col("_code").alias("_prefix"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
        met = counted.join(dealt, [*keys, "_salt"])
        if shift + DIGIT < 64:
            met = met.where(F.shiftright("_code", shift + DIGIT) == F.col("_prefix"))
        digits = met.groupBy(*keys, "_which", "_rank", F.shiftright("_code", shift).alias("_code")).agg(F.sum("_n").alias("_n"))
        upto = F.sum("_n").over(Window.partitionBy(*keys, "_which").orderBy("_code").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        found = digits.withColumn("_upto", upto).where("_upto > _rank AND _upto - _n <= _rank")
        found = found.select(*keys, "_which", (F.col("_rank") - F.col("_upto") + F.col("_n")).alias("_rank"), "_code")
        targets = pinned(found, "targets")
    value_at = lambda which: F.max(F.when(F.col("_which") == which, F.col("_code")))
    ends = targets.groupBy(*keys).agg(value_at(0).alias("_low"), F.coalesce(value_at(1), value_at(0)).alias("_high"))
    return total.join(ends, keys).select(*keys, "n", from_ordered_bits("_low").alias("low"), from_ordered_bits("_high").alias("high"))
