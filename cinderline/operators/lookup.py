"""Left join with a table that has one row per key, safe for keys that hold a large part of the left side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_lookup(left: DataFrame, right: DataFrame, key: str, *, broadcast_rows: int = 50_000, salts: int = 16) -> DataFrame:
    """left with the columns of right (unique by key); null or unknown keys get nulls, no row of left is lost or doubled.

    right is broadcast if it is counted to have at most broadcast_rows rows. Beyond that it is repeated once per salt and
    both sides are shuffled on (key, salt), so a key with a third of all rows is spread over `salts` tasks.
    """
    if right.limit(broadcast_rows + 1).count() <= broadcast_rows:
        return left.join(F.broadcast(right), key, "left")
    salted = left.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(salts)))
    copies = right.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    return salted.join(copies, [key, "__salt"], "left").drop("__salt")
