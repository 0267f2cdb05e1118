"""Attributes as known at event time.

Revisions become, per entity, half-open intervals [start, end) in each of which one revision is the one in force, exploded into
those time buckets that hold events of the entity. Events find theirs by an equi-join on (entity, bucket) and containment, so no
join is ever on time alone, and a stray event or revision of another age costs one bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

MONTH_S = 30 * 86_400


def _micros(time: Column) -> Column:
    """Microseconds since 1970; a time without zone is read in the session's zone, on both sides alike."""
    return F.unix_micros(time.cast("timestamp"))


def _bucket(micros: Column, seconds: int) -> Column:
    width = F.lit(seconds * 1_000_000)
    return ((micros - F.pmod(micros, width)) / width).cast("bigint")


def _start(bucket: Column, seconds: int) -> Column:
    return bucket * F.lit(seconds * 1_000_000)


def validity_intervals(revisions: DataFrame, *, entity: Column, valid_from: Column, known_at: Column, attributes: list[str], needed: DataFrame, bucket_s: int = MONTH_S) -> DataFrame:
    """Rows (__entity, __bucket, __from, __to, __rev): the revision in force in [__from, __to), cut at the borders of the
    buckets in needed (__entity, __bucket, distinct).

    A revision counts from the moment when it both applies and is known. Among those that count, the one with the latest
    valid_from is in force, then the latest known_at, then the greatest attributes in the given order. Revisions without
    entity or times never count; repeated rows count once. The running best is taken per (entity, bucket) with the best of all earlier buckets
    carried in, so that the revisions of one busy entity are spread over its buckets. There are at most as many intervals
    as changes and needed buckets together, however far apart in time these lie.
    """
    rows = revisions.select(
        entity.alias("__entity"),
        F.greatest(_micros(valid_from), _micros(known_at)).alias("__at"),
        F.struct(valid_from.alias("valid_from"), known_at.alias("known_at"), *[F.col(c) for c in attributes]).alias("__rev"),
        valid_from.isNotNull().alias("__v"),
        known_at.isNotNull().alias("__k"),
    ).where("__entity is not null and __v and __k")
    changes = rows.groupBy("__entity", _bucket(F.col("__at"), bucket_s).alias("__bucket"), "__at").agg(F.max("__rev").alias("__rev"))
    by_time = Window.partitionBy("__entity").orderBy("__bucket")
    touched = changes.select("__entity", "__bucket", "__at", "__rev", F.lit(False).alias("__needed"))
    empty = needed.select("__entity", "__bucket", F.lit(None).cast("bigint").alias("__at"), F.lit(None).cast(dict(changes.dtypes)["__rev"]).alias("__rev"), F.lit(True).alias("__needed"))
    buckets = (
        touched.unionByName(empty)
        .groupBy("__entity", "__bucket")
        .agg(F.max("__rev").alias("__best"), F.min("__at").alias("__first"), F.max("__needed").alias("__needed"))
        .withColumn("__carry", F.max("__best").over(by_time.rowsBetween(Window.unboundedPreceding, -1)))
        .where("__needed")
    )
    end = _start(F.col("__bucket") + 1, bucket_s)
    within = Window.partitionBy("__entity", "__bucket").orderBy("__at")
    inside = changes.join(buckets.where("__first is not null").select("__entity", "__bucket", "__carry"), ["__entity", "__bucket"]).select(
        "__entity",
        "__bucket",
        F.col("__at").alias("__from"),
        F.coalesce(F.lead("__at").over(within), end).alias("__to"),
        F.greatest("__carry", F.max("__rev").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))).alias("__rev"),
    )
    carried = buckets.where("__carry is not null").select(
        "__entity", "__bucket", _start(F.col("__bucket"), bucket_s).alias("__from"), F.coalesce("__first", end).alias("__to"), F.col("__carry").alias("__rev")
    )
    return inside.unionByName(carried)


def asof_join(
    events: DataFrame,
    revisions: DataFrame,
    *,
    event_entity: Column,
    event_time: str,
    entity: Column,
    valid_from: str,
    known_at: str,
    attributes: list[str],
    prefix: str = "asof_",
    bucket_s: int = MONTH_S,
    broadcast_rows: int = 20_000,
    salts: int = 16,
) -> DataFrame:
    """Every event with the attributes that applied and were already known at its time.

    Result: all columns of events, then prefix + name for valid_from, known_at and each attribute; a name that events
    already have gets further underscores. Events without entity or time, or before the first known revision, keep nulls;
    no event is lost or doubled, repeated events stay repeated. Equal moments count as known (<=). attributes are also
    the last tie-break, so put the revision's key first. An empty table on either side gives events with nulls.

    The events are looked at once more before the join, for the distinct (entity, bucket) they fall into (partially aggregated, so a
    busy entity shuffles one row per bucket and task). The intervals are written once and broadcast only when there are at most
    broadcast_rows of them; beyond that both sides are shuffled on (entity, bucket, salt), the intervals once per salt, so that an entity that
    holds a third of the events in one bucket still spreads over `salts` tasks.
    """
    time = _micros(F.col(event_time))
    e = events.withColumns({"__entity": event_entity, "__time": time}).withColumn("__bucket", _bucket(F.col("__time"), bucket_s))
    needed = e.where("__entity is not null and __bucket is not null").select("__entity", "__bucket").distinct()
    spans = cut_lineage(validity_intervals(revisions, entity=entity, valid_from=F.col(valid_from), known_at=F.col(known_at), attributes=attributes, needed=needed, bucket_s=bucket_s))
    keys = ["__entity", "__bucket"]
    if spans.count() <= broadcast_rows:
        right = F.broadcast(spans)
    else:
        e = e.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in events.columns]), F.lit(salts)))
        right = spans.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
        keys.append("__salt")
    r = right.select(*[F.col(k).alias(f"r{k}") for k in keys], "__from", "__to", "__rev")
    joined = e.join(
        r, [F.col(k) == F.col(f"r{k}") for k in keys] + [F.col("__time") >= F.col("__from"), F.col("__time") < F.col("__to")], "left"
    )
    taken, out = set(events.columns), []
    for c in ["valid_from", "known_at", *attributes]:
        name = prefix + c
        while name in taken:
            name += "_"
        taken.add(name)
        out.append(F.col("__rev").getField(c).alias(name))
    return joined.select(*[F.col(f"`{c}`") for c in events.columns], *out)
