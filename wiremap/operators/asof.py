"""As-of join: for each left row, the latest right row strictly before it.

Spark has no as-of join.  Joining every right row of a key and keeping the
best one emits all pairs of a key, and a single running window per key puts
a hot key into one task.  This operator uses two levels of windows instead:

1. Left and right rows are unioned and cut into ``(by, time bucket)``
   partitions; a running ``last(payload, ignorenulls)`` gives each left row
   the latest right row earlier in its own bucket.  At equal times left rows
   sort first, so only strictly earlier right rows count.
2. For the right rows of earlier buckets, each right bucket is reduced to its
   latest row, and a running ``last`` over ``(bucket, kind)`` per key, on the
   distinct left buckets and those reduced right buckets only, carries the
   latest earlier row into every left bucket.  That window holds at most one
   row per bucket per key, however many rows the key has.

The result is exact for any bucket width; the width only moves work between
the two levels (a hot key is split into as many tasks as it has buckets).
Ties on the right clock are broken by the remaining payload fields, the
smallest (nulls last) winning, so the result is deterministic and agrees with
an ascending total order on those fields.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

DEFAULT_BUCKET_SECONDS = 60


def asof_latest(left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str,
                right_time: str, right_cols: Sequence[str], out: str = "asof",
                bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """``left`` plus a struct column ``out`` = ``(right_time, *right_cols)`` of the
    latest right row with equal ``by`` and ``right_time < left_time`` (null if none).
    Null keys and null times never match, as in an equi-join.
    """
    by = list(by)
    width = int(bucket_seconds) * 1_000_000
    payload = F.struct(*[F.col(c) for c in [right_time, *right_cols]])
    ptype = right.select(payload.alias("p")).schema["p"].dataType

    def bucket(t: str) -> F.Column:
        return F.floor(F.unix_micros(F.col(t)) / F.lit(width)).cast("long")

    lcols = left.columns
    lt = left.select(*lcols, F.col(left_time).alias("__t"))
    ls = lt.select(*lcols, "__t", bucket("__t").alias("__b"), F.lit(0).alias("__k"),
                   F.lit(None).cast(ptype).alias("__p"))
    rt = right.filter(F.col(right_time).isNotNull())
    for c in by:
        rt = rt.filter(F.col(c).isNotNull())
    rs = rt.select(
        *[F.col(c) if c in by else F.lit(None).cast(left.schema[c].dataType).alias(c)
          for c in lcols],
        F.col(right_time).alias("__t"), bucket(right_time).alias("__b"),
        F.lit(1).alias("__k"), payload.alias("__p"))

    # At equal times: left rows first (strictly-before), then right rows from
    # the largest to the smallest payload, so the running last is the smallest.
    ties = [F.col("__p").getField(c).desc_nulls_first() for c in right_cols]
    running = (Window.partitionBy(*by, "__b").orderBy("__t", "__k", *ties)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    within = (ls.unionByName(rs)
              .withColumn("__in", F.last("__p", ignorenulls=True).over(running))
              .filter(F.col("__k") == 0))

    best = Window.partitionBy(*by, "__b").orderBy(
        F.col("__t").desc(), *[F.col("__p").getField(c).asc_nulls_last() for c in right_cols])
    right_buckets = (rs.select(*by, "__b", "__t", "__p")
                     .withColumn("__rn", F.row_number().over(best))
                     .filter(F.col("__rn") == 1).select(*by, "__b", "__p"))
    left_buckets = ls.select(*by, "__b").distinct()
    series = (left_buckets.withColumn("__k", F.lit(0)).withColumn("__p", F.lit(None).cast(ptype))
              .unionByName(right_buckets.withColumn("__k", F.lit(1))))
    carry_w = (Window.partitionBy(*by).orderBy("__b", "__k")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carry = (series.withColumn("__carry", F.last("__p", ignorenulls=True).over(carry_w))
             .filter((F.col("__k") == 0) & F.col("__carry").isNotNull())
             .select(*by, "__b", "__carry"))

    # ``within`` is already hash-partitioned on (by, bucket) by its window, so
    # this join moves only the carry table (one row per key and bucket).
    joined = within.join(carry, [*by, "__b"], "left")
    return joined.select(*lcols, F.coalesce("__in", "__carry").alias(out))
